"""Sets, selection, lineages, names and trees against plain forms."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from basalt.functions.sequence import HYDROPATHY, hydrophobic_spans, membrane_spans
from basalt.operators import lineage as L
from basalt.operators import sets, trees
from basalt.operators.naming import unique_ids
from basalt.operators.selection import upper_median


@pytest.mark.parametrize("seed", [1, 2])
def test_shared_members_with_hot_members(spark, seed, monkeypatch):
    """Small tiles, members of two to all groups, nulls and repeats."""
    monkeypatch.setattr(sets, "TILE_GROUPS", 7)
    monkeypatch.setattr(sets, "TILE_MEMBERS", 5)
    rng = random.Random(seed)
    rows = [(f"g{rng.randrange(60)}", rng.choice([rng.randrange(12), rng.randrange(400)])) for _ in range(2500)] + [(None, 1), ("g1", None), ("lonely", 999)]
    got = {(r["a"], r["b"]): (r["shared"], round(r["distance"], 9)) for r in sets.jaccard_pairs(spark.createDataFrame(rows, "g string, m int"), "g", "m").collect()}
    held = {}
    for g, m in rows:
        if g is not None and m is not None:
            held.setdefault(g, set()).add(m)
    want = {(a, b): (len(held[a] & held[b]), round(1 - len(held[a] & held[b]) / len(held[a] | held[b]), 9)) for a, b in itertools.combinations(sorted(held), 2) if held[a] & held[b]}
    assert got == want
    assert sets.jaccard_pairs(spark.createDataFrame([], "g int, m int"), "g", "m").count() == 0


def test_a_member_of_all_groups_makes_no_squares(spark):
    """Rows sent for a member of m groups grow with m, not with its square."""
    df = spark.range(600).select(F.col("id").alias("g"), F.explode(F.array(F.lit(0), F.col("id") % 7 + 1)).alias("m"))
    pairs = sets.jaccard_pairs(df, "g", "m")
    assert pairs.count() == 600 * 599 // 2
    text = pairs._jdf.queryExecution().toString()
    assert "FlatMapGroupsInArrow" in text and "CartesianProduct" not in text


@pytest.mark.parametrize("least", [3, 100_000])
def test_median_narrows_hot_keys_down(spark, least):
    rng = random.Random(least)
    rows = [("hot", rng.random()) for _ in range(20000)] + [("odd", float(k)) for k in (5, 1, 3)] + [("even", 1.0), ("even", 2.0), ("one", 7.0), (None, 4.0), (None, 9.0), ("none", None)]
    rows += [("tied", rng.choice([1.0, 2.0, 2.0, 3.0])) for _ in range(999)] + [("nan", v) for v in (1.0, float("nan"), 2.0)]
    got = {r["k"]: (r["median"], r["n"]) for r in upper_median(spark.createDataFrame(rows, "k string, v double"), ["k"], "v", least).collect()}
    want = {}
    for k in {r[0] for r in rows if r[1] is not None}:
        values = sorted((v for key, v in rows if key == k and v is not None), key=lambda v: (v != v, v))
        want[k] = (values[len(values) // 2], len(values))
    assert got == want
    assert upper_median(spark.createDataFrame([], "k string, v int"), ["k"], "v").count() == 0


def test_lineages_of_any_depth(spark):
    links = [(f"n{k}", f"n{k // 2}" if k > 1 else None, f"N{k}" if k % 5 else None, "genus" if k % 7 == 0 else "other") for k in range(1, 200)]
    links += [(f"deep{k}", f"deep{k - 1}" if k else "gone", "d", "other") for k in range(70)]
    df = spark.createDataFrame(links, "id string, up string, name string, rank string")
    parent = {k: u for k, u, *_ in links}
    names = {k: n or "" for k, _, n, _ in links}
    ranks = {k: r for k, *_, r in links}

    def way(k):
        out = [k]
        while parent[out[-1]] in parent:
            out.append(parent[out[-1]])
        return out

    got = {(r["node"], r["ancestor"]): r["distance"] for r in L.ancestors(df, "id", "up").collect()}
    assert got == {(k, a): d for k in parent for d, a in enumerate(way(k))}
    text = {r["node"]: (r["lineage"], r["depth"]) for r in L.lineage_text(df, "id", "up", "name", "/").collect()}
    assert text == {k: ("/".join(names[a] for a in reversed(way(k))), len(way(k)) - 1) for k in parent}
    evidence = spark.createDataFrame([("n3",), ("n12",), ("deep10",)], "e string")
    for levels in (None, 3):
        found = {r["node"]: (r["level"], r["matched"]) for r in L.first_level(df, df, "id", "up", evidence, "e", levels).collect()}
        want = {k: next(((d, a) for d, a in enumerate(way(k)[:levels]) if a in ("n3", "n12", "deep10")), None) for k in parent}
        assert found == {k: v for k, v in want.items() if v}
    called = {r["node"]: r["called"] for r in L.at_rank(df, df, "id", "up", "rank", F.lit("genus")).collect()}
    assert called == {k: next((a for a in way(k) if ranks[a] == "genus"), None) for k in parent}
    with pytest.raises(ValueError, match="circle"):
        L.ancestors(spark.createDataFrame([("a", "b"), ("b", "a")], "id string, up string"), "id", "up")


def plain_names(ids):
    seen, out = set(), []
    for base in ids:
        name, n = base, 2
        while name in seen:
            name, n = f"{base}_{n}", n + 1
        seen.add(name)
        out.append(name)
    return out


def test_names_are_unique_as_if_given_in_turn(spark):
    rng = random.Random(8)
    fixed = ["a", "a", "a_2", "a_2_dup", "a_2", "a", "a_2_2", "b_02", "b", "b", "c_1", "c", "c", "d_3", "d", "d", "d", "d_2", "e", "e_2", "e", "e_3", "e", "q\n_2", "q\n"]
    pool = ["x", "x_2", "x_3", "x_2_2", "x_5", "x_2_3", "x_3_2", "y", "y_4"]
    cases = [fixed, ["a"] * 40, *[[rng.choice(pool) for _ in range(rng.randrange(1, 60))] for _ in range(6)]]
    # Names of different cases never meet: each case has letters of its own.
    marked = [(c, [f"{chr(65 + c)}{i}" for i in case]) for c, case in enumerate(cases)]
    rows = [(c * 10**6 + k * 3, i) for c, case in marked for k, i in enumerate(case)] + [(10**8, None)]
    rng.shuffle(rows)
    got = dict(map(tuple, unique_ids(spark.createDataFrame(rows, "pos int, feature_id string").repartition(3)).select("pos", "unique_id").collect()))
    assert got == {c * 10**6 + k * 3: name for c, case in marked for k, name in enumerate(plain_names(case))} | {10**8: None}


def plain_linkage(names, distances):
    clusters = {n: (frozenset([n]), 0.0) for n in names}
    d = lambda x, y: sum(distances.get((min(i, j), max(i, j)), 1.0) for i in x for j in y) / (len(x) * len(y))
    joins = {}
    while True:
        options = [(d(clusters[a][0], clusters[b][0]), a, b) for a, b in itertools.combinations(sorted(clusters), 2)]
        options = [o for o in options if o[0] < 1 - 1e-12]
        if not options:
            return joins, clusters
        gap, a, b = min(options)
        joined = clusters[a][0] | clusters.pop(b)[0]
        clusters[a] = (joined, gap / 2)
        joins[a, b] = (round(gap / 2, 9), len(joined))


@pytest.mark.parametrize("seed,share", [(1, 1.0), (2, 0.2)])
def test_rounds_of_nearest_pairs_give_the_linkage(spark, seed, share):
    rng = random.Random(seed)
    names = [f"s{k:02}" for k in range(16)]
    distances = {p: rng.random() for p in itertools.combinations(names, 2) if rng.random() < share}
    joins, roots = trees.average_linkage(spark.createDataFrame([(n,) for n in names], "node string"), spark.createDataFrame([(*p, d) for p, d in distances.items()], "a string, b string, distance double"))
    want, clusters = plain_linkage(names, distances)
    assert {(r["left"], r["right"]): (round(r["height"], 9), r["size"]) for r in joins.collect()} == want
    assert {r["node"]: r["size"] for r in roots.collect()} == {n: len(c) for n, (c, _) in clusters.items()}
    whole = trees.newick(roots).first()
    assert whole["leaves"] == 16 and all(whole["newick"].count(n) == 1 for n in names) and whole["newick"].count("(") == 15


def test_newick_of_three(spark):
    nodes, gaps = spark.createDataFrame([("a",), ("b",), ("c",)], "node string"), spark.createDataFrame([("a", "b", 0.2), ("a", "c", 0.6), ("b", "c", 0.8)], "a string, b string, distance double")
    assert trees.newick(trees.average_linkage(nodes, gaps)[1]).first()["newick"] == "((a:0.100000,b:0.100000):0.250000,c:0.350000);"
    assert trees.newick(trees.average_linkage(nodes, gaps.limit(0))[1]).first()["newick"] == "((a:0.500000,b:0.500000):0.000000,c:0.500000);"


def test_leaves_are_spent_on_the_query_then_on_pathogens(spark):
    genomes = [("q", "S1", True, True, 5), ("x", "S1", False, True, 1), ("p2", "S3", False, True, 3), ("p1", "S2", False, True, 2), ("n1", "S4", False, False, 4), ("n2", "S4", False, None, 6), ("n3", None, False, False, 7), ("n4", "S5", None, None, 8)]
    df = spark.createDataFrame(genomes, "node string, species string, is_query boolean, human boolean, pos int")
    label = lambda n: [(r["node"], r["label"]) for r in trees.tree_leaves(df, n).collect()]
    assert label(9) == [("q", "query"), ("p1", "pathogen"), ("p2", "pathogen"), ("n1", "other"), ("n4", "other")]
    assert label(2) == [("q", "query"), ("p1", "pathogen")]
    families = spark.createDataFrame([("q", "f"), ("p1", "f"), ("p1", "g"), ("p2", None)], "node string, family string")
    row = trees.gene_content_tree(df, families).first()
    assert (row["ok"], row["reason"]) == (False, "only 2 genomes have protein families; a tree needs at least 3")
    row = trees.gene_content_tree(df, families.unionByName(spark.createDataFrame([("n1", "h")], families.schema))).first()
    assert (row["ok"], row["leaves"], row["newick"]) == (True, 3, "(n1:0.500000,(p1:0.250000,q:0.250000):0.250000);")


def test_spans_of_long_and_short_sequences(spark):
    rng = random.Random(1)
    letters = "".join(rng.choice("AILVKDEGFXB*") for _ in range(3000)) + "ILV" * 20 + "K" * 9
    scale = [HYDROPATHY.get(c, 0.0) for c in letters]
    hit = [i for i in range(len(letters) - 18) if round(sum(scale[i : i + 19]), 6) >= round(1.6 * 19, 6)]
    runs, start = [], 0
    for k in range(1, len(hit) + 1):
        if k == len(hit) or hit[k] != hit[k - 1] + 1:
            if k - start >= 9:
                runs.append((hit[start] + 10, hit[k - 1] + 10))
            start = k
    assert hydrophobic_spans(letters) == runs and runs
    df = spark.createDataFrame([("I" * 18,), (None,), ("",), ("é" * 30,), ("L" * 1_000_000,)], "sequence string")
    assert [r["spans"] and [tuple(x) for x in r["spans"]] for r in membrane_spans(df).collect()] == [[], None, [], [], [(10, 999_991)]]
