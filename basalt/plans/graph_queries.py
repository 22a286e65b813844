"""Merged annotations, the knowledge graph and rescored runs, bound to the benchmark tables with their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basalt.operators.best import top_per_key
from basalt.plans import annotation as A
from basalt.plans import graph as G
from basalt.plans import rescoring as R
from basalt.plans.queries import Tables, query
from basalt.plans.triage import PROFILES, SOURCE_RANK, Profile

#: Events as what providers say of users: the same expressions in Spark and in SQL.
SAID = {
    "feature_id": "user_id", "pos": "event_id",
    "flag": "CASE event_id % 5 WHEN 0 THEN 'tm_helices' WHEN 1 THEN 'signal_peptide' WHEN 2 THEN 'lipoprotein' WHEN 3 THEN 'localization' ELSE 'description' END",
    "value": """CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 5 = 0 THEN CAST(event_id % 3 AS VARCHAR(9)) WHEN event_id % 5 < 3 THEN CASE WHEN event_id % 2 = 0 THEN 'true' ELSE 'false' END
WHEN event_id % 5 = 3 THEN CASE event_id % 4 WHEN 0 THEN 'cytoplasm' WHEN 1 THEN 'outer membrane' WHEN 2 THEN 'extracellular' ELSE 'cytoplasmic membrane' END ELSE event_type END""",
    "source": f"CASE CAST(floor(event_id / 5) AS BIGINT) % 8 {' '.join(f'WHEN {i} THEN {s!r}' for i, s in enumerate(SOURCE_RANK))} END",
    "evidence": "CAST(event_id AS VARCHAR(20))",
    "first_span": "CASE WHEN event_id % 5 = 0 THEN CAST(event_id % 90 AS INT) END",
}
_CASE = lambda values, key: f"CASE {key} {' '.join(f'WHEN {k!r} THEN {v!r}' for k, v in values.items())} END"
_WEAKEST = lambda *flags: _CASE({v: A.CONFIDENCE[k] for k, v in SOURCE_RANK.items() if v != 50} | {50: "predicted"}, f"least({', '.join(f'{f}_rank' for f in flags)})")

_MERGED = f"""WITH c AS (SELECT {", ".join(f"{x} AS {n}" for n, x in SAID.items())} FROM events WHERE user_id IS NOT NULL), r AS (SELECT *, {_CASE(SOURCE_RANK, "source")} AS own FROM c WHERE value IS NOT NULL),
b AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY feature_id, flag ORDER BY CASE WHEN flag = 'description' THEN coalesce({_CASE(A.NAME_RANK, "source")}, own) ELSE own END DESC, pos) = 1),
w AS (SELECT feature_id, {", ".join(f"max(CASE WHEN flag = '{f}' THEN {x} END) AS {n}{y}" for f, n in (("tm_helices", "tm"), ("signal_peptide", "signal"), ("lipoprotein", "anchor"), ("localization", "place"), ("description", "description")) for x, y in (("value", ""), ("source", "_source"), ("own", "_rank"), ("first_span", "_span")))}
FROM (SELECT DISTINCT feature_id FROM c) LEFT JOIN b USING (feature_id) GROUP BY 1),
x AS (SELECT *, coalesce(CAST(tm AS INT), 0) - CASE WHEN tm_source = 'heuristic' AND CAST(tm AS INT) > 0 AND tm_span <= 45 AND signal = 'true' AND signal_rank > 10 THEN 1 ELSE 0 END AS n, coalesce(signal = 'true', FALSE) AS cut, coalesce(anchor = 'true', FALSE) AS tied, coalesce(place, 'unknown') AS spot FROM w),
y AS (SELECT *, spot IN ('outer membrane', 'cytoplasmic membrane') AS inside, spot = 'extracellular' OR (cut AND n = 0 AND NOT tied) AS gone FROM x),
z AS (SELECT * REPLACE (CASE WHEN inside AND n = 0 THEN place_source ELSE tm_source END AS tm_source, CASE WHEN inside AND n = 0 THEN place_rank ELSE tm_rank END AS tm_rank) FROM y)
SELECT feature_id, CASE WHEN tm_source IS NOT NULL THEN n > 0 OR inside END AS membrane, CASE WHEN tm_source IS NOT NULL THEN n END AS tm_helices, CASE WHEN signal_source IS NOT NULL THEN cut END AS signal_peptide,
CASE WHEN anchor_source IS NOT NULL THEN tied END AS lipoprotein, CASE WHEN signal_source IS NOT NULL OR place_source IS NOT NULL THEN gone END AS secreted,
CASE WHEN signal_source IS NOT NULL OR place_source IS NOT NULL THEN gone OR tied OR spot IN ('outer membrane', 'cell wall', 'extracellular') END AS surface_exposed, spot AS localization, tm_source AS membrane_source, description, description_source,
coalesce({_WEAKEST("tm")}, 'uncovered') AS membrane_confidence, coalesce({_WEAKEST("place", "signal", "tm", "anchor")}, 'uncovered') AS secreted_confidence, {_WEAKEST("tm", "signal")} AS confidence,
coalesce(nullif(array_to_string(list_sort(list_distinct([place_source, signal_source, tm_source, anchor_source])), '+'), ''), 'none') AS secreted_sources FROM z"""


def _merged(t: Tables) -> DataFrame:
    calls = t.events.where("user_id is not null").select(*(F.expr(x).alias(n) for n, x in SAID.items()))
    return A.merge(calls.select("feature_id").distinct(), calls)


@query(_MERGED)
def merged_annotations(t: Tables) -> DataFrame:
    """Users as proteins, their events as calls of eight providers."""
    shown = "feature_id membrane tm_helices signal_peptide lipoprotein secreted surface_exposed localization membrane_source description description_source membrane_confidence secreted_confidence confidence secreted_sources"
    return _merged(t).select(*shown.split())


@query(f"""WITH m AS ({_MERGED}) SELECT measure, value, count(*) AS n FROM (SELECT unnest(['membrane', 'secreted', 'localization', 'membrane_confidence', 'secreted_confidence', 'membrane_source', 'confidence']) AS measure,
unnest([CAST(membrane AS VARCHAR), CAST(secreted AS VARCHAR), localization, membrane_confidence, secreted_confidence, coalesce(membrane_source, 'none'), coalesce(confidence, 'none')]) AS value FROM m) WHERE value IS NOT NULL GROUP BY 1, 2""")
def annotation_report(t: Tables) -> DataFrame:
    wanted = ("membrane", "secreted", "localization", "membrane_confidence", "secreted_confidence", "membrane_source", "confidence")
    return A.report(_merged(t)).where(F.col("measure").isin(*wanted))


# -- the graph -------------------------------------------------------------------------------


def _replies(rows: DataFrame, key: Column, order: list[Column], entry: Column, limit: int, wrapper: str | None = None, failed: Column | None = None) -> DataFrame:
    """Cached replies, one a key: its first ``limit`` rows as JSON, or a stored failure."""
    few = top_per_key(rows.withColumn("cache_key", key), ["cache_key"], order, limit)
    kept = few.groupBy("cache_key").agg(F.array_sort(F.collect_list(F.struct("place", entry.alias("e")))).alias("all"))
    listed = F.transform("all", lambda x: x["e"])
    body = F.to_json(F.struct(listed.alias(wrapper)) if wrapper else listed)
    return kept.select("cache_key", (F.when(failed, '{"_http_status": 503}').otherwise(body) if failed is not None else body).alias("payload_json"))


def _graph(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Customers as proteins, their orders as partners, nations as homologs, suppliers of a nation
    as targets, parts that they sold as compounds."""
    name = lambda kind, c: F.concat(F.lit(kind), F.col(c).cast("string"))
    proteins = t.customer.select(
        name("c", "c_custkey").alias("feature_id"), F.when(F.col("c_custkey") % 10 != 0, name("L", "c_custkey")).alias("locus_tag"), F.col("c_name").alias("product"),
        F.when(F.col("c_custkey") % 6 == 0, (F.col("c_custkey") % 100).cast("double")).alias("human_identity"), F.col("c_custkey").alias("pos"),
    )
    homologs = t.customer.select(
        name("c", "c_custkey").alias("feature_id"), name("N", "c_nationkey").alias("accession"), (F.col("c_acctbal") / 10000).alias("identity"), F.lit(None).cast("double").alias("coverage"),
        F.lit("").alias("organism"), F.lit("nation").alias("via"), F.lit("").alias("name"), F.lit(0).alias("pos"),
    )
    partner = F.struct(name("o", "o_orderkey").alias("stringId_B"), F.col("o_totalprice").alias("score"))
    partners = _replies(t.orders, name("L", "o_custkey"), [F.desc("o_totalprice"), F.col("o_orderkey")], partner, 12, failed=F.substring("cache_key", 2, 20).cast("long") % 13 == 0)
    component = F.when(F.col("s_suppkey") % 5 == 0, "X").otherwise(F.col("cache_key"))
    target = F.struct(name("S", "s_suppkey").alias("target_chembl_id"), F.col("s_name").alias("pref_name"), F.array(F.struct(component.alias("accession"))).alias("target_components"))
    targets = _replies(t.supplier, name("N", "s_nationkey"), [F.col("s_suppkey")], target, 8, "targets")
    activity = F.struct(name("M", "l_partkey").alias("molecule_chembl_id"), F.col("l_quantity").cast("string").alias("pchembl_value"))
    activities = _replies(t.lineitem, name("S", "l_suppkey"), [F.desc("l_extendedprice"), F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey")], activity, 12, "activities")
    return G.build(proteins, homologs, partners, targets, activities)


_GRAPH = """o AS (SELECT o_custkey, o_orderkey, o_totalprice FROM orders WHERE o_custkey % 10 <> 0 AND o_custkey % 13 <> 0 AND o_custkey IN (SELECT c_custkey FROM customer) QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) <= 10),
t AS (SELECT s_nationkey, s_suppkey FROM supplier WHERE s_nationkey IN (SELECT c_nationkey FROM customer) QUALIFY row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) <= 5), k AS (SELECT * FROM t WHERE s_suppkey % 5 <> 0),
a AS (SELECT l_suppkey, l_partkey, l_quantity FROM lineitem JOIN k ON s_suppkey = l_suppkey QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey) <= 10),
e AS (SELECT 'brc:c' || o_custkey AS source_id, 'string:o' || o_orderkey AS target_id, 'interacts_with' AS type, o_totalprice AS weight FROM o
UNION ALL SELECT 'brc:c' || c_custkey, 'uniprot:N' || c_nationkey, 'homolog_of', c_acctbal / 10000 FROM customer UNION ALL SELECT 'uniprot:N' || s_nationkey, 'chembl:S' || s_suppkey, 'represented_by', NULL FROM k
UNION ALL SELECT 'compound:M' || l_partkey, 'chembl:S' || l_suppkey, 'target_of', l_quantity FROM a
UNION ALL SELECT 'brc:c' || c_custkey, 'human:' || lower(replace(c_name, '#', '-')), 'homolog_of', c_custkey % 100 FROM customer WHERE c_custkey % 6 = 0 AND c_custkey % 100 <> 0)"""


@query(f"""WITH {_GRAPH} SELECT source_id, target_id, type, round(weight, 6) AS weight FROM e""")
def knowledge_graph(t: Tables) -> DataFrame:
    said = lambda field: F.get_json_object("evidence", f"$.{field}").cast("double")
    weight = F.coalesce(said("combined_score"), said("percent_identity"), said("pchembl_value"))
    return _graph(t)[1].select("source_id", "target_id", "type", F.round(weight, 6).alias("weight"))


@query(f"""WITH {_GRAPH}, i AS (SELECT source_id AS id FROM e UNION SELECT target_id FROM e UNION SELECT 'brc:c' || c_custkey FROM customer),
n AS (SELECT CASE WHEN id LIKE 'compound:%' THEN 'compound' WHEN id LIKE 'chembl:%' THEN 'chembl_target' ELSE 'protein' END AS type FROM i)
SELECT 'node' AS part, type, count(*) AS n FROM n GROUP BY 2 UNION ALL SELECT 'edge', type, count(*) FROM e GROUP BY 2 UNION ALL SELECT 'cap', unnest(['partners', 'targets', 'compounds']), unnest([10, 5, 10])""")
def graph_summary(t: Tables) -> DataFrame:
    nodes, edges, _ = _graph(t)
    return G.summary(nodes, edges)


@query(f"""WITH {_GRAPH} SELECT 'STRING' AS source, 'interaction_partners' AS step, 'c' || c_custkey AS key, CASE WHEN c_custkey IN (SELECT o_custkey FROM orders) THEN 'HTTP 503' ELSE 'no reply is kept' END AS error FROM customer
WHERE c_custkey % 10 <> 0 AND (c_custkey % 13 = 0 OR c_custkey NOT IN (SELECT o_custkey FROM orders))
UNION ALL SELECT 'ChEMBL', 'target', 'N' || c_nationkey, 'no reply is kept' FROM (SELECT DISTINCT c_nationkey FROM customer) WHERE c_nationkey NOT IN (SELECT s_nationkey FROM supplier)
UNION ALL SELECT 'ChEMBL', 'target', 'N' || s_nationkey, 'S' || s_suppkey || ' does not list N' || s_nationkey || ' as a component; the filter did not apply' FROM t WHERE s_suppkey % 5 = 0
UNION ALL SELECT 'ChEMBL', 'activity', 'S' || s_suppkey, 'no reply is kept' FROM k WHERE s_suppkey NOT IN (SELECT l_suppkey FROM lineitem)""")
def graph_failures(t: Tables) -> DataFrame:
    return _graph(t)[2]


# -- recorded runs ---------------------------------------------------------------------------

#: Parts as proteins of a finished run, some components as text: the same expressions in Spark and in SQL.
RECORDED = {
    "feature_id": "p_partkey", "product": "p_name", "rank": "p_partkey + 1", "score": "p_retailprice", "selected": "p_partkey % 4 = 0", "human_identity_pct": "CASE WHEN p_partkey % 3 = 0 THEN p_size + 0.25D0 END",
    "distinct_entries": "p_partkey % 6", "pdb_evidence": "CAST(p_size AS DOUBLE) / 50", "virulence_amr": "CASE WHEN p_type LIKE 'PROMO%' THEN 1.0D0 ELSE 0.5D0 END", "essential": "CASE WHEN p_partkey % 5 = 0 THEN 1.0D0 ELSE 0.0D0 END",
    "drug_target": "CASE p_partkey % 3 WHEN 0 THEN '1.0' WHEN 1 THEN 'n/a' ELSE '' END", "annotation_gap": "CASE WHEN p_partkey % 7 = 0 THEN 1.0D0 END", "surface_bonus": "0.0D0",
    "ligandable_homolog": "CASE WHEN p_brand = 'Brand#11' THEN 1.0D0 ELSE 0.0D0 END", "membrane_penalty": "CASE WHEN p_partkey % 4 = 1 THEN 1.0D0 ELSE 0.0D0 END", "human_homolog_penalty": "CAST(p_partkey % 50 AS DOUBLE) / 50",
}
_READ = f"SELECT {', '.join(f'{x.replace("D0", "::DOUBLE")} AS {n}' for n, x in RECORDED.items())} FROM part"


def _rescored_sql(profile: Profile, n: int) -> str:
    parts = " + ".join(f"coalesce(TRY_CAST({c} AS DOUBLE), 0.0) * ({w!r}::DOUBLE)" for c, w in profile.weights.items())
    barred = "coalesce(human_identity_pct >= 40, FALSE)" if profile.disqualify_human_homologs else "FALSE"
    return f"""r AS ({_READ}), s AS (SELECT *, round({parts}, 6) AS new_score, {barred} AS barred FROM r), k AS (SELECT *, row_number() OVER w AS new_rank, sum(CASE WHEN barred THEN 0 ELSE 1 END) OVER (w ROWS UNBOUNDED PRECEDING) AS taken
FROM s WINDOW w AS (ORDER BY new_score DESC, pdb_evidence DESC, distinct_entries DESC, feature_id)), z AS (SELECT *, NOT barred AND taken <= {n} AS chosen FROM k)"""


def _recorded(t: Tables) -> DataFrame:
    return t.part.select(*(F.expr(x.replace("D0", "D")).alias(n) for n, x in RECORDED.items()))


@query(f"""WITH {_rescored_sql(PROFILES["bacterial-target"], 80)} SELECT new_rank AS rank, feature_id, new_score AS score, chosen AS selected, rank AS original_rank,
CASE WHEN barred THEN printf('human homolog %.1f%% identity', human_identity_pct) ELSE '' END AS disqualified FROM z""")
def rescored_run(t: Tables) -> DataFrame:
    return R.rescore(_recorded(t), PROFILES["bacterial-target"], 80).select("rank", "feature_id", "score", "selected", "original_rank", "disqualified")


@query(f"""WITH {_rescored_sql(PROFILES["evidence-only"], 80)} SELECT unnest(['proteins', 'selected', 'selected_before', 'overlap', 'entered', 'left', 'disqualified', 'moved', 'furthest']) AS name, unnest([count(*), count(*) FILTER (WHERE chosen), count(*) FILTER (WHERE selected),
count(*) FILTER (WHERE chosen AND selected), count(*) FILTER (WHERE chosen AND NOT selected), count(*) FILTER (WHERE selected AND NOT chosen), count(*) FILTER (WHERE barred), count(*) FILTER (WHERE new_rank <> rank), max(abs(new_rank - rank))])::DOUBLE AS value FROM z
UNION ALL SELECT unnest({["top_n", "disqualify_human_homologs", *(f"weight:{c}" for c in PROFILES["evidence-only"].weights)]}), unnest({[80.0, 0.0, *map(float, PROFILES["evidence-only"].weights.values())]})::DOUBLE""")
def rescore_manifest(t: Tables) -> DataFrame:
    profile = PROFILES["evidence-only"]
    return R.manifest(R.rescore(_recorded(t), profile, 80), profile, 80)
