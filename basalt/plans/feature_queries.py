"""The triage and the feature operators bound to the benchmark tables, with their SQL.

The tables are shaped into the inputs of the operators first, by the same expressions on both
sides: customers are proteins, orders are hits, events are specialty rows and provider calls."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basalt.functions import rules as R
from basalt.functions import scalar as S
from basalt.operators import features as X
from basalt.operators import organisms as O
from basalt.plans import scoring as C
from basalt.plans import sites as Y
from basalt.plans import structures as P
from basalt.plans import triage as G
from basalt.plans.queries import Tables, query

#: Expressions that Spark and DuckDB read alike.
PROTEIN = {
    "feature_id": "c_custkey",
    "product": "CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'hypothetical protein' WHEN 'MACHINERY' THEN 'outer membrane adhesin' WHEN 'BUILDING' THEN 'toxin of the secretion system' "
    "WHEN 'AUTOMOBILE' THEN 'two-component response regulator' ELSE 'DNA gyrase' END",
    "gene": "CASE WHEN c_custkey % 4 = 0 THEN 'gyrA' ELSE ' ' END",
    "length": "c_custkey * 13 % 900 + 50",
    "pos": "c_custkey",
}
SPECIALTY = {
    "feature_id": "event_id % 1500",
    "property": "CASE event_id % 7 WHEN 0 THEN 'Virulence Factor' WHEN 1 THEN 'Antibiotic Resistance' WHEN 2 THEN 'Essential Gene' WHEN 3 THEN 'Drug Target' WHEN 4 THEN 'Transporter' "
    "WHEN 5 THEN 'Human Homolog' ELSE 'Metal Resistance' END",
    "classification": "CASE event_id % 5 WHEN 0 THEN 'Antibiotic efflux pump' WHEN 1 THEN 'antibiotic target in susceptible species' WHEN 2 THEN 'Adherence' WHEN 3 THEN '' END",
    "identity": "CAST(value AS VARCHAR(20))",
}
HIT = {
    "feature_id": "o_custkey", "pos": "o_orderkey", "bitscore": "o_totalprice", "identity": "(o_orderkey * 7 % 100) / 100.0D0", "query_coverage": "(o_orderkey % 100) / 100.0D0",
    "evalue": "CASE WHEN o_orderstatus = 'F' THEN 1.0D0 ELSE 1.0D-30 END", "resolution": "1.0D0 + (o_orderkey % 40) / 10.0D0",
    "method": "CASE substring(o_orderpriority, 1, 1) WHEN '1' THEN 'X-RAY DIFFRACTION' WHEN '2' THEN 'SOLUTION NMR' WHEN '3' THEN 'Electron Microscopy' END",
    "has_ligand": "o_orderkey % 3 = 0", "has_partner": "o_orderkey % 5 = 0", "has_annotation": "o_orderkey % 2 = 0", "entry_id": "o_orderkey % 97",
}
CALL = {
    "feature_id": "event_id % 1500", "pos": "event_id",
    "flag": "CASE event_id % 4 WHEN 0 THEN 'membrane' WHEN 1 THEN 'signal' WHEN 2 THEN 'surface' ELSE 'secreted' END",
    "value": "CASE WHEN event_id % 9 <> 0 THEN event_id % 2 = 0 END",
    "source": "CASE event_id % 5 WHEN 0 THEN 'heuristic' WHEN 1 THEN 'deeptmhmm' WHEN 2 THEN 'psortb' WHEN 3 THEN 'uniprot_experimental' ELSE 'signalp' END",
}


def _shaped(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.select(*(F.expr(x.replace("D0", "D").replace("D-30", "E-30D")).alias(n) for n, x in columns.items()))


def _sql(table: str, columns: dict[str, str]) -> str:
    return f"SELECT {', '.join(f'{x.replace("0D0", "0::DOUBLE").replace("1.0D-30", "1e-30::DOUBLE")} AS {n}' for n, x in columns.items())} FROM {table}"


def proteins(t: Tables) -> DataFrame:
    return _shaped(t.customer, PROTEIN)


def specialty(t: Tables) -> DataFrame:
    return _shaped(t.events, SPECIALTY)


def hits(t: Tables) -> DataFrame:
    ligands = F.when(F.col("has_ligand"), F.array(F.lit("ATP"))).otherwise(F.array().cast("array<string>"))
    return _shaped(t.orders, HIT).withColumn("ligands", ligands)


_FLAGS = f"""flags AS (SELECT feature_id, bool_or(name IN ('virulence factor', 'virulance factor')) AS virulence, bool_or(name = 'essential gene') AS essential,
bool_or(name = 'drug target') OR bool_or(name = 'antibiotic resistance' AND said LIKE '%antibiotic target in susceptible species%' AND NOT mechanism) AS drug_target,
bool_or(name = 'transporter') AS transporter, bool_or(name = 'metal resistance') AS metal_resistance,
max(CASE WHEN name = 'human homolog' THEN TRY_CAST(identity AS DOUBLE) END) AS human_identity_pct,
CASE WHEN max(CASE WHEN name = 'antibiotic resistance' THEN CAST(mechanism AS INTEGER) END) = 1 THEN 1.0
WHEN min(CASE WHEN name = 'antibiotic resistance' THEN CAST(said LIKE '%antibiotic target in susceptible species%' AND NOT mechanism AS INTEGER) END) = 1 THEN 0.0
WHEN count(*) FILTER (WHERE name = 'antibiotic resistance') > 0 THEN 0.5 ELSE 0.0 END::DOUBLE AS amr_value,
list_sort(list_distinct(list(CASE name WHEN 'virulence factor' THEN 'virulence' WHEN 'antibiotic resistance' THEN 'amr' WHEN 'essential gene' THEN 'essential' WHEN 'drug target' THEN 'drug_target'
WHEN 'transporter' THEN 'transporter' WHEN 'human homolog' THEN 'human_homolog' ELSE name END))) AS types
FROM (SELECT *, said LIKE '%antibiotic efflux%' AS mechanism FROM (SELECT *, lower(property) AS name, lower(coalesce(classification, '')) AS said FROM ({_sql("events", SPECIALTY)}))) GROUP BY 1)"""
_HITS = f"""hits AS (SELECT *, evalue <= 1e-5 AND query_coverage >= 0.5 AS qualifies FROM ({_sql("orders", HIT)})),
scored AS (SELECT *, CASE WHEN qualifies THEN identity * query_coverage * (CASE WHEN method = 'SOLUTION NMR' THEN 0.7 WHEN method IS NULL THEN 0.6 WHEN resolution <= 2.5 THEN 1.0
WHEN resolution <= 3.5 THEN 0.8 ELSE 0.6 END)::DOUBLE + (CASE WHEN has_ligand THEN 0.10 ELSE 0.0 END::DOUBLE + CASE WHEN has_partner THEN 0.05 ELSE 0.0 END::DOUBLE
+ CASE WHEN has_annotation THEN 0.05 ELSE 0.0 END::DOUBLE) ELSE 0.0 END AS hit_score FROM hits),
best AS (SELECT feature_id, pos, hit_score, has_ligand, has_partner, count(*) OVER f AS qualifying_hits FROM scored WHERE qualifies
WINDOW f AS (PARTITION BY feature_id) QUALIFY row_number() OVER (PARTITION BY feature_id ORDER BY hit_score DESC, bitscore DESC, pos) = 1),
entries AS (SELECT feature_id, count(DISTINCT entry_id) AS distinct_entries FROM scored WHERE qualifies GROUP BY 1)"""
_RANKS = "CASE source WHEN 'uniprot_experimental' THEN 60 WHEN 'deeptmhmm' THEN 50 WHEN 'signalp' THEN 50 WHEN 'psortb' THEN 45 ELSE 10 END"
_CALLS = f"""won AS (SELECT *, {_RANKS} AS source_rank FROM ({_sql("events", CALL)}) WHERE value IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY feature_id, flag ORDER BY {_RANKS} DESC, pos) = 1),
calls AS (SELECT feature_id, {", ".join(f"max(CASE WHEN flag = '{f}' THEN CAST(value AS INTEGER) END) = 1 AS {f}_value, max(CASE WHEN flag = '{f}' THEN source END) AS {f}_source" for f in ("membrane", "signal", "surface", "secreted"))},
min(source_rank) AS weakest_rank FROM won GROUP BY 1),
annotation AS (SELECT *, CASE WHEN coalesce(surface_source, secreted_source, signal_source) IS NOT NULL THEN coalesce(surface_value, FALSE) OR coalesce(secreted_value, FALSE) END AS exposed FROM calls)"""


# -- the triage ------------------------------------------------------------------------------


@query(f"WITH {_FLAGS} SELECT * REPLACE (array_to_string(types, ',') AS types) FROM flags")
def specialty_flags(t: Tables) -> DataFrame:
    return G.specialty_flags(specialty(t)).withColumn("types", F.array_join("types", ","))


@query(f"WITH {_HITS} SELECT feature_id, pos, round(hit_score, 9) AS hit_score, qualifying_hits, distinct_entries FROM best JOIN entries USING (feature_id)")
def scored_best_hits(t: Tables) -> DataFrame:
    return G.best_hits(G.scored_hits(hits(t))).select("feature_id", "pos", F.round("hit_score", 9).alias("hit_score"), "qualifying_hits", "distinct_entries")


@query(f"WITH {_CALLS} SELECT * FROM annotation")
def merged_calls(t: Tables) -> DataFrame:
    return G.merge_calls(_shaped(t.events, CALL))


_TRIAGE = f"""WITH {_FLAGS}, {_HITS}, {_CALLS}, p AS ({_sql("customer", PROTEIN)}),
parts AS (SELECT p.feature_id, round(coalesce(hit_score, 0.0) / (1.0::DOUBLE + 0.10::DOUBLE + 0.05::DOUBLE + 0.05::DOUBLE), 6) AS pdb_evidence,
greatest(CASE WHEN virulence THEN 1.0 ELSE 0.0 END, coalesce(amr_value, 0.0))::DOUBLE AS virulence_amr, CASE WHEN essential THEN 1.0 ELSE 0.0 END::DOUBLE AS essential_part,
CASE WHEN drug_target THEN 1.0 ELSE 0.0 END::DOUBLE AS drug_part, CASE WHEN product LIKE 'hypothetical%' THEN 1.0 ELSE 0.0 END::DOUBLE AS gap,
CASE WHEN exposed THEN 1.0 ELSE 0.0 END::DOUBLE AS surface, CASE WHEN has_ligand AND NOT has_partner THEN 1.0 ELSE 0.0 END::DOUBLE AS ligandable,
CASE WHEN membrane_value THEN 1.0 ELSE 0.0 END::DOUBLE AS membrane, round(coalesce(human_identity_pct, 0.0) / 100, 6) AS human, coalesce(distinct_entries, 0) AS distinct_entries,
coalesce(human_identity_pct >= 40, FALSE) AS disqualified FROM p LEFT JOIN flags USING (feature_id) LEFT JOIN best USING (feature_id) LEFT JOIN entries USING (feature_id) LEFT JOIN annotation USING (feature_id)),
totals AS (SELECT *, round(pdb_evidence * 0.40::DOUBLE + virulence_amr * 0.20::DOUBLE + essential_part * 0.15::DOUBLE + drug_part * 0.15::DOUBLE + gap * 0.30::DOUBLE + surface * 0.10::DOUBLE
+ ligandable * 0.10::DOUBLE - membrane * 0.15::DOUBLE - human * 0.25::DOUBLE, 6) AS score FROM parts),
ranked AS (SELECT *, row_number() OVER w AS rank, sum(CASE WHEN disqualified THEN 0 ELSE 1 END) OVER (w ROWS UNBOUNDED PRECEDING) AS taken FROM totals
WINDOW w AS (ORDER BY score DESC, pdb_evidence DESC, distinct_entries DESC, feature_id))"""


@query(_TRIAGE + " SELECT feature_id, score, pdb_evidence, virulence_amr, distinct_entries, disqualified, rank, NOT disqualified AND taken <= 100 AS selected FROM ranked")
def triage_proteins(t: Tables) -> DataFrame:
    best = G.best_hits(G.scored_hits(hits(t)))
    parts = G.components(proteins(t), G.specialty_flags(specialty(t)), best, G.merge_calls(_shaped(t.events, CALL)))
    out = G.triage(parts, 100)
    return out.select("feature_id", "score", "pdb_evidence", "virulence_amr", "distinct_entries", "disqualified", "rank", "selected")


@query(_TRIAGE + " SELECT feature_id, rank FROM ranked WHERE NOT disqualified AND taken <= 20 ORDER BY rank LIMIT 15")
def view_of_selected(t: Tables) -> DataFrame:
    parts = G.components(proteins(t), G.specialty_flags(specialty(t)), G.best_hits(G.scored_hits(hits(t))), G.merge_calls(_shaped(t.events, CALL)))
    return X.view_top(G.triage(parts, 20), 15).select("feature_id", "rank")


_CATEGORIES = """CASE product WHEN 'outer membrane adhesin' THEN ['adhesion'] WHEN 'toxin of the secretion system' THEN ['secretion', 'toxin'] ELSE [] END"""


@query(f"""WITH {_FLAGS}, p AS ({_sql("customer", PROTEIN)}), points AS (SELECT feature_id, length, pos, list_filter([
CASE WHEN list_contains(types, 'virulence') THEN 'virulence' END, CASE WHEN list_contains(types, 'amr') THEN 'amr' END, CASE WHEN list_contains(types, 'drug_target') THEN 'drug_target' END,
CASE WHEN list_contains(types, 'essential') THEN 'essential' END, CASE WHEN list_contains(types, 'transporter') THEN 'transporter' END, CASE WHEN len({_CATEGORIES}) > 0 THEN 'mechanism' END,
CASE WHEN product LIKE '%membrane%' THEN 'surface' END, CASE WHEN trim(gene) <> '' THEN 'named_gene' END, CASE WHEN list_contains(types, 'human_homolog') THEN 'human_homolog' END], lambda x: x IS NOT NULL) AS r,
len({_CATEGORIES}) > 0 OR list_has_any(coalesce(types, []), ['virulence', 'amr', 'drug_target']) AS eligible FROM p LEFT JOIN flags USING (feature_id)),
summed AS (SELECT *, coalesce(list_sum(list_transform(r, lambda x: CASE x WHEN 'virulence' THEN 3 WHEN 'drug_target' THEN 3 WHEN 'human_homolog' THEN -2 WHEN 'amr' THEN 2 WHEN 'essential' THEN 2 WHEN 'mechanism' THEN 2 ELSE 1 END)), 0) AS priority FROM points)
SELECT feature_id, CAST(priority AS INTEGER) AS priority, array_to_string(r, ',') AS reasons, row_number() OVER (ORDER BY priority DESC, length DESC, pos) AS rank, eligible AS selected FROM summed""")
def feature_priorities(t: Tables) -> DataFrame:
    out = G.priorities(proteins(t), G.specialty_flags(specialty(t)), R.mechanisms(F.col("product")))
    return out.select("feature_id", "priority", F.array_join(F.transform("breakdown", lambda x: x["reason"]), ",").alias("reasons"), "rank", "selected")


@query(f"""WITH {_FLAGS}, c AS (SELECT feature_id, bool_or(property = 'Virulence Factor') AS v, bool_or(classification = 'Adherence') AS a FROM ({_sql("events", SPECIALTY)}) GROUP BY 1)
SELECT feature_id, array_to_string(list_filter([CASE WHEN product = 'outer membrane adhesin' OR a THEN 'adhesion' END, CASE WHEN product LIKE 'toxin%' THEN 'secretion' END,
CASE WHEN product LIKE 'toxin%' THEN 'toxin' END, CASE WHEN v AND product LIKE 'two-component%' THEN 'regulation' END], lambda x: x IS NOT NULL), ',') AS mechanisms,
product LIKE '%adhesin%' OR product LIKE 'toxin%' AS pathogenesis, product NOT LIKE 'hypothetical%' AS informative FROM ({_sql("customer", PROTEIN)}) p LEFT JOIN c USING (feature_id)""")
def protein_mechanisms(t: Tables) -> DataFrame:
    index = X.specialty_index(specialty(t), S.specialty_type(F.col("property")))
    joined = proteins(t).join(index, "feature_id", "left")
    found = R.mechanisms(F.col("product"), F.col("classes"), F.array_contains("types", "virulence"))
    return joined.select("feature_id", F.array_join(found, ",").alias("mechanisms"), R.acts_in_pathogenesis(F.col("product")).alias("pathogenesis"), R.informative(F.col("product")).alias("informative"))


# -- structures ------------------------------------------------------------------------------

_CHOICE = {
    "feature_id": "p_partkey", "best_entity": "CASE WHEN p_size % 3 = 0 THEN concat('E', p_size % 5) END", "holo_entity": "CASE WHEN p_size % 2 = 0 THEN concat('E', p_size % 4) END",
    "model_id": "CASE WHEN p_size % 5 = 1 THEN p_brand END", "model_ref": "CASE WHEN p_size % 11 = 0 THEN p_type END",
}


@query(f"""SELECT feature_id, CASE WHEN best_entity IS NOT NULL THEN 'pdb' WHEN model_id IS NOT NULL THEN 'afdb' WHEN feature_id % 7 = 0 THEN 'pdb' WHEN model_ref IS NOT NULL THEN 'afdb' END AS source,
CASE WHEN best_entity IS NOT NULL THEN coalesce(holo_entity, best_entity) WHEN model_id IS NOT NULL THEN model_id WHEN feature_id % 7 = 0 THEN 'R1' ELSE model_ref END AS accession,
coalesce(holo_entity <> best_entity, FALSE) AS swapped, CASE WHEN coalesce(best_entity, model_id, model_ref) IS NULL AND feature_id % 7 <> 0 THEN 'prediction_required' ELSE 'collected' END AS status
FROM ({_sql("part", _CHOICE)})""")
def structure_choice(t: Tables) -> DataFrame:
    refs = F.when(F.col("feature_id") % 7 == 0, F.array(F.lit("R1"), F.lit("R2"))).otherwise(F.array().cast("array<string>"))
    out = P.choose(_shaped(t.part, _CHOICE).withColumn("pdb_refs", refs))
    return out.select("feature_id", "choice.source", "choice.accession", F.coalesce("swapped", F.lit(False)).alias("swapped"), "status")


_GATE = {
    "pos": "o_orderkey", "source": "CASE WHEN o_orderkey % 3 = 0 THEN 'afdb' ELSE 'pdb' END", "identity": "(o_orderkey % 60) / 100.0D0", "coverage": "(o_orderkey % 100) / 100.0D0",
    "resolution": "1.0D0 + (o_orderkey % 40) / 10.0D0", "method": "CASE WHEN o_orderkey % 4 = 1 THEN 'Solution NMR' END", "mean_plddt": "CASE WHEN o_orderkey % 7 <> 0 THEN (o_orderkey % 100) * 1.0D0 END",
}


@query(f"""SELECT pos, passed, CASE WHEN passed THEN '' WHEN source = 'pdb' THEN array_to_string(list_filter([CASE WHEN identity < 0.25 THEN 'identity >= fails' END,
CASE WHEN coverage < 0.5 THEN 'coverage >= fails' END, CASE WHEN method IS NULL AND resolution > 3.5 THEN 'resolution <= fails' END], lambda x: x IS NOT NULL), '; ')
ELSE array_to_string(list_filter([CASE WHEN coalesce(mean_plddt, 0) < 70 THEN 'mean_plddt >= fails' END, CASE WHEN coverage < 0.8 THEN 'coverage >= fails' END], lambda x: x IS NOT NULL), '; ') END AS reasons
FROM (SELECT *, CASE WHEN source = 'pdb' THEN identity >= 0.25 AND coverage >= 0.5 AND (method IS NOT NULL OR resolution <= 3.5) ELSE coalesce(mean_plddt >= 70, FALSE) AND coverage >= 0.8 END AS passed FROM ({_sql("orders", _GATE)}))""")
def structure_gate(t: Tables) -> DataFrame:
    return P.gate(_shaped(t.orders, _GATE)).select("pos", "passed", "reasons")


#: Atoms, templates and chains out of the embeddings, for Spark and DuckDB alike: labels are structures.
_ATOM = {
    "structure": "CAST(label AS VARCHAR(20))", "pos": "vec_id", "group_PDB": "CASE WHEN vec_id % 6 = 0 THEN 'HETATM' ELSE 'ATOM' END",
    "component": "CASE WHEN vec_id % 6 <> 0 THEN 'ALA' WHEN vec_id % 12 = 0 THEN 'ATP' WHEN vec_id % 18 = 0 THEN 'MG' ELSE 'HOH' END", "chain": "CASE vec_id % 5 WHEN 0 THEN 'B' WHEN 1 THEN 'C' ELSE 'A' END",
    "seq_id": "CAST(vec_id AS INTEGER)", "auth_seq_id": "CAST(vec_id AS VARCHAR(20))", "auth_chain": "CASE WHEN vec_id % 5 = 1 THEN 'X' END", "b": "(vec_id * 37 % 60) * 1.0D0 + 40.0D0",
}
_KINDS = {
    "structure": "CAST(label AS VARCHAR(20))", "accession": "CASE WHEN label % 7 = 3 THEN 'AF-1' ELSE concat('e', label, '_9') END", "source": "CASE WHEN label % 2 = 0 THEN 'afdb' ELSE 'pdb' END",
    "template": "CASE WHEN label % 7 <> 5 THEN concat('E', label, '_', 1 + label % 2) END",
}
_SITES = f"""a AS (SELECT * FROM (SELECT {", ".join(f"{x.replace('1.0D0', '1.0::DOUBLE').replace('40.0D0', '40.0::DOUBLE')} AS {n}" for n, x in _ATOM.items())}, label, embedding[1]::DOUBLE * 50 AS x, embedding[2]::DOUBLE * 50 AS y, embedding[3]::DOUBLE * 50 AS z FROM embeddings)),
t AS (SELECT DISTINCT label, {", ".join(f"{x} AS {n}" for n, x in _KINDS.items())} FROM embeddings), w AS (SELECT structure, label, source FROM t WHERE label % 7 NOT IN (3, 5)),
h AS (SELECT a.* FROM a JOIN w USING (label) WHERE group_PDB = 'HETATM' AND (component = 'ATP' OR component = 'MG' AND label % 3 <> 0)),
p AS (SELECT a.* FROM a JOIN w USING (label) WHERE group_PDB = 'ATOM' AND (label % 2 = 0 OR chain IN ('A', 'B'))),
n AS (SELECT h.label, h.pos AS copy, h.component, h.chain AS c, p.pos, p.b, sqrt((p.x - h.x) ** 2 + (p.y - h.y) ** 2 + (p.z - h.z) ** 2) AS distance FROM h JOIN p ON p.label = h.label AND sqrt((p.x - h.x) ** 2 + (p.y - h.y) ** 2 + (p.z - h.z) ** 2) <= 4.5),
s AS (SELECT label, copy, component, c, count(*) AS n_residues, avg(b) AS mean_b, round(min(distance), 2) AS nearest, string_agg(CAST(pos AS VARCHAR), ',' ORDER BY coalesce(CASE WHEN pos % 5 = 1 THEN 'X' END, CASE pos % 5 WHEN 0 THEN 'B' ELSE 'A' END), pos) AS lining FROM n GROUP BY 1, 2, 3, 4 HAVING count(*) >= 3),
sites AS (SELECT w.structure, component || '_' || c || copy AS site, row_number() OVER (PARTITION BY w.structure ORDER BY component <> 'ATP', n_residues DESC, copy)::INTEGER AS rank, n_residues, nearest, lining,
component = 'MG' OR label IN (SELECT label FROM h WHERE component = 'MG') AS cofactor_required, NOT (source = 'afdb' AND mean_b < 70) AS usable FROM s JOIN w USING (label))"""


def _sites(t: Tables) -> tuple[DataFrame, DataFrame]:
    at = [(F.col("embedding")[i].cast("double") * 50).alias(c) for i, c in enumerate("xyz")]
    atoms = t.embeddings.select(*(F.expr(x.replace("D0", "D")).alias(n) for n, x in _ATOM.items()), *at)
    metals = F.when(F.col("label") % 3 != 0, F.array(F.lit("mg"))).otherwise(F.array().cast("array<string>"))
    templates = t.embeddings.select("label", *(F.expr(x).alias(n) for n, x in _KINDS.items())).distinct().select(*_KINDS, F.array(F.lit("atp")).alias("ligands"), metals.alias("metals"))
    chains = t.embeddings.where("label % 2 = 1").select(F.col("label").cast("string").alias("structure"), F.lit("2").alias("entity"), F.explode(F.array(F.lit("A"), F.lit("B"))).alias("chain")).distinct()
    return templates, Y.holo_sites(atoms, templates, chains)


@query(f"WITH {_SITES} SELECT * FROM sites")
def holo_sites(t: Tables) -> DataFrame:
    _, sites = _sites(t)
    lining = F.array_join(F.transform("residues", lambda r: r["auth"]), ",")
    nearest = F.array_min(F.transform("residues", lambda r: r["distance"]))
    return sites.select("structure", "site", "rank", "n_residues", nearest.alias("nearest"), lining.alias("lining"), "cofactor_required", "usable")


@query(f"""WITH {_SITES}, c AS (SELECT structure, count(*) AS sites, count(*) FILTER (WHERE usable) AS usable FROM sites GROUP BY 1)
SELECT t.structure, CASE WHEN sites IS NULL THEN 'no_pocket' WHEN c.usable > 0 THEN 'ok' ELSE 'all_rejected' END AS status, coalesce(sites, 0) AS sites, coalesce(c.usable, 0) AS usable, label % 7 NOT IN (3, 5) AS template_is_structure,
CASE WHEN sites > 0 THEN '' WHEN label % 7 = 5 THEN 'no qualifying homolog binds a ligand or metal; a pocket detector is needed and none ran' WHEN label % 7 = 3 THEN 'the binding site is in ' || template || ', not in the collected structure; transferring it needs a superposition'
ELSE 'no residue of our entity lines ATP' || CASE WHEN label % 3 <> 0 THEN ', MG' ELSE '' END END AS reason FROM t LEFT JOIN c USING (structure)""")
def site_status(t: Tables) -> DataFrame:
    return Y.site_status(*_sites(t))


# -- joins of feature tables -----------------------------------------------------------------


@query("""SELECT feature_id, array_to_string(list_sort(list(DISTINCT printf('%03d:%s', l_suppkey, l_returnflag))), ',') AS bindings
FROM (SELECT DISTINCT l_partkey AS feature_id, l_suppkey, l_returnflag FROM lineitem) GROUP BY 1""")
def role_bindings(t: Tables) -> DataFrame:
    roles = t.lineitem.groupBy("l_suppkey", "l_returnflag").agg(F.collect_set("l_partkey").alias("features"))
    nested = roles.groupBy("l_suppkey").agg(F.collect_list(F.struct(F.col("l_returnflag").alias("role_id"), "features")).alias("role_bindings"))
    out = X.role_bindings(nested.select(F.format_string("%03d", "l_suppkey").alias("name"), F.array(F.lit("c")).alias("classification"), "role_bindings"))
    # The texts have an order of their own: 1000:A comes before 100:A.
    texts = F.array_sort(F.transform("bindings", lambda x: F.concat(x["name"], F.lit(":"), x["role"])))
    return out.select("feature_id", F.array_join(texts, ",").alias("bindings"))


@query(f"""SELECT p.feature_id, count(s.feature_id) AS n, max(TRY_CAST(s.identity AS DOUBLE)) AS most, any_value(k.c) AS hit_count
FROM ({_sql("customer", PROTEIN)}) p LEFT JOIN ({_sql("events", SPECIALTY)}) s USING (feature_id)
LEFT JOIN (SELECT o_custkey, count(*) AS c FROM orders GROUP BY 1) k ON o_custkey = p.feature_id GROUP BY 1""")
def specialty_arrays(t: Tables) -> DataFrame:
    rows = specialty(t).withColumns({"evidence": F.lit("BLAT"), "query_coverage": F.lit("90")})
    kmers = t.orders.groupBy(F.col("o_custkey").alias("feature_id")).agg(F.count("*").alias("hit_count"))
    out = X.specialty_arrays(proteins(t).select("feature_id"), rows, kmers)
    return out.select("feature_id", F.size("specialty").cast("long").alias("n"), F.array_max(F.transform("specialty", lambda x: x["identity"])).alias("most"), "kmer.hit_count")


@query("""SELECT p_partkey, lower(p_brand) AS entity, coalesce(s_name, p_name) AS title, s_acctbal AS year FROM part LEFT JOIN (SELECT concat('BRAND#', s_suppkey) AS e,
CASE WHEN s_suppkey % 2 = 0 THEN s_name END AS s_name, s_acctbal FROM supplier WHERE s_suppkey < 20) ON e = upper(p_brand)""")
def metadata_overwrite(t: Tables) -> DataFrame:
    rows = t.part.select("p_partkey", F.lower("p_brand").alias("entity"), F.col("p_name").alias("title"))
    name = F.when(F.col("s_suppkey") % 2 == 0, F.col("s_name"))
    known = t.supplier.where("s_suppkey < 20").select(F.concat(F.lit("brand#"), "s_suppkey").alias("entity"), name.alias("title"), F.col("s_acctbal").alias("year"))
    return X.overwrite_known(rows, "entity", known)


@query("""WITH r AS (SELECT user_id, event_id, event_type, event_id % 4 AS taxon, user_id % 4 AS wanted FROM events WHERE event_type IN ('click', 'view') AND event_id % 3 <> 0)
SELECT user_id, event_id AS accession, count(*) OVER (PARTITION BY user_id) AS candidates FROM r
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY CASE WHEN taxon = wanted THEN 0 ELSE 1 END, CASE WHEN event_type = 'click' THEN 0 ELSE 1 END, event_id) = 1""")
def accession_choice(t: Tables) -> DataFrame:
    database = F.when(F.col("event_type") == "click", "UniProtKB/Swiss-Prot").when(F.col("event_type") == "view", "UniProtKB/TrEMBL").otherwise("PATRIC")
    refs = t.events.select("user_id", F.col("event_id").alias("accession"), database.alias("database"), (F.col("event_id") % 3 != 0).alias("active"), (F.col("event_id") % 4).alias("taxon"), (F.col("user_id") % 4).alias("wanted_taxon"), F.col("event_id").alias("pos"))
    return X.choose_accession(refs, "user_id")


@query("""SELECT o_orderkey AS feature_id, md5(CAST(o_custkey AS VARCHAR)) AS md5, c_name AS sequence FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderstatus = 'F'""")
def essential_sequences(t: Tables) -> DataFrame:
    checksum = lambda c: F.md5(F.col(c).cast("string").cast("binary"))
    features = t.orders.select(F.col("o_orderkey").alias("feature_id"), checksum("o_custkey").alias("md5"))
    sequences = t.customer.select(checksum("c_custkey").alias("md5"), F.col("c_name").alias("sequence"))
    out = X.sequences_by_checksum(t.orders.where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("feature_id")), features, sequences.unionByName(sequences))
    return out.select("feature_id", "md5", "sequence")


@query("""WITH k AS (SELECT lower(p_name) AS name, min(p_partkey) AS note FROM part WHERE p_partkey % 10 = 0 GROUP BY 1 UNION ALL SELECT 'red', -1 UNION ALL SELECT 'small', -2)
SELECT p_partkey, p_name, coalesce(a.note, b.note) AS note, CASE WHEN a.name IS NOT NULL THEN 'species' WHEN b.name IS NOT NULL THEN 'genus' END AS hint
FROM part LEFT JOIN k a ON a.name = lower(p_name) LEFT JOIN k b ON b.name = lower(split_part(p_name, ' ', 1))""")
def knowledge_by_hint(t: Tables) -> DataFrame:
    species = t.part.where("p_partkey % 10 = 0").groupBy(F.lower("p_name").alias("name")).agg(F.min("p_partkey").cast("long").alias("note"))
    genera = t.region.select("r_regionkey").limit(1).select(F.explode(F.array(F.struct(F.lit("red").alias("name"), F.lit(-1).cast("long").alias("note")), F.struct(F.lit("small").alias("name"), F.lit(-2).cast("long").alias("note")))).alias("x")).select("x.*")
    return X.lookup_by_hint(t.part.select("p_partkey", "p_name"), "p_name", species.unionByName(genera), ["note"])


@query("SELECT o_orderkey, o_custkey % 5 IN (o_orderkey % 5, o_orderkey % 3) AS verified FROM orders")
def verified_targets(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", (F.col("o_custkey") % 5).alias("accession"), F.array(F.col("o_orderkey") % 5, F.col("o_orderkey") % 3).alias("components"))
    return X.verified_targets(rows).select("o_orderkey", "verified")


_WORD = lambda c, k: f"regexp_replace(lower(split_part({c}, ' ', {k})), '[.,]+$', '')"
_STEM = f"CAST(greatest(6, ceil(0.75 * least(length({_WORD('q.query', 1)}), length({_WORD('g.name', 1)})))) AS BIGINT)"


@query(f"""WITH g AS (SELECT name, count(*) AS n FROM (SELECT coalesce(CASE WHEN p_partkey % 2 = 0 THEN p_type END, p_name || p_brand) AS genome, p_name || p_brand AS name FROM part
QUALIFY row_number() OVER (PARTITION BY coalesce(CASE WHEN p_partkey % 2 = 0 THEN p_type END, p_name || p_brand) ORDER BY p_partkey) = 1) GROUP BY 1),
q AS (SELECT DISTINCT CASE WHEN p_size = 1 THEN ' ' ELSE replace(p_name, 'medium', 'mediumx') END AS query FROM part), m AS (SELECT q.query, g.n, {_WORD("q.query", 2)} = {_WORD("g.name", 2)} AS one FROM q, g
WHERE {_WORD("q.query", 1)} = {_WORD("g.name", 1)} AND {_WORD("q.query", 1)} <> '' OR (least(length({_WORD("q.query", 1)}), length({_WORD("g.name", 1)})) >= {_STEM} AND left({_WORD("q.query", 1)}, {_STEM}) = left({_WORD("g.name", 1)}, {_STEM})))
SELECT query, query <> ' ' AS measured, CASE WHEN query <> ' ' THEN (SELECT sum(n) FROM g)::BIGINT END AS genomes, CASE WHEN query <> ' ' THEN coalesce(sum(n) FILTER (WHERE one), 0)::BIGINT END AS same_species,
CASE WHEN query <> ' ' THEN coalesce(sum(n), 0)::BIGINT END AS same_genus FROM q LEFT JOIN m USING (query) GROUP BY 1""")
def genome_relatedness(t: Tables) -> DataFrame:
    genome = F.when(F.col("p_partkey") % 2 == 0, F.col("p_type")).otherwise(F.lit(" "))
    reference = t.part.select(genome.alias("genome_id"), F.concat("p_name", "p_brand").alias("genome_name"), F.col("p_partkey").alias("pos"))
    queries = t.part.select(F.when(F.col("p_size") == 1, " ").otherwise(F.replace("p_name", F.lit("medium"), F.lit("mediumx"))).alias("query"))
    return O.relatedness(reference, queries)


# -- the full score --------------------------------------------------------------------------

#: The query's organism, hits' organisms and taxa, and computed evidence, for Spark and DuckDB alike.
ASKED = PROTEIN | {"query_name": "CASE c_nationkey % 3 WHEN 0 THEN 'Vibrio cholerae O1' WHEN 1 THEN ' ' ELSE 'Mycoplasma genitalium' END"}
BOUND = HIT | {
    "organism": "CASE o_orderkey % 4 WHEN 0 THEN 'Vibrio cholerae' WHEN 1 THEN 'Mycoplasmoides genitalium' WHEN 2 THEN 'Homo sapiens' END", "taxon": "CASE WHEN o_orderkey % 4 = 2 THEN 9606 END",
    "has_metal": "o_orderkey % 7 = 0",
}
_COMPUTED = {
    "human": ({"feature_id": "c_custkey", "human_pct": "(c_custkey % 100) * 1.0D0", "human_source": "'search'"}, "c_custkey % 11 = 0"),
    "essential": ({"feature_id": "c_custkey", "essential_call": "CASE WHEN c_custkey % 3 <> 0 THEN c_custkey % 2 = 0 END", "essential_from": "'alignment'"}, "c_custkey % 13 = 0"),
    "assays": ({"feature_id": "c_custkey"}, "c_custkey % 17 = 0"),
    "retrieval": ({"feature_id": "c_custkey", "retrieval_status": "CASE WHEN c_custkey % 19 = 0 THEN 'query-failed' WHEN c_custkey % 4 <> 0 THEN 'ok' END", "error": "CASE WHEN c_custkey % 19 = 0 THEN 'timeout' END"}, "c_custkey % 5 <> 0"),
}


def scored_proteins(t: Tables, n: int = 100) -> DataFrame:
    some = lambda c, x: F.when(F.col(c), F.array(F.lit(x))).otherwise(F.array().cast("array<string>"))
    found = _shaped(t.orders, BOUND).withColumns({"ligands": some("has_ligand", "ATP"), "metals": some("has_metal", "ZN")})
    part = lambda name: _shaped(t.customer.where(_COMPUTED[name][1]), _COMPUTED[name][0])
    assays = part("assays").withColumn("assay_targets", F.array(F.lit("T1"), F.lit("T2")))
    rows = C.score_proteins(_shaped(t.customer, ASKED), specialty(t), found, G.merge_calls(_shaped(t.events, CALL)), part("human"), part("essential"), assays, part("retrieval"), F.col("query_name"))
    return C.rank_proteins(rows, n)


_FULL = f"""WITH {_FLAGS}, {_HITS}, {_CALLS}, p AS ({_sql("customer", ASKED)}), more AS ({_sql("orders", BOUND)}),
{", ".join(f"{name} AS ({_sql('customer', columns)} WHERE {where})" for name, (columns, where) in _COMPUTED.items())},
basis AS (SELECT feature_id, CASE WHEN bool_or(m) THEN array_to_string(list_sort(list_distinct(list(classification) FILTER (WHERE m))), '; ') WHEN bool_and(t) THEN 'antibiotic target in susceptible species'
ELSE 'AMR row with no classification recorded' END AS amr_basis, bool_or(t) AS antibiotic_target FROM (SELECT *, lower(coalesce(classification, '')) LIKE '%antibiotic efflux%' AS m,
lower(coalesce(classification, '')) LIKE '%antibiotic target in susceptible species%' AS t FROM ({_sql("events", SPECIALTY)}) WHERE property = 'Antibiotic Resistance') GROUP BY 1),
top AS (SELECT b.*, m.entry_id, m.identity, m.query_coverage, m.resolution, m.organism, m.taxon FROM best b JOIN more m USING (feature_id, pos)),
holo AS (SELECT s.feature_id, s.entry_id AS holo_entry FROM scored s JOIN more m USING (pos) WHERE qualifies AND (s.has_ligand OR m.has_metal)
QUALIFY row_number() OVER (PARTITION BY s.feature_id ORDER BY s.has_ligand DESC, hit_score DESC, s.bitscore DESC, pos) = 1),
parts AS (SELECT p.feature_id, round(coalesce(hit_score, 0.0) / (1.0::DOUBLE + 0.10::DOUBLE + 0.05::DOUBLE + 0.05::DOUBLE), 6) AS pdb_evidence, hit_score, entry_id, identity, query_coverage, resolution, holo_entry,
coalesce(has_ligand, FALSE) AS ligand, greatest(CASE WHEN virulence THEN 1.0 ELSE 0.0 END, coalesce(amr_value, 0.0))::DOUBLE AS virulence_amr, coalesce(essential_call, essential, FALSE) AS is_essential,
coalesce(drug_target, FALSE) AS is_target, product LIKE 'hypothetical%' AS gap, coalesce(signal_source, surface_source, secreted_source) AS surface_source, coalesce(exposed, FALSE) AS surface, coalesce(membrane_value, FALSE) AS membrane,
membrane_source, coalesce(has_ligand AND NOT has_partner, FALSE) AS own_ligand, a.feature_id IS NOT NULL AS assayed, coalesce(human_pct, human_identity_pct) AS pct,
CASE WHEN human_pct IS NOT NULL THEN human_source WHEN human_identity_pct IS NOT NULL THEN 'specialty' ELSE '' END AS human_homolog_source, CASE WHEN essential_call IS NOT NULL THEN essential_from ELSE 'specialty' END AS essential_source,
coalesce(amr_basis, '') AS amr_basis, coalesce(antibiotic_target, FALSE) AS antibiotic_target, coalesce(retrieval_status = 'query-failed', FALSE) AS search_failed, retrieval_status, coalesce(distinct_entries, 0) AS distinct_entries, coalesce(qualifying_hits, 0) AS qualifying_hits,
CASE WHEN query_name <> ' ' THEN coalesce(organism IN ('Vibrio cholerae', 'Mycoplasmoides genitalium') AND query_name[1:8] = organism[1:8], FALSE) END AS related, coalesce(taxon = 9606, FALSE) AS human_hit
FROM p LEFT JOIN flags USING (feature_id) LEFT JOIN basis USING (feature_id) LEFT JOIN top USING (feature_id) LEFT JOIN entries USING (feature_id) LEFT JOIN holo USING (feature_id) LEFT JOIN annotation USING (feature_id)
LEFT JOIN human USING (feature_id) LEFT JOIN essential USING (feature_id) LEFT JOIN assays a USING (feature_id) LEFT JOIN retrieval USING (feature_id)),
totals AS (SELECT *, round(coalesce(pct, 0.0) / 100, 6) AS penalty, own_ligand OR assayed AS ligandable, coalesce(pct >= 40, FALSE) AS disqualified,
CASE WHEN own_ligand THEN 'ligand bound in ' || entry_id || ': ATP' WHEN assayed THEN 'compounds assayed against the mapped target: T1;T2' WHEN ligand THEN 'ligand in ' || entry_id || ' not credited: the entry has partners' ELSE '' END AS ligandable_basis FROM parts),
summed AS (SELECT *, round(pdb_evidence * 0.40::DOUBLE + virulence_amr * 0.20::DOUBLE + (CASE WHEN is_essential THEN 1 ELSE 0 END) * 0.15::DOUBLE + (CASE WHEN is_target THEN 1 ELSE 0 END) * 0.15::DOUBLE + (CASE WHEN gap THEN 1 ELSE 0 END) * 0.30::DOUBLE
+ (CASE WHEN surface THEN 1 ELSE 0 END) * 0.10::DOUBLE + (CASE WHEN ligandable THEN 1 ELSE 0 END) * 0.10::DOUBLE - (CASE WHEN membrane THEN 1 ELSE 0 END) * 0.15::DOUBLE - penalty * 0.25::DOUBLE, 6) AS score,
CASE WHEN disqualified THEN printf('human homolog %.1f%% identity (%s)', pct, human_homolog_source) ELSE '' END AS disqualified_why FROM totals),
ranked AS (SELECT *, row_number() OVER w AS rank, NOT disqualified AND sum(CASE WHEN disqualified THEN 0 ELSE 1 END) OVER (w ROWS UNBOUNDED PRECEDING) <= 100 AS selected FROM summed
WINDOW w AS (ORDER BY score DESC, pdb_evidence DESC, distinct_entries DESC, feature_id)),
full_rows AS (SELECT *, concat_ws('; ', CASE WHEN hit_score IS NOT NULL THEN printf('PDB %d identity %.0f%%, coverage %.0f%%, %.2f A', entry_id, identity * 100, query_coverage * 100, resolution)
WHEN search_failed THEN 'PDB search failed; no structural evidence recorded' ELSE 'no qualifying PDB hit' END, CASE WHEN ligand THEN 'ligand-bound homolog: ATP' END, CASE WHEN virulence_amr > 0 THEN 'virulence/AMR' END,
CASE WHEN is_essential THEN 'essential-gene ortholog' END, CASE WHEN is_target THEN 'known drug target' END, CASE WHEN gap THEN 'uncharacterized product' END, CASE WHEN ligandable THEN 'ligandable homolog (' || ligandable_basis || ')' END,
CASE WHEN surface THEN 'surface-exposed or secreted' END, CASE WHEN membrane THEN 'predicted membrane protein (penalty)' END, CASE WHEN penalty > 0 THEN printf('human homolog %.0f%% identity (penalty)', round_even(penalty * 100, 0)) END,
CASE WHEN related THEN 'best structural hit is of the same species' END, CASE WHEN antibiotic_target THEN 'antibiotic target in a susceptible species, not a resistance gene' END,
CASE WHEN disqualified THEN 'DISQUALIFIED: ' || disqualified_why END) AS reason FROM ranked)"""


@query(_FULL + """ SELECT feature_id, score, rank, selected, distinct_entries, holo_entry, human_homolog_source, essential_source, amr_basis, surface_source IS NOT NULL AS surface_measured, hit_score IS NOT NULL OR assayed AS ligandable_measured,
hit_score IS NULL AND NOT search_failed AS no_hit, search_failed, human_hit, related AS same_species_hit, disqualified_why, reason FROM full_rows""")
def full_scores(t: Tables) -> DataFrame:
    return scored_proteins(t).select(
        "feature_id", "score", "rank", "selected", "distinct_entries", "holo_entry", "human_homolog_source", "essential_source", "amr_basis", "surface_measured", "ligandable_measured",
        "no_hit", "search_failed", "human_hit", "same_species_hit", "disqualified_why", "reason",
    )


@query(_FULL + """, c AS (SELECT 'counts' AS part, unnest(['proteins_scored', 'selected', 'disqualified', 'no_hit', 'search_failed', 'hits_qualifying']) AS name, unnest([count(*), count(*) FILTER (WHERE selected), count(*) FILTER (WHERE disqualified),
count(*) FILTER (WHERE hit_score IS NULL AND NOT search_failed), count(*) FILTER (WHERE search_failed), sum(qualifying_hits)]) AS n FROM full_rows
UNION ALL SELECT 'measured', unnest(['surface_bonus', 'ligandable_homolog', 'membrane_penalty']), unnest([count(surface_source), count(*) FILTER (WHERE hit_score IS NOT NULL OR assayed), count(membrane_source)]) FROM full_rows
UNION ALL SELECT 'nonzero', unnest(['pdb_evidence', 'virulence_amr', 'essential', 'drug_target', 'annotation_gap', 'surface_bonus', 'ligandable_homolog', 'membrane_penalty', 'human_homolog_penalty']),
unnest([count(*) FILTER (WHERE pdb_evidence <> 0), count(*) FILTER (WHERE virulence_amr <> 0), count(*) FILTER (WHERE is_essential), count(*) FILTER (WHERE is_target), count(*) FILTER (WHERE gap), count(*) FILTER (WHERE surface),
count(*) FILTER (WHERE ligandable), count(*) FILTER (WHERE membrane), count(*) FILTER (WHERE penalty <> 0)]) FROM full_rows
UNION ALL SELECT 'same_organism', unnest(['species_total', 'species_selected', 'genus_total', 'genus_selected']), unnest([count(*) FILTER (WHERE related), count(*) FILTER (WHERE related AND selected), count(*) FILTER (WHERE related), count(*) FILTER (WHERE related AND selected)]) FROM full_rows
UNION ALL SELECT 'retrieval', coalesce(retrieval_status, 'not asked'), count(*) FROM full_rows GROUP BY 2) SELECT part, name, n::BIGINT AS n FROM c""")
def run_manifest(t: Tables) -> DataFrame:
    return C.run_manifest(scored_proteins(t))


@query(f"""SELECT 'search' AS step, CAST(feature_id AS VARCHAR) AS key, 'timeout' AS error FROM ({_sql("customer", _COMPUTED["retrieval"][0])} WHERE {_COMPUTED["retrieval"][1]}) WHERE retrieval_status = 'query-failed'""")
def run_failures(t: Tables) -> DataFrame:
    return C.failures(scored_proteins(t))


@query(f"""SELECT feature_id, coalesce(array_to_string(list_sort(list(DISTINCT nullif(classification, ''))), ','), '') AS classes, array_to_string(list_sort(list(DISTINCT property)), ',') AS properties, count(*) AS rows
FROM ({_sql("events", SPECIALTY)}) GROUP BY 1""")
def specialty_index(t: Tables) -> DataFrame:
    out = X.specialty_index(specialty(t), S.specialty_type(F.col("property")))
    return out.select("feature_id", F.array_join("classes", ",").alias("classes"), F.array_join("properties", ",").alias("properties"), "rows")


@query("""WITH f AS (SELECT c_nationkey, c_mktsegment AS v, count(*) AS n FROM customer WHERE c_mktsegment <> 'HOUSEHOLD' GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY c_nationkey ORDER BY count(*) DESC, c_mktsegment) = 1)
SELECT c_custkey, CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN c_mktsegment ELSE v END AS value, CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN 'this genome' WHEN v IS NOT NULL THEN 'species-typical (' || n || ' genomes)' END AS source
FROM customer LEFT JOIN f USING (c_nationkey)""")
def growth_rows(t: Tables) -> DataFrame:
    own = F.when(F.col("c_mktsegment") == "HOUSEHOLD", "Not provided").otherwise(F.col("c_mktsegment"))
    rows = t.customer.withColumn("own", own)
    typical = X.typical_value(rows, ["c_nationkey"], S.meaningful(F.col("own")))
    joined = rows.join(typical, "c_nationkey", "left")
    return joined.select("c_custkey", R.growth_row(F.col("own"), F.col("value"), F.col("n")).alias("row")).select("c_custkey", "row.value", "row.source")


@query("""SELECT user_id, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY CASE WHEN event_id % 3 = 0 THEN 0 WHEN event_id % 2 = 0 THEN 2 ELSE 1 END DESC, event_id) = 1""")
def richest_terms(t: Tables) -> DataFrame:
    name, aspect = F.when(F.col("event_id") % 3 != 0, F.lit("n")), F.when(F.col("event_id") % 2 == 0, F.lit("a")).otherwise(F.lit(""))
    return X.richest(t.events.select("user_id", "event_id", name.alias("name"), aspect.alias("aspect"), F.col("event_id").alias("pos")), "user_id").select("user_id", "event_id")


@query("""SELECT user_id, coalesce(min(CASE WHEN event_type = 'purchase' THEN event_id END), min(CASE WHEN event_type = 'click' THEN event_id END), min(event_id)) AS term FROM events GROUP BY 1""")
def preferred_terms(t: Tables) -> DataFrame:
    listed = t.events.groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("event_id", F.col("event_type").alias("kind"), F.col("event_id").alias("id")))).alias("terms"))
    return listed.select("user_id", X.preferred_term(F.col("terms"), ("purchase", "click")).alias("term"))


@query("""SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN CASE WHEN p_brand IN ('Brand#1', 'Brand#2') THEN 'A' ELSE 'C' END WHEN 1 THEN 'N' WHEN 2 THEN 'OA' ELSE 'ZN' END AS kind,
p_size % 9 = 0 OR p_size % 5 = 0 AS poor, CASE WHEN p_size % 6 <> 0 THEN printf('%d%%', p_size) ELSE '—' END AS share FROM part""")
def atoms_and_genomes(t: Tables) -> DataFrame:
    name = F.when(F.col("p_brand").isin("Brand#1", "Brand#2"), "CG").otherwise("CA")
    element = F.get(F.array(*map(F.lit, ("C", "N", "O", "ZN"))), F.col("p_size") % 4)
    quality = F.when(F.col("p_size") % 9 == 0, " Poor").otherwise("Good")
    flags = F.when(F.col("p_size") % 5 == 0, F.array(F.lit("too short")))
    share = F.when(F.col("p_size") % 6 != 0, F.col("p_size") / 100)
    return t.part.select("p_partkey", R.atom_type(name, F.lit("PHE"), element).alias("kind"), R.poor_genome(quality, flags).alias("poor"), R.percent(share).alias("share"))
