"""The core operators bound to the benchmark tables, each with the same query in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from basalt.functions import scalar as S
from basalt.operators import aggregates as A
from basalt.operators import best as B
from basalt.operators import keyed as K
from basalt.streaming import latest

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


class Tables:
    """The tables of a data folder, by attribute."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir
        self._read = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        return self._read(name)


def query(sql: str | None = None):
    """Register a function of the tables under its own name."""

    def add(f: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


BIG = "value >= 50"


# -- best row per key ------------------------------------------------------------------------


@query("""SELECT user_id, event_id, event_type, value, TRUE AS counted FROM events WHERE event_type <> 'view'
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) = 1""")
def best_hit_gate_then_max(t: Tables) -> DataFrame:
    best = B.best_per_key(t.events, ["user_id"], [F.desc("value"), F.col("event_id")], F.col("event_type") != "view", "gate_then_max")
    return best.select("user_id", "event_id", "event_type", "value", "counted")


@query("""SELECT user_id, event_id, event_type, value, event_type <> 'view' AS counted FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) = 1""")
def best_hit_max_then_gate(t: Tables) -> DataFrame:
    best = B.best_per_key(t.events, ["user_id"], [F.desc("value"), F.col("event_id")], F.col("event_type") != "view", "max_then_gate")
    return best.select("user_id", "event_id", "event_type", "value", "counted")


@query("""SELECT user_id, event_id, event_type, value FROM events WHERE value > 1
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY (event_type = 'purchase') DESC, value DESC, event_id) = 1""")
def best_holo_hit(t: Tables) -> DataFrame:
    order = [F.desc(F.col("event_type") == "purchase"), F.desc("value"), F.col("event_id")]
    return B.best_per_key(t.events, ["user_id"], order, F.col("value") > 1, "gate_then_max").select("user_id", "event_id", "event_type", "value")


@query("""SELECT p_brand, p_partkey, p_retailprice, place FROM (
SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS place FROM part) WHERE place <= 10""")
def capped_per_source(t: Tables) -> DataFrame:
    return B.top_per_key(t.part, ["p_brand"], [F.desc("p_retailprice"), F.col("p_partkey")], 10).select("p_brand", "p_partkey", "p_retailprice", "place")


# -- ranking, selection, scoring -------------------------------------------------------------


@query("""WITH r AS (SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus = 'P' AS dq FROM orders)
SELECT o_custkey, o_orderkey, dq, row_number() OVER w AS rank,
NOT dq AND sum(CAST(NOT dq AS INTEGER)) OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey ROWS UNBOUNDED PRECEDING) <= 3 AS selected
FROM r WINDOW w AS (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey)""")
def rank_select_disqualify(t: Tables) -> DataFrame:
    rows = t.orders.withColumn("dq", F.col("o_orderstatus") == "P")
    return B.rank_select(rows, [F.desc("o_totalprice"), F.col("o_orderkey")], 3, F.col("dq"), ["o_custkey"]).select("o_custkey", "o_orderkey", "dq", "rank", "selected")


@query("""SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus <> 'P' ORDER BY o_totalprice DESC, o_orderkey LIMIT 50""")
def select_top_global(t: Tables) -> DataFrame:
    return B.select_top(t.orders, [F.desc("o_totalprice"), F.col("o_orderkey")], 50, F.col("o_orderstatus") == "P").select("o_orderkey", "o_totalprice")


PART_WEIGHTS = {"size_part": 0.4, "promo": 0.2, "brass": 0.15, "penalty": -0.25}


def part_components(t: Tables) -> DataFrame:
    one = lambda c: F.when(c, 1.0).otherwise(0.0)
    return t.part.select(
        "p_partkey", (F.col("p_size") / 50).alias("size_part"), one(F.col("p_type").startswith("PROMO")).alias("promo"),
        one(F.col("p_type").contains("BRASS")).alias("brass"), one(F.col("p_brand") == "Brand#11").alias("penalty"),
    )


_PARTS = """SELECT p_partkey, p_size / 50.0::DOUBLE AS size_part, CASE WHEN p_type LIKE 'PROMO%' THEN 1.0 ELSE 0.0 END::DOUBLE AS promo,
CASE WHEN p_type LIKE '%BRASS%' THEN 1.0 ELSE 0.0 END::DOUBLE AS brass, CASE WHEN p_brand = 'Brand#11' THEN 1.0 ELSE 0.0 END::DOUBLE AS penalty FROM part"""


@query(f"""SELECT *, round(0.4::DOUBLE * size_part + 0.2::DOUBLE * promo + 0.15::DOUBLE * brass - 0.25::DOUBLE * penalty, 6) AS score FROM ({_PARTS})""")
def weighted_score_components(t: Tables) -> DataFrame:
    parts = part_components(t)
    return parts.withColumn("score", S.weighted({n: F.col(n) for n in PART_WEIGHTS}, PART_WEIGHTS))


@query(f"""WITH p AS ({_PARTS}), r AS (SELECT p_partkey,
row_number() OVER (ORDER BY round(0.4::DOUBLE * size_part + 0.2::DOUBLE * promo + 0.15::DOUBLE * brass - 0.25::DOUBLE * penalty, 6) DESC, p_partkey) AS a,
row_number() OVER (ORDER BY round(size_part, 6) DESC, p_partkey) AS b FROM p)
SELECT count(*) FILTER (WHERE a <= 100) AS n, count(*) FILTER (WHERE a <= 100 AND b <= 100) AS overlap FROM r""")
def selection_overlap(t: Tables) -> DataFrame:
    parts = part_components(t)
    top = lambda w: parts.withColumn("s", S.weighted({n: F.col(n) for n in w}, w)).orderBy(F.desc("s"), "p_partkey").limit(100).select("p_partkey")
    one, two = top(PART_WEIGHTS), top({"size_part": 1.0})
    return one.join(two.withColumn("both", F.lit(1)), "p_partkey", "left").agg(F.count("*").alias("n"), F.count("both").alias("overlap"))


@query("""SELECT d.doc_id, coalesce(l.quality, 0) * 3 + CASE WHEN d.lang = 'en' THEN 2 ELSE 0 END + CASE WHEN d.n_chars > 2000 THEN 1 ELSE 0 END
- coalesce(l.toxic, 0) * 2 AS points, concat_ws('; ', CASE WHEN l.quality = 1 THEN 'quality' END, CASE WHEN d.lang = 'en' THEN 'english' END,
CASE WHEN d.n_chars > 2000 THEN 'long' END, CASE WHEN l.toxic = 1 THEN 'toxic' END) AS reasons FROM documents d LEFT JOIN labels l USING (doc_id)""")
def priority_breakdown(t: Tables) -> DataFrame:
    joined = t.documents.join(t.labels, "doc_id", "left")
    tests = {"quality": (3, F.col("quality") == 1), "english": (2, F.col("lang") == "en"), "long": (1, F.col("n_chars") > 2000), "toxic": (-2, F.col("toxic") == 1)}
    given = F.filter(F.array(*(F.when(c, F.struct(F.lit(p).alias("points"), F.lit(n).alias("reason"))) for n, (p, c) in tests.items())), lambda x: x.isNotNull())
    parts = joined.select("doc_id", given.alias("b"))
    return parts.select("doc_id", F.aggregate("b", F.lit(0), lambda s, x: s + x["points"]).alias("points"), F.array_join(F.transform("b", lambda x: x["reason"]), "; ").alias("reasons"))


@query("""SELECT l_orderkey, CASE WHEN max(CAST(l_returnflag = 'R' AS INTEGER)) = 1 THEN 1.0 WHEN min(CAST(l_linestatus = 'O' AS INTEGER)) = 1 THEN 0.0
ELSE 0.5 END::DOUBLE AS evidence, count(*) AS n FROM lineitem GROUP BY 1""")
def resistance_evidence(t: Tables) -> DataFrame:
    value = A.resistance_evidence(F.col("l_returnflag") == "R", F.col("l_linestatus") == "O", F.col("l_orderkey"))
    return t.lineitem.groupBy("l_orderkey").agg(value.alias("evidence"), F.count("*").alias("n"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_quantity > 0 THEN least(1.0, greatest(0.0, (l_quantity - l_linenumber + 1) / l_quantity)) ELSE 0.0 END::DOUBLE AS covered
FROM lineitem""")
def query_coverage(t: Tables) -> DataFrame:
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", S.coverage(F.col("l_linenumber"), F.col("l_quantity"), F.col("l_quantity")).alias("covered"))


# -- keyed joins -----------------------------------------------------------------------------


@query("""SELECT doc_id, 'left' AS side FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)
UNION ALL SELECT doc_id, 'right' FROM labels l WHERE NOT EXISTS (SELECT 1 FROM documents d WHERE l.doc_id = d.doc_id)""")
def orphan_report(t: Tables) -> DataFrame:
    return K.orphans(t.documents, t.labels, "doc_id")


@query("""SELECT d.doc_id, d.lang, coalesce('label', d.source) AS source, l.quality FROM documents d JOIN labels l USING (doc_id)
UNION ALL SELECT doc_id, lang, source, NULL FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def keyed_merge(t: Tables) -> DataFrame:
    update = t.labels.select("doc_id", F.lit("label").alias("source"), "quality")
    return K.keyed_merge(t.documents.select("doc_id", "lang", "source"), update, "doc_id")


@query("""SELECT doc_id, min(doc_id) OVER (PARTITION BY text) AS representative, count(*) OVER (PARTITION BY text) AS copies FROM documents""")
def dedup_fanout(t: Tables) -> DataFrame:
    return K.representatives(t.documents, S.sequence_key(F.col("text")), "doc_id")


@query("""SELECT c_custkey, coalesce(s.s_suppkey, n.n_nationkey) AS found, CASE WHEN s.s_suppkey IS NOT NULL THEN 0 WHEN n.n_nationkey IS NOT NULL THEN 1 END::INTEGER AS alias_pos
FROM customer c LEFT JOIN supplier s ON s.s_suppkey = c.c_custkey AND c.c_acctbal > 0 LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey""")
def alias_join_first_match(t: Tables) -> DataFrame:
    names = t.supplier.select(F.concat(F.lit("s"), "s_suppkey").alias("name"), F.col("s_suppkey").alias("found"))
    names = names.unionByName(t.nation.select(F.concat(F.lit("n"), "n_nationkey").alias("name"), F.col("n_nationkey").cast("long").alias("found")))
    first = F.when(F.col("c_acctbal") > 0, F.concat(F.lit("s"), "c_custkey"))
    rows = t.customer.select("c_custkey", F.array(first, F.concat(F.lit("n"), "c_nationkey")).alias("aliases"))
    return K.alias_join(rows, "aliases", names, "name", "c_custkey").select("c_custkey", "found", "alias_pos")


@query("""SELECT c_custkey, coalesce(s.s_name, n.n_name, r.r_name) AS target,
CASE WHEN s.s_name IS NOT NULL THEN 'supplier' WHEN n.n_name IS NOT NULL THEN 'nation' WHEN r.r_name IS NOT NULL THEN 'region' ELSE 'unmapped' END AS route
FROM customer c LEFT JOIN supplier s ON s.s_suppkey = c.c_custkey LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey AND n.n_nationkey < 10
LEFT JOIN region r ON r.r_regionkey = c.c_nationkey - 15""")
def crosswalk_cascade(t: Tables) -> DataFrame:
    routes = [
        ("supplier", t.supplier, "s_suppkey", "s_name"),
        ("nation", t.nation.where("n_nationkey < 10"), "n_nationkey", "n_name"),
        ("region", t.region, "r_regionkey", "r_name"),
    ]
    rows = t.customer.select("c_custkey", F.col("c_custkey").alias("s_suppkey"), F.col("c_nationkey").alias("n_nationkey"), (F.col("c_nationkey") - 15).alias("r_regionkey"))
    return K.crosswalk(rows, "c_custkey", routes).select("c_custkey", "target", "route")


@query("""SELECT p_partkey, tier, p_type FROM (SELECT p_partkey, 0 AS tier, p_type FROM part WHERE p_size > 40
UNION ALL SELECT p_partkey, 1, p_type FROM part WHERE p_type LIKE '%STEEL%') QUALIFY row_number() OVER (PARTITION BY p_partkey ORDER BY tier) = 1""")
def first_tier_wins(t: Tables) -> DataFrame:
    part = t.part.select("p_partkey", "p_type", "p_size")
    return B.first_tier([part.where("p_size > 40"), part.where(F.col("p_type").contains("STEEL"))], ["p_partkey"], [F.col("p_type")]).select("p_partkey", "tier", "p_type")


@query("""SELECT user_id, event_type, value, event_id FROM events WHERE value IS NOT NULL QUALIFY row_number() OVER (PARTITION BY user_id
ORDER BY CASE event_type WHEN 'purchase' THEN 60 WHEN 'click' THEN 50 WHEN 'signup' THEN 30 ELSE 0 END DESC, event_id) = 1""")
def provider_precedence(t: Tables) -> DataFrame:
    ranks = {"purchase": 60, "click": 50, "signup": 30}
    return B.provider_precedence(t.events, ["user_id"], ranks, "event_type", "value", "event_id").select("user_id", "event_type", "value", "event_id")


# -- aggregations ----------------------------------------------------------------------------


@query("""SELECT lang AS value, count(*) AS n FROM documents WHERE lang IS NOT NULL GROUP BY 1 HAVING count(*) >= 5 ORDER BY n DESC, value LIMIT 3""")
def facet_topn(t: Tables) -> DataFrame:
    return A.facet(t.documents, "lang", 5, 3)


@query("""WITH c AS (SELECT c_nationkey, c_mktsegment, count(*) AS n FROM customer GROUP BY 1, 2), t AS (SELECT c_nationkey, count(*) AS total FROM customer GROUP BY 1),
b AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY c_nationkey ORDER BY n DESC, c_mktsegment) = 1)
SELECT c_nationkey, CASE WHEN n >= 0.25 * total THEN c_mktsegment END AS mode, n, total FROM t JOIN b USING (c_nationkey)""")
def mode_quorum(t: Tables) -> DataFrame:
    return A.mode_quorum(t.customer, ["c_nationkey"], "c_mktsegment", 0.25)


@query("""SELECT coalesce(event_type, 'unknown') AS bucket, count(*) AS n, count(DISTINCT user_id) AS users, count(*) FILTER (WHERE value >= 50) AS big FROM events GROUP BY 1""")
def property_buckets(t: Tables) -> DataFrame:
    return t.events.groupBy(F.coalesce("event_type", F.lit("unknown")).alias("bucket")).agg(
        F.count("*").alias("n"), F.count_distinct("user_id").alias("users"), F.count_if(F.expr(BIG)).alias("big")
    )


@query("""SELECT CASE WHEN o_orderstatus = 'F' THEN 'found' WHEN o_orderstatus = 'O' THEN 'open' ELSE 'failed' END AS status, o_orderpriority, count(*) AS n,
CAST(grouping_id(CASE WHEN o_orderstatus = 'F' THEN 'found' WHEN o_orderstatus = 'O' THEN 'open' ELSE 'failed' END, o_orderpriority) AS BIGINT) AS level
FROM orders GROUP BY CUBE (CASE WHEN o_orderstatus = 'F' THEN 'found' WHEN o_orderstatus = 'O' THEN 'open' ELSE 'failed' END, o_orderpriority)""")
def status_counts(t: Tables) -> DataFrame:
    status = F.when(F.col("o_orderstatus") == "F", "found").when(F.col("o_orderstatus") == "O", "open").otherwise("failed")
    return t.orders.select(status.alias("status"), "o_orderpriority").cube("status", "o_orderpriority").agg(F.count("*").alias("n"), F.grouping_id().alias("level"))


@query("""SELECT event_type, value AS median, n FROM (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY value) AS r,
count(*) OVER (PARTITION BY event_type) AS n FROM events WHERE value IS NOT NULL) WHERE r = n // 2 + 1""")
def upper_median(t: Tables) -> DataFrame:
    return A.upper_median(t.events, ["event_type"], "value").select("event_type", "median", "n")


@query("""WITH s AS (SELECT DISTINCT s_nationkey AS g, l_partkey AS m FROM lineitem JOIN supplier ON s_suppkey = l_suppkey), z AS (SELECT g, count(*) AS n FROM s GROUP BY g)
SELECT x.g AS a, y.g AS b, count(*) AS shared, 1 - count(*) / (max(za.n) + max(zb.n) - count(*))::DOUBLE AS distance
FROM s x JOIN s y ON x.m = y.m AND x.g < y.g JOIN z za ON za.g = x.g JOIN z zb ON zb.g = y.g GROUP BY 1, 2""")
def jaccard_pairs(t: Tables) -> DataFrame:
    sold = t.lineitem.select("l_partkey", "l_suppkey").join(t.supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
    return A.jaccard_pairs(sold, "s_nationkey", "l_partkey")


@query("""WITH e AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos FROM events),
i AS (SELECT *, pos - row_number() OVER (PARTITION BY user_id ORDER BY pos) AS g FROM e WHERE value < 50)
SELECT user_id, min(pos) AS first, max(pos) AS last, count(*) AS length FROM i GROUP BY user_id, g HAVING count(*) >= 3""")
def gaps_islands(t: Tables) -> DataFrame:
    rows = t.events.withColumn("pos", F.row_number().over(W.partitionBy("user_id").orderBy("ts", "event_id")).cast("long"))
    return A.islands(rows, ["user_id"], "pos", F.col("value") < 50, "value").where("length >= 3").select("user_id", "first", "last", "length")


@query("""SELECT event_id, count(*) OVER w AS n, max(value) OVER w AS most FROM events
WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 9 PRECEDING AND 9 FOLLOWING)""")
def sliding_window(t: Tables) -> DataFrame:
    w = W.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(-9, 9)
    return t.events.select("event_id", F.count("*").over(w).alias("n"), F.max("value").over(w).alias("most"))


@query("""SELECT a.vec_id, b.vec_id AS vec_id_2 FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id < b.vec_id
WHERE sqrt((a.embedding[1]::DOUBLE - b.embedding[1]) ** 2 + (a.embedding[2]::DOUBLE - b.embedding[2]) ** 2 + (a.embedding[3]::DOUBLE - b.embedding[3]) ** 2) <= 0.08""")
def contact_pairs(t: Tables) -> DataFrame:
    at = [F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate("xyz")]
    points = t.embeddings.select("label", "vec_id", *at)
    return A.contacts(points, points, "label", 0.08).where("vec_id < vec_id_2").select("vec_id", "vec_id_2")


# -- graphs, caps, gates ---------------------------------------------------------------------


@query("""WITH o AS (SELECT o_custkey, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) <= 10)
SELECT 'customer:' || o_custkey AS source_id, 'order:' || o_orderkey AS target_id, 'placed' AS type FROM o
UNION ALL SELECT DISTINCT 'order:' || o_orderkey, 'part:' || l_partkey, 'contains' FROM o JOIN lineitem ON l_orderkey = o_orderkey""")
def kg_edges_capped(t: Tables) -> DataFrame:
    placed = B.top_per_key(t.orders, ["o_custkey"], [F.desc("o_totalprice"), F.col("o_orderkey")], 10).select("o_custkey", "o_orderkey")
    name = lambda kind, c: F.concat(F.lit(f"{kind}:"), F.col(c))
    one = placed.select(name("customer", "o_custkey").alias("source_id"), name("order", "o_orderkey").alias("target_id"), F.lit("placed").alias("type"))
    held = placed.join(t.lineitem.select("l_orderkey", "l_partkey"), F.col("o_orderkey") == F.col("l_orderkey"))
    two = held.select(name("order", "o_orderkey").alias("source_id"), name("part", "l_partkey").alias("target_id"), F.lit("contains").alias("type")).distinct()
    return one.unionByName(two)


@query("""SELECT l_returnflag AS type, count(*) AS n FROM lineitem GROUP BY 1""")
def kg_type_counts(t: Tables) -> DataFrame:
    return t.lineitem.groupBy(F.col("l_returnflag").alias("type")).agg(F.count("*").alias("n"))


@query("""SELECT id, type, name FROM (SELECT user_id AS id, first_value(event_type) OVER w AS type,
first_value(event_type) OVER (PARTITION BY user_id ORDER BY (event_type = 'view'), event_id) AS name, row_number() OVER w AS r FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id))
WHERE r = 1""")
def kg_upsert_nodes(t: Tables) -> DataFrame:
    name = F.when(F.col("event_type") != "view", F.col("event_type")).otherwise(" ")
    rows = t.events.select(F.col("user_id").alias("id"), F.col("event_type").alias("type"), name.alias("name"), F.col("event_id").alias("pos"))
    return A.upsert_nodes(rows).select("id", "type", F.coalesce("name", F.lit("view")).alias("name"))


@query("""SELECT doc_id, n_chars FROM documents WHERE n_chars < 500 UNION ALL
(SELECT doc_id, n_chars FROM documents WHERE NOT n_chars < 500 ORDER BY n_chars DESC, doc_id LIMIT 100)""")
def sequence_cap_exempt(t: Tables) -> DataFrame:
    return B.cap_exempt(t.documents.select("doc_id", "n_chars"), F.col("n_chars") < 500, [F.desc("n_chars"), F.col("doc_id")], 100)


def line_checks():
    return F.array(A.check("quantity", F.col("l_quantity"), ">=", 10), A.check("discount", F.col("l_discount"), "<=", 0.07), A.check("tax", F.col("l_tax"), "<=", 0.06))


@query("""SELECT l_orderkey, l_partkey, l_linenumber, l_quantity >= 10 AND l_discount <= 0.07 AND l_tax <= 0.06 AS passed,
concat_ws('; ', CASE WHEN NOT l_quantity >= 10 THEN 'quantity >= fails' END, CASE WHEN NOT l_discount <= 0.07 THEN 'discount <= fails' END,
CASE WHEN NOT l_tax <= 0.06 THEN 'tax <= fails' END) AS reasons FROM lineitem""")
def quality_gate(t: Tables) -> DataFrame:
    rows = t.lineitem.withColumn("checks", line_checks())
    return rows.select("l_orderkey", "l_partkey", "l_linenumber", A.checks_pass(F.col("checks")).alias("passed"), A.failed_reasons(F.col("checks")).alias("reasons"))


@query("""SELECT p_partkey, CASE WHEN p_retailprice >= 1800 THEN 'very high' WHEN p_retailprice >= 1500 THEN 'confident' WHEN p_retailprice >= 1200 THEN 'low'
ELSE 'very low' END AS band FROM part""")
def confidence_band(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", S.confidence_band((F.col("p_retailprice") - 1200) / 15 + 50).alias("band"))


# -- text and hashes -------------------------------------------------------------------------

MECHANISMS = (("metal", r"(?i)steel|brass|tin|copper|nickel"), ("plated", r"(?i)\bplated\b"), ("promo", r"(?i)^promo"), ("large", r"(?i)\blarge\b"))


@query(r"""SELECT p_partkey, concat_ws(',', CASE WHEN regexp_matches(p_type, '(?i)steel|brass|tin|copper|nickel') THEN 'metal' END,
CASE WHEN regexp_matches(p_type, '(?i)\bplated\b') THEN 'plated' END, CASE WHEN regexp_matches(p_type, '(?i)^promo') THEN 'promo' END,
CASE WHEN regexp_matches(p_type, '(?i)\blarge\b') THEN 'large' END) AS kinds FROM part""")
def classify_mechanisms(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", F.array_join(S.all_rules(F.col("p_type"), MECHANISMS), ",").alias("kinds"))


@query("""SELECT page_id, CASE WHEN regexp_matches(lower(url), '^https') THEN 'secure' WHEN regexp_matches(lower(url), 'html$') THEN 'static' ELSE 'other' END AS kind FROM pages""")
def first_rule_map(t: Tables) -> DataFrame:
    return t.pages.select("page_id", S.first_rule(F.col("url"), (("^https", "secure"), ("html$", "static")), F.lit("other")).alias("kind"))


@query("""SELECT doc_id, sha256(text) AS content_key, length(text) AS n FROM documents""")
def sha256_key(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", S.sequence_key(F.col("text")).alias("content_key"), F.length("text").cast("long").alias("n"))


@query()
def crc64_key(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", S.crc64_hex(F.col("p_name")).alias("crc64"))


@query(r"""SELECT p_partkey, regexp_replace(upper(p_brand), '[^A-Z0-9]', '', 'g') AS locus,
substring(regexp_replace(lower(trim(p_type)), '[^a-z0-9]+', '-', 'g'), 1, 60) AS slug FROM part""")
def normalised_names(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", S.normal_locus(F.col("p_brand")).alias("locus"), S.slug(F.col("p_type")).alias("slug"))


@query("""SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events""")
def tolerant_casts(t: Tables) -> DataFrame:
    return t.events.select("event_id", S.as_int(F.get_json_object("props", "$.k")).alias("k"))


@query("""SELECT event_id FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 30 DAY""")
def cache_freshness(t: Tables) -> DataFrame:
    latest_at = t.events.agg(F.max("ts").alias("now"))
    return t.events.join(F.broadcast(latest_at), F.col("ts") >= F.col("now") - F.expr("INTERVAL 30 DAYS")).select("event_id")


@query("""SELECT conv_id, count(*) AS turns, string_agg(role, '>' ORDER BY turn) AS roles, max(length(text)) AS longest FROM conversations GROUP BY 1""")
def turn_sequence(t: Tables) -> DataFrame:
    turns = F.array_sort(F.collect_list(F.struct("turn", "role")))
    return t.conversations.groupBy("conv_id").agg(
        F.count("*").alias("turns"), F.array_join(F.transform(turns, lambda x: x["role"]), ">").alias("roles"), F.max(F.length("text")).cast("long").alias("longest")
    )


# -- plans over whole tables -----------------------------------------------------------------


@query("""SELECT l_returnflag, l_linestatus, CAST(sum(CAST(round(l_quantity) AS BIGINT)) AS BIGINT) AS sum_qty, count(*) AS count_order,
count(DISTINCT l_partkey) AS parts FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY 1, 2""")
def pricing_summary(t: Tables) -> DataFrame:
    rows = t.lineitem.where(F.col("l_shipdate") <= F.lit("1998-09-02").cast("timestamp_ntz"))
    return rows.groupBy("l_returnflag", "l_linestatus").agg(F.sum(F.round("l_quantity").cast("long")).alias("sum_qty"), F.count("*").alias("count_order"), F.count_distinct("l_partkey").alias("parts"))


@query("""SELECT n_name, o_orderpriority, count(*) AS n, max(o_totalprice) AS most FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
JOIN region ON r_regionkey = n_regionkey WHERE o_orderdate >= TIMESTAMP '1995-01-01' GROUP BY 1, 2""")
def coverage_survey(t: Tables) -> DataFrame:
    orders = t.orders.where(F.col("o_orderdate") >= F.lit("1995-01-01").cast("timestamp_ntz"))
    joined = orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).groupBy("n_name", "o_orderpriority").agg(F.count("*").alias("n"), F.max("o_totalprice").alias("most"))


@query("""SELECT o_orderkey, score, rank FROM (SELECT o_orderkey, score, row_number() OVER (PARTITION BY c_mktsegment ORDER BY score DESC, o_orderkey) AS rank FROM (
SELECT o_orderkey, c_mktsegment, CASE WHEN o_orderstatus = 'F' THEN 3 ELSE 0 END + CASE WHEN o_orderpriority LIKE '1%' THEN 2 ELSE 0 END
+ coalesce(big, 0) AS score FROM orders JOIN customer ON c_custkey = o_custkey
LEFT JOIN (SELECT l_orderkey, count(*) FILTER (WHERE l_quantity >= 25) AS big FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey)) WHERE rank <= 100""")
def triage_orders(t: Tables) -> DataFrame:
    evidence = t.lineitem.groupBy("l_orderkey").agg(F.count_if(F.col("l_quantity") >= 25).alias("big"))
    score = F.when(F.col("o_orderstatus") == "F", 3).otherwise(0) + F.when(F.col("o_orderpriority").startswith("1"), 2).otherwise(0) + F.coalesce("big", F.lit(0))
    rows = t.orders.join(t.customer.select("c_custkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey")).join(evidence, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    ranked = B.top_per_key(rows.withColumn("score", score.cast("long")), ["c_mktsegment"], [F.desc("score"), F.col("o_orderkey")], 100)
    return ranked.select("o_orderkey", "score", F.col("place").alias("rank"))


@query("""SELECT user_id, value, event_type, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) = 1""")
def streaming_latest_best(t: Tables) -> DataFrame:
    return latest.latest_best(t.events, ["user_id"])


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES["triage_proteins"](spark, sf_dir)
