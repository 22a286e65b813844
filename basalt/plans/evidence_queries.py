"""More core operators bound to the benchmark tables: summaries, decisions and term tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from basalt.functions import scalar as S
from basalt.functions.sequence import membrane_spans
from basalt.operators import best as B
from basalt.operators import features as X
from basalt.operators import lineage as L
from basalt.operators import trees as G
from basalt.operators.naming import unique_ids
from basalt.operators.staging import shared_folder
from basalt.plans import taxonomy as Q
from basalt.plans.queries import Tables, query
from basalt.sources import paged as N
from basalt.streaming import latest
from basalt.streaming import stateful as Z

# -- summaries -------------------------------------------------------------------------------


@query("""SELECT CAST(floor(p_retailprice / 100) AS BIGINT) AS bin, count(*) AS n FROM part GROUP BY 1""")
def score_histogram(t: Tables) -> DataFrame:
    return t.part.groupBy(F.floor(F.col("p_retailprice") / 100).alias("bin")).agg(F.count("*").alias("n"))


@query("""SELECT c_custkey, c_mktsegment, round(100.0::DOUBLE * c_acctbal / max(c_acctbal) OVER (PARTITION BY c_mktsegment), 3) AS percent FROM customer""")
def percent_of_max(t: Tables) -> DataFrame:
    most = F.max("c_acctbal").over(W.partitionBy("c_mktsegment"))
    return t.customer.select("c_custkey", "c_mktsegment", F.round(F.lit(100.0) * F.col("c_acctbal") / most, 3).alias("percent"))


@query("""SELECT count(*) AS documents, count(*) FILTER (WHERE lang = 'en') AS english, count(*) FILTER (WHERE n_chars >= 5000) AS long_ones,
count(DISTINCT source) AS sources, count(*) FILTER (WHERE regexp_matches(text, 'https?://')) AS with_links, max(n_chars) AS longest FROM documents""")
def annotation_summary(t: Tables) -> DataFrame:
    return t.documents.agg(
        F.count("*").alias("documents"), F.count_if(F.col("lang") == "en").alias("english"), F.count_if(F.col("n_chars") >= 5000).alias("long_ones"),
        F.count_distinct("source").alias("sources"), F.count_if(F.col("text").rlike("https?://")).alias("with_links"), F.max("n_chars").alias("longest"),
    )


@query("""SELECT component, count(*) FILTER (WHERE value IS NOT NULL) AS measured, count(*) FILTER (WHERE value <> 0) AS nonzero, count(*) AS n FROM (
SELECT unnest(['quality', 'toxic']) AS component, unnest([l.quality, l.toxic]) AS value FROM documents d LEFT JOIN labels l USING (doc_id)) GROUP BY 1""")
def component_availability(t: Tables) -> DataFrame:
    wide = t.documents.select("doc_id").join(t.labels, "doc_id", "left")
    long = wide.unpivot(["doc_id"], ["quality", "toxic"], "component", "value")
    return long.groupBy("component").agg(F.count("value").alias("measured"), F.count_if(F.col("value") != 0).alias("nonzero"), F.count("*").alias("n"))


@query("""SELECT o_orderstatus, o_orderpriority, count(*) AS n, count(DISTINCT o_custkey) AS customers FROM orders
GROUP BY ROLLUP (o_orderstatus, o_orderpriority)""")
def survey_rollup(t: Tables) -> DataFrame:
    return t.orders.rollup("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n"), F.count_distinct("o_custkey").alias("customers"))


@query("""SELECT kind, count(*) AS n, count(DISTINCT p_brand) AS brands, min(p_partkey) AS first FROM (SELECT p_partkey, p_brand, unnest(string_split(p_type, ' ')) AS kind FROM part) GROUP BY 1""")
def member_tally(t: Tables) -> DataFrame:
    each = t.part.select("p_partkey", "p_brand", F.explode(F.split("p_type", " ")).alias("kind"))
    return each.groupBy("kind").agg(F.count("*").alias("n"), F.count_distinct("p_brand").alias("brands"), F.min("p_partkey").alias("first"))


@query("""SELECT user_id, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS types, count(*) FILTER (WHERE event_type = 'purchase') AS purchases,
bool_or(event_type = 'error') AS failed FROM events GROUP BY 1""")
def evidence_sets(t: Tables) -> DataFrame:
    return t.events.groupBy("user_id").agg(
        F.array_join(F.array_sort(F.collect_set("event_type")), ",").alias("types"), F.count_if(F.col("event_type") == "purchase").alias("purchases"),
        F.bool_or(F.col("event_type") == "error").alias("failed"),
    )


@query("""SELECT field, value, n FROM (SELECT field, value, n, row_number() OVER (PARTITION BY field ORDER BY n DESC, value) AS r FROM (
SELECT 'lang' AS field, lang AS value, count(*) AS n FROM documents GROUP BY lang UNION ALL SELECT 'source', source, count(*) FROM documents GROUP BY source)) WHERE r <= 6""")
def field_distributions(t: Tables) -> DataFrame:
    long = t.documents.unpivot(["doc_id"], ["lang", "source"], "field", "value").where(S.meaningful(F.col("value")).isNotNull())
    counts = long.groupBy("field", "value").agg(F.count("*").alias("n"))
    return B.top_per_key(counts, ["field"], [F.desc("n"), F.col("value")], 6).drop("place")


# -- decisions -------------------------------------------------------------------------------


@query("""SELECT p_partkey, CASE WHEN p_size >= 30 THEN 'experimental' WHEN p_retailprice >= 1500 THEN 'model' WHEN p_type LIKE '%STEEL%' THEN 'related' ELSE 'prediction_required' END AS choice,
CASE WHEN p_size >= 30 AND p_retailprice >= 1500 THEN 'model' END AS template FROM part""")
def choose_structure(t: Tables) -> DataFrame:
    solved, model, related = F.col("p_size") >= 30, F.col("p_retailprice") >= 1500, F.col("p_type").contains("STEEL")
    choice = F.coalesce(F.when(solved, "experimental"), F.when(model, "model"), F.when(related, "related"), F.lit("prediction_required"))
    return t.part.select("p_partkey", choice.alias("choice"), F.when(solved & model, "model").alias("template"))


@query("""SELECT n_nationkey, s_suppkey, tier FROM (SELECT s_nationkey AS n_nationkey, s_suppkey, CASE WHEN s_acctbal > 8000 THEN 0 WHEN s_acctbal > 5000 THEN 1 ELSE 2 END AS tier, s_acctbal FROM supplier)
QUALIFY row_number() OVER (PARTITION BY n_nationkey ORDER BY tier, s_acctbal DESC, s_suppkey) = 1""")
def resolution_tiers(t: Tables) -> DataFrame:
    tier = F.when(F.col("s_acctbal") > 8000, 0).when(F.col("s_acctbal") > 5000, 1).otherwise(2)
    rows = t.supplier.select(F.col("s_nationkey").alias("n_nationkey"), "s_suppkey", "s_acctbal", tier.alias("tier"))
    return B.first_per_key(rows, ["n_nationkey"], [F.col("tier"), F.desc("s_acctbal"), F.col("s_suppkey")]).select("n_nationkey", "s_suppkey", "tier")


@query("""SELECT doc_id, CASE WHEN n_chars / 10000.0 <= 0.05 THEN 'species' WHEN n_chars / 10000.0 <= 0.2 THEN 'genus' END AS rank FROM documents""")
def rank_by_distance(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", Q.rank_of(F.col("n_chars") / 10000).alias("rank"))


@query("""WITH h AS (SELECT c_custkey AS run, o_orderkey, CASE WHEN o_orderkey % 11 <> 0 THEN CASE WHEN o_orderkey % 13 = 0 THEN 'gone' ELSE 'c' || c_custkey END END AS taxon, (o_orderkey % 50) / 200.0::DOUBLE AS distance, c_nationkey, n_regionkey
FROM customer LEFT JOIN orders ON o_custkey = c_custkey JOIN nation ON n_nationkey = c_nationkey QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY (o_orderkey % 50) / 200.0::DOUBLE, o_orderkey) = 1),
r AS (SELECT *, CASE WHEN distance <= 0.05 THEN 'species' WHEN distance <= 0.2 THEN 'genus' END AS rank FROM h),
s AS (SELECT *, CASE WHEN o_orderkey IS NULL THEN 'no hits' WHEN rank IS NULL THEN printf('the nearest genome is at %.4f, beyond every cut-off', distance) WHEN taxon IS NULL THEN 'the nearest genome has no taxon' WHEN taxon = 'gone' THEN 'the taxon is not known'
WHEN rank = 'genus' AND n_regionkey = 4 THEN 'the lineage has no genus' ELSE '' END AS reason FROM r)
SELECT run, CASE WHEN reason = '' THEN rank END AS called_rank, CASE WHEN reason = '' THEN CASE rank WHEN 'species' THEN 'n' || c_nationkey ELSE 'r' || n_regionkey END END AS taxon, reason FROM s""")
def taxon_calls(t: Tables) -> DataFrame:
    """Customers as runs, their orders as hits on them, and the tree of places as the taxonomy."""
    rank = F.when(F.col("node").startswith("n"), "species").when(F.col("node").startswith("r") & (F.col("node") != "r4"), "genus").otherwise("no rank")
    taxa = places(t).where(~F.col("node").startswith("o")).select(F.col("node").alias("taxon"), "parent", rank.alias("rank"), "name")
    taxon = F.when(F.col("o_orderkey") % 11 != 0, F.when(F.col("o_orderkey") % 13 == 0, "gone").otherwise(F.concat(F.lit("c"), "o_custkey")))
    hits = t.orders.select(F.col("o_custkey").alias("run"), F.col("o_orderkey").cast("string").alias("genome"), taxon.alias("taxon"), (F.col("o_orderkey") % 50 / 200).alias("distance"), F.col("o_orderkey").alias("pos"))
    return Q.call_taxa(t.customer.select(F.col("c_custkey").alias("run")), hits, taxa).drop("name")


@query("""WITH g AS (SELECT s_name AS value, count(*) AS n FROM lineitem JOIN supplier ON s_suppkey = l_suppkey WHERE l_quantity > 49 GROUP BY 1), m AS (SELECT n_name AS value, count(*) AS n FROM supplier JOIN nation ON n_nationkey = s_nationkey WHERE s_acctbal > 6000 GROUP BY 1),
a AS (SELECT c_custkey, n_name, r_name, CASE WHEN c_custkey % 9 = 0 THEN 'Supplier#' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') END AS rel FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey)
SELECT c_custkey AS query, CASE WHEN c_custkey % 7 <> 0 AND g.n IS NOT NULL THEN 'genome' ELSE 'name' END AS kind,
CASE WHEN c_custkey % 7 = 0 THEN 'ASIA' WHEN g.n IS NOT NULL THEN '1 related genomes' WHEN m.n IS NOT NULL THEN n_name WHEN r_name = 'ASIA' THEN r_name ELSE n_name END AS matched,
CASE WHEN c_custkey % 7 = 0 THEN 77 WHEN g.n IS NOT NULL THEN g.n WHEN m.n IS NOT NULL THEN m.n WHEN r_name = 'ASIA' THEN 77 ELSE 0 END::BIGINT AS rows
FROM a LEFT JOIN g ON g.value = rel LEFT JOIN m ON m.value = n_name""")
def reference_resolution(t: Tables) -> DataFrame:
    """Customers ask for relatives: by keyword, by suppliers of their number, or by their nation and region."""
    named = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    own = F.when(F.col("c_custkey") % 9 == 0, F.array(F.concat(F.lit("Supplier#"), F.lpad(F.col("c_custkey").cast("string"), 9, "0")), F.lit("")))
    asked = named.select(F.col("c_custkey").alias("query"), F.when(F.col("c_custkey") % 7 == 0, "ASIA").otherwise(" ").alias("keyword"), own.alias("relatives"), F.array("r_name", F.lit(" "), "n_name").alias("lineage"), F.when(F.col("c_custkey") % 2 == 0, F.col("n_name")).alias("scientific"))
    genomes = t.lineitem.where("l_quantity > 49").join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).groupBy(F.col("s_name").alias("value")).agg(F.count("*").alias("rows"))
    nations = t.supplier.where("s_acctbal > 6000").join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).groupBy(F.col("n_name").alias("value")).agg(F.count("*").alias("rows"))
    regions = t.region.where("r_name = 'ASIA'").select(F.col("r_name").alias("value"), F.lit(77).cast("long").alias("rows"))
    names = nations.unionByName(regions).withColumn("kind", F.lit("name"))
    return Q.resolve_reference(asked, names.unionByName(genomes.withColumn("kind", F.lit("genome"))))


@query("""SELECT event_id, user_id, CASE WHEN value IS NULL THEN NULL ELSE value >= 50 END AS known, coalesce(CASE WHEN value >= 90 THEN 'failed' END, 'seen') AS status FROM events""")
def three_valued_flags(t: Tables) -> DataFrame:
    value = F.col("value")
    return t.events.select("event_id", "user_id", F.when(value.isNotNull(), value >= 50).alias("known"), F.coalesce(F.when(value >= 90, "failed"), F.lit("seen")).alias("status"))


@query("""SELECT l_orderkey, count(*) AS checks, count(*) FILTER (WHERE l_tax <= 0.04 OR l_discount IS NULL) AS passed FROM lineitem WHERE l_discount <= 0.05 OR l_discount IS NULL GROUP BY 1""")
def null_passing_gate(t: Tables) -> DataFrame:
    held = t.lineitem.where((F.col("l_discount") <= 0.05) | F.col("l_discount").isNull())
    return held.groupBy("l_orderkey").agg(F.count("*").alias("checks"), F.count_if((F.col("l_tax") <= 0.04) | F.col("l_discount").isNull()).alias("passed"))


@query("""SELECT pocket_of, pocket, probability FROM (SELECT l_orderkey AS pocket_of, l_partkey * 100 + l_linenumber AS pocket, l_discount * 10 AS probability FROM lineitem)
QUALIFY row_number() OVER (PARTITION BY pocket_of ORDER BY probability DESC, pocket) <= CASE WHEN max(probability) OVER (PARTITION BY pocket_of) >= 0.5 THEN 2 ELSE 1 END
AND (probability >= 0.5 OR max(probability) OVER (PARTITION BY pocket_of) < 0.5)""")
def pocket_selection(t: Tables) -> DataFrame:
    rows = t.lineitem.select(F.col("l_orderkey").alias("pocket_of"), (F.col("l_partkey") * 100 + F.col("l_linenumber")).alias("pocket"), (F.col("l_discount") * 10).alias("probability"))
    return B.pick_pockets(rows, ["pocket_of"], 0.5, 2).select("pocket_of", "pocket", "probability")


# -- terms, lists and text -------------------------------------------------------------------


@query("""SELECT doc_id, word, pos FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS word, generate_subscripts(string_split(text, ' '), 1) - 1 AS pos FROM documents)
WHERE word NOT IN ('', '-') QUALIFY row_number() OVER (PARTITION BY doc_id, word ORDER BY pos) = 1""")
def terms_first_seen(t: Tables) -> DataFrame:
    return X.first_words(t.documents, "doc_id", "text")


@query("""SELECT page_id, regexp_extract(url, '^https?://([^/]+)', 1) AS host, regexp_extract(html, '<title>([^<]*)', 1) AS title,
CAST(length(html) - length(replace(html, '<p>', '')) AS BIGINT) // 3 AS paragraphs FROM pages""")
def page_headers(t: Tables) -> DataFrame:
    return t.pages.select(
        "page_id", F.regexp_extract("url", r"^https?://([^/]+)", 1).alias("host"), F.regexp_extract("html", r"<title>([^<]*)", 1).alias("title"),
        F.regexp_count("html", F.lit("<p>")).cast("long").alias("paragraphs"),
    )


@query("""SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, json_extract_string(props, '$.missing') AS missing FROM events""")
def payload_fields(t: Tables) -> DataFrame:
    reply = t.events.select("event_id", F.from_json("props", "k bigint, missing string").alias("r"))
    return reply.select("event_id", "r.k", "r.missing")


@query("""WITH d AS (SELECT DISTINCT l_suppkey AS k FROM lineitem WHERE l_returnflag = 'R'), e AS (SELECT DISTINCT l_suppkey AS k FROM lineitem WHERE l_quantity > 49)
SELECT k, 'both' AS side FROM (SELECT k FROM d INTERSECT SELECT k FROM e) UNION ALL SELECT k, 'first' FROM (SELECT k FROM d EXCEPT SELECT k FROM e)
UNION ALL SELECT k, 'second' FROM (SELECT k FROM e EXCEPT SELECT k FROM d)""")
def set_operations(t: Tables) -> DataFrame:
    one = t.lineitem.where("l_returnflag = 'R'").select(F.col("l_suppkey").alias("k")).distinct()
    two = t.lineitem.where("l_quantity > 49").select(F.col("l_suppkey").alias("k")).distinct()
    named = lambda df, name: df.withColumn("side", F.lit(name))
    return named(one.intersect(two), "both").unionByName(named(one.exceptAll(two), "first")).unionByName(named(two.exceptAll(one), "second"))


_PLACES = """SELECT 'r' || r_regionkey AS node, CAST(NULL AS VARCHAR) AS parent, r_name AS name FROM region UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey, n_name FROM nation
UNION ALL SELECT 'c' || c_custkey, 'n' || c_nationkey, c_name FROM customer UNION ALL SELECT 'o' || o_orderkey, 'c' || o_custkey, NULL FROM orders"""


def places(t: Tables) -> DataFrame:
    """A tree of four levels: regions, nations, customers and orders."""
    row = lambda df, kind, key, up, above, name: df.select(F.concat(F.lit(kind), key).alias("node"), (F.concat(F.lit(up), above) if up else F.lit(None).cast("string")).alias("parent"), name.alias("name"))
    one = row(t.region, "r", "r_regionkey", "", "", F.col("r_name")).unionByName(row(t.nation, "n", "n_nationkey", "r", "n_regionkey", F.col("n_name")))
    two = row(t.customer, "c", "c_custkey", "n", "c_nationkey", F.col("c_name")).unionByName(row(t.orders, "o", "o_orderkey", "c", "o_custkey", F.lit(None).cast("string")))
    return one.unionByName(two)


@query(f"""WITH RECURSIVE p AS ({_PLACES}), path AS (SELECT node, coalesce(name, '') AS lineage, 0::BIGINT AS depth FROM p WHERE parent IS NULL
UNION ALL SELECT p.node, lineage || ' > ' || coalesce(name, ''), depth + 1 FROM path JOIN p ON p.parent = path.node) SELECT * FROM path""")
def lineage_lines(t: Tables) -> DataFrame:
    return L.lineage_text(places(t), "node", "parent", "name")


@query("""WITH w AS (SELECT o_orderkey, o_custkey, c_nationkey, n_regionkey FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey),
s AS (SELECT DISTINCT s_nationkey FROM supplier WHERE s_acctbal > 5000), c AS (SELECT c_custkey FROM customer WHERE c_acctbal > 9000)
SELECT node, level::BIGINT AS level, matched FROM (SELECT 'o' || o_orderkey AS node, CASE WHEN o_custkey IN (FROM c) THEN 1 WHEN c_nationkey IN (FROM s) THEN 2 WHEN n_regionkey = 1 THEN 3 END AS level,
CASE WHEN o_custkey IN (FROM c) THEN 'c' || o_custkey WHEN c_nationkey IN (FROM s) THEN 'n' || c_nationkey WHEN n_regionkey = 1 THEN 'r1' END AS matched FROM w) WHERE level IS NOT NULL""")
def nearest_level(t: Tables) -> DataFrame:
    mark = lambda df, kind, key: df.select(F.concat(F.lit(kind), key).alias("place"))
    evidence = mark(t.customer.where("c_acctbal > 9000"), "c", "c_custkey").unionByName(mark(t.supplier.where("s_acctbal > 5000"), "n", "s_nationkey")).unionByName(mark(t.region.where("r_regionkey = 1"), "r", "r_regionkey"))
    asked = t.orders.select(F.concat(F.lit("o"), "o_orderkey").alias("node"))
    return L.first_level(asked, places(t), "node", "parent", evidence, "place")


@query("""SELECT p_partkey, CASE WHEN n = 1 THEN p_brand ELSE p_brand || '_' || n END AS unique_id FROM (SELECT p_partkey, p_brand, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS n FROM part)""")
def unique_brands(t: Tables) -> DataFrame:
    return unique_ids(t.part.select("p_partkey", "p_brand"), "p_brand", "p_partkey").select("p_partkey", "unique_id")


@query("""WITH s AS (SELECT doc_id, upper(regexp_replace(coalesce(text, ''), '[^A-Za-z]', '', 'g')) AS s FROM documents), r AS (SELECT doc_id, i, CAST(round(10 * coalesce(
map_extract(MAP {'A': 1.8, 'R': -4.5, 'N': -3.5, 'D': -3.5, 'C': 2.5, 'Q': -3.5, 'E': -3.5, 'G': -0.4, 'H': -3.2, 'I': 4.5, 'L': 3.8, 'K': -3.9, 'M': 1.9, 'F': 2.8, 'P': -1.6, 'S': -0.8, 'T': -0.7, 'W': -0.9, 'Y': -1.3, 'V': 4.2}, s[i])[1], 0)) AS BIGINT) AS h
FROM (SELECT doc_id, s, unnest(range(1, len(s) + 1)) AS i FROM s)), w AS (SELECT doc_id, i, sum(h) OVER v AS total, count(*) OVER v AS n FROM r WINDOW v AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 9 PRECEDING AND 9 FOLLOWING)),
g AS (SELECT doc_id, i, i - row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k FROM w WHERE n = 19 AND total >= 304)
SELECT doc_id, min(i)::INTEGER AS first, max(i)::INTEGER AS last FROM g GROUP BY doc_id, k HAVING count(*) >= 9""")
def hydrophobic_runs(t: Tables) -> DataFrame:
    letters = F.upper(F.regexp_replace(F.coalesce("text", F.lit("")), "[^A-Za-z]", ""))
    found = membrane_spans(t.documents.select("doc_id", letters.alias("sequence")))
    return found.select("doc_id", F.explode("spans").alias("x")).select("doc_id", F.col("x.start").alias("first"), F.col("x.end").alias("last"))


@query()
def gene_content_tree(t: Tables) -> DataFrame:
    sold = t.lineitem.select("l_partkey", "l_suppkey").join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    genomes = t.nation.select(F.col("n_nationkey").alias("node"), F.col("n_name").alias("species"), (F.col("n_nationkey") == 7).alias("is_query"), (F.col("n_regionkey") == 2).alias("human"), F.col("n_nationkey").alias("pos"))
    return G.gene_content_tree(genomes, sold.select(F.col("s_nationkey").alias("node"), F.col("l_partkey").alias("family")))


@query("""SELECT user_id, CAST(date_trunc('day', ts) AS TIMESTAMP) AS day, count(*) AS n, max(value) AS most FROM events GROUP BY 1, 2""")
def daily_windows(t: Tables) -> DataFrame:
    return t.events.groupBy("user_id", F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day")).agg(F.count("*").alias("n"), F.max("value").alias("most"))


@query("""SELECT o_custkey, count(*) AS orders, round(least(2.0, log10(count(*) + 1)), 6) AS bonus FROM orders GROUP BY 1""")
def literature_bonus(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_custkey").agg(F.count("*").alias("orders")).withColumn("bonus", F.round(S.literature_bonus(F.col("orders")), 6))


# -- pages and streams -----------------------------------------------------------------------


def _scratch(t: Tables) -> str:
    return f"{shared_folder(t.spark)}/query_{uuid.uuid4().hex}"


@query("""SELECT row_number() OVER (ORDER BY c_custkey) - 1 AS pos, c_custkey, c_name, c_mktsegment FROM customer""")
def paged_rows(t: Tables) -> DataFrame:
    """The customers, kept as pages of replies in the shared folder and read again a page a task."""
    folder = _scratch(t)
    rows = t.customer.select("c_custkey", "c_name", "c_mktsegment")
    N.keep_pages(rows, F.col("c_custkey"), folder, 500)
    return N.fields(N.pages(t.spark, N.folder_fetch(folder), 500, rows.count()), "c_custkey long, c_name string, c_mktsegment string")


@query("""WITH e AS (SELECT user_id, event_id, ts, value, epoch_us(ts) // 1000 - lag(epoch_us(ts) // 1000) OVER (PARTITION BY user_id ORDER BY ts) > 86400000 AS new FROM events WHERE value IS NOT NULL AND user_id IS NOT NULL),
r AS (SELECT *, sum(CASE WHEN new THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts RANGE UNBOUNDED PRECEDING) AS k FROM e)
SELECT CAST(user_id AS VARCHAR) AS key, row_number() OVER (PARTITION BY user_id ORDER BY min(ts))::INTEGER AS sessions, count(*) AS n, round(sum(value), 6) AS total, epoch_us(min(ts)) // 1000 AS first_ms, epoch_us(max(ts)) // 1000 AS last_ms
FROM r GROUP BY user_id, k HAVING epoch_us(max(ts)) // 1000 + 86400000 <= (SELECT epoch_us(max(ts)) // 1000 - 3600000 FROM events)""")
def event_sessions(t: Tables) -> DataFrame:
    """The stream of events, run through with keyed state and timers: users' days of activity."""
    out = Z.run_through(Z.sessions(latest.events_stream(t.spark, t.sf_dir), "user_id", 86400), _scratch(t))
    ms = lambda c: F.unix_millis(c)
    return out.select("key", "sessions", "n", F.round("total", 6).alias("total"), ms(F.col("first_ts")).alias("first_ms"), ms(F.col("last_ts")).alias("last_ms"))
