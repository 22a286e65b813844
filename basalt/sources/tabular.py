"""Tables with aliases, wrapped JSON, tolerant text, hit tables and provider outputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basalt.functions.scalar import as_float, as_int, first_present, localisation, normal_header, split_list

HIT_SCHEMA = "qseqid string, sseqid string, pident double, length int, mismatch int, gapopen int, qstart int, qend int, sstart int, send int, evalue double, bitscore double"
INTERPRO_COLUMNS = "protein_accession sequence_md5 sequence_length analysis signature_accession signature_description start stop score status date interpro_accession interpro_description go_annotations pathways".split()
EMAPPER_COLUMNS = "query seed_ortholog evalue score eggNOG_OGs max_annot_lvl COG_category Description Preferred_name GOs EC KEGG_ko KEGG_Pathway KEGG_Module KEGG_Reaction KEGG_rclass BRITE KEGG_TC CAZy BiGG_Reaction PFAMs".split()

#: Names that a column goes by, in order of preference. Fixed values.
ALIASES = {
    "feature_id": ("patric_id", "feature_id", "brc_id", "genome_feature_id"),
    "product": ("product", "function"),
    "gene": ("gene", "gene_name", "gene_symbol"),
    "locus_tag": ("refseq_locus_tag", "locus_tag", "alt_locus_tag"),
    "property": ("property", "specialty_gene_property", "type"),
    "classification": ("classification", "amr_classification", "assertion"),
    "source": ("source", "database", "specialty_source"),
    "identity": ("identity", "pct_identity", "percent_identity"),
    "query_coverage": ("query_coverage", "coverage", "query_cov"),
}


def resolve(df: DataFrame, wanted: tuple[str, ...] | None = None) -> DataFrame:
    """Headers normalised, and each wanted column taken from the first of its names that has a
    value in the row; a column under none of its names is null."""
    renamed = df.toDF(*(normal_header(c.lstrip("﻿")) for c in df.columns))
    out = []
    for name in wanted or ALIASES:
        present = [F.col(a) for a in ALIASES[name] if a in renamed.columns]
        out.append((first_present(*present) if present else F.lit(None).cast("string")).alias(name))
    return renamed.select(*out)


def delimited(spark: SparkSession, path: str) -> DataFrame:
    """Comma, tab or semicolon separated, told from the first line, all columns as text."""
    first = spark.read.text(path).limit(1).collect()
    line = first[0][0] if first else ""
    separator = max(",\t;", key=line.count)
    return spark.read.csv(path, header=True, sep=separator, multiLine=True, escape='"', ignoreLeadingWhiteSpace=True)


def json_records(spark: SparkSession, path: str) -> DataFrame:
    """Records of a JSON list, or of the list that an object wraps."""
    df = spark.read.option("multiLine", True).option("primitivesAsString", True).json(path)
    for wrapper in ("features", "items", "records", "response", "docs"):
        if wrapper in df.columns:
            inner = df.select(F.explode(wrapper).alias("r")) if df.schema[wrapper].dataType.typeName() == "array" else df.select(F.col(wrapper).alias("r"))
            df = inner.select("r.*")
    return df


def tolerant_text(spark: SparkSession, path: str) -> DataFrame:
    """Rows (path, text): UTF-8, with or without a mark, or else Windows-1252."""
    files = spark.read.format("binaryFile").load(path)
    utf8 = F.expr("try_validate_utf8(cast(content as string))")
    # Spark has no decoder for Windows-1252; it is Latin-1 but for the places 0x80 to 0x9F.
    places = [i for i in range(0x80, 0xA0) if bytes([i]).decode("cp1252", "ignore")]
    western = F.translate(F.decode("content", "ISO-8859-1"), "".join(map(chr, places)), bytes(places).decode("cp1252"))
    return files.select("path", F.regexp_replace(F.coalesce(utf8, western), "^﻿", "").alias("text"))


def hits(spark: SparkSession, path: str) -> DataFrame:
    """Headerless twelve-column alignment hits; short and unreadable rows are skipped."""
    return spark.read.csv(path, sep="\t", schema=HIT_SCHEMA, mode="DROPMALFORMED").where("qseqid is not null and bitscore is not null")


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).where(F.trim("value") != "")


def emapper(spark: SparkSession, path: str) -> DataFrame:
    """Orthology annotations as long terms (feature_id, kind, id, source)."""
    rows = _lines(spark, path).where(~F.col("value").startswith("#")).select(F.split("value", "\t").alias("f"))
    field = lambda name: F.get("f", EMAPPER_COLUMNS.index(name))
    kinds = {"go": field("GOs"), "ec": field("EC"), "kegg": field("KEGG_ko"), "pfam": field("PFAMs"), "cog": field("COG_category")}
    terms = F.map_from_arrays(F.array(*map(F.lit, kinds)), F.array(*(split_list(F.coalesce(c, F.lit("-"))) for c in kinds.values())))
    long = rows.select(F.get("f", 0).alias("feature_id"), F.explode(terms).alias("kind", "ids"))
    return long.select("feature_id", "kind", F.explode("ids").alias("id"), F.lit("eggnog").alias("source"))


def interpro(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.csv(path, sep="\t", schema=", ".join(f"{c} string" for c in INTERPRO_COLUMNS))
    casts = {"start": as_int(F.col("start")), "stop": as_int(F.col("stop")), "score": as_float(F.col("score")), "sequence_length": as_int(F.col("sequence_length"))}
    return rows.withColumns(casts)


def topology(spark: SparkSession, path: str) -> DataFrame:
    """Membrane topology from GFF3: counted helices, strands and signals, and the declared number
    of spans, which counts where nothing was counted."""
    lines = _lines(spark, path)
    declared = lines.select(
        F.regexp_extract("value", r"^#\s*(\S+)\s+Number of predicted TMRs:\s*(\d+)", 1).alias("feature_id"),
        F.regexp_extract("value", r"Number of predicted TMRs:\s*(\d+)", 1).try_cast("int").alias("declared"),
    ).where("feature_id <> ''")
    regions = lines.where(~F.col("value").rlike("^(#|//)")).select(F.split("value", "\t").alias("f")).select(F.get("f", 0).alias("feature_id"), F.lower(F.get("f", 1)).alias("region"))
    counted = regions.groupBy("feature_id").agg(
        F.count_if(F.col("region").contains("helix")).alias("helices"), F.count_if(F.col("region").contains("strand") | F.col("region").contains("beta")).alias("strands"),
        F.count_if(F.col("region") == "signal").alias("signals"),
    )
    joined = declared.join(counted, "feature_id", "full")
    spans = F.coalesce("helices", F.lit(0)) + F.coalesce("strands", F.lit(0))
    return joined.select("feature_id", F.when(spans > 0, spans).otherwise(F.coalesce("declared", F.lit(0))).alias("spans"), (F.coalesce("signals", F.lit(0)) > 0).alias("signal"))


def signal_peptides(spark: SparkSession, path: str) -> DataFrame:
    rows = _lines(spark, path).where(~F.col("value").startswith("#")).select(F.split("value", "\t").alias("f"), "value")
    return rows.select(F.regexp_extract(F.get("f", 0), r"^(\S+)", 1).alias("feature_id"), F.get("f", 1).alias("prediction"), as_int(F.nullif(F.regexp_extract("value", r"CS pos:\s*(\d+)", 1), F.lit(""))).alias("cleavage"))


def localisations(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.csv(path, sep="\t", header=True)
    renamed = rows.toDF(*(normal_header(c) for c in rows.columns))
    return renamed.select(F.regexp_extract("seqid", r"^(\S+)", 1).alias("feature_id"), localisation(F.col("localization")).alias("location"), as_float(F.col("score")).alias("score"))


def pockets(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.csv(path, header=True, ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True)
    renamed = rows.toDF(*(normal_header(c) for c in rows.columns))
    return renamed.select(F.col("name").alias("pocket"), *(as_float(F.col(c)).alias(c) for c in ("score", "probability", "center_x", "center_y", "center_z") if c in renamed.columns))


def payload(cache: DataFrame, schema: str, column: str = "payload_json") -> DataFrame:
    """Cached replies parsed by an explicit schema; what does not parse is a failed reply."""
    parsed: Column = F.from_json(column, schema)
    return cache.withColumn("reply", parsed).withColumn("status", F.when(F.col("reply").isNull(), "failed").otherwise("found"))


def fresh(cache: DataFrame, now: Column, days: int = 30) -> DataFrame:
    return cache.where(F.col("fetched_at") >= now - F.make_dt_interval(F.lit(days)))
