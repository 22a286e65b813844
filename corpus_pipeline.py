"""The corpus pipeline: five stages from raw documents to token digests."""

from __future__ import annotations

import public_tokenizers as tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basalt.llm.bpe import bpe_report
from basalt.llm.common import cut, discard, table
from basalt.llm.lines import kept_texts
from basalt.llm.mixing import mixed_documents
from basalt.llm.simhash import first_of_groups
from basalt.llm.toxicity import with_toxicity


def _free(docs: DataFrame, name: str) -> str:
    """``name``, made different from all columns of ``docs``."""
    while name in docs.columns:
        name += "_"
    return name


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored under one half stay.

    Every row is scored by its own text, whatever its id, so repeated rows share their fate and
    null ids change nothing; null and empty texts are scored by the classifier's bias alone.
    Further columns pass through, whatever their names; an empty table stays empty."""
    score = _free(docs, "pipeline_toxicity")
    scored = with_toxicity(docs, table(spark, sf_dir, "labels"), score)
    return scored.where(scored[score] < 0.5).drop(score)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts keep the lines that no earlier line resembles; a text left with none is gone.

    Earlier is by doc_id and position. Texts without any line from the start, null ones
    included, stay; rows with a null doc_id stay whole; rows that repeat id and text keep the
    same lines. ``n_chars`` follows the text where that column is there; columns by the names
    ``kept_text``, ``n_lines``, ``n_kept`` and ``lost_marks`` are renamed on the way."""
    clashing = {c: _free(docs, f"own_{c}") for c in ("kept_text", "n_lines", "n_kept", "lost_marks") if c in docs.columns}
    done = kept_texts(docs.withColumnsRenamed(clashing))
    emptied = (F.col("n_kept") < F.col("n_lines")) & ~F.col("kept_text").rlike(r"\S")
    left = done.where(~F.coalesce(emptied, F.lit(False))).withColumn("text", F.col("kept_text"))
    if "n_chars" in docs.columns:
        changed = F.col("n_kept") < F.col("n_lines")
        left = left.withColumn("n_chars", F.when(changed, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return left.select(*(F.col(clashing.get(c, c)).alias(c) for c in docs.columns))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of every SimHash group stays; each row is judged by its own text.

    Groups are those of the operator: three-word shingles, three differing bits. Nulls, ties,
    repeated rows and clashing names are treated as ``first_of_groups`` says."""
    return first_of_groups(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it: texts without words never, null ids and
    repeated rows like all others, columns as they are."""
    return mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of what is left, one row for each row; a null text has none."""
    return bpe_report(docs, tokenizers.path("byte_bpe_50k.tiktoken"), tokenizers.PATTERN)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("simhash", drop_near_copies),
    ("mixing", mix_sources),
    ("byte_bpe", encode),
]

#: Viterbi decoding and the fitted classifier have no SQL form; tests hold each stage to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again by the next."""
    docs = before = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
        if hasattr(before, "cut_at"):
            discard(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
