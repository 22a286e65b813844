"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

import public_tokenizers as tokenizers

from basalt.llm.bpe import bpe_report
from basalt.llm.chat import ROTATE_SQL, rotate
from basalt.llm.common import table
from basalt.llm.divergence import AUDIT_SQL, divergence_audit
from basalt.llm.html import extract
from basalt.llm.itq import embedding_groups
from basalt.llm.lexical import SEARCH_SQL, ranked_search
from basalt.llm.lines import line_report
from basalt.llm.mixing import mix_report
from basalt.llm.rabitq import search
from basalt.llm.simhash import simhash_groups
from basalt.llm.suffixes import REPORT_SQL, contamination_report
from basalt.llm.tokencount import token_counts
from basalt.llm.toxicity import toxicity_scores


def op1_itq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_groups(table(spark, sf_dir, "embeddings"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_report(table(spark, sf_dir, "documents"), tokenizers.path("byte_bpe_50k.tiktoken"), tokenizers.PATTERN)


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_report(table(spark, sf_dir, "documents"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), tokenizers.path("piece_bpe_32k.model"))


def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


def op8_rabitq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"))


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rotate(table(spark, sf_dir, "conversations"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_report(table(spark, sf_dir, "documents"))


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence_audit(table(spark, sf_dir, "documents"))


def op12_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_itq": op1_itq,
    "op2_simhash": op2_simhash,
    "op3_toxicity": op3_toxicity,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_line_dedup": op5_line_dedup,
    "op6_token_counts": op6_token_counts,
    "op7_html": op7_html,
    "op8_rabitq": op8_rabitq,
    "op9_chat": op9_chat,
    "op10_mixing": op10_mixing,
    "op11_divergence": op11_divergence,
    "op12_lexical": op12_lexical,
    "op13_suffixes": op13_suffixes,
}

ORACLE_SQL: dict[str, str] = {"op9_chat": ROTATE_SQL, "op11_divergence": AUDIT_SQL, "op12_lexical": SEARCH_SQL, "op13_suffixes": REPORT_SQL}
