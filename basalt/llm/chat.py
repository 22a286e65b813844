"""Chat formatting from every participant's point of view."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Turns of a conversation that are laid out in one task.
BLOCK = 256
#: Turns by this role belong to no participant and stay as they are.
SYSTEM = "system"


def rotate(turns: DataFrame) -> DataFrame:
    """Rows (conv_id, perspective, turn, speaker, role, name, rendered, begin, end, mask_begin,
    mask_end): every conversation once from the view of each of its participants.

    A participant is a role other than ``system``; a null role speaks as ``unknown``. In a view
    its participant is the ``assistant``, all others are ``user`` with their role as ``name``,
    and system turns stay ``system``. A turn is rendered as a header line, the text (null:
    empty) and a closing line; ``begin`` and ``end`` place it, in characters, in the whole
    rendered dialogue, whose turns stand by ``turn`` (null first), then role and text. The mask
    spans what the assistant says and its end mark, which is what a model learns; it is null in
    other turns. Repeated rows are turns of their own. Conversations without participants have
    no view; rows with a null conv_id form one conversation; further columns play no part; an
    empty table gives an empty result. Blocks of turns are laid out apart and then moved to
    their place, so that a conversation of any length takes many tasks.
    """
    said = turns.select(
        F.col("conv_id").isNull().alias("no_id"), F.coalesce(F.col("conv_id").cast("long"), F.lit(0)).alias("conv"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("unknown")).alias("speaker"), F.coalesce("text", F.lit("")).alias("said"),
    )
    views = said.where(F.col("speaker") != SYSTEM).select("no_id", "conv", F.col("speaker").alias("perspective")).distinct()
    both = said.join(views, ["no_id", "conv"])
    own = F.col("speaker") == F.col("perspective")
    role = F.when(F.col("speaker") == SYSTEM, SYSTEM).when(own, "assistant").otherwise("user")
    header = F.concat(F.lit("<|"), F.col("role"), F.when(F.col("role") == "user", F.concat(F.lit(" name="), F.col("speaker"))).otherwise(""), F.lit("|>\n"))
    shown = both.withColumn("role", role).withColumn("header", header).withColumn("rendered", F.concat("header", "said", F.lit("\n<|end|>\n")))
    sized = shown.withColumn("n", F.length("rendered").cast("long")).withColumn("block", F.floor(F.coalesce("turn", F.lit(-1)) / BLOCK))
    view = ["no_id", "conv", "perspective"]
    ahead = W.partitionBy(*view).orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    offsets = sized.groupBy(*view, "block").agg(F.sum("n").alias("size")).select(*view, "block", F.coalesce(F.sum("size").over(ahead), F.lit(0)).alias("offset"))
    inside = W.partitionBy(*view, "block").orderBy(F.col("turn").asc_nulls_first(), "speaker", "said").rowsBetween(W.unboundedPreceding, 0)
    placed = sized.withColumn("end", F.sum("n").over(inside)).join(offsets, [*view, "block"])
    begin = F.col("offset") + F.col("end") - F.col("n")
    learns = F.col("role") == "assistant"
    return placed.select(
        F.when(~F.col("no_id"), F.col("conv")).alias("conv_id"), "perspective", "turn", "speaker", "role",
        F.when(F.col("role") == "user", F.col("speaker")).alias("name"), "rendered",
        begin.alias("begin"), (F.col("offset") + F.col("end")).alias("end"),
        F.when(learns, begin + F.length("header")).alias("mask_begin"), F.when(learns, F.col("offset") + F.col("end") - 1).alias("mask_end"),
    )


#: The same in DuckDB.
ROTATE_SQL = """
WITH said AS (
    SELECT conv_id, turn, coalesce(role, 'unknown') AS speaker, coalesce(text, '') AS said FROM conversations
), views AS (
    SELECT DISTINCT conv_id, speaker AS perspective FROM said WHERE speaker <> 'system'
), shown AS (
    SELECT s.*, v.perspective,
           CASE WHEN speaker = 'system' THEN 'system' WHEN speaker = perspective THEN 'assistant' ELSE 'user' END AS role
    FROM said s JOIN views v ON s.conv_id IS NOT DISTINCT FROM v.conv_id
), headed AS (
    SELECT *, '<|' || role || CASE WHEN role = 'user' THEN ' name=' || speaker ELSE '' END || '|>' || chr(10) AS header FROM shown
), rendered AS (
    SELECT *, header || said || chr(10) || '<|end|>' || chr(10) AS rendered FROM headed
), placed AS (
    SELECT *, CAST(sum(length(rendered)) OVER (PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, speaker, said ROWS UNBOUNDED PRECEDING) AS BIGINT) AS "end"
    FROM rendered
)
SELECT conv_id, perspective, turn, speaker, role, CASE WHEN role = 'user' THEN speaker END AS name, rendered,
       "end" - length(rendered) AS "begin", "end",
       CASE WHEN role = 'assistant' THEN "end" - length(rendered) + length(header) END AS mask_begin,
       CASE WHEN role = 'assistant' THEN "end" - 1 END AS mask_end
FROM placed
"""
