"""Chat formatting: the dialogue from every participant's point of view.

For each participant of a conversation the whole dialogue is rendered once,
with that speaker's turns as the assistant's and everyone else's as a user's
who goes by name. Turns of the system role keep that role and have no view
of their own. ``masks`` are the spans of the assistant's words, each with
its end marker: what a model is trained on in this view.

A view comes in parts of ``PART_TURNS`` turns; joined in order they are the
whole rendering, and usual dialogues are one part. So no task holds more
turns of a conversation than a part has, however long it is. Turns are put
in order by a range partitioning on (conversation, turn, role, text), which
splits a long conversation, and numbered by partition; only the counts of
the pieces are added up.

Defined results: repeated rows count once; different rows of one turn follow
each other by role, then text; a null role is called ``unknown``, a null text
is empty, a null turn comes first, rows without a conversation id are one
conversation; a dialogue of system turns alone has no view; marker signs
inside a text are broken by a backslash. An empty table gives an empty table.
Other columns are not used. Spans are code points of their part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gapscope.llm.common import let, read, stored

PART_TURNS = 64
SYSTEM, UNKNOWN = "system", "unknown"
BEGIN, END = "<|im_start|>", "<|im_end|>"


def numbered(turns: DataFrame) -> DataFrame:
    """(conv_id, at, role, text): distinct turns with their place in the dialogue, from 0."""
    order = ["conv_id", "turn", "role", "text"]
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit(UNKNOWN)).alias("role"), F.coalesce("text", F.lit("")).alias("text")).distinct()
    placed = stored(rows.repartitionByRange(*[F.col(c).asc_nulls_first() for c in order]).withColumn("piece", F.spark_partition_id()), "chat-turns")
    pieces = placed.groupBy("conv_id", "piece").count()
    before = Window.partitionBy("conv_id").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = pieces.select(F.col("conv_id").alias("c"), F.col("piece").alias("p"), F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    in_piece = Window.partitionBy("conv_id", "piece").orderBy(*[F.col(c).asc_nulls_first() for c in order])
    own = placed.withColumn("k", F.row_number().over(in_piece) - 1)
    return own.join(starts, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("piece") == F.col("p"))).select("conv_id", (F.col("start") + F.col("k")).alias("at"), "role", "text")


def safe(text: Column) -> Column:
    return F.replace(text, F.lit("<|"), F.lit("<\\|"))


def rendered(turns: Column, speaker: Column) -> Column:
    """struct(text, masks) of one part: an array of (at, role, text) in order."""
    def head(t: Column) -> Column:
        name = F.when(t["role"] == SYSTEM, F.lit(SYSTEM)).when(t["role"] == speaker, F.lit("assistant")).otherwise(F.concat(F.lit("user name="), safe(t["role"])))
        return F.concat(F.lit(BEGIN), name, F.lit("\n"))

    pieces = F.transform(turns, lambda t: F.struct(head(t).alias("head"), F.concat(safe(t["text"]), F.lit(END)).alias("body"), ((t["role"] == speaker) & (t["role"] != SYSTEM)).alias("own")))

    def step(state: Column, p: Column) -> Column:
        start = state["n"] + F.length(p["head"])
        end = start + F.length(p["body"])
        return F.struct((end + 1).alias("n"), F.when(p["own"], F.concat(state["masks"], F.array(F.struct(start.alias("start"), end.alias("end"))))).otherwise(state["masks"]).alias("masks"))

    zero = F.struct(F.lit(0).alias("n"), F.array().cast("array<struct<start:int,end:int>>").alias("masks"))
    return let(pieces, lambda ps: F.struct(
        F.concat(F.array_join(F.transform(ps, lambda p: F.concat(p["head"], p["body"])), "\n"), F.lit("\n")).alias("text"),
        F.aggregate(ps, zero, step, lambda s: s["masks"]).alias("masks")))


def views(turns: DataFrame) -> DataFrame:
    """(conv_id, speaker, part, n_turns, text, masks): every participant's rendering of every part."""
    lines = stored(numbered(turns), "chat-lines")
    parts = (
        lines.groupBy("conv_id", F.floor(F.col("at") / PART_TURNS).cast("int").alias("part"))
        .agg(F.array_sort(F.collect_list(F.struct("at", "role", "text"))).alias("turns"))  # at most PART_TURNS
    )
    speakers = lines.where(F.col("role") != SYSTEM).select(F.col("conv_id").alias("c"), F.col("role").alias("speaker")).distinct()
    both = parts.join(speakers, F.col("conv_id").eqNullSafe(F.col("c"))).withColumn("view", rendered(F.col("turns"), F.col("speaker")))
    return both.select("conv_id", "speaker", "part", F.size("turns").cast("long").alias("n_turns"), "view.text", "view.masks")


def op2_chat_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = F.array_join(F.transform("masks", lambda m: F.concat_ws(":", m["start"].cast("string"), m["end"].cast("string"))), ",")
    return views(read(spark, sf_dir, "conversations")).withColumn("masks", spans)


QUERIES = {"op2_chat_views": op2_chat_views}

ORACLE = {"op2_chat_views": r"""
WITH turns AS (SELECT DISTINCT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS place FROM turns),
seen AS (
  SELECT p.conv_id, s.speaker, CAST(p.place // 64 AS INTEGER) AS part, p.place, p.role = s.speaker AS own,
         '<|im_start|>' || CASE WHEN p.role = 'system' THEN 'system' WHEN p.role = s.speaker THEN 'assistant' ELSE 'user name=' || replace(p.role, '<|', '<\|') END || chr(10) AS head,
         replace(p.text, '<|', '<\|') || '<|im_end|>' AS body
  FROM placed p JOIN (SELECT DISTINCT conv_id, role AS speaker FROM turns WHERE role <> 'system') s ON p.conv_id IS NOT DISTINCT FROM s.conv_id),
ends AS (SELECT *, sum(length(head) + length(body) + 1) OVER (PARTITION BY conv_id, speaker, part ORDER BY place) - 1 AS e FROM seen)
SELECT conv_id, speaker, part, count(*) AS n_turns, string_agg(head || body || chr(10), '' ORDER BY place) AS text,
       coalesce(string_agg(CAST(e - length(body) AS VARCHAR) || ':' || CAST(e AS VARCHAR), ',' ORDER BY place) FILTER (WHERE own), '') AS masks
FROM ends GROUP BY conv_id, speaker, part
"""}
