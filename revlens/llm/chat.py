"""Chat formatting: multi-party perspective rotation (operator 4). DataFrame functions only.

Every speaker of a conversation but ``system`` is a participant. For each of
them the whole dialogue is rendered with that speaker as assistant, all other
speakers as users named by their role, and system messages as they are. The
mask lists the code-point ranges of the assistant's own texts.

A dialogue is rendered in segments of at most ``SEGMENT`` messages, so no task
gathers a conversation of unbounded length; ``text_offset`` is where a segment
stands in the dialogue, and mask ranges count from the segment's start. Joining
the segments of a dialogue in order gives its whole text. Offsets are summed
over the segments' sizes alone; no text passes that window.

Defined results: messages are in order of turn, role and text, nulls first; a
null text is empty, a null role is the speaker ``unknown``; messages without a
conv_id form one conversation of null id; repeated rows are rendered each; a
conversation without a participant has no rows; an empty table gives an empty
result; further columns are never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import table

SEGMENT = 128


def _segment(column: str) -> Column:
    """Never null, so that no null filter keeps the two readers of a shuffle apart."""
    return F.coalesce(F.floor(F.col(column) / SEGMENT), F.lit(0))


def perspectives(messages: DataFrame) -> DataFrame:
    """conv_id, perspective, segment, n_messages, n_own, rendered, mask, n_chars and text_offset."""
    # A struct is never null, and structs of null are equal.
    rows = messages.select(
        F.struct("conv_id").alias("conv"), F.coalesce(F.col("turn").cast("long"), F.lit(-1)).alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("unknown")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).withColumn("part", _segment("turn"))
    # Parts hold messages of neighbouring turns; repeated turns can make a part long, so it is cut again by rank.
    rank = F.row_number().over(Window.partitionBy("conv", "part").orderBy("turn", "role", "text")) - 1
    ranked = rows.withColumn("rank", rank).withColumn("piece", _segment("rank"))
    speakers = rows.where("role <> 'system'").select("conv", F.col("role").alias("perspective")).distinct()
    own = F.col("role") == F.col("perspective")
    head = F.when(F.col("role") == "system", "<|system|>\n").when(own, "<|assistant|>\n").otherwise(F.concat(F.lit("<|user name="), "role", F.lit("|>\n")))
    turns = ranked.join(speakers, "conv").select(
        "conv", "perspective", "part", "piece", "rank", own.alias("own"), head.alias("head"), "text", F.concat(head, "text", F.lit("<|end|>\n")).alias("line"))
    key = ["conv", "perspective", "part", "piece"]
    listed = turns.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("rank", "own", "head", "text", "line"))).alias("lines"))
    # Where each line starts, from the lines before it; at most SEGMENT lines.
    size = F.length(F.array_join(F.transform("lines", lambda x: x["line"]), ""))
    start = F.aggregate(
        "lines", F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("mask")),
        lambda a, x: F.struct(
            (a["at"] + F.length(x["line"])).alias("at"),
            F.when(x["own"], F.array_append(a["mask"], F.concat_ws(":", (a["at"] + F.length(x["head"])).cast("string"), (a["at"] + F.length(x["head"]) + F.length(x["text"])).cast("string")))).otherwise(a["mask"]).alias("mask"),
        ),
    )
    out = listed.select(
        *key, F.size("lines").cast("long").alias("n_messages"), F.size(F.filter("lines", lambda x: x["own"])).cast("long").alias("n_own"),
        F.array_join(F.transform("lines", lambda x: x["line"]), "").alias("rendered"), F.array_join(start["mask"], ",").alias("mask"), size.cast("long").alias("n_chars"),
    )
    order = Window.partitionBy("conv", "perspective").orderBy("part", "piece")
    places = out.select(
        *key, (F.row_number().over(order) - 1).cast("long").alias("segment"),
        (F.sum("n_chars").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n_chars")).cast("long").alias("text_offset"),
    )
    return out.join(places, key).select("conv.conv_id", "perspective", "segment", "n_messages", "n_own", "rendered", "mask", "n_chars", "text_offset")


def query(spark, sf_dir: str) -> DataFrame:
    return perspectives(table(spark, sf_dir, "conversations"))


SQL = f"""
WITH m AS (
  SELECT conv_id, coalesce(CAST(turn AS BIGINT), -1) AS turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations),
r AS (
  SELECT *, CAST(floor(turn / {SEGMENT}) AS BIGINT) AS part,
         row_number() OVER (PARTITION BY conv_id, CAST(floor(turn / {SEGMENT}) AS BIGINT) ORDER BY turn, role, text) - 1 AS rk FROM m),
s AS (SELECT DISTINCT conv_id, role AS perspective FROM m WHERE role <> 'system'),
t AS (
  SELECT r.conv_id, s.perspective, part, rk // {SEGMENT} AS piece, rk, r.role = s.perspective AS own, text,
         CASE WHEN r.role = 'system' THEN '<|system|>' WHEN r.role = s.perspective THEN '<|assistant|>'
              ELSE '<|user name=' || r.role || '|>' END || chr(10) AS head
  FROM r JOIN s ON r.conv_id IS NOT DISTINCT FROM s.conv_id),
l AS (
  SELECT *, head || text || '<|end|>' || chr(10) AS line,
         coalesce(sum(length(head || text || '<|end|>' || chr(10))) OVER (
           PARTITION BY conv_id, perspective, part, piece ORDER BY rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos
  FROM t),
g AS (
  SELECT conv_id, perspective, part, piece, count(*) AS n_messages, count(*) FILTER (own) AS n_own,
         string_agg(line, '' ORDER BY rk) AS rendered,
         coalesce(string_agg(CAST(pos + length(head) AS BIGINT) || ':' || CAST(pos + length(head) + length(text) AS BIGINT), ',' ORDER BY rk) FILTER (own), '') AS mask,
         CAST(sum(length(line)) AS BIGINT) AS n_chars
  FROM l GROUP BY conv_id, perspective, part, piece)
SELECT conv_id, perspective, row_number() OVER w - 1 AS segment, n_messages, n_own, rendered, mask, n_chars,
       CAST(sum(n_chars) OVER (w ROWS UNBOUNDED PRECEDING) - n_chars AS BIGINT) AS text_offset
FROM g WINDOW w AS (PARTITION BY conv_id, perspective ORDER BY part, piece)"""
