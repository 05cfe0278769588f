"""Cumulative-snapshot collapse of logged conversations, in DataFrame
operations only.

A conversation's turns, in order, get a rolling prefix hash: the exclusive or
of 128-bit hashes of (position, role, text). A conversation whose whole hash is
a proper prefix hash of another one is a snapshot of it and goes; of equal
conversations the least id stays. What is left is rendered turn by turn.

Long conversations are split: turns are ranked inside blocks of ``BLOCK`` turn
numbers and block totals carry ranks and hashes over, so no task needs a whole
conversation. Prefix hashes are made distinct before the anti-join, so a first
turn that very many share is one row.

Defined results: turns sort by turn, then role, then text, NULL last; equal
rows of a conversation count once; NULL role or text differs from the empty
one and renders as empty; a NULL ``conv_id`` is one conversation; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleaner.llm.common import fill_null, read_table, write_out

BLOCK = 256


def _turn_order() -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in ("turn", "role", "text")]


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) -> + position (from 1), n_turns, x1, x2: the
    rolling hash up to the row, as two numbers."""
    x = turns.select("conv_id", "turn", "role", "text").distinct()
    x = x.withColumn("block", F.floor(F.col("turn") / BLOCK))
    inside = Window.partitionBy("conv_id", "block").orderBy(*_turn_order())
    x = x.withColumn("rank", F.row_number().over(inside))
    before = Window.partitionBy("conv_id").orderBy(F.col("block").asc_nulls_last())
    earlier = before.rowsBetween(Window.unboundedPreceding, -1)
    sizes = x.groupBy("conv_id", "block").agg(F.count("*").alias("n")).select(
        F.col("conv_id").alias("c"), F.col("block").alias("b"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"),
        F.sum("n").over(Window.partitionBy("conv_id")).alias("n_turns"))
    same = x["conv_id"].eqNullSafe(F.col("c")) & x["block"].eqNullSafe(F.col("b"))
    x = x.join(sizes, same).withColumn("position", F.col("offset") + F.col("rank")).drop("c", "b", "offset", "rank")
    parts = ["position", F.col("role").isNull(), "role", F.col("text").isNull(), "text"]
    x = x.withColumns({"t1": F.xxhash64(F.lit(1), *parts), "t2": F.xxhash64(F.lit(2), *parts)})
    by_position = Window.partitionBy("conv_id", "block").orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    x = write_out(x.withColumns({"x1": F.expr("bit_xor(t1)").over(by_position), "x2": F.expr("bit_xor(t2)").over(by_position)}).drop("t1", "t2"))
    totals = x.groupBy("conv_id", "block").agg(F.max_by(F.struct("x1", "x2"), "position").alias("t"))
    carried = totals.select(F.col("conv_id").alias("c"), F.col("block").alias("b"),
                            F.coalesce(F.expr("bit_xor(t.x1)").over(earlier), F.lit(0).cast("long")).alias("o1"),
                            F.coalesce(F.expr("bit_xor(t.x2)").over(earlier), F.lit(0).cast("long")).alias("o2"))
    same = x["conv_id"].eqNullSafe(F.col("c")) & x["block"].eqNullSafe(F.col("b"))
    return x.join(carried, same).select("conv_id", "turn", "role", "text", "position", "n_turns",
                                        F.col("x1").bitwiseXOR(F.col("o1")).alias("x1"), F.col("x2").bitwiseXOR(F.col("o2")).alias("x2"))


def maximal_conversations(hashed: DataFrame) -> DataFrame:
    """(conv_id, n_copies) of the conversations to keep; n_copies counts equal
    ones, itself included."""
    finals = hashed.filter("position = n_turns").groupBy("n_turns", "x1", "x2").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_copies"))
    prefixes = hashed.filter("position < n_turns").select(F.col("position").alias("p"), F.col("x1").alias("p1"), F.col("x2").alias("p2")).distinct()
    return finals.join(prefixes, (F.col("n_turns") == F.col("p")) & (F.col("x1") == F.col("p1")) & (F.col("x2") == F.col("p2")), "left_anti").select("conv_id", "n_copies")


def collapse_snapshots(turns: DataFrame) -> DataFrame:
    """conv_id, position, n_turns, n_copies, segment: the kept conversations,
    rendered; segments of a conversation in order of position make its text."""
    hashed = write_out(prefix_hashes(turns))
    kept = maximal_conversations(hashed).select(F.col("conv_id").alias("c"), "n_copies")
    segment = F.concat(F.lit("<|im_start|>"), fill_null(F.col("role")), F.lit("\n"), fill_null(F.col("text")), F.lit("<|im_end|>\n"))
    return hashed.join(kept, F.col("conv_id").eqNullSafe(F.col("c"))).select(
        "conv_id", F.col("position").cast("long").alias("position"), F.col("n_turns").cast("long").alias("n_turns"), "n_copies", segment.alias("segment"))


def op2_snapshot_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rendered turns of the maximal conversations."""
    return collapse_snapshots(read_table(spark, sf_dir, "conversations"))


OP2_SQL = r"""
WITH t AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations),
r AS (SELECT *, row_number() OVER w AS position, count(*) OVER (PARTITION BY conv_id) AS n_turns,
             string_agg(coalesce('r' || length(role) || ':' || role, 'n') || coalesce('t' || length(text) || ':' || text, 'n'), '|')
               OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, role NULLS LAST, text NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS prefix
      FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS LAST, role NULLS LAST, text NULLS LAST)),
f AS (SELECT n_turns, prefix, min(conv_id) AS conv_id, count(*) AS n_copies FROM r WHERE position = n_turns GROUP BY n_turns, prefix),
k AS (SELECT * FROM f WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.position < r.n_turns AND r.position = f.n_turns AND r.prefix = f.prefix))
SELECT r.conv_id, r.position::BIGINT AS position, r.n_turns::BIGINT AS n_turns, k.n_copies::BIGINT AS n_copies,
       '<|im_start|>' || coalesce(role, '') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10) AS segment
FROM r JOIN k ON r.conv_id IS NOT DISTINCT FROM k.conv_id
"""
