"""Mixing sources to target weights by hash-threshold histograms.

Each source may take at most ``max_repeat`` times its size; targets share the
total by weight, the excess of capped sources reshared by weight. A source
with target ``t`` and size ``s`` takes every document ``t // s`` times, and once
more the documents whose hash is at or below a threshold. The threshold is
found without sorting documents: sizes are summed by (source, 12-bit hash
bucket), the bucket in which the budget runs out is found, and only that
bucket is summed again by the next 12 bits, five times in all; so a source
never has more than 4096 sums, whatever its size. Thresholds are
nested: a larger budget takes a superset.

Defined results: NULL text has size 0; a NULL source is one source, last in
order; a NULL ``doc_id`` hashes as the text ``null``; rows with the same
``doc_id`` in a source share a hash and are taken together; an empty table
gives an empty result; other columns of the input pass through unchanged when
asked for, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleaner.llm.common import private_names, read_table, split_words, write_out

WEIGHTS = (1, 2, 3)
MAX_REPEAT = 3
_DIGIT = 3  # hex digits of each refinement
_LEVELS = 5
_EXACT = "decimal(38,0)"


def hash_position(doc_id: Column) -> Column:
    """60-bit position of a document in its source's fixed random order."""
    digest = F.md5(F.coalesce(doc_id.cast("string"), F.lit("null")))
    return F.conv(F.substring(digest, 1, _DIGIT * _LEVELS), 16, 10).cast("long")


def source_targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """(source, source_size) -> + target. One row per source.

    Sources are ordered by code point, NULL last, and weigh ``weights`` in
    turn. A source is capped when its cap over its weight is below the level
    that the sources not yet capped would get; comparisons are exact."""
    by_name = Window.partitionBy(F.lit(0)).orderBy(F.col("source").isNull(), "source")
    n = len(weights)
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), ((F.row_number().over(by_name) - 1) % n + 1).cast("int"))
    x = sources.select("source", F.col("source_size").cast(_EXACT).alias("size"), w.cast("long").alias("w"))
    x = x.withColumn("cap", F.col("size") * F.lit(max_repeat).cast(_EXACT))
    order = Window.partitionBy(F.lit(0)).orderBy(F.col("size").cast("double") / F.col("w"), F.col("source").isNull(), "source")
    whole = Window.partitionBy(F.lit(0))
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    x = x.select(
        "source", "size", "w", "cap",
        (F.sum("size").over(whole) - F.coalesce(F.sum("cap").over(earlier), F.lit(0))).cast(_EXACT).alias("left_size"),
        (F.sum("w").over(whole) - F.coalesce(F.sum("w").over(earlier), F.lit(0))).alias("left_w"),
        F.row_number().over(order).alias("i"))
    x = x.withColumn("capped", F.col("cap").cast("double") * F.col("left_w") < F.col("left_size").cast("double") * F.col("w"))
    # capped sources come first in this order; the first that is not capped sets the level
    x = x.withColumn("first_free", F.min(F.when(~F.col("capped"), F.struct("i", "left_size", "left_w"))).over(whole))
    free = F.col("i") >= F.col("first_free.i")
    target = F.when(free, F.col("first_free.left_size").cast("double") * F.col("w") / F.col("first_free.left_w")).otherwise(F.col("cap").cast("double"))
    return x.select("source", F.col("size").cast("long").alias("source_size"), F.coalesce(target, F.lit(0.0)).alias("target"))


def hash_thresholds(sized: DataFrame, budgets: DataFrame) -> DataFrame:
    """(source, at): the position up to which documents of a source come
    nearest to its budget; -1 takes none.

    sized: (source, position, size); budgets: (source, budget double)."""
    n = budgets.count()
    # what is taken for sure, and the prefix in which the budget runs out
    state = write_out(budgets.select("source", "budget", F.lit(0).cast(_EXACT).alias("below"), F.lit(0).cast("long").alias("prefix")))
    for level in range(_LEVELS):
        last = level == _LEVELS - 1
        rest = _DIGIT * 4 * (_LEVELS - 1 - level)
        here = F.shiftright("position", rest) if rest else F.col("position")
        rows = sized.select(F.col("source").alias("src"), here.alias("bucket"), "size")
        if level:  # only the boundary bucket is summed again
            inside = state.select(F.col("source").alias("src0"), F.col("prefix").alias("p0"))
            rows = rows.join(inside, F.col("src").eqNullSafe(F.col("src0")) & (F.shiftright("bucket", _DIGIT * 4) == F.col("p0")), "left_semi")
        sums = rows.groupBy("src", "bucket").agg(F.sum("size").cast(_EXACT).alias("size"))
        run = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
        joined = state.join(sums, state["source"].eqNullSafe(sums["src"]), "left").select(
            "source", "budget", "below", "prefix", "bucket", F.coalesce("size", F.lit(0)).cast(_EXACT).alias("size"))
        joined = joined.withColumn("upto", (F.col("below") + F.sum("size").over(run)).cast(_EXACT))
        over = F.col("upto").cast("double") > F.col("budget")
        # the first bucket that goes over the budget; a source that never does keeps its last one
        hit = F.coalesce(F.min(F.when(over, F.struct("bucket", "upto", "size"))), F.max(F.struct("bucket", "upto", "size"))).alias("hit")
        if not last:
            state = write_out(joined.groupBy("source").agg(F.first("budget").alias("budget"), hit, F.first("prefix").alias("old")).select(
                "source", "budget", (F.col("hit.upto") - F.col("hit.size")).cast(_EXACT).alias("below"),
                F.coalesce("hit.bucket", "old").alias("prefix")), n)
        else:
            done = joined.groupBy("source").agg(F.first("budget").alias("budget"), hit)
            above = F.col("hit.upto").cast("double") - F.col("budget")
            under = F.col("budget") - (F.col("hit.upto") - F.col("hit.size")).cast("double")
            at = F.when(above < under, F.col("hit.bucket")).otherwise(F.col("hit.bucket") - 1)
            state = done.select("source", F.coalesce(F.when(F.col("budget") > 0, at), F.lit(-1)).cast("long").alias("at"))
    return state


def mix_sources(docs: DataFrame, weights: Sequence[int] = WEIGHTS, max_repeat: int = MAX_REPEAT,
                keep_columns: bool = False) -> DataFrame:
    """One row per input row: doc_id, size, source_size, target, copies, taken.

    ``taken`` is ``size * copies``; ``copies`` is at most ``max_repeat``. With
    ``keep_columns`` the input's columns come first and clashing result names
    get a leading underscore."""
    size = F.size(split_words(F.col("text"))).cast("long")
    result = ["size", "source_size", "target", "copies", "taken"]
    names = private_names(docs.columns if keep_columns else ["doc_id", "source"], [*result, "plan"])
    at = names["plan"]
    if keep_columns:
        base = docs.withColumn(names["size"], size).withColumn(names["taken"], hash_position(F.col("doc_id")))
        sized = base.select("source", F.col(names["size"]).alias("size"), F.col(names["taken"]).alias("position"))
        sized = write_out(sized)
    else:
        base = write_out(docs.select("doc_id", "source", size.alias("size"), hash_position(F.col("doc_id")).alias("taken")))
        sized = base.select("source", "size", F.col("taken").alias("position"))
    targets = write_out(source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, max_repeat))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    budgets = targets.select("source", F.when(whole >= max_repeat, F.lit(0.0)).otherwise(F.col("target") - whole * F.col("source_size")).alias("budget"))
    plan = targets.withColumn("whole", F.least(whole, F.lit(max_repeat)))
    marks = hash_thresholds(sized, budgets)
    plan = plan.join(marks, plan["source"].eqNullSafe(marks["source"]), "left").select(
        F.struct(plan["source"].alias("s"), "source_size", "target", "whole", "at").alias(at))
    joined = base.join(plan, base["source"].eqNullSafe(F.col(f"{at}.s")), "left")
    copies = (F.col(f"{at}.whole") + F.when(F.col(names["taken"]) <= F.col(f"{at}.at"), 1).otherwise(0)).cast("long")
    kept = docs.columns if keep_columns else ["doc_id"]
    return joined.select(
        *[base[c] for c in kept], F.col(names["size"]), F.col(f"{at}.source_size").alias(names["source_size"]),
        F.col(f"{at}.target").alias(names["target"]), copies.alias(names["copies"]),
        (F.col(names["size"]) * copies).alias(names["taken"]))


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, size, source_size, target, taken over all documents."""
    return mix_sources(read_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


OP6_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> ''))::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null')), 1, 15))::BIGINT AS position
  FROM documents),
s AS (SELECT source, sum(size)::HUGEINT AS size FROM d GROUP BY source),
w AS (SELECT *, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT AS w FROM s),
o AS (SELECT *, size * 3 AS cap, row_number() OVER (ORDER BY size::DOUBLE / w, source NULLS LAST) AS i FROM w),
c AS (SELECT *, sum(size) OVER () - coalesce(sum(cap) OVER (ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ls,
             sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lw FROM o),
f AS (SELECT min(i) AS i FROM c WHERE NOT (cap::DOUBLE * lw::DOUBLE < ls::DOUBLE * w)),
t AS (SELECT c.source, c.size::BIGINT AS source_size,
             coalesce(CASE WHEN c.i >= f.i THEN (SELECT ls::DOUBLE FROM c c2 WHERE c2.i = f.i) * c.w / (SELECT lw::DOUBLE FROM c c2 WHERE c2.i = f.i)
                           ELSE c.cap::DOUBLE END, 0.0) AS target FROM c, f),
b AS (SELECT *, CASE WHEN source_size > 0 THEN least(floor(target / source_size), 3) ELSE 0 END::BIGINT AS whole FROM t),
g AS (SELECT *, CASE WHEN whole >= 3 THEN 0.0 ELSE target - whole * source_size END AS budget FROM b),
p AS (SELECT source, position, sum(size) AS size FROM d GROUP BY source, position),
r AS (SELECT p.*, g.budget, sum(p.size) OVER (PARTITION BY p.source ORDER BY p.position) AS upto FROM p JOIN g ON p.source IS NOT DISTINCT FROM g.source),
k AS (SELECT source, budget, coalesce(min(CASE WHEN upto::DOUBLE > budget THEN {'a': position, 'b': upto, 'c': size} END),
                                      max({'a': position, 'b': upto, 'c': size})) AS hit FROM r GROUP BY source, budget),
m AS (SELECT source, CASE WHEN budget > 0 THEN CASE WHEN hit.b::DOUBLE - budget < budget - (hit.b - hit.c)::DOUBLE THEN hit.a ELSE hit.a - 1 END ELSE -1 END AS at FROM k)
SELECT d.doc_id, d.size, g.source_size, g.target,
       (d.size * (g.whole + CASE WHEN d.position <= m.at THEN 1 ELSE 0 END))::BIGINT AS taken
FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source JOIN m ON d.source IS NOT DISTINCT FROM m.source
"""
