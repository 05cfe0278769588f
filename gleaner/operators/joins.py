"""Range join: match a key against inclusive [lo, hi] ranges.

Spark has no native range join and a plain non-equi join becomes a nested
loop. Here the join is an equi-join on (level, bucket) plus the range
predicate, so it shuffles (or broadcasts, when AQE sees a small side) like
any hash join:

* bucket widths form levels ``w0, w0*f, w0*f^2, ...`` up to the widest
  range; each range is placed on the lowest level whose width covers it,
  so it spans at most two buckets there;
* each key probes its bucket on every level (one row per level).

The work per key is bounded by the number of levels (logarithmic in the
ratio of the widest to the narrowest range) and a wide range never drags
narrow ones into its bucket.
"""

from __future__ import annotations


from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _levels(ranges: DataFrame, lo: str, hi: str, fanout: int) -> list[int]:
    """Bucket widths per level, from one global aggregate (a single row)."""
    r = ranges.agg(F.min(F.col(hi) - F.col(lo) + 1).alias("mn"),
                   F.max(F.col(hi) - F.col(lo) + 1).alias("mx")).first()
    mn, mx = max(int(r["mn"] or 1), 1), max(int(r["mx"] or 1), 1)
    widths = [mn]
    while widths[-1] < mx:
        widths.append(widths[-1] * fanout)
    return widths


def range_join(left: DataFrame, key: str, ranges: DataFrame, lo: str = "entity_minimum",
               hi: str = "entity_maximum", how: str = "inner", fanout: int = 16,
               widths: list[int] | None = None) -> DataFrame:
    """Rows of ``left`` with every range containing ``left[key]``
    (``how='left'`` also keeps keys no range contains, with NULL range
    columns)."""
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    ws = widths or _levels(ranges, lo, hi, fanout)
    warr = F.array(*[F.lit(w).cast("bigint") for w in ws])
    width = F.col(hi) - F.col(lo) + 1
    # each range on the lowest level whose bucket width covers it
    r = ranges.withColumn("_rl", _level_of(width, ws))
    bw = F.element_at(warr, F.col("_rl") + 1)
    r = r.withColumn("_rb", F.explode(F.sequence(F.floor(F.col(lo) / bw).cast("bigint"),
                                                 F.floor(F.col(hi) / bw).cast("bigint"))))
    probes = F.array(*[F.struct(F.lit(i).alias("l"), F.floor(F.col(key) / w).cast("bigint").alias("b"))
                       for i, w in enumerate(ws)])
    lft = left.withColumn("_p", F.explode(probes))
    cond = ((lft["_p"]["l"] == r["_rl"]) & (lft["_p"]["b"] == r["_rb"])
            & lft[key].between(r[lo], r[hi]))
    matched = lft.join(r, cond, "inner").drop("_p", "_rl", "_rb")
    if how == "inner":
        return matched
    hit_keys = matched.select(F.col(key).alias("_hk")).distinct()
    missing = left.join(hit_keys, left[key] == hit_keys["_hk"], "left_anti")
    for f in ranges.schema.fields:
        if f.name not in missing.columns:
            missing = missing.withColumn(f.name, F.lit(None).cast(f.dataType))
    return matched.unionByName(missing.select(*matched.columns))


def _level_of(width, ws: list[int]):
    """Index of the lowest width in ``ws`` that is >= ``width``."""
    lvl = F.lit(len(ws) - 1)
    for i in range(len(ws) - 2, -1, -1):
        lvl = F.when(width <= ws[i], F.lit(i)).otherwise(lvl)
    return lvl

