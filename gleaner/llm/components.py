"""Connected components of a distributed graph, in DataFrame operations.

Alternating large-star / small-star steps: every step is one aggregation (with
map-side combine) and one equi-join on the node, so a hub with very many
neighbours is pre-aggregated for its minimum and its join partition can be
split by the adaptive planner. Links never reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.llm.common import write_out


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over edges (a, b) with a > b.

    large: every node links its larger neighbours to the least of itself and
    its neighbours; small: its smaller neighbours and itself."""
    if large:
        near = edges.select(F.col("b").alias("u"), F.col("a").alias("v")).unionAll(
            edges.select(F.col("a").alias("u"), F.col("b").alias("v")))
    else:
        near = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = near.join(least, "u")
    if large:
        out = joined.filter(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).unionAll(
            least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.filter(F.col("a") > F.col("b")).distinct()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", links: int | None = None) -> DataFrame:
    """(node, component) for every node that has a link; the component is its
    least node. NULL ends, loops and repeated links count for nothing.

    Steps repeat until two rounds give the same links (about log2 of the
    longest path); each round is written to the shared checkpoint folder, in
    parts by the number of its links (``links``: about how many come in)."""
    now = write_out(
        edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"), F.col(a).alias("x"), F.col(b).alias("y"))
        .filter("x is not null and y is not null and x <> y").select("a", "b").distinct(), links)
    mark = None
    while True:
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(seen) == mark or seen[0] == 0:
            break
        mark = tuple(seen)
        now = write_out(_star(_star(now, large=True), large=False), seen[0])
    nodes = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.unionAll(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
