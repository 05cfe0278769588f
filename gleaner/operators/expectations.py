"""Expectation checkpoint: assertions on a built dataset.

An expectation is (name, condition, min, max): the number of rows matching
the SQL condition must lie in [min, max] (a missing bound is open). All
expectations of a table are counted in **one** aggregation pass, whatever
their number, then turned into one result row each. The pass may be the one
that writes the table (:func:`watch_expectations`).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from gleaner.session import literal_df


def expectations_table(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return literal_df(spark, rows, "name string, condition string, min_count bigint, "
                                   "max_count bigint")


RESULT = "name string, condition string, matched bigint, min_count bigint, max_count bigint, passed boolean"


def _counters(exp: list[Row]) -> list[Column]:
    return [F.count_if(F.expr(f"coalesce(({e['condition']}), false)")).alias(f"_e{i}") for i, e in enumerate(exp)]


def _judged(out: DataFrame) -> DataFrame:
    ok_lo = F.col("min_count").isNull() | (F.col("matched") >= F.col("min_count"))
    ok_hi = F.col("max_count").isNull() | (F.col("matched") <= F.col("max_count"))
    return out.withColumn("passed", ok_lo & ok_hi)


def watch_expectations(df: DataFrame, expectations: DataFrame | None) -> tuple[DataFrame, Callable[[], tuple[int, DataFrame]]]:
    """The table, watched while some action (a write) reads it once, and a
    function that gives the number of its rows and the results of
    :func:`check_expectations` after that action, without another pass."""
    spark = df.sparkSession
    exp = expectations.collect() if expectations is not None else []
    seen = Observation()
    watched = df.observe(seen, F.count(F.lit(1)).alias("_rows"), *_counters(exp))

    def results() -> tuple[int, DataFrame]:
        counts = seen.get
        rows = [(e["name"], e["condition"], int(counts.get(f"_e{i}") or 0), e["min_count"], e["max_count"], None) for i, e in enumerate(exp)]
        found = literal_df(spark, rows, RESULT)
        return int(counts.get("_rows") or 0), _judged(found)

    return watched, results


def check_expectations(df: DataFrame, expectations: DataFrame) -> DataFrame:
    """(name, condition, matched, min_count, max_count, passed) per
    expectation. The expectation list is a small config (its conditions
    become expressions of one aggregation)."""
    exp = expectations.collect()
    aggs = _counters(exp)
    counted = df.agg(*aggs) if aggs else df.limit(0).agg(F.count(F.lit(1)).alias("_none"))
    rows = [F.struct(F.lit(e["name"]).alias("name"), F.lit(e["condition"]).alias("condition"),
                     F.col(f"_e{i}").cast("bigint").alias("matched"),
                     F.lit(e["min_count"]).cast("bigint").alias("min_count"),
                     F.lit(e["max_count"]).cast("bigint").alias("max_count"))
            for i, e in enumerate(exp)]
    if not rows:
        return expectations.limit(0).select("name", "condition").withColumn("matched", F.lit(0))
    out = counted.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    return _judged(out)
