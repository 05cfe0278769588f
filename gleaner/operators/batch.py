"""Batch transform with error capture.

The built-in phases are set-based and never fail a batch on bad rows (they
use try_* casts and issue rows). This module is for *user* callbacks that
must run per resource: the callback gets all rows of one resource, and a
failure becomes a result row for that resource instead of failing the task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import groupby

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import _parse_datatype_string

from gleaner.session import reliable_checkpoint

RESULT_SCHEMA = "resource string, ok boolean, rows bigint, error string"


def run_with_errors(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame],
                    key: str = "resource") -> DataFrame:
    """One row per resource (a NULL one included): ok and the number of rows
    the callback returned, or the error text. The callback needs a whole
    resource at once, so a resource must fit in a task's memory; jobs whose
    work is row by row use the phases instead."""
    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        res = pdf[key].iloc[0]
        try:
            out = (res, True, int(len(fn(pdf))), None)
        except Exception as e:  # noqa: BLE001 - errors become rows
            out = (res, False, 0, f"{type(e).__name__}: {e}")
        return pd.DataFrame([out], columns=["resource", "ok", "rows", "error"])

    return df.groupBy(key).applyInPandas(one, RESULT_SCHEMA)


class _InputFailed(Exception):
    """Reading the input failed: the task's fault, not the callback's."""


def _pieces(batches: Iterator[pd.DataFrame], key: str) -> Iterator[tuple[object, pd.DataFrame]]:
    """Batches cut where the key changes."""
    batches = iter(batches)
    while True:
        try:
            batch = next(batches)
        except StopIteration:
            return
        except Exception as e:
            raise _InputFailed from e
        keys = batch[key].astype(object).where(batch[key].notna(), None)
        cuts = [0, *(i for i in range(1, len(keys)) if keys.iloc[i] != keys.iloc[i - 1]), len(keys)]
        for a, b in zip(cuts, cuts[1:]):
            if a < b:
                yield keys.iloc[a], batch.iloc[a:b].reset_index(drop=True)


def run_streamed(df: DataFrame, fn: Callable[[object, Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema: str,
                 key: str = "resource", order: str = "entry_number") -> tuple[DataFrame, DataFrame]:
    """(rows, results) of ``fn(resource, pieces)`` run for every resource (a
    NULL one included): ``pieces`` are the resource's rows in ``order``, a
    batch at a time, so a resource never has to fit in memory. ``rows`` holds
    what the callbacks yielded (columns of ``schema``) for resources that did
    not fail; ``results`` a row per resource: ok, the number of rows, the error
    text. A failure costs that resource alone. The output is stored once in
    the shared checkpoint folder and both tables read it."""
    names = [f.name for f in _parse_datatype_string(schema).fields]

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def result(resource, ok, rows, error):
            return pd.DataFrame([[resource, ok, rows, error] + [None] * len(names)], columns=["_key", "_ok", "_rows", "_error", *names], dtype=object)

        for resource, group in groupby(_pieces(batches, key), lambda p: p[0]):
            rows = 0
            try:
                for out in fn(resource, (piece for _k, piece in group)):
                    rows += len(out)
                    head = pd.DataFrame({"_key": [resource] * len(out), "_ok": None, "_rows": None, "_error": None}, dtype=object)
                    yield pd.concat([head, out[names].reset_index(drop=True)], axis=1)
            except _InputFailed:
                raise
            except Exception as e:  # noqa: BLE001 - errors become rows
                yield result(resource, False, 0, f"{type(e).__name__}: {e}")
            else:
                yield result(resource, True, rows, None)

    dealt = df.withColumn(key, F.col(key).cast("string")).repartition(key).sortWithinPartitions(key, order)
    stored = reliable_checkpoint(dealt.mapInPandas(work, f"_key string, _ok boolean, _rows bigint, _error string, {schema}"))
    results = stored.where(F.col("_ok").isNotNull()).select(F.col("_key").alias("resource"), F.col("_ok").alias("ok"), F.col("_rows").alias("rows"), F.col("_error").alias("error"))
    failed = results.where(~F.col("ok")).select(F.col("resource").alias("_failed"))
    rows = stored.where(F.col("_ok").isNull()).join(failed, F.col("_key").eqNullSafe(F.col("_failed")), "left_anti")
    return rows.select(*names), results


def summarise_results(results: DataFrame) -> DataFrame:
    """successful / failed counts in one pass."""
    return results.agg(F.count_if("ok").alias("successful"), F.count_if(~F.col("ok")).alias("failed"))


def failed_resources(results: DataFrame) -> DataFrame:
    return results.where(~F.col("ok")).select("resource", "error")
