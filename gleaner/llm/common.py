"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.session import reliable_checkpoint

#: A word is a maximal run of characters outside space and U+0009..U+000D.
WORD_GAP = r"[\x20\x09-\x0D]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows for which a stored table of known size gets a part, and the least parts it gets.
PART_ROWS = 10_000
LEAST_PARTS = 8


def write_out(df: DataFrame, rows: int | None = None, each: int = PART_ROWS) -> DataFrame:
    """Cut lineage through the shared checkpoint folder. A table of about
    ``rows`` rows is stored as a part for every ``each`` of them, never as more
    parts than it has: every file of a part costs requests to the store (on a
    local one, processes that set its rights)."""
    if rows is not None:
        df = df.coalesce(max(LEAST_PARTS, -(-rows // each)))
    return reliable_checkpoint(df)


#: Rows of ids that may be sent to every task; beyond it Spark plans the join.
FEW_IDS = 500_000


def broadcast_if_few(ids: DataFrame, limit: int = FEW_IDS) -> DataFrame:
    """``ids`` (a stored table of a few narrow columns) with a broadcast hint
    if it has at most ``limit`` rows, so that what it is joined to need not be
    shuffled; without one beyond that."""
    return F.broadcast(ids) if ids.count() <= limit else ids


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z alone; other letters stay as they are."""
    return F.translate(text, _UPPER, _UPPER.lower())


def split_words(text: Column) -> Column:
    """Words of a text, in order; NULL text has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WORD_GAP), lambda w: w != "")


def fill_null(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def null_safe_on(left: DataFrame, right: DataFrame, pairs: Iterable[tuple[str, str]]) -> Column:
    """Join condition in which NULL equals NULL."""
    cond = F.lit(True)
    for a, b in pairs:
        cond = cond & left[a].eqNullSafe(right[b])
    return cond


def private_names(columns: Sequence[str], wanted: Sequence[str]) -> dict[str, str]:
    """Names for helper columns that clash with none of ``columns``."""
    taken, out = {c.lower() for c in columns}, {}
    for name in wanted:
        new = name
        while new.lower() in taken:
            new = "_" + new
        taken.add(new.lower())
        out[name] = new
    return out
