"""Collection index: the dataset -> resource map, per-resource endpoints,
organisations and start date, the resource index and daily log refresh."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.functions.scalar import split_words


def dataset_resource_map(log: DataFrame, source: DataFrame) -> DataFrame:
    """(dataset, resource), long form: a resource fetched from an endpoint
    belongs to every dataset (pipeline) of that endpoint's sources."""
    ep = source.select("endpoint", F.explode(split_words(F.regexp_replace("pipelines", ";", " ")))
                       .alias("dataset"))
    fetched = log.where(F.col("resource").isNotNull()).select("endpoint", "resource").distinct()
    return fetched.join(ep, "endpoint").select("dataset", "resource").distinct()


def resource_lists(dataset_resources: DataFrame) -> DataFrame:
    """dataset -> ordered list of resources, as long rows (dataset, pos,
    resource) with ``pos`` the 0-based place in the dataset's sorted list.

    No list is built in one row: positions come from the distributed global
    numbering minus each dataset's first position (one small row per
    dataset), so a dataset holding a third of all resources is still spread
    over many tasks."""
    from gleaner.operators.selection import number_rows
    pairs = dataset_resources.select("dataset", "resource").distinct()
    positioned, _ = number_rows(pairs, ["dataset", "resource"])
    first = positioned.groupBy("dataset").agg(F.min("position").alias("_first"))
    return positioned.join(first, "dataset").select(
        "dataset", (F.col("position") - F.col("_first")).alias("pos"), "resource")


def join_list(col: str, sep: str = " "):
    """Aggregate expression: distinct values, sorted, joined by ``sep``."""
    return F.array_join(F.sort_array(F.collect_set(col)), sep)


def _fetches(log: DataFrame, source: DataFrame) -> DataFrame:
    """One row per (resource, endpoint) with its first and last day, joined
    to the endpoint's sources. The pre-aggregation means a resource fetched
    a huge number of times ships each endpoint once, not each log line."""
    per = (log.where(F.col("resource").isNotNull())
           .groupBy("resource", "endpoint")
           .agg(F.min("entry_date").alias("_first"), F.max("entry_date").alias("_last")))
    return per.join(source.select("endpoint", "organisation", "pipelines"), "endpoint", "left")


def resource_enrichment(log: DataFrame, source: DataFrame) -> DataFrame:
    """Per resource: space-joined endpoints, space-joined organisations and
    the start date (first day it was collected)."""
    return _fetches(log, source).groupBy("resource").agg(
        F.min("_first").alias("start_date"),
        join_list("endpoint").alias("endpoints"),
        join_list("organisation").alias("organisations"))


def enrich_pairs(tasks: DataFrame, enrichment: DataFrame, key: str = "old_resource") -> DataFrame:
    """Left-join the per-resource lookups by the *listed* (old) resource id;
    missing lookups give empty text and a NULL date."""
    e = enrichment.withColumnRenamed("resource", "_er")
    out = tasks.join(e, tasks[key] == e["_er"], "left").drop("_er")
    return (out.withColumn("endpoints", F.coalesce("endpoints", F.lit("")))
               .withColumn("organisations", F.coalesce("organisations", F.lit("")))
               .withColumn("entry_date", F.date_format("start_date", "yyyy-MM-dd"))
               .drop("start_date"))


def resource_index(log: DataFrame, source: DataFrame) -> DataFrame:
    """resource.csv: one row per resource with first/last collection day and
    the endpoints, organisations and datasets it came from."""
    return _fetches(log, source).groupBy("resource").agg(
        F.min("_first").alias("start_date"), F.max("_last").alias("end_date"),
        join_list("endpoint", ";").alias("endpoints"),
        join_list("organisation", ";").alias("organisations"),
        F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_set(
            split_words(F.regexp_replace("pipelines", ";", " ")))))), ";").alias("datasets"))


def refill_today(log_index: DataFrame, todays_log: DataFrame, today) -> DataFrame:
    """Keep the stored log rows of earlier days and replace today's rows with
    a fresh read of today's partition."""
    return (log_index.where(F.col("entry_date") < F.lit(today).cast("date"))
            .unionByName(todays_log.where(F.col("entry_date") == F.lit(today).cast("date"))))


def collection_datasets(spec_dataset: DataFrame, collection: str) -> DataFrame:
    """Datasets of the specification whose collection is ``collection``
    (matched by column name, not by position)."""
    return spec_dataset.where(F.col("collection") == collection).select("dataset").distinct()


def require_nonempty(df: DataFrame, what: str) -> None:
    """Fail when an input has no rows (a bounded check: one row is read)."""
    if df.isEmpty():
        raise ValueError(f"No {what} found")
