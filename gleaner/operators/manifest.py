"""Fetch manifests: which remote objects to copy where, and how a fetch went.

The byte transfer itself is I/O (not built); these are the table operators
around it: location building, artefact fan-out, de-duplication, and
reconciliation of what was expected with what arrived.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.functions.scalar import resource_location

# The five artefact families stored per (dataset, resource),
# as (family, default directory, file extension), in their published order.
ARTEFACTS = [
    ("transformed", "transformed/", "parquet"),
    ("issue", "issue/", "csv"),
    ("column_field", "var/column-field/", "csv"),
    ("dataset_resource", "var/dataset-resource/", "csv"),
    ("converted_resource", "var/converted-resource/", "csv"),
]


def artefact_paths(pairs: DataFrame, artefacts=ARTEFACTS) -> DataFrame:
    """One row per (pair, artefact family): ``<dir><dataset>/<resource>.<ext>``.
    A generator (explode) in the same stage: no shuffle."""
    fams = F.array(*[
        F.struct(F.lit(i).alias("ordinal"), F.lit(name).alias("family"),
                 F.concat(F.lit(d), F.col("dataset"), F.lit("/"), F.col("resource"),
                          F.lit("." + ext)).alias("remote_path"))
        for i, (name, d, ext) in enumerate(artefacts)])
    return pairs.select("*", F.explode(fams).alias("_a")).select("*", "_a.*").drop("_a")


def resource_manifest(resolved: DataFrame, collection: str, bucket: str | None = None,
                      base_url: str | None = None, collection_dir: str = "collection") -> DataFrame:
    """Raw resource fetch list: url of the (redirected) resource and the
    local path it is stored at."""
    remote = F.concat(F.lit("collection/resource/"), F.col("resource"))
    return resolved.select(
        resource_location(remote, collection, bucket, base_url).alias("url"),
        F.concat(F.lit(collection_dir.rstrip("/") + "/resource/"), F.col("resource")).alias("path"),
    )


def artefact_manifest(pairs: DataFrame, collection: str, bucket: str | None = None,
                      base_url: str | None = None) -> DataFrame:
    """Artefact fetch list: five objects per pair, local path = remote path."""
    a = artefact_paths(pairs)
    return a.select("dataset", "resource", "family",
                    resource_location("remote_path", collection, bucket, base_url).alias("url"),
                    F.col("remote_path").alias("path"))


def log_manifest(pairs: DataFrame, collection: str, bucket: str | None = None,
                 base_url: str | None = None, log_dir: str = "var/dataset-resource/") -> DataFrame:
    """Version-log fetch list, one object per pair."""
    remote = F.concat(F.lit(log_dir), F.col("dataset"), F.lit("/"), F.col("resource"), F.lit(".csv"))
    return pairs.select("dataset", "resource",
                        resource_location(remote, collection, bucket, base_url).alias("url"),
                        remote.alias("path"))


def dedup_manifest(manifest: DataFrame, seq_col: str | None = None) -> DataFrame:
    """One row per url; with ``seq_col`` the last local path wins, otherwise
    the greatest path (deterministic either way)."""
    if seq_col:
        return manifest.groupBy("url").agg(F.max_by("path", seq_col).alias("path"))
    return manifest.groupBy("url").agg(F.max("path").alias("path"))


def reconcile_manifest(expected: DataFrame, present: DataFrame, key: str = "url") -> DataFrame:
    """Flag each expected object as present or not found."""
    p = present.select(F.col(key).alias("_k")).distinct().withColumn("_hit", F.lit(True))
    return (expected.join(p, expected[key] == p["_k"], "left")
            .withColumn("present", F.coalesce("_hit", F.lit(False))).drop("_k", "_hit"))


def summarise_manifest(reconciled: DataFrame) -> DataFrame:
    """downloaded = present objects, not_found = the rest."""
    return reconciled.agg(F.count_if("present").alias("downloaded"),
                          F.count_if(~F.col("present")).alias("not_found"))


def files_per_task(manifest: DataFrame, tasks: DataFrame) -> DataFrame:
    """Objects to fetch / tasks, integer division, 0 when there are no
    tasks. Both counts come from one aggregation over a tagged union (no
    join)."""
    tagged = manifest.select(F.lit(1).alias("_f"), F.lit(0).alias("_t")) \
        .unionByName(tasks.select(F.lit(0).alias("_f"), F.lit(1).alias("_t")))
    c = tagged.agg(F.coalesce(F.sum("_f"), F.lit(0)).cast("bigint").alias("n_files"),
                   F.coalesce(F.sum("_t"), F.lit(0)).cast("bigint").alias("n_tasks"))
    return c.select(
        "n_files", "n_tasks",
        F.when(F.col("n_tasks") > 0, F.expr("n_files div n_tasks")).otherwise(F.lit(0))
        .cast("bigint").alias("files_per_task"))


def failed_downloads(reconciled: DataFrame) -> DataFrame:
    return reconciled.where(~F.col("present")).select("url")


def raise_on_failed(reconciled: DataFrame, listing: str) -> None:
    """Any failed object fails the job. Every failed url is written, sorted,
    as text under ``listing``; the error names the count and that place, so
    nothing unbounded reaches the driver."""
    failed = failed_downloads(reconciled)
    failed.select("url").sort("url").write.mode("overwrite").text(listing)
    n = failed.sparkSession.read.text(listing).count()
    if n:
        raise RuntimeError(f"Failed to download {n} file(s), listed in {listing}")
