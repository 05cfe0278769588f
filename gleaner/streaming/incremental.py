"""Incremental loading of the collector's daily log partitions.

The collector appends one directory per day (``log/YYYY-MM-DD/*.csv``).
Instead of re-reading every day on each run, a file stream with an
``availableNow`` trigger picks up only files not seen before (the stream's
checkpoint remembers them) and stops. Every micro-batch is written to its
own ``batch_id`` partition, so a batch replayed after a crash replaces what
its first try left and each file is loaded once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gleaner.sources.files import csv_by_header, decoded

FILES_PER_BATCH = 1000


def log_files(spark: SparkSession, log_dir: str) -> DataFrame:
    """The daily log files as a stream of their lines' paths."""
    raw = (spark.readStream.option("recursiveFileLookup", "true").option("maxFilesPerTrigger", FILES_PER_BATCH)
           .text(log_dir))
    return raw.select(decoded(F.col("_metadata.file_path")).alias("path"))


def read_logs(spark: SparkSession, paths: str | list[str]) -> DataFrame | None:
    """Log rows of the files, columns by each file's own header, with the day
    taken from the path."""
    found = csv_by_header(spark, paths)
    if found is None:
        return None

    def pick(name):
        return F.expr(f"try_element_at(values, nullif(CAST(array_position(header, '{name}') AS INT), 0))")
    found = found.withColumn("header", F.transform("header", lambda c: F.translate(c, "-", "_")))
    day = F.regexp_extract("file", r"/(\d{4}-\d{2}-\d{2})/[^/]+$", 1)
    return found.select(pick("endpoint").alias("endpoint"), pick("resource").alias("resource"), pick("status").alias("status"),
                        F.to_date(F.nullif(day, F.lit(""))).alias("log_date"),
                        F.to_date(F.substring(pick("entry_date"), 1, 10)).alias("entry_date"))


def load_new_logs(spark: SparkSession, log_dir: str, table_path: str,
                  checkpoint: str | None = None) -> int:
    """Add the log rows of files not loaded before; returns the number of
    rows added in this run. The stream's state lies beside the table
    (``<table_path>-stream``) unless told otherwise: a path that stays the
    same from run to run, on the same storage as the table."""
    checkpoint = checkpoint or f"{table_path.rstrip('/')}-stream"
    added = {"rows": 0}

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        # at most FILES_PER_BATCH paths
        paths = [r[0] for r in batch.select("path").distinct().collect()]
        rows = read_logs(batch.sparkSession, paths) if paths else None
        if rows is None:
            return
        obs = Observation(f"log_batch_{batch_id}")
        (rows.withColumn("batch_id", F.lit(batch_id)).observe(obs, F.count(F.lit(1)).alias("rows"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id", "log_date").parquet(table_path))
        added["rows"] += int(obs.get.get("rows", 0))

    q = (log_files(spark, log_dir).writeStream.foreachBatch(write_batch)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return added["rows"]


def daily_log(spark: SparkSession, log_dir: str, table_path: str, today: str | None = None,
              rebuild: bool = False) -> tuple[DataFrame, int]:
    """The log index over all daily partitions, and the number of rows that
    this run added to it. Only files not loaded before are read, and with
    ``today`` (yyyy-mm-dd) that day's folder afresh, as its files may have
    changed since; a day whose folder is gone keeps its stored rows. ``rebuild``
    forgets what was loaded and reads every day again."""
    if f"{log_dir.rstrip('/')}/".startswith(f"{table_path.rstrip('/')}/"):
        raise ValueError(f"The log table {table_path} would hold the daily logs {log_dir}")
    checkpoint = f"{table_path.rstrip('/')}-stream"
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(table_path).getFileSystem(spark._jsc.hadoopConfiguration())
    if rebuild:
        fs.delete(path(checkpoint), True)
    if not fs.exists(path(checkpoint)):  # also what a rebuild that broke off left
        fs.delete(path(table_path), True)
    added = 0
    if fs.exists(path(log_dir)):
        added = load_new_logs(spark, log_dir, table_path, checkpoint)
    columns = "endpoint string, resource string, status string, entry_date date, batch_id bigint, log_date date"
    stored = (spark.read.schema(columns).parquet(table_path) if fs.exists(path(table_path)) else spark.createDataFrame([], columns)).drop("batch_id")
    if today is not None:
        fresh = read_logs(spark, f"{log_dir.rstrip('/')}/{today}/*.csv")
        if fresh is not None:
            stored = stored.where(~F.col("log_date").eqNullSafe(F.lit(today).cast("date"))).unionByName(fresh)
    return stored.select("endpoint", "resource", "entry_date", "status", "log_date"), added
