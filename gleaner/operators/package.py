"""Publishing: the dataset package (seven tables), CSV and flattened dumps,
the state document, issue logs, incremental sync, counts and checksums."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gleaner.schemas import CSV_COLUMNS, CSV_TABLES, PACKAGE_COLUMNS
from gleaner.session import reliable_checkpoint
from gleaner.sources import files as SRC


def project_fixed(df: DataFrame, table: str, dataset: str | None = None) -> DataFrame:
    """The fixed columns of a package table, in order; ``dataset`` as a
    constant when given (and the table has that column)."""
    cols = PACKAGE_COLUMNS[table] if table in PACKAGE_COLUMNS else CSV_COLUMNS[table]
    return df.select(*[F.lit(dataset).alias(c) if (c == "dataset" and dataset is not None)
                       else F.col(c) for c in cols])


def build_package(spark: SparkSession, dataset: str, parquet_root: str,
                  collection_root: str | None = None, collection: str | None = None,
                  entity_range: tuple[int, int] | None = None) -> dict[str, DataFrame]:
    """The seven tables of one dataset's package: four from the parquet
    tree, three from the collection CSVs (loaded by header name). The
    dataset's entity range is required with the latter: it selects the
    old-entity rows. Old entities that are no numbers become issue rows."""
    tables = {t: SRC.scan_partitioned(spark, parquet_root, t, dataset) for t in PACKAGE_COLUMNS}
    if collection_root and collection:
        base = f"{collection_root.rstrip('/')}/{collection}-collection"
        tables["dataset_resource"] = SRC.scan_log_csv(
            spark, f"{base}/var/dataset-resource/{dataset}/*.csv", "dataset_resource")
        tables["column_field"] = SRC.scan_log_csv(
            spark, f"{base}/var/column-field/{dataset}/*.csv", "column_field")
        if entity_range is None:
            raise ValueError("the entity range of the dataset (specification) is required")
        old = f"{collection_root.rstrip('/')}/config/pipeline/{collection}/old-entity.csv"
        tables["old_entity"] = SRC.scan_old_entity(spark, old, *entity_range)
        tables["issue"] = tables["issue"].unionByName(SRC.rejected_old_entity(spark, old, dataset))
    return tables


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, rows) for every table, one job over a union of counts."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
             for name, df in tables.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


def _replace_partition(df: DataFrame, path: str) -> None:
    """Write ``df`` as all there is under ``path``. An empty table leaves a
    file with its schema, so it reads back as empty and nothing stale stays."""
    df.write.mode("overwrite").parquet(path)


def write_package(tables: dict[str, DataFrame], out_root: str, dataset: str) -> DataFrame:
    """Write every table under ``<out>/<table>/dataset=<dataset>/``, replacing
    that dataset's partition alone, and the row counts (observed while
    writing, no second pass) under ``<out>/counts``. Returns the counts."""
    spark = next(iter(tables.values())).sparkSession
    counts = []
    for name, df in tables.items():
        obs = Observation(f"rows_{name}")
        out = df.drop("dataset").observe(obs, F.count(F.lit(1)).alias("rows"))
        _replace_partition(out, f"{out_root.rstrip('/')}/{name}/dataset={dataset}")
        counts.append((name, int(obs.get.get("rows", 0))))
    result = spark.createDataFrame(counts, "table string, rows bigint")
    _replace_partition(result, f"{out_root.rstrip('/')}/counts/dataset={dataset}")
    return result


def replace_resources(df: DataFrame, path: str, done: DataFrame) -> None:
    """Store a batch's rows in a table partitioned by dataset: rows of the
    batch's (dataset, resource) pairs (``done``) are replaced, those of other
    resources and datasets stay. Only the batch's datasets are rewritten."""
    spark = df.sparkSession
    pairs = done.select("dataset", "resource").distinct()
    names = sorted(r[0] for r in pairs.select("dataset").distinct().collect())  # datasets of one batch
    kept = stored_datasets(spark, df.schema, path, names)
    if kept is not None:
        kept = reliable_checkpoint(kept.join(pairs, ["dataset", "resource"], "left_anti"))
    replace_datasets(df if kept is None else kept.unionByName(df), path, names)


def stored_datasets(spark: SparkSession, schema: StructType, path: str, names: list[str]) -> DataFrame | None:
    """The rows of some datasets of a table partitioned by dataset; None where
    there is no table."""
    try:
        stored = spark.read.schema(schema).parquet(path)
    except AnalysisException as err:
        if not SRC._path_missing(err):
            raise
        return None
    return stored.select(*schema.names).where(F.col("dataset").isin(names))


def replace_datasets(df: DataFrame, path: str, names: list[str]) -> None:
    """Replace the partitions of the named datasets by ``df``, which may have
    been read from them; other datasets keep their files."""
    out = reliable_checkpoint(df)
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("dataset").parquet(path))
    filled = {r[0] for r in out.select("dataset").distinct().collect()}
    for name in names:  # nothing left of a dataset: an empty partition, not the old one
        if name not in filled:
            _replace_partition(out.drop("dataset").limit(0), f"{path.rstrip('/')}/dataset={name}")


def write_versions(log: DataFrame, path: str, run: int) -> None:
    """Add a batch's versions to the dataset-resource log under ``path``,
    compacted: the folder ``log_dataset=<dataset>`` holds one row per resource,
    the one of its last run. Only the batch's datasets are rewritten; rows that
    others put into other folders of ``path`` stay as they are."""
    from gleaner.operators.selection import latest_versions
    spark = log.sparkSession
    names = sorted(r[0] for r in log.select("dataset").distinct().collect())  # datasets of one batch
    if not names:
        return
    folders = [f"{path.rstrip('/')}/log_dataset={name}" for name in names]
    fs = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    stored = [f"{f}/*.csv" for f in folders if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f))]
    new = log.withColumn("run", F.lit(run).cast("bigint"))
    both = new.unionByName(SRC.scan_version_log(spark, stored)) if stored else new
    kept = reliable_checkpoint(latest_versions(both).withColumn("log_dataset", F.col("dataset")))
    (kept.toDF(*[c.replace("_", "-") if c != "log_dataset" else c for c in kept.columns])
     .repartition("log_dataset").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .option("header", "true").option("escape", '"').partitionBy("log_dataset").csv(path))


def write_csv(df: DataFrame, path: str) -> None:
    """Entities (or any table) as standard CSV with a header: quotes inside
    a value are doubled."""
    df.write.mode("overwrite").option("header", "true").option("escape", '"').csv(path)


def write_flattened(df: DataFrame, path: str) -> None:
    """Flattened entities as CSV and JSON lines side by side."""
    write_csv(df, f"{path.rstrip('/')}/csv")
    df.write.mode("overwrite").json(f"{path.rstrip('/')}/json")


def write_state(pairs: DataFrame, path: str) -> None:
    """The state (each dataset's ordered work list) as JSON lines, one line
    per (dataset, pos, resource), partitioned by dataset: no dataset's list
    is ever assembled in one row or one task. ``pos`` is taken from the
    input when present, else the place in the dataset's sorted list.
    :func:`gleaner.sources.files.scan_state_pairs` reads it back."""
    from gleaner.operators.collection import resource_lists
    long = pairs.select("dataset", "pos", "resource") if "pos" in pairs.columns \
        else resource_lists(pairs)
    long.write.mode("overwrite").partitionBy("dataset").json(path)


def merge_issues(existing: DataFrame | None, new: DataFrame) -> DataFrame:
    """Existing issue log (if present and non-empty) followed by the new
    issues; columns matched by name."""
    if existing is None or existing.isEmpty():
        return new
    return existing.unionByName(new, allowMissingColumns=True)


def append_operational_issues(issues: DataFrame, path: str, entry_date: str) -> None:
    """Add a day's issues to the per-dataset history; a second run of the
    same day replaces that day's rows of the datasets it has."""
    (issues.withColumn("log_date", F.lit(entry_date)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("dataset", "log_date").parquet(path))


def sync_new(local: DataFrame, remote: DataFrame, keys: list[str], path: str,
             identity: list[str] | None = None) -> DataFrame:
    """Bring ``path`` up to date with the rows missing remotely or differing
    on ``keys`` (such as name and size); returns those rows. With
    ``identity`` (the columns that name an object) a changed object replaces
    its stored row; without it, rows are only added."""
    new = reliable_checkpoint(local.join(remote.select(*keys), keys, "left_anti"))
    if identity is None:
        new.write.mode("append").parquet(path)
        return new
    try:
        stored = local.sparkSession.read.schema(local.schema).parquet(path)
    except AnalysisException as err:
        if not SRC._path_missing(err):
            raise
        out = new
    else:
        out = reliable_checkpoint(stored.join(new.select(*identity).distinct(), identity, "left_anti").unionByName(new))
    out.write.mode("overwrite").parquet(path)
    return new


def write_artefacts(df: DataFrame, path: str) -> None:
    """Per-(dataset, resource) artefacts: partitioned by dataset (a directory
    per resource would create millions of tiny partitions at scale). The
    resources of ``df`` are replaced, all others stay. The ``rebalance`` hint
    lets AQE split a resource holding a large share of the rows over several
    writer tasks and merge small ones."""
    replace_resources(df.hint("rebalance", "dataset", "resource"), path, df)


def content_hash(spark: SparkSession, directory: str) -> str:
    """Hash of a config/specification directory: sha256 of the sorted
    (relative path, sha256(content)) list. Used as a version key."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(directory)
    # relative path: what follows the folder's own path in the file's
    root = spark._jvm.org.apache.hadoop.fs.Path(directory)
    root = root.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(root).toString().rstrip("/")
    plain = F.regexp_replace(F.col("path"), "^([a-z0-9]+:)/+", "$1/")
    rel = F.substr(plain, F.lit(len(re.sub("^([a-z0-9]+:)/+", r"\1/", root)) + 2))
    per = files.select(rel.alias("p"), F.sha2("content", 256).alias("h"))
    row = per.agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("p", "h"))),
                                                  lambda x: F.concat_ws(":", x["p"], x["h"])), "\n"),
                         256).alias("hash")).first()
    return row["hash"]


def count_files(df: DataFrame) -> int:
    """Number of distinct input files behind a scan."""
    return df.select(F.countDistinct(F.col("_metadata.file_path")).alias("n")).first()["n"]


__all__ = ["CSV_TABLES"]
