"""File sources: partitioned parquet tables, many small CSV logs, the state
document, artefact trees and raw resources.

All readers are Spark readers with fixed schemas (no inference). Paths may
be any Hadoop-compatible location (local, s3a://, abfss://, ...).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, _parse_datatype_string

from gleaner.schemas import PACKAGE_COLUMNS, STATE, csv_schema, package_schema


def _empty(spark: SparkSession, schema: StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def _path_missing(err: Exception) -> bool:
    return "PATH_NOT_FOUND" in str(err) or "Path does not exist" in str(err) \
        or "UNABLE_TO_INFER_SCHEMA" in str(err)


def ddl(schema: str) -> StructType:
    return _parse_datatype_string(schema)


def with_partition(schema: StructType) -> StructType:
    """The schema with the partition column ``dataset``, where it lacks it."""
    return schema if "dataset" in schema.names else StructType([*schema.fields, StructField("dataset", StringType())])


# ------------------------------------------------------------------ S1 / P1 / P2 / F2

def scan_partitioned(spark: SparkSession, root: str, table: str, dataset: str) -> DataFrame:
    """One dataset's rows of a Hive-partitioned parquet table
    ``<root>/<table>/dataset=<dataset>/**.parquet``, in the fixed column
    order with ``dataset`` as a constant. Only that partition's files are
    opened (rows of other datasets never appear); a missing partition gives
    an empty table. A fixed column missing from the files is an error, not
    a column of NULLs."""
    cols = PACKAGE_COLUMNS[table]
    leaf = f"{root.rstrip('/')}/{table}/dataset={dataset}"
    try:
        found = spark.read.option("recursiveFileLookup", "true").parquet(leaf)
    except AnalysisException as err:
        if _path_missing(err):
            return _empty(spark, package_schema(table))
        raise
    missing = [c for c in cols if c != "dataset" and c not in found.columns]
    if missing:
        raise ValueError(f"{table} files for dataset {dataset} lack columns {missing}")
    schema = package_schema(table)
    return found.select(*[
        F.lit(dataset).alias(c) if c == "dataset" else F.col(c).cast(schema[c].dataType)
        for c in cols])


def scan_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A whole partitioned table (all datasets); filter on ``dataset`` and
    Spark prunes partitions (``PartitionFilters`` in the plan)."""
    return spark.read.parquet(f"{root.rstrip('/')}/{table}")


# ------------------------------------------------------------------ S2 / P3 / D3 / D22

CSV_OPTIONS = {"quote": '"', "escape": '"', "multiLine": "true"}


def _underscored(name):
    return F.translate(F.trim(name), "-", "_")


def first_lines(spark: SparkSession, pattern: str | list[str]) -> DataFrame:
    """(file, line): the first line of each file that is not empty, without a
    byte order mark; files without one are left out."""
    lines = spark.read.text(pattern).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("b"),
        F.monotonically_increasing_id().alias("id"), F.regexp_replace("value", "^\ufeff|\r$", "").alias("value"))
    return lines.where("b = 0 and value <> ''").groupBy("file").agg(F.min_by("value", "id").alias("line"))


def csv_by_header(spark: SparkSession, pattern: str | list[str], multi_line: bool = True,
                  first: DataFrame | None = None) -> DataFrame | None:
    """CSV files, each read by its own header: (file, header ARRAY, values
    ARRAY, block, place, written). None when there is no file or no header.

    The data is read by Spark's CSV parser, positionally, its first line
    skipped as header; the header line itself comes from a text scan of the
    files (splittable like the data) and goes through the same parser, so
    quoted names, commas and doubled quotes in names, and a byte order mark
    are understood. Quoted line breaks in values need ``multi_line`` (a file is
    then one split); pass False for large files known to have none. ``block``
    and ``place`` order a file's rows; ``written`` is the file's modification
    time. ``first``: the files' :func:`first_lines`, where they are known."""
    try:
        first = first_lines(spark, pattern) if first is None else first
    except AnalysisException as err:
        if _path_missing(err):
            return None
        raise
    # as many positional columns as the widest header can have
    width = first.agg(F.max(F.size(F.split("line", ","))).alias("w")).first()["w"] or 0
    if width == 0:
        return None
    wide = StructType([StructField(f"_c{i}", StringType()) for i in range(width)])
    names = F.from_csv("line", ", ".join(f"_c{i} string" for i in range(width)), {"quote": '"', "escape": '"'})
    heads = first.select(F.col("file").alias("_hf"), F.array(*[names[f"_c{i}"] for i in range(width)]).alias("_h"))
    last = F.aggregate(F.transform("_h", lambda c, i: F.when(c.isNotNull(), i + 1).otherwise(0)), F.lit(0), lambda a, b: F.greatest(a, b))
    heads = heads.select("_hf", F.transform(F.slice("_h", F.lit(1), last), lambda c: F.trim(F.coalesce(c, F.lit("")))).alias("header"))
    rows = (spark.read.schema(wide).option("header", "true").option("enforceSchema", "true").option("mode", "PERMISSIVE")
            .options(**{**CSV_OPTIONS, "multiLine": str(multi_line).lower()}).csv(pattern)
            .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                    F.monotonically_increasing_id().alias("place"), F.col("_metadata.file_modification_time").alias("written"),
                    F.array(*[F.col(f"_c{i}") for i in range(width)]).alias("values")))
    # one small row per file: AQE broadcasts it when the file count is small
    return rows.join(heads, rows["file"] == heads["_hf"]).drop("_hf")


def scan_version_log(spark: SparkSession, pattern: str | list[str]) -> DataFrame:
    """The dataset-resource log with ``run``, a number that orders runs: the
    file's own ``run`` column where it has one, else the time (microseconds)
    its file was written."""
    target = csv_schema("dataset_resource")
    found = csv_by_header(spark, pattern)
    if found is None:
        return _empty(spark, target).withColumn("run", F.lit(None).cast("bigint"))
    found = found.withColumn("header", F.transform("header", _underscored))
    run = F.coalesce(_picked("run").try_cast("bigint"), F.unix_micros("written"))
    return found.select(*[_picked(f.name).cast(f.dataType).alias(f.name) for f in target.fields], run.alias("run"))


def _picked(name: str):
    return F.expr(f"try_element_at(values, nullif(CAST(array_position(header, '{name}') AS INT), 0))")


def scan_log_csv(spark: SparkSession, pattern: str | list[str], table: str) -> DataFrame:
    """Many small CSV files (one per resource) as one table in the fixed
    column order, matched **by header name** per file: files with permuted,
    missing or extra columns line up by name (a plain multi-file CSV read
    would swap columns silently). Hyphenated headers are normalised to
    underscores before matching. Absent directory or no file -> empty table
    with the fixed schema."""
    target = csv_schema(table)
    found = csv_by_header(spark, pattern)
    if found is None:
        return _empty(spark, target)
    found = found.withColumn("header", F.transform("header", _underscored))
    return found.select(*[_picked(f.name).cast(f.dataType).alias(f.name) for f in target.fields])


def normalise_columns(df: DataFrame, target: list[str]) -> DataFrame:
    """Hyphenated header -> underscored names, then keep the target columns
    present (in target order). Normalising first keeps multi-word columns."""
    renamed = df.toDF(*[c.strip().replace("-", "_") for c in df.columns])
    return renamed.select(*[c for c in target if c in renamed.columns])


# ------------------------------------------------------------------ S3 / F3

def scan_old_entity(spark: SparkSession, path: str, entity_min: int, entity_max: int) -> DataFrame:
    """old-entity config rows (columns by header name) whose old entity lies
    in [min, max]. Bad text and out-of-range numbers never fail the load;
    see :func:`rejected_old_entity`."""
    df = scan_csv_table(spark, path, ["old_entity", "entity", "status"])
    return df.where(F.col("old_entity").try_cast("bigint").between(entity_min, entity_max))


def rejected_old_entity(spark: SparkSession, path: str, dataset: str) -> DataFrame:
    """Issue rows for old-entity config rows whose old entity is no number."""
    df = scan_csv_table(spark, path, ["old_entity", "entity", "status"])
    bad = df.where(F.col("old_entity").isNotNull() & F.col("old_entity").try_cast("bigint").isNull())
    values = {"field": F.lit("old-entity"), "issue_type": F.lit("invalid-old-entity"), "dataset": F.lit(dataset),
              "value": F.col("old_entity"), "message": F.lit("old entity is not a number")}
    return bad.select(*[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in package_schema("issue").fields])


# ------------------------------------------------------------------ S4 / S6 / S7

def scan_csv_table(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A config/collection CSV (hyphenated header) as all-text columns,
    normalised to underscores; absent file -> empty."""
    schema = StructType([StructField(c, StringType()) for c in columns])
    try:
        df = spark.read.option("header", "true").options(**CSV_OPTIONS).csv(path)
    except AnalysisException as err:
        if _path_missing(err):
            return _empty(spark, schema)
        raise
    df = df.toDF(*[c.lstrip("\ufeff").strip().replace("-", "_") for c in df.columns])
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c)
                       for c in columns])


def dataset_entity_range(spec_dataset: DataFrame, dataset: str) -> tuple[int, int]:
    """(entity_minimum, entity_maximum) of a dataset in the specification."""
    r = spec_dataset.where(F.col("dataset") == dataset) \
        .select(F.col("entity_minimum").cast("bigint"), F.col("entity_maximum").cast("bigint")).first()
    if r is None:
        raise KeyError(f"Dataset '{dataset}' not in the specification")
    return int(r[0]), int(r[1])


# ------------------------------------------------------------------ S5

def scan_state(spark: SparkSession, path: str) -> DataFrame:
    """The state document ``{"transform_resources": {dataset: [resource,
    ...]}}`` with an explicit MAP schema (inference would make a struct with
    one field per dataset)."""
    return spark.read.schema(STATE).option("multiLine", "true").json(path)


def scan_state_pairs(spark: SparkSession, path: str) -> DataFrame:
    """The long state written by :func:`gleaner.operators.package.write_state`
    as (dataset, pos, resource)."""
    return spark.read.schema("pos bigint, resource string, dataset string").json(path) \
        .select("dataset", "pos", "resource")


def scan_any_state(spark: SparkSession, path: str) -> DataFrame:
    """A state of either form, told apart by what its first record holds: the
    document (``transform_resources``) or the long form (``pos``), whose
    datasets are its partitions. A state without any record is a long one."""
    schema = "transform_resources map<string,array<string>>, pos bigint, resource string"
    first = spark.read.schema(schema).option("multiLine", "true").json(path).select(
        F.col("transform_resources").isNotNull().alias("document"), F.col("pos").isNotNull().alias("long")).first()
    if first is not None and not first["long"]:
        return scan_state(spark, path)
    return scan_state_pairs(spark, path)


# ------------------------------------------------------------------ S8

def scan_artefacts(spark: SparkSession, root: str, family_dir: str, fmt: str = "csv",
                   schema: StructType | str | None = None) -> DataFrame:
    """All files of one artefact family ``<root>/<dir>/<dataset>/<resource>.<ext>``
    with ``dataset`` and ``resource`` taken from each row's file path."""
    base = f"{root.rstrip('/')}/{family_dir.strip('/')}"
    reader = spark.read.option("recursiveFileLookup", "true")
    if fmt == "csv":
        reader = reader.option("header", "true").options(**CSV_OPTIONS).option("enforceSchema", "false")
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.format(fmt).load(base)
    p = F.col("_metadata.file_path")
    return df.select("*",
                     F.regexp_extract(p, r"([^/]+)/[^/]+$", 1).alias("dataset"),
                     F.regexp_extract(p, r"([^/.]+)(\.[^/]*)?$", 1).alias("resource"))


# ------------------------------------------------------------------ S9

def number_file_rows(df: DataFrame, entry_col: str = "entry_number",
                     path_col: str | None = None) -> DataFrame:
    """1-based row number of each row within its file, without sorting a
    file in one task: rows of one file split are contiguous in their task,
    so the number is the split's offset in its file (a prefix sum over the
    splits, one small row each) plus the row's index inside the split."""
    m = df.select("*", F.col("_metadata.file_path").alias("_fp"),
                  F.col("_metadata.file_block_start").alias("_bs"),
                  F.monotonically_increasing_id().alias("_mid"))
    splits = m.groupBy("_fp", "_bs").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_m0"))
    w = Window.partitionBy("_fp").orderBy("_bs").rowsBetween(Window.unboundedPreceding, -1)
    # one row per file split; the window sorts splits of one file, not rows
    splits = splits.withColumn("_off", F.coalesce(F.sum("_n").over(w), F.lit(0)))
    j = m.join(splits.select("_fp", "_bs", "_off", "_m0"), ["_fp", "_bs"])
    out = j.withColumn(entry_col, F.col("_off") + F.col("_mid") - F.col("_m0") + 1)
    drop = ["_bs", "_mid", "_off", "_m0"]
    if path_col:
        out = out.withColumn(path_col, F.col("_fp"))
    if path_col != "_fp":
        drop.append("_fp")
    return out.drop(*drop)


def scan_raw_resource(spark: SparkSession, path: str, fmt: str = "csv", multi_line: bool = True) -> DataFrame:
    """Collected raw files as all-text columns plus ``resource`` (the file
    name) and ``entry_number`` (row within the file). CSV files must share
    one header (else see :func:`scan_raw_cells`); without quoted line breaks
    (``multi_line`` False) large ones are read in several splits."""
    if fmt == "csv":
        df = (spark.read.option("header", "true").option("inferSchema", "false").option("enforceSchema", "false")
              .options(**{**CSV_OPTIONS, "multiLine": str(multi_line).lower()}).csv(path))
    elif fmt == "json":
        df = spark.read.option("primitivesAsString", "true").json(path)
    else:
        df = spark.read.format(fmt).load(path)
        df = df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
    df = df.withColumn("resource", F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)$", 1))
    return number_file_rows(df)


def decoded(uri):
    """A file URI as it stands in ``_metadata.file_path``, as a path to read."""
    return F.url_decode(F.replace(F.col(uri) if isinstance(uri, str) else uri, F.lit("+"), F.lit("%2B")))


def file_name(uri):
    return decoded(F.regexp_extract(uri, r"([^/]+)$", 1))


def number_places(found: DataFrame) -> DataFrame:
    """Rows of (file, block, place, ...) with their 1-based ``entry_number`` in
    the file: the rows of the file's earlier splits plus the place in the own
    one. No file is sorted in one task."""
    splits = found.groupBy("file", "block").agg(F.count(F.lit(1)).alias("_n"), F.min("place").alias("_m0"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # one row per file split; the window sorts splits of one file, not rows
    splits = splits.withColumn("_off", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    j = found.join(splits.select("file", "block", "_off", "_m0"), ["file", "block"])
    return j.withColumn("entry_number", F.col("_off") + F.col("place") - F.col("_m0") + 1).drop("_off", "_m0")


def scan_raw_cells(spark: SparkSession, pattern: str | list[str], multi_line: bool = True, first: DataFrame | None = None) -> DataFrame:
    """Raw CSV resources with heterogeneous headers as
    (resource, entry_number, cells ARRAY<STRUCT<column, value>>).

    Every row is paired with its own file's header (see
    :func:`csv_by_header`), so files with different, permuted or extra
    columns never mix. ``entry_number`` is the row number after the header;
    rows are numbered per file split without sorting a file in one task.
    ``pattern`` is a glob or a list of files; no files, no rows."""
    found = csv_by_header(spark, pattern, multi_line, first) if pattern else None
    if found is None:
        return spark.createDataFrame(
            [], "resource string, entry_number bigint, cells array<struct<column:string,value:string>>")
    cells = F.transform("header", lambda c, i: F.struct(c.alias("column"), F.get(F.col("values"), i).alias("value")))
    return number_places(found).select(file_name("file").alias("resource"), "entry_number", cells.alias("cells"))


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """(resource, path) of the files of a folder; contents are not read."""
    try:
        files = spark.read.format("binaryFile").load(f"{folder.rstrip('/')}/*")
    except AnalysisException as err:
        if _path_missing(err):
            return spark.createDataFrame([], "resource string, path string")
        raise
    return files.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("resource"), "path")
