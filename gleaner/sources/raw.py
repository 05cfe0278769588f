"""Raw resources of several formats as one table of cells.

A collected file has no extension; what it holds shows in its first line:

  csv         anything below does not apply
  json_lines  a JSON object complete in that line; one record a line, read in
              splits like any text
  json        an array of objects, a GeoJSON feature collection (a record is a
              feature's properties and its ``geometry`` as JSON text) or one
              object; a document is one row of one task until it is exploded
  unknown     zero bytes, or the signature of a parquet, zip, gzip or PDF file

Nested values stay JSON text. A record that its reader cannot use (a line or an
array element that is no object) is given out on a channel of its own, with its
number; a file that cannot be read at all costs its resource alone. Empty files
have no records.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.session import reliable_checkpoint
from gleaner.sources.files import decoded, file_name, first_lines, number_places, scan_raw_cells

CELLS = "resource string, entry_number bigint, cells array<struct<column:string,value:string>>"
REJECTED = "resource string, entry_number bigint, record string, message string"
FAILED = "resource string, error string"
FORMATS = ("csv", "json_lines", "json", "unknown")
SIGNATURES = ["PAR1", "PK\x03\x04", "\x1f", "%PDF-"]
# Raw files read in one scan; a longer list is read in several.
FILES_PER_SCAN = 10_000


class RawScan(NamedTuple):
    cells: DataFrame     # CELLS: the records
    rejected: DataFrame  # REJECTED: records no reader can use
    failed: DataFrame    # FAILED: files no reader can use


def _cells(record: Column) -> Column:
    return F.transform(F.map_entries(record), lambda e: F.struct(e["key"].alias("column"), e["value"].alias("value")))


def json_cells(text: Column) -> Column:
    """The cells of a JSON object; NULL where the text is no JSON object."""
    return _cells(F.from_json(text, "map<string,string>"))


def json_document_cells(text: Column) -> Column:
    """The cells of every record of a JSON document: an array with a NULL for
    each element that is no object. NULL where the text is no JSON document."""
    marked = {"columnNameOfCorruptRecord": "_bad"}
    several = F.from_json(text, "array<string>")
    collection = F.from_json(text, "type string, features array<struct<properties:map<string,string>,geometry:string>>, _bad string", marked)
    of_feature = F.transform(collection["features"], lambda f: F.when(f.isNotNull(), F.concat(
        F.coalesce(_cells(f["properties"]), F.array().cast("array<struct<column:string,value:string>>")),
        F.array(F.struct(F.lit("geometry").alias("column"), f["geometry"].alias("value"))))))
    return (F.when(F.ltrim(text).startswith("["), F.transform(several, json_cells))
            .when(collection["type"].eqNullSafe("FeatureCollection"), F.when(collection["_bad"].isNull(), of_feature))
            .when(json_cells(text).isNotNull(), F.array(json_cells(text))))


def probe_format(line: Column) -> Column:
    """Format of a file by its first line that holds anything."""
    begin = F.ltrim(line)
    record = F.from_json(line, "map<string,string>")
    binary = reduce(lambda a, b: a | b, [line.startswith(s) for s in SIGNATURES], F.instr(line, "\0") > 0)
    whole = record.isNotNull() & ~F.get(F.map_values(F.map_filter(record, lambda k, v: k == "type")), 0).eqNullSafe("FeatureCollection")
    return (F.when(binary, "unknown").when(begin.startswith("{") & whole, "json_lines")
            .when(begin.startswith("{") | begin.startswith("["), "json").otherwise("csv"))


def _csv(spark: SparkSession, paths: list[str], heads: DataFrame, multi_line: bool) -> RawScan:
    cells = scan_raw_cells(spark, paths, multi_line, heads.where("format = 'csv'").select("file", "line"))
    return RawScan(cells, spark.createDataFrame([], REJECTED), spark.createDataFrame([], FAILED))


def _json_lines(spark: SparkSession, paths: list[str]) -> RawScan:
    lines = number_places(spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"), F.regexp_replace("value", "^\ufeff", "").alias("record")))
    lines = lines.where(F.trim("record") != "").select(file_name("file").alias("resource"), "entry_number", "record", json_cells(F.col("record")).alias("cells"))
    bad = lines.where("cells is null").select("resource", "entry_number", "record", F.lit("not a JSON object").alias("message"))
    return RawScan(lines.where("cells is not null").select("resource", "entry_number", "cells"), bad, spark.createDataFrame([], FAILED))


def _json(spark: SparkSession, paths: list[str]) -> RawScan:
    text = F.regexp_replace("value", "^\ufeff", "")
    docs = spark.read.text(paths, wholetext=True).select(
        file_name(F.col("_metadata.file_path")).alias("resource"), json_document_cells(text).alias("records"))
    each = docs.select("resource", F.posexplode("records").alias("_at", "cells")).withColumn("entry_number", (F.col("_at") + 1).cast("bigint"))
    bad = each.where("cells is null").select("resource", "entry_number", F.lit(None).cast("string").alias("record"), F.lit("not a JSON object").alias("message"))
    failed = docs.where("records is null").select("resource", F.lit("not a JSON document").alias("error"))
    return RawScan(each.where("cells is not null").select("resource", "entry_number", "cells"), bad, failed)


def _unknown(spark: SparkSession, heads: DataFrame) -> RawScan:
    failed = heads.where("format = 'unknown'").select(file_name("file").alias("resource"), F.lit("unknown file format").alias("error"))
    return RawScan(spark.createDataFrame([], CELLS), spark.createDataFrame([], REJECTED), failed)


def _scan(spark: SparkSession, paths: list[str], multi_line: bool) -> list[RawScan]:
    lines = first_lines(spark, paths)
    heads = lines.select("file", probe_format(F.col("line")).alias("format"), "line")
    # a row per file; other formats' first lines may be whole documents
    heads = reliable_checkpoint(heads.withColumn("line", F.when(F.col("format") == "csv", F.col("line"))))
    named: dict[str, list[str]] = {}
    for r in heads.select("format", decoded(F.col("file")).alias("path")).collect():  # no more than ``paths``
        named.setdefault(r["format"], []).append(r["path"])
    readers = {"csv": lambda p: _csv(spark, p, heads, multi_line), "json_lines": lambda p: _json_lines(spark, p),
               "json": lambda p: _json(spark, p), "unknown": lambda p: _unknown(spark, heads)}
    return [readers[f](named[f]) for f in FORMATS if f in named]


def scan_raw_files(spark: SparkSession, paths: list[str], multi_line: bool = True) -> RawScan:
    """The records of raw files, each by the reader of its own format, with
    ``resource`` the file's name and ``entry_number`` the record's place in it
    (lines of JSON: the line). ``multi_line`` as in
    :func:`gleaner.sources.files.csv_by_header`."""
    scans = [s for k in range(0, len(paths), FILES_PER_SCAN) for s in _scan(spark, paths[k:k + FILES_PER_SCAN], multi_line)]
    if not scans:
        scans = [RawScan(*[spark.createDataFrame([], s) for s in (CELLS, REJECTED, FAILED)])]
    return RawScan(*[reduce(lambda a, b: a.unionByName(b), parts) for parts in zip(*scans)])
