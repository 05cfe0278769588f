"""Command-line entry points: ``python -m gleaner.cli <command> ...``.

Each command reads the collection's files with Spark, runs one job from
:mod:`gleaner.plans.jobs` and writes its result as parquet (and the small
summaries to stdout). Paths may be any Hadoop-compatible location.

  collect                  resource index, dataset-resource table, new
                           resources and the state of a collection
  build-package            seven tables of one dataset's package + counts
  plan-transform           task list of a transform run
  plan-resources           raw resources to fetch (url, path)
  plan-transformed         artefacts to fetch for a slice of pairs
  plan-dataset-resource    version logs to fetch, reconciled with what exists
  transform                run the phases over the raw resources of a task list
  assemble                 transformed rows -> entity, fact, fact_resource, issue
                           tables (the layout build-package reads), CSV,
                           flattened files and expectation results
  update                   the entity, fact, fact_resource and issue tables that
                           assemble built, after one more batch of transform
"""

from __future__ import annotations

import argparse
import datetime
import json
import logging
import sys
import time

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner import __version__
from gleaner.operators import package as PK
from gleaner.operators import phases as PH
from gleaner.operators import selection as SEL
from gleaner.operators.batch import summarise_results
from gleaner.operators.collection import dataset_resource_map
from gleaner.plans import jobs as J
from gleaner.schemas import package_schema
from gleaner.session import literal_df, reliable_checkpoint
from gleaner.sources import files as SRC
from gleaner.sources import raw as RAW
from gleaner.streaming.incremental import daily_log

LOG_COLUMNS = ["endpoint", "resource", "entry_date", "status"]
SOURCE_COLUMNS = ["source", "organisation", "endpoint", "collection", "pipelines"]
OLD_RESOURCE_COLUMNS = ["old_resource", "resource", "status"]


TRANSFORMED_SCHEMA = ("entity bigint, resource string, entry_number bigint, entry_date string, priority bigint, "
                      "field string, value string, dataset string")


def load_collection(spark: SparkSession, collection_dir: str) -> dict[str, DataFrame]:
    """log, source and old-resource tables of a collection directory.
    old-resource entries keep their file order (``seq``) so the last
    duplicate wins."""
    base = collection_dir.rstrip("/")
    log = SRC.scan_csv_table(spark, f"{base}/log.csv", LOG_COLUMNS).withColumn(
        "entry_date", F.to_date(F.substring("entry_date", 1, 10)))
    source = SRC.scan_csv_table(spark, f"{base}/source.csv", SOURCE_COLUMNS)
    old = _old_resource(spark, f"{base}/old-resource.csv")
    return {"log": log, "source": source, "old_resource": old}


def _old_resource(spark: SparkSession, path: str) -> DataFrame:
    """old-resource.csv with ``seq`` = row number in the file; an absent file
    is an empty table, any other error is raised."""
    try:
        raw = spark.read.option("header", "true").options(**SRC.CSV_OPTIONS).csv(path)
    except AnalysisException as err:
        if not SRC._path_missing(err):
            raise
        return spark.createDataFrame(
            [], "seq bigint, old_resource string, resource string, status string")
    numbered = SRC.number_file_rows(raw, "seq")
    numbered = numbered.toDF(*[c.strip().replace("-", "_") for c in numbered.columns])
    return numbered.select("seq", *[F.col(c) if c in numbered.columns
                                    else F.lit(None).cast("string").alias(c)
                                    for c in OLD_RESOURCE_COLUMNS])


def cmd_collect(spark, a) -> dict:
    """Resource index, dataset -> resource table, the resources not seen
    before, the state of the collection (``--state-path`` of the plan commands)
    and its counts by dataset, skip-aware where a version log is named. With
    ``--log-dir`` the log is that of the collector's daily partitions."""
    c = load_collection(spark, a.collection_dir)
    added = {}
    if a.log_dir:
        today = None if a.no_refill or a.regenerate_log else a.today or datetime.date.today().isoformat()
        log, rows = daily_log(spark, a.log_dir, f"{a.output.rstrip('/')}/log-index", today, a.regenerate_log)
        c["log"], added = log.drop("log_date"), {"log_rows_added": rows}
    index, pairs = J.collect_index(c["log"], c["source"])
    out = a.output.rstrip("/")
    seen = None
    try:
        seen = reliable_checkpoint(spark.read.parquet(f"{out}/resource").select("resource"))
    except AnalysisException as err:
        if not SRC._path_missing(err):
            raise
    index = reliable_checkpoint(index)
    new = index if seen is None else index.join(seen, "resource", "left_anti")
    new.write.mode("overwrite").parquet(f"{out}/new-resource")
    index.write.mode("overwrite").parquet(f"{out}/resource")
    pairs.write.mode("overwrite").parquet(f"{out}/dataset-resource")
    PK.write_state(pairs, f"{out}/state")
    kw = {}
    if a.dataset_resource_dir:
        kw = {"version_log": _version_log(spark, a.dataset_resource_dir), "versions": _versions(spark, a.pipeline_dir, a.specification_dir)}
    SEL.work_counts(pairs, **kw).write.mode("overwrite").parquet(f"{out}/state-counts")
    return {"resources": index.count(), "new": spark.read.parquet(f"{out}/new-resource").count(), **added}


def _versions(spark, pipeline_dir: str, specification_dir: str) -> SEL.Versions:
    return SEL.Versions(__version__, PK.content_hash(spark, pipeline_dir),
                        PK.content_hash(spark, specification_dir))


def _version_log(spark, dataset_resource_dir: str) -> DataFrame:
    return SRC.scan_version_log(spark, f"{dataset_resource_dir.rstrip('/')}/*/*.csv")


def _state(spark, path: str | None):
    return SRC.scan_any_state(spark, path) if path else None


def cmd_build_package(spark, a) -> dict:
    spec = SRC.scan_csv_table(spark, f"{a.specification_dir.rstrip('/')}/dataset.csv",
                              ["dataset", "collection", "entity_minimum", "entity_maximum"])
    counts = J.build_package(spark, a.dataset, a.parquet_datasets_path, a.output_path,
                             a.collection_data_path, a.collection, spec)
    return {r["table"]: r["rows"] for r in counts.collect()}


def cmd_plan_transform(spark, a) -> dict:
    c = load_collection(spark, a.collection_dir)
    kw = {}
    if not a.reprocess:
        kw = {"version_log": _version_log(spark, a.dataset_resource_dir),
              "versions": _versions(spark, a.pipeline_dir, a.specification_dir)}
    tasks = J.plan_transform(dataset_resource_map(c["log"], c["source"]), c["old_resource"],
                             c["log"], c["source"], dataset=a.dataset, offset=a.offset,
                             limit=a.limit, reprocess=a.reprocess, state=_state(spark, a.state_path),
                             collection_dir=a.collection_dir, **kw)
    tasks.write.mode("overwrite").parquet(a.output)
    return {"tasks": spark.read.parquet(a.output).count()}


def cmd_plan_resources(spark, a) -> dict:
    c = load_collection(spark, a.collection_dir)
    kw = {"dataset": a.dataset, "offset": a.offset, "limit": a.limit, "reprocess": a.reprocess,
          "state": _state(spark, a.state_path)}
    if not a.reprocess:
        kw.update(version_log=_version_log(spark, a.dataset_resource_dir),
                  versions=_versions(spark, a.pipeline_dir, a.specification_dir))
    man = J.plan_resource_fetch(dataset_resource_map(c["log"], c["source"]), c["old_resource"],
                                a.collection_name, bucket=a.bucket, base_url=a.base_url, **kw)
    man.write.mode("overwrite").parquet(a.output)
    return {"files": spark.read.parquet(a.output).count()}


def cmd_plan_transformed(spark, a) -> dict:
    c = load_collection(spark, a.collection_dir)
    man, fpt = J.plan_artefact_fetch(dataset_resource_map(c["log"], c["source"]), c["old_resource"],
                                     a.collection_name, bucket=a.bucket, base_url=a.base_url,
                                     dataset=a.dataset, offset=a.offset, limit=a.limit)
    man.write.mode("overwrite").parquet(a.output)
    return fpt.first().asDict()


def cmd_plan_dataset_resource(spark, a) -> dict:
    c = load_collection(spark, a.collection_dir)
    rec, summary = J.plan_log_fetch(dataset_resource_map(c["log"], c["source"]),
                                    _version_log(spark, a.dataset_resource_dir),
                                    a.collection_name, bucket=a.bucket, base_url=a.base_url,
                                    dataset=a.dataset)
    rec.write.mode("overwrite").parquet(a.output)
    return summary.first().asDict()


# Config CSVs of the pipeline directory and the columns the phases read
# (hyphenated headers are accepted; other columns are ignored).
PIPELINE_CONFIGS = {
    "column": ("column.csv", ["dataset", "column", "field"]),
    "skip": ("skip.csv", ["dataset", "pattern"]),
    "patch": ("patch.csv", ["dataset", "field", "pattern", "replacement"]),
    "filter": ("filter.csv", ["dataset", "field", "pattern"]),
    "concat": ("concat.csv", ["dataset", "field", "fields", "separator"]),
    "default": ("default.csv", ["dataset", "field", "default_field"]),
    "default_value": ("default-value.csv", ["dataset", "field", "value"]),
    "transform": ("transform.csv", ["dataset", "field", "replacement_field"]),
}


def _in_file_order(df: DataFrame) -> DataFrame:
    return df.withColumn("seq", F.monotonically_increasing_id())


def load_pipeline(spark, pipeline_dir: str, specification_dir: str) -> dict[str, DataFrame]:
    base = pipeline_dir.rstrip("/")
    # an optional resource column scopes a row to one resource
    configs = {name: _in_file_order(SRC.scan_csv_table(spark, f"{base}/{fname}", ["resource", *cols]))
               for name, (fname, cols) in PIPELINE_CONFIGS.items()}
    configs["prefix"] = SRC.scan_csv_table(
        spark, f"{specification_dir.rstrip('/')}/dataset.csv", ["dataset", "prefix"])
    return configs


def cmd_transform(spark, a) -> dict:
    """One batch: its rows, issues, logs and results replace those of its
    (dataset, resource) pairs; other batches' stay."""
    tasks = spark.read.parquet(a.tasks)
    out = a.output_dir.rstrip("/")
    folder = a.resource_dir.rstrip("/")
    present = reliable_checkpoint(SRC.list_files(spark, folder).join(tasks.select("resource").distinct(), "resource", "left_semi"))
    if a.on_missing == "fail":
        SEL.require_resources_present(tasks, present)
    errors = SEL.missing_resources(tasks, present)
    configs = load_pipeline(spark, a.pipeline_dir, a.specification_dir)
    # resources whose config cannot be used fail alone; the others go on
    invalid = PH.invalid_patterns(spark, configs)
    bad = literal_df(spark, invalid, "_d string, _r string, _e string")
    hit = (F.col("dataset") == F.col("_d")) & ((F.col("_r") == "") | (F.col("_r") == F.col("old_resource")))
    unusable = tasks.join(bad, hit).groupBy("dataset", "old_resource").agg(F.min("_e").alias("error"))
    # the raw files of the task list, each by its own format; a file that cannot be read fails alone
    paths = [r[0] for r in present.select("path").sort("path").toLocalIterator()]
    raw = RAW.scan_raw_files(spark, paths, multi_line=not a.single_line)
    unread = tasks.join(raw.failed.select("resource", F.concat_ws(": ", "error", "resource").alias("error")), "resource")
    unusable = reliable_checkpoint(unusable.unionByName(unread.select("dataset", "old_resource", "error")))
    errors = errors.select("dataset", "old_resource", "error").unionByName(unusable)
    errors = reliable_checkpoint(errors.groupBy("dataset", "old_resource").agg(F.min("error").alias("error")))
    listed = tasks.select("dataset", F.col("old_resource").alias("resource"))
    tasks = tasks.join(unusable, ["dataset", "old_resource"], "left_anti")
    for name in ("skip", "patch", "filter"):
        configs[name] = configs[name].where(F.col("pattern").isNull() | ~F.concat_ws(": invalid pattern ", F.lit(name), "pattern").isin([e for _d, _r, e in invalid]))
    cells = J.task_rows(raw.cells, tasks)
    base = a.pipeline_dir.rstrip("/")
    lookup = SRC.scan_csv_table(spark, f"{base}/lookup.csv",
                                ["prefix", "reference", "organisation", "entity"]) \
        .withColumn("entity", F.col("entity").try_cast("bigint"))
    old_entity = _in_file_order(SRC.scan_csv_table(spark, f"{base}/old-entity.csv", ["old_entity", "entity", "status"]))
    combine = SRC.scan_csv_table(spark, f"{base}/combine.csv", ["dataset", "field", "separator"])
    t = J.transform_cells(cells, configs, lookup, old_entity, combine=combine, store=reliable_checkpoint)
    done = (tasks.join(present.select(F.col("resource").alias("_p")), tasks["resource"] == F.col("_p"), "left_semi")
            .select("dataset", F.col("old_resource").alias("resource")).distinct())
    PK.replace_resources(t.facts_input, f"{out}/transformed", done)
    PK.replace_resources(t.issues, f"{out}/issue", done)
    PK.replace_resources(t.column_field, f"{out}/column-field", done)
    PK.replace_resources(J.task_rows(raw.rejected, tasks), f"{out}/rejected", done)
    if a.keep_converted:
        PK.replace_resources(cells, f"{out}/converted-resource", done)
    results = (listed.join(errors.select("dataset", F.col("old_resource").alias("resource"), "error"), ["dataset", "resource"], "left")
               .select("dataset", "resource", F.col("error").isNull().alias("ok"), "error").distinct())
    PK.replace_resources(results, f"{out}/result", listed)
    v = _versions(spark, a.pipeline_dir, a.specification_dir)
    entry_date = a.entry_date or datetime.date.today().isoformat()
    log = PH.provenance_log(done, v.code_version, v.config_hash, v.specification_hash, entry_date)
    PK.replace_resources(log, f"{out}/dataset-resource", done)
    if a.dataset_resource_dir:  # where plan-transform looks for it
        PK.write_versions(log, a.dataset_resource_dir, time.time_ns() // 1000)
    counts = summarise_results(results).first()
    n, failed = counts["successful"] + counts["failed"], counts["failed"]
    summary = {"tasks": n, "successful": n - failed, "failed": failed}
    if failed:
        print(json.dumps(summary))
        raise SystemExit(1)
    return summary


def cmd_assemble(spark, a) -> dict:
    from gleaner.operators import facts as FA
    from gleaner.operators.collection import require_nonempty
    from gleaner.operators.expectations import watch_expectations
    src = a.transformed_dir.rstrip("/")
    t = spark.read.schema(TRANSFORMED_SCHEMA).parquet(f"{src}/transformed")
    issues = spark.read.schema(package_schema("issue")).parquet(f"{src}/issue")
    if a.dataset:
        t, issues = t.where(F.col("dataset") == a.dataset), issues.where(F.col("dataset") == a.dataset)
    require_nonempty(t, "transformed rows")
    out = a.output_dir.rstrip("/")
    ranks = FA.rank_dates(t)
    entity = FA.resolve_entities(t, ranks)
    if a.pipeline_dir:
        entity = J.fill_organisations(entity, SRC.scan_csv_table(
            spark, f"{a.pipeline_dir.rstrip('/')}/entity-organisation.csv",
            ["dataset", "entity_minimum", "entity_maximum", "organisation"]))
    fields = None
    if a.specification_dir:
        listed = SRC.scan_csv_table(spark, f"{a.specification_dir.rstrip('/')}/field.csv", ["field"])
        fields = sorted(r[0].replace("-", "_") for r in listed.where("field is not null").distinct().collect()) or None
    tables = {"entity": entity, "fact": FA.make_facts(t, keep_dataset=True, ranks=ranks),
              "fact_resource": FA.make_fact_resources(t, keep_dataset=True, ranks=ranks),
              "issue": issues.select(*PK.PACKAGE_COLUMNS["issue"])}
    exp = None
    if a.expectations:
        exp = SRC.scan_csv_table(spark, a.expectations, ["name", "condition", "min_count", "max_count"]) \
            .select("name", "condition", F.col("min_count").try_cast("bigint").alias("min_count"),
                    F.col("max_count").try_cast("bigint").alias("max_count"))
    # rows and expectations are counted by the write itself: each table is computed once
    counts, checked = {}, None
    for name, df in tables.items():
        watched, results = watch_expectations(df, exp if name == "entity" else None)
        watched.write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
            .partitionBy("dataset").parquet(f"{out}/{name}")
        counts[name], found = results()
        checked = found if name == "entity" else checked
    written = spark.read.schema(package_schema("entity")).parquet(f"{out}/entity")
    PK.write_csv(written, f"{out}/csv")
    PK.write_flattened(FA.flatten_entities(written, fields), f"{out}/flattened")
    if a.history_dir:
        PK.append_operational_issues(issues, a.history_dir, a.entry_date or datetime.date.today().isoformat())
    if exp is not None:
        checked.write.mode("overwrite").parquet(f"{out}/expectations")
        counts["expectations_failed"] = checked.where(~F.col("passed")).count()
    return counts


def cmd_update(spark, a) -> dict:
    """Bring the tables that ``assemble`` built up to date with one batch of
    ``transform``. Datasets that the batch does not touch are neither read nor
    written; of the others, only touched entities are resolved again."""
    tasks = spark.read.parquet(a.tasks)
    done = reliable_checkpoint(tasks.select("dataset", F.col("old_resource").alias("resource")).distinct())
    names = sorted(r[0] for r in done.select("dataset").distinct().collect())  # datasets of one batch
    src, out = a.transformed_dir.rstrip("/"), a.output_dir.rstrip("/")
    t = PK.stored_datasets(spark, SRC.ddl(TRANSFORMED_SCHEMA), f"{src}/transformed", names)
    if t is None:
        raise FileNotFoundError(f"No transformed rows under {src}")
    with_dataset = {name: SRC.with_partition(package_schema(name)) for name in ("entity", "fact", "fact_resource", "issue")}
    stored = {name: PK.stored_datasets(spark, schema, f"{out}/{name}", names) for name, schema in with_dataset.items()}
    stored = {name: spark.createDataFrame([], with_dataset[name]) if df is None else df for name, df in stored.items()}
    organisation = None
    if a.pipeline_dir:
        organisation = SRC.scan_csv_table(spark, f"{a.pipeline_dir.rstrip('/')}/entity-organisation.csv",
                                          ["dataset", "entity_minimum", "entity_maximum", "organisation"])
    tables = J.update_built(t, done, stored, organisation)
    issues = PK.stored_datasets(spark, with_dataset["issue"], f"{src}/issue", names)
    if issues is not None:
        kept = stored["issue"].join(done, ["dataset", "resource"], "left_anti")
        tables["issue"] = PK.merge_issues(kept, issues.join(done, ["dataset", "resource"], "left_semi")).select(*with_dataset["issue"].names)
    tables = {name: reliable_checkpoint(df) for name, df in tables.items()}  # all are read before the first is replaced
    for name, df in tables.items():
        PK.replace_datasets(df, f"{out}/{name}", names)
    return {"datasets": len(names), **{name: df.count() for name, df in tables.items()}}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="gleaner")
    sub = p.add_subparsers(dest="command", required=True)

    b = sub.add_parser("build-package")
    b.add_argument("--dataset", required=True)
    b.add_argument("--parquet-datasets-path", required=True)
    b.add_argument("--output-path", required=True)
    b.add_argument("--collection-data-path", required=True)
    b.add_argument("--collection", required=True)
    b.add_argument("--specification-dir", required=True)
    b.set_defaults(fn=cmd_build_package)

    def selection_args(s, versions=True):
        s.add_argument("--collection-dir", required=True)
        s.add_argument("--dataset", default=None)
        s.add_argument("--offset", type=int, default=None)
        s.add_argument("--limit", type=int, default=None)
        s.add_argument("--output", required=True)
        if versions:
            s.add_argument("--dataset-resource-dir", default="var/dataset-resource/")
            s.add_argument("--pipeline-dir", default="pipeline/")
            s.add_argument("--specification-dir", default="specification/")
            s.add_argument("--reprocess", action="store_true")
            s.add_argument("--state-path", default=None)

    def location_args(s):
        s.add_argument("--bucket", default=None)
        s.add_argument("--base-url", default=None)
        s.add_argument("--collection-name", required=True)

    t = sub.add_parser("plan-transform")
    selection_args(t)
    t.set_defaults(fn=cmd_plan_transform)

    r = sub.add_parser("plan-resources")
    selection_args(r)
    location_args(r)
    r.set_defaults(fn=cmd_plan_resources)

    x = sub.add_parser("plan-transformed")
    selection_args(x, versions=False)
    location_args(x)
    x.set_defaults(fn=cmd_plan_transformed)

    v = sub.add_parser("plan-dataset-resource")
    v.add_argument("--collection-dir", required=True)
    v.add_argument("--dataset", default=None)
    v.add_argument("--dataset-resource-dir", default="var/dataset-resource/")
    v.add_argument("--output", required=True)
    location_args(v)
    v.set_defaults(fn=cmd_plan_dataset_resource)

    i = sub.add_parser("collect")
    i.add_argument("--collection-dir", required=True)
    i.add_argument("--output", required=True)
    i.add_argument("--dataset-resource-dir", default=None, help="version log: counts leave out what is up to date")
    i.add_argument("--pipeline-dir", default="pipeline/")
    i.add_argument("--specification-dir", default="specification/")
    i.add_argument("--log-dir", default=None, help="daily log partitions <dir>/<yyyy-mm-dd>/*.csv, in place of log.csv")
    i.add_argument("--regenerate-log", action="store_true", help="read every day again")
    i.add_argument("--no-refill", action="store_true", help="do not read today's partition afresh")
    i.add_argument("--today", default=None, help="the day that is read afresh (default: the current date)")
    i.set_defaults(fn=cmd_collect)

    w = sub.add_parser("transform")
    w.add_argument("--tasks", required=True, help="task list written by plan-transform")
    w.add_argument("--resource-dir", required=True)
    w.add_argument("--pipeline-dir", default="pipeline/")
    w.add_argument("--specification-dir", default="specification/")
    w.add_argument("--output-dir", required=True)
    w.add_argument("--entry-date", default=None)
    w.add_argument("--single-line", action="store_true", help="no CSV value holds a line break: large files are read in splits")
    w.add_argument("--keep-converted", action="store_true", help="also write the records as read, before any phase")
    w.add_argument("--on-missing", choices=["fail", "record"], default="fail")
    w.add_argument("--dataset-resource-dir", default=None,
                   help="version log that plan-transform reads; the batch's versions are added")
    w.set_defaults(fn=cmd_transform)

    u = sub.add_parser("update")
    u.add_argument("--tasks", required=True, help="task list of the batch")
    u.add_argument("--transformed-dir", required=True, help="output dir of transform")
    u.add_argument("--output-dir", required=True, help="output dir of assemble")
    u.add_argument("--pipeline-dir", default=None, help="for entity-organisation.csv")
    u.set_defaults(fn=cmd_update)

    m = sub.add_parser("assemble")
    m.add_argument("--transformed-dir", required=True, help="output dir of transform")
    m.add_argument("--output-dir", required=True)
    m.add_argument("--dataset", default=None)
    m.add_argument("--expectations", default=None, help="CSV: name,condition,min-count,max-count")
    m.add_argument("--pipeline-dir", default=None, help="for entity-organisation.csv")
    m.add_argument("--specification-dir", default=None, help="for field.csv: the columns of the flattened tables")
    m.add_argument("--history-dir", default=None, help="add the issues to this operational history")
    m.add_argument("--entry-date", default=None)
    m.set_defaults(fn=cmd_assemble)
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    args = parser().parse_args(argv)
    if getattr(args, "bucket", None) is None and hasattr(args, "base_url") and not args.base_url:
        raise SystemExit("Error: Either --bucket or --base-url must be provided")
    logging.basicConfig(level=logging.INFO, format="%(levelname)s: %(message)s")
    spark = spark or SparkSession.builder.appName(f"gleaner-{args.command}").getOrCreate()
    out = args.fn(spark, args)
    print(json.dumps(out, default=str))
    return out


if __name__ == "__main__":
    main(sys.argv[1:])
