"""Job compositions and sinks end to end on small in-memory inputs and a
temp tree."""

from pyspark.sql import functions as F

from gleaner.operators import expectations as EX
from gleaner.operators import package as PK
from gleaner.operators import selection as SEL
from gleaner.operators.collection import collection_datasets, require_nonempty
from gleaner.plans import jobs as J

import pytest


def _inputs(spark):
    log = spark.createDataFrame(
        [("ep1", "r1", "2024-01-01", "200"), ("ep1", "r2", "2024-01-02", "200"),
         ("ep2", "r2", "2024-01-03", "200"), ("ep2", None, "2024-01-03", "500")],
        "endpoint string, resource string, entry_date string, status string") \
        .withColumn("entry_date", F.col("entry_date").cast("date"))
    source = spark.createDataFrame([("s1", "org-a", "ep1", "c", "trees"), ("s2", "org-b", "ep2", "c", "trees")],
                                   "source string, organisation string, endpoint string, "
                                   "collection string, pipelines string")
    old = spark.createDataFrame([], "seq bigint, old_resource string, resource string, status string")
    raw = spark.createDataFrame([("trees", "r1", 1, "T1", "Oak"), ("trees", "r2", 1, "T2", "Ash"),
                                 ("trees", "r2", 2, "T3", "")],
                                "dataset string, resource string, entry_number bigint, Ref string, Name string")
    configs = {
        "column": spark.createDataFrame([("trees", "Ref", "reference"), ("trees", "Name", "name")],
                                        "dataset string, column string, field string"),
        "default_value": spark.createDataFrame([("trees", "name", "unnamed")],
                                               "dataset string, field string, value string"),
        "prefix": spark.createDataFrame([("trees", "tree")], "dataset string, prefix string"),
    }
    lookup = spark.createDataFrame([("tree", "T1", 1), ("tree", "T2", 2), ("tree", "T3", 3)],
                                   "prefix string, reference string, entity bigint")
    old_entity = spark.createDataFrame([], "old_entity string, entity string, status string")
    return log, source, old, raw, configs, lookup, old_entity


def test_nightly(spark):
    log, source, old, raw, configs, lookup, old_entity = _inputs(spark)
    exp = EX.expectations_table(spark, [("no unnamed", "name = 'unnamed'", 0, 0)])
    out = J.nightly(log, source, old, raw, ["Ref", "Name"], configs, lookup, old_entity,
                    reprocess=True, expectations=exp)
    tasks = {r["old_resource"]: (r["endpoints"], r["organisations"], r["entry_date"])
             for r in out["tasks"].collect()}
    assert tasks == {"r1": ("ep1", "org-a", "2024-01-01"), "r2": ("ep1 ep2", "org-a org-b", "2024-01-02")}
    ents = {r["entity"]: r["name"] for r in out["entity"].collect()}
    assert ents == {1: "Oak", 2: "Ash", 3: "unnamed"}
    e = out["expectations"].first()
    assert (e["matched"], e["passed"]) == (1, False)
    issues = [(r["issue_type"], r["field"]) for r in out["issues"].collect()]
    assert issues == [("default-value", "name")]


def test_nightly_reads_redirected_resources(spark):
    log, source, _old, raw, configs, lookup, old_entity = _inputs(spark)
    old = spark.createDataFrame([(1, "r1", "r1-new", "301")], "seq bigint, old_resource string, resource string, status string")
    raw = raw.unionByName(spark.createDataFrame([("trees", "r1-new", 1, "T1", "From the new file")], raw.schema))
    combine = spark.createDataFrame([("trees", "name", " + ")], "dataset string, field string, separator string")
    out = J.nightly(log, source, old, raw, ["Ref", "Name"], configs, lookup, old_entity, reprocess=True, combine=combine)
    assert {r["entity"]: r["name"] for r in out["entity"].collect()} == {1: "From the new file", 2: "Ash", 3: "unnamed"}


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("d", "r1", "x"), ("d", "r2", "y")],
                               "dataset string, resource string, value string")
    PK.write_csv(df, str(tmp_path / "csv"))
    assert spark.read.option("header", "true").csv(str(tmp_path / "csv")).count() == 2
    PK.write_flattened(df, str(tmp_path / "flat"))
    assert spark.read.json(str(tmp_path / "flat" / "json")).count() == 2
    PK.write_artefacts(df, str(tmp_path / "art"))
    assert spark.read.parquet(str(tmp_path / "art")).where("dataset = 'd'").count() == 2
    PK.append_operational_issues(df, str(tmp_path / "ops"), "2024-01-01")
    PK.append_operational_issues(df, str(tmp_path / "ops"), "2024-01-02")
    assert spark.read.parquet(str(tmp_path / "ops")).count() == 4
    remote = df.limit(0)
    new = PK.sync_new(df, remote, ["resource"], str(tmp_path / "sync"))
    assert new.count() == 2
    again = PK.sync_new(df, spark.read.parquet(str(tmp_path / "sync")), ["resource"],
                        str(tmp_path / "sync"))
    assert again.count() == 0


def test_collection_datasets_and_guard(spark):
    spec = spark.createDataFrame([("a", "c1", 1, 2), ("b", "c2", 3, 4)],
                                 "dataset string, collection string, entity_minimum bigint, "
                                 "entity_maximum bigint")
    assert [r[0] for r in collection_datasets(spec, "c1").collect()] == ["a"]
    with pytest.raises(ValueError, match="No transformed files"):
        require_nonempty(spec.limit(0), "transformed files")


def test_artefact_fetch_job(spark):
    pairs = spark.createDataFrame([("d", "r1"), ("d", "r2"), ("d", "r3")], "dataset string, resource string")
    old = spark.createDataFrame([(1, "r2", "", "410")], "seq bigint, old_resource string, resource string, status string")
    man, fpt = J.plan_artefact_fetch(pairs, old, "c", bucket="b", offset=0, limit=2)
    assert man.count() == 5  # r1 only: r2 retired after slicing, r3 outside the slice
    f = fpt.first()
    assert (f["n_files"], f["n_tasks"], f["files_per_task"]) == (5, 1, 5)
    assert SEL


def test_transform_reads_raw_files_of_tasks(spark, tmp_path):
    from gleaner.sources.files import scan_raw_resource
    d = tmp_path / "collection" / "resource"
    d.mkdir(parents=True)
    (d / "new1").write_text("Ref,Name\nT1,Oak\nT2,Ash\n")
    (d / "r3").write_text("Ref,Name\nT3,Elm\n")
    tasks = spark.createDataFrame(
        [("old1", "trees", "new1", "p"), ("old1", "shrubs", "new1", "p"), ("r3", "trees", "r3", "p")],
        "old_resource string, dataset string, resource string, path string")
    raw = scan_raw_resource(spark, str(d))
    rows = J.task_rows(raw, tasks)
    got = sorted((r["dataset"], r["resource"], r["entry_number"], r["Ref"]) for r in rows.collect())
    assert got == [("shrubs", "old1", 1, "T1"), ("shrubs", "old1", 2, "T2"),
                   ("trees", "old1", 1, "T1"), ("trees", "old1", 2, "T2"), ("trees", "r3", 1, "T3")]
    _log, _src, _old, _raw, configs, lookup, old_entity = _inputs(spark)
    t = J.transform(rows.where("dataset = 'trees'"), ["Ref", "Name"], configs, lookup, old_entity)
    ents = sorted((r["resource"], r["entity"]) for r in t.rows.where("field = 'name'").collect())
    assert ents == [("old1", 1), ("old1", 2), ("r3", 3)]
