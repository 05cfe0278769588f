"""A built dataset after one more batch equals a full build."""

from pathlib import Path

from gleaner import cli
from gleaner.operators import package as PK
from gleaner.schemas import package_schema
from gleaner.sources import files as SRC

ROW = "dataset string, resource string, entry_number bigint, entity bigint, field string, value string, entry_date string, priority bigint"


def rows(spark, *found):
    return spark.createDataFrame([(d, r, n, e, f, v, "2024-01-01", 1) for d, r, n, e, f, v in found], ROW).select(
        "entity", "resource", "entry_number", "entry_date", "priority", "field", "value", "dataset")


def issues(spark, *found):
    schema = SRC.with_partition(package_schema("issue"))
    return spark.createDataFrame([tuple({"dataset": d, "resource": r, "value": v}.get(n) for n in schema.names) for d, r, v in found], schema)


def batch(spark, out, found, found_issues, done):
    done = spark.createDataFrame(done, "dataset string, resource string")
    PK.replace_resources(rows(spark, *found), f"{out}/transformed", done)
    PK.replace_resources(issues(spark, *found_issues), f"{out}/issue", done)
    done.withColumnRenamed("resource", "old_resource").write.mode("overwrite").parquet(f"{out}/tasks")


def files(folder):
    return {str(p): p.stat().st_mtime_ns for p in Path(folder).rglob("*.parquet")}


def test_update_equals_a_full_build_and_keeps_other_files(spark, tmp_path):
    out, built = tmp_path / "out", tmp_path / "built"
    (tmp_path / "p").mkdir()
    (tmp_path / "p" / "entity-organisation.csv").write_text("dataset,entity-minimum,entity-maximum,organisation\ntree,1,9,org-x\n")
    batch(spark, out, [("tree", "a", 1, 1, "name", "Oak"), ("tree", "a", 2, 2, "name", "Ash"), ("tree", "b", 1, 1, "size", "3"),
                       ("tree", "b", 2, 4, "name", "Fir"), ("zone", "a", 1, 1, "name", "Z"), ("gone", "g", 1, 7, "name", "G")],
          [("tree", "a", "i1"), ("tree", "b", "i2"), ("zone", "a", "i3")], [("tree", "a"), ("tree", "b"), ("zone", "a"), ("gone", "g")])
    cli.main(["assemble", "--transformed-dir", str(out), "--output-dir", str(built), "--pipeline-dir", str(tmp_path / "p")], spark=spark)
    before = files(built / "entity" / "dataset=zone")
    # a names other entities now, c is new (as is its dataset), g has no rows left
    batch(spark, out, [("tree", "a", 1, 1, "name", "Elm"), ("tree", "a", 2, 3, "name", "Yew"), ("tree", "c", 1, 4, "size", "9"), ("bush", "c", 1, 5, "name", "Box")],
          [("tree", "a", "i4"), ("bush", "c", "i5")], [("tree", "a"), ("tree", "c"), ("bush", "c"), ("gone", "g")])
    args = ["update", "--tasks", str(out / "tasks"), "--transformed-dir", str(out), "--output-dir", str(built), "--pipeline-dir", str(tmp_path / "p")]
    assert cli.main(args, spark=spark)["datasets"] == 3
    assert files(built / "entity" / "dataset=zone") == before

    full = tmp_path / "full"
    cli.main(["assemble", "--transformed-dir", str(out), "--output-dir", str(full), "--pipeline-dir", str(tmp_path / "p")], spark=spark)

    def read(root, name):
        found = spark.read.schema(SRC.with_partition(package_schema(name))).parquet(str(root / name))
        return sorted(found.collect(), key=str)

    for name in ("entity", "fact", "fact_resource", "issue"):
        assert read(built, name) == read(full, name), name
    assert [(r["dataset"], r["entity"], r["name"]) for r in read(built, "entity")] and not any(r["dataset"] == "gone" for r in read(built, "entity"))
    # the same batch once more changes nothing
    cli.main(args, spark=spark)
    assert read(built, "entity") == read(full, "entity") and read(built, "fact_resource") == read(full, "fact_resource")
