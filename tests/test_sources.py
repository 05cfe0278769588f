"""State document, artefact paths, raw-resource row numbers, content hash."""

import json

from gleaner.operators import package as PK
from gleaner.operators import selection as SEL
from gleaner.sources import files as SRC


def test_state_keeps_list_order(spark, tmp_path):
    p = tmp_path / "state.json"
    p.write_text(json.dumps({"transform_resources": {"d1": ["r2", "r1"], "d2": ["r9"]}}, indent=2))
    state = SRC.scan_state(spark, str(p))
    got = SEL.pairs_from_map(state).orderBy("dataset", "pos").collect()
    assert [(r["dataset"], r["pos"], r["resource"]) for r in got] == [
        ("d1", 0, "r2"), ("d1", 1, "r1"), ("d2", 0, "r9")]


def test_state_round_trip_as_lines(spark, tmp_path):
    pairs = spark.createDataFrame([("d1", 0, "r2"), ("d1", 1, "r1"), ("d2", 0, "r9")],
                                  "dataset string, pos bigint, resource string")
    PK.write_state(pairs, str(tmp_path / "state"))
    back = SRC.scan_state_pairs(spark, str(tmp_path / "state"))
    assert sorted((r["dataset"], r["pos"], r["resource"]) for r in back.collect()) == [
        ("d1", 0, "r2"), ("d1", 1, "r1"), ("d2", 0, "r9")]
    got = SEL.state_pairs(back, "d1").orderBy("pos").collect()
    assert [r["resource"] for r in got] == ["r2", "r1"]


def test_state_positions_from_sorted_lists(spark, tmp_path):
    pairs = spark.createDataFrame([("d1", "b"), ("d1", "a"), ("d2", "z"), ("d1", "c")],
                                  "dataset string, resource string")
    PK.write_state(pairs, str(tmp_path / "s2"))
    back = SRC.scan_state_pairs(spark, str(tmp_path / "s2"))
    assert sorted((r["dataset"], r["pos"], r["resource"]) for r in back.collect()) == [
        ("d1", 0, "a"), ("d1", 1, "b"), ("d1", 2, "c"), ("d2", 0, "z")]


def test_artefacts_dataset_and_resource_from_path(spark, tmp_path):
    for ds, res in [("d1", "aaa"), ("d2", "bbb")]:
        d = tmp_path / "issue" / ds
        d.mkdir(parents=True)
        (d / f"{res}.csv").write_text("field,issue_type\nname,patch\n")
    df = SRC.scan_artefacts(spark, str(tmp_path), "issue/")
    assert sorted((r["dataset"], r["resource"], r["field"]) for r in df.collect()) == [
        ("d1", "aaa", "name"), ("d2", "bbb", "name")]


def test_raw_rows_numbered_per_file(spark, tmp_path):
    d = tmp_path / "resource"
    d.mkdir()
    (d / "r1").write_text("a,b\n1,x\n2,y\n3,z\n")
    (d / "r2").write_text("a,b\n9,q\n")
    df = SRC.scan_raw_resource(spark, str(d))
    got = sorted((r["resource"], r["entry_number"], r["a"]) for r in df.collect())
    assert got == [("r1", 1, "1"), ("r1", 2, "2"), ("r1", 3, "3"), ("r2", 1, "9")]


def test_raw_rows_numbered_across_splits(spark, tmp_path):
    d = tmp_path / "big"
    d.mkdir()
    n = 20000
    (d / "r1").write_text("a\n" + "".join(f"{i}\n" for i in range(n)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        df = SRC.scan_raw_resource(spark, str(d), multi_line=False)
        assert df.rdd.getNumPartitions() > 1
        rows = df.select("entry_number", "a").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted((r["entry_number"], int(r["a"])) for r in rows) == [(i + 1, i) for i in range(n)]


def test_content_hash_changes_with_content(spark, tmp_path):
    d = tmp_path / "pipeline"
    d.mkdir()
    (d / "a.csv").write_text("x\n")
    (d / "b.csv").write_text("y\n")
    h1 = PK.content_hash(spark, str(d))
    assert h1 == PK.content_hash(spark, str(d)) and len(h1) == 64
    (d / "b.csv").write_text("z\n")
    assert PK.content_hash(spark, str(d)) != h1


def test_count_files(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"f{i}.csv").write_text("a\n1\n")
    df = spark.read.option("header", "true").csv(str(tmp_path))
    assert PK.count_files(df) == 3


def test_config_csv_by_name(spark, tmp_path):
    from gleaner.operators.package import project_fixed
    p = tmp_path / "old-resource.csv"
    p.write_text("resource,old-resource,status,extra\nnew1,old1,301,x\n,old2,410,y\n")
    df = SRC.scan_csv_table(spark, str(p), ["old_resource", "resource", "status", "notes"])
    rows = sorted(tuple(r) for r in df.collect())
    assert rows == [("old1", "new1", "301", None), ("old2", None, "410", None)]
    assert SRC.scan_csv_table(spark, str(tmp_path / "absent.csv"), ["a"]).count() == 0
    cf = spark.createDataFrame([("r", "c", "f", "x")], "resource string, column string, field string, z string")
    assert project_fixed(cf.withColumn("dataset", cf["z"]), "column_field", "ds").first().asDict() == {
        "dataset": "ds", "resource": "r", "column": "c", "field": "f"}


def test_day_text(spark):
    import datetime
    from gleaner.functions import scalar as X
    df = spark.createDataFrame([(datetime.date(2024, 1, 5),)], "d date")
    assert df.select(X.day_text("d")).first()[0] == "2024-01-05"
