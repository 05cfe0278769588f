"""Raw resources of several formats, as cells and through the transform."""

import json

import pytest
from test_cli import _common, tree  # noqa: F401

from gleaner import cli
from gleaner.sources import raw

FILES = {
    "plain": "Ref,Name\nT1,Oak\n",
    "braces": "\nName,Ref\n{odd},T9\n",
    "lines": '{"Ref": "T2", "Name": "Ash"}\n\n{"Ref": "T3", "Na\n{"Name": null, "Size": 3, "Box": {"a": [1]}}\n[1]\n',
    "array": '[\n {"Ref": "T4"},\n 7,\n {"Ref": "T5", "Name": "Elm, \\"wych\\""}\n]',
    "geo": '{"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {"Ref": "T6"},'
           ' "geometry": {"type": "Point", "coordinates": [1, 2]}}, {"properties": null, "geometry": null}]}',
    "geo-lines": '{\n"type": "FeatureCollection",\n"features": [\n{"properties": {"Ref": "T7"}}\n]}',
    "one": '{\n "Ref": "T8"\n}',
    "broken": '[{"Ref": "T1"}, {"Ref"',
    "broken-geo": '{"type": "FeatureCollection", "features": [{"properties": {"Ref": "T1"}}, {"prop',
    "empty": "",
    "blank": "\n\n",
}


@pytest.fixture()
def folder(tmp_path):
    for name, text in FILES.items():
        (tmp_path / name).write_text(text)
    (tmp_path / "with-mark").write_text('﻿{"Ref": "T1"}\n')
    (tmp_path / "columns").write_bytes(b"PAR1\x15\x04\x15\x00rest")
    (tmp_path / "zeros").write_bytes(b"Ref\x00,Name\nT1\x00,x\n")
    return tmp_path


def test_each_file_by_its_own_format(spark, folder):
    got = raw.scan_raw_files(spark, [str(p) for p in sorted(folder.iterdir())])
    cells = {(r["resource"], r["entry_number"]): {c["column"]: c["value"] for c in r["cells"]} for r in got.cells.collect()}
    point = cells.pop(("geo", 1))
    assert point.pop("Ref") == "T6" and json.loads(point.pop("geometry")) == {"type": "Point", "coordinates": [1, 2]} and not point
    assert cells == {
        ("plain", 1): {"Ref": "T1", "Name": "Oak"}, ("braces", 1): {"Name": "{odd}", "Ref": "T9"},
        ("lines", 1): {"Ref": "T2", "Name": "Ash"}, ("lines", 4): {"Name": None, "Size": "3", "Box": '{"a":[1]}'},
        ("array", 1): {"Ref": "T4"}, ("array", 3): {"Ref": "T5", "Name": 'Elm, "wych"'},
        ("geo", 2): {"geometry": None}, ("geo-lines", 1): {"Ref": "T7", "geometry": None},
        ("one", 1): {"Ref": "T8"}, ("with-mark", 1): {"Ref": "T1"}}
    assert sorted((r["resource"], r["entry_number"], r["record"]) for r in got.rejected.collect()) == sorted(
        [("array", 2, None), ("lines", 3, '{"Ref": "T3", "Na'), ("lines", 5, "[1]")], key=str)
    assert {r["resource"]: r["error"] for r in got.failed.collect()} == {
        "broken": "not a JSON document", "broken-geo": "not a JSON document",
        "columns": "unknown file format", "zeros": "unknown file format"}


def test_no_files_and_blocks_of_files(spark, folder, monkeypatch):
    assert [d.count() for d in raw.scan_raw_files(spark, [])] == [0, 0, 0]
    assert [d.count() for d in raw.scan_raw_files(spark, [str(folder / "empty")])] == [0, 0, 0]
    monkeypatch.setattr(raw, "FILES_PER_SCAN", 2)
    paths = [str(folder / n) for n in ("plain", "array", "broken", "lines", "geo")]
    assert [d.count() for d in raw.scan_raw_files(spark, paths, multi_line=False)] == [7, 3, 1]


def test_transform_of_csv_json_and_a_broken_file(spark, tree, capsys):  # noqa: F811
    (tree / "collection" / "log.csv").write_text(
        "endpoint,resource,entry-date,status\n" + "".join(f"ep1,{r},2024-01-01T10:00:00Z,200\n" for r in ("aaa", "jsn", "bad")))
    res = tree / "collection" / "resource"
    res.mkdir()
    (res / "aaa").write_text("Ref,Name\nT1,Oak\n")
    (res / "jsn").write_text('{"Ref": "T2", "Name": "Ash"}\n{"Ref": \n')
    (res / "bad").write_text('[{"Ref": "T3"}, {')
    (tree / "pipeline" / "column.csv").write_text("dataset,column,field\ntree,Ref,reference\ntree,Name,name\n")
    (tree / "pipeline" / "lookup.csv").write_text("prefix,reference,organisation,entity\n" + "".join(f"tree,T{k},,{k}\n" for k in (1, 2, 3)))
    (tree / "specification" / "dataset.csv").write_text("dataset,prefix,entity-minimum,entity-maximum\ntree,tree,1,99\n")
    tasks, out = str(tree / "tasks"), tree / "out"
    cli.main(["plan-transform", *_common(tree), "--output", tasks, "--reprocess"], spark=spark)
    args = ["transform", "--tasks", tasks, "--resource-dir", str(res), "--pipeline-dir", str(tree / "pipeline"),
            "--specification-dir", str(tree / "specification"), "--output-dir", str(out), "--entry-date", "2024-02-01", "--keep-converted"]
    with pytest.raises(SystemExit):
        cli.main(args, spark=spark)
    assert json.loads(capsys.readouterr().out.splitlines()[-1]) == {"tasks": 3, "successful": 2, "failed": 1}
    rows = spark.read.parquet(str(out / "transformed")).where("field = 'name'")
    assert sorted((r["resource"], r["entity"], r["value"]) for r in rows.collect()) == [("aaa", 1, "Oak"), ("jsn", 2, "Ash")]
    results = {r["resource"]: r["error"] for r in spark.read.parquet(str(out / "result")).collect()}
    assert results == {"aaa": None, "jsn": None, "bad": "not a JSON document: bad"}
    rejected = spark.read.parquet(str(out / "rejected")).collect()
    assert [(r["dataset"], r["resource"], r["entry_number"], r["record"]) for r in rejected] == [("tree", "jsn", 2, '{"Ref": ')]
    kept = spark.read.parquet(str(out / "converted-resource"))
    assert sorted((r["resource"], len(r["cells"])) for r in kept.collect()) == [("aaa", 2), ("jsn", 2)]
    assert {r["resource"] for r in spark.read.parquet(str(out / "dataset-resource")).collect()} == {"aaa", "jsn"}
    # mended, the file is work again and its batch adds up
    (res / "bad").write_text('[{"Ref": "T3", "Name": "Elm"}]')
    assert cli.main(args, spark=spark) == {"tasks": 3, "successful": 3, "failed": 0}
    assert spark.read.parquet(str(out / "transformed")).where("field = 'name'").count() == 3
