"""Command-line entry points on a temp collection tree."""

import pytest

from gleaner import cli


@pytest.fixture()
def tree(tmp_path):
    c = tmp_path / "collection"
    c.mkdir()
    (c / "log.csv").write_text(
        "endpoint,resource,entry-date,status\n"
        "ep1,aaa,2024-01-01T10:00:00Z,200\nep2,bbb,2024-01-02T10:00:00Z,200\n"
        "ep2,ccc,2024-01-03T10:00:00Z,200\nep1,,2024-01-04T10:00:00Z,500\n")
    (c / "source.csv").write_text(
        "source,organisation,endpoint,collection,pipelines\n"
        "s1,org-a,ep1,trees,tree\ns2,org-b,ep2,trees,tree;tree-zone\n")
    (c / "old-resource.csv").write_text(
        "old-resource,status,resource\nbbb,301,zzz\nccc,410,\nbbb,301,yyy\n")
    for d in ("pipeline", "specification"):
        (tmp_path / d).mkdir()
        (tmp_path / d / "x.csv").write_text(f"{d}\n")
    dr = tmp_path / "var" / "dataset-resource" / "tree"
    dr.mkdir(parents=True)
    (dr / "aaa.csv").write_text("dataset,resource,code-version,config-hash,specification-hash\n"
                                "tree,aaa,old,x,y\n")
    return tmp_path


def _common(t):
    return ["--collection-dir", str(t / "collection"), "--dataset-resource-dir",
            str(t / "var" / "dataset-resource"), "--pipeline-dir", str(t / "pipeline"),
            "--specification-dir", str(t / "specification")]


def test_plan_transform(spark, tree):
    out = str(tree / "tasks")
    cli.main(["plan-transform", *_common(tree), "--output", out], spark=spark)
    rows = sorted((r["dataset"], r["old_resource"], r["resource"], r["endpoints"], r["entry_date"])
                  for r in spark.read.parquet(out).collect())
    # bbb redirected to its last entry (yyy); ccc removed; aaa has a stale log
    assert rows == [("tree", "aaa", "aaa", "ep1", "2024-01-01"), ("tree", "bbb", "yyy", "ep2", "2024-01-02"),
                    ("tree-zone", "bbb", "yyy", "ep2", "2024-01-02")]


def test_plan_resources_and_transformed(spark, tree):
    out = str(tree / "res")
    got = cli.main(["plan-resources", *_common(tree), "--output", out, "--collection-name", "trees",
                    "--base-url", "https://files.example.org/"], spark=spark)
    urls = sorted(r["url"] for r in spark.read.parquet(out).collect())
    assert got["files"] == 2 and urls == [
        "https://files.example.org/trees-collection/collection/resource/aaa",
        "https://files.example.org/trees-collection/collection/resource/yyy"]
    out2 = str(tree / "art")
    fpt = cli.main(["plan-transformed", "--collection-dir", str(tree / "collection"), "--output", out2,
                    "--collection-name", "trees", "--bucket", "b", "--offset", "0", "--limit", "3"],
                   spark=spark)
    assert fpt == {"n_files": 10, "n_tasks": 2, "files_per_task": 5}  # ccc retired


def test_plan_dataset_resource(spark, tree):
    got = cli.main(["plan-dataset-resource", "--collection-dir", str(tree / "collection"),
                    "--dataset-resource-dir", str(tree / "var" / "dataset-resource"),
                    "--output", str(tree / "logs"), "--collection-name", "trees", "--bucket", "b"],
                   spark=spark)
    assert got == {"downloaded": 1, "not_found": 4}


def test_needs_bucket_or_base(spark, tree):
    with pytest.raises(SystemExit):
        cli.main(["plan-transformed", "--collection-dir", str(tree / "collection"),
                  "--output", str(tree / "x"), "--collection-name", "trees"], spark=spark)


def test_transform_resources_with_different_headers(spark, tree):
    res = tree / "collection" / "resource"
    res.mkdir()
    (res / "aaa").write_text("Ref,Name,Size\nT1,Oak,3\nT2,Ash,\n")
    (res / "yyy").write_text("Name,Extra,Ref\nElm,x,T3\n")  # permuted header, extra column
    pipe = tree / "pipeline"
    (pipe / "column.csv").write_text("dataset,column,field\ntree,Ref,reference\ntree,Name,name\n"
                                    "tree-zone,Ref,reference\ntree-zone,Name,name\n")
    (pipe / "default-value.csv").write_text("dataset,field,value\ntree,size,unknown\n")
    (pipe / "lookup.csv").write_text("prefix,reference,organisation,entity\n"
                                    "tree,T1,,1\ntree,T2,,2\ntree,T3,,3\n")
    (tree / "specification" / "dataset.csv").write_text(
        "dataset,prefix,entity-minimum,entity-maximum\ntree,tree,1,99\ntree-zone,tree,1,99\n")
    tasks = str(tree / "tasks")
    cli.main(["plan-transform", *_common(tree), "--output", tasks, "--reprocess"], spark=spark)
    out = tree / "out"
    got = cli.main(["transform", "--tasks", tasks, "--resource-dir", str(res),
                    "--pipeline-dir", str(pipe), "--specification-dir", str(tree / "specification"),
                    "--output-dir", str(out), "--entry-date", "2024-02-01"], spark=spark)
    assert got == {"tasks": 3, "successful": 3, "failed": 0}
    rows = spark.read.parquet(str(out / "transformed"))
    names = sorted((r["dataset"], r["resource"], r["entity"], r["value"])
                   for r in rows.where("field = 'name'").collect())
    # yyy's columns matched by its own header; outputs keyed by the listed id bbb
    assert names == [("tree", "aaa", 1, "Oak"), ("tree", "aaa", 2, "Ash"), ("tree", "bbb", 3, "Elm"),
                     ("tree-zone", "bbb", 3, "Elm")]
    sizes = sorted((r["entity"], r["value"]) for r in rows.where("field = 'size'").collect())
    assert sizes == [(1, "3"), (2, "unknown"), (3, "unknown")]
    issues = spark.read.parquet(str(out / "issue"))
    assert issues.where("issue_type = 'default-value'").count() == 2
    logs = spark.read.parquet(str(out / "dataset-resource"))
    assert sorted((r["dataset"], r["resource"]) for r in logs.collect()) == [
        ("tree", "aaa"), ("tree", "bbb"), ("tree-zone", "bbb")]

    # assemble, then package one dataset from what assemble wrote
    (tree / "expect.csv").write_text("name,condition,min-count,max-count\n"
                                     "named,name IS NULL,0,0\nall have a size,json NOT LIKE '%size%',0,0\n"
                                     "open bound,json IS NULL,0,\n")
    built = tree / "built"
    counts = cli.main(["assemble", "--transformed-dir", str(out), "--output-dir", str(built),
                       "--expectations", str(tree / "expect.csv")], spark=spark)
    assert counts["entity"] == 4 and counts["issue"] == 2 and counts["expectations_failed"] == 1
    ents = sorted((r["dataset"], r["entity"], r["name"], r["json"])
                  for r in spark.read.parquet(str(built / "entity")).collect())
    # the unmapped Extra column becomes field "extra", kept in json
    assert ents == [("tree", 1, "Oak", '{"size":"3"}'), ("tree", 2, "Ash", '{"size":"unknown"}'),
                    ("tree", 3, "Elm", '{"extra":"x","size":"unknown"}'),
                    ("tree-zone", 3, "Elm", '{"extra":"x"}')]
    flat = spark.read.option("header", "true").csv(str(built / "flattened" / "csv"))
    assert "size" in flat.columns and "json" not in flat.columns
    coll = tree / "cdata"
    (coll / "trees-collection").mkdir(parents=True)
    pkg = cli.main(["build-package", "--dataset", "tree", "--parquet-datasets-path", str(built),
                    "--output-path", str(tree / "package"), "--collection-data-path", str(coll),
                    "--collection", "trees", "--specification-dir", str(tree / "specification")], spark=spark)
    assert pkg["entity"] == 3 and pkg["issue"] == 2 and pkg["fact"] > 0


def test_transform_missing_resource(spark, tree):
    res = tree / "collection" / "resource"
    res.mkdir()
    (res / "aaa").write_text("Ref\nT1\n")
    tasks = str(tree / "tasks")
    cli.main(["plan-transform", *_common(tree), "--output", tasks, "--reprocess"], spark=spark)
    args = ["transform", "--tasks", tasks, "--resource-dir", str(res), "--pipeline-dir",
            str(tree / "pipeline"), "--specification-dir", str(tree / "specification"),
            "--output-dir", str(tree / "out"), "--entry-date", "2024-02-01"]
    with pytest.raises(FileNotFoundError, match="yyy"):
        cli.main(args, spark=spark)
    with pytest.raises(SystemExit):
        cli.main(args + ["--on-missing", "record"], spark=spark)


def test_batches_accumulate_and_close_the_loop(spark, tree):
    res = tree / "collection" / "resource"
    res.mkdir()
    (res / "aaa").write_text('Ref,"Name, full",Tag\nT1,"Oak, ""old""",b\nT1,Oak again,a\n')
    (res / "yyy").write_text("\ufeffTag,Ref\nx,T3\n")
    pipe = tree / "pipeline"
    (pipe / "column.csv").write_text('dataset,column,field\ntree,Ref,reference\ntree,"Name, full",name\ntree-zone,Ref,reference\n')
    (pipe / "patch.csv").write_text("dataset,field,pattern,replacement\ntree,tag,^b$,c\ntree,tag,^c$,d\n")
    (pipe / "lookup.csv").write_text("prefix,reference,organisation,entity\ntree,T1,,1\ntree,T3,,3\n")
    (pipe / "combine.csv").write_text("dataset,field,separator\ntree,tag,;\n")
    (pipe / "entity-organisation.csv").write_text("dataset,entity-minimum,entity-maximum,organisation\ntree,1,2,org-x\ntree,2,9,org-y\n")
    spec = tree / "specification"
    (spec / "dataset.csv").write_text("dataset,prefix\ntree,tree\ntree-zone,tree\n")
    (spec / "field.csv").write_text("field\ntag\nheight\n")
    logs, out = tree / "log", tree / "out"
    logs.mkdir()

    def plan(*extra):
        args = ["plan-transform", "--collection-dir", str(tree / "collection"), "--dataset-resource-dir", str(logs),
                "--pipeline-dir", str(pipe), "--specification-dir", str(spec), "--output", str(tree / "tasks"), *extra]
        return cli.main(args, spark=spark)["tasks"]

    def transform():
        return cli.main(["transform", "--tasks", str(tree / "tasks"), "--resource-dir", str(res), "--pipeline-dir", str(pipe),
                         "--specification-dir", str(spec), "--output-dir", str(out), "--dataset-resource-dir", str(logs),
                         "--entry-date", "2024-02-01"], spark=spark)

    assert plan("--offset", "0", "--limit", "1") == 1
    assert transform() == {"tasks": 1, "successful": 1, "failed": 0}
    assert plan() == 2
    assert transform() == {"tasks": 2, "successful": 2, "failed": 0}
    assert plan() == 0
    rows = spark.read.parquet(str(out / "transformed"))
    assert sorted((r["dataset"], r["resource"], r["field"], r["value"]) for r in rows.where("field in ('tag', 'name')").collect()) == [
        ("tree", "aaa", "name", "Oak again"), ("tree", "aaa", "name", 'Oak, "old"'), ("tree", "aaa", "tag", "a;d"),
        ("tree", "bbb", "tag", "x"), ("tree-zone", "bbb", "tag", "x")]
    issues = spark.read.parquet(str(out / "issue"))
    assert sorted(r["value"] for r in issues.where("issue_type = 'patch'").collect()) == ["b", "c"]
    assert spark.read.parquet(str(out / "result")).where("ok").count() == 3
    built = tree / "built"
    counts = cli.main(["assemble", "--transformed-dir", str(out), "--output-dir", str(built), "--pipeline-dir", str(pipe),
                       "--specification-dir", str(spec), "--history-dir", str(tree / "history"), "--entry-date", "2024-02-01"], spark=spark)
    assert counts["entity"] == 3
    got = {(r["dataset"], r["entity"]): r["organisation_entity"] for r in spark.read.parquet(str(built / "entity")).collect()}
    assert got == {("tree", 1): "org-x", ("tree", 3): "org-y", ("tree-zone", 3): None}
    flat = spark.read.option("header", "true").csv(str(built / "flattened" / "csv"))
    assert "tag" in flat.columns and "height" in flat.columns
    assert spark.read.parquet(str(tree / "history")).count() == counts["issue"]


def test_assemble_without_issues(spark, tree):
    facts = spark.createDataFrame([("tree", 1, "aaa", 1, None, 1, "reference", "T1")],
                                  "dataset string, entity bigint, resource string, entry_number bigint, entry_date string, priority bigint, field string, value string")
    facts.write.partitionBy("dataset").parquet(str(tree / "t" / "transformed"))
    (tree / "t" / "issue").mkdir()
    counts = cli.main(["assemble", "--transformed-dir", str(tree / "t"), "--output-dir", str(tree / "b")], spark=spark)
    assert counts == {"entity": 1, "fact": 1, "fact_resource": 1, "issue": 0}


def test_collect(spark, tree):
    args = ["collect", "--collection-dir", str(tree / "collection"), "--output", str(tree / "index")]
    assert cli.main(args, spark=spark) == {"resources": 3, "new": 3}
    assert cli.main(args, spark=spark) == {"resources": 3, "new": 0}
    index = {r["resource"]: r["datasets"] for r in spark.read.parquet(str(tree / "index" / "resource")).collect()}
    assert index == {"aaa": "tree", "bbb": "tree;tree-zone", "ccc": "tree;tree-zone"}


def test_revert_is_due_again_and_the_log_stays_compact(spark, tree):
    res = tree / "collection" / "resource"
    res.mkdir()
    for name in ("aaa", "yyy"):
        (res / name).write_text("Ref\nT1\n")
    logs = tree / "log"
    logs.mkdir()
    config = tree / "pipeline" / "x.csv"
    args = ["--pipeline-dir", str(tree / "pipeline"), "--specification-dir", str(tree / "specification")]

    def plan(*extra):
        return cli.main(["plan-transform", "--collection-dir", str(tree / "collection"), "--dataset-resource-dir", str(logs), *args,
                         "--output", str(tree / "tasks"), *extra], spark=spark)["tasks"]

    def transform():
        cli.main(["transform", "--tasks", str(tree / "tasks"), "--resource-dir", str(res), *args, "--output-dir", str(tree / "out"),
                  "--dataset-resource-dir", str(logs), "--entry-date", "2024-02-01"], spark=spark)

    assert plan() == 3
    transform()
    first, runs = config.read_text(), 0
    for text in ("b\n", first):  # to another configuration, and back
        assert plan() == 0
        config.write_text(text)
        assert plan() == 3
        transform()
        runs += 1
    assert plan() == 0 and runs == 2
    stored = cli._version_log(spark, str(logs))
    assert stored.count() == stored.select("dataset", "resource").distinct().count() == 3
    # a batch of one dataset leaves the others' rows
    config.write_text("c\n")
    assert plan("--dataset", "tree-zone") == 1
    transform()
    assert plan() == 2 and cli._version_log(spark, str(logs)).count() == 3


def test_collect_state_feeds_the_plan(spark, tree):
    index = tree / "index"
    cli.main(["collect", "--collection-dir", str(tree / "collection"), "--output", str(index), *_common(tree)[2:]], spark=spark)
    counts = {r["dataset"]: (r["listed"], r["skipped"], r["remaining"]) for r in spark.read.parquet(str(index / "state-counts")).collect()}
    assert counts == {"tree": (3, 0, 3), "tree-zone": (2, 0, 2)}

    def plan(state, dataset, *extra):
        out = str(tree / "tasks")
        cli.main(["plan-transform", *_common(tree), "--output", out, "--state-path", str(state), "--dataset", dataset, *extra], spark=spark)
        return sorted(r["old_resource"] for r in spark.read.parquet(out).collect())

    assert plan(index / "state", "tree") == ["aaa", "bbb"]
    assert plan(index / "state", "tree-zone") == ["bbb"]
    assert plan(index / "state", "tree", "--offset", "1", "--limit", "1") == ["bbb"]
    document = tree / "state.json"
    document.write_text('{\n  "transform_resources": {\n    "tree": ["bbb", "aaa"],\n    "none": []\n  }\n}\n')
    assert plan(document, "tree") == ["aaa", "bbb"] and plan(document, "tree", "--offset", "1") == ["aaa"]
    for state in (index / "state", document):
        with pytest.raises(KeyError, match="absent"):
            plan(state, "absent")


def test_a_bad_pattern_costs_its_resources_alone(spark, tree):
    res = tree / "collection" / "resource"
    res.mkdir()
    for name in ("aaa", "yyy"):
        (res / name).write_text("Ref\nT1\n")
    pipe = tree / "pipeline"
    (pipe / "column.csv").write_text("dataset,column,field\ntree,Ref,reference\ntree-zone,Ref,reference\n")
    (pipe / "skip.csv").write_text("dataset,resource,pattern\ntree,aaa,(unclosed\ntree,,^nothing$\n")
    (pipe / "lookup.csv").write_text("prefix,reference,organisation,entity\ntree,T1,,1\n")
    (tree / "specification" / "dataset.csv").write_text("dataset,prefix\ntree,tree\ntree-zone,tree\n")
    tasks, out = str(tree / "tasks"), tree / "out"
    cli.main(["plan-transform", *_common(tree), "--output", tasks, "--reprocess"], spark=spark)
    with pytest.raises(SystemExit):
        cli.main(["transform", "--tasks", tasks, "--resource-dir", str(res), "--pipeline-dir", str(pipe), "--specification-dir",
                  str(tree / "specification"), "--output-dir", str(out), "--entry-date", "2024-02-01"], spark=spark)
    results = {(r["dataset"], r["resource"]): r["error"] for r in spark.read.parquet(str(out / "result")).collect()}
    assert results == {("tree", "aaa"): "skip: invalid pattern (unclosed", ("tree", "bbb"): None, ("tree-zone", "bbb"): None}
    rows = spark.read.parquet(str(out / "transformed"))
    assert {(r["dataset"], r["resource"]) for r in rows.collect()} == {("tree", "bbb"), ("tree-zone", "bbb")}
    assert spark.read.parquet(str(out / "dataset-resource")).count() == 2
