"""Batch transform with error capture, and incremental log loading."""

from helpers_batch import fail_on_bad

from gleaner.operators import batch as B
from gleaner.streaming import incremental as INC


def test_failures_become_rows(spark):
    df = spark.createDataFrame([("r1", "ok"), ("r1", "ok"), ("r2", "bad"), ("r3", "ok")],
                               "resource string, value string")
    res = B.run_with_errors(df, fail_on_bad)
    got = {r["resource"]: (r["ok"], r["rows"]) for r in res.collect()}
    assert got == {"r1": (True, 2), "r2": (False, 0), "r3": (True, 1)}
    s = B.summarise_results(res).first()
    assert (s["successful"], s["failed"]) == (2, 1)
    err = B.failed_resources(res).first()
    assert err["resource"] == "r2" and "bad value" in err["error"]


def _day(root, day, rows):
    d = root / day
    d.mkdir(parents=True)
    (d / "part.csv").write_text("endpoint,resource,status,entry-date\n" +
                                "".join(f"{e},{r},200,{day}T01:00:00Z\n" for e, r in rows))


def test_incremental_log_loading(spark, tmp_path):
    logs = tmp_path / "log"
    _day(logs, "2024-01-01", [("e1", "a"), ("e2", "b")])
    _day(logs, "2024-01-02", [("e1", "c")])
    table, ckpt = str(tmp_path / "table"), str(tmp_path / "ckpt")
    assert INC.load_new_logs(spark, str(logs), table, ckpt) == 3
    assert INC.load_new_logs(spark, str(logs), table, ckpt) == 0  # nothing new
    _day(logs, "2024-01-03", [("e3", "d")])
    assert INC.load_new_logs(spark, str(logs), table, ckpt) == 1
    back = spark.read.parquet(table)
    assert back.count() == 4
    assert sorted(str(r["log_date"]) for r in back.select("log_date").distinct().collect()) == [
        "2024-01-01", "2024-01-02", "2024-01-03"]


def test_logs_with_other_headers_and_a_replayed_batch(spark, tmp_path):
    day = tmp_path / "log" / "2024-03-01"
    day.mkdir(parents=True)
    (day / "one.csv").write_text("endpoint,resource,status,entry-date\ne1,r1,200,2024-03-01T01:00:00Z\n")
    (day / "two files.csv").write_text('status,entry-date,"resource",extra,endpoint\n404,2024-03-01,,x,e2\n')
    table, state = str(tmp_path / "table"), str(tmp_path / "state")
    assert INC.load_new_logs(spark, str(tmp_path / "log"), table, state) == 2
    # the same files again under a fresh state are batch 0 again: replaced, not doubled
    assert INC.load_new_logs(spark, str(tmp_path / "log"), table, str(tmp_path / "other")) == 2
    got = sorted((r["endpoint"], r["resource"], r["status"], str(r["entry_date"]), str(r["log_date"])) for r in spark.read.parquet(table).collect())
    assert got == [("e1", "r1", "200", "2024-03-01", "2024-03-01"), ("e2", None, "404", "2024-03-01", "2024-03-01")]


def test_a_resource_without_name_is_kept_and_callbacks_see_whole_resources(spark):
    rows = [("a", k) for k in range(95)] + [(None, 1), (None, 2)]
    df = spark.createDataFrame(rows, "resource string, value long").repartition(6)
    got = {r["resource"]: (r["ok"], r["rows"]) for r in B.run_with_errors(df, lambda pdf: pdf).collect()}
    assert got == {"a": (True, 95), None: (True, 2)}


def test_streamed_callbacks_fail_one_by_one(spark):
    from helpers_batch import double_in_pieces

    from gleaner.operators.batch import run_streamed
    rows = [("big", i, f"v{i}") for i in range(1, 3001)] + [("late", i, "bad" if i == 2500 else "x") for i in range(1, 3001)]
    rows += [(f"r{k}", 1, "a") for k in range(40)] + [(None, 1, "n"), (None, 2, "m")]
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        df = spark.createDataFrame(rows, "resource string, entry_number long, value string").repartition(4)
        out, results = run_streamed(df, double_in_pieces, "resource string, entry_number bigint, value string")
        got = {r["resource"]: (r["ok"], r["rows"], r["error"]) for r in results.collect()}
        assert got.pop("late") == (False, 0, "ValueError: bad value in late")
        assert got.pop("big") == (True, 3000, None) and got.pop(None) == (True, 2, None)
        assert len(got) == 40 and set(got.values()) == {(True, 1, None)}
        want = sorted((r, n, v * 2) for r, n, v in rows if r not in ("late", None))
        assert sorted(tuple(r) for r in out.where("resource is not null").collect()) == want
        assert out.where("resource is null").count() == 2
        empty, none = run_streamed(df.limit(0), double_in_pieces, "resource string, entry_number bigint, value string")
        assert empty.count() == 0 and none.count() == 0
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
