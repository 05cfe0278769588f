"""Collection index from daily log partitions."""

from test_cli import tree  # noqa: F401

from gleaner import cli


def test_collect_reads_new_days_alone_and_refills_today(spark, tree):  # noqa: F811
    log, out = tree / "log", str(tree / "index")

    def day(date, name, *rows, header="endpoint,resource,entry-date,status"):
        (log / date).mkdir(parents=True, exist_ok=True)
        (log / date / f"{name}.csv").write_text("\n".join([header, *rows]) + "\n")

    def collect(*extra):
        got = cli.main(["collect", "--collection-dir", str(tree / "collection"), "--output", out, "--log-dir", str(log), *extra], spark=spark)
        return got, sorted(r["resource"] for r in spark.read.parquet(f"{out}/resource").collect())

    assert collect("--today", "2024-01-01") == ({"resources": 0, "new": 0, "log_rows_added": 0}, [])
    day("2024-01-01", "a", "ep1,aaa,2024-01-01T10:00:00Z,200", "ep2,bbb,2024-01-01T11:00:00Z,200")
    assert collect("--today", "2024-01-01") == ({"resources": 2, "new": 2, "log_rows_added": 2}, ["aaa", "bbb"])
    day("2024-01-02", "a", "200,ccc,ep1,2024-01-02", header="status,resource,endpoint,entry-date")
    # the second run loads the new day alone
    assert collect("--today", "2024-01-02") == ({"resources": 3, "new": 1, "log_rows_added": 1}, ["aaa", "bbb", "ccc"])
    # today's file changes: read afresh, unless told not to; an earlier day's change needs a rebuild
    day("2024-01-02", "a", "ep1,ddd,2024-01-02,200")
    day("2024-01-01", "a", "ep1,eee,2024-01-01,200")
    assert collect("--no-refill")[1] == ["aaa", "bbb", "ccc"]
    assert collect("--today", "2024-01-02")[1] == ["aaa", "bbb", "ddd"]
    assert collect("--regenerate-log") == ({"resources": 2, "new": 1, "log_rows_added": 2}, ["ddd", "eee"])
    assert collect("--today", "2024-01-03") == ({"resources": 2, "new": 0, "log_rows_added": 0}, ["ddd", "eee"])
