"""Expectations counted by the pass that writes a table."""

import pytest

from gleaner.operators.expectations import check_expectations, expectations_table, watch_expectations

ROWS = [("a", 1), ("b", None), (None, 3), ("it's", 4)]
EXPECTED = [("some", "n > 0", 1, None), ("none missing", "name IS NULL", 0, 0), ("open", "n IS NULL", None, None),
            ("quoted", "name = \"it's\"", 1, 1), ("too few", "n < 0", 1, 2)]


@pytest.mark.parametrize("rows", [ROWS, []])
@pytest.mark.parametrize("expected", [EXPECTED, []])
def test_watched_equals_checked(spark, tmp_path, rows, expected):
    df = spark.createDataFrame(rows, "name string, n bigint").repartition(3)
    exp = expectations_table(spark, expected) if expected else expectations_table(spark, [("x", "n > 0", 0, 0)]).limit(0)
    watched, results = watch_expectations(df, exp)
    watched.write.parquet(str(tmp_path / "t"))
    count, found = results()
    assert count == len(rows) == spark.read.schema("name string, n bigint").parquet(str(tmp_path / "t")).count()
    want = [tuple(r) for r in check_expectations(df, exp).collect()] if expected else []
    assert [tuple(r) for r in found.where("name is not null").collect()] == want
    if rows and expected:
        assert [r["passed"] for r in found.collect()] == [True, False, True, True, False]


def test_only_rows_are_counted_without_expectations(spark, tmp_path):
    watched, results = watch_expectations(spark.range(7).toDF("n"), None)
    watched.write.parquet(str(tmp_path / "t"))
    count, found = results()
    assert count == 7 and found.where("name is not null").count() == 0
