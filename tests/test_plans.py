"""Plan properties of every registered query, the driver contract, and the
DuckDB oracle on the smallest scale factor."""

import duckdb
import pytest

import __spark_entry__ as E
from gleaner.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()
PY_NODES = ["BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas",
            "PythonUDF"]
BAD_JOINS = ["BroadcastNestedLoopJoin", "CartesianProduct"]


@pytest.fixture(scope="module")
def plans(spark):
    out = {}
    for name, (fn, _sql) in QUERIES.items():
        df = fn(spark, SF)
        out[name] = (df, df._jdf.queryExecution().executedPlan().toString())
    return out


def test_every_query_has_an_oracle_or_is_listed(plans):
    assert set(QUERIES) <= set(E.queries()) and set(QUERIES) <= set(E.oracle_sql())


def test_no_python_in_registered_plans(plans):
    for name, (_df, plan) in plans.items():
        assert not any(n in plan for n in PY_NODES), name


def test_no_nested_loop_or_cartesian_joins(plans):
    for name, (_df, plan) in plans.items():
        assert not any(n in plan for n in BAD_JOINS), name


def test_no_windows_in_registered_plans(plans):
    # a window without a partition key runs in one task; none is used at all
    for name, (_df, plan) in plans.items():
        assert "Window " not in plan and "Window(" not in plan, name


def test_fact_aggregations_are_hash_based(plans):
    # winners carry their value as text, which only a sort-based aggregate can hold
    for name in ("make_facts", "make_fact_resources", "resource_index", "skip_counts"):
        assert "SortAggregate" not in plans[name][1], name


def test_scans_are_pruned(plans):
    # only the hashed text and the source are needed
    plan = plans["build_pairs"][1]
    assert "ReadSchema: struct<text:string,source:string>" in plan
    assert "n_chars" not in plan
    plan = plans["make_fact_resources"][1]
    assert "l_tax" not in plan and "l_discount" not in plan


def test_entry_contract(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["old_resource", "dataset", "resource", "path", "endpoints",
                          "organisations", "entry_date"]


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if v.__class__.__name__ == "Decimal":
        return round(float(v), 6)
    return v


def test_oracle_matches_at_smallest_scale(spark, plans):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    failures = []
    for name, (_fn, sql) in QUERIES.items():
        df = plans[name][0]
        cols = sorted(df.columns)
        got = sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=repr)
        res = con.execute(sql)
        dcols = [c[0] for c in res.description]
        if sorted(dcols) != cols:
            failures.append((name, "columns", dcols))
            continue
        idx = [dcols.index(c) for c in cols]
        exp = sorted((tuple(_norm(r[i]) for i in idx) for r in res.fetchall()), key=repr)
        if got != exp:
            failures.append((name, len(got), len(exp)))
    assert failures == []
