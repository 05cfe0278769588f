"""What the fact steps send through the network, and that it changes no row."""

import pytest

from gleaner.operators import facts as FA
from gleaner.plans import queries as Q

SCHEMA = ("dataset string, entity bigint, resource string, entry_number bigint, "
          "entry_date string, priority bigint, field string, value string")
HEX = "0123456789abcdef" * 4
RESOURCES = [HEX, HEX.upper(), "abc", "0abc", "", "not hex", "Zürich", None]


def rows(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def odd(spark):
    return rows(spark, [("d" if e else None, e, r, n, "2020-01-01", 1, "name", v)
                        for e in (1, None) for r in RESOURCES for n in (1, 1, None) for v in ("a", None)])


def plan_of(df):
    """The plan as first made; one that ran would hold its final form too."""
    return df.select("*")._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    """The shuffles of a plan outside of broadcasts, as lines."""
    return [line for line in plan_of(df).splitlines() if "Exchange hashpartitioning" in line]


def test_resources_of_any_form_keep_their_text(spark):
    got = [tuple(r) for r in FA.make_fact_resources(odd(spark)).select("fact", "entry_number", "resource").collect()]
    want = {(r["fact"], r["entry_number"], r["resource"]) for r in
            odd(spark).select(FA.fact_id("entity", "field", "value").alias("fact"), "entry_number", "resource").collect()}
    assert len(got) == len(set(got)) and set(got) == want


def test_fact_resources_are_dealt_before_they_are_compared(spark):
    # no table of groups before the shuffle, and resources cross it as bytes
    df = FA.make_fact_resources(odd(spark))
    plan = plan_of(df)
    below = plan[plan.index("Exchange hashpartitioning"):]
    assert len(exchanges(df)) == 1 and "Aggregate" not in below and "_resource_raw" in below.splitlines()[0]


def test_provenance_joins_ids_of_any_form(spark):
    ids = [HEX, HEX.upper(), "abc", "0abc", "", "x", None]
    facts = spark.createDataFrame([(i, k, "name", "v") for k, i in enumerate(ids)], "fact string, entity bigint, field string, value string")
    stated = spark.createDataFrame([(i, r, "2020-01-01", k) for k, i in enumerate(ids) for r in RESOURCES],
                                   "fact string, resource string, entry_date string, entry_number bigint")
    df = FA.fact_provenance(facts, stated)
    assert df.columns == ["fact", "entity", "field", "value", "resource", "resource_entry_date", "entry_number"]
    got = {(r["fact"], r["entity"], r["resource"], r["entry_number"]) for r in df.collect()}
    assert got == {(i, k, r, k) for k, i in enumerate(ids) if i is not None for r in RESOURCES}
    assert df.count() == len(got) and "_fact_raw" in exchanges(df)[0]


@pytest.mark.parametrize("run", ["make_facts", "resolve_fields", "resolve_entities"])
def test_one_shuffle_by_entity(spark, run):
    t = odd(spark)
    ranks = FA.rank_dates(t)
    df = getattr(FA, run)(t, ranks=ranks)
    plan = plan_of(df)
    assert len(exchanges(df)) == 1 and "REPARTITION_BY_COL" in exchanges(df)[0]
    assert "Aggregate" not in plan[plan.index("Exchange hashpartitioning"):].split("BroadcastExchange")[0]


def test_unranked_resolution_is_the_same_and_reads_once(spark):
    t = rows(spark, [("d", e, "r", n, date, p, "name", f"{n}{p}{date}") for e in (1, 2, None) for n in (1, None, 7)
                     for p in (1, None, 5) for date in ("2020-01-01", None, "", "2020-01-01T1")])
    ranked, plain = FA.resolve_fields(t), FA.resolve_fields(t, ranked=False)
    assert sorted(map(repr, ranked.collect())) == sorted(map(repr, plain.collect())) and ranked.count() == 3
    assert "_rank" not in plan_of(plain) and len(exchanges(plain)) == 1, plan_of(plain)


def test_update_shuffles_old_rows_once(spark):
    data = [("d", e, f"r{i}", i, f"2020-01-{i % 28 + 1:02d}", 1 + i % 2, "name", f"v{i % 5}") for e in range(5) for i in range(20)]
    t = rows(spark, data)
    old, new = t.where("entry_number < 12"), t.where("entry_number >= 12 and entity < 2")
    made = FA.resolve_entities(old)
    stored = spark.createDataFrame(made.collect(), made.schema)
    upd = FA.update_entities(stored, old, new)
    assert sorted(map(tuple, upd.collect())) == sorted(map(tuple, FA.resolve_entities(old.union(new)).collect()))
    dealt = [line for line in exchanges(upd) if "REPARTITION_BY_COL" in line]
    assert len(dealt) == 1 and sum("SortMergeJoin" in line for line in plan_of(upd).splitlines()) <= 1


def test_update_leaves_rows_without_entity_as_they_were(spark):
    old = rows(spark, [("d", None, "r1", 1, "2020-01-01", 1, "name", "old"), ("d", 1, "r1", 2, "2020-01-01", 1, "name", "kept")])
    new = rows(spark, [("d", None, "r2", 1, "2019-01-01", 2, "name", "new")])
    got = sorted((repr(r["entity"]), r["name"]) for r in FA.update_entities(FA.resolve_entities(old), old, new).collect())
    assert got == [("1", "kept"), ("None", "new"), ("None", "old")]


def test_phases_run_once_in_queries_that_read_their_log_twice(spark, monkeypatch):
    made = []
    monkeypatch.setattr(Q.TJ, "issues", lambda s, d, run=Q.TJ.issues: made.append(run(s, d)) or made[-1])
    for name in ("merge_issues", "stack_issues"):
        plan = plan_of(Q.QUERIES[name][0](spark, "/root/testdata/sf0.001"))
        assert "transform(" not in plan and "orders.parquet" not in plan, name
    assert len(made) == 2


def test_order_entities_evaluate_the_phases_once(spark, monkeypatch):
    monkeypatch.setattr(FA, "rank_dates", lambda t: pytest.fail("a pass over the phases for ranks alone"))
    assert Q.QUERIES["order_entities"][0](spark, "/root/testdata/sf0.001").count() > 0
