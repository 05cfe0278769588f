"""Facts from whole entries: the same rows, dealt before they are taken apart."""

import pytest
from pyspark.sql import functions as F

from gleaner.operators import facts as FA
from gleaner.operators import package as PK
from gleaner.operators import phases as PH
from gleaner.plans import queries as Q
from gleaner.plans import transform_job as TJ

SCHEMA = ("dataset string, entity bigint, resource string, entry_number bigint, entry_date string, "
          "priority bigint, fields array<struct<field:string,value:string>>")
HEX = "0123456789abcdef" * 4
FIELDS = [[("name", "a"), ("name", "a"), ("organisation_entity", "7"), ("status", None)], [("name", "a"), (None, "x")], [], None]


def entries(spark):
    """Entries with repeated, empty and missing fields, and with nulls in all else."""
    return spark.createDataFrame(
        [("d", e, r, n, date, p, f) for e in (1, -1, 5, None) for r in (HEX, "Zürich", None) for n, date, p in (
            (0, "2020-01-01", 1), (0, "2020-01-01", 1), (-3, None, None), (None, "", -7), (1 << 20, "9999", 5000))
         for f in FIELDS], SCHEMA)


def collected(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


def shuffles(df):
    """The shuffles of a plan outside of broadcasts, each with what is below it."""
    plan = df.select("*")._jdf.queryExecution().executedPlan().toString()
    parts = plan.split("Exchange hashpartitioning")
    return [p.split("BroadcastExchange")[0] for p in parts[1:]]


def test_provenance_is_joined_where_its_tables_lie(spark):
    # an entry without entity, whose field reads like one, has the id of another's fact
    odd = spark.createDataFrame([("d", None, "r", 1, "2020", 1, [("1", "name|a")])], SCHEMA)
    t = entries(spark).unionByName(odd)
    ranks = FA.rank_dates(t)
    df = FA.fact_provenance(FA.make_facts(t, ranked=False, size=ranks.rows, keep_place=True),
                            FA.make_fact_resources(t, ranks=ranks, keep_place=True))
    assert collected(df) == collected(FA.fact_provenance(FA.make_facts(t), FA.make_fact_resources(t)))
    assert len(shuffles(df)) == 2 and all(s.startswith("(_place") for s in shuffles(df))
    query = Q.QUERIES["fact_provenance"][0](spark, "/root/testdata/sf0.001")
    assert len(shuffles(query)) == 2


@pytest.mark.parametrize("ranked", [True, False])
def test_fact_resources_of_entries_are_those_of_their_rows(spark, ranked, monkeypatch):
    t = entries(spark)
    ranks = FA.rank_dates(t) if ranked else None
    want = FA.explode_fields(t).select(FA.fact_id("entity", "field", "value").alias("fact"), "entry_date",
                                       "entry_number", "priority", "resource").distinct()
    got = FA.make_fact_resources(t, ranks=ranks)
    assert collected(got) == collected(want) == collected(FA.make_fact_resources(FA.explode_fields(t), ranks=ranks))
    assert got.schema["priority"].dataType == t.schema["priority"].dataType
    assert len(shuffles(got)) == 1 and "inline" not in shuffles(got)[0]
    # a merit that does not fit into a number is compared as it is
    monkeypatch.setattr(FA, "MAX_RANKED_BYTES", 0)
    assert collected(FA.make_fact_resources(t, ranks=ranks)) == collected(want)


def test_rows_are_dealt_to_as_many_parts_as_they_need(spark, monkeypatch):
    t = entries(spark)
    n = t.count()
    monkeypatch.setattr(FA, "ENTRIES_PER_PART", 1)
    ranks = FA.rank_dates(t)
    assert ranks.rows == n > int(spark.conf.get("spark.sql.shuffle.partitions"))
    for df in (FA.make_fact_resources(t, size=n), FA.make_fact_resources(t, ranks=ranks), FA.make_facts(t, ranks=ranks),
               FA.resolve_fields(t, ranks)):
        assert f", {n}), REPARTITION_BY_NUM" in shuffles(df)[0].splitlines()[0]


def test_facts_and_winners_of_entries_are_those_of_their_rows(spark):
    t = entries(spark)
    for run in (FA.make_facts, FA.resolve_fields, FA.resolve_entities):
        assert collected(run(t)) == collected(run(FA.explode_fields(t)))
        assert "inline" not in shuffles(run(t))[-1]
    assert collected(FA.make_facts(t)) == collected(FA.make_facts(t, ranked=False))
    assert FA.json_fields(t.where("size(fields) = 4")) == FA.json_fields(FA.explode_fields(t.where("size(fields) = 4")))


def test_table_counts_deal_entries_whole(spark, monkeypatch):
    made = []
    monkeypatch.setattr(PK, "table_counts", lambda tables, run=PK.table_counts: made.append(tables) or run(tables))
    rows = {r["table"]: r["rows"] for r in Q.QUERIES["table_counts"][0](spark, "/root/testdata/sf0.001").collect()}
    assert rows == {name: df.count() for name, df in made[0].items()} and len(rows) == 3
    for df in made[0].values():
        assert all("inline" not in s for s in shuffles(df) if "REPARTITION" in s.splitlines()[0])


def test_transformed_facts_carry_no_log_through_the_joins(spark):
    d = "/root/testdata/sf0.001"
    full, slim = TJ.staged(spark, d), TJ.staged(spark, d, log=False)
    assert collected(PH.facts_entries(full, F.lit(1))) == collected(PH.facts_entries(slim, F.lit(1)))
    cols = ["dataset", "entry_number", "entity", F.col("st.keep").alias("keep"),
            F.transform("st.fields", lambda x: F.struct(x["field"], x["value"])).alias("fields")]
    assert collected(full.select(*cols)) == collected(slim.select(*cols))
    assert {r[0] for r in slim.select(F.explode("st.issues.issue_type")).distinct().collect()} <= {"unknown-entity"}
    assert full.select(F.explode("st.issues")).count() > slim.select(F.explode("st.issues")).count()
    assert "resource" not in slim.columns and "column" not in slim.select(F.inline("st.fields")).columns
    df = Q.QUERIES["transformed_facts"][0](spark, d)
    dealt = [s for s in shuffles(df) if "REPARTITION" in s.splitlines()[0]]
    assert len(dealt) == 1 and "inline" not in dealt[0].split("Exchange")[0]
