"""Facts and entity resolution on small fixtures."""

import pytest

from gleaner.operators import facts as FA

SCHEMA = ("dataset string, entity bigint, resource string, entry_number bigint, "
          "entry_date string, priority bigint, field string, value string")


def rows(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def test_winner_priority_then_date_then_entry(spark):
    t = rows(spark, [
        ("d", 1, "r1", 1, "2020-01-01", 2, "name", "late-low-priority"),
        ("d", 1, "r2", 1, "2019-01-01", 1, "name", "early-high-priority"),
        ("d", 1, "r3", 1, "2019-06-01", 1, "name", "later-high-priority"),
        ("d", 1, "r3", 2, "2019-06-01", 1, "reference", "A"),
        ("d", 1, "r3", 3, "2019-06-01", 1, "reference", "B"),
        ("d", 1, "r3", 3, "2019-06-01", 1, "colour", "red"),
    ])
    e = FA.resolve_entities(t).first()
    assert e["name"] == "later-high-priority"
    assert e["reference"] == "B"  # same date, later entry
    assert e["json"] == '{"colour":"red"}'
    assert e["entry_date"] == "2019-06-01"


def test_flatten_explicit_column_wins(spark):
    t = rows(spark, [("d", 1, "r", 1, "2020-01-01", 1, "name", "N"),
                     ("d", 1, "r", 1, "2020-01-01", 1, "colour", "red")])
    ents = FA.resolve_entities(t)
    ents = ents.withColumn("json", ents["json"].substr(0, 0))  # keep types
    t2 = FA.resolve_entities(t)
    flat = FA.flatten_entities(t2).first()
    assert flat["colour"] == "red" and flat["name"] == "N" and "json" not in flat.asDict()
    clash = t2.selectExpr("*", "'{\"name\":\"other\"}' AS j").drop("json").withColumnRenamed("j", "json")
    assert FA.flatten_entities(clash).first()["name"] == "N"


def test_update_equals_full_resolution(spark):
    data = [("d", e, f"r{i}", i, f"2020-01-{i % 28 + 1:02d}", 1 + i % 2, "name", f"v{i % 5}")
            for e in range(5) for i in range(20)]
    t = rows(spark, data)
    old, new = t.where("entry_number < 12"), t.where("entry_number >= 12")
    upd = FA.update_entities(FA.resolve_entities(old), old, new)
    full = FA.resolve_entities(t)
    assert sorted(map(tuple, upd.collect())) == sorted(map(tuple, full.collect()))


def test_checksum_order_insensitive_and_duplicates_count(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (2, "y")], "k int, v string")
    b = spark.createDataFrame([(2, "y"), (1, "x"), (2, "y")], "k int, v string")
    c = spark.createDataFrame([(1, "x")], "k int, v string")
    ca, cb, cc = (FA.table_checksum(x).first() for x in (a, b, c))
    assert tuple(ca) == tuple(cb) and ca["checksum"] != cc["checksum"]


def test_fact_ids_and_provenance(spark):
    t = rows(spark, [("d", 1, "r1", 1, "2020-01-01", 1, "name", "N"),
                     ("d", 1, "r2", 4, "2021-01-01", 2, "name", "N")])
    facts = FA.make_facts(t)
    assert facts.count() == 1
    f = facts.first()
    assert f["priority"] == 1 and f["entry_date"] == "2021-01-01"
    assert FA.make_fact_resources(t).count() == 2
    assert FA.fact_provenance(facts, FA.make_fact_resources(t)).count() == 2


ODD_OBSERVATIONS = [
    ("d", 1, f"r{i}", n, date, p, field, value)
    for field in ("name", "colour")
    for i, (n, date, p, value) in enumerate([
        (1, "2020-01-01", 2, "a"), (None, "2020-01-01", 2, "b"), (3, "2020-01-01T10:00:00", 2, "c"),
        (2, None, 2, "d"), (2, "", 2, "e"), (9, "Zürich", None, "f"), (3, "2020-01-01T10:00:00", 2, "g"),
        (-4, "9999-12-31", 2, "c"), (1, "2020", 2, "h"), (7, "2020-01-01", 2, None)])]


def _as_text(monkeypatch, run):
    with monkeypatch.context() as m:
        m.setattr(FA, "MAX_RANKED_BYTES", -1)
        return run()


def test_ranked_dates_give_what_texts_give(spark, monkeypatch):
    big = 2 ** 63 - 1
    tables = {
        "odd": ODD_OBSERVATIONS,
        "one field each": [r[:6] + (f"f{k}",) + r[7:] for k, r in enumerate(ODD_OBSERVATIONS)],
        "no dates": [("d", 1, "r", 1, None, None, "name", v) for v in "ba"],
        "wide ranges": [("d", 1, "r", n, "2020-01-01", p, "name", f"{n}{p}")
                        for n in (-big - 1, 0, big) for p in (-big - 1, 0, big)],
        "far numbers": [("d", 1, "r", big - k, "2020-01-01", -big - 1 + k, "name", str(k)) for k in range(3)],
        "empty": [],
    }
    for name, data in tables.items():
        t = rows(spark, data)
        for run in (FA.make_facts, FA.resolve_fields):
            ranked = sorted(map(repr, run(t).collect()))
            assert ranked == sorted(map(repr, _as_text(monkeypatch, lambda: run(t).collect()))), (name, run)
            if run is FA.make_facts:
                assert len(ranked) == len({(r[1], r[6], r[7]) for r in data}), name


def test_ranks_serve_facts_and_fields_alike(spark):
    t = rows(spark, ODD_OBSERVATIONS)
    ranks = FA.rank_dates(t)
    assert ranks.count == 7
    dates = [r["_date"] for r in sorted(ranks.table.collect(), key=lambda r: r["_rank"])]
    assert dates == [None, "", "2020", "2020-01-01", "2020-01-01T10:00:00", "9999-12-31", "Zürich"]
    assert FA.make_facts(t, ranks=ranks).count() == FA.make_facts(t).count()
    won = {r["field"]: (r["value"], r["entry_date"]) for r in FA.resolve_fields(t, ranks).collect()}
    assert won["name"] == ("c", "9999-12-31")


def test_a_date_without_a_rank_is_an_error(spark):
    ranks = FA.rank_dates(rows(spark, ODD_OBSERVATIONS))
    late = rows(spark, [("d", 1, "r", 1, "2021-01-01", 1, "name", "x")])
    with pytest.raises(Exception, match="entry date without a rank"):
        FA.make_facts(late, ranks=ranks).collect()
