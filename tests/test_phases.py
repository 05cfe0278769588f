"""Transform phases on a small fixture: each phase's contract."""

from pyspark.sql import functions as F

from gleaner.operators import phases as PH

COLS = ["Ref", "Name", "Kind", "Date"]


def cfg(spark, name, cols, rows):
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in ["dataset"] + cols))


def configs(spark):
    return {
        "column": cfg(spark, "column", ["column", "field"],
                      [("d", "Ref", "reference"), ("d", "Name", "name"), ("d", "Date", "start_date")]),
        "skip": cfg(spark, "skip", ["pattern"], [("d", "^SKIP")]),
        "patch": cfg(spark, "patch", ["field", "pattern", "replacement"],
                     [("d", "kind", "^old$", "new")]),
        "filter": cfg(spark, "filter", ["field", "pattern"], [("d", "name", "^[A-Z]")]),
        "concat": cfg(spark, "concat", ["field", "fields", "separator"],
                      [("d", "label", "name;kind", "-")]),
        "default": cfg(spark, "default", ["field", "default_field"], [("d", "end_date", "start_date")]),
        "default_value": cfg(spark, "default_value", ["field", "value"], [("d", "typology", "thing")]),
        "transform": cfg(spark, "transform", ["field", "replacement_field"], [("d", "kind", "category")]),
        "prefix": cfg(spark, "prefix", ["prefix"], [("d", "thing")]),
    }


def raw(spark):
    rows = [("d", "r1", 1, "1", "Alpha", "old", "2020-01-01"),
            ("d", "r1", 2, "2", "beta", "old", None),
            ("d", "r1", 3, "SKIP", "Gamma", "x", None),
            ("d", "r2", 1, "9", "Delta", None, ""),
            ("e", "r3", 1, "5", "Eps", "k", None)]
    return spark.createDataFrame(
        rows, "dataset string, resource string, entry_number bigint, Ref string, Name string, "
              "Kind string, Date string")


def run(spark):
    c = PH.dataset_config(spark, configs(spark))
    e = PH.to_entries(raw(spark), COLS, c)
    for step in [PH.map_columns, PH.patch_values, PH.filter_entries, PH.concat_fields,
                 PH.default_fields, PH.default_values, PH.rename_fields]:
        e = step(e)
    lookup = spark.createDataFrame([("thing", "1", 101)], "prefix string, reference string, entity bigint")
    e = PH.assign_entities(e, lookup)
    old = spark.createDataFrame([("101", "202", "301")], "old_entity string, entity string, status string")
    return PH.redirect_entities(e, old)


def fields(e):
    out = {}
    for r in PH.entry_rows(e, with_entity=True).collect():
        out.setdefault((r["resource"], r["entry_number"]), {})[r["field"]] = r["value"]
        out[(r["resource"], r["entry_number"])]["@entity"] = r["entity"]
    return out


def test_phases_end_to_end(spark):
    e = run(spark)
    got = fields(e)
    # skipped row gone, lower-case name filtered out
    assert set(got) == {("r1", 1), ("r2", 1), ("r3", 1)}
    a = got[("r1", 1)]
    assert a["reference"] == "1" and a["name"] == "Alpha" and a["category"] == "new"
    assert a["label"] == "Alpha-new" and a["end_date"] == "2020-01-01"
    assert a["typology"] == "thing" and a["@entity"] == 202  # looked up, then redirected
    d = got[("r2", 1)]
    assert "start_date" not in d and "end_date" not in d and d["label"] == "Delta"
    assert d["@entity"] is None
    # dataset without config: unmapped columns get normalised names
    assert set(got[("r3", 1)]) >= {"ref", "name", "kind"}


def test_issue_log(spark):
    iss = PH.entry_issues(run(spark))
    kinds = sorted((r["resource"], r["entry_number"], r["issue_type"], r["field"], r["value"])
                   for r in iss.collect())
    assert ("r1", 1, "patch", "kind", "old") in kinds
    assert ("r1", 2, "patch", "kind", "old") in kinds  # raised before its entry was filtered
    assert ("r1", 1, "default-field", "end_date", "2020-01-01") in kinds
    assert ("r2", 1, "unknown-entity", "reference", "9") in kinds
    assert not any(k[1] == 3 and k[0] == "r1" for k in kinds)  # skipped row raises nothing
    assert iss.columns == PH.ISSUE_FIELDS


def test_retired_entity_dropped(spark):
    c = PH.dataset_config(spark, configs(spark))
    e = PH.map_columns(PH.to_entries(raw(spark), COLS, c))
    lookup = spark.createDataFrame([("thing", "1", 101)], "prefix string, reference string, entity bigint")
    e = PH.assign_entities(e, lookup)
    old = spark.createDataFrame([("101", "", "410"), ("x", "1", "301")],
                                "old_entity string, entity string, status string")
    kept = PH.entry_rows(PH.redirect_entities(e, old), with_entity=True)
    assert kept.where(F.col("resource") == "r1").where(F.col("entry_number") == 1).count() == 0


def test_combine_values(spark):
    rows = spark.createDataFrame([("d", 1, "tag", "b"), ("d", 1, "tag", "a"), ("d", 1, "tag", "b"),
                                  ("d", 2, "tag", "z")],
                                 "dataset string, entity bigint, field string, value string")
    c = spark.createDataFrame([("d", "tag", ";")], "dataset string, field string, separator string")
    got = {r["entity"]: r["value"] for r in PH.combine_values(rows, c).collect()}
    assert got == {1: "a;b", 2: "z"}


def test_phase_edge_cases(spark):
    c = PH.dataset_config(spark, {
        "column": cfg(spark, "column", ["column", "field"], [("d", "A", "a"), ("d", "B", "b")]),
        "concat": cfg(spark, "concat", ["field", "fields", "separator"], [("d", "ab", "a;b", "+")]),
        "default": cfg(spark, "default", ["field", "default_field"], [("d", "c", "zz")]),
        "filter": cfg(spark, "filter", ["field", "pattern"], [("d", "b", "^ok$")]),
    })
    raw = spark.createDataFrame([("d", "r", 1, "x", None), ("d", "r", 2, "y", "ok"), ("d", "r", 3, "z", "bad")],
                                "dataset string, resource string, entry_number bigint, A string, B string")
    e = PH.to_entries(raw, ["A", "B"], c)
    for step in [PH.map_columns, PH.filter_entries, PH.concat_fields, PH.default_fields]:
        e = step(e)
    got = {}
    for r in PH.entry_rows(e).collect():
        got.setdefault(r["entry_number"], {})[r["field"]] = r["value"]
    # entry 1 has no b: the filter does not apply; concat skips the missing part
    assert got[1] == {"a": "x", "ab": "x"}
    assert got[2] == {"a": "y", "b": "ok", "ab": "y+ok"}
    assert 3 not in got  # b present and not matching: dropped
    # the default's source field never exists: nothing added, no issue
    assert PH.entry_issues(e).count() == 0


def test_resource_specific_and_duplicate_config_rows(spark):
    col = spark.createDataFrame(
        [("d", None, "A", "a"), ("d", "r2", "A", "special"), ("d", None, "B", "b"), ("d", None, "B", "b")],
        "dataset string, resource string, column string, field string")
    dv = spark.createDataFrame([("d", "r1", "only_r1", "yes")],
                               "dataset string, resource string, field string, value string")
    c = PH.dataset_config(spark, {"column": col, "default_value": dv})
    raw = spark.createDataFrame([("d", "r1", 1, "x", "y"), ("d", "r2", 1, "z", "w")],
                                "dataset string, resource string, entry_number bigint, A string, B string")
    e = PH.default_values(PH.map_columns(PH.to_entries(raw, ["A", "B"], c)))
    got = {}
    for r in PH.entry_rows(e).collect():
        got.setdefault(r["resource"], {})[r["field"]] = r["value"]
    assert got == {"r1": {"a": "x", "b": "y", "only_r1": "yes"}, "r2": {"special": "z", "b": "w"}}


def test_repeated_lookup_rows_do_not_duplicate_entries(spark):
    c = PH.dataset_config(spark, {
        "column": cfg(spark, "column", ["column", "field"], [("d", "Ref", "reference")]),
        "prefix": cfg(spark, "prefix", ["prefix"], [("d", "thing")])})
    raw = spark.createDataFrame([("d", "r", 1, "1")], "dataset string, resource string, "
                                                      "entry_number bigint, Ref string")
    lookup = spark.createDataFrame([("thing", "1", 7), ("thing", "1", 5)],
                                   "prefix string, reference string, entity bigint")
    e = PH.assign_entities(PH.map_columns(PH.to_entries(raw, ["Ref"], c)), lookup)
    rows = PH.entry_rows(e, with_entity=True).collect()
    assert [(r["field"], r["entity"]) for r in rows] == [("reference", 5)]


def test_organisation_specific_lookup_wins(spark):
    c = PH.dataset_config(spark, {
        "column": cfg(spark, "column", ["column", "field"],
                      [("d", "Ref", "reference"), ("d", "Org", "organisation")]),
        "prefix": cfg(spark, "prefix", ["prefix"], [("d", "thing")])})
    raw = spark.createDataFrame([("d", "r", 1, "1", "org-a"), ("d", "r", 2, "1", "org-b"),
                                 ("d", "r", 3, "1", None)],
                                "dataset string, resource string, entry_number bigint, Ref string, Org string")
    lookup = spark.createDataFrame([("thing", "1", "org-a", 10), ("thing", "1", "", 20)],
                                   "prefix string, reference string, organisation string, entity bigint")
    e = PH.assign_entities(PH.map_columns(PH.to_entries(raw, ["Ref", "Org"], c)), lookup)
    got = {r["entry_number"]: r["entity"] for r in PH.entry_rows(e, with_entity=True)
           .where("field = 'reference'").collect()}
    assert got == {1: 10, 2: 20, 3: 20}
