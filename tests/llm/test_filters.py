import textwrap

import duckdb
import pandas as pd
import pytest
from conftest import SF

from gleaner.llm import decontamination, license_digests, snapshot_collapse, url_filter
from gleaner.llm.queries import QUERIES


def duck(sql, **tables):
    con = duckdb.connect()
    for name, rows in tables.items():
        con.register(name, rows)
    return con.sql(sql).df()


def same(spark_df, want):
    columns = sorted(want.columns)
    got = spark_df.toPandas()
    assert sorted(got.columns) == columns

    def plain(x):
        return None if pd.isna(x) else x if isinstance(x, (str, bool)) else float(x)

    def rows(df):
        return sorted((tuple(plain(x) for x in r) for r in df[columns].itertuples(index=False)), key=repr)

    assert rows(got) == rows(want)


@pytest.mark.parametrize("name", [n for n, (_f, sql) in QUERIES.items() if sql])
def test_queries_equal_their_sql(spark, name):
    fn, sql = QUERIES[name]
    tables = {t: spark.read.parquet(f"{SF}/{t}.parquet").toPandas() for t in ("documents", "pages", "benchmark", "conversations")}
    same(fn(spark, SF), duck(sql, **tables))


def hits(docs, items):
    return {r["doc"]: (r["n_words"], r["n_hit"], r["n_items"]) for r in decontamination.contamination(docs, items).collect()}


def test_windows_short_items_and_overlaps(spark, edge_docs, empty_docs, clashing_docs):
    items = spark.createDataFrame([
        (1, "Alpha beta, gamma delta epsilon zeta eta theta iota kappa lambda mu"), (2, "short ITEM here"), (3, ""), (4, None), (5, "!!!"), (6, "never seen words at all"), (2, "short item here"),
    ], "item_id long, text string")
    full = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
    docs = spark.createDataFrame([
        (1, "x " + full + " y"), (2, "beta gamma delta epsilon zeta eta theta iota kappa lambda"), (3, "beta gamma delta epsilon zeta eta theta iota kappa"),
        (4, "short item, here short-item here"), (5, None), (6, ""), (7, full + " short item here " + full), (8, "ALPHA" + full), (None, "a Short\nItem\tHere"),
    ], "doc_id long, text string")
    assert hits(docs, items) == {1: (14, 12, 1), 2: (10, 10, 1), 3: (9, 0, 0), 4: (6, 6, 1), 5: (0, 0, 0), 6: (0, 0, 0), 7: (27, 27, 2), 8: (12, 11, 1), None: (4, 3, 1)}
    assert [r["doc_id"] for r in decontamination.drop_contaminated(docs, items).orderBy("doc_id").collect()] == [3, 5, 6]
    none = items.filter("item_id = 99")
    assert {v[1:] for v in hits(docs, none).values()} == {(0, 0)}
    assert hits(empty_docs, items) == {}
    kept = decontamination.drop_contaminated(clashing_docs, items)
    assert kept.columns == clashing_docs.columns and kept.count() == clashing_docs.count()


def test_blocks_of_windows_give_the_same_rows(spark, monkeypatch):
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    whole = sorted(map(tuple, decontamination.contamination(docs, items).collect()))
    monkeypatch.setattr(decontamination, "BLOCK", 150)
    assert sorted(map(tuple, decontamination.contamination(docs, items).collect())) == whole


def urls(spark, rows, links=None, **params):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    if links is not None:
        links = spark.createDataFrame(links, "url string, target string")
    return {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.filter_urls(pages, links, **params).collect()}


def test_rules_parts_and_precedence(spark):
    got = urls(spark, [
        (1, "https://A.Example.ORG/es/x?q#f", None), (2, "http://example.org/en/17", None), (3, "http://x.org", None), (4, "http://x.org/", None),
        (5, "http://b.com/de/1", None), (6, "http://b.com/fr/1", None), (7, "no url", None), (8, None, None), (9, "http://notexample.org/es/1", None), (10, "ftp://h?x/de/", None),
    ])
    assert got == {
        1: ("a.example.org", "/es/x", "example.org/es/", "block"), 2: ("example.org", "/en/17", "example.org/en/1", "block"), 3: ("x.org", "", None, "allow"),
        4: ("x.org", "/", "org/", "allow"), 5: ("b.com", "/de/1", "com/de/", "block"), 6: ("b.com", "/fr/1", "com/fr/", "allow"), 7: ("", "", None, "allow"),
        8: ("", "", None, "allow"), 9: ("notexample.org", "/es/1", "org/", "allow"), 10: ("h", "", None, "allow"),
    }


def test_blocks_reach_aliases_unless_one_is_allowed(spark):
    canonical = '<html><link rel="canonical" href="http://b.com/de/7"></html>'
    refresh = "<meta http-equiv='refresh' content='0; url=/two'>"
    got = urls(spark, [
        (1, "http://a.net/1", canonical), (2, "http://a.net/one", refresh), (3, "https://a.net/two/?utm_source=x", None), (4, "http://a.net/three", None), (5, "http://a.net/four", None),
        (6, "http://c.net/5", None), (7, "http://a.net/1#top", ""), (8, "http://d.net/8", None),
    ], links=[("http://a.net/two", "http://b.com/de/9"), ("http://a.net/three", "http://b.com/de/1"), ("http://a.net/three", "http://b.com/fr/1"), ("http://a.net/four", "http://a.net/three"),
              (None, "http://d.net/8"), ("http://d.net/8", None), ("http://d.net/8", "http://d.net/8")])
    assert {k: v[3] for k, v in got.items()} == {1: "block", 2: "block", 3: "block", 4: "allow", 5: "allow", 6: "allow", 7: "block", 8: "allow"}
    assert urls(spark, []) == {}


def test_snapshots_collapse(spark):
    def conv(i, *texts, start=0):
        return [(i, start + k, "user" if k % 2 == 0 else "assistant", t) for k, t in enumerate(texts)]

    rows = (conv(1, "a", "b") + conv(2, "a", "b", "c") + conv(3, "a") + conv(4, "a", "b", "c") + conv(5, "a", "x", start=5) + conv(6, "b", "a") + conv(7, None, "b") + conv(8, "", "b")
            + conv(9, *(f"t{k}" for k in range(600))) + conv(10, *(f"t{k}" for k in range(300))) + conv(None, "z") + [(2, 1, "assistant", "b")] + [(11, None, "user", "a"), (11, 0, "user", "q"), (11, 0, "user", "p")])
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    out = snapshot_collapse.collapse_snapshots(turns).collect()
    kept = {}
    for r in sorted(out, key=lambda r: r["position"]):
        kept.setdefault(r["conv_id"], []).append(r)
    assert set(kept) == {2, 5, 6, 7, 8, 9, 11, None}
    assert kept[2][0]["n_copies"] == 2 and len(kept[2]) == 3 and kept[9][-1]["n_turns"] == 600
    assert "".join(r["segment"] for r in kept[6]) == "<|im_start|>user\nb<|im_end|>\n<|im_start|>assistant\na<|im_end|>\n"
    assert [r["segment"][17:18] for r in kept[11]] == ["p", "q", "a"]
    same(snapshot_collapse.collapse_snapshots(turns), duck(snapshot_collapse.OP2_SQL, conversations=turns.toPandas().astype({"conv_id": "Int64", "turn": "Int64"})))
    assert snapshot_collapse.collapse_snapshots(turns.limit(0)).count() == 0


def test_licences_by_canonical_text(spark, edge_docs, empty_docs):
    mit = license_digests.KNOWN[9][1]
    altered = "Copyright (c) 2020 Some One\n(C) Others\n\n" + mit.upper().replace(", ", " ,  ").replace("SUBLICENSE", "Sub-licence").replace("NONINFRINGEMENT", "non-infringement")
    docs = spark.createDataFrame([(1, altered), (2, mit + " or else"), (3, "text\nReleased under the MIT Licence!\nmore\nLicensed under CC-BY-NC 4.0"), (4, None), (5, "Copyright 2020 me"), (6, "")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in license_digests.scan_licenses(docs).collect()}
    assert got[1]["license"] == "MIT" and got[2]["license"] is None
    assert got[3]["line_licenses"] == "CC-BY-NC-4.0,MIT" and got[3]["license"] is None
    assert all(got[k]["digest"] is None and got[k]["license"] is None for k in (4, 5, 6))
    assert license_digests.scan_licenses(edge_docs).count() == edge_docs.count()
    assert license_digests.scan_licenses(empty_docs).count() == 0
    assert license_digests.scan_licenses(docs, known=[]).filter("license is not null").count() == 0


def test_wrapped_licences_keep_their_copyright_lines(spark):
    def wrapped(text, width):
        paragraphs = "\n".join(line.strip() for line in text.split("\n")).split("\n\n")
        # lines of a notice are never joined to others
        return "\n\n".join(x if "copyright (c)" in x.lower() else textwrap.fill(x, width, break_long_words=False, break_on_hyphens=False) for x in paragraphs)

    isc = license_digests._ISC.replace("this permission", "\nthis permission").replace("above copyright", "above\ncopyright")
    rows = [("ISC", "ISC License\n\nCopyright (c) 2020, Some One\n\n" + isc)]
    for name, text in license_digests.EVERY:
        if len(text) > 200:
            rows += [(name, text)] + [(name, "Copyright Some One and other contributors\n(c) The Others\n\n" + wrapped(line, w)) for line in [text] for w in (72, 76, 80)]
    docs = spark.createDataFrame([(k, t) for k, (_n, t) in enumerate(rows)], "doc_id long, text string")
    got = {r["doc_id"]: r["license"] for r in license_digests.scan_licenses(docs).collect()}
    assert [(n, k) for k, (n, _t) in enumerate(rows) if got[k] != n] == []
    assert {"Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "GPL-2.0", "GPL-3.0", "MPL-2.0", "Unlicense"} <= set(got.values())


def test_wrapped_body_line_is_not_a_notice(spark):
    rows = [("copyright notice and this permission notice appear in all copies.", True), ("COPYRIGHT HOLDERS BE LIABLE", True), ("(c) You must retain all notices", True),
            ("Copyright (c) 2020 X", False), ("Copyright 2020 X", False), ("Copyright by X", False), ("(c) Others", False), ("\u00a9 X", False), ("Copyright Joyent, Inc.", False), ("Copyright [yyyy] [name of copyright owner]", False)]
    docs = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(rows)], "doc_id long, text string")
    assert [r["digest"] is not None for r in license_digests.scan_licenses(docs).orderBy("doc_id").collect()] == [kept for _t, kept in rows]
