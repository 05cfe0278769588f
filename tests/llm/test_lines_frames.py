"""Line dedup and fill-in-middle over compressed frames, against brute force."""

import hashlib

import brute
import numpy as np
import pytest
import zstandard
from conftest import LONG, SF
from hypothesis import given, settings
from hypothesis import strategies as st

from gleaner.llm import fill_middle, line_dedup


def sha(text):
    return hashlib.sha256((text or "").encode()).hexdigest()


def frames_of(text, size):
    raw = np.frombuffer(text.encode(), dtype=np.uint8)
    found = fill_middle.text_frames(raw, size, zstandard.ZstdCompressor())
    return fill_middle.FrameText([dict(zip(("units", "chars", "data"), f)) for f in found], size), len(raw), found


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="abé\U0001F600 \t\n\v<>PS", max_size=40), st.integers(1, 9), st.data())
def test_cuts_and_streams_at_any_frame_size(text, size, data):
    frames, n_bytes, found = frames_of(text, size)
    units = brute._UNIT.findall(text)
    assert (found[-1][:2] if found else (0, 0)) == (len(units), len(text))
    a = data.draw(st.integers(0, len(units)))
    b = data.draw(st.integers(a, len(units)))
    cuts = []
    for k in (a, b):
        want = "".join(units[:k])
        at, chars = frames.cut(k)
        assert (at, chars) == (len(want.encode()), len(want))
        cuts.append(at)
    if any(m in text for m in ("<P>", "<S>", "<M>")):
        return
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    for form, want in (("psm", f"<P>{p}<S>{s}<M>{m}"), ("spm", f"<S>{s}<P>{p}<M>{m}"), ("plain", text)):
        pieces = list(fill_middle.render(frames, form, *cuts, n_bytes))
        assert b"".join(pieces).decode() == want
        assert b"".join(fill_middle.restore(iter(pieces), form, size)).decode() == text
        one_by_one = [bytes([x]) for x in want.encode()]
        assert b"".join(fill_middle.restore(one_by_one, form, size)).decode() == text


def test_a_cut_opens_one_frame():
    frames, _n, found = frames_of(LONG, 1 << 10)
    assert len(found) > 50
    frames.cut(found[30][0] + 3)
    assert frames.opened == 1


@pytest.mark.parametrize("frame", [fill_middle.FRAME, 1000])
def test_fill_middle_equals_brute_force(spark, edge_docs, clashing_docs, frame):
    table = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    marked = spark.createDataFrame([(k, f"some <P> text {k} <M>") for k in range(20)] + [(77, "  "), (78, " lone word \n"), (79, LONG * 3)], "doc_id long, text string")
    docs = table.unionAll(edge_docs.select("doc_id", "text")).unionAll(marked).unionAll(clashing_docs.select("doc_id", "text"))
    got = [tuple(r) for r in fill_middle.fill_in_middle(docs, frame=frame, keep_output=True).collect()]
    want = []
    for r in docs.collect():
        n, form, a, b, output = brute.fill_middle(r["doc_id"], r["text"])
        want.append((r["doc_id"], n, form, a, b, sha(output), sha(r["text"]), output))
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}


def test_fill_middle_empty_and_extra_columns(spark, empty_docs, clashing_docs):
    assert fill_middle.fill_in_middle(empty_docs).count() == 0
    assert fill_middle.fill_in_middle(clashing_docs).count() == clashing_docs.count()


def shared_lines():
    rows = [(k, f"Common LINE here \nown line {k}\n\n  common line HERE\t\nhalf {k % 9}\n{'x' * (k % 3)}") for k in range(30)]
    rows += [(100 + k, f"nine of them\n{k}") for k in range(9)] + [(200, "nine of them")] * 5
    rows += [(None, f"by text\nn{k}") for k in range(9)] + [(None, "by text\nn0")] * 4
    rows += [(300 + k, "ÉTÉ A\r\nété a") for k in range(10)] + [(400, "common line here"), (401, ""), (402, None), (403, "\n\n")]
    return rows


@pytest.mark.parametrize("hot_keys", [line_dedup.HOT_KEYS, 20])
def test_line_dedup_equals_brute_force(spark, hot_keys):
    rows = shared_lines()
    got = line_dedup.line_report(spark.createDataFrame(rows, "doc_id long, text string"), hot_keys=hot_keys).collect()
    want = [(i, n, gone, sha(rest)) for i, n, gone, rest in brute.common_lines(rows)]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert any(r["n_dropped"] == 3 for r in got)


def test_line_dedup_on_a_table_and_edge_rows(spark, edge_docs, empty_docs, clashing_docs):
    for docs, least in ((spark.read.parquet(f"{SF}/documents.parquet"), 3), (edge_docs, 2), (clashing_docs, 2)):
        rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
        want = brute.common_lines(rows, 1, least)
        got = line_dedup.line_report(docs, min_docs=least).collect()
        assert sorted(map(tuple, got), key=repr) == sorted([(i, n, g, sha(rest)) for i, n, g, rest in want], key=repr)
        kept = line_dedup.drop_common_lines(docs, min_docs=least)
        assert kept.columns == docs.columns
        texts = [(r["doc_id"], r["text"]) for r in kept.collect()]
        assert sorted(texts, key=repr) == sorted([(i, rest if t is not None else None) for (i, t), (_i, _n, _g, rest) in zip(rows, want)], key=repr)
    assert line_dedup.line_report(empty_docs).count() == 0


def test_line_dedup_plan_has_no_python(spark):
    plan = line_dedup.op13_line_dedup(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "MapInArrow" not in plan
