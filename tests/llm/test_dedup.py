import brute
import numpy as np
import pyarrow as pa
from conftest import SF
from hypothesis import given, settings
from hypothesis import strategies as st

from gleaner.llm import circulant_minhash, suffix_dedup, suffix_sort
from gleaner.llm.components import connected_components


def near(docs, **params):
    return {r["doc_id"]: r for r in circulant_minhash.near_duplicates(docs, **params).collect()}


def test_near_duplicates_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    for k in (2, 5):
        got = near(docs, shingle=k, percent=80)
        for i, (n, component) in brute.near_duplicates(rows, k, 80).items():
            assert (got[i]["n_shingles"], got[i]["component_id"], got[i]["kept"]) == (n, component, i == component)


def test_chain_of_near_copies_is_one_component(spark):
    # neighbours are linked, the ends are not
    words = [f"w{i}" for i in range(400)]
    rows = [(100 - k, " ".join(words[:40 * k] and [f"x{k}_{j}" if j < 15 * k else w for j, w in enumerate(words)])) for k in range(8)]
    rows = [(i, t or " ".join(words)) for i, t in rows]
    want = brute.near_duplicates(rows, 2, 80)
    got = near(spark.createDataFrame(rows, "doc_id long, text string"), shingle=2, percent=80)
    assert {i: r["component_id"] for i, r in got.items()} == {i: c for i, (_n, c) in want.items()}


def test_group_of_copies_and_edge_rows(spark, edge_docs, empty_docs, clashing_docs):
    rows = [(r["doc_id"], r["text"]) for r in edge_docs.collect()] + [(1000 + k, f"one very common passage of words that many copies share {k % 3}") for k in range(300)]
    want = brute.near_duplicates(rows, 2, 80)
    got = near(spark.createDataFrame(rows, "doc_id long, text string"), shingle=2, percent=80)
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == want
    assert near(empty_docs) == {}
    kept = circulant_minhash.keep_one(clashing_docs, shingle=5)
    assert kept.columns == clashing_docs.columns
    ids = [r["doc_id"] for r in kept.select("doc_id").collect()]
    assert ids.count(None) == 2 and ids.count(1) == 2 and 2 not in ids


def test_components_of_path_hub_and_loops(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(500, 500 + i) for i in range(1, 40)] + [(7, 7), (None, 3), (70, 69), (70, 69)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 0 for i in range(61)} | {500 + i: 500 for i in range(40)} | {69: 69, 70: 69}
    assert got == want
    assert connected_components(spark.createDataFrame([], "a string, b string")).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 4), max_size=80), st.sampled_from([2, 4096]))
def test_suffix_array_equals_sorting(values, buckets):
    text = np.array([*values, 0], dtype=np.int64)
    before, suffix_sort.MAX_BUCKETS = suffix_sort.MAX_BUCKETS, buckets
    try:
        got = suffix_sort.suffix_array(text).tolist()
    finally:
        suffix_sort.MAX_BUCKETS = before
    assert got == sorted(range(len(text)), key=lambda i: tuple(text[i:]))


def removed(docs):
    return {r["doc_id"]: tuple(r)[1:] for r in suffix_dedup.remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()}


def test_repeats_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    assert removed(docs) == brute.repeats([tuple(r) for r in docs.collect()])


def test_repeats_at_boundaries_and_inside_one_text(spark):
    rng = np.random.default_rng(3)
    piece = "".join(chr(97 + x) for x in rng.integers(0, 26, 500))
    other = "".join(chr(97 + x) for x in rng.integers(0, 26, 500))
    rows = [
        (1, piece), (2, other[:50] + piece[100:199] + other[50:90]), (3, other[90:140] + piece[100:200] + other[140:180]), (4, piece[10:140] + piece[200:330]),
        (5, "a" * 350), (6, "ab" * 150), (7, piece[:100]), (8, piece[:99]), (9, ""), (10, None), (11, "é" * 120), (12, other[200:330] + other[200:330]),
        (13, "x" + piece[37:160] + "y" + piece[36:161] + "z"), (14, piece), (15, "b" + "a" * 180),
    ]
    assert removed(spark.createDataFrame(rows, "doc_id long, text string")) == brute.repeats(rows)


def test_one_passage_in_very_many_texts(spark):
    rng = np.random.default_rng(5)
    line = "".join(chr(97 + x) for x in rng.integers(0, 26, 80))
    rows = [(k, "".join(chr(97 + x) for x in rng.integers(0, 26, 60)) + line + str(k % 5) * 30) for k in range(300)]
    assert removed(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)) == brute.repeats(rows)


def test_repeats_edge_tables(spark, edge_docs, empty_docs, clashing_docs):
    rows = [(r["doc_id"], r["text"]) for r in edge_docs.collect()]
    assert removed(edge_docs) == brute.repeats(rows)
    assert removed(empty_docs) == {}
    got = suffix_dedup.remove_repeats(clashing_docs)
    assert got.count() == clashing_docs.count()
    first = got.filter("doc_id = 1").collect()
    assert len(first) == 2 and first[0] == first[1] and first[0]["n_removed"] == 0


def test_unlinked_candidates_meet_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(circulant_minhash, "BLOCK", 3)
    monkeypatch.setattr(circulant_minhash, "STAR_ROUNDS", 1)
    rng = np.random.default_rng(11)
    words = [f"w{i}" for i in range(120)]
    rows = []
    for k in range(60):  # copies far enough apart that few pairs are linked
        own = list(words)
        for place in rng.integers(0, 120, 3 + k % 7):
            own[place] = f"x{rng.integers(0, 10**6)}"
        rows.append((k, " ".join(own)))
    rows += [(100 + k, " ".join(words) + " tail" * (k % 2)) for k in range(20)]
    want = brute.near_duplicates(rows, 2, 80)
    got = near(spark.createDataFrame(rows, "doc_id long, text string"), shingle=2, percent=80)
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == want


def passage_rows(n):
    """Texts of their own around one passage: at its edges, one key and n contexts."""
    rng = np.random.default_rng(11)
    letters = np.frombuffer(b"abcdefghijklmnopqrstuvwxyz ", np.uint8)
    passage = letters[rng.integers(0, 27, 130)].tobytes().decode()
    own = [letters[rng.integers(0, 27, 180)].tobytes().decode() for _ in range(n)]
    return [(k, x[:90] + passage + x[90:]) for k, x in enumerate(own)]


def test_a_passage_with_a_new_neighbour_in_every_text(spark):
    rows = passage_rows(3 * suffix_dedup._HOT // 2)
    assert removed(spark.createDataFrame(rows, "doc_id long, text string").repartition(8)) == brute.repeats(rows)


def test_a_hot_key_gets_no_suffix_array(monkeypatch):
    sizes, own, hot = [], suffix_dedup.repeated_starts, 200
    monkeypatch.setattr(suffix_dedup, "repeated_starts", lambda parts, *a: sizes.append(len(parts)) or own(parts, *a))
    keys = [1] * 3 + [2] * 5 + [3] * 5_000 + [4] * 200 + [5] * 2
    bytes_ = [bytes([65 + k]) * 99 + bytes([97 + j % 3]) for j, k in enumerate(keys)]
    rows = pa.RecordBatch.from_arrays([pa.array(keys), pa.array(range(len(keys))), pa.array([0] * len(keys)), pa.array(bytes_)], names=["shard", "doc_id", "first", "bytes"])
    read = []
    out = suffix_dedup._searcher(hot)(read.append(k) or rows.slice(k, 100) for k in range(0, len(keys), 100))
    got = next(out).to_pylist()
    assert len(read) < 20
    got += [r for b in out for r in b.to_pylist()]
    back = sorted(keys[r["doc_id"]] for r in got if r["kind"] == suffix_dedup._OPEN)
    assert back == [1] * 3 + [3] * 5_000 + [5] * 2  # the first and last key, and the hot one
    assert sizes == [205]
    assert sum(r["count"] for r in got if r["kind"] == suffix_dedup._REPEATS) == 205 - 3 - 3


def test_strings_dealt_one_by_one_equal_brute_force(spark, monkeypatch):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    monkeypatch.setattr(suffix_dedup, "_HOT", 1)
    assert removed(spark.createDataFrame(rows, "doc_id long, text string")) == brute.repeats(rows)


def test_runs_are_compared_batch_by_batch():
    rng = np.random.default_rng(5)
    columns = [rng.integers(0, 6, 400), rng.integers(0, 3, 400), rng.integers(0, 20, 400), rng.integers(0, 9, 400)]
    by = np.lexsort(columns[::-1])
    whole = pa.RecordBatch.from_arrays([pa.array(c[by]) for c in columns], names=["anchor", "context", "doc_id", "place"])

    def compared(step):
        read = []
        out = suffix_dedup._compare_runs(read.append(k) or whole.slice(k, step) for k in range(0, 400, step))
        rows = next(out).to_pylist()
        seen = len(read)
        return seen, sorted(tuple(r.values()) for r in rows + [r for b in out for r in b.to_pylist()])

    one, want = compared(400)
    for step in (1, 7, 90):
        seen, got = compared(step)
        assert got == want and seen < 4


def test_strings_of_a_block_are_combined_before_they_are_shuffled(spark, monkeypatch):
    rng = np.random.default_rng(23)
    passage = "".join(chr(97 + x) for x in rng.integers(0, 26, 118))
    contexts = pa.RecordBatch.from_arrays([pa.array(range(900)), pa.array([7] * 900), pa.array([(passage + f"{k:016d}").encode() for k in range(900)])],
                                          names=["doc_id", "first", "bytes"])
    monkeypatch.setattr(suffix_dedup, "_BLOCK", 300)
    rows = [r for b in suffix_dedup._cut_strings(iter([contexts])) for r in b.to_pylist()]
    runs = [r for r in rows if r["kind"] == suffix_dedup._REPEATS]
    # all but the first context of a block: one run of the strings inside the passage or its zeros
    assert len(runs) == 3 * 299 and all(r["start"] == 7 and r["count"] >= 19 for r in runs)
    assert len(rows) - len(runs) == len({(r["high"], r["low"], r["doc_id"] // 300) for r in rows if r["kind"] == suffix_dedup._OPEN})
    monkeypatch.setattr(suffix_dedup, "_BLOCK", 3)
    monkeypatch.setattr(suffix_dedup, "_HOT", 1)
    rows = passage_rows(40) + [(100 + k, t) for k, t in passage_rows(5)]
    assert removed(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)) == brute.repeats(rows)


def test_links_are_stored_in_parts_by_their_number(spark):
    """A part is a file, and every file costs requests to the store."""
    from pathlib import Path
    from urllib.parse import urlparse

    from gleaner.session import ensure_checkpoint_dir

    folder = Path(urlparse(ensure_checkpoint_dir(spark)).path)
    settings = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in settings}
    before = set(folder.glob("rdd-*"))
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        found = connected_components(spark.range(400).selectExpr("id AS a", "id + 1 - id % 2 AS b"), links=400).collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert {(r["node"], r["component"]) for r in found} == {(k, k - k % 2) for k in range(400)}
    stored = [len(list(p.glob("part-*"))) for p in set(folder.glob("rdd-*")) - before]
    assert stored and max(stored) <= 8
