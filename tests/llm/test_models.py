import hashlib
import math

import brute
import numpy as np
import pytest
from conftest import SF
from hypothesis import given, settings
from hypothesis import strategies as st

import corpus_pipeline
from gleaner.llm import context_tree, mixing, pii_boosting
from gleaner.llm.pii_spans import FEATURES, KINDS, _disguised, base_spans, disguised_candidates


def said(spans):
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab.@-+ 0127953()é\n", max_size=60))
def test_patterns_equal_the_plain_search(text):
    assert base_spans(text) == brute.personal_data(text)


def test_personal_data_of_given_table(spark):
    texts = {r[0]: r[1] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    rows = pii_boosting.op5_candidate_boosting(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = brute.personal_data(texts[r["doc_id"]])
        assert [r[f"n_{k}"] for k in KINDS] == [sum(x[1] == k for x in want) for k in range(4)]
        assert r["base_sha256"] == hashlib.sha256(said(want).encode()).hexdigest()
        assert set(said(want).split(",")) <= set(r["spans"].split(",")) | {""}


def luhn_number(seed, n=16):
    digits = [int(x) for x in np.random.default_rng(seed).integers(0, 10, n - 1)]
    total = sum(digits[-2::-2]) + sum(sum(divmod(2 * x, 10)) for x in digits[-1::-2])
    return "".join(map(str, digits)) + str(-total % 10)


def test_boosting_adds_likely_spans_and_keeps_clean_texts(spark):
    rows = []
    for k in range(900):
        phone = f"({200 + k % 700}) {100 + k % 900:03d}-{k * 37 % 10000:04d}"
        mail = f"{'user' if k % 2 else 'u' + str(k)}@{'host' if k % 4 < 2 else 'box' + str(k % 9)}.example.com"
        rows.append((3 * k, (f"please call phone +1 {phone} or mail {mail} now", f"call us: +1 {phone}\nor write to {mail}", f"{mail} is where to contact me, tel +1 {phone}",
                             f"You can mail {mail} at any time. My phone is +1 {phone}, thank you")[k % 4]))
        rows.append((3 * k + 1, f"part numbers {k:03d} {k + 1:03d} {k + 2:04d} {k + 3:05d} and version 300.{k}.400.{k} of item {10 ** 13 + k * 7919}"))
        rows.append((3 * k + 2, f"plain prose without any figures at all, take {k % 7}"))
    rows.append((90_000, "please call phone 1 (555) 123-4567 or mail me"))
    rows.append((90_001, "please call us or mail jane (at) host3.example (dot) com now"))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r for r in pii_boosting.find_spans(docs).collect()}
    assert len(found) == len(rows)
    assert all(not found[k]["spans"] for k in range(2, 2700, 3))
    assert all(set(r["base"]) <= set(r["spans"]) for r in found.values())
    wrong = sum(len(found[k]["spans"]) > len(found[k]["base"]) for k in range(1, 2700, 3))
    assert wrong <= 9
    added = {k: {(s["kind"], s["start"], s["end"]) for s in found[k]["spans"]} for k in (90_000, 90_001)}
    assert (3, 18, 34) in added[90_000] and not found[90_000]["base"]
    assert (0, 23, 56) in added[90_001] and not found[90_001]["base"]
    shown = pii_boosting.redact(docs.filter("doc_id >= 90000")).count()
    assert shown == 2


def test_disguises_escape_the_patterns_and_meet_the_generators():
    text = "write to a.b@mail.example.com, host 10.20.30.40, card 4111111111111111, call +1 (403) 555-9312 now"
    for pad in range(8):
        padded = text + " " * pad
        base = base_spans(padded)
        assert [k for _a, k, _b in base] == [0, 1, 2, 3]
        made = disguised_candidates(padded, base)
        assert [k for k, *_ in made] == [0, 1, 2, 3] and all(len(x) == len(FEATURES) for *_, x in made)
        for style in range(8):
            for a, kind, b in base:
                assert not any(k == kind for _s, k, _e in base_spans(_disguised(kind, padded[a:b], style)))


def test_redaction_cuts_every_span_and_nothing_else(spark, edge_docs, empty_docs, clashing_docs):
    docs = spark.createDataFrame([(1, "é mail a.b@c.de, call +1 (403) 555-9312."), (2, "no data"), (3, None), (4, ""), (1, "é mail a.b@c.de, call +1 (403) 555-9312."), (None, "ip 10.0.0.1")], "doc_id long, text string")
    got = sorted((tuple(r) for r in pii_boosting.redact(docs).collect()), key=repr)
    cut = (1, "é mail [EMAIL], call [PHONE].")
    assert got == sorted([cut, (2, "no data"), (3, None), (4, ""), cut, (None, "ip [IP]")], key=repr)
    assert pii_boosting.redact(empty_docs).count() == 0
    assert pii_boosting.redact(clashing_docs).columns == clashing_docs.columns
    assert pii_boosting.redact(clashing_docs).count() == clashing_docs.count()


def test_overlapping_spans_become_one():
    spans = [{"start": 0, "kind": 0, "end": 4}, {"start": 2, "kind": 3, "end": 6}, {"start": 8, "kind": 1, "end": 9}]
    assert pii_boosting._cut("abcdefghij", spans) == "[EMAIL]gh[IP]j"


def test_unigram_scores_equal_brute_force(spark, monkeypatch):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute.unigram(rows)
    for frequent in (context_tree.FREQUENT, 50):  # with few frequent words, most meet their counts in the join
        got = {r["doc_id"]: r for r in context_tree.score_documents(docs, frequent=frequent).collect()}
        for i, (held, n, known, total, score) in want.items():
            r = got[i]
            assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held, n, known, total)
            assert r["base_score"] == pytest.approx(score, rel=1e-9)


def recursive_scores(train, texts):
    """Context-tree weighting from its definition: block probabilities of
    every node, and each bit as a ratio of mixed predictions."""
    from collections import Counter
    from functools import cache

    depth, classes = context_tree.DEPTH, context_tree._CLASS
    bits = Counter()

    def steps(text):
        b = text.encode().lower()
        for k, byte in enumerate(b):
            past = tuple(int(classes[b[k - j]]) if k >= j else int(classes[0]) for j in range(1, depth + 1))
            node = 1
            for shift in range(7, -1, -1):
                bit = byte >> shift & 1
                yield past, node, bit
                node = node * 2 + bit

    children = {}
    for text in train:
        for past, node, bit in steps(text):
            for d in range(depth + 1):
                bits[past[:d], node, bit] += 1
                if d:
                    children.setdefault((past[:d - 1], node), set()).add(past[:d])

    @cache
    def own(past, node):
        a, b = bits[past, node, 0], bits[past, node, 1]
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.log(math.pi) - math.lgamma(a + b + 1)

    @cache
    def mixed(past, node):
        if len(past) == depth:
            return own(past, node)
        longer = sum(mixed(c, node) for c in children.get((past, node), ()))
        top = max(own(past, node), longer)
        return math.log(0.5) + top + math.log(math.exp(own(past, node) - top) + math.exp(longer - top))

    def predict(past, node, d, bit):
        at = past[:d]
        kt = (bits[at, node, bit] + 0.5) / (bits[at, node, 0] + bits[at, node, 1] + 1)
        if d == depth:
            return kt
        w = math.exp(math.log(0.5) + own(at, node) - mixed(at, node))
        return w * kt + (1 - w) * predict(past, node, d + 1, bit)

    return [sum(math.log10(predict(past, node, 0, bit)) for past, node, bit in steps(t)) for t in texts]


def test_tree_scores_equal_the_recursion():
    train = ["abracadabra, abra!", "cad abr 12", "", "ééa b-c"]
    texts = ["abra cad", "zzz 9", "", "aéb", "Abracadabra, abra!"]

    def arrays(rows):
        raw = [t.encode() for t in rows]
        return np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in raw])])

    codes, counts = np.unique(context_tree._codes(*arrays(train)), return_counts=True)
    got = context_tree.ContextTree(codes, counts).score(*arrays(texts))
    assert got == pytest.approx(recursive_scores([t.lower() for t in train], [t.lower() for t in texts]))
    # probabilities of all bytes after any context add up to one
    table = context_tree.ContextTree(codes, counts).table.reshape(-1, 256)
    assert (10 ** table).sum(axis=1) == pytest.approx(np.ones(len(table)))
    empty = context_tree.ContextTree(codes[:0], counts[:0])
    assert empty.score(*arrays(["ab"]))[0] == pytest.approx(16 * math.log10(0.5))


def test_table_of_nodes_scores_as_the_recursion(spark):
    """Digits and accented letters are contexts of their own; rare codes meet the table in a join."""
    texts = ["abracadabra 12, 17 abra!", "cad abr 12", "ééa b-c \u00e8\u00eaa", "", "in 1917 and 1918, 1917 again", "zzz 9", "abra 1917", "A b\u0107 1818", "abracadabra 12, 17 abra!", "ab"] * 2
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = context_tree.score_documents(docs).collect()
    train = [texts[r["doc_id"]].lower() for r in rows if not r["held_out"]]
    assert 0 < len(train) < len(texts)
    want = recursive_scores(train, [t.lower() for t in texts])
    assert [r["score"] for r in sorted(rows)] == pytest.approx(want)
    got = {r["doc_id"]: r["score"] for r in context_tree.score_documents(docs, frequent_codes=5).collect()}
    assert [got[k] for k in range(len(texts))] == pytest.approx(want)
    # contexts that differ in a digit alone are told apart
    two = recursive_scores(["q1x q2y"] * 20, ["q1x", "q1y"])
    assert two[0] > two[1] + 0.5


def test_held_out_texts_code_shorter_than_by_single_bytes(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    got = context_tree.score_documents(rows).join(rows, "doc_id").filter("held_out").selectExpr("-sum(score) / log10(2) / sum(octet_length(text)) AS bits").first()
    assert 0 < got["bits"] < 3.6


def test_scores_of_edge_tables(spark, edge_docs, empty_docs, clashing_docs):
    got = {r["doc_id"]: r for r in context_tree.score_documents(edge_docs).collect()}
    assert got[3]["score"] == got[4]["score"] == 0.0 and got[1]["score"] == got[2]["score"] < 0
    assert context_tree.score_documents(empty_docs).count() == 0
    assert context_tree.score_documents(clashing_docs).count() == clashing_docs.count()


def shares(sized):
    """Targets by resharing, round after round."""
    names = sorted(sized)
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    total, capped = sum(sized.values()), set()
    while True:
        free = [s for s in names if s not in capped]
        left = total - sum(3 * sized[s] for s in capped)
        level = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if level[s] > 3 * sized[s]}
        if not over:
            return {s: 3 * sized[s] if s in capped else level[s] for s in names}
        capped |= over


def test_mix_meets_targets(spark):
    rows, k = [], 0
    for s, n in {"a": 2000, "b": 40, "c": 300, "d": 5, "e": 900, "f": 0}.items():
        for j in range(n):
            k += 1
            rows.append((k, "w " * (1 + (k * 7919) % 13), s))
    rows.append((k + 1, None, "f"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    sized = {}
    for _i, t, s in rows:
        sized[s] = sized.get(s, 0) + len(brute.words(t))
    want = shares(sized)
    got = mixing.mix_sources(docs).join(docs.drop("text"), "doc_id").collect()
    assert len(got) == len(rows)
    taken = {}
    for r in got:
        assert r["target"] == pytest.approx(want[r["source"]]) and r["taken"] <= 3 * r["size"] and r["source_size"] == sized[r["source"]]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    assert all(abs(taken[s] - want[s]) <= 7 for s in want)
    again = {r["doc_id"]: r["taken"] for r in mixing.mix_sources(docs.repartition(7)).collect()}
    assert again == {r["doc_id"]: r["taken"] for r in got}


def test_mix_of_edge_tables(spark, edge_docs, empty_docs, clashing_docs):
    assert mixing.mix_sources(empty_docs).count() == 0
    assert mixing.mix_sources(edge_docs).count() == edge_docs.count()
    mixed = mixing.mix_sources(clashing_docs, keep_columns=True)
    assert mixed.columns[:len(clashing_docs.columns)] == clashing_docs.columns and mixed.count() == clashing_docs.count()
    ones = {tuple(r) for r in mixed.filter("doc_id = 1").collect()}
    assert len(ones) == 1


def test_pipeline_stages(spark, clashing_docs):
    import conftest

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    assert [n for n, _f in corpus_pipeline.STAGES] == ["quality rules", "near duplicates", "decontamination", "personal data", "mixing"]
    sizes = [docs.count()]
    for k, (_name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = spark.createDataFrame(stage(spark, docs, SF).toPandas())
        if k < 4:
            assert docs.columns == columns
        sizes.append(docs.count())
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > 0
    texts = [r["text"] for r in docs.select("text").collect()]
    assert not any(brute.personal_data(t) for t in texts)
    assert not any(brute.base_quality(t)[5] for t in texts if "[" not in t)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, clashing_docs, conftest.SF).count() >= 0 and name
        assert stage(spark, clashing_docs.limit(0), conftest.SF).count() == 0


def test_pipeline_run(spark):
    rows = corpus_pipeline.run(spark, SF).select("doc_id", "taken", "copies").collect()
    assert rows and all(r["copies"] >= 1 for r in rows)
    assert math.isfinite(sum(r["taken"] for r in rows))
