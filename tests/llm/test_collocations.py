"""Phrase mining against brute force, and the double-array trie alone."""

import brute
import numpy as np
import pytest
from conftest import LONG, SF
from hypothesis import given, settings
from hypothesis import strategies as st

from gleaner.llm.collocations import _tight, mine_phrases
from gleaner.llm.word_trie import PhraseTrie, symbols_per_code


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 4), st.sampled_from([3, 300, 70_000]), st.data())
def test_trie_finds_every_occurrence(width, top, data):
    code = st.integers(1, top)
    phrases = data.draw(st.lists(st.tuples(*[code] * width), max_size=60, unique=True))
    known = [c for p in phrases for c in p] or [1]
    text = data.draw(st.lists(st.one_of(st.sampled_from(known), st.integers(0, top)), max_size=60))
    text += [c for p in phrases[:5] for c in p]
    trie = PhraseTrie(np.array(phrases, np.int32).reshape(-1, width), symbols_per_code(top))
    places, found = trie.walk(np.array(text, np.int32))
    where = {p: k for k, p in enumerate(phrases)}
    want = [(i, where[tuple(text[i:i + width])]) for i in range(len(text) - width + 1) if tuple(text[i:i + width]) in where]
    assert list(zip(places.tolist(), found.tolist())) == want


def test_trie_of_wide_and_narrow_families():
    draw = np.random.default_rng(5)
    phrases = np.unique(np.minimum(draw.zipf(1.3, (40_000, 3)), 900).astype(np.int32), axis=0)
    phrases = phrases[draw.permutation(len(phrases))]
    trie = PhraseTrie(phrases, 2)
    places, found = trie.walk(phrases.ravel())
    assert (found[places % 3 == 0] == np.arange(len(phrases))).all()


def test_tight_keeps_neighbours_alone():
    assert _tight(np.array([0, 0, 3, 0, 4, 5, 0, 0, 6, 0, 0, 7, 8])).tolist() == [4, 5, 0, 7, 8, 0]
    assert _tight(np.zeros(0)).tolist() == [] and _tight(np.array([5])).tolist() == []


def rows_of(docs):
    return [(r["lang"], r["text"]) for r in docs.select("lang", "text").collect()]


@pytest.mark.parametrize("params", [{}, {"block_size": 37, "shard": 50}])
def test_phrases_equal_brute_force(spark, params):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = [tuple(r) for r in mine_phrases(docs, min_count=12, top=60, **params).collect()]
    want = brute.collocations(rows_of(docs), least=12, top=60)
    assert sorted(got) == sorted(want) and len(want) >= 100


def test_ties_pieces_nulls_and_hot_phrases(spark, edge_docs, empty_docs, clashing_docs):
    rows = [("en", "New York, new\tYORK; new york is. big big big big big big!")] * 40 + [(None, "a b\nc d\r\ne  f:a b")] * 5 + [("und", "a b")] * 3
    rows += [("fr", "été à la plage É"), ("fr", None), ("fr", ""), ("de", "..., ;")] + [("xx", LONG)] * 2
    docs = spark.createDataFrame(rows, "lang string, text string")
    for least in (2, 9, 1000):
        got = [tuple(r) for r in mine_phrases(docs, min_count=least).collect()]
        assert sorted(got) == sorted(brute.collocations(rows, least=least))
    assert mine_phrases(empty_docs).count() == 0
    for docs in (edge_docs, clashing_docs):
        got = [tuple(r) for r in mine_phrases(docs, min_count=8, top=50).collect()]
        assert sorted(got) == sorted(brute.collocations(rows_of(docs), least=8, top=50))
