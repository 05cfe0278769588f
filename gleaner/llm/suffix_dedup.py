"""Removal of repeated byte strings by sharded suffix arrays.

A byte goes if a string of ``LENGTH`` bytes covers it that also starts earlier
in the corpus (smaller ``doc_id``, or the same document at an earlier place).

1. Anchors. In every string of LENGTH bytes, the leftmost least hash among its
   GRAM-byte substrings is its anchor, so equal strings have equal anchors at
   equal places. Consecutive starts with one anchor form a run; the bytes of a
   run are its context (at most 2 * LENGTH). A text has a run every 35 bytes.
2. Runs are range-partitioned and sorted by (anchor hash, context hash, doc_id,
   place), so a hot anchor spreads over partitions. A run that follows an
   equal context repeats it entirely. First runs of a context whose anchor
   also has other contexts go on: there, matches begin or end.
3. Shards. Those contexts are cut at the anchor's two sides (every string holds
   34 bytes before or after the anchor's) and range-partitioned by those bytes,
   doc_id and place; a shard gets a suffix array by induced sorting, permuted
   common prefixes find equal strings, and all but the earliest of each are
   repeats. A key of more than _HOT contexts, and one that a neighbouring
   partition may continue, gets none: its strings are hashed one by one and
   combined by blocks of contexts; the earliest of each string in each block
   are sorted over all partitions by (hash, doc_id, start) and compared with
   neighbours.
4. Runs and strings found are united to spans by document and cut out.

Anchors and contexts are compared by 64-bit hashes each (128 together),
strings of hot keys by 128-bit hashes.

Defined results: NULL text is empty; texts under LENGTH bytes lose nothing;
matches never cross documents; a NULL ``doc_id`` sorts first; rows that share
an id and text are one occurrence, judged alike; of rows that share an id but
not their text the removed spans are united (ids are expected to be unique);
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm.bytescan import BYTE_VALUE, U64, chunks, mix, powers, text_bytes
from gleaner.llm.common import read_table, write_out
from gleaner.llm.suffix_sort import common_prefix_reaches, suffix_array

LENGTH = 100
GRAM = 32
_WINDOW = LENGTH - GRAM + 1
_SIDE = 34  # of the LENGTH - GRAM bytes beside an anchor, one side has as many
_PLACE = U64((1 << 31) - 1)
_NO_ID = -(1 << 63)
_SHARD_BYTES = 1 << 20
_HOT = _SHARD_BYTES // (2 * LENGTH)  # contexts of one key that a suffix array takes
_BLOCK = 4_096  # contexts whose strings are combined before they are shuffled
_REPEATS, _OPEN = 0, 1


def _fixed_hash(sums: np.ndarray, down: np.ndarray, at: np.ndarray | slice, length: int) -> np.ndarray:
    if isinstance(at, slice):
        n = len(sums) - length
        return (sums[length:length + n] - sums[:n]) * down[:n]
    return (sums[at + length] - sums[at]) * down[at]


def anchor_runs(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(document, first start, number of starts, anchor place in the document,
    anchor hash, context hash) of every run of the documents."""
    none = np.zeros(0, np.int64)
    if len(raw) < LENGTH:
        return (none,) * 4 + (none.view(np.uint64),) * 2
    up, down = powers(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum(BYTE_VALUE[raw] * up[:-1], dtype=np.uint64, out=sums[1:])
    grams = mix(_fixed_hash(sums, down, slice(None), GRAM))
    least = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
    for step in (1, 2, 4, 8, 16, 32):
        least = np.minimum(least[:-step], least[step:])
    rest = _WINDOW - 64
    least = np.minimum(least[:-rest], least[rest:])
    edge = np.zeros(len(raw) + 1, dtype=np.int8)
    long = np.diff(offsets) >= LENGTH
    edge[offsets[:-1][long]] += 1
    edge[offsets[1:][long] - LENGTH + 1] -= 1
    starts = np.flatnonzero(np.cumsum(edge[:len(least)], dtype=np.int8) > 0)
    if not len(starts):
        return (none,) * 4 + (none.view(np.uint64),) * 2
    anchors = (least[starts] & _PLACE).astype(np.int64)
    heads = np.flatnonzero(np.concatenate([[True], anchors[1:] != anchors[:-1]]))
    first, anchor = starts[heads], anchors[heads]
    count = np.diff(np.append(heads, len(starts)))
    last = first + count - 1
    context = mix(_fixed_hash(sums, down, first, LENGTH)) + _fixed_hash(sums, down, last, LENGTH) * U64(0xD6E8FEB86659FD93)
    context = mix(context + (count * 128 + (anchor - first)).astype(np.uint64))
    doc = np.searchsorted(offsets, first, side="right") - 1
    return doc, first - offsets[doc], count, anchor - offsets[doc], grams[anchor], context


def _find_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, offsets = text_bytes(batch.column(1))
        ids = batch.column(0).cast(pa.int64()).fill_null(_NO_ID).to_numpy(zero_copy_only=False)
        for a, _b, part, off in chunks(raw, offsets):
            doc, first, count, anchor, grams, contexts = anchor_runs(part, off)
            # place: first start, number of starts and distance to the anchor
            place = (first << 14) | (count << 7) | (anchor - first)
            for k in range(0, len(doc), 65_536):
                cut = slice(k, k + 65_536)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(grams[cut].view(np.int64)), pa.array(contexts[cut].view(np.int64)), pa.array(ids[a + doc[cut]]), pa.array(place[cut])],
                    names=["anchor", "context", "doc_id", "place"])


def _compare_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeated and open runs of one sorted partition; of what was read, only
    the first run of the last context is held."""
    carry: list[np.ndarray] = []
    # what a neighbouring partition may continue stays open
    several, sent = True, False  # the last anchor has several contexts; carry was given out

    def given(kinds: np.ndarray, columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        for k in range(0, len(kinds), 65_536):
            kind, doc, place = (c[k:k + 65_536] for c in (kinds, *columns[2:]))
            yield pa.RecordBatch.from_arrays([pa.array(kind.astype(np.int32)), pa.array(doc), pa.array(place)], names=["kind", "doc_id", "place"])

    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if carry:
            columns = [np.concatenate(c) for c in zip(carry, columns)]
        anchor, context, doc, place = columns
        new_anchor = np.concatenate([[True], anchor[1:] != anchor[:-1]])
        new_context = new_anchor | np.concatenate([[True], context[1:] != context[:-1]])
        first = np.maximum.accumulate(np.where(new_context, np.arange(len(anchor)), 0))
        repeats = (doc != doc[first]) | (place != place[first])
        group = np.cumsum(new_anchor) - 1
        contexts = np.bincount(group, weights=new_context)
        contexts[0] += several
        open_ = new_context & (contexts[group] > 1)
        open_[0] &= not sent
        rows = np.flatnonzero(repeats | open_)
        yield from given(np.where(repeats[rows], _REPEATS, _OPEN), [c[rows] for c in columns])
        carry = [c[first[-1]:first[-1] + 1].copy() for c in columns]
        several = sent = bool(contexts[-1] > 1)
    if carry and not sent:
        yield from given(np.array([_OPEN]), carry)


def _cut_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text, places) -> both sides of each context: (shard key, doc_id,
    first start, bytes)."""
    for batch in batches:
        raw, offsets = text_bytes(batch.column(1))
        keys, ids, firsts, parts = [], [], [], []
        for d, places in enumerate(batch.column(2).to_pylist()):
            text = raw[offsets[d]:offsets[d + 1]].tobytes()
            doc = batch.column(0)[d].as_py()
            for place in places:
                first, count, left = place >> 14, (place >> 7) & 127, place & 127
                anchor = first + left
                split = min(max(anchor - _SIDE - first + 1, 0), count)  # starts with _SIDE bytes before the anchor
                for a, b, gram in ((first, first + split, text[max(anchor - _SIDE, 0):anchor + GRAM]),
                                   (first + split, first + count, text[anchor:anchor + GRAM + _SIDE])):
                    if a < b and b - 1 + LENGTH <= len(text):
                        keys.append(int.from_bytes(hashlib.blake2b(gram, digest_size=8, key=b"l" if a == first and split else b"r").digest(), "little", signed=True))
                        ids.append(doc)
                        firsts.append(a)
                        parts.append(text[a:b - 1 + LENGTH])
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(ids, pa.int64()), pa.array(firsts, pa.int64()), pa.array(parts, pa.binary())],
                                         names=["shard", "doc_id", "first", "bytes"])


def repeated_starts(parts: list[bytes], docs: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(part, offset) of every LENGTH-byte string of the parts that also starts
    earlier, by (doc, first + offset), in another of them."""
    sizes = np.array([len(p) for p in parts], dtype=np.int64)
    begins = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1]
    text = np.frombuffer(b"\0".join(parts) + b"\0", dtype=np.uint8)
    symbols = text.astype(np.int64) + 2
    symbols[begins + sizes] = 1
    suffixes = suffix_array(np.concatenate([symbols, [0]]))[1:]
    part = np.repeat(np.arange(len(parts)), sizes + 1)
    offset = np.arange(len(text)) - begins[part]
    starts = offset + LENGTH <= sizes[part]
    joins = common_prefix_reaches(text, suffixes, LENGTH, starts)
    # a neighbour without LENGTH bytes left has a separator inside: not the same string
    before = np.full(len(text), False)
    before[suffixes[1:]] = starts[suffixes[:-1]]
    joins &= before
    order = suffixes[starts[suffixes]]
    group = np.cumsum(~joins[order])
    several = np.bincount(group)[group] > 1
    order, group = order[several], group[several]
    if not len(order):
        return order, order
    doc, start = docs[part[order]], firsts[part[order]] + offset[order]
    by = np.lexsort((start, doc, group))
    order, group, doc, start = order[by], group[by], doc[by], start[by]
    head = np.maximum.accumulate(np.where(np.concatenate([[True], group[1:] != group[:-1]]), np.arange(len(group)), 0))
    later = order[(doc != doc[head]) | (start != start[head])]
    return part[later], offset[later]


def _searcher(hot: int):
    def search_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted contexts -> (doc_id, first, count) of repeated starts. Contexts
        of one key stay together; keys are put together up to _SHARD_BYTES. The
        contexts of keys with more than ``hot`` of them, and of the first and
        last key, are given back with their bytes."""
        held: list[tuple[int, int, int, bytes]] = []
        back: list[tuple[int, int, int, bytes]] = []
        size, kept = 0, 0  # bytes held; rows of finished keys among held
        key, passed = None, True  # the key being read; whether its contexts go back

        def give_back() -> Iterator[pa.RecordBatch]:
            nonlocal back
            if back:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(back), _OPEN, np.int32)), pa.array([r[1] for r in back], pa.int64()), pa.array([r[2] for r in back], pa.int64()),
                     pa.array([None] * len(back), pa.int64()), pa.array([r[3] for r in back], pa.binary())], names=["kind", "doc_id", "first", "count", "bytes"])
                back = []

        def search(rows: list[tuple[int, int, int, bytes]]) -> Iterator[pa.RecordBatch]:
            if len(rows) < 2:
                return
            # equal bytes under equal keys are one context: its earliest stands for it
            docs, firsts = np.array([r[1] for r in rows], np.int64), np.array([r[2] for r in rows], np.int64)
            part, offset = repeated_starts([r[3] for r in rows], docs, firsts)
            if len(part):
                doc, start = docs[part], firsts[part] + offset
                by = np.lexsort((start, doc))
                doc, start = doc[by], start[by]
                heads = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (start[1:] > start[:-1] + 1)]))
                ends = np.append(heads[1:], len(doc)) - 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(heads), _REPEATS, np.int32)), pa.array(doc[heads]), pa.array(start[heads]), pa.array(start[ends] - start[heads] + 1),
                     pa.array([None] * len(heads), pa.binary())], names=["kind", "doc_id", "first", "count", "bytes"])

        for batch in batches:
            for row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                if row[0] != key:
                    passed = key is None
                    key = row[0]
                    if kept == len(held) - 1:  # a key with one context repeats nothing
                        size -= len(held.pop()[3])
                    kept = len(held)
                    if size >= _SHARD_BYTES:
                        yield from search(held)
                        held, size, kept = [], 0, 0
                if not passed and len(held) - kept == hot:
                    passed = True
                    back += held[kept:]
                    size -= sum(len(r[3]) for r in held[kept:])
                    del held[kept:]
                if passed:
                    back.append(row)
                    if len(back) >= 1_024:
                        yield from give_back()
                else:
                    held.append(row)
                    size += len(row[3])
        back += held[kept:]
        yield from give_back()
        yield from search(held[:kept])
    return search_shards


def _cut_strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contexts -> their strings by 128-bit hash, combined within a block of
    contexts: a string that also starts earlier in its block is a repeat, given
    as runs (doc_id, start, count); the earliest of each goes on alone."""
    names = ["kind", "high", "low", "doc_id", "start", "count"]
    for batch in batches:
        for k in range(0, batch.num_rows, _BLOCK):
            part = batch.slice(k, _BLOCK)
            doc, first = (part.column(c).to_numpy(zero_copy_only=False) for c in range(2))
            bytes_ = part.column(2).to_pylist()
            count = np.array([len(own) - LENGTH + 1 for own in bytes_], np.int64)
            digests = b"".join(hashlib.blake2b(own[j:j + LENGTH], digest_size=16).digest() for own, n in zip(bytes_, count) for j in range(n))
            high, low = np.frombuffer(digests, dtype="<i8").reshape(-1, 2).T
            doc = np.repeat(doc, count)
            start = np.repeat(first - np.cumsum(count) + count, count) + np.arange(len(doc))
            order = np.lexsort((start, doc, low, high))
            new = np.concatenate([[True], (high[order][1:] != high[order][:-1]) | (low[order][1:] != low[order][:-1])])
            alone = order[new]
            # what equals the earliest of its string in place too is that very start
            earliest = alone[np.cumsum(new) - 1]
            later = order[(doc[order] != doc[earliest]) | (start[order] != start[earliest])]
            later = later[np.lexsort((start[later], doc[later]))]
            at, place = doc[later], start[later]
            heads = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (place[1:] > place[:-1] + 1)])) if len(later) else later
            length = place[np.append(heads[1:], len(later)) - 1] - place[heads] + 1 if len(later) else later
            rows = len(alone) + len(heads)
            none = pa.nulls(len(heads), pa.int64())
            for c in range(0, rows, 65_536):
                yield pa.RecordBatch.from_arrays([x.slice(c, 65_536) for x in (
                    pa.array(np.repeat(np.array([_OPEN, _REPEATS], np.int32), [len(alone), len(heads)])),
                    pa.concat_arrays([pa.array(high[alone]), none]), pa.concat_arrays([pa.array(low[alone]), none]),
                    pa.array(np.concatenate([doc[alone], at[heads]])), pa.array(np.concatenate([start[alone], place[heads]])),
                    pa.array(np.concatenate([np.ones(len(alone), np.int64), length])))], names=names)


def _compare_strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeated strings of one sorted partition; its first string and the first
    of its last group stay open, as neighbours may hold more of their groups."""
    carry: list[np.ndarray] = []

    def given(kind: int, columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        for k in range(0, len(columns[0]), 65_536):
            cut = [c[k:k + 65_536] for c in columns]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(cut[0]), kind, np.int32)), *map(pa.array, cut)], names=["kind", "high", "low", "doc_id", "start"])

    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if carry:
            columns = [np.concatenate(c) for c in zip(carry, columns)]
        else:
            yield from given(_OPEN, [c[:1] for c in columns])
        high, low, doc, start = columns
        new = np.concatenate([[True], (high[1:] != high[:-1]) | (low[1:] != low[:-1])])
        first = np.maximum.accumulate(np.where(new, np.arange(len(high)), 0))
        rows = np.flatnonzero((doc != doc[first]) | (start != start[first]))
        yield from given(_REPEATS, [c[rows] for c in columns])
        carry = [c[first[-1]:first[-1] + 1].copy() for c in columns]
    if carry:
        yield from given(_OPEN, carry)


def _repeated_strings(contexts: DataFrame, parts: int) -> DataFrame:
    """(doc_id, first, count) of repeated starts, without bringing a key together."""
    keys = ["high", "low", "doc_id", "start"]
    cut = write_out(contexts.mapInArrow(_cut_strings, "kind int, high long, low long, doc_id long, start long, count long"))
    inside = cut.filter(F.col("kind") == _REPEATS).select("doc_id", F.col("start").alias("first"), "count")
    strings = cut.filter(F.col("kind") == _OPEN).select(*keys)
    compared = write_out(strings.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).mapInArrow(
        _compare_strings, "kind int, high long, low long, doc_id long, start long"))
    # two rows of a partition at most
    edges = compared.filter(F.col("kind") == _OPEN).groupBy("high", "low").agg(F.sort_array(F.collect_set(F.struct("doc_id", "start"))).alias("at"))
    edges = edges.select(F.explode(F.slice("at", F.lit(2), F.size("at"))).alias("at")).select("at.doc_id", "at.start")
    repeated = compared.filter(F.col("kind") == _REPEATS).select("doc_id", "start").unionAll(edges)
    return inside.unionAll(repeated.select("doc_id", F.col("start").alias("first"), F.lit(1).cast("long").alias("count")))


def repeated_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, first, count): runs of starts of repeated strings."""
    spark = docs.sparkSession
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    keys = ["anchor", "context", "doc_id", "place"]
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    runs = texts.mapInArrow(_find_runs, "anchor long, context long, doc_id long, place long")
    compared = write_out(runs.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).mapInArrow(_compare_runs, "kind int, doc_id long, place long"))
    whole = compared.filter(F.col("kind") == _REPEATS).select(
        "doc_id", F.shiftright("place", 14).alias("first"), F.shiftright("place", 7).bitwiseAND(F.lit(127)).cast("long").alias("count"))
    wanted = compared.filter(F.col("kind") == _OPEN).groupBy(F.col("doc_id").alias("id")).agg(F.collect_list("place").alias("places"))
    named = texts.select(F.coalesce("doc_id", F.lit(_NO_ID)).alias("doc_id"), "text")
    contexts = named.join(wanted, F.col("doc_id") == F.col("id")).select("doc_id", "text", "places").mapInArrow(
        _cut_contexts, "shard long, doc_id long, first long, bytes binary")
    # the earliest of equal contexts stands for them in its shard; later ones repeat it
    keys = ["shard", "doc_id", "first"]
    found = write_out(contexts.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).mapInArrow(
        _searcher(_HOT), "kind int, doc_id long, first long, count long, bytes binary"))
    inside = found.filter(F.col("kind") == _REPEATS).select("doc_id", "first", "count")
    strings = _repeated_strings(found.filter(F.col("kind") == _OPEN).select("doc_id", "first", "bytes"), parts)
    return whole.unionAll(inside).unionAll(strings)


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, offsets = text_bytes(batch.column(1))
        removed, spans, digests = [], [], []
        for d, found in enumerate(batch.column(2)):
            own = raw[offsets[d]:offsets[d + 1]]
            if found.is_valid and len(own):
                edge = np.zeros(len(own) + 1, dtype=np.int64)
                first = np.minimum(found.values.field("first").to_numpy(), len(own))
                end = np.minimum(first + found.values.field("count").to_numpy() + (LENGTH - 1), len(own))
                np.add.at(edge, first, 1)
                np.add.at(edge, end, -1)
                gone = np.cumsum(edge[:-1]) > 0
                removed.append(int(np.count_nonzero(gone)))
                spans.append(int(np.count_nonzero(gone[1:] & ~gone[:-1]) + gone[0]))
                own = own[~gone]
            else:
                removed.append(0)
                spans.append(0)
            digests.append(hashlib.sha256(own.tobytes()).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(np.diff(offsets).astype(np.int64)), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(digests, pa.string())],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256; a row per input row."""
    spans = repeated_spans(docs, doc_id, text).groupBy(F.col("doc_id").alias("id")).agg(F.collect_list(F.struct("first", "count")).alias("spans"))
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    joined = texts.join(spans, F.coalesce("doc_id", F.lit(_NO_ID)) == F.col("id"), "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(_cut_out, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Removed bytes and the digest of what is left, of every document."""
    return remove_repeats(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


OP4_SQL = """
WITH t AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
b AS (SELECT doc_id, h, (length(h) // 2)::BIGINT AS n FROM t),
q AS (SELECT doc_id, base, substr(h, 2 * base + 1, 2198) AS h, least(1000, n - 99 - base) AS m
      FROM (SELECT doc_id, h, n, unnest(range(0, n - 99, 1000)) AS base FROM b WHERE n >= 100)),
g AS MATERIALIZED (SELECT doc_id, base + o AS p, md5_number(substr(h, 2 * o + 1, 200)) AS g FROM (SELECT *, unnest(range(m)) AS o FROM q)),
f AS (SELECT g, min({'d': doc_id, 'p': p}) AS first FROM g GROUP BY g HAVING count(*) > 1),
k AS (SELECT g.doc_id, g.p FROM g JOIN f ON f.g = g.g WHERE g.doc_id <> f.first.d OR g.p <> f.first.p),
i AS MATERIALIZED (SELECT DISTINCT doc_id, unnest(range(p, p + 100)) AS i FROM k),
v AS (SELECT doc_id, count(*) AS n_removed, count(*) FILTER (WHERE before IS NULL OR before < i - 1) AS n_spans
      FROM (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM i) GROUP BY doc_id),
y AS (SELECT doc_id, base, substr(h, 2 * base + 1, 2000) AS h, least(1000, n - base) AS m
      FROM (SELECT b.doc_id, b.h, b.n, unnest(range(0, b.n, 1000)) AS base FROM b JOIN v ON v.doc_id = b.doc_id)),
x AS (SELECT doc_id, base + o AS i, substr(h, 2 * o + 1, 2) AS x FROM (SELECT *, unnest(range(m)) AS o FROM y)),
c AS (SELECT x.doc_id, string_agg(x.x, '' ORDER BY x.i) AS kept FROM x ANTI JOIN i ON i.doc_id = x.doc_id AND i.i = x.i GROUP BY x.doc_id)
SELECT b.doc_id, b.n AS n_bytes, coalesce(v.n_removed, 0)::BIGINT AS n_removed, coalesce(v.n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(CASE WHEN v.doc_id IS NULL THEN b.h ELSE coalesce(c.kept, '') END)) AS kept_sha256
FROM b LEFT JOIN v ON v.doc_id = b.doc_id LEFT JOIN c ON c.doc_id = b.doc_id
"""
