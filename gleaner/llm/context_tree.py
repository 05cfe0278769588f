"""Language-model scores by context-tree weighting over bytes.

Every byte is eight binary decisions; each decision under each context of
0..``DEPTH`` preceding bytes has a Krichevsky-Trofimov estimate. Contexts are
exact bytes (A-Z folded), as the predicted byte is. A node's weighted
probability is half its own estimate and half the product of its children's,
so all depths are mixed by how well they code the training texts. The trained
tree predicts each byte of a text; the sum of the logarithms is its score, the
negative of its code length. Beside it stands an add-one unigram score.

The statistics come from all training texts: counts of (context, byte) and of
words, summed in each task before the shuffle. The tree is a table of nodes
(context, bit prefix) for each depth, which grows with the corpus: estimates are
folded from the longest contexts to the shortest by groupBy, and mixed back to
the longest by joins. Every (context, byte) that any text has meets its bits in
the longest contexts that training texts have. Of both words and (context,
byte) the most frequent (``FREQUENT``, ``FREQUENT_CODES``) are sent to all tasks;
the others of a text meet their values in an equi-join, so all get their true ones.

Defined results: NULL text is empty and scores 0; a NULL ``doc_id`` counts as
the text ``null`` for the split; before the start of a text, context bytes are
zero; equal rows get equal scores and all train; without training texts every
bit has probability one half; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm.bytescan import LOWER, U64, chunks, text_bytes, word_hashes, words
from gleaner.llm.common import LEAST_PARTS, read_table, write_out
from gleaner.session import stored_once

FREQUENT = 200_000
FREQUENT_CODES = 500_000
DEPTH = 4
SYMBOLS = 256
_WORD, _BYTES, _END, _ASKED = 0, 1, 2, 3
_FLUSH = 1 << 20  # distinct keys a task holds before it hands them on
_NODES = 250_000  # nodes for which a stored level gets a part
_CLASS = np.arange(SYMBOLS)  # a context byte counts as itself


def _codes(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(context of DEPTH preceding bytes, byte) of every byte as one number;
    the nearest byte is the context's last digit."""
    b = LOWER[raw].astype(np.int64)
    code = b.copy()
    for back in range(1, DEPTH + 1):
        code[back:] |= b[:-back] << (8 * back)
    starts, ends = offsets[:-1], offsets[1:]
    for k in range(DEPTH):  # bytes before the start of a text are zero
        code[starts[starts + k < ends] + k] &= (1 << 8 * (k + 1)) - 1
    return code


def _merge(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    k, c = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(k, kind="stable")
    k, c = k[order], c[order]
    heads = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.zeros(0, np.int64)
    return k[heads], np.add.reduceat(c, heads) if len(heads) else c


class _Counts:
    def __init__(self, kind: int):
        self.kind, self.keys, self.counts, self.held = kind, [], [], 0

    def add(self, values: np.ndarray) -> Iterator[pa.RecordBatch]:
        k, c = np.unique(values, return_counts=True)
        self.keys.append(k.view(np.int64))
        self.counts.append(c)
        self.held += len(k)
        if self.held > _FLUSH:
            k, c = _merge(self.keys, self.counts)
            self.keys, self.counts, self.held = [k], [c], len(k)
            if self.held > _FLUSH // 2:
                yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.held:
            k, c = _merge(self.keys, self.counts)
            for at in range(0, len(k), 65_536):
                part = k[at:at + 65_536]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), self.kind, np.int32)), pa.array(part), pa.array(c[at:at + 65_536])], names=["kind", "key", "n"])
        self.keys, self.counts, self.held = [], [], 0


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen, grams, asked, ends = _Counts(_WORD), _Counts(_BYTES), _Counts(_ASKED), 0
    for batch in batches:
        held = batch.column(1)
        raw, offsets = text_bytes(batch.column(0).filter(pc.invert(held)))
        ends += len(offsets) - 1
        for _first, _end, part, off in chunks(raw, offsets):
            starts, stops, _ = words(part, off)
            yield from seen.add(word_hashes(part, starts, stops))
            yield from grams.add(_codes(part, off))
        for _first, _end, part, off in chunks(*text_bytes(batch.column(0).filter(held))):
            yield from asked.add(_codes(part, off))
    for counts in (seen, grams, asked):
        yield from counts.flush()
    yield pa.RecordBatch.from_arrays([pa.array([_END], pa.int32()), pa.array([0], pa.int64()), pa.array([ends], pa.int64())], names=["kind", "key", "n"])


def text_counts(texts: DataFrame) -> DataFrame:
    """(kind, key, n) of (text, held_out): counts of word hashes, of codes and of
    texts in training texts, and of codes in the others."""
    return texts.mapInArrow(_count, "kind int, key long, n long").groupBy("kind", "key").agg(F.sum("n").alias("n"))


def _log_gamma(x: Column) -> Column:
    """``_lgamma`` as a column."""
    shift = x
    for k in range(1, 8):
        shift = shift * (x + k)
    y = x + 8
    series = 1 / (12 * y) - 1 / (360 * y * y * y) + 1 / (1260 * y * y * y * y * y) - 1 / (1680 * y * y * y * y * y * y * y)
    return (y - 0.5) * F.log(y) - y + 0.5 * float(np.log(2 * np.pi)) + series - F.log(shift)


def _steps(key: Column) -> Column:
    """(node, bit) of the eight decisions of a code's byte; nodes in heap order from 1."""
    byte = key.bitwiseAND(255)
    return (F.array(*[F.struct(F.shiftright(byte, 8 - k).bitwiseOR(1 << k).cast("int").alias("node"),
                                        F.shiftright(byte, 7 - k).bitwiseAND(1).cast("int").alias("bit")) for k in range(8)]))


def _suffix(context: Column, depth: int) -> Column:
    return context.bitwiseAND(F.lit(SYMBOLS ** depth - 1).cast("long"))


def _store(df: DataFrame, rows: int) -> DataFrame:
    return stored_once(df.coalesce(max(LEAST_PARTS, -(-rows // _NODES))))


def tree_levels(grams: DataFrame) -> list[DataFrame]:
    """For each depth, (context, node, bit): the mixed probability of a one at
    every node that a training text visited. ``grams``: (key, n)."""
    x = grams.select(F.shiftright("key", 8).alias("context"), F.explode(_steps(F.col("key"))).alias("s"), F.col("n").cast("double").alias("n"))
    rows = x.groupBy("context", F.col("s.node").alias("node")).agg(
        F.sum(F.when(F.col("s.bit") == 0, F.col("n")).otherwise(0.0)).alias("zeros"), F.sum(F.when(F.col("s.bit") == 1, F.col("n")).otherwise(0.0)).alias("ones"))
    sizes: list[int] = []
    half, size = float(np.log(0.5)), 8 * grams.count()
    levels: list[DataFrame] = []
    for depth in range(DEPTH, -1, -1):  # shorter contexts: sums over what came before
        zeros, ones = F.col("zeros"), F.col("ones")
        rows = rows.withColumn("own", _log_gamma(zeros + 0.5) + _log_gamma(ones + 0.5) - float(np.log(np.pi)) - _log_gamma(zeros + ones + 1))
        top = F.greatest("own", "below") if depth < DEPTH else None
        both = F.col("own") if top is None else half + top + F.log1p(F.exp(F.least("own", "below") - top))
        rows = rows.withColumn("both", both)
        level = _store(rows.select("context", "node", "zeros", "ones", "both", ((ones + 0.5) / (zeros + ones + 1)).alias("kt"),
                                   (F.exp(half + F.col("own") - F.col("both")) if depth < DEPTH else F.lit(1.0)).alias("w")), size)
        size = level.count()
        levels.insert(0, level)
        sizes.insert(0, size)
        if depth:
            rows = level.groupBy(_suffix(F.col("context"), depth - 1).alias("context"), "node").agg(
                F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("both").alias("below"))
    out: list[DataFrame] = []
    for depth, level in enumerate(levels):  # mixed so far, and the weight left for longer contexts
        level = level.select("context", "node", "kt", "w")
        if depth:
            before = out[-1].select(F.col("context").alias("c"), F.col("node").alias("m"), "fixed", "rest")
            level = level.join(before, (_suffix(level["context"], depth - 1) == F.col("c")) & (level["node"] == F.col("m")))
        else:
            level = level.withColumns({"fixed": F.lit(0.0), "rest": F.lit(1.0)})
        out.append(_store(level.select("context", "node", (F.col("fixed") + F.col("rest") * F.col("w") * F.col("kt")).alias("fixed"), (F.col("rest") * (1 - F.col("w"))).alias("rest")), sizes[depth]))
    return [x.select("context", "node", (F.col("fixed") + F.col("rest") / 2).alias("one")) for x in out]


def code_logs(counts: DataFrame) -> DataFrame:
    """(key, n, log): log10 P(byte | context) of every code that a text has, and
    its count in all texts. Each bit has the estimate of its longest visited
    context, as nodes without counts pass on that of the shorter one; without
    any it is even. ``counts``: (kind, key, n)."""
    codes = counts.filter(F.col("kind").isin(_BYTES, _ASKED)).groupBy("key").agg(F.sum("n").alias("n"), F.min("kind").alias("kind"))
    codes = stored_once(codes)
    size = codes.count()
    levels = tree_levels(counts.filter(F.col("kind") == _BYTES).select("key", "n"))
    waiting = codes.select("key", F.lit(0).cast("long").alias("done"))
    found: list[DataFrame] = []
    for depth in range(DEPTH, -1, -1):
        level = levels[depth].select(F.col("context").alias("c"), F.col("node").alias("m"), "one")
        same = (_suffix(F.shiftright("key", 8), depth) == F.col("c")) & (F.col("node") == F.col("m"))
        one = F.col("one") if depth else F.coalesce("one", F.lit(0.5))
        bits = waiting.select("key", "done", F.explode(F.slice(_steps(F.col("key")), F.col("done") + 1, 8)).alias("s")).select("key", "done", "s.node", "s.bit")
        rows = bits.join(level, same, "left").select("key", "done", F.log10(F.when(F.col("bit") == 1, one).otherwise(1 - one)).alias("log"))
        # a visited node's shorter prefixes are visited: the first bits are found, the rest goes on
        rows = _store(rows.groupBy("key").agg(F.sum("log").alias("log"), (F.max("done") + F.count("log")).alias("done")), size)
        found.append(rows.select("key", "log"))
        waiting = rows.filter("done < 8").select("key", "done")
    every = found[0]
    for x in found[1:]:
        every = every.unionAll(x)
    logs = every.groupBy("key").agg(F.sum("log").alias("log"))
    return stored_once(codes.select("key", "n").join(logs, "key"))


def _lgamma(x: np.ndarray) -> np.ndarray:
    """Logarithm of the gamma function for x > 0 (Stirling's series at x + 8)."""
    shift = np.ones_like(x)
    for k in range(8):
        shift *= x + k
    y = x + 8
    series = 1 / (12 * y) - 1 / (360 * y ** 3) + 1 / (1260 * y ** 5) - 1 / (1680 * y ** 7)
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - np.log(shift)


def _bit_counts(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Zeros and ones at the 255 bit nodes (heap order from 1) of each row of
    byte counts."""
    total = np.zeros((len(n), 512))
    total[:, 256:] = n
    for node in range(255, 0, -1):
        total[:, node] = total[:, 2 * node] + total[:, 2 * node + 1]
    return total[:, 2:512:2], total[:, 3:512:2]


class ContextTree:
    """Weighted context tree of few texts as log10 P(byte | context), held as
    arrays: what ``tree_levels`` and ``code_logs`` must agree with.

    ``table`` has a row of 256 for every context of any depth that was seen. A
    context that was not has the row of its longest seen part."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray):
        seen = [np.unique(codes >> 8)]
        n = np.zeros((len(seen[0]), 256))
        n[np.searchsorted(seen[0], codes >> 8), codes & 255] = counts
        by_depth = [n]
        for depth in range(DEPTH - 1, -1, -1):  # shorter contexts: sums over what came before
            shorter = seen[0] % SYMBOLS ** depth
            seen.insert(0, np.unique(shorter))
            n = np.zeros((len(seen[0]), 256))
            np.add.at(n, np.searchsorted(seen[0], shorter), by_depth[0])
            by_depth.insert(0, n)
        if not len(codes):  # nothing seen: one node without counts
            seen[0], by_depth[0] = np.zeros(1, np.int64), np.zeros((1, 256))
        half = np.log(0.5)
        weight: list[np.ndarray] = [np.zeros(0)] * (DEPTH + 1)
        kt: list[np.ndarray] = [np.zeros(0)] * (DEPTH + 1)
        below = np.zeros(0)
        for depth in range(DEPTH, -1, -1):
            zeros, ones = _bit_counts(by_depth[depth])
            own = _lgamma(zeros + 0.5) + _lgamma(ones + 0.5) - np.log(np.pi) - _lgamma(zeros + ones + 1)
            kt[depth] = (ones + 0.5) / (zeros + ones + 1)
            if depth == DEPTH:
                both, weight[depth] = own, np.ones_like(own)
            else:
                both = half + np.logaddexp(own, below)
                weight[depth] = np.exp(half + own - both)
            if depth:
                parent = np.searchsorted(seen[depth - 1], seen[depth] % SYMBOLS ** (depth - 1))
                below = np.zeros((len(seen[depth - 1]), 255))
                np.add.at(below, parent, both)
        tables = []
        fixed, rest = np.zeros((1, 255)), np.ones((1, 255))
        for depth in range(DEPTH + 1):  # mixed so far, and the weight left for longer contexts
            parent = np.searchsorted(seen[depth - 1], seen[depth] % SYMBOLS ** (depth - 1)) if depth else np.zeros(len(seen[0]), np.int64)
            fixed = fixed[parent] + rest[parent] * weight[depth] * kt[depth]
            rest = rest[parent] * (1 - weight[depth])
            bit = fixed + rest / 2
            logs = np.zeros((len(bit), 512))
            for node in range(1, 256):
                logs[:, 2 * node] = logs[:, node] + np.log10(1 - bit[:, node - 1])
                logs[:, 2 * node + 1] = logs[:, node] + np.log10(bit[:, node - 1])
            tables.append(logs[:, 256:])
        self.seen, self.first = seen, np.cumsum([0, *map(len, seen)])
        self.table = np.concatenate(tables).ravel()

    def row(self, contexts: np.ndarray) -> np.ndarray:
        """The table's row for each full context."""
        out = np.zeros(len(contexts), dtype=np.int64)
        for depth in range(DEPTH + 1):
            part = contexts % SYMBOLS ** depth
            at = np.searchsorted(self.seen[depth], part)
            at[at == len(self.seen[depth])] = 0
            known = self.seen[depth][at] == part if len(self.seen[depth]) else np.zeros(len(part), bool)
            out[known] = self.first[depth] + at[known]
        return out

    def score(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """log10 probability of each text."""
        codes = _codes(raw, offsets)
        each = self.table[self.row(codes >> 8) * 256 + (codes & 255)]
        out, full = np.zeros(len(offsets) - 1), np.diff(offsets) > 0
        if full.any():
            out[full] = np.add.reduceat(each, offsets[:-1][full])
        return out


_SCORED = ("doc_id long, tag long, held_out boolean, n_words long, n_frequent long, part double, score double, "
           "rare array<long>, times array<long>, rare_codes array<long>, code_times array<long>")


class _Values:
    """Logarithms by key: a table of slots by a hash of the key, the other keys
    of a slot by search."""

    def __init__(self, keys: np.ndarray, logs: np.ndarray):
        bits = max(4, int(4 * len(keys)).bit_length())
        self.keys, self.logs, self.shift = keys, logs, U64(64 - bits)
        self.slot_key, self.slot_log = np.zeros(1 << bits, np.int64), np.zeros(1 << bits)
        self.used = np.zeros(1 << bits, dtype=bool)
        at = self._slots(keys)
        self.slot_key[at], self.slot_log[at], self.used[at] = keys, logs, True

    def _slots(self, values: np.ndarray) -> np.ndarray:
        return ((values.view(np.uint64) * U64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(logarithm or 0, known) of each value."""
        at = self._slots(values)
        known = (self.slot_key[at] == values) & self.used[at]
        out = np.where(known, self.slot_log[at], 0.0)
        other = np.flatnonzero(~known)
        if len(other) and len(self.keys):
            left = values[other]
            at = np.minimum(np.searchsorted(self.keys, left), len(self.keys) - 1)
            same = self.keys[at] == left
            out[other[same]], known[other[same]] = self.logs[at[same]], True
        return out, known


def _look_up(values: np.ndarray, bounds: np.ndarray, table: _Values) -> tuple[np.ndarray, np.ndarray, pa.Array, pa.Array]:
    """For each text: sum and number of the values that the table has, and the
    others with their counts."""
    n = len(bounds) - 1
    each, known = table.find(values)
    total, frequent, full = np.zeros(n), np.zeros(n, np.int64), np.diff(bounds) > 0
    if full.any():
        total[full] = np.add.reduceat(each, bounds[:-1][full])
        frequent[full] = np.add.reduceat(known, bounds[:-1][full], dtype=np.int64)
    others = np.flatnonzero(~known)
    left_doc, left = np.searchsorted(bounds, others, side="right") - 1, values[others]
    order = np.lexsort((left, left_doc))
    left_doc, left = left_doc[order], left[order]
    heads = np.flatnonzero(np.concatenate([[True], (left[1:] != left[:-1]) | (left_doc[1:] != left_doc[:-1])])) if len(left) else np.zeros(0, np.int64)
    times = np.diff(np.append(heads, len(left))).astype(np.int64)
    ends = pa.array(np.searchsorted(left_doc[heads], np.arange(n + 1)).astype(np.int32))
    return total, frequent, pa.ListArray.from_arrays(ends, pa.array(left[heads])), pa.ListArray.from_arrays(ends, pa.array(times))


def _scorer(keys: np.ndarray, logs: np.ndarray, code_keys: np.ndarray, code_logs: np.ndarray):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_word, by_code = _Values(keys, logs), _Values(code_keys, code_logs)
        for batch in batches:
            raw, offsets = text_bytes(batch.column(3))
            for first, end, part, off in chunks(raw, offsets):
                starts, stops, bounds = words(part, off)
                total, frequent, rare, times = _look_up(word_hashes(part, starts, stops).view(np.int64), bounds, by_word)
                bits, _, rare_codes, code_times = _look_up(_codes(part, off), off, by_code)
                rows = batch.slice(first, end - first)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0).cast(pa.int64()), rows.column(1), rows.column(2), pa.array(np.diff(bounds).astype(np.int64)), pa.array(frequent),
                     pa.array(total), pa.array(bits), rare, times, rare_codes, code_times],
                    names=["doc_id", "tag", "held_out", "n_words", "n_frequent", "part", "score", "rare", "times", "rare_codes", "code_times"])
    return score


def _least_count(by_word: DataFrame, frequent: int) -> int:
    """The least count from which on there are at most ``frequent`` words, up
    to the width of a bin: counts are binned by 16ths of an octave, so the
    histogram has about a thousand rows at most."""
    bins = F.floor(F.log2("n") * 16).cast("int")
    rows = by_word.groupBy(bins.alias("bin")).agg(F.count("*").alias("words"), F.min("n").alias("least")).orderBy(F.desc("bin")).collect()
    total, least = 0, 1 << 62
    for row in rows:
        total += row["words"]
        if total > frequent:
            break
        least = row["least"]
    return least


def held_out(doc_id: Column, folds: int = 7, fold: int = 2) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("null"))), F.lit(folds)) == fold


def _top(rows: DataFrame, frequent: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys and logarithms of the ``frequent`` most frequent rows at most."""
    top = rows.filter(F.col("n") >= _least_count(rows, frequent)).select("key", "log").toPandas().sort_values("key")
    return top["key"].to_numpy(np.int64), top["log"].to_numpy(np.float64)


def score_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", frequent: int = FREQUENT, frequent_codes: int = FREQUENT_CODES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score; a
    row per input row."""
    x = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(F.col(text).isNull(), text).alias("tag"), held_out(F.col(doc_id)).alias("held_out"), F.col(text).alias("text"))
    counts = stored_once(text_counts(x.select("text", "held_out")))
    sums = {r["kind"]: (r["n"], r["rows"]) for r in counts.groupBy("kind").agg(F.sum("n").alias("n"), F.count("*").alias("rows")).collect()}
    n_texts = int(sums.get(_END, (0, 0))[0] or 0)
    n_train = int(sums.get(_WORD, (0, 0))[0] or 0) + n_texts
    vocabulary = int(sums.get(_WORD, (0, 0))[1]) + (n_texts > 0)
    by_code = code_logs(counts)
    by_word = counts.filter(F.col("kind") == _WORD).select("key", "n", F.log10(F.col("n") + 1.0).alias("log"))
    scored = write_out(x.mapInArrow(_scorer(*_top(by_word, frequent), *_top(by_code, frequent_codes)), _SCORED))

    def left(keys: str, times: str, kind: int) -> DataFrame:
        each = scored.filter(F.size(keys) > 0).select("doc_id", "tag", F.explode(F.arrays_zip(F.col(keys).alias("k"), F.col(times).alias("t"))).alias("r"))
        return each.select("doc_id", "tag", F.lit(kind).alias("kind"), F.col("r.k").alias("key"), F.col("r.t").alias("times")).distinct()

    rare = left("rare", "times", _WORD).join(by_word.select("key", "log"), "key").unionByName(
        left("rare_codes", "code_times", _BYTES).join(by_code.select("key", "log"), "key"))
    word, cost_of = F.col("kind") == _WORD, F.col("times") * F.col("log")
    found = rare.groupBy(F.col("doc_id").alias("d"), F.col("tag").alias("g")).agg(
        F.sum(F.when(word, F.col("times"))).alias("n_rare"), F.sum(F.when(word, cost_of)).alias("rare_part"), F.sum(F.when(~word, cost_of)).alias("rare_score"))
    joined = scored.join(found, scored["doc_id"].eqNullSafe(found["d"]) & (scored["tag"] == found["g"]), "left")
    n_tokens = F.col("n_words") + 1
    cost = float(np.log10(n_train + vocabulary + 1))
    base = F.col("part") + F.coalesce("rare_part", F.lit(0.0)) + float(np.log10(n_texts + 1)) - n_tokens * cost
    known = F.col("n_frequent") + F.coalesce("n_rare", F.lit(0)) + int(n_texts > 0)
    return joined.select("doc_id", "held_out", n_tokens.cast("long").alias("n_tokens"), known.cast("long").alias("n_known"),
                         F.lit(n_train).cast("long").alias("train_tokens"), base.alias("base_score"), (F.col("score") + F.coalesce("rare_score", F.lit(0.0))).alias("score"))


def op8_context_tree_weighting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram and context-tree scores of every document."""
    return score_documents(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
