"""Phrase collocations counted with broadcast double-array tries.

Phrases are of one language each and never cross a piece (a stretch without
``. , ; : ! ?`` and line ends).

1. Words are counted by language; those that occur ``min_count`` times or more
   get codes in order of their hashes. Texts are stored once as runs of codes,
   0 for piece ends and rarer words (no frequent phrase holds either). The
   hashes of at most WORDS words are broadcast at a time; a larger vocabulary
   takes several rounds over the stored runs.
2. Level by level (2 to ``longest`` words): a phrase is a candidate if it
   follows a frequent phrase of the level before by a frequent word, and if
   what the tasks met of it bounds its support by ``min_count`` or more; so no
   frequent phrase is missed, and hardly any other is left. Candidates are cut
   by hash into shards of about PHRASES; each shard becomes a double-array trie
   that is broadcast, all places of a run move through it at once, symbol by
   symbol, and accepting states are counted by ``bincount``. A task sends its
   counts in blocks of _CELLS, which are added up block by block.
3. Frequent phrases are joined with the counts of both sides of every cut,
   scored in exact decimals, and the best of each language are ranked. A phrase
   inside a longer one of the same count goes.

Words are told apart by 64-bit hashes of language and word.

Defined results: NULL text is empty, a NULL language is ``und``; repeated rows
and rows with equal or NULL ids count each; a language without candidates has
no row; ties are ranked by phrase; an empty table gives an empty result; very
long texts are runs of their own; other columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleaner.llm.bytescan import LOWER, U64, chunks, mix, text_bytes, word_hashes, words
from gleaner.llm.common import broadcast_if_few, read_table, write_out
from gleaner.llm.word_trie import PhraseTrie, symbols_per_code
from gleaner.operators.selection import number_rows
from gleaner.session import ensure_checkpoint_dir

MIN_COUNT = 100
LONGEST = 5
TOP = 2_000
WORDS = 1 << 22  # broadcast word hashes, 8 bytes each
PHRASES = 1 << 18  # phrases of a trie, about
_CELLS = 1 << 12  # counts of a row
_HELD = 1 << 20  # distinct phrases a task holds before it sends them
_HELD_WORDS = 1 << 18
_BATCH = 1 << 16

# piece ends become line ends, which are no part of any word
_FOLD = LOWER.copy()
_FOLD[[ord(c) for c in ".,;:!?\n\v\f\r"]] = 0x0A


def _pieces(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(word starts, word ends, document of each word, whether a piece begins
    with it) of folded bytes."""
    starts, ends, bounds = words(raw, offsets)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(bounds))
    splits = np.zeros(len(raw) + 1, np.int64)
    np.cumsum(raw == 0x0A, out=splits[1:])
    begins = np.ones(len(starts), dtype=bool)
    begins[1:] = (splits[starts[1:]] > splits[ends[:-1]]) | (doc[1:] != doc[:-1])
    return starts, ends, doc, begins


def _coded_chunks(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, ...]]:
    """(folded bytes, starts, ends, row of each word, begins, hashes) for the
    columns lang and text of a batch."""
    langs = batch.column(0).fill_null("und").dictionary_encode()
    names, at = [n.encode() for n in langs.dictionary.to_pylist()], langs.indices.to_numpy(zero_copy_only=False)
    joined = np.frombuffer(b"".join(names), dtype=np.uint8)
    ends = np.cumsum([len(n) for n in names], dtype=np.int64)
    lang = mix(word_hashes(joined, ends - [len(n) for n in names], ends) + U64(1)) if len(names) else np.zeros(0, np.uint64)
    raw, offsets = text_bytes(batch.column(1))
    raw = _FOLD[raw]
    for a, _b, part, off in chunks(raw, offsets):
        starts, ends, doc, begins = _pieces(part, off)
        if len(starts):
            yield part, starts, ends, a + doc, begins, mix(word_hashes(part, starts, ends) + lang[at[a + doc]])


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(hash, lang, word, n); rows without a word hold all words of a language."""
    held: dict[tuple, list] = {}

    def given() -> Iterator[pa.RecordBatch]:
        rows = [(h, lang, word, n) for (h, lang), (word, n) in held.items()]
        for k in range(0, len(rows), _BATCH):
            h, lang, word, n = zip(*rows[k:k + _BATCH])
            yield pa.RecordBatch.from_arrays([pa.array(h, pa.int64()), pa.array(lang, pa.string()), pa.array(word, pa.string()), pa.array(n, pa.int64())], names=["h", "lang", "word", "n"])
        held.clear()

    for batch in batches:
        langs = batch.column(0).fill_null("und").to_pylist()
        for raw, starts, ends, row, _begins, hashes in _coded_chunks(batch):
            own, first, n = np.unique(hashes.view(np.int64), return_index=True, return_counts=True)
            for h, k, count in zip(own.tolist(), first.tolist(), n.tolist()):
                key = (h, langs[int(row[k])])
                if key in held:
                    held[key][1] += count
                else:
                    held[key] = [raw[starts[k]:ends[k]].tobytes().decode(), count]
            rows, sizes = np.unique(row, return_counts=True)
            for k, count in zip(rows.tolist(), sizes.tolist()):
                held.setdefault((0, langs[k]), [None, 0])[1] += count
            if len(held) > _HELD_WORDS:
                yield from given()
    yield from given()


def _codes(hashes: np.ndarray, block: np.ndarray, first: int) -> np.ndarray:
    """Codes of the words of a block of sorted hashes; 0 for others."""
    if not len(block):
        return np.zeros(len(hashes), np.int32)
    at = np.minimum(np.searchsorted(block, hashes), len(block) - 1)
    return np.where(block[at] == hashes, at + first, 0).astype(np.int32)


def _tight(codes: np.ndarray) -> np.ndarray:
    """Without words that have no neighbour, and one 0 for several."""
    padded = np.concatenate([[0], codes, [0]]).astype(np.int32)
    padded[1:-1][(padded[:-2] == 0) & (padded[2:] == 0)] = 0
    return padded[1:][(padded[1:] != 0) | (padded[:-1] != 0)]


def _run(codes: np.ndarray, hashes: np.ndarray | None) -> pa.RecordBatch:
    both = [_tight(codes).tobytes(), None] if hashes is None else [codes.tobytes(), hashes.tobytes()]
    return pa.RecordBatch.from_arrays([pa.array([b], pa.binary()) for b in both], names=["codes", "hashes"])


def _encoder(block: Broadcast, first: int, last: bool):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(lang, text) -> (codes, hashes): a row per chunk of texts."""
        for batch in batches:
            for _raw, _starts, _ends, _row, begins, hashes in _coded_chunks(batch):
                at = np.arange(len(hashes)) + np.cumsum(begins)
                spread = np.zeros(at[-1] + 1, np.int64)
                spread[at] = hashes.view(np.int64)
                codes = np.zeros(len(spread), np.int32)
                codes[at] = _codes(hashes.view(np.int64), block.value, first)
                yield _run(codes, None if last else spread)
    return encode


def _recoder(block: Broadcast, first: int, last: bool):
    def recode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                codes = np.frombuffer(batch.column(0)[k].as_py(), np.int32)
                hashes = np.frombuffer(batch.column(1)[k].as_py(), np.int64)
                more = np.where(hashes != 0, _codes(hashes, block.value, first), 0)
                yield _run(np.maximum(codes, more), None if last else hashes)
    return recode


def _store(df: DataFrame, folder: str, name: str) -> DataFrame:
    df.write.option("compression", "zstd").parquet(f"{folder}/{name}")
    return df.sparkSession.read.parquet(f"{folder}/{name}")


def encode_texts(texts: DataFrame, vocabulary: DataFrame, n_words: int, folder: str, block_size: int = WORDS) -> DataFrame:
    """(codes): int32 runs of word codes, stored in ``folder``; ``vocabulary``
    has h and code, codes 1 to ``n_words`` in order of h."""
    sc, runs = texts.sparkSession.sparkContext, None
    firsts = list(range(1, n_words + 1, block_size)) or [1]
    for first in firsts:
        block = vocabulary.filter(F.col("code").between(first, first + block_size - 1)).select("h").toPandas()["h"].to_numpy(np.int64)  # block_size rows at most
        sent, last = sc.broadcast(np.sort(block)), first == firsts[-1]
        step = texts.mapInArrow(_encoder(sent, first, last), "codes binary, hashes binary") if runs is None else \
            runs.mapInArrow(_recoder(sent, first, last), "codes binary, hashes binary")
        runs = _store(step, folder, f"codes-{first}")
        sent.destroy()
    return runs.select("codes")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield np.frombuffer(batch.column(0)[k].as_py(), np.int32)


def _rows(matrix: np.ndarray, last: np.ndarray, names: list[str]) -> Iterator[pa.RecordBatch]:
    for k in range(0, len(matrix), _BATCH):
        columns = [pa.array(np.ascontiguousarray(matrix[k:k + _BATCH, c])) for c in range(matrix.shape[1])]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(last[k:k + _BATCH])], names=names)


def _merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    own, at = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.zeros(len(own), np.int64)
    np.add.at(total, at, np.concatenate(counts))
    return own, total


_PACKED = "bucket int, keys binary, counts binary"


def _packed(keys: np.ndarray, counts: np.ndarray, buckets: int) -> Iterator[pa.RecordBatch]:
    """Keys and counts as one row for each hash bucket that has any."""
    bucket = (mix(keys.view(np.uint64)) % U64(buckets)).astype(np.int32)
    by = np.argsort(bucket, kind="stable")
    keys, counts, bucket = keys[by], counts[by], bucket[by]
    heads = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))[:len(keys)]
    ends = np.append(heads[1:], len(keys))
    for k in range(0, len(heads), 64):
        cuts = list(zip(heads[k:k + 64].tolist(), ends[k:k + 64].tolist()))
        yield pa.RecordBatch.from_arrays([pa.array(bucket[heads[k:k + 64]]), pa.array([keys[i:j].tobytes() for i, j in cuts], pa.binary()),
                                          pa.array([counts[i:j].tobytes() for i, j in cuts], pa.binary())], names=["bucket", "keys", "counts"])


def _proposer(sent: Broadcast | None, width: int, buckets: int):
    def propose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Distinct phrases of ``width`` words that begin with one of the trie's
        (with any word, for two words), with how often a task met them; a key
        is the number of the first words (or the word) and the last word."""
        trie = sent.value[1] if sent else None
        held, counts, size = [], [], 0
        for codes in _runs(batches):
            if trie is None:
                places, head = np.flatnonzero(codes[:-1]), codes[:-1][codes[:-1] != 0]
            else:
                places, head = trie.walk(codes[:-1])
            follow = codes[places + width - 1]
            keys, n = np.unique((head[follow != 0].astype(np.int64) << 32) | follow[follow != 0], return_counts=True)
            held.append(keys)
            counts.append(n)
            size += len(keys)
            if size > 2 * _HELD:
                keys, n = _merged(held, counts)
                held, counts, size = [keys], [n], len(keys)
                if size > _HELD:
                    yield from _packed(keys, n, buckets)
                    held, counts, size = [], [], 0
        if held:
            yield from _packed(*_merged(held, counts), buckets)
    return propose


def _bounder(sent: Broadcast | None, width: int, min_count: int):
    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The tasks' keys of a bucket, which come one after the other, added
        up -> the phrases whose support may reach ``min_count``. Holds a
        bucket's distinct keys."""
        phrases = sent.value[0] if sent else None
        now, held, counts, size, base = None, [], [], 0, 0

        def given() -> Iterator[pa.RecordBatch]:
            if held:
                keys, n = _merged(held, counts)
                keys = keys[n >= min_count]
                head = keys >> 32
                rows = head.astype(np.int32)[:, None] if phrases is None else phrases[head]
                yield from _rows(rows, (keys & 0xFFFFFFFF).astype(np.int32), [f"c{w}" for w in range(1, width + 1)])

        for batch in batches:
            for k in range(batch.num_rows):
                if batch.column(0)[k].as_py() != now:
                    yield from given()
                    now, held, counts, size, base = batch.column(0)[k].as_py(), [], [], 0, 0
                held.append(np.frombuffer(batch.column(1)[k].as_py(), np.int64))
                counts.append(np.frombuffer(batch.column(2)[k].as_py(), np.int64))
                size += len(held[-1])
                if size > 2 * base + _HELD:
                    keys, n = _merged(held, counts)
                    held, counts, size, base = [keys], [n], len(keys), len(keys)
        yield from given()
    return bound


def _counter(sent: Broadcast):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Occurrences of the trie's phrases, _CELLS to a row."""
        phrases, trie = sent.value
        counts = np.zeros(len(phrases), np.int64)
        for codes in _runs(batches):
            _places, found = trie.walk(codes)
            counts += np.bincount(found, minlength=len(phrases))
        for k in range(0, len(counts), _CELLS):
            if counts[k:k + _CELLS].any():
                yield pa.RecordBatch.from_arrays([pa.array([k // _CELLS], pa.int32()), pa.array([counts[k:k + _CELLS].tobytes()], pa.binary())], names=["block", "counts"])
    return count


def _summer(sent: Broadcast, min_count: int):
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The tasks' counts of a block, which come one after the other, added
        up -> the frequent phrases."""
        phrases, _trie = sent.value
        names = [*(f"c{w}" for w in range(1, phrases.shape[1] + 1)), "f"]
        now, total = None, None

        def given() -> Iterator[pa.RecordBatch]:
            if now is not None:
                often = np.flatnonzero(total >= min_count)
                yield from _rows(phrases[now * _CELLS + often], total[often], names)

        for batch in batches:
            for k in range(batch.num_rows):
                block, counts = batch.column(0)[k].as_py(), np.frombuffer(batch.column(1)[k].as_py(), np.int64)
                if block == now:
                    total += counts
                else:
                    yield from given()
                    now, total = block, counts.copy()
        yield from given()
    return add


def _in_tries(runs: DataFrame, phrases: DataFrame, names: list[str], n_symbols: int, shard: int, task) -> list[DataFrame]:
    """The stored results of ``task(broadcast)`` for each trie of about
    ``shard`` phrases."""
    sc, out = runs.sparkSession.sparkContext, []
    shards = -(-phrases.count() // shard)
    for k in range(shards):
        own = phrases.filter(F.pmod(F.xxhash64(*names), F.lit(shards)) == k) if shards > 1 else phrases
        matrix = own.select(*names).toPandas().to_numpy(np.int32)  # about shard rows
        sent = sc.broadcast((matrix, PhraseTrie(matrix, n_symbols)))
        out.append(write_out(task(sent)))
        sent.destroy()
    return out


def _union(frames: list[DataFrame], spark: SparkSession, ddl: str) -> DataFrame:
    out = spark.createDataFrame([], ddl) if not frames else frames[0]
    for df in frames[1:]:
        out = out.unionAll(df)
    return out


def frequent_phrases(runs: DataFrame, n_words: int, min_count: int = MIN_COUNT, longest: int = LONGEST, shard: int = PHRASES) -> list[DataFrame]:
    """(c1..ck, f) of the phrases of 2 to ``longest`` words that occur
    ``min_count`` times or more, by length."""
    spark, levels, n_symbols = runs.sparkSession, [], symbols_per_code(n_words)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    for width in range(2, longest + 1):
        names = [f"c{w}" for w in range(1, width + 1)]
        ddl = ", ".join(f"{c} int" for c in names) + ", f long"

        def propose(sent: Broadcast | None) -> DataFrame:
            met = runs.mapInArrow(_proposer(sent, width, 2 * parts), _PACKED)
            return met.repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(
                _bounder(sent, width, min_count), ddl.removesuffix(", f long"))

        def count(sent: Broadcast) -> DataFrame:
            blocks = runs.mapInArrow(_counter(sent), "block int, counts binary")
            return blocks.repartition(parts, "block").sortWithinPartitions("block").mapInArrow(_summer(sent, min_count), ddl)

        # a phrase has one head, so no two tries propose the same one
        proposed = [write_out(propose(None))] if width == 2 else _in_tries(runs, levels[-1], names[:-1], n_symbols, shard, propose)
        seen = _union(proposed, spark, ddl.removesuffix(", f long"))
        levels.append(_union(_in_tries(runs, seen, names, n_symbols, shard, count), spark, ddl))
    return levels


def _parts(cut: Column, phrase: str = "p") -> tuple[Column, Column]:
    return F.slice(phrase, F.lit(1), cut), F.slice(phrase, cut + 1, F.size(phrase))


def rank_phrases(levels: list[DataFrame], vocabulary: DataFrame, totals: DataFrame, top: int = TOP) -> DataFrame:
    """The best phrases of each language; see the module."""
    every = vocabulary.select(F.array(F.col("code").cast("int")).alias("p"), F.col("n").alias("f"))
    for k, level in enumerate(levels):
        every = every.unionAll(level.select(F.array(*[f"c{w}" for w in range(1, k + 3)]).alias("p"), "f"))
    every = write_out(every)
    phrases = every.filter(F.size("p") > 1)
    parts = F.array(F.struct(F.slice("p", 2, F.size("p")).alias("q")), F.struct(F.slice("p", F.lit(1), F.size("p") - 1).alias("q")))
    inside = phrases.filter(F.size("p") > 2).select(F.explode(parts).alias("x"), F.col("f").alias("a")).select(F.col("x.q").alias("p"), "a").distinct()
    own = write_out(phrases.withColumnRenamed("f", "a").join(inside, ["p", "a"], "left_anti"))
    sides = broadcast_if_few(every)
    cuts = own.select("p", "a", F.explode(F.sequence(F.lit(1), F.size("p") - 1)).alias("cut"))
    cuts = cuts.select("p", "a", "cut", *[c.alias(n) for c, n in zip(_parts(F.col("cut")), ("head", "tail"))])
    cuts = cuts.join(sides.select(F.col("p").alias("head"), F.col("f").alias("l")), "head").join(sides.select(F.col("p").alias("tail"), F.col("f").alias("r")), "tail")
    named = broadcast_if_few(vocabulary.select(F.col("code").cast("int").alias("code"), "lang", "word"))
    cuts = cuts.join(named.select(F.col("code").alias("first"), "lang"), F.col("p")[0] == F.col("first")).join(
        broadcast_if_few(totals.select(F.col("lang").alias("of"), F.col("n").alias("n"))), F.col("lang") == F.col("of"))
    a, l, r, n = (F.col(c).cast("decimal(38,0)") for c in ("a", "l", "r", "n"))
    scored = cuts.withColumns({"over": F.lit(1000).cast("decimal(38,0)") * a * n, "under": l * r}).withColumn("score", F.expr("over div under"))
    best = scored.groupBy("p", "lang", "a", "n").agg(F.min(F.struct("score", "cut", "l", "r")).alias("b")).select(
        "p", "lang", "a", "n", "b.score", "b.l", "b.r")
    for w in range(LONGEST if not levels else len(levels) + 1):
        best = best.withColumn("at", F.get("p", F.lit(w))).join(named.select(F.col("code").alias("at"), F.col("word").alias(f"w{w}")), "at", "left").drop("at")
    texts = best.withColumn("phrase", F.concat_ws(" ", *[f"w{w}" for w in range(len(levels) + 1)]))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = texts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def mine_phrases(docs: DataFrame, text: str = "text", lang: str = "lang", min_count: int = MIN_COUNT, longest: int = LONGEST,
                 top: int = TOP, block_size: int = WORDS, shard: int = PHRASES) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's ``top`` phrases."""
    folder = f"{ensure_checkpoint_dir(docs.sparkSession)}/phrases-{uuid.uuid4().hex}"
    texts = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    counted = texts.mapInArrow(_count_words, "h long, lang string, word string, n long").groupBy("h", "lang", "word").agg(F.sum("n").alias("n"))
    counted = write_out(counted.filter((F.col("n") >= min_count) | F.col("word").isNull()))
    totals = counted.filter(F.col("word").isNull()).select("lang", "n")
    numbered, n_words = number_rows(counted.filter(F.col("word").isNotNull()), ["h", "lang", "word"])
    vocabulary = write_out(numbered.withColumn("code", F.col("position") + 1).select("h", "code", "lang", "word", "n"))
    runs = encode_texts(texts, vocabulary, n_words, folder, block_size)
    return rank_phrases(frequent_phrases(runs, n_words, min_count, longest, shard), vocabulary, totals, top)


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best phrases of every language of the documents."""
    return mine_phrases(read_table(spark, sf_dir, "documents"))


OP11_SQL = r"""
WITH t AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
s AS (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM t),
p AS MATERIALIZED (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM s),
m AS (SELECT lang, sum(len(w))::BIGINT AS n FROM p GROUP BY lang),
g AS (SELECT lang, k, w[i:i + k - 1] AS q FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM p, (SELECT unnest(range(1, 6)) AS k) WHERE len(w) >= k)),
f AS MATERIALIZED (SELECT lang, q, len(q) AS k, count(*) AS f FROM g GROUP BY lang, q HAVING count(*) >= 100),
i AS (SELECT lang, q[1:k - 1] AS q, f FROM f WHERE k > 2 UNION SELECT lang, q[2:k] AS q, f FROM f WHERE k > 2),
c AS (SELECT f.* FROM f ANTI JOIN i ON i.lang = f.lang AND i.q = f.q AND i.f = f.f WHERE f.k > 1),
x AS (SELECT c.*, cut, q[1:cut] AS head, q[cut + 1:] AS tail FROM (SELECT *, unnest(range(1, k)) AS cut FROM c) c),
y AS (SELECT x.lang, x.q, x.f AS a, x.cut, l.f AS l, r.f AS r, m.n, ((1000::HUGEINT * x.f * m.n) // (l.f::HUGEINT * r.f))::BIGINT AS score
      FROM x JOIN f l ON l.lang = x.lang AND l.q = x.head JOIN f r ON r.lang = x.lang AND r.q = x.tail JOIN m ON m.lang = x.lang),
z AS (SELECT * FROM y QUALIFY row_number() OVER (PARTITION BY lang, q ORDER BY score, cut) = 1),
o AS (SELECT lang, array_to_string(q, ' ') AS phrase, a, l, r, n, score FROM z)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM o
QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) <= 2000
"""
