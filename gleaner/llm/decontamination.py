"""Benchmark decontamination by a prefix-filtered set join, in DataFrame
operations only.

Items are cut into windows of ``window`` consecutive words (an item with fewer
words is one window). A text can hold a window only if it holds every word of
it, so the rarest word of a window, by its count over all documents, is the
whole necessary prefix at containment 1. Documents are scanned for those words
only; each occurrence meets the windows that have it as prefix, the length and
the offset of the word bound where the window may lie, and the words there are
compared one by one. Windows with a word that no document has are left out.

The prefix words of at most ``BLOCK`` windows are looked up in a scan; more
windows are handled in further blocks of that size, each against all
documents, so what is broadcast does not grow with the benchmark.

Defined results: NULL or empty texts have no words and no hits; items without
words have no windows; rows of ``documents`` with the same id but other texts
are judged apart, equal rows alike; NULL ids are kept; an empty benchmark hits
nothing. ``items_sha256`` of a clean document is the digest of the empty text.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm.common import broadcast_if_few, fill_null, lower_ascii, private_names, read_table, write_out

WINDOW = 10
BLOCK = 20_000
_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def item_words(text: Column) -> Column:
    """Words of a text for matching: A-Z folded, runs of letters, digits and
    non-ASCII characters."""
    t = fill_null(text)
    folded = F.when(F.octet_length(t) == F.length(t), F.lower(t)).otherwise(lower_ascii(t))
    return F.filter(F.split(folded, _BREAK), lambda w: w != "")


def item_windows(items: DataFrame, item_id: str, text: str, window: int) -> DataFrame:
    """(item_id, words) of every window of every item."""
    x = items.select(F.col(item_id).alias("item_id"), item_words(F.col(text)).alias("w")).filter(F.size("w") > 0)
    last = F.greatest(F.size("w") - window + 1, F.lit(1))
    return x.select("item_id", F.explode(F.transform(F.sequence(F.lit(1), last), lambda i: F.slice("w", i, window))).alias("words"))


def _blocks(df: DataFrame, by: str) -> Iterator[DataFrame]:
    """``df`` in parts of about ``BLOCK`` rows at most, by a hash of ``by``."""
    n = df.count()
    parts = -(-n // BLOCK)
    for k in range(parts):
        yield df.filter(F.pmod(F.xxhash64(by), F.lit(parts)) == k) if parts > 1 else df


def word_counts(docs: DataFrame, text: str, vocabulary: DataFrame) -> DataFrame:
    """(word, n) over all documents, for the words of ``vocabulary``."""
    out = None
    for part in _blocks(vocabulary, "word"):
        known = [r[0] for r in part.collect()]  # at most about BLOCK words
        found = docs.select(F.explode(F.filter(item_words(F.col(text)), lambda w: w.isin(known))).alias("word"))
        counted = found.groupBy("word").agg(F.count("*").alias("n"))
        out = counted if out is None else out.unionAll(counted)
    return out if out is not None else vocabulary.select("word", F.lit(0).cast("long").alias("n"))


def rarest_words(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """(wid, words, token, offset): the rarest word of each window, with its
    first offset; windows with a word that never occurs are left out."""
    each = windows.select("wid", F.posexplode("words").alias("offset", "word"))
    best = each.join(counts, "word", "left").groupBy("wid").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "word", "offset")).alias("b"))
    return windows.join(best.filter("b.n > 0"), "wid").select("wid", "words", F.col("b.word").alias("token"), F.col("b.offset").alias("offset"))


def find_hits(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
              item_text: str = "text", window: int = WINDOW) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents, occurrences, windows).

    documents: (doc, key, n_words), one row per input row; occurrences: (doc,
    key, start, wid, n) of windows, start counted in words from 0; windows:
    (wid, item_id). ``key`` tells texts of one id apart."""
    owned = write_out(item_windows(items, item_id, item_text, window))
    n = owned.count()
    windows = write_out(owned.groupBy("words").agg(F.count("*").alias("n")).select(F.sha2(F.to_json("words"), 256).alias("wid"), "words"), n)
    owners = owned.select(F.sha2(F.to_json("words"), 256).alias("wid"), "item_id").distinct()
    vocabulary = write_out(windows.select(F.explode("words").alias("word")).distinct(), n)
    prefixes = write_out(rarest_words(windows, word_counts(docs, text, vocabulary)), n)
    tokens = write_out(prefixes.groupBy(F.col("token").alias("word")).agg(F.count("*").alias("n")), n)

    base = docs.select(F.col(doc_id).alias("doc"), F.xxhash64(F.col(text).isNull(), text).alias("key"), item_words(F.col(text)).alias("w"))
    reach = window - 1
    documents, found = None, None
    for part in _blocks(tokens, "word"):
        rows = part.collect()  # at most about BLOCK words
        known, n_windows = [r["word"] for r in rows], sum(r["n"] for r in rows)
        places = F.filter(F.transform("w", lambda w, i: F.when(w.isin(known), i)), lambda i: i.isNotNull())
        cut = base.select("doc", "key", F.size("w").alias("n_words"), F.transform(places, lambda i: F.struct(
            i.alias("at"), F.greatest(i - reach, F.lit(0)).alias("first"), F.element_at("w", i + 1).alias("token"),
            F.slice("w", F.greatest(i - reach, F.lit(0)) + 1, 2 * window).alias("near"))).alias("places"))
        cut = write_out(cut)
        documents = cut.select("doc", "key", "n_words") if documents is None else documents
        each = cut.filter(F.size("places") > 0).select("doc", "key", "n_words", F.explode("places").alias("p")).select("doc", "key", "n_words", "p.*")
        # broadcast while the block's windows are as few as its words; else Spark chooses
        mine = prefixes.filter(F.col("token").isin(known))
        mine = F.broadcast(mine) if n_windows <= 4 * BLOCK else mine
        start, size = F.col("at") - F.col("offset"), F.size("words")
        hit = each.join(mine, "token").filter((start >= 0) & (start + size <= F.col("n_words"))).filter(
            F.slice("near", start - F.col("first") + 1, size) == F.col("words"))
        hit = hit.select("doc", "key", start.alias("start"), "wid", size.alias("n"))
        found = hit if found is None else found.unionAll(hit)
    if documents is None:
        documents = write_out(base.select("doc", "key", F.size("w").alias("n_words")))
        found = documents.filter("false").select("doc", "key", F.lit(0).alias("start"), F.lit("").alias("wid"), F.lit(0).alias("n"))
    return documents, write_out(found), write_out(owners, n)


def contamination(docs: DataFrame, items: DataFrame, **names) -> DataFrame:
    """(doc, key, n_words, n_hit, n_items, items_sha256), a row per input row."""
    documents, found, owners = find_hits(docs, items, **names)
    words = F.size(F.array_distinct(F.flatten(F.collect_set(F.sequence(F.col("start"), F.col("start") + F.col("n") - 1)))))
    hits = found.groupBy("doc", "key").agg(words.cast("long").alias("n_hit"))
    ids = F.array_sort(F.collect_set(F.coalesce(F.col("item_id").cast("string"), F.lit("null"))))
    listed = found.select("doc", "key", "wid").distinct().join(owners, "wid").groupBy("doc", "key").agg(ids.alias("ids"))
    both = hits.join(listed, hits["doc"].eqNullSafe(listed["doc"]) & (hits["key"] == listed["key"])).select(
        hits["doc"].alias("d"), hits["key"].alias("k"), "n_hit", "ids")
    joined = documents.join(both, F.col("doc").eqNullSafe(F.col("d")) & (F.col("key") == F.col("k")), "left")
    none = F.array().cast("array<string>")
    return joined.select(
        "doc", "key", F.col("n_words").cast("long").alias("n_words"), F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(F.coalesce("ids", none)).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.coalesce("ids", none), ","), 256).alias("items_sha256"))


def drop_contaminated(docs: DataFrame, items: DataFrame, **names) -> DataFrame:
    """The rows of ``docs`` that hold no window of any item."""
    doc_id, text = names.get("doc_id", "doc_id"), names.get("text", "text")
    _, found, _ = find_hits(docs, items, **names)
    n = private_names(docs.columns, ["bad_doc", "bad_key"])
    bad = found.select(F.col("doc").alias(n["bad_doc"]), F.col("key").alias(n["bad_key"])).distinct()
    same = docs[doc_id].eqNullSafe(F.col(n["bad_doc"])) & (F.xxhash64(docs[text].isNull(), docs[text]) == F.col(n["bad_key"]))
    return docs.join(broadcast_if_few(write_out(bad)), same, "left_anti")


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """n_words, n_hit, n_items, items_sha256, contaminated of every document."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    result = contamination(docs, read_table(spark, sf_dir, "benchmark"))
    return result.select(F.col("doc").alias("doc_id"), "n_words", "n_hit", "n_items", "items_sha256", (F.col("n_hit") > 0).alias("contaminated"))


_SQL_WORDS = r"list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"

OP10_SQL = rf"""
WITH d AS (SELECT doc_id, {_SQL_WORDS} AS w FROM documents),
i AS (SELECT item_id, w FROM (SELECT item_id, {_SQL_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
s AS (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS p FROM i),
x AS (SELECT item_id, w[p:p + 9] AS g FROM s),
l AS (SELECT DISTINCT len(g) AS n FROM x),
p AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, l WHERE len(w) >= n),
h AS (SELECT p.doc_id, p.p, p.n, x.item_id FROM (SELECT doc_id, p, n, w[p:p + n - 1] AS g FROM p) p JOIN (SELECT DISTINCT item_id, g FROM x) x ON p.g = x.g),
hw AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM (SELECT DISTINCT doc_id, p, n FROM h)) GROUP BY doc_id),
hi AS (SELECT doc_id, list_sort(list(DISTINCT item_id::VARCHAR)) AS ids FROM h GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(len(ids), 0)::BIGINT AS n_items,
       sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hw ON d.doc_id = hw.doc_id LEFT JOIN hi ON d.doc_id = hi.doc_id
"""
