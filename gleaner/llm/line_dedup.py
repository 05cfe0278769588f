"""Removal of lines that many documents share.

1. Lines are exploded with their positions; a line's key is the line without
   space and U+0009..U+000D at both ends, A-Z folded. Keys are compared by two
   64-bit hashes (128 bits together).
2. Distinct (key, document) pairs are formed first, which spreads a key that a
   third of all documents hold over all tasks, then counted by key.
3. Keys of ``min_docs`` documents or more are looked up again from the lines.
   The at most ``HOT_KEYS`` most frequent of them (every key that holds at
   least a HOT_KEYS-th part of all counted pairs) are broadcast; all others go
   through a shuffle join, where no key is hot any more.
4. A document's dropped positions are collected, and its other lines joined
   again in the order of their positions.

Defined results: NULL text counts as one empty line and stays NULL in
``drop_common_lines``; an empty key is never dropped while ``min_chars`` is at
least 1; rows that share a ``doc_id`` are one document when documents are
counted, and each row keeps its own lines; rows with a NULL ``doc_id`` are one
document per distinct text; an empty table gives an empty result; a lone CR is
part of its line; other columns are kept or ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm.common import fill_null, lower_ascii, private_names, read_table, write_out

MIN_CHARS = 1
MIN_DOCS = 10
HOT_KEYS = 100_000
_ENDS = " \t\n\u000b\f\r"


def line_key(line: Column) -> Column:
    """The line stripped at both ends, A-Z folded."""
    bare = F.trim(line, F.lit(_ENDS))
    # lower() folds more than A-Z, but not in ASCII text, where it is faster
    return F.when(F.octet_length(bare) == F.length(bare), F.lower(bare)).otherwise(lower_ascii(bare))


def _hashed_lines(docs: DataFrame, doc_id: str, text: str, min_chars: int) -> DataFrame:
    """(doc, tag, pos, h1, h2) of every line with a key of ``min_chars``."""
    rows = docs.select(F.col(doc_id).alias("doc"), F.xxhash64(F.col(text).isNull(), text).alias("tag"), F.split(fill_null(F.col(text)), "\n").alias("lines"))
    each = rows.select("doc", "tag", F.posexplode("lines").alias("pos", "line")).select("doc", "tag", "pos", line_key(F.col("line")).alias("key"))
    return each.filter(F.length("key") >= min_chars).select(
        "doc", "tag", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))


def common_keys(lines: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(h1, h2, n_docs) of the keys that at least ``min_docs`` documents hold."""
    own = F.when(F.col("doc").isNull(), F.col("tag")).otherwise(F.lit(0))
    pairs = lines.select("h1", "h2", "doc", own.alias("own")).distinct()
    return pairs.groupBy("h1", "h2").agg(F.count("*").alias("n_docs")).filter(F.col("n_docs") >= min_docs)


def _common_positions(lines: DataFrame, common: DataFrame, min_docs: int, hot_keys: int) -> DataFrame:
    """(doc, tag, gone): the positions of common lines, a row per text."""
    pairs = common.agg(F.sum("n_docs")).first()[0] or 0
    hot = max(min_docs, -(-pairs // hot_keys))  # at most hot_keys keys have so many documents
    found = lines.join(F.broadcast(common.filter(F.col("n_docs") >= hot).select("h1", "h2")), ["h1", "h2"])
    if hot > min_docs:
        found = found.unionByName(lines.join(common.filter(F.col("n_docs") < hot).select("h1", "h2"), ["h1", "h2"]))
    return found.groupBy("doc", "tag").agg(F.collect_set("pos").alias("gone"))


def _judged(docs: DataFrame, doc_id: str, text: str, min_chars: int, min_docs: int, hot_keys: int) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with private columns n_lines, n_dropped and rest (the joined
    lines that stay), and the names of these."""
    n = private_names(docs.columns, ["n_lines", "n_dropped", "rest", "doc", "tag", "gone", "lines", "own"])
    lines = _hashed_lines(docs, doc_id, text, min_chars)
    common = write_out(common_keys(lines, min_docs))
    gone = _common_positions(lines, common, min_docs, hot_keys).select(*[F.col(c).alias(n[c]) for c in ("doc", "tag", "gone")])
    own = docs.withColumns({n["own"]: F.xxhash64(F.col(text).isNull(), F.col(text)), n["lines"]: F.split(fill_null(F.col(text)), "\n")})
    joined = own.join(gone, own[doc_id].eqNullSafe(gone[n["doc"]]) & (own[n["own"]] == gone[n["tag"]]), "left")
    lines_of, gone_of = F.col(n["lines"]), F.coalesce(F.col(n["gone"]), F.array().cast("array<int>"))
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines_of) - 1), gone_of)
    rest = F.when(F.col(n["gone"]).isNull(), F.col(text)).otherwise(F.array_join(F.transform(stay, lambda i: lines_of[i]), "\n"))
    return joined.withColumns({n["n_lines"]: F.size(lines_of).cast("long"), n["n_dropped"]: F.size(gone_of).cast("long"), n["rest"]: rest}), n


def drop_common_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS,
                      min_docs: int = MIN_DOCS, hot_keys: int = HOT_KEYS) -> DataFrame:
    """``docs`` without the lines whose keys at least ``min_docs`` documents hold."""
    out, n = _judged(docs, doc_id, text, min_chars, min_docs, hot_keys)
    return out.withColumn(text, F.col(n["rest"])).select(docs.columns)


def line_report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS,
                min_docs: int = MIN_DOCS, hot_keys: int = HOT_KEYS) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256; a row per input row."""
    out, n = _judged(docs.select(doc_id, text), doc_id, text, min_chars, min_docs, hot_keys)
    return out.select(F.col(doc_id).alias("doc_id"), F.col(n["n_lines"]).alias("n_lines"), F.col(n["n_dropped"]).alias("n_dropped"),
                      F.sha2(fill_null(F.col(n["rest"])), 256).alias("kept_sha256"))


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines dropped from every document and the digest of what stays."""
    return line_report(read_table(spark, sf_dir, "documents"))


OP13_SQL = """
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
c AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
j AS (SELECT k.*, c.key IS NOT NULL AS gone FROM k LEFT JOIN c ON c.key = k.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""
