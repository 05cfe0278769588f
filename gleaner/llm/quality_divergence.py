"""Quality rules by distribution divergence, in DataFrame expressions only.

Every text gets a character-class histogram (lower-case letters, upper-case
letters, digits, gaps, ASCII punctuation, everything else) and a histogram of
the common words of each language below. References are the summed histograms
of all documents of a language that pass the base rules. A document is
compared, by Jensen-Shannon distance (square root of the divergence in bits,
0..1), with the nearest reference of each kind; it is dropped when the text is
long enough for the histogram to mean something and the distance is above the
limit. Texts shorter than a guard are never dropped by that histogram.

Base rules come first: fewer than ``min_words`` words, or more than
``max_repeat_pct`` percent of the words in 8-word windows that occur twice.

Defined results: a NULL or empty text has no words and fails the base rules;
rows with NULL or unknown ``lang`` add to no reference and are compared with
all of them; if no reference exists, only the base rules decide; equal rows
are judged alike and all stay. Windows are compared by 64-bit hashes within
one text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm.common import fill_null, private_names, read_table, split_words, write_out

#: Frequent function words of each reference language.
COMMON_WORDS = {
    "en": ("the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "was", "on", "are", "as", "with", "he", "be", "at", "by", "this", "from", "or", "an", "have", "not"),
    "fr": ("de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est", "pour", "qui", "dans", "a", "par", "plus", "pas", "au", "sur", "ne", "se", "ce", "il"),
    "de": ("der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "für", "ist", "im", "dem", "nicht", "ein", "eine", "als", "auch", "es", "an", "er", "so"),
    "es": ("de", "la", "que", "el", "en", "y", "a", "los", "se", "del", "las", "un", "por", "con", "no", "una", "su", "para", "es", "al", "lo", "como", "o", "este", "más"),
}
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PCT = 30
#: Guards and limits of the divergence rules.
MIN_CHARS = 200
MIN_HISTOGRAM_WORDS = 50
MAX_CHAR_DISTANCE = 0.28
MAX_WORD_DISTANCE = 0.47

_CLASSES = ("lower", "upper", "digit", "gap", "punctuation", "other")


def _left(text: Column, drop: str) -> Column:
    """Number of characters of a text outside the class ``drop``."""
    return F.length(F.regexp_replace(text, drop, ""))


def _xlog(p: Column, q: Column) -> Column:
    """p * log2(p / ((p + q) / 2)), 0 where p is 0."""
    return F.when(p > 0, p * F.log2(2 * p / (p + q))).otherwise(0.0)


def _distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two arrays of shares."""
    parts = F.zip_with(p, q, lambda a, b: (_xlog(a, b) + _xlog(b, a)) / 2)
    return F.sqrt(F.greatest(F.aggregate(parts, F.lit(0.0), lambda s, x: s + x), F.lit(0.0)))


def _shares(counts: Column) -> Column:
    total = F.aggregate(counts, F.lit(0.0), lambda s, x: s + x)
    return F.transform(counts, lambda x: F.when(total > 0, x / total).otherwise(0.0))


def text_measures(docs: DataFrame, text: str, names: dict[str, str], common: list[str]) -> DataFrame:
    """``docs`` with the base counts and both histograms in helper columns."""
    n = names
    t = fill_null(F.col(text))
    x = docs.withColumns({n["words"]: split_words(F.col(text)), n["lines"]: F.filter(F.split(t, "\n"), lambda v: v.rlike(r"[^\x20\x09-\x0D]"))})
    words = F.col(n["words"])
    x = x.withColumns({
        n["n_words"]: F.size(words).cast("long"),
        n["word_chars"]: _left(t, r"[\x20\x09-\x0D]+").cast("long"),
        n["n_symbols"]: F.length(F.regexp_replace(t, r"[^#*$%&|<>]+", "")).cast("long"),
        n["n_dup_lines"]: (F.size(n["lines"]) - F.size(F.array_distinct(n["lines"]))).cast("long"),
        n["windows"]: F.when(F.size(words) >= WINDOW, F.transform(
            F.sequence(F.lit(1), F.size(words) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(words, i, WINDOW)))).otherwise(F.array().cast("array<bigint>")),
        n["hits"]: F.filter(F.transform(words, F.lower), lambda w: w.isin(common)),
        n["chars"]: F.array(*[c.cast("double") for c in (
            F.length(F.regexp_replace(t, r"[^\p{Ll}]+", "")), F.length(F.regexp_replace(t, r"[^\p{Lu}]+", "")),
            F.length(F.regexp_replace(t, r"[^0-9]+", "")), F.length(F.regexp_replace(t, r"[^!-/:-@\[-`{-~]+", "")))]),
        n["n_chars"]: F.length(t).cast("long"),
    }).drop(n["lines"])
    w = F.col(n["windows"])
    # most texts repeat no window: only the others are sorted
    ordered = F.array_sort(F.transform(w, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    x = x.withColumn(n["order"], F.when(F.size(F.array_distinct(w)) < F.size(w), ordered))
    o = F.col(n["order"])
    size = F.size(o)
    again = F.filter(F.sequence(F.lit(1), size), lambda k: (
        ((k > 1) & (F.element_at(o, F.greatest(k - 1, F.lit(1)))["h"] == F.element_at(o, k)["h"]))
        | ((k < size) & (F.element_at(o, F.least(k + 1, size))["h"] == F.element_at(o, k)["h"]))))
    x = x.withColumn(n["order"], F.when(o.isNotNull(), F.array_sort(F.transform(again, lambda k: F.element_at(o, k)["i"]))))
    o = F.col(n["order"])
    size = F.size(o)
    covered = F.aggregate(F.transform(o, lambda p, k: F.when(k + 1 < size, F.least(F.lit(WINDOW), F.element_at(o, F.least(k + 2, size)) - p)).otherwise(F.lit(WINDOW))),
                          F.lit(0), lambda s, v: s + v)
    hits, chars = F.col(n["hits"]), F.col(n["chars"])
    seen = F.array_distinct(hits)
    x = x.withColumns({
        n["n_repeat_words"]: F.coalesce(F.when(o.isNotNull(), covered), F.lit(0)).cast("long"),
        # sparse: (word, count) of the common words that occur
        n["word_counts"]: F.transform(seen, lambda v: F.struct(v.alias("w"), (F.size(hits) - F.size(F.array_remove(hits, v))).cast("double").alias("c"))),
        n["n_hits"]: F.size(hits).cast("long"),
        n["classes"]: F.array(chars[0], chars[1], chars[2], (F.col(n["n_chars"]) - F.col(n["word_chars"])).cast("double"), chars[3],
                              (F.col(n["word_chars"]) - chars[0] - chars[1] - chars[2] - chars[3]).cast("double")),
    })
    return x.drop(n["words"], n["windows"], n["order"], n["hits"], n["chars"], n["n_chars"])


def judge(docs: DataFrame, text: str = "text", lang: str = "lang", common_words: dict[str, tuple[str, ...]] = COMMON_WORDS,
          min_words: int = MIN_WORDS, max_repeat_pct: int = MAX_REPEAT_PCT, min_chars: int = MIN_CHARS,
          min_histogram_words: int = MIN_HISTOGRAM_WORDS, max_char_distance: float = MAX_CHAR_DISTANCE,
          max_word_distance: float = MAX_WORD_DISTANCE, keep_text: bool = False) -> DataFrame:
    """The rows of ``docs`` (all columns but the text, unless ``keep_text``)
    with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, char_distance, word_distance, kept. A result name that the
    input has already gets a leading underscore."""
    bins = sorted({w for ws in common_words.values() for w in ws})
    results = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "char_distance", "word_distance", "kept"]
    n = private_names(docs.columns, results + ["words", "lines", "windows", "hits", "chars", "order", "n_chars", "word_counts", "n_hits", "classes"])
    x = text_measures(docs, text, n, bins)
    failed = (F.col(n["n_words"]) < min_words) | (100 * F.col(n["n_repeat_words"]) > max_repeat_pct * F.col(n["n_words"]))
    x = write_out(x.withColumn(n["base_failed"], failed) if keep_text else x.withColumn(n["base_failed"], failed).drop(text))

    # references: one row per language of the parameter, a few dozen numbers each
    good = x.filter(~F.col(n["base_failed"]) & F.col(lang).isin(list(common_words)))
    classes = [F.sum(F.col(n["classes"])[i]).alias(f"c{i}") for i in range(len(_CLASSES))]
    by_class = {r[0]: [float(v or 0) for v in r[1:-1]] + [float(r[-1] or 0)] for r in good.groupBy(lang).agg(*classes, F.sum(n["n_words"])).collect()}
    by_word: dict[str, dict[str, float]] = {k: {} for k in by_class}
    counted = good.select(F.col(lang).alias("l"), F.explode(n["word_counts"]).alias("x")).groupBy("l", "x.w").agg(F.sum("x.c"))
    for name, word, count in counted.collect():  # at most languages x common words
        by_word[name][word] = float(count)

    def shares(values: list[float]) -> list[float]:
        total = sum(values)
        return [v / total for v in values] if total else values

    own = _shares(F.col(n["classes"]))
    char_d, word_d = [], []
    for name in sorted(by_class):
        *counts, n_words = by_class[name]
        if not n_words:
            continue
        char_d.append(_distance(own, F.array(*[F.lit(v) for v in shares(counts)])))
        q = {w: by_word[name].get(w, 0.0) / n_words for w in bins}
        rest = 1.0 - sum(q.values())
        ref = F.create_map(*[v for w in bins if q[w] for v in (F.lit(w), F.lit(q[w]))]) if any(q.values()) else None
        total = F.col(n["n_words"]).cast("double")
        # words the text has; those it lacks add half of their reference share each
        have = F.transform(F.col(n["word_counts"]), lambda v: F.struct(
            (v["c"] / total).alias("p"), (F.coalesce(F.element_at(ref, v["w"]), F.lit(0.0)) if ref is not None else F.lit(0.0)).alias("q")))
        p_rest = (total - F.col(n["n_hits"])) / total
        q_rest = F.lit(max(rest, 0.0))
        both = F.aggregate(have, F.struct(F.lit(0.0).alias("d"), F.lit(0.0).alias("q")), lambda s, v: F.struct(
            (s["d"] + (_xlog(v["p"], v["q"]) + _xlog(v["q"], v["p"])) / 2).alias("d"), (s["q"] + v["q"]).alias("q")))
        lacking = F.lit(sum(q.values())) - both["q"]
        js = both["d"] + lacking / 2 + (_xlog(p_rest, q_rest) + _xlog(q_rest, p_rest)) / 2
        word_d.append(F.when(total > 0, F.sqrt(F.least(F.greatest(js, F.lit(0.0)), F.lit(1.0)))))

    def nearest(ds: list[Column]) -> Column:
        return (F.least(*ds) if len(ds) > 1 else ds[0]) if ds else F.lit(None).cast("double")

    x = x.withColumns({n["char_distance"]: nearest(char_d), n["word_distance"]: nearest(word_d)})
    length = F.aggregate(F.col(n["classes"]), F.lit(0.0), lambda s, v: s + v)
    odd_chars = (length >= min_chars) & (F.col(n["char_distance"]) > max_char_distance)
    odd_words = (F.col(n["n_words"]) >= min_histogram_words) & (F.col(n["word_distance"]) > max_word_distance)
    verdict = ~F.col(n["base_failed"]) & ~F.coalesce(odd_chars, F.lit(False)) & ~F.coalesce(odd_words, F.lit(False))
    return x.withColumn(n["kept"], verdict).drop(n["word_counts"], n["n_hits"], n["classes"])


def keep_good(docs: DataFrame, **params) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their own columns."""
    judged = judge(docs, keep_text=True, **params)
    kept = [c for c in judged.columns if c not in docs.columns and c.endswith("kept")][0]
    return judged.filter(F.col(kept)).select(docs.columns)


def op1_quality_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and verdict of every document."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return judge(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
                              F.round("char_distance", 6).alias("char_distance"), F.round("word_distance", 6).alias("word_distance"))


def _common_sql() -> str:
    """All common words as rows of a VALUES list."""
    return ", ".join(f"('{w}')" for w in sorted({w for ws in COMMON_WORDS.values() for w in ws}))


_XLOG = "CASE WHEN {p} > 0 THEN {p} * log2(2 * {p} / ({p} + {q})) ELSE 0 END"


def _js_sql(p: str, q: str) -> str:
    return f"sqrt(greatest(sum(({_XLOG.format(p=p, q=q)}) + ({_XLOG.format(p=q, q=p)})) / 2, 0))"


OP1_SQL = rf"""
WITH d AS (
  SELECT doc_id, lang, coalesce(text, '') AS t, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM documents),
win AS (SELECT doc_id, p, md5(array_to_string(w[p:p + 7], ' ')) AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS p FROM d WHERE len(w) >= 8)),
rep AS (SELECT doc_id, count(DISTINCT i) AS n FROM (
          SELECT doc_id, unnest(range(p, p + 8)) AS i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win) WHERE c > 1) GROUP BY doc_id),
c AS (
  SELECT d.doc_id, lang, w, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
         coalesce(rep.n, 0)::BIGINT AS n_repeat_words, length(t) AS n_chars, length(regexp_replace(t, '[^\p{{Ll}}]+', '', 'g')) AS c0,
         length(regexp_replace(t, '[^\p{{Lu}}]+', '', 'g')) AS c1, length(regexp_replace(t, '[^0-9]+', '', 'g')) AS c2,
         length(regexp_replace(t, '[^!-/:-@\[-`{{-~]+', '', 'g')) AS c4
  FROM d LEFT JOIN rep ON rep.doc_id = d.doc_id),
b AS MATERIALIZED (
  SELECT *, n_chars - word_chars AS c3, word_chars - c0 - c1 - c2 - c4 AS c5,
         n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PCT} * n_words AS base_failed FROM c),
k AS (SELECT doc_id, i, v FROM (SELECT doc_id, [c0, c1, c2, c3, c4, c5] AS vs, unnest(range(1, 7)) AS i, vs[i]::DOUBLE AS v FROM b)),
p AS (SELECT doc_id, i, CASE WHEN sum(v) OVER (PARTITION BY doc_id) > 0 THEN v / sum(v) OVER (PARTITION BY doc_id) ELSE 0 END AS p FROM k),
good AS (SELECT doc_id, lang, n_words FROM b WHERE NOT base_failed AND lang IN ({', '.join(f"'{x}'" for x in COMMON_WORDS)})),
q AS (SELECT lang, i, v / sum(v) OVER (PARTITION BY lang) AS q FROM (SELECT lang, i, sum(v) AS v FROM k JOIN good ON good.doc_id = k.doc_id GROUP BY lang, i)),
cd AS (SELECT doc_id, min(js) AS char_distance FROM (SELECT p.doc_id, q.lang, {_js_sql('p.p', 'q.q')} AS js FROM p JOIN q ON q.i = p.i GROUP BY p.doc_id, q.lang) GROUP BY doc_id),
common(word) AS (VALUES {_common_sql()}),
h AS (SELECT doc_id, x AS word, count(*) AS n FROM (SELECT doc_id, lower(unnest(w)) AS x FROM b) WHERE x IN (SELECT word FROM common) GROUP BY doc_id, x),
wq AS (SELECT lang, word, sum(n) / any_value(total) AS q FROM (SELECT good.lang, h.word, h.n, total FROM h JOIN good ON good.doc_id = h.doc_id
         JOIN (SELECT lang, sum(n_words)::DOUBLE AS total FROM good GROUP BY lang) g ON g.lang = good.lang) GROUP BY lang, word),
langs AS (SELECT lang FROM good GROUP BY lang HAVING sum(n_words) > 0),
wp AS (SELECT b.doc_id, langs.lang, common.word, coalesce(h.n, 0) / n_words::DOUBLE AS p, coalesce(wq.q, 0) AS q
       FROM b CROSS JOIN langs CROSS JOIN common LEFT JOIN h ON h.doc_id = b.doc_id AND h.word = common.word
       LEFT JOIN wq ON wq.lang = langs.lang AND wq.word = common.word WHERE n_words > 0),
wa AS (SELECT * FROM wp UNION ALL SELECT doc_id, lang, NULL, greatest(1 - sum(p), 0), greatest(1 - sum(q), 0) FROM wp GROUP BY doc_id, lang),
wd AS (SELECT doc_id, min(js) AS word_distance FROM (SELECT doc_id, lang, {_js_sql('p', 'q')} AS js FROM wa GROUP BY doc_id, lang) GROUP BY doc_id)
SELECT b.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT coalesce(n_chars >= {MIN_CHARS} AND char_distance > {MAX_CHAR_DISTANCE}, false)
         AND NOT coalesce(n_words >= {MIN_HISTOGRAM_WORDS} AND word_distance > {MAX_WORD_DISTANCE}, false) AS kept,
       round(char_distance, 6) AS char_distance, round(word_distance, 6) AS word_distance
FROM b LEFT JOIN cd ON cd.doc_id = b.doc_id LEFT JOIN wd ON wd.doc_id = b.doc_id
"""
