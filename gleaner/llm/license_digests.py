"""License scans by canonical digest, in DataFrame operations only.

A text is made canonical (case folded, copyright notices and all punctuation
dropped, equivalent spellings unified) and its SHA-256 is hash-joined to those
of known licence texts. Entire texts are compared; besides, every line of a
document is looked up, as licence statements often stand on a line of their
own.

A line is a copyright notice if it begins with ``copyright``, ``(c)`` or the
sign, unless the next word shows a wrapped line or a clause of a licence.
Holders named inside a text (BSD's last clause) make it another text.

Defined results: NULL and empty texts, and texts of copyright lines alone,
have no digest and match nothing; known licences with the same canonical text
are told by the least name; equal rows are judged alike; other columns are
ignored. The SQL twin knows ``KNOWN`` alone and drops every line that begins
like a notice, so the two agree on tables without whole licences or wrapped
copyright lines. The known texts are a parameter: a list is at most a few hundred
short texts, whose digests are literals of the plan.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from importlib import resources

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm.common import fill_null, read_table
from gleaner.session import literal_df

_GRANT_MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), "
    "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
    "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:\n"
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n"
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, "
    "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
    "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS "
    "IN THE SOFTWARE.")
_ISC = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
    "copyright notice and this permission notice appear in all copies.\n"
    "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF "
    "MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES "
    "WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
    "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.")
#: Fixed values: (name, text) of known licence texts and statements.
KNOWN = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("ISC", "ISC License\n" + _ISC),
    ("ISC", _ISC),
    ("MIT", "MIT License\n" + _GRANT_MIT),
    ("MIT", _GRANT_MIT),
    ("MIT", "Released under the MIT License."),
)
#: Entire texts under ``licenses/``: heading lines that may stand before them, and where their appendix begins.
_HEADS = {"BSD-2-Clause": ("BSD 2-Clause License", "The 2-Clause BSD License"), "BSD-3-Clause": ("BSD 3-Clause License", "The 3-Clause BSD License")}
_APPENDIX = ("APPENDIX: How to apply", "How to Apply These Terms")


def _whole_texts() -> Iterator[tuple[str, str]]:
    for file in sorted(resources.files("gleaner.llm").joinpath("licenses").iterdir(), key=lambda f: f.name):
        name, text = file.name.removesuffix(".txt"), file.read_text(encoding="utf-8")
        texts = [text]
        for mark in _APPENDIX:
            # the last mention is the heading
            if mark in text:
                texts.append(text[:text.rindex(mark)])
        if name in _HEADS:
            texts.append(re.sub(r"(?m)^[123]\. ", "* ", text))
            texts += [f"{head}\n{t}" for t in texts for head in _HEADS[name]]
        for t in texts:
            yield name, t


#: Fixed values: ``KNOWN`` and the entire texts of common licences.
EVERY = KNOWN + tuple(_whole_texts())
#: Spellings that count as equal, after punctuation is gone.
SPELLINGS = (
    ("licence", "license"), ("sub license", "sublicense"), ("non infringement", "noninfringement"), ("non commercial", "noncommercial"),
    ("copyright owner", "copyright holder"), ("organisation", "organization"), ("authorisation", "authorization"), ("recognise", "recognize"),
    ("favour", "favor"), ("per cent", "percent"), ("https", "http"), ("while", "whilst"),
)
_COPYRIGHT = r"(^|\n)[^a-z0-9\n]*(?:copyright|\(c\)|©)[^\n]*"  # of the SQL twin
#: Words that follow "copyright", or the mark of a clause (c), in the body of a licence.
_BODY_WORDS = (
    "act|also|and|as|are|assignments?|at|claims?|disclaimers?|doctrines?|does|exceptions?|for|grants?|has|have|holders?|if|in|interests?|is|it|laws?|licen[cs]es?|like|limitations?|lines?|may|notices?|of|on|"
    "or|ownership|owners?|patents?|permission|protection|resulting|rights?|shall|statements?|status|that|the[^\\p{L}\\p{N}\\n]+(?:library|software)|those|to|trademarks?|treaty|under|which|without")
_CLAUSE_WORDS = "any|each|for|if|in|such|that|this|to|under|when|where|you"
_NOTICE = (
    rf"(^|\n)[^a-z0-9\n]*(?:copyright(?!\p{{L}})(?![^\p{{L}}\p{{N}}\n]*(?:{_BODY_WORDS})(?![\p{{L}}\p{{N}}]))"
    rf"|\(c\)(?![^\p{{L}}\p{{N}}\n]*(?:{_CLAUSE_WORDS})(?![\p{{L}}\p{{N}}]))|©)[^\n]*")
_GAP = r"[^\p{L}\p{N}]+"


def canonical(text: Column) -> Column:
    x = F.lower(fill_null(text))
    x = F.when(x.contains("copyright") | x.contains("(c)") | x.contains("©"), F.regexp_replace(x, _NOTICE, "\n")).otherwise(x)
    x = F.regexp_replace(x, _GAP, " ")
    for old, new in SPELLINGS:
        x = F.replace(x, F.lit(old), F.lit(new))
    return F.trim(x)


def canonical_sql(text: str) -> str:
    """``canonical`` in DuckDB's SQL, with any line that begins like a notice."""
    x = f"regexp_replace(lower(coalesce({text}, '')), '{_COPYRIGHT}', chr(10), 'g')"
    x = f"regexp_replace({x}, '{_GAP}', ' ', 'g')"
    for old, new in SPELLINGS:
        x = f"replace({x}, '{old}', '{new}')"
    return f"trim({x})"


def digest(text: Column) -> Column:
    """SHA-256 of the canonical text, NULL if nothing is left of it."""
    c = canonical(text)
    return F.when(c != "", F.sha2(c, 256))


def scan_licenses(docs: DataFrame, known: Sequence[tuple[str, str]] = EVERY, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, digest, license (of the entire text), line_licenses (names of
    licences that lines state, sorted, comma-joined), one row per input row."""
    names = literal_df(docs.sparkSession, list(known), "license string, text string")
    names = names.select("license", digest(F.col("text")).alias("known")).filter("known is not null").groupBy("known").agg(F.min("license").alias("license"))
    by_digest = {r["known"]: r["license"] for r in names.collect()}  # as long as the list
    x = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), digest(F.col(text)).alias("digest"))
    lines = F.filter(F.split(fill_null(F.col("text")), "\n"), lambda v: v.rlike(r"[\p{L}\p{N}]"))
    found = F.filter(F.transform(lines, digest), lambda d: d.isin(list(by_digest)))
    table = literal_df(docs.sparkSession, sorted(by_digest.items()), "known string, name string")
    x = x.select("doc_id", "digest", found.alias("found"))
    stated = F.array_sort(F.array_distinct(F.flatten(F.array(*[
        F.when(F.array_contains("found", d), F.array(F.lit(n))).otherwise(F.array().cast("array<string>")) for d, n in sorted(by_digest.items())])))) if by_digest else F.array().cast("array<string>")
    return x.join(F.broadcast(table), F.col("digest") == F.col("known"), "left").select(
        "doc_id", "digest", F.col("name").alias("license"), F.array_join(stated, ",").alias("line_licenses"))


def op9_canonical_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest, licence and stated licences of every document."""
    return scan_licenses(read_table(spark, sf_dir, "documents"))


def _quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


OP9_SQL = f"""
WITH k AS (SELECT sha256({canonical_sql('t')}) AS known, min(n) AS license
           FROM (VALUES {', '.join(f'({_quoted(n)}, {_quoted(t)})' for n, t in KNOWN)}) AS v(n, t) GROUP BY 1),
d AS (SELECT doc_id, coalesce(text, '') AS text, {canonical_sql('text')} AS c FROM documents),
l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d),
m AS (SELECT l.doc_id, string_agg(DISTINCT k.license, ',' ORDER BY k.license) AS line_licenses
      FROM l JOIN k ON sha256({canonical_sql('l.line')}) = k.known GROUP BY l.doc_id)
SELECT d.doc_id, CASE WHEN c <> '' THEN sha256(c) END AS digest, k.license, coalesce(m.line_licenses, '') AS line_licenses
FROM d LEFT JOIN k ON sha256(c) = k.known LEFT JOIN m ON d.doc_id = m.doc_id
"""
