"""Personal data by candidate gradient boosting.

Generators of high recall propose spans, which may overlap; boosted trees rate
each by its format and its surroundings; a span is redacted when its rating is
at or above its kind's threshold. Spans of the fixed patterns always stay.

The trees learn from spans of the fixed patterns, as they stand and once more
in a disguise that the patterns do not match (``name (at) host (dot) com``, a
phone without plus, other separators), each in its own surroundings; other
proposals that touch no such span are the counter-examples. The fit takes about
``SAMPLE`` candidates of each kind and class, by a hash over all documents. All
candidates of the corpus are rated, and a kind's threshold is the least rating
(in BINS steps) from which at least ``PRECISION`` of the disguised spans and of
the unconfirmed proposals together are disguised spans; so every proposal that
would be added counts as an error. Without disguised spans of a kind nothing of
that kind is added.

Defined results: NULL text is empty and holds nothing; without candidates of
both classes nothing is added; rows that share an id are judged by their own
text, equal rows alike; NULL ids are kept; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm.common import private_names, read_table, write_out
from gleaner.llm.pii_spans import FEATURES, KINDS, base_spans, candidates, disguised_candidates

SAMPLE = 4_000
PRECISION = 0.9
BINS = 500
LEAST = 20  # candidates in a leaf, so that a few look-alikes among the counter-examples get no leaf of their own
_PLAIN, _BASE, _DISGUISED = 0, 1, 2

_SPAN = "struct<start:int,kind:int,end:int>"
_FOUND = pa.schema([
    ("doc_id", pa.int64()), ("tag", pa.int64()),
    ("base", pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))),
    ("proposed", pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("label", pa.int32()), ("touches", pa.bool_()), ("x", pa.list_(pa.float64()))]))),
])
_FOUND_DDL = f"doc_id long, tag long, base array<{_SPAN}>, proposed array<struct<kind:int,start:int,end:int,label:int,touches:boolean,x:array<double>>>"


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for doc, tag, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            t = text.as_py() or ""
            base = base_spans(t)
            rows.append({"doc_id": doc, "tag": tag, "base": [{"start": a, "kind": k, "end": b} for a, k, b in base],
                         "proposed": [{"kind": k, "start": a, "end": b, "label": y, "touches": o, "x": x} for k, a, b, y, o, x in candidates(t, base)]
                         + [{"kind": k, "start": a, "end": b, "label": _DISGUISED, "touches": False, "x": x} for k, a, b, x in disguised_candidates(t, base)]})
        yield pa.RecordBatch.from_pylist(rows, schema=_FOUND)


def _rated(found: DataFrame, sample: int, precision: float) -> DataFrame:
    """(doc_id, tag, span) of the added spans."""
    each = found.filter(F.size("proposed") > 0).select("doc_id", "tag", F.explode("proposed").alias("p")).select("doc_id", "tag", "p.*")
    each = each.select("*", *[F.col("x")[k].alias(f"f_{name}") for k, name in enumerate(FEATURES)])
    features = [f"f_{name}" for name in FEATURES]
    each = each.filter((F.col("label") != _PLAIN) | ~F.col("touches"))
    none = found.filter("false").select("doc_id", "tag", F.lit(None).cast(_SPAN).alias("span"))
    sizes = {(r["kind"], r["label"]): r["count"] for r in each.groupBy("kind", "label").count().collect()}
    if not any(y == _DISGUISED for _k, y in sizes) or not any(y == _PLAIN for _k, y in sizes):
        return none
    share = F.lit(0.0)
    for (kind, label), n in sizes.items():
        share = F.when((F.col("kind") == kind) & (F.col("label") == label), F.lit(min(1.0, sample / n))).otherwise(share)
    at = F.pmod(F.xxhash64("doc_id", "tag", "start", "end", "kind", "label"), F.lit(1 << 20)) / (1 << 20)
    vectors = VectorAssembler(inputCols=features, outputCol="features")
    taken = write_out(vectors.transform(each.filter(at < share).withColumn("y", (F.col("label") != _PLAIN).cast("int"))).select("y", "features"))
    trees = GBTClassifier(featuresCol="features", labelCol="y", maxIter=10, maxDepth=3, stepSize=0.3, minInstancesPerNode=LEAST, seed=17).fit(taken.coalesce(2))
    rated = trees.transform(vectors.transform(each.filter(F.col("label") != _BASE))).withColumn("bin", F.floor(vector_to_array("probability")[1] * BINS).cast("int"))
    rated = write_out(rated.select("doc_id", "tag", "kind", "start", "end", "label", "bin"))

    # 4 kinds x BINS rows at most
    counts = rated.groupBy("kind", "bin").agg(F.count_if(F.col("label") == _DISGUISED).alias("right"), F.count_if(F.col("label") == _PLAIN).alias("wrong")).toPandas()
    limit = F.lit(BINS + 1)
    for kind, rows in counts.groupby("kind"):
        rows = rows.sort_values("bin", ascending=False)
        right, wrong = rows["right"].cumsum(), rows["wrong"].cumsum()
        good = rows[(right > 0) & (right >= precision * (right + wrong))]
        if len(good):
            limit = F.when(F.col("kind") == int(kind), F.lit(int(good["bin"].min()))).otherwise(limit)
    return rated.filter((F.col("label") == _PLAIN) & (F.col("bin") >= limit)).select("doc_id", "tag", F.struct("start", "kind", "end").alias("span"))


def find_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", sample: int = SAMPLE, precision: float = PRECISION) -> DataFrame:
    """(doc_id, tag, base, spans), a row per input row: the fixed patterns'
    spans and all spans, as sorted arrays of struct(start, kind, end); ``tag``
    tells texts of one id apart."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(F.col(text).isNull(), text).alias("tag"), F.col(text).alias("text"))
    found = write_out(rows.mapInArrow(_find, _FOUND_DDL))
    added = _rated(found, sample, precision).groupBy(F.col("doc_id").alias("d"), F.col("tag").alias("g")).agg(F.collect_set("span").alias("added"))
    joined = found.join(added, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("tag") == F.col("g")), "left")
    every = F.array_sort(F.array_union("base", F.coalesce("added", F.array().cast(f"array<{_SPAN}>"))))
    return joined.select("doc_id", "tag", "base", every.alias("spans"))


def span_text(spans: Column | str) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _cut(text: str, spans) -> str:
    out, last, kind = [], 0, None
    for span in spans:
        start, k, end = span["start"], span["kind"], span["end"]
        if kind is not None and start < last:  # overlapping spans become one
            last = max(last, end)
            continue
        if kind is not None:
            out.append(f"[{KINDS[kind].upper()}]")
        out.append(text[last:start])
        last, kind = end, k
    if kind is not None:
        out.append(f"[{KINDS[kind].upper()}]")
    out.append(text[last:])
    return "".join(out)


def redact(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **params) -> DataFrame:
    """``docs`` with every span of its texts replaced by its kind in brackets.
    All columns keep their names; a column ``n_chars`` is not touched."""
    n = private_names(docs.columns, ["r_doc", "r_tag", "r_spans"])
    spans = find_spans(docs, doc_id, text, **params).filter(F.size("spans") > 0).select(
        F.col("doc_id").alias(n["r_doc"]), F.col("tag").alias(n["r_tag"]), F.col("spans").alias(n["r_spans"])).dropDuplicates([n["r_doc"], n["r_tag"]])

    @F.pandas_udf("string")
    def replaced(texts: pd.Series, found: pd.Series) -> pd.Series:
        return pd.Series([t if s is None or t is None else _cut(t, s) for t, s in zip(texts, found)], dtype=object)

    same = docs[doc_id].cast("long").eqNullSafe(F.col(n["r_doc"])) & (F.xxhash64(docs[text].isNull(), docs[text]) == F.col(n["r_tag"]))
    joined = docs.join(spans, same, "left")
    return joined.withColumn(text, replaced(F.col(text), F.col(n["r_spans"]))).select(docs.columns)


def op5_candidate_boosting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, digest and spans of the personal data in every document."""
    spans = find_spans(read_table(spark, sf_dir, "documents").select("doc_id", "text"))

    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    counts = [count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return spans.select("doc_id", *counts, F.sha2(span_text(F.col("base")), 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans"))
