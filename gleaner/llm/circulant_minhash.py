"""Near-duplicates by circulant MinHash.

A document's set is its distinct hashes of ``shingle`` consecutive words. One
permutation (a mixing of the hash) places each element in a universe of
``UNIVERSE`` slots; a second permutation, a table, is shifted circularly by k
for the k-th signature coordinate, so the coordinates of one element are a
contiguous slice of the table and a signature is the element-wise minimum of
slices. ``BANDS`` bands of ``ROWS`` coordinates name candidates: a pair at
similarity 0.8 shares no band with probability (1 - 0.8**6)**40 = 5e-6.

Documents with equal sets form a class, found by an aggregation; only class
representatives (least ids) go on. First, in every band bucket that holds
several components, one member of the smallest component is the centre and is
compared exactly, on full sets, with the members of the other components;
confirmed links join components. After ``STAR_ROUNDS`` such rounds few buckets
hold two components. Their members are dealt to blocks of about ``BLOCK``, and
each pair of blocks is a task's group: one matrix product gives all
intersections there, and a spanning forest of the links is kept. So every pair
that shares a bucket and is not yet connected is compared, a large bucket is
spread over many tasks, and no list of all pairs is ever made. (A group of g
documents that share a bucket without being linked costs g * g / BLOCK copies of
a set; that is the price of losing no link.)

Defined results: a text without words, or NULL, has an empty set and is linked
with nothing; a text with fewer words than a shingle has its whole word
sequence as one element; rows that share an id count as one document (ids are
expected to be unique; of differing texts one is compared); NULL ids are left
alone, linked with nothing; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm.bytescan import U64, chunks, mix, shingle_sets, text_bytes, word_hashes, words
from gleaner.llm.common import broadcast_if_few, private_names, read_table, write_out
from gleaner.llm.components import connected_components

BANDS = 40
ROWS = 6
UNIVERSE = 1 << 18
STAR_ROUNDS = 2
BLOCK = 512
SETS = 2_000  # documents for which a stored table of sets, or of links found on them, gets a part
_SLICES = 4096  # elements whose slices are held at a time
_COLUMNS = 4096  # distinct elements of a matrix product

_SKETCH = "doc_id long, n_shingles long, h1 long, h2 long, bands array<long>"


def _table() -> np.ndarray:
    """The second permutation, long enough to be read at every shift."""
    order = np.random.default_rng(7).permutation(UNIVERSE).astype(np.uint32)
    return np.concatenate([order, order[:BANDS * ROWS]])


def signature(elements: np.ndarray, slices: np.ndarray) -> np.ndarray:
    """All coordinates of one set (not empty)."""
    at = (mix(elements ^ U64(0x5851F42D4C957F2D)) >> U64(64 - 18)).astype(np.int64)
    low = slices[at[:_SLICES]].min(axis=0)
    for k in range(_SLICES, len(at), _SLICES):
        np.minimum(low, slices[at[k:k + _SLICES]].min(axis=0), out=low)
    return low


def _sketcher(shingle: int):
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices = np.lib.stride_tricks.sliding_window_view(_table(), BANDS * ROWS)
        band_no = np.arange(BANDS, dtype=np.uint64)
        for batch in batches:
            raw, offsets = text_bytes(batch.column(1))
            n = len(offsets) - 1
            counts, h1, h2 = np.zeros(n, np.int64), np.zeros(n, np.uint64), np.zeros(n, np.uint64)
            bands: list[np.ndarray] = []
            for first, end, part, off in chunks(raw, offsets):
                starts, ends, bounds = words(part, off)
                hashes = word_hashes(part, starts, ends)
                for d, own in zip(range(first, end), shingle_sets(hashes, bounds, shingle)):
                    counts[d] = len(own)
                    if not len(own):
                        bands.append(np.zeros(0, np.uint64))
                        continue
                    h1[d], h2[d] = np.bitwise_xor.reduce(mix(own)), np.add.reduce(mix(own + U64(1)))
                    rows = signature(own, slices).reshape(BANDS, ROWS).astype(np.uint64)
                    key = mix(band_no + U64(1))
                    for j in range(ROWS):
                        key = mix(key ^ rows[:, j]) + U64(j)
                    bands.append(mix(key))
            flat = np.concatenate(bands) if bands else np.zeros(0, np.uint64)
            ends_of = np.concatenate([[0], np.cumsum([len(b) for b in bands])]).astype(np.int32)
            listed = pa.ListArray.from_arrays(pa.array(ends_of), pa.array(flat.view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(counts), pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64)), listed],
                names=["doc_id", "n_shingles", "h1", "h2", "bands"])
    return sketch


def _setter(shingle: int):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = text_bytes(batch.column(1))
            for first, end, part, off in chunks(raw, offsets):
                starts, ends, bounds = words(part, off)
                own = shingle_sets(word_hashes(part, starts, ends), bounds, shingle)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, end - first).cast(pa.int64()), pa.array([x.tobytes() for x in own], pa.binary())], names=["rep", "elements"])
    return sets


def _confirmer(percent: int):
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for x, y in zip(batch.column(2), batch.column(3)):
                p, q = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                at = np.searchsorted(p, q)
                at[at == len(p)] = 0
                both = int(np.count_nonzero(p[at] == q))
                ok.append(100 * both >= percent * (len(p) + len(q) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))
    return confirm


def linked_forest(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links (places in ``sets``) that connect whatever the sets' pairs at the
    given similarity connect."""
    m = len(sets)
    sizes = np.array([len(x) for x in sets], dtype=np.int64)
    owner = np.repeat(np.arange(m), sizes)
    _, element, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    several = counts[element] > 1  # an element of one set is in no intersection
    owner, element = owner[several], element[several]
    order = np.argsort(element, kind="stable")
    owner, element = owner[order], np.unique(element[order], return_inverse=True)[1]
    both = np.zeros((m, m), dtype=np.float32)
    for first in range(0, int(element[-1]) + 1 if len(element) else 0, _COLUMNS):
        a, b = np.searchsorted(element, [first, first + _COLUMNS])
        part = np.zeros((m, _COLUMNS), dtype=np.float32)
        part[owner[a:b], element[a:b] - first] = 1
        both += part @ part.T
    both = both.astype(np.int64)
    linked = 100 * both >= percent * (sizes[:, None] + sizes[None, :] - both)
    out, seen = [], np.zeros(m, dtype=bool)
    for start in range(m):
        if seen[start]:
            continue
        seen[start], front = True, [start]
        while front:
            x = front.pop()
            new = np.flatnonzero(linked[x] & ~seen)
            seen[new] = True
            out += [(x, int(y)) for y in new]
            front += new.tolist()
    return out


def _block_links(percent: int):
    def links(table: pa.Table) -> pa.Table:
        reps = table.column("rep").to_pylist()
        kept = {rep: k for k, rep in enumerate(reps)}  # a row of a block paired with itself comes once
        rows = list(kept.values())
        found = linked_forest([np.frombuffer(table.column("elements")[k].as_buffer(), np.uint64) for k in rows], percent)
        return pa.table({"a": pa.array([reps[rows[x]] for x, _ in found], pa.int64()), "b": pa.array([reps[rows[y]] for _, y in found], pa.int64())})
    return links


def _with_components(waiting: DataFrame, parts: DataFrame | None) -> DataFrame:
    rows = waiting if parts is None else waiting.join(parts, F.col("rep") == F.col("node"), "left").drop("node")
    comp = F.col("rep") if parts is None else F.coalesce("component", "rep")
    return rows.select("bucket", "rep", "n", comp.alias("comp"))


def _mixed(rows: DataFrame) -> DataFrame:
    """(k, members, centre, centre_n, centre_comp, big, big_n) of the buckets
    that hold several components; ``big`` is the largest of them."""
    by_comp = rows.groupBy("bucket", "comp").agg(F.count("*").alias("size"), F.min_by(F.struct("rep", "n"), "rep").alias("least"))
    found = by_comp.groupBy("bucket").agg(
        F.count("*").alias("comps"), F.sum("size").alias("members"), F.min(F.struct("size", "comp", "least")).alias("c"), F.max(F.struct("size", "comp")).alias("g"))
    return found.filter("comps > 1").select(
        F.col("bucket").alias("k"), "members", F.col("c.least.rep").alias("centre"), F.col("c.least.n").alias("centre_n"), F.col("c.comp").alias("centre_comp"),
        F.col("g.comp").alias("big"), F.col("g.size").alias("big_n"))


def _block_pairs(rows: DataFrame) -> DataFrame:
    """Rows of mixed buckets -> (bucket, kind, i, j, rep), a row for each pair of
    blocks it takes part in. Members of a large component form blocks of their
    own, which meet the other blocks but not each other."""
    apart = (F.col("comp") == F.col("big")) & (F.col("big_n") > BLOCK)
    large = F.when(F.col("big_n") > BLOCK, F.col("big_n")).otherwise(0)
    n_rest = F.ceil((F.col("members") - large) / BLOCK).cast("int")
    n_large = F.ceil(large / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("rep"), F.when(apart, n_large).otherwise(n_rest)).cast("int")
    x = rows.select("bucket", "rep", apart.alias("apart"), n_rest.alias("n_rest"), n_large.alias("n_large"), own.alias("own"))
    among = F.transform(F.sequence(F.lit(0), F.col("n_rest") - 1), lambda o: F.struct(
        F.lit(0).alias("kind"), F.least(o, F.col("own")).alias("i"), F.greatest(o, F.col("own")).alias("j")))
    across = F.when(F.col("n_large") > 0, F.transform(F.sequence(F.lit(0), F.col("n_large") - 1), lambda o: F.struct(
        F.lit(1).alias("kind"), F.col("own").alias("i"), o.alias("j")))).otherwise(F.array().cast("array<struct<kind:int,i:int,j:int>>"))
    onto = F.transform(F.sequence(F.lit(0), F.col("n_rest") - 1), lambda o: F.struct(F.lit(1).alias("kind"), o.alias("i"), F.col("own").alias("j")))
    return x.select("bucket", "rep", F.explode(F.when(F.col("apart"), onto).otherwise(F.concat(among, across))).alias("p")).select("bucket", "p.*", "rep")


def sketches(docs: DataFrame, doc_id: str, text: str, shingle: int) -> DataFrame:
    return docs.select(F.col(doc_id).cast("long"), F.col(text)).mapInArrow(_sketcher(shingle), _SKETCH)


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept; a row per input row."""
    sketched = write_out(sketches(docs, doc_id, text, shingle))
    n = sketched.count()
    sets = ["n_shingles", "h1", "h2"]
    classes = write_out(sketched.filter("n_shingles > 0 and doc_id is not null").groupBy(*sets).agg(F.min("doc_id").alias("rep")), n)
    reps = sketched.select("doc_id", *sets, "bands").join(classes.withColumnRenamed("rep", "doc_id"), ["doc_id", *sets], "left_semi").dropDuplicates(["doc_id"])
    keyed = reps.select(F.col("doc_id").alias("rep"), F.col("n_shingles").alias("n"), F.explode("bands").alias("bucket"))
    shared = keyed.groupBy("bucket").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")).filter("lo <> hi").select("bucket")
    waiting = write_out(keyed.join(shared, "bucket", "left_semi"), n)  # at most BANDS * n rows
    members = broadcast_if_few(write_out(waiting.select("rep").distinct(), n))  # texts of the others stay where they are
    own_sets = write_out(docs.select(F.col(doc_id).cast("long").alias("rep"), F.col(text).alias("t")).join(members, "rep", "left_semi")
                         .dropDuplicates(["rep"]).mapInArrow(_setter(shingle), "rep long, elements binary"), n, SETS)
    links, parts = None, None
    for _ in range(STAR_ROUNDS):
        rows = _with_components(waiting, parts)
        rows = write_out(rows.join(_mixed(rows), F.col("bucket") == F.col("k")), n)  # buckets of one component are done
        pairs = rows.filter((F.col("comp") != F.col("centre_comp")) & (100 * F.least("n", "centre_n") >= percent * F.greatest("n", "centre_n")))
        pairs = pairs.select(F.col("centre").alias("a"), F.col("rep").alias("b")).distinct()
        left = own_sets.select(F.col("rep").alias("a"), F.col("elements").alias("x"))
        right = own_sets.select(F.col("rep").alias("b"), F.col("elements").alias("y"))
        confirmed = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(_confirmer(percent), "a long, b long")
        links = write_out(confirmed if links is None else links.unionAll(confirmed), n, SETS)
        parts = write_out(connected_components(links, links=n), n)
        waiting = rows.filter("rep <> centre").select("bucket", "rep", "n")
    rows = _with_components(waiting, parts)
    rows = write_out(rows.join(_mixed(rows), F.col("bucket") == F.col("k")), n)
    blocks = _block_pairs(rows).join(own_sets, "rep").groupBy("bucket", "kind", "i", "j").applyInArrow(_block_links(percent), "a long, b long")
    parts = write_out(connected_components(links.unionAll(blocks), links=n), n)
    members = classes.select(*[F.col(c).alias("c_" + c) for c in sets], "rep")
    same = (F.col("n_shingles") == F.col("c_n_shingles")) & (F.col("h1") == F.col("c_h1")) & (F.col("h2") == F.col("c_h2"))
    joined = sketched.drop("bands").join(members, same, "left")
    joined = joined.join(parts, F.col("rep") == F.col("node"), "left")
    component = F.coalesce("component", "rep", "doc_id")
    return joined.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", **params) -> DataFrame:
    """The rows of ``docs`` that stand for their component; rows without an id
    stay. Repeated rows of one id stay together."""
    gone_id = private_names(docs.columns, ["gone"])["gone"]
    gone = near_duplicates(docs, doc_id=doc_id, **params).filter(~F.col("kept")).select(F.col("doc_id").alias(gone_id)).distinct()
    return docs.join(broadcast_if_few(write_out(gone)), docs[doc_id].cast("long") == F.col(gone_id), "left_anti")


def op7_circulant_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents on 2-word shingles at 80 percent."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs, shingle=2, percent=80)


# Candidates by the rarest shingles of each text (a pair at 0.8 shares one of
# them), exact sizes of all intersections, reachability.
OP7_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                             '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS MATERIALIZED (
  SELECT doc_id, unnest(CASE WHEN len(w) >= 2 THEN list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))
                             WHEN len(w) = 1 THEN w ELSE [] END) AS g FROM w),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
f AS MATERIALIZED (SELECT g, count(*) AS c FROM s GROUP BY g),
p AS MATERIALIZED (
  SELECT * FROM (SELECT s.doc_id, s.g, n.n, row_number() OVER (PARTITION BY s.doc_id ORDER BY f.c, s.g) AS r
                 FROM s JOIN f ON f.g = s.g JOIN n ON n.doc_id = s.doc_id) WHERE r <= n - ceil(0.8 * n) + 1),
x AS MATERIALIZED (
  SELECT DISTINCT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb FROM p a JOIN p b ON a.g = b.g AND a.doc_id < b.doc_id
  WHERE 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)),
l AS MATERIALIZED (
  SELECT x.a, x.b FROM x JOIN s s1 ON s1.doc_id = x.a JOIN s s2 ON s2.doc_id = x.b AND s2.g = s1.g
  GROUP BY x.a, x.b, na, nb HAVING 100 * count(*) >= 80 * (na + nb - count(*))),
e AS MATERIALIZED (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(node, root) AS (SELECT doc_id, doc_id FROM documents UNION SELECT e.b, r.root FROM r JOIN e ON r.node = e.a),
c AS (SELECT node, min(root) AS component_id FROM r GROUP BY node)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d JOIN c ON c.node = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""
