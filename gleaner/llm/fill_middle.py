"""Fill-in-middle reordering of texts kept as seekable compressed frames.

1. Store. A text becomes one row of independent zstandard frames of at most
   FRAME bytes of UTF-8 each, with the units and code points that end up to
   each frame's end, cumulated. A unit is a word with the whitespace before it,
   or whitespace at the end of the text. The table is written to the shared
   folder; any part of a text can then be read from the frames that cover it.
2. Selection. The two cuts, drawn from a hash of seed and ``doc_id``, are
   looked up in the cumulative unit counts; only the frames that hold a cut are
   decompressed, to find its byte and code point.
3. Digests. The pieces of the output are streamed frame by frame, in output
   order, into its digest. The text is rebuilt from that stream: its parts are
   told apart by the markers, kept as frames again and read in text order.

A row is worked on by itself, so equal rows, hot sources and NULL ids need no
shuffle; memory holds a row's compressed frames and one plain frame.

Defined results: NULL text is empty, empty text is plain; a NULL ``doc_id``
hashes as an empty string; texts that contain a marker are plain; rows that
share an id have equal draws, each over its own text; an empty table gives an
empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm.bytescan import GAP, text_bytes
from gleaner.llm.common import read_table
from gleaner.session import ensure_checkpoint_dir

FRAME = 1 << 16
SEED = 42
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
_ROWS, _BYTES = 256, 1 << 24  # documents and stored bytes of an output batch, about
_FRAMES = "array<struct<units:long,chars:long,data:binary>>"
STORE = f"doc_id long, n_bytes long, n_units long, n_chars long, marked boolean, frames {_FRAMES}"
_STORE = pa.schema([
    ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_units", pa.int64()), ("n_chars", pa.int64()), ("marked", pa.bool_()),
    ("frames", pa.list_(pa.struct([("units", pa.int64()), ("chars", pa.int64()), ("data", pa.binary())])))])


def unit_ends(raw: np.ndarray) -> np.ndarray:
    """Ends of the units of one text, in bytes."""
    gap = GAP[raw]
    ends = np.flatnonzero(~gap[:-1] & gap[1:]) + 1
    return np.append(ends, len(raw)) if len(raw) else ends


def text_frames(raw: np.ndarray, size: int, packer: zstandard.ZstdCompressor) -> list[tuple[int, int, bytes]]:
    """(units, code points, data) of each frame; a unit counts where its last
    byte lies, a code point where its first does."""
    ends, out, chars = unit_ends(raw), [], 0
    heads = (raw & 0xC0) != 0x80
    for a in range(0, len(raw), size):
        b = min(a + size, len(raw))
        chars += int(np.count_nonzero(heads[a:b]))
        out.append((int(np.searchsorted(ends, b, side="right")), chars, packer.compress(raw[a:b].tobytes())))
    return out


def _storer(size: int):
    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            raw, offsets = text_bytes(batch.column(1))
            ids, rows, held = batch.column(0).to_pylist(), [], 0
            for k, doc in enumerate(ids):
                own = raw[offsets[k]:offsets[k + 1]]
                frames, plain = text_frames(own, size, packer), own.tobytes()
                rows.append({"doc_id": doc, "n_bytes": len(own), "n_units": frames[-1][0] if frames else 0, "n_chars": frames[-1][1] if frames else 0,
                             "marked": any(m in plain for m in (PREFIX, SUFFIX, MIDDLE)), "frames": [dict(zip(("units", "chars", "data"), f)) for f in frames]})
                held += sum(len(f[2]) for f in frames)
                if len(rows) == _ROWS or held > _BYTES:
                    yield pa.RecordBatch.from_pylist(rows, schema=_STORE)
                    rows, held = [], 0
            yield pa.RecordBatch.from_pylist(rows, schema=_STORE)
    return store


def write_frames(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", frame: int = FRAME) -> DataFrame:
    """The frame store of ``docs``, written to ``path`` and read back."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows.mapInArrow(_storer(frame), STORE).write.option("compression", "uncompressed").parquet(path)
    return docs.sparkSession.read.schema(STORE).parquet(path)


class FrameText:
    """One stored text, read by byte ranges; keeps one plain frame."""

    def __init__(self, frames: list[dict], size: int):
        self.frames, self.size = frames, size
        self.reader, self.at, self.plain, self.opened = zstandard.ZstdDecompressor(), -1, b"", 0

    def frame(self, k: int) -> bytes:
        if k != self.at:
            self.plain, self.at = self.reader.decompress(self.frames[k]["data"]), k
            self.opened += 1
        return self.plain

    def cut(self, units: int) -> tuple[int, int]:
        """(byte, code point) where the first ``units`` units end."""
        if not units:
            return 0, 0
        totals = [f["units"] for f in self.frames]
        k = int(np.searchsorted(totals, units))
        before = totals[k - 1] if k else 0
        raw = np.frombuffer(self.frame(k), dtype=np.uint8)
        gap = GAP[raw]
        inside = np.flatnonzero(~gap[:-1] & gap[1:]) + 1
        # the last unit of a frame may end at its edge, which the frame alone does not show
        end = int(inside[units - before - 1]) if units - before <= len(inside) else len(raw)
        heads = int(np.count_nonzero((raw[:end] & 0xC0) != 0x80))
        return k * self.size + end, heads + (self.frames[k - 1]["chars"] if k else 0)

    def read(self, a: int, b: int) -> Iterator[bytes]:
        """The bytes from a to b, a frame at a time."""
        while a < b:
            k = a // self.size
            piece = self.frame(k)[a - k * self.size:b - k * self.size]
            yield piece
            a += len(piece)


class Spool:
    """Bytes written once and read once, compressed beyond ``size``."""

    def __init__(self, size: int):
        self.size, self.frames, self.held, self.n = size, [], [], 0

    def write(self, piece: bytes) -> None:
        self.held.append(piece)
        self.n += len(piece)
        if self.n >= self.size:
            self.frames.append(zstandard.ZstdCompressor(level=1).compress(b"".join(self.held)))
            self.held, self.n = [], 0

    def read(self) -> Iterator[bytes]:
        reader = zstandard.ZstdDecompressor()
        for data in self.frames:
            yield reader.decompress(data)
        yield b"".join(self.held)


def draw(doc_id: int | None, n: int, marked: bool, seed: int = SEED) -> tuple[str, int, int]:
    """(form, first cut, second cut) of a text of ``n`` units."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[k:k + 8], 16) for k in (0, 8, 16, 24))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not n or marked or h3 % 100 >= 50:
        return "plain", a, b
    return ("spm" if h4 % 100 < 80 else "psm"), a, b


def render(text: FrameText, form: str, first: int, second: int, end: int) -> Iterator[bytes]:
    """The output, in pieces of at most a frame; cuts and end in bytes."""
    if form == "plain":
        yield from text.read(0, end)
        return
    parts = [(PREFIX, 0, first), (SUFFIX, second, end), (MIDDLE, first, second)]
    for marker, a, b in (parts if form == "psm" else [parts[1], parts[0], parts[2]]):
        yield marker
        yield from text.read(a, b)


def restore(output: Iterable[bytes], form: str, size: int = FRAME) -> Iterator[bytes]:
    """The text behind an output that comes in pieces of any length."""
    if form == "plain":
        yield from output
        return
    order = (PREFIX, SUFFIX, MIDDLE) if form == "psm" else (SUFFIX, PREFIX, MIDDLE)
    spools, k, rest = [Spool(size) for _ in order], -1, b""
    for piece in output:
        rest += piece
        while k < 2 and (at := rest.find(order[k + 1])) >= 0:
            if k >= 0:
                spools[k].write(rest[:at])
            k, rest = k + 1, rest[at + len(order[0]):]
        sure = len(rest) - (2 if k < 2 else 0)  # the next marker may have begun
        if k >= 0 and sure > 0:
            spools[k].write(rest[:sure])
            rest = rest[sure:]
    spools[k].write(rest)
    for marker in (PREFIX, MIDDLE, SUFFIX):
        yield from spools[order.index(marker)].read()


_RESULT = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()),
                     ("output_sha256", pa.string()), ("restored_sha256", pa.string()), ("output", pa.string())])


def _reorderer(size: int, seed: int, keep_output: bool):
    schema = _RESULT if keep_output else pa.schema(list(_RESULT)[:-1])

    def reorder(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for k in range(batch.num_rows):
                doc, end, n, marked, frames = (batch.column(c)[k].as_py() for c in range(5))
                text = FrameText(frames, size)
                form, a, b = draw(doc, n, marked, seed)
                chars = [None, None]
                if form != "plain":
                    (a, before), (b, upto) = text.cut(a), text.cut(b)
                    chars = [before, upto - before]
                digest, again, held = hashlib.sha256(), hashlib.sha256(), []

                def told(pieces: Iterator[bytes]) -> Iterator[bytes]:
                    for piece in pieces:
                        digest.update(piece)
                        if keep_output:
                            held.append(piece)
                        yield piece

                for piece in restore(told(render(text, form, a, b, end)), form, size):
                    again.update(piece)
                row = [doc, n, form, *chars, digest.hexdigest(), again.hexdigest()] + ([b"".join(held).decode()] if keep_output else [])
                rows.append(dict(zip(schema.names, row)))
                if len(rows) == _ROWS:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)
                    rows = []
            yield pa.RecordBatch.from_pylist(rows, schema=schema)
    return reorder


def reorder_frames(frames: DataFrame, frame: int = FRAME, seed: int = SEED, keep_output: bool = False) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output_sha256 and
    restored_sha256 of every stored text; with ``keep_output`` also ``output``,
    the reordered text. ``frame`` is the size the store was written with."""
    ddl = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"
    rows = frames.select("doc_id", "n_bytes", "n_units", "marked", "frames")
    return rows.mapInArrow(_reorderer(frame, seed, keep_output), ddl + (", output string" if keep_output else ""))


def fill_in_middle(docs: DataFrame, path: str | None = None, doc_id: str = "doc_id", text: str = "text", **params) -> DataFrame:
    """Store ``docs`` as frames (at ``path``, else in the shared checkpoint
    folder) and reorder them; a row per input row."""
    path = path or f"{ensure_checkpoint_dir(docs.sparkSession)}/frames-{uuid.uuid4().hex}"
    return reorder_frames(write_frames(docs, path, doc_id, text, frame=params.get("frame", FRAME)), **params)


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form, cuts and digests of every document's reordered text."""
    return fill_in_middle(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


OP12_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || doc_id) AS h,
                  regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u FROM documents),
d AS (SELECT *, len(u)::BIGINT AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2, ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM t),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
             CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain'
                  WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM d),
p AS (SELECT *, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle, array_to_string(u[b + 1:], '') AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END::BIGINT AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END::BIGINT AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(text) AS restored_sha256
FROM p
"""
