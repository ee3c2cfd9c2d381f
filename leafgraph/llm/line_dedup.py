"""Line deduplication over sorted hashes, answered by a compressed keep bitmap for each document.

The 128-bit hashes of all long enough line keys are range-partitioned by (hash, document descending, position) and
sorted.  One pass streams each partition: the first document of a key is the largest one that holds it; from the third
document on, every line of the key is dropped, and the second document's lines with it.  A key that reaches over a
partition border is settled afterwards from the two border entries each partition reports, so a line that a third of all
documents share is spread over as many partitions as its documents need.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafgraph.llm.store import arrow_batches, shuffle_width, stage

MIN_CHARS = 20
MIN_DOCS = 3
#: What a key loses at both ends: ASCII white space.
_STRIP = " \t\n\r\x0b\x0c"
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
#: Kinds of rows of the line table and of the streaming pass.
_DOC, _LINE, _DROP, _OPEN, _BORDER = 0, 1, 2, 3, 4

_LINES = "doc_id long, text_hash long, kind int, h1 long, h2 long, position int"
_SEEN = "kind int, h1 long, h2 long, doc_id long, text_hash long, position int, docs long"


def line_key(line: str) -> str:
    return line.strip(_STRIP).translate(_LOWER)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _lines(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols: tuple[list, ...] = ([], [], [], [], [], [])
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                text = text or ""
                text_hash = _signed(xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")))
                lines = text.split("\n")
                rows = [(doc, text_hash, _DOC, 0, 0, len(lines))]
                for i, line in enumerate(lines):
                    if len(line) >= min_chars and len(key := line_key(line)) >= min_chars:
                        h = xxhash.xxh3_128_intdigest(key.encode("utf-8", "surrogatepass"))
                        rows.append((doc, text_hash, _LINE, _signed(h >> 64), _signed(h & (1 << 64) - 1), i))
                for col, values in zip(cols, zip(*rows, strict=True), strict=True):
                    col.extend(values)
            types = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32())
            names = ("doc_id", "text_hash", "kind", "h1", "h2", "position")
            yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=names)

    return run


def _stream(min_docs: int):
    """Decide the lines of keys that lie inside a partition; report border keys and their undecided lines.

    Rows come sorted by (hash, document descending, position).  At most the rows of ``min_docs`` documents of one key
    are held back.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        key = doc = None
        docs = 0  # documents of the key so far
        first_doc = None  # the key's first, so its largest
        held: list[tuple] = []  # lines of the key that are not decided yet
        leading = True  # the partition's first key: it may have begun in an earlier partition

        def flush() -> pa.RecordBatch:
            nonlocal out
            cols = list(zip(*out, strict=True)) if out else [[]] * 7
            types = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
            names = ("kind", "h1", "h2", "doc_id", "text_hash", "position", "docs")
            out = []
            return pa.record_batch([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=names)

        def end_key(last: bool) -> None:
            if key is None:
                return
            if leading or last:
                out.append((_BORDER, *key, first_doc, 0, 0, docs))
                out.extend((_OPEN, *key, *row, 0) for row in held)
            held.clear()

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("h1", "h2", "doc_id", "text_hash", "position")]
            for h1, h2, d, t, p in zip(*columns, strict=True):
                if (h1, h2) != key:
                    if key is not None:
                        end_key(False)
                        leading = False
                    key, doc, docs, first_doc = (h1, h2), None, 0, d
                if d != doc:
                    doc, docs = d, docs + 1
                    if docs == min_docs and not leading:
                        out.extend((_DROP, *key, *row, 0) for row in held if row[0] != first_doc)
                        held.clear()
                if leading:  # undecided, however many: passed on at once
                    out.append((_OPEN, h1, h2, d, t, p, 0))
                elif docs >= min_docs:
                    out.append((_DROP, h1, h2, d, t, p, 0))
                else:
                    held.append((d, t, p))
            if len(out) > 50_000:
                yield flush()
        end_key(True)
        yield flush()

    return run


def _bitmap(n_lines: int, dropped: list[int] | None) -> bytes:
    keep = np.ones(n_lines, dtype=np.uint8)
    if dropped:
        keep[dropped] = 0
    return zlib.compress(np.packbits(keep, bitorder="little").tobytes(), 6)


def kept_lines(bitmap: bytes, n_lines: int) -> np.ndarray:
    """The keep bitmap as booleans, a value for each line."""
    packed = np.frombuffer(zlib.decompress(bitmap), dtype=np.uint8)
    return np.unpackbits(packed, count=n_lines, bitorder="little").astype(bool)


def line_keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``doc_id, text_hash, n_lines, n_dropped, keep``: a zlib-compressed bitmap, bit i for line i, 1 where it stays.

    Lines are separated by line feeds; a null or empty text is one empty line.  Keys (stripped of ASCII white space, A-Z
    lower-cased) of at least ``min_chars`` code points in at least ``min_docs`` documents lose all their lines except in
    the largest id that holds them, where all stay.  Rows of one id are one document and null ids are together the
    smallest; repeated rows give one result.  An empty table gives no rows.
    """
    if min_docs < 2:
        raise ValueError("min_docs must be 2 at least: the largest id always keeps its lines")
    spark = docs.sparkSession
    arrow_batches(spark)
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    table = stage(read.mapInArrow(_lines(min_chars), _LINES), "lines")
    rank = F.coalesce("doc_id", F.lit(-(1 << 63)))
    lines = table.where(F.col("kind") == _LINE).select("h1", "h2", rank.alias("doc_id"), "text_hash", "position")
    order = [F.col("h1"), F.col("h2"), F.col("doc_id").desc()]
    ranged = lines.repartitionByRange(shuffle_width(spark), *order).sortWithinPartitions(*order, "text_hash", "position")
    seen = stage(ranged.mapInArrow(_stream(min_docs), _SEEN), "line-pass")
    # at most two entries a partition
    border = seen.where(F.col("kind") == _BORDER).groupBy("h1", "h2")
    border = border.agg(F.sum("docs").alias("all_docs"), F.max("doc_id").alias("largest")).where(F.col("all_docs") >= min_docs)
    late = seen.where(F.col("kind") == _OPEN).join(F.broadcast(border), ["h1", "h2"]).where("doc_id <> largest")
    dropped = seen.where(F.col("kind") == _DROP).select("doc_id", "text_hash", "position")
    dropped = dropped.union(late.select("doc_id", "text_hash", "position"))
    per_doc = dropped.groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_set("position")).alias("gone"))
    heads = table.where(F.col("kind") == _DOC).select("doc_id", "text_hash", F.col("position").alias("n_lines")).distinct()
    per_doc = per_doc.select(F.col("doc_id").alias("__doc"), F.col("text_hash").alias("__text"), "gone")
    joined = heads.join(per_doc, (rank == F.col("__doc")) & (F.col("text_hash") == F.col("__text")), "left")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gone = batch.column("gone").to_pylist()
            n = batch.column("n_lines").to_pylist()
            arrays = [batch.column("doc_id"), batch.column("text_hash"), pa.array(n, pa.int64())]
            arrays.append(pa.array([len(g or ()) for g in gone], pa.int64()))
            arrays.append(pa.array([_bitmap(a, b) for a, b in zip(n, gone, strict=True)], pa.binary()))
            yield pa.record_batch(arrays, names=("doc_id", "text_hash", "n_lines", "n_dropped", "keep"))

    return joined.select("doc_id", "text_hash", "n_lines", "gone").mapInArrow(
        pack, "doc_id long, text_hash long, n_lines long, n_dropped long, keep binary"
    )


def _with_text_hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw = batch.column("text").cast(pa.binary()).to_pylist()
        hashes = pa.array([_signed(xxhash.xxh3_64_intdigest(t or b"")) for t in raw], pa.int64())
        yield pa.record_batch([batch.column("doc_id"), batch.column("text"), hashes], names=("doc_id", "text", "text_hash"))


def apply_keep_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept_text`` for each row of ``docs``: the lines that stay, joined by line feeds."""
    hashed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    hashed = hashed.mapInArrow(_with_text_hash, "doc_id long, text string, text_hash long")
    maps = bitmaps.select(F.col("doc_id").alias("__doc"), F.col("text_hash").alias("__text"), "n_lines", "n_dropped", "keep")
    joined = hashed.join(maps, F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("text_hash") == F.col("__text")))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            values = (batch.column(c).to_pylist() for c in ("text", "n_lines", "n_dropped", "keep"))
            for text, n, dropped, keep in zip(*values, strict=True):
                if dropped:
                    stays = kept_lines(keep, n).tolist()
                    text = "\n".join([line for line, stay in zip(text.split("\n"), stays, strict=True) if stay])
                kept.append(text or "")
            arrays = [batch.column("doc_id"), batch.column("n_lines"), batch.column("n_dropped"), pa.array(kept, pa.string())]
            yield pa.record_batch(arrays, names=("doc_id", "n_lines", "n_dropped", "kept_text"))

    return joined.select("doc_id", "text", "n_lines", "n_dropped", "keep").mapInArrow(
        cut, "doc_id long, n_lines long, n_dropped long, kept_text string"
    )


def sha256_hex(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
