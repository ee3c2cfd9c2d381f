"""Exact deduplication by a tree merge of sorted digest runs.

Every document goes to a leaf chosen by a hash of its id, so that copies of one text spread over all leaves.  A leaf
sorts its digests once and merges them into a run with one entry a digest: the smallest id and the number of documents.
In binomial rounds the leaves of a group of two, four, ... then exchange parts of their runs: after round k a member of a
group of 2**k (several doublings are taken at once) holds those digests of the whole group that agree with its own place
in the last k bits.  After the last round each digest has one owner.

Runs travel as blocks of sorted entries.  A round never sorts entries again: it takes the blocks in the order of their
first keys and merges the open ones, up to the first key of the next, so that it holds about a block of each run at a
time.  A digest that a third of all documents share has at most one entry a leaf in any exchange.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafgraph.llm.store import arrow_batches, shuffle_width, small_side, stage, unused

WHITESPACE = r"[\x20\x09-\x0D]+"
#: Doublings that one round takes: each place receives from 2**3 others.
ROUND_BITS = 3
MAX_LEAVES = 4096
_NO_ID = (1 << 63) - 1
#: Entries of a block of a run.
BLOCK = 4096
#: A digest with its text's length behind it (equal digests of texts of different length stay apart), the smallest id and
#: the number of documents.
ENTRY = np.dtype([("key", "S40"), ("least_id", "<i8"), ("n", "<i8")])
_BLOCKS = "leaf int, place int, first binary, block binary"


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITESPACE, " ")


def _key_bytes(keys: np.ndarray) -> np.ndarray:
    """Keys as rows of 40 bytes; numpy leaves out the zeros that a key ends with."""
    return np.frombuffer(np.ascontiguousarray(keys).tobytes(), dtype=np.uint8).reshape(-1, 40)


def merge_neighbours(entries: np.ndarray) -> np.ndarray:
    """One entry for each run of equal keys: the smallest id and the sum of documents."""
    if not len(entries):
        return entries
    new = np.ones(len(entries), dtype=bool)
    new[1:] = entries["key"][1:] != entries["key"][:-1]
    at = np.flatnonzero(new)
    merged = entries[at]
    merged["least_id"] = np.minimum.reduceat(entries["least_id"], at)
    merged["n"] = np.add.reduceat(entries["n"], at)
    return merged


def merge_runs(blocks: Iterator[np.ndarray]) -> Iterator[np.ndarray]:
    """Merge sorted blocks, given in the order of their first keys, into sorted entries with one entry a key.

    What lies below the first key of the next block is complete and goes out; the rest stays open.
    """
    open_: list[np.ndarray] = []
    for block in blocks:
        if not len(block):
            continue
        border = block["key"][0]
        cuts = [int(np.searchsorted(run["key"], border)) for run in open_]
        if any(cuts):
            yield _merged([run[:cut] for run, cut in zip(open_, cuts, strict=True) if cut])
            open_ = [run[cut:] for run, cut in zip(open_, cuts, strict=True) if cut < len(run)]
        open_.append(block)
    if open_:
        yield _merged(open_)


def _merged(runs: list[np.ndarray]) -> np.ndarray:
    """Sorted runs as one: neighbours two by two, each entry placed by how many of the other run come before it."""
    while len(runs) > 1:
        pairs = [runs[i : i + 2] for i in range(0, len(runs), 2)]
        runs = []
        for pair in pairs:
            if len(pair) == 1:
                runs.append(pair[0])
                continue
            a, b = pair
            both = np.empty(len(a) + len(b), dtype=ENTRY)
            both[np.arange(len(a)) + np.searchsorted(b["key"], a["key"], side="left")] = a
            both[np.arange(len(b)) + np.searchsorted(a["key"], b["key"], side="right")] = b
            runs.append(merge_neighbours(both))
    return merge_neighbours(runs[0])


def _owner(keys: np.ndarray, leaves: int) -> np.ndarray:
    """The leaf that a key ends up with."""
    return (np.ascontiguousarray(_key_bytes(keys)[:, :8]).view(">u8").ravel() % np.uint64(leaves)).astype(np.int64)


class _Sender:
    """Entries of one place's run, dealt in order to the places they go to next; blocks leave when they are full."""

    def __init__(self, leaf: int, group: int, leaves: int) -> None:
        self.leaf, self.group, self.leaves = leaf, group, leaves
        self.waiting: dict[int, list[np.ndarray]] = {}

    def deal(self, entries: np.ndarray) -> list[tuple[int, int, bytes, bytes]]:
        out = []
        place = self.leaf // self.group * self.group + _owner(entries["key"], self.leaves) % self.group
        for p in np.unique(place).tolist():
            held = self.waiting.setdefault(p, [])
            held.append(entries[place == p])
            if sum(map(len, held)) >= BLOCK:
                out += self._blocks(p)
        return out

    def _blocks(self, p: int) -> list[tuple[int, int, bytes, bytes]]:
        entries = np.concatenate(self.waiting.pop(p))
        parts = [entries[i : i + BLOCK] for i in range(0, len(entries), BLOCK)]
        return [(self.leaf, p, _key_bytes(x["key"][:1]).tobytes(), x.tobytes()) for x in parts]

    def rest(self) -> list[tuple[int, int, bytes, bytes]]:
        return [block for p in list(self.waiting) for block in self._blocks(p)]


def _record(rows: list[tuple[int, int, bytes, bytes]]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary())
    columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
    return pa.record_batch(columns, names=("leaf", "place", "first", "block"))


def _leaf_runs(group: int, leaves: int):
    """Rows sorted by leaf and digest to the blocks of the leaves' runs, addressed for the first round."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sender: _Sender | None = None
        carry: np.ndarray | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            leaf = batch.column("leaf").to_numpy()
            entries = np.zeros(batch.num_rows, dtype=ENTRY)
            key = np.zeros((batch.num_rows, 40), dtype=np.uint8)
            key[:, :32] = np.frombuffer(b"".join(batch.column("digest").to_pylist()), dtype=np.uint8).reshape(-1, 32)
            key[:, 32:] = batch.column("n_bytes").to_numpy().astype(">i8").view(np.uint8).reshape(-1, 8)
            entries["key"] = key.view("S40").ravel()
            entries["least_id"] = batch.column("least_id").to_numpy()
            entries["n"] = 1
            out: list[tuple[int, int, bytes, bytes]] = []
            cuts = [0, *(np.flatnonzero(leaf[1:] != leaf[:-1]) + 1).tolist(), len(leaf)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if sender is None or sender.leaf != leaf[a]:
                    if sender is not None and carry is not None:
                        out += sender.deal(carry) + sender.rest()
                    sender, carry = _Sender(int(leaf[a]), group, leaves), None
                part = entries[a:b] if carry is None else np.concatenate([carry, entries[a:b]])
                merged = merge_neighbours(part)
                carry = merged[-1:]  # the next batch may go on with it
                if len(merged) > 1:
                    out += sender.deal(merged[:-1])
            yield _record(out)
        if sender is not None and carry is not None:
            yield _record(sender.deal(carry) + sender.rest())

    return run


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Iterator[np.ndarray]]]:
    """The blocks of each place of a partition that is sorted by place and first key."""
    rows = (
        (place, np.frombuffer(block, dtype=ENTRY))
        for batch in batches
        for place, block in zip(batch.column("place").to_pylist(), batch.column("block").to_pylist(), strict=True)
    )
    return ((place, (block for _, block in group)) for place, group in groupby(rows, key=lambda r: r[0]))


def _round(group: int, leaves: int):
    """Merge the runs that meet at a place, and address the result for the next round."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for place, blocks in _stream(batches):
            sender = _Sender(place, group, leaves)
            for entries in merge_runs(blocks):
                yield _record(sender.deal(entries))
            yield _record(sender.rest())

    return run


def _unpacked(entries: np.ndarray) -> list[pa.Array]:
    raw = _key_bytes(entries["key"])
    offsets = pa.py_buffer(np.arange(0, 32 * len(raw) + 1, 32, dtype=np.int32))
    digest = pa.Array.from_buffers(pa.binary(), len(raw), [None, offsets, pa.py_buffer(np.ascontiguousarray(raw[:, :32]))])
    return [digest, pa.array(np.ascontiguousarray(raw[:, 32:]).view(">i8").ravel().astype(np.int64))]


def _owned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The last merge: one entry a digest."""
    for _, blocks in _stream(batches):
        for entries in merge_runs(blocks):
            columns = [*_unpacked(entries), pa.array(entries["least_id"].copy()), pa.array(entries["n"].copy())]
            yield pa.record_batch(columns, names=("digest", "n_bytes", "least_id", "n"))


def _asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What the leaves' runs hold, entry by entry."""
    for batch in batches:
        for leaf, block in zip(batch.column("leaf").to_pylist(), batch.column("block").to_pylist(), strict=True):
            entries = np.frombuffer(block, dtype=ENTRY)
            columns = [pa.array(np.full(len(entries), leaf, dtype=np.int32)), *_unpacked(entries)]
            yield pa.record_batch(columns, names=("leaf", "digest", "n_bytes"))


def _exchange(runs: DataFrame, places: int) -> DataFrame:
    """Blocks at the places they are addressed to, in the order of their first keys."""
    return runs.repartitionById(places, "place").sortWithinPartitions("place", "first")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", leaves: int | None = None) -> DataFrame:
    """One row a document: ``doc_id, keep_id, group_size, kept, text_sha256``; other columns are not read.

    Texts are equal when identical after each run of ASCII white space became one space; a null text counts as empty.
    The smallest id of a group stays.  Repeated rows (same id and text) are counted in ``group_size`` and marked alike.
    A null id comes after all others: a group of null ids only has ``keep_id`` null and ``kept`` true.  An empty table
    gives an empty result.
    """
    spark = docs.sparkSession
    arrow_batches(spark)
    if leaves is None:
        leaves = min(MAX_LEAVES, 1 << max(4, (shuffle_width(spark) - 1).bit_length()))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), normalised(F.col(text_col)).alias("t")).select(
        "doc_id", F.unhex(F.sha2("t", 256)).alias("digest"), F.octet_length("t").cast("long").alias("n_bytes")
    )
    rows = stage(rows.withColumn("leaf", F.pmod(F.xxhash64("doc_id", "digest"), F.lit(leaves)).cast("int")), "digests")
    entries = rows.select("leaf", "digest", "n_bytes", F.coalesce("doc_id", F.lit(_NO_ID)).alias("least_id"))
    entries = entries.repartitionById(leaves, "leaf").sortWithinPartitions("leaf", "digest", "n_bytes")
    groups = [min(leaves, 1 << bits) for bits in range(ROUND_BITS, (leaves - 1).bit_length() + ROUND_BITS, ROUND_BITS)] or [1]
    leaf_runs = stage(entries.mapInArrow(_leaf_runs(groups[0], leaves), _BLOCKS), "runs")
    runs = leaf_runs
    for group in groups[1:]:
        runs = _exchange(runs, leaves).mapInArrow(_round(group, leaves), _BLOCKS)
    owned = _exchange(runs, leaves).mapInArrow(_owned, "digest binary, n_bytes long, least_id long, n long")
    answers = leaf_runs.mapInArrow(_asked, "leaf int, digest binary, n_bytes long").join(owned, ["digest", "n_bytes"])
    keep_id = F.when(F.col("least_id") != _NO_ID, F.col("least_id"))
    return rows.join(answers, ["leaf", "digest", "n_bytes"]).select(
        "doc_id",
        keep_id.alias("keep_id"),
        F.col("n").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep_id).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns, whatever they are called; of repeated rows of a kept id, one.

    Rows are found by their ids alone, and texts are not shuffled while the ids that go are few enough to be sent around.
    Only rows whose id other rows have too (or that have none) are told apart by their texts.  A null id comes after all
    others; null and empty texts are equal; an empty table gives an empty result.
    """
    key, text = unused("id", docs), unused("text", docs)
    groups = stage(exact_groups(docs, id_col, text_col).withColumnRenamed("doc_id", key), "groups")
    shared = groups.groupBy(key).agg(F.count("*").alias("n")).where(F.col(key).isNull() | (F.col("n") > 1)).select(key)
    left = docs.withColumn(key, F.col(id_col).cast("long"))
    if not shared.limit(1).count():
        return left.join(small_side(groups.where("not kept").select(key)), key, "left_anti").select(*_all(docs))
    shared = stage(shared, "shared-ids")
    away = groups.where("not kept").select(key).union(shared.where(F.col(key).isNotNull())).distinct()
    alone = left.where(F.col(key).isNotNull()).join(small_side(away), key, "left_anti").select(*_all(docs))
    other = unused("other", docs)
    several = small_side(shared.select(F.col(key).alias(other)))
    several = left.join(several, F.col(key).eqNullSafe(F.col(other)), "left_semi").withColumn(text, F.sha2(normalised(F.col(text_col)), 256))
    kept = groups.where("kept").select(F.col(key).alias(other), F.col("text_sha256").alias(other + "_text")).distinct()
    several = several.join(kept, F.col(key).eqNullSafe(F.col(other)) & (F.col(text) == F.col(other + "_text")), "left_semi")
    return alone.unionByName(several.dropDuplicates([key, text]).select(*_all(docs)))


def _all(docs: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in docs.columns]
