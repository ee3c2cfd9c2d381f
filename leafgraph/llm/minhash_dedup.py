"""Near-duplicate documents by circulant MinHash, with every link confirmed on full shingle sets.

One permutation (a bijection of 64-bit shingle hashes, of which the upper half is the place) scatters the shingles over
2**32 places; a second one ranks places, and signature coordinate k uses it shifted around the circle by k steps.  So two
permutations give all coordinates.  Four coordinates make a band; documents that share a band meet in a bucket.

No bucket emits its pairs.  First each member is compared with its bucket's smallest id, and the links become components.
The other members of a bucket are dealt into classes of neighbouring set sizes, since sets of too different size are never
linked.  A class whose members still lie in different components is cut into chunks of bounded bytes and each pair of
chunks compared as one product of incidence matrices, which emits only which components touch.  Documents with equal
shingle sets are one node throughout.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafgraph.llm.components import connected_components
from leafgraph.llm.shingles import batches as text_batches
from leafgraph.llm.shingles import mix64, shingle_sets
from leafgraph.llm.store import arrow_batches, small_side, stage, unused

WIDTH = 5
#: Linked: PERCENT * union <= 100 * intersection.
PERCENT = 80
#: The chance that a pair at the threshold shares no band: (1 - 0.8**4)**24 = 3e-6.
BANDS, ROWS = 24, 4
#: Documents of a chunk, and shingles of it (8 bytes each), on average: only a set that is larger makes a larger chunk.
CHUNK = 256
CHUNK_ITEMS = 1 << 19
LEAVES = 64
#: The circular shift between coordinates; odd, so that it reaches every place.
_STEP = 0x9E3779B1
_SIGMA = 0x2545F4914F6CDD1D


def _rank32(x: np.ndarray) -> np.ndarray:
    """The second permutation: a bijection of 32-bit places (murmur3's finaliser)."""
    x = x ^ (x >> np.uint32(16))
    x *= np.uint32(0x85EBCA6B)
    x ^= x >> np.uint32(13)
    x *= np.uint32(0xC2B2AE35)
    x ^= x >> np.uint32(16)
    return x


def signatures(sets: list[np.ndarray], size: int) -> np.ndarray:
    """``size`` circulant MinHash coordinates of each set; all ones for an empty set."""
    out = np.full((len(sets), size), 0xFFFFFFFF, dtype=np.uint32)
    lengths = np.array([len(s) for s in sets])
    some = np.flatnonzero(lengths)
    if not len(some):
        return out
    places = (mix64(np.concatenate([sets[i] for i in some]) ^ np.uint64(_SIGMA)) >> np.uint64(32)).astype(np.uint32)
    first = np.concatenate(([0], np.cumsum(lengths[some])[:-1]))
    for k in range(size):
        out[some, k] = np.minimum.reduceat(_rank32(places + np.uint32(k * _STEP & 0xFFFFFFFF)), first)
    return out


def _band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    keys = np.empty((len(signature), bands), dtype=np.uint64)
    for b in range(bands):
        key = np.full(len(signature), b + 1, dtype=np.uint64)
        for r in range(rows):
            key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + signature[:, b * rows + r].astype(np.uint64))
        keys[:, b] = key
    return keys.view(np.int64)


def _raw_texts(batch: pa.RecordBatch) -> list[bytes]:
    return [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]


def _sketch(width: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, keys = [], [], []
            for _, texts in text_batches(_raw_texts(batch)):
                sets = shingle_sets(texts, width)
                sizes += [len(s) for s in sets]
                digests += [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
                keys.append(_band_keys(signatures(sets, bands * rows), bands, rows))
            flat = np.concatenate(keys).ravel() if keys else np.empty(0, dtype=np.int64)
            lists = pa.ListArray.from_arrays(np.arange(0, len(flat) + 1, bands, dtype=np.int32), pa.array(flat))
            columns = [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), lists]
            yield pa.record_batch(columns, names=("doc_id", "n", "digest", "bands"))

    return run


def _full_sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets: list[bytes] = []
            for _, texts in text_batches(_raw_texts(batch)):
                sets += [s.tobytes() for s in shingle_sets(texts, width)]
            yield pa.record_batch([batch.column("doc_id"), pa.array(sets, pa.binary())], names=("doc_id", "items"))

    return run


def _linked(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column("a").to_numpy(), batch.column("b").to_numpy()
            keep = np.zeros(len(a), dtype=bool)
            left, right = batch.column("items_a"), batch.column("items_b")
            for i in range(len(a)):
                x = np.frombuffer(left[i].as_buffer(), dtype=np.uint64)
                y = np.frombuffer(right[i].as_buffer(), dtype=np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep[i] = 100 * both >= percent * (len(x) + len(y) - both)
            yield pa.record_batch([pa.array(a[keep]), pa.array(b[keep])], names=("a", "b"))

    return run


def _incidence(sets: list[np.ndarray], step: int = 4096) -> Iterator[np.ndarray]:
    """Blocks of columns of the 0/1 matrix of documents by shingles, only for shingles that two documents hold."""
    items = np.concatenate(sets) if sets else np.empty(0, dtype=np.uint64)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(items, kind="stable")
    items, owner = items[order], owner[order]
    new = np.ones(len(items), dtype=bool)
    new[1:] = items[1:] != items[:-1]
    group = np.cumsum(new) - 1
    often = np.bincount(group, minlength=1) > 1 if len(items) else np.zeros(1, dtype=bool)
    use = often[group] if len(items) else np.zeros(0, dtype=bool)
    column = (np.cumsum(often) - 1)[group[use]] if len(items) else np.empty(0, dtype=np.int64)
    owner = owner[use]
    for at in range(0, int(often.sum()), step):
        lo, hi = np.searchsorted(column, [at, at + step])
        block = np.zeros((len(sets), min(step, int(often.sum()) - at)), dtype=np.float32)
        block[owner[lo:hi], column[lo:hi] - at] = 1.0
        yield block


def touching(sets: list[np.ndarray], component: np.ndarray, side: np.ndarray, percent: int) -> np.ndarray:
    """Pairs of different components with a linked pair of documents; ``side`` 0 and 1 are compared, 2 with its own."""
    size = np.array([len(s) for s in sets], dtype=np.int64)
    both = np.zeros((len(sets), len(sets)), dtype=np.float32)
    for block in _incidence(sets):
        both += block @ block.T
    shared = both.astype(np.int64)
    linked = 100 * shared >= percent * (size[:, None] + size[None, :] - shared)
    linked &= component[:, None] != component[None, :]
    if not (side == 2).any():
        linked &= side[:, None] != side[None, :]
    i, j = np.nonzero(np.triu(linked, 1))
    return np.unique(np.sort(np.stack([component[i], component[j]], axis=1), axis=1), axis=0)


def _chunk_pairs(percent: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.drop_duplicates("doc_id")
        sets = [np.frombuffer(x, dtype=np.uint64) for x in group["items"]]
        found = touching(sets, group["component"].to_numpy(), group["side"].to_numpy(), percent)
        return pd.DataFrame({"a": found[:, 0], "b": found[:, 1]}) if len(found) else pd.DataFrame({"a": [], "b": []}, dtype="int64")

    return run


def _one_node_a_set(rows: DataFrame) -> DataFrame:
    """Add ``rep``, the smallest id with the same shingle set, without one task that sees all copies."""
    keys = ["digest", "n"]
    leaf = rows.withColumn("leaf", F.pmod(F.xxhash64("doc_id"), F.lit(LEAVES)))
    leaf_least = leaf.groupBy("leaf", *keys).agg(F.min("doc_id").alias("rep"))
    least = leaf_least.groupBy(*keys).agg(F.min("rep").alias("rep"))
    answers = leaf_least.drop("rep").join(least, keys)
    return leaf.join(answers, ["leaf", *keys]).drop("leaf")


def near_duplicate_groups(
    docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id, n_shingles, component_id, kept``.

    Words are separated by ASCII white space, A-Z lower-cased; a document's set holds its distinct ``width``-word
    shingles, or its whole word sequence if it is shorter.  Documents are linked when ``100 * intersection >= percent *
    union``.  ``component_id`` is the smallest id reachable by links.  Null or empty texts have an empty set and link with
    nothing, rows with a null id likewise (``component_id`` null, kept).  Repeated rows are one document.  An empty table
    gives an empty result.
    """
    spark = docs.sparkSession
    arrow_batches(spark)
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sketch = read.mapInArrow(_sketch(width, bands, rows), "doc_id long, n long, digest binary, bands array<long>")
    sketch = stage(sketch, "sketch")
    nodes = stage(_one_node_a_set(sketch.where("doc_id is not null and n > 0")), "nodes")

    reps = nodes.where("doc_id = rep").dropDuplicates(["doc_id"])
    keyed = reps.select("doc_id", "n", F.explode("bands").alias("bucket"))
    heads = keyed.groupBy("bucket").agg(F.count("*").alias("members"), F.min(F.struct("doc_id", "n")).alias("head"))
    heads = heads.where("members > 1").select("bucket", "members", "head")
    members = stage(keyed.join(heads, "bucket"), "members")

    # sets of different size can only be linked if the smaller has percent of the larger
    fits = F.lit(100) * F.least("n", "head.n") >= F.lit(percent) * F.greatest("n", "head.n")
    pairs = members.where((F.col("head.doc_id") != F.col("doc_id")) & fits)
    pairs = pairs.select(F.col("head.doc_id").alias("a"), F.col("doc_id").alias("b")).distinct()
    wanted = members.select(F.col("doc_id").alias("__id")).distinct()
    texts = read.join(small_side(wanted), F.col("doc_id") == F.col("__id"), "left_semi")
    sets = stage(texts.mapInArrow(_full_sets(width), "doc_id long, items binary").dropDuplicates(["doc_id"]), "sets")
    with_b = pairs.join(sets.select(F.col("doc_id").alias("b"), F.col("items").alias("items_b")), "b")
    with_both = with_b.join(sets.select(F.col("doc_id").alias("a"), F.col("items").alias("items_a")), "a")
    stars = stage(with_both.select("a", "b", "items_a", "items_b").mapInArrow(_linked(percent), "a long, b long"), "stars")
    components = stage(connected_components(stars), "components")

    # what no head has settled: the other members of buckets that hold more than one component, in classes of set sizes.
    # A class and the one above it hold all that a set can be linked with, so that each set is in two of them.
    rest = members.where((F.col("members") > 2) & (F.col("head.doc_id") != F.col("doc_id"))).join(
        components.withColumnRenamed("node", "doc_id"), "doc_id", "left"
    )
    step = math.log(100 / percent) * (1 + 1e-6)  # a little more than linked sets can differ by
    size_class = F.floor(F.log(F.col("n")) / step).cast("int") if percent < 100 else F.col("n").cast("int")
    rest = rest.select("bucket", "doc_id", "n", F.coalesce("component", "doc_id").alias("component"), size_class.alias("size_class"))
    rest = rest.withColumn("size_class", F.explode(F.array(F.col("size_class"), F.col("size_class") + 1)))
    mixed = rest.groupBy("bucket", "size_class").agg(
        F.min("component").alias("low"), F.max("component").alias("high"),
        F.bit_xor(F.xxhash64("doc_id")).alias("mark"), F.sum(F.xxhash64("doc_id").cast("decimal(38,0)")).alias("total"),
        F.count("*").alias("docs"), F.sum("n").alias("items"),
    ).where("low <> high")
    # classes of other bands with the same members need no second look
    mixed = mixed.groupBy("mark", "total", "docs", "items").agg(F.min(F.struct("bucket", "size_class")).alias("first"))
    chunks = F.ceil(F.greatest(F.col("docs") / CHUNK, F.col("items") / CHUNK_ITEMS)).cast("int")
    mixed = mixed.select("first.bucket", "first.size_class", F.least(chunks, F.col("docs").cast("int")).alias("chunks"))
    rest = rest.join(mixed, ["bucket", "size_class"])
    rest = rest.withColumn("chunk", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.col("chunks")).cast("int"))
    rest = rest.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    rest = rest.select(
        "bucket", "size_class", "doc_id", "component", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"),
        F.when(F.col("chunk") == F.col("other"), 2).when(F.col("chunk") < F.col("other"), 0).otherwise(1).alias("side"),
    )
    blocks = rest.join(sets, "doc_id").groupBy("bucket", "size_class", "i", "j")
    across = stage(blocks.applyInPandas(_chunk_pairs(percent), "a long, b long").distinct(), "across")
    merged = connected_components(across).select(F.col("node").alias("component"), F.col("component").alias("root"))
    final = components.join(merged, "component", "left").select("node", F.coalesce("root", "component").alias("component"))
    alone = merged.join(components, F.col("node") == merged["component"], "left_anti")
    final = final.union(alone.select(F.col("component").alias("node"), F.col("root").alias("component")))

    named = nodes.select("doc_id", "n", "rep").join(final.withColumnRenamed("node", "rep"), "rep", "left")
    named = named.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "rep").alias("component_id"))
    bare = sketch.where("doc_id is null or n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return named.union(bare).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_one_of_each_group(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` whose document is its group's smallest id, or whose id is null; all columns stay.

    Rows are found by the ids that go, so texts are not shuffled while those are few enough to be sent around.  Null and
    empty texts are no copies of each other; repeated rows of a kept id all stay; an empty table gives an empty result.
    """
    key = unused("id", docs)
    groups = stage(near_duplicate_groups(docs, width, percent).where("doc_id is not null").select(F.col("doc_id").alias(key), "kept"), "groups")
    gone = groups.groupBy(key).agg(F.bool_or("kept").alias("kept")).where("not kept").select(key)
    left = docs.withColumn(key, F.col("doc_id").cast("long"))
    return left.join(small_side(gone), key, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
