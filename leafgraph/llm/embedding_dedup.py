"""Near-duplicate vectors: spherical k-means cells, blocked cosine products inside them, one representative a group.

Cells are the half-space intersections of k centroids, fitted on a bounded sample.  A vector lives in the cell of its best
centroid and visits each cell of lower number that a vector within the threshold's angle of it could live in: on the
sphere, the angle to any vector beyond the plane between two centroids is at least the angle to that plane.  So every pair
at or above the threshold meets in exactly one cell, and the cells lose no link.

Equal vectors are one node throughout.  A cell is cut into chunks, and a task compares two chunks as one blocked product,
whose pairs it turns into counts and a spanning forest at once.  The product is taken first over a few leading principal
components and one more for the length of the rest: by Cauchy and Schwarz that bounds the cosine from above, and only the
pairs it lets through are multiplied out in double precision.  Vectors travel as the numbers they came as.
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
from leafgraph.llm.store import arrow_batches, small_side, stage

THRESHOLD = 0.95
#: Vectors the centroids are fitted on (10 MB at 64 components), the most vectors a cell should hold, the cells that a
#: small table is divided into anyway so that all cores have work, and the most cells.
SAMPLE = 20_000
CELL = 32_768
LEAST_CELLS = 8
MAX_CELLS = 4096
#: Vectors of one side of a product, and of the rows of it that are held at once.
CHUNK = 32_768
STRIP = 256
#: One in so many components leads.
LEADING = 4
LEAVES = 64
_SLACK = 1e-9


def _unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _prepared(kind: str):
    """Rows of (id, dim, digest, vector): the components as bytes; no digest for a vector that links with nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, digests, vectors = [], [], []
            for v in batch.column("embedding"):
                raw = v.values if v.is_valid else None
                x = np.empty(0) if raw is None or raw.null_count else raw.to_numpy(zero_copy_only=False).astype(kind) + 0.0
                good = len(x) > 0 and bool(np.isfinite(x).all()) and bool(x.any())
                dims.append(len(x))
                vectors.append(x.tobytes() if good else None)
                digests.append(hashlib.blake2b(vectors[-1], digest_size=16).digest() if good else None)
            columns = [batch.column("vec_id"), pa.array(dims, pa.int32()), pa.array(digests, pa.binary()), pa.array(vectors, pa.binary())]
            yield pa.record_batch(columns, names=("vec_id", "dim", "digest", "vector"))

    return run


def _stacked(vectors: list[bytes], kind: str) -> np.ndarray:
    return _unit(np.frombuffer(b"".join(vectors), dtype=kind).reshape(len(vectors), -1))


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 12, seed: int = 1) -> np.ndarray:
    """``k`` unit centroids of unit vectors ``x``, by cosine; an emptied cluster takes the worst placed vector."""
    rng = np.random.default_rng(seed)
    centroids = x[rng.choice(len(x), size=min(k, len(x)), replace=False)]
    for _ in range(rounds):
        score = x @ centroids.T
        home = score.argmax(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, home, x)
        empty = np.flatnonzero(np.bincount(home, minlength=len(centroids)) == 0)
        sums[empty] = x[score.max(axis=1).argsort()[: len(empty)]]
        length = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
        centroids = np.where(length > 0, sums / np.maximum(length, 1e-300), centroids)
    return centroids


def _cells(centroids: dict[int, np.ndarray], threshold: float, kind: str):
    """Rows of (cell, visitor, id, copies, vector): where each vector lives and which cells it visits."""
    reach = math.sqrt(max(0.0, 1.0 - threshold * threshold)) + _SLACK if threshold > 0 else math.inf

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apart = {d: np.sqrt(np.maximum(2.0 - 2.0 * np.clip(c @ c.T, -1.0, 1.0), 0.0)) for d, c in centroids.items()}
        for batch in batches:
            size, vectors = batch.column("dim").to_numpy(), batch.column("vector")
            for dim in np.unique(size).tolist():
                own = np.flatnonzero(size == dim)
                c = centroids.get(dim)
                if c is None:
                    row, cell = np.arange(len(own)), np.zeros(len(own), dtype=np.int64)
                    home = cell
                else:
                    score = _stacked(vectors.take(pa.array(own)).to_pylist(), kind) @ c.T
                    home = score.argmax(axis=1)
                    gap = score[np.arange(len(own)), home][:, None] - score
                    near = gap <= reach * apart[dim][home] + _SLACK
                    near &= np.arange(len(c))[None, :] <= home[:, None]
                    near[np.arange(len(own)), home] = True
                    row, cell = np.nonzero(near)
                for at in range(0, len(row), 4096):
                    r, z = row[at : at + 4096], cell[at : at + 4096]
                    sent = batch.select(["rep", "copies", "vector"]).take(pa.array(own[r]))
                    columns = [pa.array(np.full(len(r), dim, dtype=np.int32)), pa.array(z.astype(np.int32)), pa.array(z != home[r])]
                    yield pa.record_batch([*columns, *sent.columns], names=("dim", "cell", "visitor", "rep", "copies", "vector"))

    return run


def leading_components(x: np.ndarray) -> np.ndarray:
    """Orthonormal columns: the principal components of unit vectors ``x``, one for every ``LEADING`` of their components."""
    _, vectors = np.linalg.eigh(x.T @ x)
    return vectors[:, ::-1][:, : max(1, x.shape[1] // LEADING)]


def _bounding(x: np.ndarray, leading: np.ndarray) -> np.ndarray:
    """Vectors whose products bound the cosines of ``x`` from above, up to the rounding of single precision."""
    led = x @ leading
    rest = np.sqrt(np.maximum(1.0 - (led * led).sum(axis=1, keepdims=True), 0.0))
    return np.hstack([led, rest]).astype(np.float32)


def linked(x: np.ndarray, y: np.ndarray, low_x: np.ndarray, low_y: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of ``x`` and ``y`` with a cosine of ``threshold`` or more."""
    i, j = np.nonzero(low_x @ low_y.T >= threshold - 1e-4)
    if 8 * len(i) > len(x) * len(y):
        return np.nonzero(x @ y.T >= threshold)
    hit = np.empty(len(i), dtype=bool)
    for at in range(0, len(i), 1 << 16):
        part = slice(at, at + (1 << 16))
        hit[part] = np.einsum("ij,ij->i", x[i[part]], y[j[part]]) >= threshold
    return i[hit], j[hit]


def _hook(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Make ``label`` agree along the pairs: each node points to the smallest index it is connected to."""
    while True:
        a, b = label[i], label[j]
        differ = a != b
        if not differ.any():
            return
        i, j, a, b = i[differ], j[differ], a[differ], b[differ]
        low = np.minimum(a, b)
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        while (label[label] != label).any():
            label[:] = label[label]


def _product(threshold: float, kind: str, leading: dict[int, np.ndarray]):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["side", "rep"], kind="stable").reset_index(drop=True)
        x = _stacked(group["vector"].tolist(), kind)
        ids, copies, side = (group[c].to_numpy() for c in ("rep", "copies", "side"))
        lead = leading.get(x.shape[1])
        low = _bounding(x, leading_components(x) if lead is None else lead)
        own = bool((side == 2).any())
        cut = len(group) if own else int((side == 0).sum())
        links = np.zeros(len(group), dtype=np.int64)
        label = np.arange(len(group))
        for at in range(0, cut, STRIP):
            end = min(at + STRIP, cut)
            begin = at if own else cut
            i, j = linked(x[at:end], x[begin:], low[at:end], low[begin:], threshold)
            if own:
                i, j = i[i < j], j[i < j]
            if len(i):
                i, j = i + at, j + begin
                links += np.bincount(i, weights=copies[j], minlength=len(group)).astype(np.int64)
                links += np.bincount(j, weights=copies[i], minlength=len(group)).astype(np.int64)
                _hook(label, i, j)
        some = np.flatnonzero(links)
        return pd.DataFrame({"rep": ids[some], "links": links[some], "least": ids[label[some]]})

    return run


def vector_groups(vectors: DataFrame, threshold: float = THRESHOLD, sample: int = SAMPLE, cell: int | None = None) -> DataFrame:
    """One row for each row of ``vectors(vec_id, embedding)``: ``vec_id, n_links, component_id, kept``.

    ``n_links`` counts the other rows with a cosine of ``threshold`` or more, ``component_id`` is the smallest id
    reachable by such links and ``kept`` marks that one.  Vectors that are null, empty, zero or hold null or non-finite
    components, and rows with a null id, link with nothing (a null id is kept); so do vectors of different length.
    Repeated rows count as rows of their own that are linked.  An empty table gives an empty result.  ``cell`` is the
    number of vectors a cell should hold.
    """
    spark = vectors.sparkSession
    arrow_batches(spark)
    kind = "<f4" if dict(vectors.dtypes)["embedding"] == "array<float>" else "<f8"
    read = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<float>" if kind == "<f4" else "array<double>"))
    rows = read.mapInArrow(_prepared(kind), "vec_id long, dim int, digest binary, vector binary")
    rows = stage(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")  # written, so that the numbers stay
    fit = F.col("digest").isNotNull() & F.col("vec_id").isNotNull()
    leaf = rows.where(fit).select("vec_id", "row", "dim", "digest", F.pmod(F.xxhash64("row"), F.lit(LEAVES)).alias("leaf"))
    leaf_least = leaf.groupBy("leaf", "dim", "digest").agg(F.min(F.struct("vec_id", "row")).alias("first"), F.count("*").alias("copies"))
    least = leaf_least.groupBy("dim", "digest").agg(F.min("first").alias("first"), F.sum("copies").alias("copies"))
    least = stage(least.select("dim", "digest", F.col("first.vec_id").alias("rep"), F.col("first.row").alias("row"), "copies"), "least")
    answers = leaf_least.select("leaf", "dim", "digest").join(least.drop("row"), ["dim", "digest"])
    nodes = stage(leaf.join(answers, ["leaf", "dim", "digest"]).select("vec_id", "rep", "copies"), "vector-nodes")
    first = stage(rows.select("row", "dim", "vector").join(small_side(least.select("row", "rep", "copies")), "row"), "vector-reps")

    dims = least.groupBy("dim").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dim").limit(64).collect()
    centroids: dict[int, np.ndarray] = {}
    leading: dict[int, np.ndarray] = {}
    for dim, n in ((r["dim"], r["n"]) for r in dims):
        k = min(MAX_CELLS, math.ceil(n / (cell or max(1024, min(CELL, math.ceil(n / LEAST_CELLS))))))
        if k > 1:
            share = min(1.0, sample / n)
            drawn = first.where((F.col("dim") == dim) & (F.pmod(F.xxhash64("rep", F.lit("k-means")), F.lit(1 << 30)) < int(share * (1 << 30))))
            drawn = drawn.select("vector", F.xxhash64("rep").alias("h")).orderBy("h").limit(sample).toPandas()
            x = _stacked(drawn["vector"].tolist(), kind)
            centroids[dim], leading[dim] = spherical_kmeans(x, k), leading_components(x)
    placed = stage(
        first.mapInArrow(_cells(centroids, threshold, kind), "dim int, cell int, visitor boolean, rep long, copies long, vector binary"),
        "cells",
    )
    counts = placed.groupBy("dim", "cell").agg(
        F.ceil(F.count_if(~F.col("visitor")) / CHUNK).cast("int").alias("live"),
        F.ceil(F.count_if("visitor") / CHUNK).cast("int").alias("call"),
    )
    # a resident meets each chunk of residents and of visitors, a visitor each chunk of residents
    sized = placed.join(small_side(counts), ["dim", "cell"])
    draw = F.xxhash64("rep", F.lit("chunk"))
    sized = sized.withColumn("chunk", F.pmod(draw, F.when(F.col("visitor"), F.col("call")).otherwise(F.col("live"))).cast("int"))
    spread = F.sequence(F.lit(0), F.when(F.col("visitor"), F.col("live")).otherwise(F.col("live") + F.col("call")) - 1)
    sized = sized.where("live > 0").withColumn("other", F.explode(spread))
    resident_pair = ~F.col("visitor") & (F.col("other") < F.col("live"))
    sized = sized.select(
        "dim", "cell", "rep", "copies", "vector",
        F.when(F.col("visitor"), F.col("other")).when(resident_pair, F.least("chunk", "other")).otherwise(F.col("chunk")).alias("i"),
        F.when(F.col("visitor"), F.col("live") + F.col("chunk")).when(resident_pair, F.greatest("chunk", "other")).otherwise(F.col("other")).alias("j"),
        F.when(F.col("visitor"), 1).when(~resident_pair, 0).when(F.col("chunk") == F.col("other"), 2)
        .when(F.col("chunk") < F.col("other"), 0).otherwise(1).alias("side"),
    )
    found = sized.groupBy("dim", "cell", "i", "j").applyInPandas(_product(threshold, kind, leading), "rep long, links long, least long")
    found = stage(found, "vector-links")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    components = connected_components(found.select(F.col("rep").alias("a"), F.col("least").alias("b")))
    of_rep = links.join(components.withColumnRenamed("node", "rep"), "rep", "left")
    linked = nodes.join(of_rep, "rep", "left").select(
        "vec_id",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links"),
        F.coalesce("component", "rep").alias("component_id"),
    )
    bare = rows.where(~fit).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.union(bare).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
