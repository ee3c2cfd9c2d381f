"""Mixing sources to target weights, with DataFrame functions only.

Sizes are added up per source, targets follow from the weights, and each document is emitted floor(rate) times plus once
more when a hash of its id falls below the fraction, where rate = target / size of its source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from leafgraph.llm.store import small_side, stage, unused

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2.0
SEED = "mix-1"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _ranked(per_source: DataFrame) -> DataFrame:
    """Add ``rank`` (from 0) by code point, null last, without one task that sees every source."""
    order = F.col("source").asc_nulls_last()
    # only the columns source and source_size come here
    parts = stage(per_source.repartitionByRange(order).withColumn("__part", F.spark_partition_id()), "sources")
    first = parts.groupBy("__part").agg(F.count("*").alias("__n"))
    offset = F.coalesce(F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    first = first.withColumn("__first", offset).drop("__n")  # a row for each partition at most
    within = F.row_number().over(Window.partitionBy("__part").orderBy(order)) - 1
    return parts.withColumn("__in", within).join(F.broadcast(first), "__part").select(
        "source", "source_size", (F.col("__first") + F.col("__in")).alias("rank")
    )


def source_targets(
    sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP
) -> DataFrame:
    """``sized(source, size)`` to ``source, source_size, target``.

    Sources in code point order, null last, take ``weights`` in turn.  Together they aim at ``share`` of all sizes; a
    target stops at ``cap`` times its source's size and the excess is shared again by weight until none is above.  Only
    sums come to the driver.
    """
    per_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    known = _ranked(per_source).withColumn("weight", weight).withColumn("limit", F.col("source_size") * F.lit(float(cap)))
    known = stage(known, "weights")
    total = known.agg(F.sum("source_size").alias("s")).first()["s"] or 0
    level, capped_before = 0.0, -1
    while True:
        full = F.col("limit") < F.col("weight") * F.lit(level)
        now = known.agg(
            F.count_if(full).alias("capped"),
            F.sum(F.when(full, F.col("limit")).otherwise(0.0)).alias("taken"),
            F.sum(F.when(full, 0).otherwise(F.col("weight"))).alias("open"),
        ).first()
        if now["capped"] == capped_before or not now["open"]:
            break
        capped_before = now["capped"]
        level = (share * total - now["taken"]) / now["open"]
    return known.select("source", "source_size", F.least("limit", F.col("weight") * F.lit(level)).alias("target"))


def _copies(doc_id: Column, source_size: Column, target: Column, seed: str) -> Column:
    rate = F.when(source_size > 0, target / source_size).otherwise(F.lit(0.0))
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    draw = F.conv(F.substring(F.md5(name.cast("binary")), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
    return (F.floor(rate) + (draw < rate - F.floor(rate)).cast("long")).cast("long")


def mix_plan(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP, seed: str = SEED
) -> DataFrame:
    """How often the mix takes each row: ``doc_id, size, source_size, target, copies``.

    Null texts have size 0, a null source is a source of its own, a null id draws like an empty one, and repeated rows
    draw alike.  A table without words gives targets and copies of 0; an empty table an empty plan.
    """
    sized = stage(docs.select("doc_id", "source", n_words(F.col("text")).alias("size")), "sizes")
    targets = small_side(source_targets(sized, weights, share, cap).withColumnRenamed("source", "__source"), 100_000)
    joined = sized.join(targets, F.col("source").eqNullSafe(F.col("__source")))
    copies = _copies(F.col("doc_id"), F.col("source_size"), F.col("target"), seed)
    return joined.select("doc_id", "size", "source_size", "target", copies.alias("copies"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP, seed: str = SEED) -> DataFrame:
    """``docs`` with each row as often as ``mix_plan`` says, and no column more, whatever they are called.

    Texts are not shuffled.  Null and empty texts have size 0 and are taken as often as their source's rate says.
    """
    sized = docs.select("source", n_words(F.col("text")).alias("size"))
    name, total, aim, times, copy = (unused(x, docs) for x in ("mix_source", "mix_size", "mix_target", "mix_copies", "mix_copy"))
    targets = source_targets(sized, weights, share, cap).select(
        F.col("source").alias(name), F.col("source_size").alias(total), F.col("target").alias(aim)
    )
    joined = docs.join(small_side(targets, 100_000), F.col("source").eqNullSafe(F.col(name)))
    repeated = joined.withColumn(times, _copies(F.col("doc_id"), F.col(total), F.col(aim), seed)).where(F.col(times) > 0)
    repeated = repeated.withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), F.col(times))))
    return repeated.select(*[F.col(f"`{c}`") for c in docs.columns])
