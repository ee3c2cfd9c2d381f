"""A corpus pipeline: five stages over ``documents``, each written as Parquet and read again by the next.

Part of the subpackage ``leafgraph.llm``: it goes where that goes.  Every stage but the last returns the columns that it
got, whatever else they are called.  An empty table passes through all stages and stays empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafgraph.llm import exact_dedup, minhash_dedup, mixing, piece_codec, toxicity
from leafgraph.llm.store import stage, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learn from the labelled documents, and drop the documents that score 0.5 or more.

    Null and empty texts match nothing and stay; so do rows with a null id, unless their text is toxic.
    """
    return toxicity.drop_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the smallest id of equal texts: null and empty texts are equal, a null id comes last, one of repeated rows stays."""
    return exact_dedup.drop_exact_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the smallest id of each group of near duplicates (five words, 0.8); texts without words and null ids stay."""
    return minhash_dedup.keep_one_of_each_group(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or drop documents so that sources come near their target weights; a null source is a source of its own."""
    return mixing.mix(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode what is left with merge-dropout and decode it again: ``doc_id, n_pieces, pieces``, a row for each row of the mix.

    A row whose pieces do not spell its text ends the run with an error.
    """
    encoded = piece_codec.round_trip(docs)
    lost = F.raise_error(F.concat(F.lit("pieces do not spell the text of document "), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    whole = encoded.where(F.when(F.col("lossless"), F.lit(True)).otherwise(lost.cast("boolean")))
    return whole.select("doc_id", F.size("pieces").cast("long").alias("n_pieces"), "pieces")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("minhash_dedup", drop_near_copies),
    ("source_mixing", mix_sources),
    ("piece_codec", encode_pieces),
]

#: Learned scores and merge-dropout can't be written in SQL; tests/llm holds the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage_of in STAGES:
        docs = stage(stage_of(spark, docs, sf_dir), name)
    return docs
