"""Documents that arrive as files: each micro-batch is analysed like a table and written under its own number."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from leafgraph.operators import relation

SCHEMA = "doc_id long, text string"


def stream_documents(spark: SparkSession, path: str, schema: str = SCHEMA, max_files: int = 100) -> DataFrame:
    """A stream of ``doc_id, text`` from Parquet files that appear in a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(path)


def token_counts(documents: DataFrame) -> DataFrame:
    """Stateless: tokens of each arriving document by kind."""
    from leafgraph.plans.rules import SPACES, TOKEN

    pieces = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(TOKEN), F.lit(0))
    blank = F.size(F.filter(pieces, lambda t: t.rlike(f"^[{SPACES}]+$")))
    return documents.select("doc_id", F.size(pieces).alias("n_tokens"), (F.size(pieces) - blank).alias("n_semantic"))


def write_relations(documents: DataFrame, names: Iterable[str], target: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Write relations of each micro-batch to ``target/<name>/batch=<number>``.

    A batch that is run again after a failure overwrites what it wrote before, so nothing is counted twice.
    """
    names = list(names)

    def write(batch: DataFrame, number: int) -> None:
        for name in names:
            relation(name, batch).write.mode("overwrite").parquet(f"{target}/{name}/batch={number}")

    writer = documents.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
