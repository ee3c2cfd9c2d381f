"""Files and tables as documents; results as partitioned Parquet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def load_documents(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, source_path, text`` of text files (a file, a folder or a pattern), one document a file.

    A leading byte order mark is dropped.  A missing path raises when the plan is analysed.
    """
    read = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("source_path"), F.col("value").alias("text"))
    text = F.regexp_replace("text", r"^\x{FEFF}", "")
    return read.select(F.xxhash64("source_path").alias("doc_id"), "source_path", text.alias("text"))


def text_length(text: Column) -> Column:
    """The length of a text in code points; of a null text 0."""
    return F.coalesce(F.length(text), F.lit(0))


def load_table(table: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A table with a text column as ``doc_id, text``; null texts are empty."""
    return table.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def validate_documents(documents: DataFrame) -> DataFrame:
    """``doc_id, rejected``: documents that are blank are not tokenised or parsed."""
    blank = ~F.coalesce(F.col("text"), F.lit("")).rlike(r"\S")
    return documents.select("doc_id", blank.alias("rejected"))


def write_stage(result: DataFrame, path: str, partition_by: str | None = None, mode: str = "overwrite") -> None:
    """Write a result table as Parquet."""
    writer = result.write.mode(mode)
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
