"""Where operators read tables, keep intermediate tables and decide about broadcasts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafgraph.session import clear_staged, materialised, shared_folder, ship_package, staged_path, unstage

#: Rows of an Arrow batch.  Texts can be long, so a batch of the default 10,000 rows could hold a gigabyte.
ARROW_ROWS = "2000"
#: Bytes of an Arrow batch; only a single row can be larger.
ARROW_BYTES = str(16 << 20)
#: Largest table that is sent to every executor: ids or hashes of up to this many rows (16 MB at two longs a row).
BROADCAST_ROWS = 1_000_000


__all__ = ["arrow_batches", "clear_staged", "shared_folder", "shuffle_width", "small_side", "stage", "staged_path", "table", "unstage", "unused"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(stem: str, *frames: DataFrame) -> str:
    """A column name that none of the frames has."""
    taken = {c.lower() for df in frames for c in df.columns}
    name = f"__{stem}"
    while name in taken:
        name += "_"
    return name


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it again: lineage ends here and lost executors cost no rerun."""
    return materialised(df, label)


def small_side(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if a count shows that it is small; otherwise as it is, for a shuffled join."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def arrow_batches(spark: SparkSession, rows: str = ARROW_ROWS) -> None:
    """Make the session ready for Python workers: they can import this package, and get batches of bounded rows and bytes.

    Bounds that the session already has stay.
    """
    ship_package(spark)
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000") in (None, "10000"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", "67108864b") in (None, "67108864b", "64MB"):
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
