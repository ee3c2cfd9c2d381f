"""Session helpers shared by all parts of the library."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_PACKAGE = Path(__file__).resolve().parent


def ship_package(spark: SparkSession) -> None:
    """Send this package's modules to the executors, once a Spark application, so that Python workers can import it."""
    context = spark.sparkContext
    if getattr(context, "_leafgraph_shipped", False):
        return
    handle, path = tempfile.mkstemp(prefix="leafgraph-", suffix=".zip")
    os.close(handle)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for module in sorted(_PACKAGE.rglob("*.py")):
            archive.write(module, str(module.relative_to(_PACKAGE.parent)))
    context.addPyFile(path)
    context._leafgraph_shipped = True


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; where it is unset and all runs in this process (tests), a folder of its own.

    On a cluster a machine's own folder would scatter the parts of a table over the executors, so that is refused.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="leafgraph-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


#: Tables that were written for a plan and not deleted since, by path.
_staged: dict[str, SparkSession] = {}


def staged_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder, deleted with the tables written for plans."""
    path = f"{shared_folder(spark)}/leafgraph/{uuid.uuid4().hex}-{label}"
    _staged[path] = spark
    return path


@contextmanager
def _shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What a query shuffles inside is deleted when it ends; otherwise it stays until the driver collects its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def append(df: DataFrame, path: str) -> None:
    """Add ``df`` to a table in the shared folder."""
    with _shuffles_dropped(df.sparkSession):
        df.write.mode("append").option("compression", "zstd").parquet(path)


def materialised(df: DataFrame, label: str, lean: bool = False) -> DataFrame:
    """``df`` written to the shared folder and read again, for a table that several branches of a plan read.

    ``lean`` spares disk: the table is written smaller, and what writing it shuffles is dropped at once.
    """
    spark = df.sparkSession
    path = staged_path(spark, label)
    if lean:
        append(df, path)
    else:
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_at = path
    return out


def unstage(df: DataFrame) -> None:
    """Delete the table that ``materialised`` wrote for this very frame.  Frames that read it can't be used afterwards."""
    _delete(getattr(df, "_staged_at", None))


def clear_staged() -> None:
    """Delete all tables that were written for plans.  Frames that read them can't be used afterwards."""
    for path in list(_staged):
        _delete(path)


def _delete(path: str | None) -> None:
    spark = _staged.pop(path, None)
    if spark is not None and spark.sparkContext._jsc is not None:
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
