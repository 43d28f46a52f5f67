"""What the operators ask of a Spark session: a shared folder, cut lineage, small Arrow batches and keys."""

from __future__ import annotations

import gc
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import ship

LAST = 2**63 - 1


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or on a single machine one of our own."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not sc.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
            folder = tempfile.mkdtemp(prefix="gristmill-")
        sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """df, computed once and read back from the shared folder; Spark removes the files once nothing refers to them."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """df as a Parquet table in the shared folder, and its path, for intermediate tables that are too large for checkpoint()'s row format."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.parquet(path), path


def remove(spark: SparkSession, path: str) -> None:
    """Removes a table that nothing reads any more."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def done_with(spark: SparkSession, *paths: str) -> None:
    """Removes tables that nothing reads any more, and has Spark's cleaner look for shuffle files that nothing refers to any more."""
    for path in paths:
        remove(spark, path)
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def small_batches(spark: SparkSession, rows: int = 1024, megabytes: int = 16) -> None:
    """Sends the package to the executors, and lowers what an Arrow batch of the session may hold, if it is more; a smaller setting stays.

    The setting is read when a plan runs, long after an operator has returned it, so it can't be put back. Workers cut batches up themselves
    (in_pieces) and don't depend on it; it bounds what the JVM holds for them.
    """
    ship(spark)
    if not 0 < int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= rows:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    size = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    if not 0 < int(re.sub(r"\D", "", size)) * {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}.get(size.lower().rstrip("b")[-1:], 1) <= megabytes << 20:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", f"{megabytes}m")


def key_of(column: str):
    """An id that joins and sorts where a null would not: nulls come last, as the largest long."""
    return F.coalesce(F.col(column).cast("long"), F.lit(LAST))
