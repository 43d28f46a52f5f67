"""Session settings and what executors need in order to run this package's functions."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once for each Spark application."""
    sc = spark.sparkContext
    if getattr(sc, "_gristmill_shipped", False):
        return
    root = Path(__file__).resolve().parent
    target = os.path.join(tempfile.mkdtemp(prefix="gristmill-"), "gristmill.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as archive:
        for path in sorted(root.rglob("*")):
            if path.is_file() and path.suffix in (".py", ".json", ".yaml"):
                archive.write(path, f"{root.name}/{path.relative_to(root)}")
    sc.addPyFile(target)
    sc._gristmill_shipped = True


def session(master: str = "local[*]", partitions: int | None = None) -> SparkSession:
    """A session with the settings that this engine's queries expect; on a cluster the deployment's own settings are kept."""
    builder = SparkSession.builder.config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true")
    builder = builder.master(master) if "SPARK_MASTER" not in os.environ else builder
    return (builder.config("spark.sql.shuffle.partitions", str(partitions)) if partitions else builder).getOrCreate()


def cut(df: DataFrame) -> DataFrame:
    """df, computed once into the checkpoint folder; where none is set, a single machine takes one of its own."""
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="gristmill-"))
    return df.checkpoint()


def settled(df: DataFrame) -> DataFrame:
    """df cut as by cut(), for rounds that join what earlier rounds have made: from here on Spark knows its true size.

    A checkpoint keeps the size that was estimated for its plan, which for a join is the product of both sides. Over rounds of joins that number's
    digits double each time, until the driver's memory is full of them. A cached table's size is measured instead.
    """
    conf, adapt = df.sparkSession.conf, "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning"  # else a cached plan keeps all shuffle partitions, however small
    before = conf.get(adapt)
    conf.set(adapt, "true")
    try:
        held = df.persist()
    finally:
        conf.set(adapt, before)
    try:
        held.count()
        return cut(held.select("*"))
    finally:
        held.unpersist()
