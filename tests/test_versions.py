"""Tables of versions: whole or not there, whatever happens to a writer."""

import pytest
from pyspark.sql import functions as F

from gristmill.sources import files


def test_a_broken_write_is_no_version(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.range(10).select("id", F.lit("a").alias("v"))
    files.upserted(spark, path, first, ["id"])
    with pytest.raises(Exception, match="broken"):
        files.upserted(spark, path, spark.range(12).select("id", F.when(F.col("id") == 11, F.raise_error(F.lit("broken"))).otherwise("b").alias("v")), ["id"])
    (tmp_path / "t" / "v=2").mkdir()  # what a writer of another kind left half-way
    (tmp_path / "t" / "v=2" / "part-0.parquet").write_bytes(b"half")
    assert files._versions(spark, path) == [1]
    (tmp_path / "t" / "v=2" / "part-0.parquet").unlink()
    (tmp_path / "t" / "v=2").rmdir()
    new = files.upserted(spark, path, spark.range(8, 12).select("id", F.lit("b").alias("v")), ["id"])
    assert new.endswith("v=2") and {(r["id"], r["v"]) for r in spark.read.parquet(new).collect()} == {(k, "a" if k < 8 else "b") for k in range(12)}


def test_two_writers(spark, tmp_path, monkeypatch):
    """Another writer finishes between this one's reading and its renaming: this one begins again from what it wrote."""
    path = str(tmp_path / "t")
    files.upserted(spark, path, spark.range(3).select("id", F.lit("a").alias("v")), ["id"])
    plain, raced = files._renamed, []

    def late(spark, before, after):
        if not raced:
            raced.append(True)
            files.upserted(spark, path, spark.createDataFrame([(1, "other")], "id long, v string"), ["id"])
        return plain(spark, before, after)

    monkeypatch.setattr(files, "_renamed", late)
    new = files.upserted(spark, path, spark.createDataFrame([(2, "mine")], "id long, v string"), ["id"])
    assert new.endswith("v=3") and {(r["id"], r["v"]) for r in spark.read.parquet(new).collect()} == {(0, "a"), (1, "other"), (2, "mine")}
    assert not list((tmp_path / "t").glob("_writing*"))
