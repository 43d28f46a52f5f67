"""Cycles of more than 400 edges are in the SQL too."""

import duckdb
from pyspark.sql import functions as F

from gristmill.plans.catalog import ORACLES, QUERIES


def test_long_cycles(spark, tmp_path):
    spark.range(60_000).select(F.col("id").alias("s_suppkey")).coalesce(1).write.parquet(str(tmp_path / "supplier.parquet"))
    con = duckdb.connect()
    con.execute(f"create view supplier as select * from '{tmp_path}/supplier.parquet/*.parquet'")
    for name in ("edge_cycles", "broken_cycles"):
        got = sorted(map(tuple, QUERIES[name](spark, str(tmp_path)).collect()))
        want = sorted(con.execute(ORACLES[name]).fetchall())
        assert got == want and len(got) == 28
        assert name != "edge_cycles" or max(n for _, n in want) == 730
