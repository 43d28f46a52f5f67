"""Distinct counts over a path where keys are there twice, and how many rows one task gets."""

import duckdb
from pyspark.sql import functions as F

from gristmill.operators import tables as ops
from gristmill.plans import catalog


def test_distinct_counts_over_rows_that_are_there_twice(spark, tmp_path):
    made = {
        "region": ([(0, "ASIA"), (1, "EUROPE")], "r_regionkey int, r_name string"),
        "nation": ([(k, f"n{k % 70:02d}", int(k == 69)) for k in range(72)], "n_nationkey int, n_name string, n_regionkey int"),
        "customer": ([(k, k % 72) for k in range(144)], "c_custkey long, c_nationkey int"),
        "orders": ([(k // 2 * 2, k % 144) for k in range(1440)] + [(k, k % 144) for k in range(0, 1440, 6)], "o_orderkey long, o_custkey long"),
        "lineitem": ([(k % 1440, k * 7 % 53) for k in range(5000)], "l_orderkey long, l_partkey long"),
        "part": ([(k, f"t{k % 9}") for k in range(45)], "p_partkey long, p_type string"),
    }
    db = duckdb.connect()
    for name, (rows, kinds) in made.items():
        spark.createDataFrame(rows, kinds).write.parquet(f"{tmp_path}/{name}.parquet")
        db.sql(f"create view {name} as select * from '{tmp_path}/{name}.parquet/*.parquet'")
    got = sorted(tuple(r) for r in catalog.path_distinct_counts(spark, str(tmp_path)).collect())
    assert got == sorted(db.sql(catalog.ORACLES["path_distinct_counts"]).fetchall()) and len(got) > 64


def test_more_rows_are_more_tasks(spark):
    df = spark.range(10_000)
    tasks = ops.tasks_for(df, 500)
    assert tasks >= 20 and ops.tasks_for(df) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert df.repartition(tasks, "id").groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0] < 1000
