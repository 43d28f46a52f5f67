"""Where queries and their SQL differed: sums whose order is left to chance, and times that were rounded into the next batch."""

import datetime as dt

import duckdb

from gristmill.plans.catalog import ORACLES, QUERIES

START = dt.datetime(2024, 1, 3)  # a multiple of three days since 1970


def both(spark, path, name, rows):
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double").coalesce(1).write.parquet(f"{path}/events.parquet")
    con = duckdb.connect()
    con.execute(f"create view events as select * from '{path}/events.parquet/*.parquet'")
    want = con.execute(ORACLES[name]).df()
    got = QUERIES[name](spark, str(path)).toPandas()[list(want.columns)]
    return [sorted(map(tuple, df.astype(object).where(df.notna(), None).astype(str).values.tolist())) for df in (got, want)]


def test_costs_are_summed_exactly(spark, tmp_path):
    rows = [(k, dt.datetime(2024, 1, 24 + k % 2), 1, "view", 0.1) for k in range(5000)] + [(9000, START, 2, "view", float("nan")), (9001, START, 2, "view", 1.0), (9002, START, 3, "view", 1.00005), (9003, START, 3, "view", 500.0)]
    got, want = both(spark, tmp_path, "cost_rollup", rows)
    assert got == want and ("1", "view", "5000", "500.0", "500.0", "False") in got and [r[3] for r in got][2] == "501.0001"


def test_the_last_half_second_is_its_own_batch(spark, tmp_path):
    rows = [(k if k % 11 else k + 100_000, START + dt.timedelta(hours=k), 1, "view", 1.0) for k in range(1, 24 * 15)]
    rows += [(11 * (20_000 + k), START + dt.timedelta(days=3 * k, seconds=-0.3), 1, "view", 1.0) for k in range(1, 5)]
    got, want = both(spark, tmp_path, "stream_sliding", rows)
    assert got == want and len(got) > 10
