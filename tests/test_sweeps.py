"""Intervals by sweep and frames over hot groups, against plain code."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from gristmill.operators import tables

SPANS = "start double, end double, name string, ord int"


@pytest.mark.parametrize("count", [0, 1, 25, 3000])
def test_fractions(spark, count):
    rng = np.random.default_rng(count)
    spans = [(s := float(round(rng.uniform(-50, 50), 1)), s + float(round(abs(rng.normal(0, 8)), 1)), f"n{k}", k // 2) for k in range(count)] + [(None, 3.0, "null", 99), (9.0, 8.0, "back", 99)] * (count > 1)
    places = [-900.5, 900.5, *[float(round(x, 1)) for x in rng.uniform(-60, 60, 300)], *[s[0] for s in spans[:20] if s[0] is not None], *[s[1] for s in spans[:20]]]
    points = spark.createDataFrame([(k, p) for k, p in enumerate(places)] + [(-1, None)], "id long, p double")
    got = {r["id"]: r["name"] for r in tables.in_interval(points, "p", spark.createDataFrame(spans, SPANS)).collect()}
    best = lambda p: max(((o, n) for s, e, n, o in spans if s is not None and s <= p <= e), default=(0, None))[1]
    assert got == {-1: None} | {k: best(p) for k, p in enumerate(places)}


def test_nested_intervals_and_a_hot_point(spark):
    n = 20_000
    spans = spark.range(n).select((-F.col("id") - 0.5).alias("start"), (F.col("id") + 0.5).alias("end"), F.concat(F.lit("n"), "id").alias("name"), (n - F.col("id")).cast("int").alias("ord"))
    points = spark.range(40_000).select("id", F.when(F.col("id") % 2 == 0, F.lit(7.25)).otherwise(F.col("id") - 20_000.0).alias("p"))
    found = tables.in_interval(points, "p", spans)
    wrong = found.where(~F.col("name").eqNullSafe(F.when(F.abs("p") <= n - 0.5, F.concat(F.lit("n"), F.ceil(F.abs("p") - 0.5).cast("string")))))
    assert found.count() == 40_000 and wrong.count() == 0
    assert "NestedLoop" not in found._jdf.queryExecution().executedPlan().toString()


def test_blocks_cover_each_number_once(spark):
    pairs = [(a, b) for a in range(20) for b in range(a, 20)]
    df = spark.createDataFrame(pairs, "a int, b int").select("a", "b", tables._blocks(F.col("a"), F.col("b"), range(6)).alias("x"))
    for r in df.collect():
        assert sorted(k for x in r["x"] for k in range(x["block"] << x["level"], (x["block"] + 1) << x["level"])) == list(range(r["a"], r["b"]))


def test_rolling_over_a_hot_group(spark):
    rng = np.random.default_rng(3)
    rows = [("hot", int(t), float(v)) for t, v in zip(rng.integers(0, 3000, 6000), rng.integers(0, 9, 6000))] + [("cold", 5, 1.0), ("cold", 5, 2.0), (None, 5, 4.0), (None, 25, 1.0), ("cold", None, 1.0)]
    df = spark.createDataFrame(rows, "g string, t long, v double").repartition(4)
    got = {(r["g"], r["t"]): (r["n"], r["s"]) for r in tables.rolling(df, ["g"], "t", "v", 20, "s").collect()}
    want = {}
    for g, t in {(g, t) for g, t, _ in rows if t is not None}:
        near = [v for h, u, v in rows if h == g and u is not None and t - 20 <= u <= t]
        want[g, t] = (sum(h == g and u == t for h, u, _ in rows), sum(near))
    assert got == want
    assert tables.rolling(df.limit(0), ["g"], "t", "v", 20, "s").count() == 0
