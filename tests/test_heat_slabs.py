"""Slabs against the scheme step by step, and how much of it is done."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from gristmill.operators import records

COLUMNS = "id long, half double, alpha double, k double, h double, T0 double, Tinf double, t double"


def stepwise(half, alpha, k, h, t0, tinf, t, nodes=21, fo=0.4):
    dx = half / (nodes - 1)
    biot = h * dx / k
    steps = max(1, int(np.ceil(alpha * t * (1 + biot) / (fo * dx**2))))
    r, f = alpha * t / steps / dx**2, [t0] * nodes
    for _ in range(steps):
        inner = [f[i] + r * (f[i + 1] - 2 * f[i] + f[i - 1]) for i in range(1, nodes - 1)]
        f = [f[0] + 2 * r * (f[1] - f[0]), *inner, f[-1] + 2 * r * (f[-2] - f[-1] + biot * (tinf - f[-1]))]
    return f[0], f[-1], (f[0] / 2 + sum(f[1:-1]) + f[-1] / 2) / (nodes - 1)


def test_slabs_of_one_shape_and_others(spark):
    rows = [(k, 0.004 + 0.003 * (k % 5), 1.4e-7, 0.5, 50.0 + k % 2, 5.0 * (k % 3), 40.0 + k, 300.0 * (k % 4)) for k in range(40)] + [(40, 0.01, 1.4e-7, 0.5, 0.0, 7.0, 7.0, 60.0), (0, 0.01, 1.4e-7, 0.5, 9.0, 3.0, 90.0, 60.0)]
    got = sorted((tuple(r) for r in records.heat_slab(spark.createDataFrame([*rows, (41, None, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0)], COLUMNS), "id").collect()))
    want = sorted((i, *stepwise(*x)) for i, *x in rows)
    assert [g[0] for g in got] == [w[0] for w in want] and np.allclose([g[1:] for g in got], [w[1:] for w in want], rtol=0, atol=1e-9)
    assert records.heat_slab(spark.createDataFrame([], COLUMNS), "id").collect() == []


def test_a_thin_slab_does_not_hold_up_the_thick_ones(spark):
    """One slab of 26,250 steps and 40,000 others of 20 kinds; every row took as many steps before (minutes)."""
    df = spark.range(40_000).select("id", (0.02 + F.col("id") % 20 / 1000).alias("half"), F.lit(1.4e-7).alias("alpha"), F.lit(0.5).alias("k"), F.lit(50.0).alias("h"), F.lit(5.0).alias("T0"), (40 + F.col("id") / 1000).alias("Tinf"), F.lit(600.0).alias("t"))
    began = time.time()
    got = records.heat_slab(df.withColumn("half", F.when(F.col("id") == 7, 0.0018).otherwise(F.col("half"))).coalesce(1), "id")
    assert got.agg(F.count("*"), F.max("mean")).first()[0] == 40_000
    assert time.time() - began < 60
    assert got.where("id = 7").first()["mean"] == pytest.approx(stepwise(0.0018, 1.4e-7, 0.5, 50.0, 5.0, 40.007, 600.0)[2], abs=1e-9)
