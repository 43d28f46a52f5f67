"""Weak components and levels on every path: one task, and rounds of stars and waves."""

import random

import pytest
from pyspark.sql import functions as F

from gristmill.operators import graph


@pytest.mark.parametrize("local", [0, 100_000])
@pytest.mark.parametrize("kind", ["long", "string"])
def test_what_hangs_together(spark, local, kind):
    rng = random.Random(2)
    edges = [(k, k + 1) for k in range(100, 700)] + [(rng.randrange(1000, 1400), rng.randrange(1000, 1400)) for _ in range(150)] + [(5, 5)]
    df = spark.createDataFrame(edges, "src long, dst long").select(F.col("src").cast(kind), F.col("dst").cast(kind)).repartition(6)
    core = {x: {x} for e in edges for x in e}
    for a, b in edges:
        if core[a] is not core[b]:
            core[a] |= core[b]
            for x in core[b]:
                core[x] = core[a]
    name = (lambda x: x) if kind == "long" else str
    assert {r["node"]: r["core"] for r in graph.weak_components(df, local).collect()} == {name(x): min(map(name, c)) for x, c in core.items()}


def test_halving_levels_take_few_jobs(spark):
    n = 60
    edges = {(k, k // 2) for k in range(1, n)} | {(k, k * 5 // 7) for k in range(1, n)}
    df = spark.createDataFrame(sorted(edges), "src long, dst long")
    into = {}
    for a, b in edges:
        if a != b:
            into.setdefault(b, []).append(a)
    level = {}
    for k in range(n - 1, -1, -1):
        level[k] = max((level[a] + 1 for a in into.get(k, ())), default=0)
    tracker = spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup(None))
    got = {r["node"]: (r["level"], r["cyclic"]) for r in graph.levels(df, local=70).collect()}
    assert got == {k: (v, k == 0 and (0, 0) in edges) for k, v in level.items()}
    assert len(tracker.getJobIdsForGroup(None)) - before < 250
