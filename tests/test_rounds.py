"""Rounds of joins keep no product of sizes on the driver, and trimming finds the same levels as a plain walk."""

from gristmill.operators import graph


def test_sizes_do_not_multiply(spark):
    """Of a chain of 300 the estimated size had more than a thousand digits after nine rounds; on larger graphs it filled the driver's memory."""
    found = graph.redirected(spark.range(300).selectExpr("id as src", "id + 1 as dst"))
    assert {tuple(r) for r in found.collect()} == {(k, 300, 300 - k) for k in range(300)}
    assert len(str(found._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) < 25


def test_levels_of_trimmed_tasks(spark):
    n, rings = 150, [(0, 1), (1, 4), (4, 13), (13, 0)]
    edges = {(k, d) for k in range(20, n) for d in (k // 2, k * 5 // 7)} | set(rings)
    level, ring = {}, {x for e in rings for x in e}
    for k in range(n - 1, 19, -1):
        level.setdefault(k, 0)
        for d in (k // 2, k * 5 // 7):
            for x in ring if d in ring else (d,):
                level[x] = max(level.get(x, 0), level[k] + 1)
    got = {r["node"]: (r["level"], r["cyclic"]) for r in graph.levels(spark.createDataFrame(sorted(edges), "src long, dst long"), local=40).collect()}
    assert got == {x: (k, x in ring) for x, k in level.items()}
