"""Strong components, levels and cycles against plain searches, on every path through the code."""

import random

import pytest

from gristmill.operators import graph


def plain(edges):
    out, nodes = {}, {x for e in edges for x in e}
    for a, b in edges:
        out.setdefault(a, set()).add(b)

    def reach(x):
        seen, todo = set(), [x]
        while todo:
            for y in out.get(todo.pop(), ()):
                if y not in seen:
                    seen.add(y)
                    todo.append(y)
        return seen

    ways = {x: reach(x) for x in nodes}
    scc = {x: min({x} | {y for y in ways[x] if x in ways[y]}) for x in nodes}
    above = {(scc[a], scc[b]) for a, b in edges if scc[a] != scc[b]}
    level = {}

    def far(x):
        if x not in level:
            level[x] = max((far(a) + 1 for a, b in above if b == x), default=0)
        return level[x]

    return {x: (scc[x], x in ways[x]) for x in nodes}, {x: far(scc[x]) for x in nodes}


GRAPHS = {
    "sparse": lambda rng: [(rng.randrange(40), rng.randrange(40)) for _ in range(45)],
    "dense": lambda rng: [(rng.randrange(12), rng.randrange(12)) for _ in range(60)],
    "rings and tails": lambda rng: [(k, (k + 1) % 7) for k in range(7)] + [(10 + k, 11 + k) for k in range(9)] + [(19, 3), (5, 30), (30, 31), (31, 32), (40, 41), (41, 40), (50, 50), (32, 50)],
    "empty": lambda rng: [],
}


@pytest.mark.parametrize(("kind", "local"), [*[(k, 100_000) for k in GRAPHS], ("rings and tails", 15)])
def test_against_plain_search(spark, kind, local):
    edges = GRAPHS[kind](random.Random(4))
    df = spark.createDataFrame([*edges, (None, 1), (1, None)], "src long, dst long")
    scc, level = plain(edges)
    assert {r["node"]: (r["scc"], r["cyclic"]) for r in graph.strong_components(df, local).collect()} == scc
    if kind != "dense" and local > 15:
        assert {r["node"]: (r["level"], r["cyclic"]) for r in graph.levels(df, local).collect()} == {x: (n, scc[x][1]) for x, n in level.items()}
    if local == 15:
        return
    free, left = graph.acyclic_part(df, local)
    assert {tuple(r) for r in left.collect()} == {(a, b) for a, b in edges if scc[a][0] == scc[b][0]}
    assert {tuple(r) for r in free.collect()} == {(a, b) for a, b in edges if scc[a][0] != scc[b][0]}


def test_long_chains_and_rings_take_few_jobs(spark):
    n = 1000
    chain = spark.range(n).selectExpr("id as src", "id + 1 as dst")
    ring = spark.range(n).selectExpr(f"{2 * n} + id as src", f"{2 * n} + (id + 1) % {n} as dst")
    tracker, before = spark.sparkContext.statusTracker(), len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    found = graph.levels(chain.unionByName(ring), local=900)
    got = {r["node"]: (r["level"], r["cyclic"]) for r in found.collect()}
    assert got == {k: (k, False) for k in range(n + 1)} | {2 * n + k: (0, True) for k in range(n)}
    assert len(tracker.getJobIdsForGroup(None)) - before < 1000


def test_cycles_are_broken(spark):
    edges = [("a", "bb"), ("bb", "c"), ("c", "a"), ("c", "bb"), ("x", "y"), ("y", "x"), ("q", "a"), ("z", "z")]
    df = spark.createDataFrame(edges, "src string, dst string")
    assert {tuple(r["cycle"]) for r in graph.cycles(df).collect()} == {("a", "bb", "c", "a"), ("bb", "c", "bb"), ("x", "y", "x"), ("z", "z")}
    kept, gone = graph.without_cycles(df)
    assert not any(r["cyclic"] for r in graph.strong_components(kept).collect())
    assert kept.count() + gone.count() == len(edges)
