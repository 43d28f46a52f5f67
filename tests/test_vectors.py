"""Vector joins against all pairs, and how many pairs they compare."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from gristmill.operators import vectors


def clustered(spark, rng, clusters=40, each=50, dims=16, spread=0.05):
    centres = rng.normal(size=(clusters, dims))
    v = np.concatenate([c + rng.normal(size=(each, dims)) * spread for c in centres])
    v[1::97] = v[0]  # copies
    return v, spark.createDataFrame([(k, x.tolist()) for k, x in enumerate(v)], "id long, v array<double>")


def test_clusters_are_pruned(spark):
    v, df = clustered(spark, np.random.default_rng(2))
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    similar = np.round(unit @ unit.T, 9)
    k, queries = 5, df.where("id % 10 = 0")
    got = {}
    for r in vectors.nearest_rows(queries, df, "id", "v", k, leaves=64, rows=100).collect():
        got.setdefault(r["id"], []).append((r["rank"], r["nearest_id"]))
    assert {q: [x for _, x in sorted(r)] for q, r in got.items()} == {q: np.lexsort((np.arange(len(v)), -similar[q]))[:k].tolist() for q in range(0, len(v), 10)}
    found = sorted(r["id"] for r in vectors.resembling_earlier(df, "id", "v", 0.95, leaves=64, rows=100).collect())
    assert found == [j for j in range(len(v)) if (unit[:j] @ unit[j] > 0.95).any()]
    balls = vectors.Balls(vectors.sound(df, "id", "v"), leaves=64, rows=100)
    near = balls.visits(vectors.sound(df, "id", "v"), float(vectors.chord(0.95)))
    assert balls.pairs(near) < len(v) ** 2 / 10


@pytest.mark.parametrize("n", [0, 1, 3])
def test_few_rows(spark, n):
    rows = [(k, [1.0, float(k)]) for k in range(n)] + [(50, [1.0]), (51, None), (52, [0.0, 0.0]), (53, [float("nan"), 1.0])]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    got = sorted((r["id"], r["nearest_id"], r["rank"]) for r in vectors.nearest_rows(df, df, "id", "v", 2).collect())
    assert [x for x in got if x[0] == 50] == [(50, 50, 1)] and len(got) == 1 + sum(min(2, n) for _ in range(n))
    assert {r["id"] for r in vectors.resembling_earlier(df, "id", "v", 0.99999).collect()} == set()


def test_one_vector_most_of_the_time(spark):
    df = spark.range(3000).select("id", F.when(F.col("id") % 3 > 0, F.array(F.lit(1.0), F.lit(2.0))).otherwise(F.array(F.lit(1.0), F.col("id").cast("double"))).alias("v"))
    assert vectors.resembling_earlier(df, "id", "v", 0.9999999).where("id % 3 > 0").count() == 1999
    top = vectors.nearest_rows(df.where("id = 1"), df, "id", "v", 3).collect()
    assert sorted((r["rank"], r["nearest_id"]) for r in top) == [(1, 1), (2, 2), (3, 4)]
