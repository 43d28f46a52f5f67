"""Vectors without clusters are sent to few groups, however many balls and shells there are, and are compared right."""

import numpy as np
from pyspark.sql import functions as F

from gristmill.operators import vectors


def test_visits_of_scattered_vectors(spark):
    rng = np.random.default_rng(3)
    v = rng.normal(size=(6000, 32)).astype(np.float32)
    df = spark.createDataFrame([(k, x.tolist()) for k, x in enumerate(v)], "id long, v array<float>")
    rows = vectors.sound(df, "id", "v")
    balls = vectors.Balls(rows)
    sent = balls.visits(rows, float(vectors.chord(0.3))).groupBy("id").count().agg(F.max("count")).first()[0]
    assert sent <= 3  # once to each group; to each of some 2,000 shells before
    x = v.astype(np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    like = np.tril(x @ x.T > 0.55, -1).any(axis=1)
    assert sorted(r["id"] for r in vectors.resembling_earlier(df, "id", "v", 0.55).collect()) == np.flatnonzero(like).tolist()
    got = {(r["id"], r["rank"]): r["nearest_id"] for r in vectors.nearest_rows(df.where("id % 100 = 0"), df, "id", "v", 7, rows=1000).collect()}
    for q in range(0, 6000, 100):
        want = np.lexsort((np.arange(6000), -np.round(x @ x[q], 9)))[:7].tolist()
        assert [got[q, r] for r in range(1, 8)] == want
