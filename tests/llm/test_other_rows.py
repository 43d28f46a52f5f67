"""The nearest rows by inner product are found whatever the rows: lengths that differ widely, tight balls, few directions, huge and tiny numbers."""

import numpy as np
import pytest

from gristmill.llm import ann


def rows(kind, rng, n=3000, dim=24):
    v = rng.normal(size=(n, dim))
    if kind == "lengths":
        return v * np.exp(rng.normal(size=(n, 1)) * 1.5)
    if kind == "balls":
        return rng.normal(size=(12, dim))[rng.integers(0, 12, n)] + v * 1e-4
    if kind == "scales":
        return v * 10.0 ** rng.integers(-3, 3, dim)
    if kind == "whole":
        return rng.integers(0, 2, (n, dim)).astype(np.float64) + np.eye(dim)[0]
    return v * 1e80


@pytest.mark.parametrize("kind", ["lengths", "balls", "scales", "whole", "huge"])
def test_none_is_missed(spark, monkeypatch, kind):
    monkeypatch.setattr(ann, "BLOCK", 512)
    v, k = rows(kind, np.random.default_rng(8)), 20
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    got = ann.search(df, df.where("vec_id % 100 = 0"), k).toPandas().sort_values(["query_id", "rank"])
    hit = 0
    for q in range(0, len(v), 100):
        s = np.einsum("ij,j->i", v, v[q])
        s[q] = -np.inf
        found = got[got.query_id == q]
        assert len(found) == k
        hit += (found.score.to_numpy() >= np.sort(s)[-k] - 1e-12 * abs(np.sort(s)[-k])).sum()
        if kind == "whole":  # exact sums, so ties are told
            assert found.vec_id.tolist() == np.lexsort((np.arange(len(v)), -s))[:k].tolist()
    assert hit == k * len(range(0, len(v), 100))
