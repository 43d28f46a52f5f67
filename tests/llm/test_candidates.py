"""Neighbours that share a list or a few are found, whatever the number of groups."""

import numpy as np

from gristmill.llm import ann


def test_clustered_neighbours(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 256)
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(40, 32)) * 2  # balls so tight that their vectors have equal codes, among scattered vectors
    v = np.concatenate([*[c + rng.normal(size=(80, 32)) * 0.001 for c in centres], rng.normal(size=(3000, 32))]).astype(np.float32)
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<float>")
    got = ann.search(df, df.where("vec_id % 40 = 0 and vec_id < 3200"), 10).toPandas()
    hit = total = 0
    for q in range(0, 3200, 40):
        s = v.astype(np.float64) @ v[q].astype(np.float64)
        best = [i for i in np.lexsort((np.arange(len(v)), -s)) if i != q][:10]
        hit, total = hit + len(set(best) & set(got[got.query_id == q].vec_id)), total + 10
    assert hit / total >= 0.95, hit / total
