"""The pipeline's near-duplicate stage against all pairs by brute force."""

import numpy as np

import corpus_pipeline

DATA = "/root/testdata/sf0.001"


def grams(text):
    w = (text or "").encode().translate(bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))).split()
    return {b" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def groups(texts):
    sets, group = [grams(t) for t in texts], list(range(len(texts)))
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a == b or len(a & b) >= 0.8 * len(a | b):
                group = [group[j] if g == group[i] else g for g in group]
    return group


def firsts(rows):
    low = {}
    for (i, _), g in zip(rows, groups([t for _, t in rows])):
        low[g] = min(i, low.get(g, i))
    return sorted(low.values())


def test_near_copies(spark):
    rng = np.random.default_rng(5)
    word = lambda: f"w{rng.integers(0, 5000)}"
    rows = [(1, None), (2, ""), (3, "one two"), (4, "One  TWO"), (5, "one two three")]
    for g in range(12):
        base = [word() for _ in range(100 + g)]
        rows.append((100 * g + 10, " ".join(base)))
        for k in range(8):  # one, two, three or four changed words: similarity 0.90, 0.81, 0.72, 0.65 to the base, less to each other
            changed = list(base)
            for at in rng.choice(len(base), k % 4 + 1, replace=False).tolist():
                changed[at] = word()
            rows.append((100 * g + 11 + k, " ".join(changed)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = corpus_pipeline.one_of_each(spark, docs, DATA)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == firsts(rows)
    assert corpus_pipeline.one_of_each(spark, docs.limit(0), DATA).count() == 0
    real = spark.read.parquet(f"{DATA}/documents.parquet")
    assert sorted(r.doc_id for r in corpus_pipeline.one_of_each(spark, real, DATA).select("doc_id").collect()) == firsts([(r.doc_id, r.text) for r in real.select("doc_id", "text").collect()])


def test_rows_that_share_an_id(spark):
    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    rows = [(1, a), (1, a), (1, b), (2, b), (None, "x"), (None, "y"), (None, "y")]
    got = corpus_pipeline.one_of_each(spark, spark.createDataFrame(rows, "doc_id long, text string"), DATA)
    assert sorted((r.doc_id is None, r.text) for r in got.collect()) == [(False, a), (False, b), (True, "x"), (True, "y")]
