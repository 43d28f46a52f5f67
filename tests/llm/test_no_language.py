"""The pipeline's language stage on planted clean, mixed and junk texts."""

import numpy as np

import corpus_pipeline

DATA = "/root/testdata/sf0.01"


def test_junk_goes_and_mixed_texts_stay(spark):
    real = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text", "lang")
    rows, rng = {r.doc_id: r for r in real.collect()}, np.random.default_rng(7)
    of = {}
    for r in rows.values():
        if 400 < len(r.text) < 3000:
            of.setdefault(r.lang, []).append(r.text)
    names = sorted(of)
    mixed = [f"{of[names[k % len(names)]][k]}\n{of[names[(k + 1) % len(names)]][k]}" for k in range(20)]
    debris = ["".join(rng.choice(list("|-+=0123456789.,;#$% \n"), 600).tolist()) + " a |" for _ in range(10)]
    letters = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz  "), 600).tolist()) for _ in range(10)]
    other = ["".join(chr(c) for c in rng.integers(0x430, 0x450, 300).tolist()) for _ in range(10)]
    planted = [(10**6 + k, t, None) for k, t in enumerate([*mixed, *debris, *letters, *other])]
    docs = real.unionByName(spark.createDataFrame(planted, real.schema))
    kept = {r.doc_id for r in corpus_pipeline.known_language(spark, docs, DATA).select("doc_id").collect()}
    lost = [r for i, r in rows.items() if i not in kept]
    shares = {name: sum(10**6 + k in kept for k in at) for name, at in {"mixed": range(20), "debris": range(20, 30), "letters": range(30, 40), "other": range(40, 50)}.items()}
    assert shares == {"mixed": 20, "debris": 0, "letters": 0, "other": 0}, shares
    assert not lost, [(r.doc_id, r.text[:80]) for r in lost[:8]] + [len(lost)]
