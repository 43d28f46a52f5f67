"""Strings in texts against plain counting."""

import random

import pytest

from gristmill.operators import patterns


@pytest.mark.parametrize("most_chars", [10, 4_000_000])
def test_occurrences(spark, most_chars):
    rng = random.Random(1)
    texts = [(k % 9, "".join(rng.choice("abé ") for _ in range(rng.randrange(40)))) for k in range(60)] + [(None, "abab"), (4, None), (5, ""), (6, "ab" * 150_000)]
    wanted = ["a", "ab", "aba", "é a", "bb", "zz", "", None, "ab"]
    docs = spark.createDataFrame([(*r, 1) for r in texts], "doc_id long, text string, n int")
    got = sorted(tuple(map(str, r)) for r in patterns.occurrences(docs, "doc_id", "text", spark.createDataFrame([(w,) for w in wanted], "pattern string"), most_chars=most_chars).collect())
    count = lambda t, w: sum(t.startswith(w, i) for i in range(len(t)))
    assert got == sorted((str(i), w, str(count(t, w))) for i, t in texts if t for w in {w for w in wanted if w} if w in t)
    assert patterns.occurrences(docs, "doc_id", "text", spark.createDataFrame([], "pattern string")).collect() == []
    assert patterns.occurrences(docs.limit(0), "doc_id", "text", spark.createDataFrame([("a",)], "pattern string")).collect() == []
