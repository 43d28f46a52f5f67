"""The first texts for many questions where the texts with the smallest ids give bounds for all others, against plain counting."""

import random
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gristmill.operators import patterns


@pytest.mark.parametrize("order", ["ascending", "descending", "mixed", "by words"])
def test_answers_with_bounds(spark, order):
    rng = random.Random(order)
    word = lambda: "".join(rng.choice("abé") for _ in range(rng.randrange(1, 4)))
    texts = [(k, " ".join(word() for _ in range(rng.randrange(8)))) for k in rng.sample(range(-50, 900), 400)]
    if order == "by words":  # the first texts hold few of the words that the others hold
        texts = [(i, t) for (i, _), (_, t) in zip(sorted(texts), sorted(texts, key=lambda x: len(x[1])), strict=True)]
    elif order != "mixed":
        texts.sort(reverse=order == "descending")
    texts += [(901, None), (902, "ABÉ AB"), (texts[0][0], "ab ba"), (None, "ab é"), (None, "ba é")]
    asked = [(q, w) for q in range(40) for w in {word() for _ in range(rng.randrange(1, 5))}] + [(40, "zz"), (41, "zz"), (41, "ab")]
    docs, words = spark.createDataFrame(spark.sparkContext.parallelize(texts, 3), "doc_id long, text string"), spark.createDataFrame(asked, "question long, word string")
    want = []
    for q in range(42):
        n = Counter(i for i, t in texts if t for p, w in asked if p == q and w in t.lower())
        want += [(q, i, n[i], r) for r, i in enumerate(sorted(n, key=lambda i: (-n[i], i is None, i or 0))[:6], 1)]
    for first in (10, 60):
        got = patterns.answers(words, docs, "doc_id", "text", 6, rows=16, first=first).collect()
        assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("turned", [1, -1])
def test_closer_bounds(turned):
    """Rows are dropped on the way, whatever the order of ids: what stays are the first of each set."""
    rng = random.Random(5)
    texts = [(k, " ".join(rng.choice(("ab", "cd", "ef", "gh", "x" * 3)) for _ in range(4))) for k in range(300)][::turned]
    sets = [["ab"], ["ab", "cd"], ["ab", "cd", "ef"], ["cd", "gh", "none"]]
    batches = [pa.RecordBatch.from_pylist([{"id": i, "t": t} for i, t in texts[a : a + 40]]) for a in range(0, 300, 40)]
    rows = [r for b in patterns._better_in_each_set(sets, {("ab",): (1, -5)}, -1, 4, 20, hold=30)(iter(batches)) for r in b.to_pylist()]
    want = []
    for s in sets[1:]:  # the first has all that it can have
        n = {i: sum(w in t for w in s) for i, t in texts}
        want += [(s, i, n[i]) for i in sorted((i for i in n if n[i]), key=lambda i: (-n[i], i))[:4]]
    assert sorted((r["words"], r["_id"], r["n_words"]) for r in rows) == sorted(want)


def test_tasks_move_only_what_passes_the_bound(spark):
    """Each task moved the first texts of each set, so what was moved grew with sets times tasks."""
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("common w"), F.col("id") % 50).alias("text"))
    sets = [["common", f"w{k}"] for k in range(50)]
    bounds = {tuple(s): (2, 950) for s in sets}
    moved = docs.where("doc_id > 1000").mapInArrow(patterns._better_in_each_set(sets, bounds, 1000, 5, 1024), "words array<string>, id long, n_words long")
    assert moved.count() == 0
