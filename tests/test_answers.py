"""The first texts for many questions against plain counting."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from gristmill.operators import patterns


@pytest.mark.parametrize(("most_sets", "rows", "shared"), [(65_536, 1024, False), (9, 3, True)])
def test_answers(spark, most_sets, rows, shared):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abé") for _ in range(rng.randrange(1, 4)))
    texts = [(k, " ".join(word() for _ in range(rng.randrange(8)))) for k in rng.sample(range(-50, 400), 120)] + [(900, None), (901, ""), (902, "ABÉ AB")]
    if shared:
        texts += [(texts[0][0], "ab ba"), (texts[1][0], "ab"), (None, "ab é"), (None, "ba é"), (texts[2][0], None)]
    asked = [(q, w) for q in range(40) for w in {word() for _ in range(rng.randrange(1, 5))}] + [(40, "zz"), (41, "zz"), (41, "ab")]
    docs, words = spark.createDataFrame(texts, "doc_id long, text string").repartition(5), spark.createDataFrame(asked, "question long, word string")
    got = sorted(map(tuple, patterns.answers(words, docs, "doc_id", "text", 6, most_sets=most_sets, rows=rows).collect()), key=str)
    want = []
    for q in range(42):
        n = Counter(i for i, t in texts if t for p, w in asked if p == q and w in t.lower())
        want += [(q, i, n[i], r) for r, i in enumerate(sorted(n, key=lambda i: (-n[i], i is None, i or 0))[:6], 1)]
    assert got == sorted(want, key=str)
    assert patterns.answers(words.limit(0), docs, "doc_id", "text", 6).collect() == []
    assert patterns.answers(words, docs.limit(0), "doc_id", "text", 6).collect() == []


def test_only_the_first_texts_of_a_task_are_moved(spark):
    """A word that all texts hold was a row for each text and question."""
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("common w"), F.col("id") % 50).alias("text")).coalesce(4)
    words = spark.range(200).select(F.col("id").alias("question"), F.explode(F.array(F.lit("common"), F.concat(F.lit("w"), F.col("id") % 50))).alias("word"))
    met = patterns.answers(words, docs, "doc_id", "text", 5)
    assert met.count() == 1000 and met.agg(F.max("n_words"), F.min("n_words")).first() == (2, 2)
    sets = [["common", f"w{k}"] for k in range(50)]
    moved = docs.select("doc_id", "text").mapInArrow(patterns._first_of_each_set(sets, 5, 1024), "words array<string>, id long, n_words long").count()
    assert moved <= 50 * 5 * 4
