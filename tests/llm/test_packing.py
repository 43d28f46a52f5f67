"""Pieces against the tokenizer on whole texts, sequences against their ids, and packings against their bound."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from gristmill.llm import packing

LONG = " ".join(f"Wort{i} isn't\tÉté" for i in range(120_000))
TEXTS = [(1, "The cat's hat"), (1, "The cat's hat"), (2, None), (3, ""), (None, " \n\t "), (4, LONG), (5, "a" * 30_000), (6, "é ́x \x1c y z　q"), (None, "ΣΑΣ ςα İ ﬁ 12345 🙂🙂 <|endoftext|>x")]


def want(rows):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    for id, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        for k, a in enumerate(range(0, len(ids), 4096)):
            yield id, k, a, ids[a : a + 4096]


def sound(rows, length=4096):
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= length
    return len(by)


def test_pieces_and_sequences(spark):
    docs = spark.createDataFrame([(*r, 1, "x") for r in TEXTS], "doc_id long, text string, length int, _uid string")
    found = packing.packed(docs, keep_ids=True).cache()
    rows, wanted = found.collect(), list(want(TEXTS))
    crc = lambda ids: zlib.crc32(np.array(ids, "<u4").tobytes())
    assert sorted((str(r["doc_id"]), r["piece"], r["start"], r["length"], r["ids_crc32"], r["ids"]) for r in rows) == sorted((str(i), k, a, len(ids), crc(ids), ids) for i, k, a, ids in wanted)
    assert sound(rows) == -(-sum(len(x[3]) for x in wanted) // 4096)
    whole = {r["sequence_id"]: r["ids"] for r in packing.sequences(found).collect()}
    assert all(whole[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]] == r["ids"] for r in rows)
    assert sum(map(len, whole.values())) == sum(len(x[3]) for x in wanted)


def test_empty(spark):
    assert packing.packed(spark.createDataFrame([], "doc_id long, text string")).collect() == []


@pytest.mark.parametrize("n", [0, 1, 2500])
def test_blocks_pool_their_worst_sequences(spark, n):
    rng = np.random.default_rng(3)
    lengths = [4096 if k % 50 == 0 else int(x) for k, x in enumerate(rng.integers(300, 2100, n))]
    items = spark.createDataFrame([(k, x) for k, x in enumerate(lengths)], "uid long, length long")
    rows = packing.placements(items, members=300).join(items, "uid").collect()
    assert sorted(r["uid"] for r in rows) == list(range(n))
    assert sound(rows) <= packing.bound(np.array(lengths, np.int64), 4096) + (4 if n else 0)


def test_evolution_beats_best_fit_decreasing():
    """Triplets that fill a sequence exactly: best-fit decreasing wastes some, and a generation is never worse than the one before."""
    rng = np.random.default_rng(5)
    parts = []
    for _ in range(60):
        a = int(rng.integers(380, 490))
        b = int(rng.integers(250, 1000 - a - 250))
        parts += [a, b, 1000 - a - b]
    lengths = np.array(parts)
    first = packing.founded(lengths, 1000, 6, rng)
    later = packing.evolved(first, lengths, 1000, 150, 8, rng)
    counts = [packing.quality(p, lengths)[0] for p in (first[0], later[0])]
    assert packing.bound(lengths, 1000) == 60 <= counts[1] < counts[0]
    assert np.bincount(later[0], lengths).max() <= 1000


def test_crossover_keeps_injected_sequences_whole():
    rng = np.random.default_rng(1)
    lengths = rng.integers(100, 600, 200)
    one, other = (packing.founded(lengths, 1000, 4, rng)[k] for k in (-1, -2))
    child = packing.crossed(one, other, lengths, 1000, rng)
    assert np.bincount(child, lengths).max() <= 1000 and len(child) == 200
    groups = lambda boxes: {frozenset(np.flatnonzero(boxes == b)) for b in set(boxes.tolist())}
    assert any(g <= h for g in groups(other) for h in groups(child) if len(g) > 1)
