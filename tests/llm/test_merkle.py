"""The manifest against plain code: several tiers of blocks, many groups, nulls, ties, repeated rows and clashing columns."""

import hashlib
import zlib

import numpy as np
import pytest

from gristmill.llm import merkle

H = lambda s: hashlib.sha256(s.encode()).hexdigest()


def test_place_is_a_van_emde_boas_order():
    for levels in range(1, 6):
        all_at = np.concatenate([merkle.place(levels, d, np.arange(8**d)) for d in range(levels)])
        assert sorted(all_at) == list(range((8**levels - 1) // 7))
        top = levels // 2  # the upper half comes first, then each subtree lies together
        if top:
            upper = np.concatenate([merkle.place(levels, d, np.arange(8**d)) for d in range(top)])
            assert upper.max() == (8**top - 1) // 7 - 1
            size = (8 ** (levels - top) - 1) // 7
            for k in (0, 8**top - 1):
                own = np.concatenate([merkle.place(levels, d, np.arange(8 ** (d - top)) + k * 8 ** (d - top)) for d in range(top, levels)])
                assert sorted(own) == list(range(len(upper_all := range((8**top - 1) // 7)) + k * size, len(upper_all) + (k + 1) * size))


def grown(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([H("".join(levels[-1][a : a + 8])) for a in range(0, len(levels[-1]), 8)])
    return levels


def steps(levels, i):
    for row in levels[:-1]:
        run = i // 8 * 8
        yield "".join(row[run:i]), "".join(row[i + 1 : run + 8])
        i //= 8


def plain(rows):
    """rows: (doc_id, source, lang, n_chars, text)."""
    part = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r: H("".join(map(part, r)))
    lower = lambda t: None if t is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
    groups = {}
    for r in rows:
        other = leaf((*r[:4], lower(r[4]))) if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 else None
        groups.setdefault(r[2], []).append((r[0] is None, r[0] or 0, leaf(r), other))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: grown([x[2] for x in sorted(groups[g], key=lambda x: x[:3])]) for g in names}
    if not rows:
        return []
    tops = grown([trees[g][-1][0] for g in names])
    root, out = tops[-1][0], []
    for k, g in enumerate(names):
        for i, (null, id, own, other) in enumerate(sorted(groups[g], key=lambda x: x[:3])):
            path = [*steps(trees[g], i), *steps(tops, k)]
            f = other or own
            for a, b in path:
                f = H(a + f + b)
            out.append((None if null else id, own, trees[g][-1][0], root, H("".join(a + b for a, b in path)), f, f == root))
    return sorted(out, key=str)


@pytest.mark.parametrize("rows", [
    [],
    [(1, "s", "en", 3, "One")],
    [(k % 40 if k % 7 else None, None if k % 5 == 0 else f"s{k % 3}", None if k % 11 == 0 else ("en", "fr", "", "é")[k % 4], k % 9 or None, None if k % 13 == 0 else f"Text {'X' * (k % 4)} é" if k % 2 else "same") for k in range(300)],
    [(7, "s", "en", 1, "Same Row")] * 700 + [(8, "s", None, 1, "A" * 300_000)],
])
def test_against_plain_code(spark, rows):
    kind = "doc_id long, source string, lang string, n_chars long, text string, g string, root string, rank int, LEAF string"
    docs = spark.createDataFrame([(*r, "x", "y", 1, "z") for r in rows], kind)
    third = merkle.F.coalesce(merkle.F.crc32(merkle.F.col("doc_id").cast("string").cast("binary")) % 3 == 0, merkle.F.lit(False))
    got = merkle.proven(docs, changed=(third, {"text": merkle.F.translate("text", merkle.UPPER, merkle.LOWER)})).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain(rows)


def test_tiers(spark):
    """Groups of more leaves than a block, and more groups than a run."""
    rows = [(k, "s", "big" if k < 4200 else f"g{k % 70:03d}", 1, f"T{k}") for k in range(4500)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    third = merkle.F.crc32(merkle.F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    got = merkle.proven(docs, changed=(third, {"text": merkle.F.translate("text", merkle.UPPER, merkle.LOWER)})).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain(rows)
    assert 0 < sum(r["verified"] for r in got) < len(got)
