"""The audit against plain code, and its trees against dense matrices."""

import re
from collections import Counter

import numpy as np
import pytest

from gristmill.llm import divergence
from gristmill.llm.divergence import Tree


def plain(rows):
    """rows: (text, lang, source)."""
    rows = [(t or "", a or "", s or "") for t, a, s in rows]
    words = lambda t: re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t))
    out = []
    for lang in {a for _, a, _ in rows}:
        seen = Counter(w for t, a, _ in rows if a == lang for w in set(words(t)))
        kept = {w for w, n in seen.items() if n >= 3}
        count = lambda s: Counter(w for t, a, x in rows if a == lang and s in (None, x) for w in words(t) if w in kept)
        share = lambda c: {w: 1 + 10**9 * (c[w] + 1) // (sum(c.values()) + len(kept)) for w in kept}
        sources = {s: count(s) for s in {s for _, a, s in rows if a == lang}}
        p, q = {s: share(c) for s, c in sources.items()}, share(count(None))
        f = lambda x, y: (x - y) ** 2 // y
        for s, c in sources.items():
            pairs = sorted((-sum(f(p[s][w], p[o][w]) for w in kept), o.encode()) for o in sources if o != s)
            terms = sorted((-f(p[s][w], q[w]), w.encode()) for w in kept if c[w] and p[s][w] > q[w])[:200]
            out += [(lang, s, part, item.decode(), -v, k + 1) for part, listed in (("pair", pairs), ("term", terms)) for k, (v, item) in enumerate(listed)]
    return sorted(out)


LONG = " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)} Ort-{i}" for i in range(200_000))


@pytest.mark.parametrize("rows", [
    [],
    [(None, None, None), ("one two", "en", "a")],
    [(f"The cat {'sat ' * (k % 4)} été Straße x{k % 5}" if k % 7 else None, ("en", "fr", None)[k % 3], None if k % 11 == 0 else f"s{k % 4}") for k in range(90)] + [("alone", "it", "a"), (None, "it", "b"), ("", "it", "c")],
    [(LONG, "en", "a"), (LONG.upper(), "en", "b"), (LONG, "en", "b"), ("7 8 9", "en", "z")],
])
def test_against_plain_code(spark, rows):
    docs = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "text string, lang string, source string, count int, term string, block int")
    assert sorted(tuple(r) for r in divergence.audit(docs).collect()) == plain(rows)


def test_many_sources(spark):
    """More sources than a part of a tile has."""
    rows = [(f"common w{chr(97 + k % 23)} {'often ' * (k % 5)}", "en", f"s{k % 270}") for k in range(540)]
    docs = spark.createDataFrame(rows, "text string, lang string, source string")
    assert sorted(tuple(r) for r in divergence.audit(docs).collect()) == plain(rows)


@pytest.mark.parametrize(("m", "n", "width", "dense"), [(3, 5, 7, 0.3), (20, 20, 300, 0.4), (20, 17, 100, 0.0), (1, 1, 1, 1), (40, 3, 0, 0), (5, 5, 50, 1)])
def test_walk(m, n, width, dense, monkeypatch):
    monkeypatch.setattr(divergence, "FRONTIER", 50)
    rng = np.random.default_rng(m)
    both = [(rng.random((k, width)) < dense) * rng.integers(1, 50, (k, width)) for k in (m, n)]
    masses = [x.sum(1) + width + 5 for x in both]
    height = divergence._height(256, width)

    def tree(x):
        r, c = np.nonzero(x)
        made = Tree.of(height, r, c, x[r, c])
        assert (made.rows() == r[np.argsort(divergence_order(r, c, height))]).all()
        return Tree.unpacked(height, made.packed(), made.counts)

    share = lambda x, mass: [[1 + 10**9 * (int(v) + 1) // int(k) for v in row] for row, k in zip(x, mass)]
    p, q = share(both[0], masses[0]), share(both[1], masses[1])
    f = lambda a, b: sum((x - y) ** 2 // y for x, y in zip(a, b))
    there, back = divergence.walked(tree(both[0]), tree(both[1]), *masses, width)
    assert there.tolist() == [[f(a, b) for b in q] for a in p] and back.tolist() == [[f(b, a) for b in q] for a in p]
    own, back = divergence.walked(tree(both[0]), tree(both[0]), masses[0], masses[0], width, True)
    assert all(own[i, j] == f(p[i], p[j]) and back[i, j] == f(p[j], p[i]) for j in range(m) for i in range(j))


def divergence_order(rows, cols, height):
    return sum(((cols >> k & 1) | (rows >> k & 1) << 1) << 2 * k for k in range(height))


def test_shares_are_exact():
    counts, masses = np.array([0, 9_300_000_000, 10**14]), np.array([1, 9_400_000_000, 10**15])
    assert divergence.share(counts, masses).tolist() == [1 + 10**9 * (c + 1) // m for c, m in zip(counts.tolist(), masses.tolist())]
