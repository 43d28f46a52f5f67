"""Registration in order against a plain loop."""

import random

import pytest

from gristmill.operators import identity

KEYS = ("cas", "inchi", "name")


def plain(rows, strict):
    index, entries, out = {}, {}, []
    for number, *values in sorted(rows):
        own = {k: v for k, v in zip(KEYS, values) if v}
        hits = {k: index[k, v] for k, v in own.items() if (k, v) in index}
        if len(set(hits.values())) > 1:
            out.append((number, None, "conflict"))
            continue
        if hits and strict and set(hits) == {"name"}:
            out.append((number, None, "refused"))
            continue
        entry = next(iter(hits.values()), number)
        record = entries.setdefault(entry, {})
        for k, v in own.items():
            if k not in record:
                record[k] = v
                index.setdefault((k, v), entry)
        out.append((number, entry, "new" if not hits else "weak" if set(hits) == {"name"} else "merged"))
    return out


@pytest.mark.parametrize("strict", [False, True])
def test_against_plain_loop(spark, strict):
    rng = random.Random(7)
    one = lambda n, letter: rng.choice([None, "", *[f"{letter}{k}" for k in range(n)]])
    rows = [(k, one(30, "c"), one(40, "i"), one(50, "n")) for k in range(150)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "no long, cas string, inchi string, name string, core int").repartition(5)
    got = sorted((r["no"], r["entry"], r["outcome"]) for r in identity.registered(df, "no", ["cas", "inchi"], ["name"], strict).collect())
    assert got == plain(rows, strict) and {g[2] for g in got} >= {"new", "merged", "conflict", "refused" if strict else "weak"}
    assert identity.registered(df.limit(0), "no", ["cas", "inchi"], ["name"]).collect() == []
