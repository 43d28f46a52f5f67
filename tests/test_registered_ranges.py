"""Registration over many ranges of records against one plain loop: values and entries that go on over all ranges."""

import random

import pytest
from test_registered import plain

from gristmill.operators import identity


@pytest.mark.parametrize("strict", [False, True])
def test_ranges_against_plain_loop(spark, strict):
    rng = random.Random(3)
    one = lambda n, letter: rng.choice([None, "", *[f"{letter}{k}" for k in range(n)]])
    rows = [(k, one(60, "c"), f"i{k // 3}" if k % 2 else one(60, "i"), one(20, "n")) for k in range(300)]
    df = spark.createDataFrame(rows, "no long, cas string, inchi string, name string").repartition(5)
    got = identity.registered(df, "no", ["cas", "inchi"], ["name"], strict, local=40).collect()
    assert sorted((r["no"], r["entry"], r["outcome"]) for r in got) == plain(rows, strict)
    held = {r["entry"]: (r["cas"], r["inchi"], r["name"]) for r in sorted(got, key=lambda r: r["no"]) if r["entry"] is not None}
    assert all(not value or value in held[r["entry"]] for r in got if r["outcome"] == "new" for value in rows[r["no"]][1:])


def test_one_chain_of_keys_over_ranges(spark):
    """All records hang together, which gave all of them to one task."""
    df = spark.range(400).selectExpr("id as no", "'x' || id div 2 as a", "'y' || (id + 1) div 2 as b")
    found = identity.registered(df, "no", ["a", "b"], [], local=100)
    rows = [(k, f"x{k // 2}", f"y{(k + 1) // 2}", None) for k in range(400)]
    assert sorted((r["no"], r["entry"], r["outcome"]) for r in found.collect()) == plain(rows, False)
