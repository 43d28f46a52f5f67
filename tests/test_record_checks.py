"""The rules of a record, each broken by one record."""

from gristmill.operators import records


def test_rules(spark):
    text = "The crust browns at 150 °C, and dries (slowly)."
    good = ("s 1", "heat", "browns at 150", text, "fact_atom", ["a"])
    rows = [
        (1, *good), (2, "no digit", *good[1:]), (3, *good[:1], "other", *good[2:]), (4, *good[:2], None, *good[3:]), (5, *good[:2], "burns at 99 today", *good[3:]), (6, *good[:4], "guess", ["a"]),
        (7, *good[:4], "causal_chain", ["a"]), (8, *good[:4], "causal_chain", None), (9, *good[:4], "causal_chain", ["a", "b"]), (10, *good[:2], "BROWNS  AT-150", *good[3:]),
        (11, *good[:2], "crust browns bt 150", *good[3:]), (12, *good[:2], "crvst brxwns bt 150", *good[3:]), (13, *good[:3], None, *good[4:]), (14, None, None, None, None, None, None),
    ]
    df = spark.createDataFrame(rows, "id long, statement string, domain string, citation string, chunk string, kind string, steps array<string>")
    got = {r["id"]: r for r in records.checked(df, spark.createDataFrame([("heat",), ("heat",)], "domain string")).collect()}
    passing = {1, 2, 9, 10, 11}
    assert {k for k, r in got.items() if r["passes"]} == passing and len(got) == len(rows)
    assert not got[2]["has_number"] and not got[3]["valid_domain"] and not got[4]["has_citation"] and not got[5]["citation_in_chunk"] and not got[6]["valid_type"]
    assert not got[7]["causal_chain_format"] and not got[8]["causal_chain_format"] and got[12]["has_citation"] and not got[12]["citation_in_chunk"]
    assert records.checked(df.limit(0), df.select("domain")).collect() == []
