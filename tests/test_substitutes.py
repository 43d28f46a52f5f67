"""Siblings by their parent against the SQL, on odd rows."""

import duckdb

from gristmill.plans.catalog import ORACLES, QUERIES


def test_items_of_several_parents_and_of_none(spark, tmp_path):
    """An item of two parents was two rows, and a null in a parent was left out of it instead of the item."""
    rows = [(k, f"Brand#{k % 3}", "SMALL" if k % 2 else "LARGE") for k in range(1, 125)]
    rows += [(5, "Brand#1", "LARGE"), (11, "Brand#1", "LARGE"), (11, "Brand#1", "LARGE"), (-12, "Brand#0", "LARGE"), (200, "Brand#9", "LARGE"), (201, None, "LARGE"), (202, None, "LARGE"), (203, "Brand#1", None)]
    rows += [(None, "Brand#1", "LARGE"), (None, "Brand#2", "LARGE"), (None, "Brand#8", "LARGE")]
    spark.createDataFrame(rows, "p_partkey long, p_brand string, p_type string").coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    con = duckdb.connect()
    con.execute(f"create view part as select * from '{tmp_path}/part.parquet/*.parquet'")
    want = con.execute(ORACLES["substitutes"]).fetchall()
    got = [(r.p_partkey, r.siblings) for r in QUERIES["substitutes"](spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str) and len(got) == 127 and (200, None) in got
