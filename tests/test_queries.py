"""Every registered query with SQL against DuckDB on the smallest tables, and formulas against known answers."""

import math
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from gristmill.functions import physics, text, unicode
from gristmill.operators import graph, identity, quotations, records, tables
from gristmill.plans.catalog import ORACLES, QUERIES
from gristmill.streaming import events as streams

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return con


def rows(df):
    def plain(v):
        return "-" if v is None or v != v else f"{v:.6g}" if isinstance(v, float) else str(v)

    return sorted(tuple(plain(None if str(v) in ("<NA>", "NaT") else v) for v in r) for r in df[sorted(df.columns)].astype(object).values.tolist())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, DATA).toPandas()
    want = duck.execute(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_formulas(spark):
    e = physics.evaluate
    got = spark.range(1).select(
        e("MF-M04", pKa=4.76, acid=0.1, base=0.1).alias("ph"), e("MF-T06", T_K=350.0, Td_K=350.0, dH=4e5).alias("half"), e("MF-M09", i=1.0, M=1.0, T_K=298.15).alias("osmotic"),
        e("MF-T02-CP", T=25.0, water=1.0, protein=0.0, fat=0.0, carb=0.0, fiber=0.0, ash=0.0).alias("cp"), e("MF-T01", T0=20.0, Tb=100.0, alpha=1e-7, x=0.002, t=60.0).alias("heat"),
        physics.f_value_profile(F.array(*map(F.lit, (0.0, 60.0, 120.0))), F.array(*map(F.lit, (121.1, 121.1, 121.1))), F.lit(121.1), F.lit(10.0)).alias("f"),
    ).first()
    assert got.ph == pytest.approx(4.76) and got.half == pytest.approx(0.5) and got.osmotic == pytest.approx(8.314462618 * 298150)
    assert got.cp == pytest.approx(4181.3, rel=0.05) and got.heat == pytest.approx(20 + 80 * math.erfc(0.002 / (2 * math.sqrt(6e-6))), rel=1e-6) and got.f == pytest.approx(2.0)
    with pytest.raises(ValueError):
        e("MF-M04", pKa=4.76)


def test_bounds(spark):
    df = spark.createDataFrame([(1.0, 5.0), (None, 50.0), (9.0, 5.0)], "a double, b double")
    issues = physics.bounds_issues({"a": (0, 5, False), "b": (0, 10, True)})
    got = [(r.ok, len(r.i)) for r in df.select(issues.alias("i"), physics.passed(issues).alias("ok")).collect()]
    assert got == [(True, 0), (False, 2), (False, 1)]


def test_values(spark):
    df = spark.createDataFrame([("30-40", "C"), ("[30, 40]", "g"), ("1e-5", "kg"), ("abc", "g"), ("-5", "F"), (None, "g")], "v string, u string")
    got = [r[0] for r in df.select(text.parsed_value(F.col("v"))).collect()]
    assert got == [35.0, 35.0, 1e-5, None, -5.0, None]
    names = spark.createDataFrame([("  Fresh  Red Onion. ",), (None,)], "n string").select(text.without_modifiers(text.normal_name(F.col("n")), ("fresh", "red")).alias("n")).collect()
    assert [r.n for r in names] == ["onion", None]


def test_peeling(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (3, 4), (5, 1)], "src long, dst long")
    free, cyclic = graph.acyclic_part(edges)
    assert sorted(map(tuple, cyclic.collect())) == [(1, 2), (2, 3), (3, 1)] and sorted(map(tuple, free.collect())) == [(3, 4), (5, 1)]


def test_upsert(spark):
    old, new = spark.createDataFrame([(1, "a", 0), (2, "b", 0)], "k int, v string, t int"), spark.createDataFrame([(2, "c", 1), (2, "d", 2), (3, "e", 1)], "k int, v string, t int")
    assert sorted(map(tuple, tables.upsert(old, new, ["k"], [F.desc("t")]).collect())) == [(1, "a", 0), (2, "d", 2), (3, "e", 1)]


def test_chunks(spark):
    def brute(text, most):
        out = []
        for part in text.split("\n"):
            if out and len(out[-1]) + 1 + len(part) <= most:
                out[-1] += "\n" + part
            else:
                out.append(part)
        return out

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    got = {}
    for r in QUERIES["chunk_pack"](spark, DATA).orderBy("doc_id", "chunk").collect():
        got.setdefault(r.doc_id, []).append(r.text)
    assert got == {k: brute(t, 800) for k, t in texts.items() if t is not None}


def test_heat(spark):
    df = spark.createDataFrame([(1, 0.01, 1.4e-7, 0.5, 5000.0, 0.0, 100.0, 300.0), (2, 0.01, 1.4e-7, 0.5, 50.0, 20.0, 20.0, 300.0), (3, 0.01, 1.4e-7, 0.5, None, 20.0, 20.0, 300.0)], "id long, half double, alpha double, k double, h double, T0 double, Tinf double, t double")
    got = {r.id: r for r in records.heat_slab(df, "id").collect()}
    fo, biot = 1.4e-7 * 300 / 1e-4, 5000 * 0.01 / 0.5
    roots = []
    for n in range(6):  # z tan z = Bi
        low, high = n * math.pi + 1e-9, n * math.pi + math.pi / 2 - 1e-9
        for _ in range(80):
            z = (low + high) / 2
            low, high = (z, high) if z * math.tan(z) < biot else (low, z)
        roots.append(z)
    series = sum(4 * math.sin(z) / (2 * z + math.sin(2 * z)) * math.exp(-z * z * fo) for z in roots)
    assert sorted(got) == [1, 2] and got[1].centre == pytest.approx(100 * (1 - series), abs=0.5) and got[2].mean == pytest.approx(20.0)


def test_redirects(spark):
    chain = spark.createDataFrame([(k, k + 1) for k in range(20)] + [(50, 51)], "src long, dst long")
    assert {(r.src, r.root, r.steps) for r in graph.redirected(chain).collect()} == {(k, 20, 20 - k) for k in range(20)} | {(50, 51, 1)}
    cycle = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (0, 1), (7, 8), (8, 9)], "src long, dst long")
    assert {tuple(r) for r in graph.redirected(cycle).collect()} == {(k, None, None) for k in range(4)} | {(7, 9, 2), (8, 9, 1)}


def test_citation_fit(spark):
    def brute(quote, whole):
        strip = lambda x: re.sub(rf"[{re.escape(unicode.MARKS)}]", "", re.sub(r"\s+", "", x)).lower()
        q, t = strip(quote), strip(whole)
        if quote in whole:
            return "exact"
        if q in t:
            return "normalised"
        near = any(sum(a != b for a, b in zip(q, t[s:], strict=False)) <= max(1, len(q) // 10) for s in range(len(t) - len(q) + 1))
        return "near" if len(q) >= 5 and near else "none"

    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    quotes = {r.item_id: r.text for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()}
    got = QUERIES["citation_fuzzy"](spark, DATA).collect()
    assert {(r.doc_id, r.item_id) for r in got if r.fit == "exact"} == {(d, i) for d, t in docs.items() for i, q in quotes.items() if t and q in t}
    assert all(r.fit == brute(quotes[r.item_id], docs[r.doc_id]) for r in got)
    cases = [("abcdefghij", "xxabcdeXghij--", "near"), ("ab cd", "zzAB，CDzz", "normalised"), ("abcd", "abxd", "none"), ("", "abc", "none"), (None, "abc", "none"), ("abc", None, "none"), ("abcdefghij", "abXdefXhij", "none")]
    df = spark.createDataFrame([(q, t) for q, t, _ in cases], "q string, t string")
    assert [r[0] for r in df.select(unicode.fit(F.col("q"), F.col("t"))).collect()] == [c[2] for c in cases]


def test_quotations_are_complete(spark):
    """Every pair of mutated quotations and texts against the comparison of all pairs."""
    rng = np.random.default_rng(8)
    words = [f"{a}{b}{c}" for a in "bdgkl" for b in "aeiou" for c in "mnrst"]
    quotes, texts = [], []
    for k in range(40):
        quote = " ".join(rng.choice(words, int(rng.integers(1, 30))).tolist())
        quotes.append((f"q{k}", quote))
        said = list(quote)
        for at in rng.choice(len(said), min(len(said), k % 7 * max(1, len(said) // 25)), replace=False):
            said[at] = "x"
        spaced = "".join(said).replace(" ", "  \n" if k % 3 == 0 else " ")
        texts.append((k, " ".join(rng.choice(words, 20).tolist()) + " " + spaced.upper() * (k % 2) + spaced * (1 - k % 2) + "，ende"))
    quotes += [("short", "ab"), ("marks", "—"), ("empty", ""), ("null", None)]
    texts += [(100, None), (101, ""), (102, "zzAB — ab"), (103, "—")]
    q, t = spark.createDataFrame(quotes, "i string, q string"), spark.createDataFrame(texts, "d long, t string")
    want = {(r.d, r.i, r.fit) for r in t.crossJoin(q).select("d", "i", unicode.fit(F.col("q"), F.col("t")).alias("fit")).where("fit <> 'none'").collect()}
    for most in (4_000_000, 300):
        assert {(r.d, r.i, r.fit) for r in quotations.quoted(t, q, "d", "t", "i", "q", most_chars=most).collect()} == want
    assert {f for _, _, f in want} == {"exact", "normalised", "near"}


def test_unicode(spark):
    df = spark.createDataFrame([("ｆｕｌｌ",), ("café",), ("plain",), (None,)], "n string")
    got = [tuple(r) for r in df.select(unicode.unicode_form(F.col("n")), unicode.without_accents(F.col("n"))).collect()]
    assert got == [("full", "ｆｕｌｌ"), ("café", "cafe"), ("plain", "plain"), (None, None)]


def test_resolve(spark):
    known = spark.createDataFrame([(1, "p1", "c1", "salt"), (2, "p2", None, "sugar"), (3, "p1", "c3", "")], "id long, p string, c string, n string")
    new = spark.createDataFrame([(10, "p1", "c1", None), (11, "p2", "c1", None), (12, None, None, "salt"), (13, "", "c9", ""), (14, None, "c3", "other")], "row int, p string, c string, n string")
    got = {r.row: (r.match_id, r.match) for r in identity.resolve(new, known, "id", ["p", "c"], ["n"]).collect()}
    assert got == {10: (1, "strong"), 11: (None, "conflict"), 12: (1, "weak"), 13: (None, "none"), 14: (3, "strong")}
    assert {r.match_id for r in identity.resolve(new, known, "id", ["p", "c"], ["n"], strict=True).where("match = 'weak'").collect()} == {None}


def test_nearest_blocks(spark):
    known = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 2.0]), (4, [1.0, 0.0, 0.0]), (5, None)], "id long, v array<double>")
    new = spark.createDataFrame([(10, [3.0, 0.0]), (11, [0.1, 1.0]), (12, None), (13, [0.0, 0.0]), (14, [1.0]), (15, [0.0, 1.0, 0.0])], "id long, v array<double>")
    got = {r.id: (r.nearest_id, round(r.similarity, 4)) for r in identity.nearest(new, known, "id", "v", leaves=2, rows=2).collect()}
    assert got == {10: (1, 1.0), 11: (3, 0.995), 12: (None, 0.0), 13: (None, 0.0), 14: (None, 0.0), 15: (4, 0.0)}
    assert {r.nearest_id for r in identity.nearest(new, known.limit(0), "id", "v").collect()} == {None}


def test_task_state_over_triggers(spark, tmp_path):
    steps = [(1, "b"), (1, "f"), (1, "b"), (1, "e"), (2, "b"), (2, "f"), (2, "b"), (2, "f"), (2, "b"), (2, "f"), (2, "b"), (3, "e"), (4, "b"), (4, "x")]
    for k, (task, what) in enumerate(steps):
        spark.createDataFrame([(task, what, k)], "task long, what string, n long").coalesce(1).write.mode("append").parquet(f"{tmp_path}/events")
    stream = spark.readStream.schema("task long, what string, n long").option("maxFilesPerTrigger", 5).parquet(f"{tmp_path}/events")
    found = []
    q = streams.tasks(stream, "task", "what", ["n"], "b", "f", "e").writeStream.outputMode("update").option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).foreachBatch(lambda b, _: found.extend(b.collect())).start()
    q.awaitTermination()
    last = {r.task: (r.state, r.attempts, r.seen) for r in sorted(found, key=lambda r: r.seen)}
    assert last == {1: ("done", 2, 4), 2: ("dead_letter", 3, 7), 3: ("pending", 0, 1), 4: ("in_progress", 1, 1)} and len(found) > len(last)
