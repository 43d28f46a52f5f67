"""Operators on small tables of their own: bounds that used to be, known cases, brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from gristmill.functions import ingredients as ing, physics, text
from gristmill.operators import graph, identity, records, tables
from gristmill.plans.catalog import QUERIES
from gristmill.sources import files

DATA = "/root/testdata/sf0.001"


def test_distribution_far_from_zero(spark):
    df = spark.createDataFrame([("a", 1e9 + k) for k in range(4)] + [("b", 5.0), ("b", None), (None, 7.0)], "g string, v double")
    got = {r.g: r for r in tables.distribution(df, ["g"], "v").collect()}
    assert got["a"].stdev == pytest.approx(math.sqrt(5 / 3), abs=1e-6) and got["a"].median == 1e9 + 2 and got["b"].stdev == 0 and got["b"].n == 1 and got[None].p95 == 7


def test_running_over_a_hot_group(spark):
    rows = [("hot", k, k % 7) for k in range(5000)] + [("cold", k, 1) for k in range(3)] + [(None, k, 2) for k in range(3)]
    df = spark.createDataFrame(rows, "g string, k int, n long").repartition(5)
    got = tables.running(df, ["g"], ["k"], "n", "s").collect()
    sums = {}
    for g, k, n in sorted(rows, key=lambda r: (str(r[0]), r[1])):
        sums[g, k] = sums.get((g, k - 1), 0) + n
    assert {(r.g, r.k): r.s for r in got} == sums
    assert sorted(r.place for r in tables.numbered(df.where("g = 'hot'"), ["g"], ["k"], "place").collect()) == list(range(1, 5001))
    assert tables.running(df.limit(0), ["g"], ["k"], "n", "s").count() == 0


@pytest.mark.parametrize("count", [30, 12_000])
def test_intervals(spark, count):
    rng = np.random.default_rng(1)
    starts = rng.integers(0, 5 * count, count)
    spans = [(int(s), int(s + rng.integers(0, 9)), f"n{k}", k) for k, s in enumerate(starts)]
    points = spark.createDataFrame([(int(p),) for p in rng.integers(-5, 5 * count + 20, 400)] + [(None,)], "p long")
    got = tables.in_interval(points, "p", spark.createDataFrame(spans, "start long, end long, name string, ord int"))
    want = lambda p: next((n for s, e, n, _ in reversed(spans) if p is not None and s <= p <= e), None)
    assert got.count() == 401 and all(r.name == want(r.p) for r in got.collect())


def test_rules_are_sent_to_the_rows(spark):
    for name, table in (("step_rule_edges", "events"), ("outlier_filter_distribution", "lineitem"), ("fallback_enrichment", "part")):
        plan = QUERIES[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan or name.startswith("outlier"), name
        for part in plan.split("BroadcastExchange")[1:]:
            assert f"{table}.parquet" not in part.split("BroadcastHashJoin")[0].split("Join")[0][:2000] or name.startswith("outlier"), name


def test_long_chain_is_peeled(spark):
    chain = spark.createDataFrame([(k, k + 1) for k in range(230)], "src long, dst long")
    free, cyclic = graph.acyclic_part(chain)
    assert cyclic.count() == 0 and free.count() == 230


def test_cycles(spark):
    edges = spark.createDataFrame([("a", "bb"), ("bb", "c"), ("c", "a"), ("x", "y"), ("y", "x"), ("c", "d"), ("e", "a"), ("p", "q")], "src string, dst string")
    assert sorted(tuple(r.cycle) for r in graph.cycles(edges).collect()) == [("a", "bb", "c", "a"), ("x", "y", "x")]
    stay, gone = graph.without_cycles(edges)
    assert sorted(map(tuple, gone.collect())) == [("a", "bb"), ("y", "x")] and stay.count() == 6 and graph.cycles(stay).count() == 0
    assert graph.cycles(edges.limit(0)).count() == 0


def test_stubs_and_edges(spark):
    made = spark.createDataFrame([("cheese", "milk", "", "Drying"), ("milk", "milk", "cow", None), ("", "x", "y", "z")], "id string, a string, b string, p string")
    edges = graph.typed_edges(made, "id", {"IS_A": (["a"], F.lit("")), "DERIVED_FROM": (["b", "a"], ing.process_type(F.col("p"))), "ROLE": (["a"], F.lit(""))}, {"ROLE": ["french"]})
    assert sorted(map(tuple, edges.collect())) == [("cheese", "milk", "DERIVED_FROM", "dried"), ("cheese", "milk", "IS_A", ""), ("milk", "cow", "DERIVED_FROM", "mixed")]
    assert [tuple(r) for r in graph.stubs(edges, spark.createDataFrame([("cheese",), ("milk",)], "id string"), "id").collect()] == [("cow", "cow", "stub", 1)]


def test_prefilter_cases(spark):
    cases = [
        (("fuji_apple", None, None, None, None), None), (("leucine", None, "x", None, None), "chemical"), (("pyrrolidine_x", "(S)-Pyrrolidine-2-carboxylic", None, None, None), "chemical"), (("Unknown_Thing", None, None, None, "unknown thing"), "data_incomplete"),
        (("unknown_thing", "", " ", "", "a real name"), None), (("17th_century", None, "x", None, None), "noise"), (("1990s", None, "x", None, None), "noise"), (("3_musketeers_bar", None, "x", None, None), "brand"), (("100_percent_foo_candy_bar", None, "x", None, None), None),
        (("00_flour", None, "x", None, None), None), (("oreochromis_niloticus", "Oreochromis", None, None, None), None), (("oreo", None, "x", None, None), "brand"), (("brandy", None, "x", None, None), None), (("babyfood_pear", None, "x", None, None), "babyfood"), ((None, None, None, None, None), "data_incomplete"),
    ]
    df = spark.createDataFrame([c for c, _ in cases], "id string, sci string, zh string, en string, ingredient string")
    assert [r[0] for r in df.select(ing.prefiltered(*map(F.col, df.columns))).collect()] == [w for _, w in cases]


def test_enums_put_right(spark):
    df = spark.createDataFrame([(["noise_excluded", "noise", None, "odd"], "liquid", "dropped", "unclear"), (None, None, "excluded", None), ([], "part", "active", "noise_time_period"), (["suspect"], "species", "excluded", "brand")], "i array<string>, f string, s string, r string")
    once = df.select(ing.put_right(*map(F.col, df.columns)).alias("x")).select("x.*")
    got = [(r.issue_codes, r.form_type, r.tree_status, r.exclusion_reason, len(r.repairs)) for r in once.collect()]
    assert got == [(["noise", "odd", "canonical_id_ambiguity"], "ambiguous", "needs_review", None, 4), (["auto_assigned_other_reason"], None, "excluded", "other", 1), ([], "part", "active", "noise", 1), (["suspect"], "species", "excluded", "brand", 0)]
    again = once.select(ing.put_right(F.col("issue_codes"), F.col("form_type"), F.col("tree_status"), F.col("exclusion_reason")).alias("x")).select("x.*")
    assert all(r.repairs == [] for r in again.collect()) and [r.issue_codes for r in again.collect()] == [r[0] for r in got]


def test_profiles(spark):
    times, temperatures = [0.0, 10.0, 25.0, 30.0, 50.0, 60.0], [100.0, 110.0, 118.0, 121.0, 119.0, 90.0]
    whole = lambda n: spark.range(1).select(physics.f_value_profile(F.array(*map(F.lit, times[:n])), F.array(*map(F.lit, temperatures[:n])), F.lit(121.1), F.lit(10.0)).alias("f")).first().f
    rate = [10 ** ((t - 121.1) / 10) for t in temperatures]

    def parabola(i, a, b):  # the integral from a to b of the parabola through three samples
        c = np.polyfit(times[i : i + 3], rate[i : i + 3], 2)
        return np.polyval(np.polyint(c), b) - np.polyval(np.polyint(c), a)

    assert whole(1) == 0 and whole(2) == pytest.approx(10 * (rate[0] + rate[1]) / 2 / 60) and whole(3) == pytest.approx(parabola(0, 0, 25) / 60)
    assert whole(4) == pytest.approx((parabola(0, 0, 25) + parabola(1, 25, 30)) / 60) and whole(6) == pytest.approx((parabola(0, 0, 25) + parabola(2, 25, 50) + parabola(3, 50, 60)) / 60)


def test_limits_and_forms(spark):
    e = physics.evaluate
    df = spark.createDataFrame([(5.0, 4.6), (4.0, 4.6), (None, 4.6)], "p double, m double")
    assert [r[0] for r in df.select(e("MF-K06", pH=F.col("p"), pH_min=F.col("m"))).collect()] == [0.0, 1.0, None]
    one = spark.range(1).select(e("MF-K06").alias("none"), e("MF-K06", conc=3.0, MIC=3.0).alias("mic"), e("MF-M05", H=2.0, p=3.0, form="p/c").alias("inverse"), e("MF-T05", rho=1.0, L=1.0, d=1.0, Tf=0.0, Tinf=-1.0, h=1.0, k=1.0).alias("slab")).first()
    assert one.none is None and one.mic == 1.0 and one.inverse == 1.5 and one.slab == pytest.approx(1 / 2 + 1 / 8)


def test_resembling_earlier(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(12, 8))
    v = np.concatenate([c + rng.normal(size=(40, 8)) * 0.3 for c in centres])
    rows = [(k, x.tolist()) for k, x in enumerate(v)] + [(900, None), (901, [0.0] * 8), (902, [1.0])]
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    want = sorted(j for j in range(len(v)) if (unit[:j] @ unit[j] > 0.9).any())
    df = spark.createDataFrame(rows, "id long, v array<double>")
    assert sorted(r.id for r in identity.resembling_earlier(df, "id", "v", 0.9, leaves=10, rows=25).collect()) == want and 0 < len(want) < len(v)
    assert identity.resembling_earlier(df.limit(0), "id", "v", 0.9).count() == 0


def test_many_anchors(spark):
    rng = np.random.default_rng(3)
    v, a = rng.normal(size=(50, 6)), rng.normal(size=(60, 6))
    df, known = spark.createDataFrame([(k, x.tolist()) for k, x in enumerate(v)], "id long, v array<double>"), spark.createDataFrame([(k, x.tolist()) for k, x in enumerate(a)], "a long, w array<double>")
    like = np.round((v / np.linalg.norm(v, axis=1, keepdims=True)) @ (a / np.linalg.norm(a, axis=1, keepdims=True)).T, 6)
    want = {(i, int(j)) for i in range(50) for j in np.argsort(-like[i], kind="stable")[:3]}
    for block in (7, 512):
        assert {(r.id, r.known) for r in identity.nearest_of(df, known, "id", "v", "a", "w", 3, block=block).collect()} == want


def test_topped_up_and_sections(spark):
    df = spark.createDataFrame([("g", k, k < 2) for k in range(20)] + [("h", k, True) for k in range(3)], "g string, k int, s boolean")
    got = records.topped_up(df, ["g"], "s", {True: 4, False: 3}, ["k"]).collect()
    assert {(r.g, r.k, r.topped_up) for r in got} == {("g", k, k > 4) for k in range(7)} | {("h", k, False) for k in range(3)}
    lines = ["x", "# a", "b", "# c", "d", "e", "# f", "g"]
    found = records.gapped_sections(spark.createDataFrame([(1, "\n".join(lines)), (2, "none"), (3, None)], "id long, t string"), "id", "t", "^# ", 3).collect()
    assert [(r.id, r.begins, r.n_lines) for r in found] == [(1, 1, 5), (1, 6, 2)]


def test_replies(spark):
    cases = [('{"a": 1}', '{"a": 1}'), ('<think>{"b": 2}</think>\n [1]', "[1]"), ('say ```json\n{"a": [1]}\n``` so', '{"a": [1]}'), ("x {\"a\": 1} y", '{"a": 1}'), ("{broken", None), (None, None), ("", None)]
    df = spark.createDataFrame([(c,) for c, _ in cases], "t string")
    assert [r[0] for r in df.select(text.reply_json(F.col("t"))).collect()] == [w for _, w in cases]
    labels = [("x → B, not A", "B"), ("Label: a\nAnswer: C", "C"), ("B-vitamin\nD", "D"), ("Aroma", None), (None, None)]
    assert [r[0] for r in spark.createDataFrame([(c,) for c, _ in labels], "t string").select(text.reply_label(F.col("t"))).collect()] == [w for _, w in labels]
    specs = [("1-3,7", [1, 2, 3, 7]), (" 5-4 , ,4", [4, 5]), ("", None), (None, None)]
    assert [r[0] for r in spark.createDataFrame([(c,) for c, _ in specs], "t string").select(text.pages_of(F.col("t"))).collect()] == [w for _, w in specs]


def test_snapshots(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    about = files.snapshot(df, str(tmp_path), "one")
    assert about["rows"] == 2 and sorted(files.restored(spark, str(tmp_path), "one").collect()) == sorted(df.collect())
    with pytest.raises(ValueError):
        files.snapshot(df, str(tmp_path), "one")
    df.limit(1).write.mode("overwrite").parquet(f"{tmp_path}/one/rows")
    with pytest.raises(ValueError):
        files.restored(spark, str(tmp_path), "one")


def test_manifests(spark, tmp_path):
    for name, what in (("a", "1"), ("b", "2")):
        (tmp_path / name).write_text(what)
    first = files.manifest(spark, str(tmp_path)).collect()
    (tmp_path / "a").write_text("3")
    (tmp_path / "c").write_text("4")
    now = files.changed(files.manifest(spark, str(tmp_path)), spark.createDataFrame(first, "path string, bytes long, sha256 string"))
    assert {(r.path[-1], r.state) for r in now.collect()} == {("a", "changed"), ("c", "new")}


def test_documents_per_file(spark, tmp_path):
    (tmp_path / "x.json").write_text('[{"page": 1},\n {"page": 2}]')
    (tmp_path / "y.json").write_text('{"page":\n 3}')
    assert {(r.file_id, r.page) for r in files.documents_per_file(spark, str(tmp_path), "page int").collect()} == {("x", 1), ("x", 2), ("y", 3)}


def test_lag_over_a_hot_group(spark):
    rows = [("hot", k, k * 3 if k % 5 else None) for k in range(4000)] + [("cold", 1, 7), (None, 2, 8), (None, 3, 9)]
    got = tables.lagged(spark.createDataFrame(rows, "g string, k int, v int").repartition(6), ["g"], ["k"], "v", "last").collect()
    want, last = {}, {}
    for g, k, v in sorted(rows, key=lambda r: (str(r[0]), r[1])):
        want[g, k], last[g] = last.get(g), v
    assert {(r.g, r.k): r.last for r in got} == want
