"""Bounds that used to be: more than 64 languages, mixes that are hard to solve, archives by record."""

import gzip
import io

import numpy as np
import pytest
from pyspark.sql import functions as F

from gristmill.llm import ann, langid, mixing, sharding, warc
from gristmill.llm.text import in_pieces


def test_rare_languages_are_learned(spark):
    rng = np.random.default_rng(1)
    letters = [chr(c) for c in range(0x4E00, 0x4E00 + 70 * 6)]
    rows = []
    for lang in range(70):
        own = letters[lang * 6 : lang * 6 + 6]
        rows += [(f"l{lang:02d}", "".join(rng.choice(own, 120).tolist()), lang * 100 + k) for k in range(12 if lang else 40)]
    docs = spark.createDataFrame(rows, "lang string, text string, doc_id long")
    network = langid.fit(docs)
    assert len(network.languages) == 70
    got = langid.predict(docs, network, keep=("lang",)).groupBy("lang").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("right")).collect()
    assert len(got) == 70 and np.mean([r.right for r in got]) > 0.8


def test_plain_convolution(spark):
    """The paired look-up tables against filters that are slid over the bytes one by one."""
    rng = np.random.default_rng(2)
    texts = [bytes(rng.integers(32, 127, n).tolist()) for n in (3, 100, 256, 700)]
    x, _, _ = langid.windows_of(np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])]))
    tables = [rng.normal(size=(w, langid.CLASSES, langid.FILTERS)) for w in langid.WIDTHS]
    network = langid.Network(["a", "b", "c"], tables, rng.normal(size=langid.FILTERS * 3), rng.normal(size=(langid.FILTERS * 3, 3)), rng.normal(size=3))
    want = []
    for window in x:
        tops = []
        for w, table in zip(langid.WIDTHS, tables):
            tops.append(np.max([sum(table[k, window[at + k]] for k in range(w)) for at in range(langid.WINDOW - w + 1)], axis=0))
        logits = np.maximum(np.concatenate(tops) + network.bias, 0) @ network.out + network.out_bias
        want.append(logits - np.log(np.exp(logits).sum()))
    assert np.allclose(network.apply(x, network.prepared()), np.array(want))


@pytest.mark.parametrize("newton", [0, 40])
def test_rates_solve_the_dual(spark, newton):
    """Each source's tilted rates meet its target, by Newton steps or by bisection alone, and steep tilts too."""
    rng = np.random.default_rng(3)
    rows = [(s, int(n), 1) for s in range(4) for n in (rng.pareto(0.7, 300) * 5 + 1).astype(int)]
    histogram = spark.createDataFrame(rows, "sid long, size long, n long").groupBy("sid", "size").agg(F.sum("n").alias("n"))
    state = histogram.groupBy("sid").agg(F.sum(F.col("size") * F.col("n")).alias("tokens"), F.sum("n").alias("docs")).withColumn("target", F.col("tokens") * F.element_at(F.array(*map(F.lit, (0.02, 0.9, 1.2, 1.97))), (F.col("sid") + 1).cast("int")))
    solved = {r.sid: r for r in mixing.multipliers(histogram, state, 2.0, newton_steps=newton).collect()}
    for sid, r in solved.items():
        part = np.array([n for s, n, _ in rows if s == sid], float)
        got = (part * np.minimum(2, np.exp(r.lam * part / r.unit))).sum()
        assert abs(got - r.target) <= 1e-6 * r.target, (sid, got, r.target)


def test_rows_that_share_an_id_are_spread(spark):
    docs = spark.range(4000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("s").alias("source"), F.concat_ws(" ", F.sequence(F.lit(1), F.col("id") % 7 + 1), F.col("id")).alias("text"))
    got = mixing.mix(docs, block=64)
    assert got.count() == 4000
    total = got.agg(F.sum("size")).first()[0]
    assert abs(got.agg(F.sum(F.col("copies") * F.col("size"))).first()[0] - 1.5 * total) <= 0.01 * total


def test_archives_by_record(spark, tmp_path):
    rows = [(k, f"http://x/{k}", "é" * k + "WARC/1.1\r\n\r\nWARC/1.1") for k in range(40)] + [(40, None, None), (41, "http://x/1", "z" * 3_000_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    warc.write(pages, str(tmp_path / "a"), per_file=10_000)
    files = sorted((tmp_path / "a").glob("archive=*/part-*"))
    assert len(files) > 1
    whole = b"".join(f.read_bytes() for f in files)
    assert whole.count(b"\x1f\x8b\x08\x00\x00\x00\x00\x00") >= 2 * 3 * len(rows)  # a member for each record, and an empty one after it
    for f in files:
        with gzip.open(f) as archive:
            assert archive.read(8) == b"WARC/1.1"
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    got = {r.page_id: r for r in warc.resolved(warc.read(spark, str(tmp_path / "a"))).collect()}
    assert {k: got[k].payload_bytes for k, _, _ in rows} == {k: len((h or "").encode()) for k, _, h in rows}
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "500"  # what is smaller already stays
    one = (tmp_path / "b")
    one.mkdir()
    (one / "part-0.gz").write_bytes(gzip.compress(gzip.decompress(whole)))
    (one / "part-1").write_bytes(gzip.decompress(files[0].read_bytes()))
    assert warc.read(spark, str(one)).count() == 3 * len(rows) + sum(1 for _ in warc._parse(io.BytesIO(gzip.decompress(files[0].read_bytes()))))


def test_doubles_and_blocks_of_queries(spark, monkeypatch):
    monkeypatch.setattr(ann, "QUERIES", 7)
    monkeypatch.setattr(ann, "BLOCK", 64)
    rng = np.random.default_rng(4)
    v = rng.normal(size=(300, 12)) * (1 + 1e-12)
    df = spark.createDataFrame([(k, x.tolist()) for k, x in enumerate(v)], "vec_id long, embedding array<double>")
    got = ann.search(df, df.where("vec_id % 10 = 0"), 5, probe=1.0).toPandas()
    best = [(q, r, int(k)) for q in range(0, 300, 10) for r, k in enumerate([k for k in np.argsort(-(v @ v[q]), kind="stable") if k != q][:5], 1)]
    found = {(a, b): (c, s) for a, b, c, s in got[["query_id", "rank", "vec_id", "score"]].itertuples(index=False)}
    assert np.mean([found[q, r][0] == k for q, r, k in best]) >= 0.95
    assert all(abs(s - v[q] @ v[int(k)]) < 1e-13 * (1 + abs(s)) for (q, _), (k, s) in found.items())


def test_rooms_are_taken_tightest_first():
    rng, rooms, plain = np.random.default_rng(5), sharding.Rooms(), []
    for k in range(4000):
        if rng.random() < 0.6 or not plain:
            plain.append((int(rng.integers(0, 300)), k))
            rooms.put(*plain[-1])
        else:
            least = int(rng.integers(0, 350))
            want = min((p for p in plain if p[0] >= least), default=None)
            assert rooms.take(least) == want
            if want:
                plain.remove(want)


def test_pieces_of_batches():
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(range(5000)), pa.array(["x" * 100_000 if k == 7 else "y" for k in range(5000)])], names=["a", "b"])
    parts = list(in_pieces([batch, batch.slice(0, 0)], 1000))
    assert [p.num_rows for p in parts] == [1000] * 5 and sum(p.num_rows for p in parts) == 5000


def test_archives_are_cut_by_bytes_and_found_by_any_name(spark, tmp_path):
    import random

    noise = random.Random(1)
    texts = [noise.randbytes(50_000 if k % 9 == 4 else 300).hex() for k in range(60)]
    pages = spark.createDataFrame(list(enumerate(texts)), "page_id long, html string").withColumn("url", F.lit("http://x/")).coalesce(1)
    warc.write(pages, str(tmp_path / "a"), per_file=30_000)
    files = sorted((tmp_path / "a").glob("archive=*/part-*"))
    assert len(files) >= 6 and max(f.stat().st_size for f in files) < 30_000 + 70_000  # one record more
    (tmp_path / "b" / "deep").mkdir(parents=True)
    (tmp_path / "b" / "CC-MAIN-0001.warc.gz").write_bytes(files[0].read_bytes())
    (tmp_path / "b" / "deep" / "any.warc").write_bytes(gzip.decompress(files[1].read_bytes()))
    n = [sum(1 for _ in warc._parse(io.BytesIO(gzip.decompress(f.read_bytes())))) for f in files]
    assert warc.read(spark, str(tmp_path / "b")).count() == n[0] + n[1]
    assert warc.read(spark, str(tmp_path / "a")).count() == 3 * len(texts)


def test_every_language_is_learned_where_ids_are_null(spark):
    one = {"en": "the house and the garden are old", "de": "das Haus und der Garten sind alt", "fr": "la maison et le jardin sont vieux"}
    rows = [(None, f"{t} {k if lang == 'fr' else ''}", lang) for lang, t in one.items() for k in range(9000 if lang == "en" else 400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(8)
    network = langid.fit(docs, docs_each=50)
    assert network.languages == ["de", "en", "fr"]
    found = langid.predict(docs.dropDuplicates(), network, keep=("lang",)).collect()
    assert len(found) == 402 and all(r["lang"] == r["lang_pred"] for r in found)


def test_empty_tables(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    assert langid.fit(docs) is None and langid.predict(docs, None).collect() == [] and langid.accepted(docs).collect() == []
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write(pages, str(tmp_path / "none"))
    (tmp_path / "none").mkdir(exist_ok=True)
    assert warc.resolved(warc.read(spark, str(tmp_path / "none"))).collect() == []
