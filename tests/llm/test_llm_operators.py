"""Each operator against SQL or a brute-force version on small tables with nulls, empty, very long and repeated rows, ties and clashing columns."""

import base64
import hashlib
import re
import zlib

import duckdb
import numpy as np
import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F

from gristmill.llm import ann, decontaminate, langid, mixing, quality, queries, sharding, simhash, substrings, url_filter, warc
from gristmill.llm.components import components

DATA = "/root/testdata/sf0.001"
LONG = " ".join(f"w{i}" for i in range(60_000))
PASSAGE = " ".join(f"shared{i}" for i in range(25))
TEXTS = [(1, "the cat sat on the mat " * 3), (2, "the cat sat on the mat " * 3), (3, None), (4, ""), (5, LONG), (6, f"before {PASSAGE} after"), (7, f"{PASSAGE} else where"), (7, f"{PASSAGE} else where"), (None, f"none {PASSAGE}"), (9, LONG + " more"), (10, "...!! ?"), (11, "Ça va été"), (None, None)]
SPARE = ", size long, shard int, key string, tokens int, rate double, c0 string, _id int, fp int, h int, source string, lang string"
WORD = re.compile("[^\x20\x09-\x0d]+")


def docs(spark, extra=False, texts=TEXTS):
    more = (1, 2, "k", 3, 0.5, "c", 4, 5, 6)
    return spark.createDataFrame([(i, t, *more, None if k % 5 == 4 else f"s{k % 3}", ("en", "fr")[k % 2]) for k, (i, t) in enumerate(texts)], "doc_id long, text string" + SPARE)


def some(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages"):
        con.sql(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    want, got = con.execute(queries.ORACLES[name]).df(), queries.QUERIES[name](spark, DATA).toPandas()
    plain = lambda d: sorted(tuple("-" if pd.isna(v) else str(int(v)) if isinstance(v, float) else str(v) for v in r) for r in d[sorted(want.columns)].astype(object).values.tolist())
    assert plain(got) == plain(want)


def fingerprint(t):
    w = (t or "").encode().translate(bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))).split()
    hashes = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 3]), 42) for i in range(max(1, len(w) - 2))] if w else []
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def test_simhash(spark):
    fps = [fingerprint(t) for _, t in TEXTS]
    group = list(range(len(fps)))
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                group = [group[j] if g == group[i] else g for g in group]
    low = {g: min((i for (i, _), h in zip(TEXTS, group) if h == g and i is not None), default=None) for g in group}
    want = sorted([(i, f - (f >> 63 << 64), low[g]) for (i, _), f, g in zip(TEXTS, fps, group)], key=lambda r: tuple((v is None, str(v)) for v in r))
    assert some(simhash.near_duplicates(docs(spark)), "doc_id", "fp", "component_id") == want
    kept = simhash.one_of_each(docs(spark))
    assert kept.count() == len(set(group)) and kept.columns == docs(spark).columns
    assert simhash.near_duplicates(docs(spark).limit(0)).count() == 0


def test_anchors_lose_no_link(spark):
    rng = np.random.default_rng(1)
    points = set()
    for b in rng.integers(0, 2**63, 40, dtype=np.uint64).tolist():
        for _ in range(40):
            x = b
            for k in rng.integers(0, 64, rng.integers(0, 4)).tolist():
                x ^= 1 << k
            points.add(x)
    p = np.array(sorted(points), np.uint64)
    near, label = np.bitwise_count(p[:, None] ^ p[None, :]) <= 3, np.arange(len(p))
    while ((new := np.where(near, label[None, :], len(p)).min(axis=1)) != label).any():
        label = new
    found = simhash.links(spark.createDataFrame(pd.DataFrame({"fp": p.view(np.int64)})))
    got = {r.node: r.component for r in components(found).collect()}
    for g in np.unique(label):
        assert len({got.get(int(x), int(x)) for x in p.view(np.int64)[label == g]}) == 1
    small = simhash.links_of(p, np.ones(len(p), bool), 0, 16)
    assert {int(x) for a, b in small for x in (*a, *b)} <= {int(x) for x in p}


def repeats(texts, n=20):
    seen, out = {}, []
    order = sorted(range(len(texts)), key=lambda k: (texts[k][0] is None, texts[k][0] or 0))
    removed = {}
    for k in order:
        w = WORD.findall(texts[k][1] or "")
        gone = set()
        for s in range(len(w) - n + 1):
            win, at = tuple(w[s : s + n]), (texts[k][0], s)
            first = seen.setdefault(win, at)
            if first != at:
                gone.update(range(s, s + n))
        removed[k] = (len(w), len(gone), hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest())
    return [(texts[k][0], *removed[k]) for k in range(len(texts))]


def test_substrings(spark):
    texts = [*TEXTS, (20, "again and " * 40), (21, "x y " * 9), (22, f"q {PASSAGE[9:]} {PASSAGE}")]
    got = substrings.without_repeats(docs(spark, texts=texts)).withColumn("sha", F.sha2("kept", 256))
    want = sorted(repeats(texts), key=lambda r: tuple((v is None, str(v)) for v in r))
    assert some(got, "doc_id", "n_words", "n_removed", "sha") == want
    assert substrings.without_repeats(docs(spark).limit(0)).count() == 0


def test_decontamination(spark):
    bench = spark.createDataFrame([("a", f"{PASSAGE} tail"), ("b", "cat sat"), ("b", "va ÉTÉ"), ("c", None), ("d", "..."), (None, "ça va")], "item_id string, text string")
    got = {(r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in decontaminate.decontaminate(docs(spark), bench).collect()}
    assert (1, 18, 6, ("b",)) in got and (6, 27, 25, ("a",)) in got and (None, 26, 25, ("a",)) in got and (3, 0, 0, ()) in got and (5, 60000, 0, ()) in got
    assert any(r[0] == 11 and r[2] == 0 for r in got)  # only A-Z is lower-cased
    kept = decontaminate.clean(docs(spark), bench)
    assert kept.columns == docs(spark).columns and {r.doc_id for r in kept.select("doc_id").collect()} == {3, 4, 5, 9, 10, 11, None}
    assert decontaminate.clean(docs(spark), bench.limit(0)).count() == len(TEXTS)
    assert decontaminate.decontaminate(docs(spark).limit(0), bench).count() == 0
    tight = decontaminate.decontaminate(docs(spark), bench, most_tokens=10)
    assert {(r.doc_id, r.n_hit) for r in tight.collect()} == {(g[0], g[2]) for g in got}


def test_proximity(spark):
    words = [f"t{i}" for i in range(12)]
    moved = [*words[:4], "gap", *words[4:8], "gap", *words[8:]]
    table = spark.createDataFrame([(1, " ".join(moved)), (2, " ".join(words)), (3, " gap ".join(words))], "doc_id long, text string")
    got = {r.doc_id: r for r in decontaminate.decontaminate(table, spark.createDataFrame([("i", " ".join(words))], "item_id string, text string")).collect()}
    assert got[1].n_hit == 0 and got[1].near_items == ["i"] and got[2].n_hit == 12 and got[2]["items"] == ["i"] and got[3].n_hit == 0


def test_mixing(spark):
    sources, rng = ["a", "b", None, "c"], np.random.default_rng(0)
    data = [(int(i), " ".join(["w"] * int(rng.integers(0, 60))), sources[int(rng.integers(0, 4))]) for i in range(400)]
    data += [(1, "w w", "a"), (1, "w w", "a"), (900, None, "b"), (901, "", "c"), (902, "w " * 3000, "a")]
    df = spark.createDataFrame(data, "doc_id long, text string, source string")
    got = mixing.mix(df, block=64).toPandas()
    assert len(got) == len(data) and (got.copies <= 2).all() and got["size"].sum() == sum(len(WORD.findall(t or "")) for _, t, _ in data)
    size = {}
    for _, t, s in data:
        size[s] = size.get(s, 0) + len(WORD.findall(t or ""))
    names = sorted([s for s in size if s is not None]) + [None]
    weight, open_, left, target = dict(zip(names, (3, 1, 2, 3))), set(names), 1.5 * sum(size.values()), {}
    while True:
        over = [s for s in open_ if left * weight[s] / sum(weight[x] for x in open_) > 2 * size[s]]
        if not over:
            target |= {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
            break
        for s in over:
            target[s] = 2 * size[s]
            open_.discard(s)
            left -= 2 * size[s]
    for t, part in got.groupby("target"):
        want = min(target.values(), key=lambda v: abs(v - t))
        assert t == pytest.approx(want) and abs((part.copies * part["size"]).sum() - want) <= max(200, 0.02 * want)
    again = mixing.mix(df.repartition(7), block=64).toPandas()
    key = ["doc_id", "size", "copies"]
    assert sorted(map(tuple, got[key].values)) == sorted(map(tuple, again[key].values))
    mixed = mixing.repeated(docs(spark))
    assert mixed.columns == docs(spark).columns and mixed.count() > 0 and mixing.mix(df.limit(0)).count() == 0


def test_sharding(spark):
    df = docs(spark, texts=TEXTS + [(100 + i, "x" * (i % 17)) for i in range(200)])
    got = sharding.shard(df, 3).toPandas()
    assert len(got) == df.count()
    for _, part in got.groupby("shard"):
        assert sorted(part.slot) == list(range(len(part)))
    assert (got.groupby(["size", "text_crc32"]).shard.nunique() == 1).all()
    assert (got[got["size"] == 1].text_crc32 == 0).all() and got[got.doc_id == 1].text_crc32.iloc[0] == zlib.crc32(TEXTS[0][1].encode())
    assert sharding.shard(df.limit(0)).count() == 0
    even = sharding.shard(spark.range(3000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("ab"), (F.col("id") % 97).cast("int")).alias("t0"), F.concat(F.repeat(F.lit("ab"), (F.col("id") % 97).cast("int")), F.col("id").cast("string")).alias("text")), 4).groupBy("shard").agg(F.sum("size").alias("b")).toPandas()
    assert even.b.max() - even.b.min() <= 4


def test_packing():
    rng = np.random.default_rng(2)
    for _ in range(30):
        sizes = [int(x) for x in rng.integers(1, 40, rng.integers(1, 60))]
        rooms = []
        for s in sorted(sizes, reverse=True):
            fit = [r for r in rooms if r >= s]
            if fit:
                rooms[rooms.index(min(fit))] -= s
            else:
                rooms.append(50 - s)
        counts = sorted({s: sizes.count(s) for s in sizes}.items())
        runs = sharding.best_fit_decreasing(counts, 50)
        load = {}
        for s, a, b, box in runs:
            load[box] = load.get(box, 0) + s * (b - a)
        assert sorted(load.values()) == sorted(50 - r for r in rooms)


def test_warc(spark, tmp_path):
    tricky = "a\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nx"
    pages = spark.createDataFrame([(1, "http://a.net/", "same"), (2, "http://a.net/", "same"), (2, "http://a.net/", "same"), (3, None, tricky), (4, "http://b/\r\nX: 1", None), (5, "", ""), (None, "u", "same"), (6, "ü", "é" * 100_000)], "page_id long, url string, html string")
    warc.write(pages, str(tmp_path / "w"))
    found = warc.read(spark, str(tmp_path / "w"))
    got = warc.resolved(found).toPandas()
    assert len(got) == 8 and got.has_request.all()
    by = {(None if pd.isna(r.page_id) else int(r.page_id)): r for r in got.itertuples()}
    assert by[1].record_type == "response" and by[None].record_type == "revisit" and by[None].refers_to == 1 and by[2].refers_to == 1
    assert by[3].payload_bytes == len(tricky) and by[4].record_type == "response" and by[5].refers_to == 4 and by[5].payload_bytes == 0 and by[6].payload_bytes == 200_000
    assert by[2].payload_bytes == 4 and by[3].payload_digest == base64.b32encode(hashlib.sha1(tricky.encode()).digest()).decode()
    assert warc.captures(pages, least=5).where("first_no is not null").count() == 0


def test_urls(spark):
    hosts = ["a.net", "net", "x.a.net", "xa.net", "", "a.org", "A.Org", "b.a.org:80", ".net", "a.net."]
    urls = [f"http://{h}{p}" for h in hosts for p in ("", "/", "/en/x", "/fr/y?z=/en/", "/en#f")] + [None, "no scheme", "x://a.net/en/://b", "http://a.net/en/" + "y" * 100_000]
    rules = [("net", "/", "block"), ("a.net", "/en/", "allow"), ("x.a.net", "/", "allow"), ("org", "/fr/", "block"), ("", "/fr", "block"), (None, "/", "block")]
    table = spark.createDataFrame([(i % 40, u) for i, u in enumerate(urls)], "page_id long, url string").withColumn("host", F.lit(1)).withColumn("rule", F.lit(2))
    got = url_filter.judge(table, spark.createDataFrame(rules, "host string, path string, verdict string"), keep=("page_id", "url"), ranges=7).collect()

    def want(u):
        if u is None or "://" not in u:
            host, path = "", ""
        else:
            host, path = re.match(r"([^/?#]*)([^?#]*)", u.split("://", 1)[1], re.S).groups()
            host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
        fit = [(len(h + p), len(h), v, h + p) for h, p, v in rules if h is not None and (h == "" or host == h or host.endswith("." + h)) and path.startswith(p)]
        return (host, path, *((max(fit)[3], max(fit)[2]) if fit else (None, "allow")))

    assert len(got) == len(urls) and all((r.host, r.path, r.rule, r.verdict) == want(r.url) for r in got)


def test_neighbours(spark):
    rng = np.random.default_rng(3)
    v = rng.normal(size=(600, 16)).astype(np.float32)
    rows = [(i, v[i].tolist()) for i in range(600)] + [(600 + i, v[0].tolist()) for i in range(50)] + [(700, None), (701, [0.0] * 16), (702, [float("nan")] * 16), (703, [1.0] * 3), (704, []), (None, v[1].tolist()), (0, v[0].tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = ann.search(df, df.where("vec_id % 20 = 0"), 10).toPandas()
    ids = np.array([r[0] for r in rows[:650]])
    m = np.array([r[1] for r in rows[:650]], np.float64)
    hit = total = 0
    for q in range(0, 650, 20):
        s = m @ m[q]
        best = [i for i in np.lexsort((ids, -s)) if i != q][:10]
        part = got[got.query_id == ids[q]].sort_values("rank")
        assert list(part["rank"]) == list(range(1, 11)) and np.allclose(part.score, s[part.vec_id])
        hit, total = hit + len(set(ids[best]) & set(part.vec_id)), total + 10
    assert hit / total >= 0.9
    assert ann.search(df.limit(0), df.limit(0)).count() == 0


def test_language(spark):
    got = langid.op4(spark, DATA).toPandas()
    truth = spark.read.parquet(f"{DATA}/documents.parquet").toPandas().merge(got, on="doc_id")
    held = truth[truth.held_out]
    assert (held.lang == held.lang_pred).mean() > 0.95 and got.score.between(0, 1).all()
    odd = {r.doc_id: r for r in langid.predict(docs(spark), langid.fit(docs(spark), order=("doc_id", "text"))).where("doc_id is not null").collect()}
    assert odd[3].lang_pred == odd[4].lang_pred == odd[10].lang_pred == "und" and odd[3].score == 0 and odd[5].lang_pred in ("en", "fr")
    assert {r.lang_pred for r in langid.predict(docs(spark), None).collect()} == {"und"}
    assert langid.accepted(docs(spark)).columns == docs(spark).columns


def test_quality(spark):
    got = quality.op2(spark, DATA).toPandas()
    labels = spark.read.parquet(f"{DATA}/labels.parquet").toPandas().merge(got, on="doc_id")
    assert labels[labels.quality == 1].keep.mean() > 0.97 and labels[labels.quality == 0].keep.mean() < 0.1
    odd = quality.classify(docs(spark)).toPandas()
    assert len(odd) == len(TEXTS) and not odd[odd.doc_id == 3].keep.any() and quality.classify(docs(spark).limit(0)).count() == 0


def test_estimate():
    rng = np.random.default_rng(4)
    truth = rng.random(20000) < 0.7
    right = np.array([0.95, 0.8, 0.6])
    votes = np.where(rng.random((20000, 3)) < right, truth[:, None], ~truth[:, None]).astype(int)
    votes[rng.random((20000, 3)) < 0.3] = -1
    patterns, back, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    posterior, rates, prior = quality.estimate(patterns, counts.astype(float))
    assert abs(rates[:, 0] - right).max() < 0.05 and abs(prior - 0.7) < 0.05 and ((posterior[back] > 0.5) == truth).mean() > 0.85


def test_pipeline(spark):
    import corpus_pipeline

    from test_nearcopies import firsts

    source = spark.read.parquet(f"{DATA}/documents.parquet")
    out = corpus_pipeline.run(spark, DATA).toPandas()
    known = [(r.doc_id, r.text, r.source) for r in corpus_pipeline.known_language(spark, source, DATA).collect()]
    assert {i for i, _, _ in known} <= {r.doc_id for r in source.collect() if re.search("[^\\W\\d_]", r.text or "")}
    one = {*firsts([(i, t) for i, t, _ in known])}
    windows = lambda t: [tuple(w[k : k + min(10, len(w))]) for w in [re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))] if w for k in range(len(w) - min(10, len(w)) + 1)]
    bench = {w for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect() for w in windows(r.text)}
    assert {len(w) for w in bench} == {10}
    clean = {i: (len(WORD.findall(t)), s) for i, t, s in known if i in one and not bench & {*windows(t)}}
    copies = out.doc_id.value_counts().to_dict()
    assert set(copies) <= set(clean) and max(copies.values()) <= 2
    total, weight, size = sum(n for n, _ in clean.values()), {}, {}
    for k, name in enumerate(sorted({s for _, s in clean.values()})):
        weight[name], size[name] = (3, 1, 2)[k % 3], sum(n for n, s in clean.values() if s == name)
    aim, open_ = {}, set(size)
    while open_:  # what a cap cuts off is shared again
        level = (1.5 * total - sum(aim.values())) / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > 2 * size[s]}
        aim |= {s: 2 * size[s] if s in over else level * weight[s] for s in over or open_}
        open_ -= over or open_
    for name, goal in aim.items():
        taken = sum(clean[i][0] * c for i, c in copies.items() if clean[i][1] == name)
        assert abs(taken - goal) <= max(0.02 * goal, max(n for n, s in clean.values() if s == name)), (name, taken, goal)
    for _, part in out.groupby("shard"):
        assert sorted(part.slot) == list(range(len(part)))
    load = out.assign(n=[len((t or "").encode()) + 1 for t in out.text]).groupby("shard").n.sum()
    assert load.max() - load.min() <= 0.02 * load.mean() and out.groupby("text").shard.nunique().max() == 1
