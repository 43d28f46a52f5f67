"""A quality classifier without labels: overlapping heuristic labellers, whose accuracies expectation-maximisation estimates, teach a hashed linear scorer.

Each labeller votes good, bad or nothing on a document. What the model of votes needs is how often each pattern of votes occurs, counted
over all documents; there are at most 3 ** labellers patterns. The posterior of a pattern labels its documents, and a logistic model over
hashed byte 4-grams and hashed words learns from a bounded sample of them. The scorer reads whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .session import cut, small_batches
from .text import ALNUM, CLASS_SPACE, NOT_SPACE, column_bytes, in_pieces, mix, pieces, words

U = np.uint64
BITS = 16
#: Bound of the training sample: documents with the smallest hash of their id, for each side of the posterior.
SAMPLE_DOCS = 3000
#: Bound of what is fitted of a sampled text: longer ones give so many pieces of so many bytes, spread evenly. Texts are scored whole.
PIECES, PIECE = 8, 4096
LABELLERS = ("symbols", "shouting", "repetition", "columns", "endings", "length", "variety", "plain", "letters", "pairs")


def measures(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns and, of each whole text, n (words) and per word: symbols, capitals, repeats of the word before, bars, sentence ends, bytes, distinct words, words that end plainly, distinct pairs of neighbours, and letters per byte that is no white space."""
    small_batches(docs.sparkSession)
    names = ["n", "symbols", "capitals", "again", "bars", "ends", "bytes", "distinct", "plain", "pairs", "letters"]
    narrow = docs.select(*keep, F.col(text).alias("_text"))
    schema = narrow.drop("_text").withColumns({c: F.lit(0.0) for c in names}).schema
    at = len(keep)
    kinds = np.zeros((6, 256), np.int64)
    kinds[0, [ord(c) for c in "#$%&*!<>{}[]^~=+@\\_"]] = 1
    kinds[1, range(0x41, 0x5B)] = 1
    kinds[2, ord("|")] = 1
    kinds[3, [ord(c) for c in ".?!"]] = 1
    kinds[4] = NOT_SPACE
    kinds[5, [*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 256)]] = 1
    plainly = np.zeros(256, np.int64)
    plainly[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 256), *map(ord, ".,;:?)'\"")]] = 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_pieces(batches):
            data, offsets = column_bytes(batch.column(at))
            out = np.zeros((len(names), batch.num_rows))
            for i, j in pieces(offsets):
                part, edge = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
                _, last, hashes, first = words(part, edge)
                n = np.diff(first)
                plain = np.concatenate([[0], np.cumsum(plainly[part[last - 1]])])
                same = np.concatenate([[0], np.cumsum(hashes[1:] == hashes[:-1]), [0]]) if len(hashes) else np.zeros(1, np.int64)
                again = np.where(n > 1, same[np.maximum(first[1:] - 1, 0)] - same[np.minimum(first[:-1], max(len(hashes) - 1, 0))], 0)
                row = np.repeat(np.arange(j - i), n)
                order = np.lexsort((hashes, row))
                new = np.ones(len(hashes), bool)
                new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (row[order][1:] != row[order][:-1])
                sums = [np.concatenate([[0], np.cumsum(k[part])]) for k in kinds]
                per = [s[edge[1:]] - s[edge[:-1]] for s in sums]
                distinct = np.bincount(row[order][new], minlength=j - i)
                inner = np.flatnonzero(row[1:] == row[:-1])
                pair = mix(hashes[inner] * U(3) + hashes[inner + 1])
                _, once = np.unique(pair ^ mix(row[inner].astype(U)), return_index=True)
                pairs = np.bincount(row[inner][once], minlength=j - i)
                shares = [x / np.maximum(n, 1) for x in (per[0], per[1], again, per[2], per[3], np.diff(edge), distinct, plain[first[1:]] - plain[first[:-1]], pairs)]
                out[:, i:j] = np.stack([n, *shares, per[5] / np.maximum(per[4], 1)])
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], *map(pa.array, out)], names=[*batch.schema.names[:at], *names])

    return narrow.mapInArrow(run, schema)


def votes() -> list[Column]:
    """1 good, 0 bad, null no opinion; one for each of LABELLERS, over the columns of measures()."""
    c = F.col
    some = c("n") > 0
    rules = [
        F.when(c("symbols") > 0.4, 0).when(c("symbols") < 0.05, 1),
        F.when(c("capitals") > 1.5, 0).when((c("capitals") < 0.4) & (c("capitals") > 0.01), 1),
        F.when(c("again") > 0.1, 0).when((c("again") < 0.02) & (c("n") >= 20), 1),
        F.when(c("bars") > 0.2, 0).when((c("bars") == 0) & (c("n") >= 50), 1),
        F.when((c("ends") < 0.01) & (c("n") >= 20), 0).when(c("ends").between(0.03, 0.3), 1),
        F.when((c("bytes") > 12) | (c("bytes") < 2.5), 0).when(c("bytes").between(4, 8) & (c("n") >= 30), 1),
        F.when((c("distinct") < 0.2) & (c("n") >= 50), 0).when((c("distinct") > 0.35) & (c("n") >= 50), 1),
        F.when(c("plain") < 0.7, 0).when(c("plain") > 0.9, 1),
        F.when(c("letters") < 0.87, 0).when(c("letters") > 0.93, 1),
        F.when((c("pairs") < 0.3) & (c("n") >= 20), 0).when((c("pairs") > 0.6) & (c("n") >= 20), 1),
    ]
    return [F.when(some, rule).otherwise(F.lit(0) if k == 0 else F.lit(None)).cast("int").alias(name) for k, (name, rule) in enumerate(zip(LABELLERS, rules, strict=True))]


def estimate(patterns: np.ndarray, counts: np.ndarray, prior: float = 0.8, rounds: int = 100) -> tuple[np.ndarray, np.ndarray, float]:
    """EM for conditionally independent labellers that may abstain. patterns: 1, 0 or -1 (no vote). Posterior of good for each pattern,
    each labeller's (chance to vote good on a good document, to vote good on a bad one), and the share of good documents.

    Each kind of bad document is seen by a few labellers and approved by the others. So it starts from objections that are seldom wrong and approvals
    that say little, which also makes good mean good; smoothing keeps all chances off 0 and 1.
    """
    rates = np.tile([0.95, 0.6], (patterns.shape[1], 1))
    good, voted = patterns == 1, patterns >= 0
    for _ in range(rounds):
        logs = [np.where(voted, np.where(good, np.log(rates[:, s]), np.log(1 - rates[:, s])), 0).sum(axis=1) for s in (0, 1)]
        odds = logs[0] - logs[1] + np.log(prior / (1 - prior))
        posterior = 1 / (1 + np.exp(-np.clip(odds, -50, 50)))
        before = rates.copy()
        for s, weight in enumerate((posterior * counts, (1 - posterior) * counts)):
            rates[:, s] = (weight @ (good & voted) + (4, 1)[s]) / (weight @ voted + 5)
        prior = float(np.clip((posterior @ counts + 4) / (counts.sum() + 5), 0.01, 0.99))
        if abs(before - rates).max() < 1e-7:
            break
    return posterior, rates, prior


def _features(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """For runs of texts: the first, the buckets of their features, the text of each, and the number of texts. Byte 4-grams and words."""
    for i, j in pieces(offsets, 1 << 19):
        part, edge = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        _, _, hashes, first = words(part, edge, ALNUM)
        if len(part) >= 4:
            wide = CLASS_SPACE[part].astype(np.uint32)
            grams = (wide[:-3] | wide[1:-2] << 8 | wide[2:-1] << 16 | wide[3:] << 24) * np.uint32(0x9E3779B1) >> np.uint32(32 - BITS)
            size = np.maximum(np.diff(edge) - 3, 0)
            at = np.repeat(edge[:-1], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            grams = grams[at].astype(np.int64)
        else:
            grams, size = np.zeros(0, np.int64), np.zeros(j - i, np.int64)
        yield i, np.concatenate([grams, (hashes >> U(64 - BITS)).astype(np.int64)]), np.concatenate([np.repeat(np.arange(j - i), size), np.repeat(np.arange(j - i), np.diff(first))]), j - i


def train(texts: list[bytes], target: np.ndarray, rounds: int = 150, rate: float = 0.5, decay: float = 1e-4) -> tuple[np.ndarray, float]:
    """Full-batch Adam for a logistic model over each text's mean of hashed features, towards posterior labels; balanced by side."""
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    rows, cols, vals = [], [], []
    for i, bucket, text, n in _features(np.frombuffer(b"".join(texts), np.uint8), offsets):
        key, count = np.unique(text * (1 << BITS) + bucket, return_counts=True)
        t = key >> BITS
        rows.append(t + i)
        cols.append(key & ((1 << BITS) - 1))
        vals.append(count / np.bincount(t, count, minlength=n)[t])
    r, c, v = (np.concatenate(x) for x in (rows, cols, vals))
    w, b = np.zeros(1 << BITS), 0.0
    side = np.where(target >= 0.5, 0.5 / max((target >= 0.5).sum(), 1), 0.5 / max((target < 0.5).sum(), 1))
    m, s = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for k in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(r, v * w[c], minlength=len(texts)) + b, -30, 30)))
        e = (p - target) * side
        g = np.append(np.bincount(c, v * e[r], minlength=len(w)) + decay * w / len(w), e.sum())
        m, s = 0.9 * m + 0.1 * g, 0.999 * s + 0.001 * g * g
        move = rate * (m / (1 - 0.9**k)) / (np.sqrt(s / (1 - 0.999**k)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return w.astype(np.float32), float(b)


def score(docs: DataFrame, weights: np.ndarray, bias: float, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    small_batches(docs.sparkSession)
    narrow = docs.select(*keep, F.col(text).alias("_text"))
    schema = narrow.drop("_text").withColumn("score", F.lit(0.0)).schema
    at = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_pieces(batches):
            data, offsets = column_bytes(batch.column(at))
            out = np.zeros(batch.num_rows)
            for i, bucket, row, n in _features(data, offsets):
                count = np.bincount(row, minlength=n)
                mean = np.bincount(row, weights[bucket], minlength=n) / np.maximum(count, 1)
                out[i : i + n] = np.where(count > 0, 1 / (1 + np.exp(-np.clip(mean + bias, -30, 30))), 0.0)
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], pa.array(out)], names=[*batch.schema.names[:at], "score"])

    return narrow.mapInArrow(run, schema)


def classify(docs: DataFrame, id: str = "doc_id", text: str = "text", sample: int = SAMPLE_DOCS, seed: int = 42, pieces: int = PIECES, piece: int = PIECE) -> DataFrame:
    """Per row: id, the labellers' votes, posterior (of being good, from the votes), score (of the trained scorer), keep (score of at least 0.5).

    Null texts and texts without words are bad (posterior by the first labeller's vote, score 0). Repeated rows come out repeated. If all
    documents of the sample fall on one side, the scorer learns that side. An empty table gives no rows. sample: the bound of the rows of
    each side that the scorer is fitted on, those with the smallest hash of id and text; of a text longer than pieces * piece bytes it learns
    that many pieces, spread evenly over it. Everything else covers all rows and whole texts.
    """
    spark = docs.sparkSession
    measured = cut(measures(docs.select(F.col(id).alias("_id"), F.xxhash64(text).alias("_h"), F.col(text).alias("_text")), "_text", ("_id", "_h")).select("_id", "_h", *votes()))
    code = sum((F.coalesce(F.col(v), F.lit(-1)) + 1) * 3**k for k, v in enumerate(LABELLERS)).cast("int")
    seen = {r[0]: r[1] for r in measured.groupBy(code.alias("code")).count().collect()}  # at most 3 ** 10 rows
    codes = np.array(sorted(seen), np.int64)
    patterns = np.stack([codes // 3**k % 3 - 1 for k in range(len(LABELLERS))], axis=1) if len(codes) else np.zeros((0, len(LABELLERS)), np.int64)
    posterior, _, _ = estimate(patterns, np.array([seen[c] for c in codes.tolist()], float))
    known = spark.createDataFrame([(int(c), float(p)) for c, p in zip(codes, posterior, strict=True)], "code int, posterior double")
    labelled = measured.withColumn("code", code).join(F.broadcast(known), "code").drop("code")  # at most 3 ** 10 rows
    order = F.xxhash64("_id", "_h", F.lit(seed))
    once = labelled.select("_id", "_h", "posterior").distinct()
    sides = [once.where(side).orderBy(order, "_id", "_h").limit(sample) for side in ("posterior >= 0.5", "posterior < 0.5")]
    picked = cut(sides[0].unionByName(sides[1]))  # at most 2 * sample rows
    raw = F.col(text).cast("binary")
    size = F.octet_length(raw)
    spread = F.concat(*[F.substring(raw, (F.floor((size - piece) * k / max(1, pieces - 1)) + 1).cast("int"), F.lit(piece)) for k in range(pieces)])
    named = docs.select(F.col(id).alias("_id"), F.xxhash64(text).alias("_h"), F.when(size <= pieces * piece, raw).otherwise(spread).alias("_text"))
    got = named.join(F.broadcast(picked), named._id.eqNullSafe(picked._id) & named._h.eqNullSafe(picked._h)).select(named._id, "_text", "posterior").where("octet_length(_text) > 0").dropDuplicates(["_id", "_text"]).orderBy("_id", "_text").collect()
    weights, bias = train([bytes(r["_text"]) for r in got], np.array([r["posterior"] for r in got])) if got else (np.zeros(1 << BITS, np.float32), 0.0)
    scored = score(docs.select(F.col(id).alias("_id"), F.xxhash64(text).alias("_h"), F.col(text).alias("_text")), weights, bias, "_text", ("_id", "_h")).withColumnsRenamed({"_id": "_i", "_h": "_t"})
    once = labelled.dropDuplicates(["_id", "_h"])
    met = scored.join(once, scored._i.eqNullSafe(once._id) & scored._t.eqNullSafe(once._h))
    return met.select(F.col("_id").alias(id), *LABELLERS, "posterior", "score", (F.col("score") >= 0.5).alias("keep"))


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "posterior", "score", "keep", *LABELLERS)
