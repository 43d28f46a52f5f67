"""Language identification by a byte convolutional network, trained and applied in numpy.

Bytes are folded into classes (A-Z as a-z, digits as one, ASCII white space as one). Filters of several widths run over fixed-length windows
of byte classes; the largest response of each filter in a window goes through a rectifier and a softmax layer. A byte's embedding and a
filter's weights at one offset only ever occur as their product, so both are one table from byte class to responses. To apply a width-w
filter, the tables of neighbouring offsets are added up beforehand for all pairs of classes, which leaves one look-up for two bytes.

A text is cut into windows from its first byte to its last. Its log-probabilities are the means over its windows, weighted by their bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .session import small_batches
from .text import column_bytes, in_pieces

WINDOW, WIDTHS, FILTERS = 256, (2, 3, 4), 8
#: Bounds of the training sample: documents of each language, of all languages (but each has LEAST_DOCS), and windows of each document.
SAMPLE_DOCS, ALL_DOCS, LEAST_DOCS, SAMPLE_WINDOWS = 800, 51_200, 8, 4


def _classes() -> tuple[np.ndarray, int]:
    table, n = np.zeros(256, np.uint8), 1  # 0: padding
    letters = {c: None for c in range(256)}
    for c in letters:
        table[c] = 1 if c in (0x20, *range(0x09, 0x0E)) else 2 if 0x30 <= c <= 0x39 else 3 if c < 0x41 or 0x5B <= c < 0x61 or 0x7B <= c < 0x80 else 0
    n = 4
    for c in [*range(0x61, 0x7B), *range(0x80, 256)]:
        table[c] = n = n if c == 0x61 else n + 1
    for c in range(0x41, 0x5B):
        table[c] = table[c + 0x20]
    return table, n + 1


CLASS, CLASSES = _classes()


def windows_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of all texts as byte classes (padded with 0), the text of each and the bytes in it."""
    size = np.diff(offsets)
    count = -(-size // WINDOW)
    text = np.repeat(np.arange(len(size)), count)
    within = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    begin = offsets[:-1][text] + within * WINDOW
    bytes_in = np.minimum(WINDOW, offsets[1:][text] - begin)
    at = begin[:, None] + np.arange(WINDOW)
    inside = np.arange(WINDOW) < bytes_in[:, None]
    return np.where(inside, CLASS[data[np.minimum(at, max(0, len(data) - 1))]], 0) if len(text) else np.zeros((0, WINDOW), np.uint8), text, bytes_in


@dataclass
class Network:
    languages: list[str]
    tables: list[np.ndarray]  # one for each width: width, classes, filters
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    def prepared(self) -> list[list[np.ndarray]]:
        """For each width, what its pairs of bytes add (classes * classes, filters), and its last byte if the width is odd."""
        return [[(t[k][:, None, :] + t[k + 1][None, :, :]).reshape(-1, t.shape[2]) if k + 1 < len(t) else t[k] for k in range(0, len(t), 2)] for t in self.tables]

    def apply(self, x: np.ndarray, prepared: list[list[np.ndarray]]) -> np.ndarray:
        """Log-probabilities of windows, 64 at a time."""
        logits = np.empty((len(x), len(self.languages)))
        for a in range(0, len(x), 64):
            part = x[a : a + 64]
            single = part.astype(np.int32)
            pair = single[:, :-1] * CLASSES + single[:, 1:]
            tops = []
            for width, tables in zip(WIDTHS, prepared, strict=True):
                n = WINDOW - width + 1
                response = None
                for k, table in enumerate(tables):
                    got = table.take((pair if 2 * k + 1 < width else single)[:, 2 * k : 2 * k + n], axis=0)
                    response = got if response is None else np.add(response, got, out=response)
                tops.append(response.max(axis=1))
            top = np.maximum(np.concatenate(tops, axis=1) + self.bias, 0)
            logits[a : a + 64] = top @ self.out + self.out_bias
        logits -= logits.max(axis=1, keepdims=True)
        return logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))


def train(x: np.ndarray, y: np.ndarray, languages: list[str], epochs: int = 8, batch: int = 64, rate: float = 0.01, seed: int = 42) -> Network:
    """Adam on the mean cross-entropy of windows; through the maximum, the gradient reaches the one place of a window that gave it."""
    rng = np.random.default_rng(seed)
    f, n = FILTERS, len(languages)
    params = [rng.normal(0, 0.1, (w, CLASSES, f)).astype(np.float32) for w in WIDTHS] + [np.zeros(f * len(WIDTHS), np.float32), rng.normal(0, 0.3, (f * len(WIDTHS), n)).astype(np.float32), np.zeros(n, np.float32)]
    first, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for a in range(0, len(x), batch):
            xb, yb = x[order[a : a + batch]].astype(np.int64), y[order[a : a + batch]]
            m, tops, places = len(xb), [], []
            for w, table in zip(WIDTHS, params, strict=False):
                span = WINDOW - w + 1
                response = sum(table[k].take(xb[:, k : k + span], axis=0) for k in range(w))
                at = response.argmax(axis=1)
                places.append(at)
                tops.append(np.take_along_axis(response, at[:, None, :], axis=1)[:, 0])
            raw = np.concatenate(tops, axis=1) + params[-3]
            top = np.maximum(raw, 0)
            logits = top @ params[-2] + params[-1]
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(m), yb] -= 1
            p /= m
            down = (p @ params[-2].T) * (raw > 0)
            grads = [np.zeros_like(t) for t in params[: len(WIDTHS)]] + [down.sum(axis=0), top.T @ p, p.sum(axis=0)]
            for i, (w, at) in enumerate(zip(WIDTHS, places, strict=True)):
                for k in range(w):
                    symbol = np.take_along_axis(xb, at + k, axis=1)
                    np.add.at(grads[i][k], (symbol, np.broadcast_to(np.arange(f), symbol.shape)), down[:, i * f : (i + 1) * f])
            step += 1
            for q, g, u, v in zip(params, grads, first, second, strict=True):
                u += 0.1 * (g - u)
                v += 0.001 * (g * g - v)
                q -= (rate * (u / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return Network(languages, params[: len(WIDTHS)], *params[len(WIDTHS) :])


def no_language(windows: list[bytes], seed: int = 42) -> list[bytes]:
    """A text of no language for every fifth window, as long as it: its characters in any order, table debris, letters by chance, other scripts' letters by chance."""
    rng, out = np.random.default_rng(seed), []
    debris, letters = list("|-=+.,;:#$%&*/()[]{}<>_~^ \t\n0123456789" * 3 + "abxyz"), list("abcdefghijklmnopqrstuvwxyz    ")
    scripts = [[chr(c) for c in range(a, a + n)] + [" "] * (n // 6) for a, n in ((0x391, 57), (0x410, 64), (0x5D0, 27), (0x621, 42), (0x905, 50), (0x3041, 86), (0x4E00, 2000), (0xAC00, 2000))]
    for k, window in enumerate(windows[::5]):
        kind = k % 4 if len(window) >= 100 else 1 + k % 3
        among = list(window.decode("utf-8", "ignore")) if kind == 0 else debris if kind == 1 else letters if kind == 2 else scripts[int(rng.integers(len(scripts)))]
        made = rng.permutation(among) if kind == 0 else rng.choice(among, len(window))
        out.append("".join(made.tolist()).encode()[: len(window)])
    return out


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", order: tuple[str, ...] = ("doc_id",), seed: int = 42, noise: bool = False, docs_each: int = SAMPLE_DOCS, docs_all: int = ALL_DOCS, windows_each: int = SAMPLE_WINDOWS) -> Network | None:
    """A network of a bounded sample of labelled rows, None if no row has a label and a text.

    Of each language, however many there are, the rows with the smallest hash of their order columns and text are learned: docs_each, or fewer
    if docs_all must do for all languages, but LEAST_DOCS at least; of each text windows_each windows, spread evenly over it. Rows may share
    or lack an id; every language that has a row with a text has one in the sample. With noise, it also learns texts of no language, as und.
    """
    rows = labelled.where(F.col(lang).isNotNull() & (F.octet_length(F.col(text)) > 0))
    counts = {r[0]: r[1] for r in rows.groupBy(lang).count().orderBy(F.desc("count"), lang).collect()}  # one row for each language
    if not counts:
        return None
    wanted, place = list(counts), F.xxhash64(*order, F.lit(seed), text)
    most = max(LEAST_DOCS, min(docs_each, docs_all // len(counts)))
    # Only rows that can be among the smallest hashes are sorted: of a language with n rows, the share 4 * most / n of all hashes (all hashes, if that is more than 1).
    bound = labelled.sparkSession.createDataFrame([(name, -(2**63) + min(n, 4 * most) * (2**64 - 1) // n) for name, n in counts.items()], "_lang string, _bound long")
    n_windows = F.ceil(F.octet_length(text) / WINDOW)
    raw = F.col(text).cast("binary")
    spread = F.transform(F.sequence(F.lit(0), F.least(F.lit(windows_each), n_windows) - 1), lambda i: F.substring(raw, (F.floor(i * n_windows / F.least(F.lit(windows_each), n_windows)) * WINDOW + 1).cast("int"), F.lit(WINDOW)))
    near = rows.join(F.broadcast(bound), F.col(lang) == F.col("_lang")).where(place <= F.col("_bound"))  # as many rows as languages, counted above
    own = Window.partitionBy(lang).orderBy(place, *order, text)

    def taken(some: DataFrame) -> list:
        picked = some.withColumn("_r", F.row_number().over(own)).where(F.col("_r") <= most)
        return picked.select(F.col(lang).alias("lang"), "_r", F.posexplode(spread).alias("_k", "w")).orderBy("lang", "_r", "_k").select("lang", "w").collect()

    got = taken(near)
    if lost := sorted(set(wanted) - {r["lang"] for r in got}):  # equal rows share a hash; a language made of few such groups may have none within its share
        got += taken(rows.join(F.broadcast(labelled.sparkSession.createDataFrame([(x,) for x in lost], "_lang string")), F.col(lang) == F.col("_lang")))
    texts, names = [bytes(r["w"]) for r in got], [r["lang"] for r in got]
    if noise:
        extra = no_language(texts, seed)
        texts, names = texts + extra, names + ["und"] * len(extra)
    languages = sorted({*wanted, *names})
    offsets = np.concatenate([[0], np.cumsum([len(w) for w in texts])])
    x, _, _ = windows_of(np.frombuffer(b"".join(texts), np.uint8), offsets)
    return train(x, np.array([languages.index(n) for n in names]), languages, seed=seed)


def predict(docs: DataFrame, network: Network | None, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns, lang_pred and score (0 to 1). Null texts and texts without a letter are und, with score 0; so are all if there is no network.

    Each row is judged by its text alone: rows with null or shared ids, and repeated rows, are rows like others. Empty tables give no rows.
    Texts of any length: windows are made and applied a few thousand at a time, and only their sums are kept.
    """
    small_batches(docs.sparkSession)
    narrow = docs.select(*keep, F.when(F.col(text).rlike(r"\p{L}"), F.col(text)).alias("_text"))
    schema = narrow.drop("_text").withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0)}).schema
    at = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prepared = network.prepared() if network else []
        for batch in in_pieces(batches):
            data, offsets = column_bytes(batch.column(at))
            names, scores = ["und"] * batch.num_rows, np.zeros(batch.num_rows)
            if network and len(data):
                total = np.zeros((batch.num_rows, len(network.languages)))
                cuts = np.unique(np.concatenate([offsets, *[np.arange(a, b, 1 << 20) for a, b in zip(offsets[:-1], offsets[1:], strict=True) if b - a > 1 << 20]]))
                i = 0
                while i < len(cuts) - 1:
                    j = max(i + 1, int(np.searchsorted(cuts, cuts[i] + (1 << 20), "right")) - 1)
                    x, part, n = windows_of(data[cuts[i] : cuts[j]], cuts[i : j + 1] - cuts[i])
                    text_of = np.searchsorted(offsets, cuts[i:j], "right") - 1
                    np.add.at(total, text_of[part], network.apply(x, prepared) * n[:, None])
                    i = j
                some = np.flatnonzero(np.diff(offsets) > 0)
                mean = total[some] / np.diff(offsets)[some, None]
                p = np.exp(mean - mean.max(axis=1, keepdims=True))
                p /= p.sum(axis=1, keepdims=True)
                for k, best, s in zip(some.tolist(), p.argmax(axis=1).tolist(), p.max(axis=1).tolist(), strict=True):
                    names[k], scores[k] = network.languages[best], s
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], pa.array(names), pa.array(scores)], names=[*batch.schema.names[:at], "lang_pred", "score"])

    return narrow.mapInArrow(run, schema)


def _held_out(id: str):
    return F.coalesce(F.crc32(F.col(id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    network = fit(docs.where(~_held_out("doc_id")))
    return predict(docs, network).select("doc_id", _held_out("doc_id").alias("held_out"), "lang_pred", "score")


def accepted(docs: DataFrame, least: float = 0.0, id: str = "doc_id", text: str = "text", lang: str = "lang", junk: float = 0.9) -> DataFrame:
    """The rows of docs, with all their columns, whose language is told with at least that score; und goes.

    By default a text that mixes languages stays, however the score is divided. Null texts, texts without a letter, and texts that the network
    takes for no language (und) with a score above junk go; without any labelled row there is no network, and all go. Rows
    with null or shared ids and repeated rows are judged one by one; an empty table gives no rows.
    """
    columns = docs.columns
    flat = docs.select(*[F.col(c).alias(f"c{k}") for k, c in enumerate(columns)])
    found = predict(flat, fit(docs.where(~_held_out(id)), text, lang, (id,), noise=True), f"c{columns.index(text)}", tuple(flat.columns))
    told = F.when(F.col("lang_pred") == "und", (F.col("score") > 0) & (F.col("score") <= junk)).otherwise(True) & (F.col("score") >= least)
    return found.where(told).select(*[F.col(f"c{k}").alias(c) for k, c in enumerate(columns)])
