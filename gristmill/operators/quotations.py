"""Quotations in texts: as they stand, without white space and marks, or with a few other characters."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..functions.unicode import comparable
from ..session import ship

_BASE = np.uint64(0x9E3779B97F4A7C15)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


def _hashed(codes: np.ndarray, length: int) -> np.ndarray:
    """A hash of every so many consecutive characters."""
    n = len(codes) - length + 1
    out = np.zeros(max(0, n), np.uint64)
    for k in range(length if n > 0 else 0):
        out = out * _BASE + codes[k : k + n]
    return out


class _Quotes:
    """Quotes cut into one segment more than characters may differ: of a quotation that fits, at least one segment stands in the text as it is."""

    def __init__(self, rows: list[tuple[str, str, str]], least: int, share: int):
        self.items, self.raw = [r[0] for r in rows], [r[1] for r in rows]
        self.codes = [_codes(r[2]) for r in rows]
        self.most = [max(1, len(c) // share) if len(c) >= least else 0 for c in self.codes]
        found: dict[int, list[tuple[int, int, int]]] = {}
        for k, (c, most) in enumerate(zip(self.codes, self.most, strict=True)):
            length = len(c) // (most + 1)
            for s in range(most + 1 if length else 0):
                found.setdefault(length, []).append((int(_hashed(c[s * length : (s + 1) * length], length)[0]), k, s * length))
        self.segments = {}
        for length, entries in found.items():
            entries.sort()
            self.segments[length] = (np.array([e[0] for e in entries], np.uint64), np.array([e[1] for e in entries]), np.array([e[2] for e in entries]))
        self.bare = [k for k, c in enumerate(self.codes) if not len(c)]

    def fits(self, text: str, plain: str) -> Iterator[tuple[str, str]]:
        codes, best = _codes(plain), {}
        for length, (hashes, quotes, starts) in self.segments.items():
            windows = _hashed(codes, length)
            low, high = (np.searchsorted(hashes, windows, side) for side in ("left", "right"))
            count = high - low
            at = np.repeat(np.flatnonzero(count), count[count > 0])
            entry = np.repeat(low[count > 0], count[count > 0]) + np.arange(len(at)) - np.repeat(np.cumsum(count[count > 0]) - count[count > 0], count[count > 0])
            for k, begin in sorted({*zip(quotes[entry].tolist(), (at - starts[entry]).tolist(), strict=True)}):
                quote = self.codes[k]
                if 0 <= begin <= len(codes) - len(quote) and best.get(k, 1) > 0:
                    wrong = int((codes[begin : begin + len(quote)] != quote).sum())
                    if wrong <= self.most[k]:
                        best[k] = min(wrong, best.get(k, wrong))
        for k in [*best, *self.bare]:
            if self.raw[k] in text:
                yield self.items[k], "exact"
            elif k in best:
                yield self.items[k], "normalised" if best[k] == 0 else "near"


def quoted(docs: DataFrame, quotes: DataFrame, id: str, text: str, item: str, quote: str, least: int = 5, share: int = 10, most_chars: int = 4_000_000) -> DataFrame:
    """id, item and fit of every quotation that a text holds: exact (as it stands), normalised (equal without white space and marks, in any case) or
    near (some place of the text differs in at most one of so many characters, one at least; for quotations of at least so many).

    Whole quotations are looked for in whole texts, and none that fits is missed. Quotations are taken in slices of about so many characters,
    which bounds what is sent to the tasks; each slice reads the texts once. Null and empty texts and quotations fit nothing; items are strings.
    """
    spark = docs.sparkSession
    ship(spark)
    wanted = quotes.where((F.col(quote) != "") & F.col(item).isNotNull()).select(F.col(item).cast("string").alias("item"), F.col(quote).alias("raw"), comparable(F.col(quote)).alias("plain")).distinct()
    n_slices = -(-(wanted.agg(F.sum(F.char_length("raw"))).first()[0] or 0) // most_chars)
    texts = docs.where(F.col(text) != "").select(F.col(id).alias("_id"), F.col(text).alias("_text"), comparable(F.col(text)).alias("_plain"))
    schema = texts.select("_id").withColumns({"item": F.lit(""), "fit": F.lit("")}).schema
    out = spark.createDataFrame([], schema)
    for k in range(n_slices):
        known = _Quotes([tuple(r) for r in wanted.where(F.pmod(F.xxhash64("item", "raw"), F.lit(n_slices)) == k).orderBy("item", "raw").collect()], least, share)

        def run(batches: Iterator[pa.RecordBatch], known: _Quotes = known) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows, items, fits = [], [], []
                for row, (whole, plain) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)):
                    for name, fit in known.fits(whole, plain):
                        rows.append(row)
                        items.append(name)
                        fits.append(fit)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), pa.array(items, pa.string()), pa.array(fits, pa.string())], names=["_id", "item", "fit"])

        out = out.unionByName(texts.mapInArrow(run, schema))
    return out.select(F.col("_id").alias(id), F.col("item").alias(item), "fit")
