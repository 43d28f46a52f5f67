"""SimHash fingerprints and near-duplicate groups by anchor-point covering.

A 64-bit fingerprint is cut into two halves of 32 bits. Two fingerprints that differ in at most 3 bits differ in at most 1 bit in one of the
halves. The anchors of a half are the words of the Hamming code of length 31 (the 32nd bit is kept as it is): a perfect code, so that every
half lies within the covering radius 1 of exactly one anchor. Each fingerprint is replicated to every anchor within the covering radius plus
the threshold of the half (1 + 1), and compared per anchor with the fingerprints whose home that anchor is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from .components import components
from .session import LAST, cut, key_of, small_batches
from .text import FOLD, column_bytes, in_pieces

U = np.uint64
THRESHOLD = 3
_FOLD = FOLD.tobytes()
_LANES = U(0x0101010101010101)


def fingerprint(text: bytes, shingle: int = 3, seed: int = 42) -> int:
    """Of whole text: lower-cases A-Z, splits at ASCII white space, and sets each bit that over half of the shingles' XXH64 have."""
    parts = text.translate(_FOLD).split()
    if not parts:
        return 0
    joined, digest = b" ".join(parts), xxhash.xxh64_intdigest
    if len(parts) <= shingle:
        return digest(joined, seed)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1)
    starts = np.concatenate([[0], ends[:-1]])[: len(parts) - shingle + 1].tolist()
    hashes = np.fromiter((digest(joined[a:b], seed) for a, b in zip(starts, (ends[shingle - 1 :] - 1).tolist(), strict=True)), U, len(starts))
    return majority(hashes)


def majority(hashes: np.ndarray) -> int:
    """The bits set in over half of the hashes; a byte of a word counts one bit of up to 255 hashes at once."""
    n = len(hashes)
    blocks = -(-n // 255)
    padded = np.zeros(blocks * 255, U)
    padded[:n] = hashes
    padded, out = padded.reshape(blocks, 255), 0
    for k in range(8):
        lanes = ((padded >> U(k)) & _LANES).sum(axis=1).view(np.uint8).reshape(blocks, 8).astype(np.int64).sum(axis=0)
        for byte in np.flatnonzero(2 * lanes > n):
            out |= 1 << (8 * int(byte) + k)
    return out


def fingerprints(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), shingle: int = 3, seed: int = 42) -> DataFrame:
    """The kept columns and fp long (the fingerprint's 64 bits, as a signed number). A null text has no words, so its fingerprint is 0."""
    small_batches(docs.sparkSession)
    narrow = docs.select(*keep, F.col(text).cast("binary").alias("_text"))
    schema = narrow.drop("_text").withColumn("fp", F.lit(0).cast("long")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_pieces(batches):
            data, offsets = column_bytes(batch.column(batch.num_columns - 1))
            whole = data.tobytes()
            fps = np.fromiter((fingerprint(whole[a:b], shingle, seed) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)), U, batch.num_rows)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(fps.view(np.int64))], names=[*batch.schema.names[:-1], "fp"])

    return narrow.mapInArrow(run, schema)


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Syndrome tables of the four bytes of a half; for each syndrome, the 15 pairs of bits whose flips give it."""
    column = np.arange(1, 32)
    table = np.zeros((4, 256), np.int64)
    for byte in range(4):
        for value in range(256):
            for bit in range(8):
                if value >> bit & 1 and 8 * byte + bit < 31:
                    table[byte, value] ^= column[8 * byte + bit]
    pairs = np.array([[(1 << (i - 1)) | (1 << ((i ^ s) - 1)) for i in range(1, 32) if i ^ s and i < i ^ s] if s else [0] * 15 for s in range(32)], U)
    return table, pairs


_SYNDROMES, _PAIRS = _tables()


def anchors(halves: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of 32-bit halves, every anchor within distance 2: (row, anchor, whether it is the row's home, the one within distance 1).

    The 32nd bit is no part of the code. A pair at distance 1 there still has the same home in the other 31 bits, so a row is listed under
    its home with either value of that bit, and under the 15 other anchors with its own value.
    """
    bits, n = halves.astype(U), len(halves)
    syndrome = np.zeros(n, np.int64)
    for byte in range(4):
        syndrome ^= _SYNDROMES[byte, ((bits >> U(8 * byte)) & U(255)).astype(np.int64)]
    home = bits ^ np.where(syndrome > 0, U(1) << np.maximum(syndrome - 1, 0).astype(U), U(0))
    off = np.flatnonzero(syndrome > 0)
    # Flipping two bits whose columns add up to the syndrome leads to the other code words within distance 2; from a code word there is none.
    far = (bits[off, None] ^ _PAIRS[syndrome[off]]).ravel()
    row = np.concatenate([np.arange(n), np.arange(n), np.repeat(off, 15)])
    return row, np.concatenate([home, home ^ U(1 << 31), far]), np.concatenate([np.ones(n, bool), np.zeros(len(row) - n, bool)])


def _replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fps = batch.column(0).to_numpy(zero_copy_only=False).view(U)
        for a in range(0, len(fps), 16384):
            part = fps[a : a + 16384]
            for half in (0, 1):
                row, anchor, home = anchors((part >> U(32 * half)) & U(0xFFFFFFFF))
                yield pa.RecordBatch.from_arrays([pa.array(((anchor << U(1)) | U(half)).view(np.int64)), pa.array(part[row].view(np.int64)), pa.array(home)], names=["anchor", "fp", "home"])


def _near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b) <= THRESHOLD


def _labels(fps: np.ndarray, homes: np.ndarray) -> np.ndarray:
    """Of an anchor's members, the least place that each is connected to over links to homes; in blocks, so memory stays small."""
    label = np.arange(len(fps))
    while True:
        before = label.copy()
        for a in range(0, len(homes), 512):
            block = homes[a : a + 512]
            low = label[block].copy()
            for m in range(0, len(fps), 4096):
                near = _near(fps[block][:, None], fps[None, m : m + 4096])
                low = np.minimum(low, np.where(near, label[None, m : m + 4096], len(fps)).min(axis=1))
            label[block] = low
            for m in range(0, len(fps), 4096):
                near = _near(fps[block][:, None], fps[None, m : m + 4096])
                label[m : m + 4096] = np.minimum(label[m : m + 4096], np.where(near, low[:, None], len(fps)).min(axis=0))
        if (label == before).all():
            return label


def links_of(fps: np.ndarray, home: np.ndarray, half: int, many: int = 1 << 22) -> list[tuple[np.ndarray, np.ndarray]]:
    """Of an anchor's members, one link for each that is connected to an earlier one: never more links than members.

    Where comparing all would be too much, the members are compared per value of each byte of the other half: fingerprints that differ in at
    most 3 bits there agree in one of its four bytes, so nothing is lost.
    """
    homes = np.flatnonzero(home)
    if not len(homes):
        return []
    if len(homes) * len(fps) <= many:
        label = _labels(fps, homes)
        moved = np.flatnonzero(label != np.arange(len(fps)))
        return [(fps[label[moved]], fps[moved])]
    out = []
    for byte in range(4):
        value = ((fps >> U(32 * (1 - half) + 8 * byte)) & U(255)).astype(np.int64)
        order = np.argsort(value, kind="stable")
        for part in np.split(order, np.flatnonzero(np.diff(value[order])) + 1):
            if len(part) > 1:
                out += links_of(fps[part], home[part], half, len(fps) ** 2)
    return out


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by anchor; what is left of the last anchor is carried over to the next batch."""

    def done(anchor: np.ndarray, fps: np.ndarray, home: np.ndarray) -> pa.RecordBatch:
        cuts = np.flatnonzero(np.diff(anchor)) + 1
        starts, ends = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(anchor)]])
        count = ends - starts
        two = starts[count == 2]
        two = two[(home[two] | home[two + 1]) & _near(fps[two], fps[two + 1])]
        found = [(fps[two], fps[two + 1])]
        for s, e in zip(starts[count > 2].tolist(), ends[count > 2].tolist(), strict=True):
            found += links_of(fps[s:e], home[s:e], int(anchor[s]) & 1)
        a, b = (np.concatenate(x) for x in zip(*found, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    rest: list[list[np.ndarray]] = []
    for batch in batches:
        now = [batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False).view(U), batch.column(2).to_numpy(zero_copy_only=False)]
        if not len(now[0]):
            continue
        if rest and rest[-1][0][-1] != now[0][-1] or not rest and now[0][0] != now[0][-1]:
            now = [np.concatenate(x) for x in zip(*rest, now, strict=True)]
            last = int(np.searchsorted(now[0], now[0][-1]))
            yield done(*(x[:last] for x in now))
            rest = [[x[last:] for x in now]]
        else:
            rest.append(now)
    if rest:
        yield done(*(np.concatenate(x) for x in zip(*rest, strict=True)))


def links(prints: DataFrame) -> DataFrame:
    """Of distinct fingerprints (fp long), links (a long, b long) between fingerprints at 1 to 3 differing bits, enough to connect all that are."""
    spread = prints.select("fp").mapInArrow(_replicate, "anchor long, fp long, home boolean")
    return spread.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(_compare, "a long, b long").distinct()


def _prints(docs: DataFrame, id: str, text: str, shingle: int, seed: int) -> DataFrame:
    return cut(fingerprints(docs.select(key_of(id).alias("_id"), F.col(text).alias("_t")), "_t", ("_id",), shingle, seed))


def _grouped(rows: DataFrame) -> DataFrame:
    prints = cut(rows.groupBy("fp").agg(F.min("_id").alias("low")))
    nodes = components(links(prints))
    named = cut(prints.join(nodes, prints.fp == nodes.node, "left").select("fp", "low", F.coalesce("component", "fp").alias("c")))
    lows = named.groupBy("c").agg(F.min("low").alias("component_id"))
    group = cut(named.join(lows, "c").select("fp", "component_id"))
    return rows.join(group, "fp")


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = 3, seed: int = 42) -> DataFrame:
    """Each row's id, fp long and component_id long: the smallest id that it reaches over links of at most 3 differing bits.

    Equal texts share a fingerprint and meet in one row before anything is compared. Null texts and texts without words have fingerprint 0
    and link like any other. A null id takes part, but never names a component unless all its ids are null; then component_id is null.
    Repeated rows come out repeated. Empty input gives no rows. Other columns are not looked at.
    """
    known = lambda c: F.when(F.col(c) != LAST, F.col(c))
    return _grouped(_prints(docs, id, text, shingle, seed)).select(known("_id").alias(id), "fp", known("component_id").alias("component_id"))


def one_of_each(docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = 3, seed: int = 42) -> DataFrame:
    """The rows of docs that stay, with all their columns: one of each component, that with the smallest id (a null id counts as the largest).

    Of rows that share that id, those with the smallest fingerprint are looked at, and of these one stays.
    """
    rows = _prints(docs, id, text, shingle, seed)
    staying = cut(_grouped(rows).where("_id = component_id").groupBy("_id").agg(F.min("fp").alias("_fp"), F.count("*").alias("_n")))
    if staying.where("_n > 1").isEmpty():
        return docs.join(staying.select(F.col("_id").alias("_stays")), key_of(id) == F.col("_stays"), "left_semi")
    columns = [f"d{k}" for k in range(len(docs.columns))]
    named = docs.select(*[F.col(c).alias(d) for c, d in zip(docs.columns, columns, strict=True)], key_of(id).alias("_key"), F.col(text).alias("_text"))
    printed = fingerprints(named, "_text", (*columns, "_key"), shingle, seed)
    kept = printed.join(staying, (printed._key == staying._id) & (printed.fp == staying._fp), "left_semi").dropDuplicates(["_key"])
    return kept.select(*[F.col(d).alias(c) for c, d in zip(docs.columns, columns, strict=True)])


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
