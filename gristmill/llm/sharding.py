"""Shards of nearly equal bytes by best-fit-decreasing bin packing of indivisible groups.

Groups of one size are interchangeable, so the packing needs no more than the number of groups of each size. Sizes are counted with 13 binary
digits, larger ones rounded up in the last (by 1 / 4096 at most), so there are at most 4096 of them for each doubling, however many bytes there
are; that table, not the groups, is what the driver packs. It takes the sizes from the largest down; each group enters the bin with the least
room that still holds it, found in a balanced tree of the bins' remaining room, and a run of equal groups enters at once. The result is a
short list of (size, from rank, to rank, bin), which Spark joins to the groups by size and rank.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .session import cut


class Rooms:
    """A balanced (AA) tree of bins by their remaining room: put, and take the bin with the least room of at least so much, in logarithmic time."""

    def __init__(self) -> None:
        self.root: list | None = None  # [level, (room, bin), left, right]

    def put(self, room: int, box: int) -> None:
        self.root = self._put(self.root, (room, box))

    def take(self, least: int) -> tuple[int, int] | None:
        node, found = self.root, None
        while node:
            if node[1][0] >= least:
                found, node = node[1], node[2]
            else:
                node = node[3]
        if found:
            self.root = self._drop(self.root, found)
        return found

    @staticmethod
    def _skew(t: list) -> list:
        left = t[2]
        if left and left[0] == t[0]:
            t[2], left[3] = left[3], t
            return left
        return t

    @staticmethod
    def _split(t: list) -> list:
        right = t[3]
        if right and right[3] and right[3][0] == t[0]:
            t[3], right[2] = right[2], t
            right[0] += 1
            return right
        return t

    def _put(self, t: list | None, key: tuple[int, int]) -> list:
        if t is None:
            return [1, key, None, None]
        side = 2 if key < t[1] else 3
        t[side] = self._put(t[side], key)
        return self._split(self._skew(t))

    def _drop(self, t: list | None, key: tuple[int, int]) -> list | None:
        if t is None:
            return None
        if key != t[1]:
            side = 2 if key < t[1] else 3
            t[side] = self._drop(t[side], key)
        elif t[2] is None and t[3] is None:
            return None
        else:  # the next key on one side takes its place
            side, back = (3, 2) if t[2] is None else (2, 3)
            near = t[side]
            while near[back]:
                near = near[back]
            t[1] = near[1]
            t[side] = self._drop(t[side], near[1])
        level = min(t[2][0] if t[2] else 0, t[3][0] if t[3] else 0) + 1
        if level < t[0]:
            t[0] = level
            if t[3] and t[3][0] > level:
                t[3][0] = level
        t = self._skew(t)
        if t[3]:
            t[3] = self._skew(t[3])
            if t[3][3]:
                t[3][3] = self._skew(t[3][3])
        t = self._split(t)
        if t[3]:
            t[3] = self._split(t[3])
        return t


def best_fit_decreasing(sizes: Iterable[tuple[int, int]], capacity: int, bins: int | None = None) -> list[tuple[int, int, int, int]] | None:
    """Packs (size, count) into bins of one capacity: runs (size, first rank, rank after the last, bin). None if more than bins would be needed."""
    rooms, runs, opened = Rooms(), [], 0
    for size, count in sorted(sizes, reverse=True):
        rank = 0
        while rank < count:
            found = rooms.take(size)
            if found is None:
                if size > capacity or opened == bins:
                    return None
                rooms.put(capacity, opened)
                opened += 1
                continue
            room, box = found
            fits = min(count - rank, room // size)
            runs.append((size, rank, rank + fits, box))
            rank += fits
            rooms.put(room - fits * size, box)
    return runs


def fixed_number(sizes: list[tuple[int, int]], bins: int) -> list[tuple[int, int, int, int]]:
    """The packing at the least capacity found at which so many bins suffice."""
    total, largest = sum(s * n for s, n in sizes), max((s for s, _ in sizes), default=0)
    low = max(-(-total // bins), largest)
    slack, runs = 0, None
    while runs is None:
        high, runs = low + slack, best_fit_decreasing(sizes, low + slack, bins)
        slack = 2 * slack + 1
    while low < high:
        middle = (low + high) // 2
        tried = best_fit_decreasing(sizes, middle, bins)
        low, high, runs = (low, middle, tried) if tried is not None else (middle + 1, high, runs)
    return runs


def _ranked(df: DataFrame, by: str, tie: tuple[str, ...], name: str, n: int, block: int = 20_000) -> DataFrame:
    """Numbers rows from 0 within by, in the order of a hash of tie and then of tie, whatever the number of rows.

    Ranges of the hash are blocks of about so many rows, each numbered by itself from where those before it end; so no value of by is one task's.
    """
    bits = max(1, (n // block).bit_length())
    dealt = df.withColumn("_x", F.xxhash64(*tie)).withColumn("_b", F.shiftrightunsigned("_x", 64 - bits))
    before = Window.partitionBy(by).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    starts = cut(dealt.groupBy(by, "_b").agg(F.count("*").alias("_n")).withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n"))
    within = F.row_number().over(Window.partitionBy(by, "_b").orderBy("_x", *tie)) - 1
    return dealt.withColumn(name, within).join(starts, [by, "_b"]).withColumn(name, F.col(name) + F.col("_start")).drop("_x", "_b", "_start")


def _class_of(size: Column) -> Column:
    """A size with 13 binary digits, rounded up; sizes below 8192 as they are."""
    low = F.greatest(F.lit(0), F.floor(F.log2(size)).cast("int") - 12)
    step = F.pow(F.lit(2.0), low).cast("long")
    return F.ceil(size / step).cast("long") * step


def _measured(docs: DataFrame, text: str, columns: list) -> DataFrame:
    raw = F.coalesce(F.col(text).cast("binary"), F.lit("").cast("binary"))
    return docs.select(*columns, (F.octet_length(raw) + 1).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"), F.xxhash64(raw).alias("_h"))


def assigned(docs: DataFrame, shards: int = 8, id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame, int]:
    """The rows as (id, size, text_crc32, _h), the bin of each group of equal texts as (size, text_crc32, _h, shard), and the number of rows."""
    rows = cut(_measured(docs, text, [F.col(id)]))
    groups = cut(rows.groupBy("size", "text_crc32", "_h").agg(F.count("*").alias("n")).withColumn("bytes", _class_of(F.col("size") * F.col("n"))))
    sizes = [(r[0], r[1]) for r in groups.groupBy("bytes").count().collect()]  # at most 4096 rows for each doubling of the size, see above
    spark = docs.sparkSession
    runs = spark.createDataFrame(fixed_number(sizes, shards), "bytes long, first long, after long, shard int")
    ranked = _ranked(groups, "bytes", ("_h", "text_crc32"), "rank", sum(n for _, n in sizes))
    bins = ranked.join(runs, "bytes").where("rank >= first and rank < after").select("size", "text_crc32", "_h", "shard")
    return rows, cut(bins), sum(n for _, n in sizes)


def shard(docs: DataFrame, shards: int = 8, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row its id, size, text_crc32, shard and slot (gapless from 0 in each shard); equal texts share a shard.

    A null text has no bytes and is in one group with the empty text; its size is 1 like theirs, its crc32 0. A group that is larger than an
    equal share has a shard of its own size. Repeated rows are rows of one group. Slots follow a hash of the id. An empty table gives no rows.
    """
    rows, bins, _ = assigned(docs, shards, id, text)
    placed = rows.join(bins, ["size", "text_crc32", "_h"])
    return _ranked(placed, "shard", (id, "_h"), "slot", rows.count()).select(id, "size", "text_crc32", "shard", F.col("slot").cast("long").alias("slot"))


def sharded(docs: DataFrame, shards: int = 8, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs with all their columns, and size, text_crc32, law, shard and slot.

    Columns of docs keep their names. An added column whose name docs has already (in either case) gets the first free one of shard_size,
    shard_size_2, shard_size_3 and so on (likewise the others).
    """
    columns, taken, added = docs.columns, {c.lower() for c in docs.columns}, {}
    for name in ("size", "text_crc32", "law", "shard", "slot"):
        new, k = name, 1
        while new in taken:
            new, k = f"shard_{name}" if k == 1 else f"shard_{name}_{k}", k + 1
        taken.add(new)
        added[name] = new
    flat = docs.toDF(*[f"c{k}" for k in range(len(columns))])
    id, text = (f"c{columns.index(c)}" for c in (id, text))
    rows, bins, _ = assigned(flat, shards, id, text)
    placed = _measured(flat, text, [F.col(c) for c in flat.columns]).join(bins, ["size", "text_crc32", "_h"])
    made = {"size": F.col("size"), "text_crc32": F.col("text_crc32"), "law": F.lit("bytes"), "shard": F.col("shard"), "slot": F.col("slot").cast("long")}
    return _ranked(placed, "shard", (id, "_h"), "slot", rows.count()).select(*[F.col(f).alias(c) for f, c in zip(flat.columns, columns, strict=True)], *[c.alias(added[n]) for n, c in made.items()])


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = shard(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
