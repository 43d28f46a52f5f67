"""Nearest neighbours by inner product: an inverted file of coarse centroids with product-quantised residuals, and bounds that lose none.

The index is fitted on a bounded sample (at most SAMPLE vectors, those with the smallest hash of their id) and holds every vector: its list,
one byte for each part of its residual, and how far the vector is from what these say. A query first visits the lists whose centroids have the
largest inner product with it. In a list it is compared with codes through a table of the inner products of its parts with all code words
(asymmetric: the query itself isn't quantised), and the best candidates are compared exactly, which gives a score that the k-th reaches. Then it
visits every list, and is compared exactly with every row, that may reach this score by the Cauchy-Schwarz inequality: an inner product differs
from that of the code by no more than the query's length times the row's distance from its code. So results are exact on any rows; how much the
bounds leave out depends on the rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .session import cut, small_batches
from .text import in_pieces

SAMPLE, MOST_LISTS, PARTS, WORDS = 16_384, 1024, 16, 256
BLOCK, QUERIES = 8192, 4096  # rows that are scanned together, and queries that meet them in a task, about


def usable(vector: str) -> Column:
    """Not null, not empty, only finite components, not all zero."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(v.isNotNull() & (F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def _kmeans(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Centroids; starts from spread rows, moves empty ones to the rows that are farthest off. The same for the same rows."""
    k = min(k, len(x))
    centroids = x[np.linspace(0, len(x) - 1, k).astype(np.int64)].copy()
    for _ in range(rounds):
        near = nearest(x, centroids)
        count = np.bincount(near, minlength=k)
        sums = np.stack([np.bincount(near, x[:, d], minlength=k) for d in range(x.shape[1])], axis=1)
        centroids = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], centroids).astype(np.float32)
        empty = np.flatnonzero(count == 0)
        if len(empty):
            off = ((x - centroids[near]) ** 2).sum(axis=1)
            centroids[empty] = x[np.argsort(-off, kind="stable")[: len(empty)]]
    return centroids


def nearest(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    half = 0.5 * (centroids**2).sum(axis=1)
    return np.concatenate([np.argmax(x[a : a + 4096] @ centroids.T - half, axis=1) for a in range(0, len(x), 4096)]) if len(x) else np.zeros(0, np.int64)


@dataclass
class Index:
    """What is fitted: at most MOST_LISTS centroids and PARTS * WORDS code words, whatever the number of vectors."""

    centroids: np.ndarray
    words: np.ndarray  # parts, words, width of a part
    pad: int

    def wide(self, x: np.ndarray) -> np.ndarray:
        return np.pad(x, ((0, 0), (0, self.pad))) if self.pad else x

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lists = nearest(x, self.centroids)
        parts = self.wide(x - self.centroids[lists]).reshape(len(x), len(self.words), -1)
        return lists, np.stack([nearest(np.ascontiguousarray(parts[:, j]), w) for j, w in enumerate(self.words)], axis=1).astype(np.uint8)

    def tables(self, q: np.ndarray) -> np.ndarray:
        """Queries, parts, words: the inner product of each part of a query with each code word."""
        parts = self.wide(q).reshape(len(q), len(self.words), -1)
        return np.einsum("qpd,pwd->qpw", parts, self.words, optimize=True)


def fit(sample: np.ndarray, n: int, parts: int = PARTS, words: int = WORDS) -> Index:
    """n: the number of vectors of the whole table, whose square root is the number of lists up to MOST_LISTS."""
    dim = sample.shape[1]
    centroids = _kmeans(sample, int(min(MOST_LISTS, max(1, n**0.5))))
    parts = min(parts, dim)
    pad = -dim % parts
    residuals = np.pad(sample - centroids[nearest(sample, centroids)], ((0, 0), (0, pad))).reshape(len(sample), parts, -1)
    books = []
    for j in range(parts):
        book = _kmeans(np.ascontiguousarray(residuals[:, j]), words)
        books.append(np.pad(book, ((0, words - len(book)), (0, 0)), mode="edge"))
    return Index(centroids, np.stack(books), pad)


def _matrix(column: pa.Array, dim: int, kind=np.float32) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(-1, dim)


def search(vectors: DataFrame, queries: DataFrame, k: int = 20, id: str = "vec_id", vector: str = "embedding", probe: float = 0.1, rerank: int = 10, seed: int = 42) -> DataFrame:
    """Of each row of queries (a part of vectors: same columns) the k nearest rows of vectors, but not itself: query_id, rank from 1, vec_id, score.

    score is the inner product of the original vectors in double precision; ties go to the smaller id. probe: the part of the lists that a
    query visits at first (at least 8 lists). rerank: how many times k candidates of each group are compared exactly at first. Both only
    decide how good the bound is that the second visit goes by. Equal vectors are one row of the index, with their k + 1 smallest ids (more
    can't be among the nearest), and are opened at the end, so copies don't crowd out others. Vectors that are null, zero, hold null or
    non-finite components, or have another length than the most frequent one (of equally frequent ones the longest) take no part; nor do
    null ids. Of rows that share an id but not the vector, each is a candidate; a query is never its own answer by id. Empty input gives no rows.

    Rows are scanned in groups of about BLOCK: small lists together, large ones in parts by a hash, so no list is one task's. The queries that
    visit a group meet it in blocks of about QUERIES, so what a task holds is bounded, and a group is sent as often as its own visitors fill
    blocks. What is sent to tasks is the fitted index, whose size has a bound (see Index), and which groups hold which lists.
    """
    spark = vectors.sparkSession
    out = "query_id long, rank int, vec_id long, score double"
    small_batches(spark)
    element = vectors.select(vector).schema[0].dataType.elementType.simpleString()
    kind = "array<float>" if element == "float" else "array<double>"  # the vectors themselves, never rounded
    good = vectors.select(F.col(id).cast("long").alias("id"), F.col(vector).cast(kind).alias("v")).where(F.col("id").isNotNull() & usable("v"))
    sizes = good.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if sizes is None:
        return spark.createDataFrame([], out)
    dim = sizes["d"]
    good = good.where(F.size("v") == dim)
    first = Window.partitionBy("v").orderBy("id")
    distinct = cut(good.distinct().withColumn("r", F.row_number().over(first)).where(F.col("r") <= k + 1).groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")).withColumns({"uid": F.col("ids")[0], "h": F.xxhash64("v")}))
    sample = distinct.orderBy(F.xxhash64("uid", F.lit(seed)), "uid", "h").limit(SAMPLE).select("v").toPandas()["v"]  # a bounded fit; every row is indexed
    n, unit = distinct.agg(F.count("*"), F.max(F.array_max(F.transform("v", F.abs))).cast("double")).first()  # the index is of vectors in this unit
    index = fit((np.stack(sample.to_numpy()).astype(np.float64) / unit).astype(np.float32), n)
    n_lists = len(index.centroids)
    visit = min(n_lists, max(8, int(np.ceil(probe * n_lists))))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_pieces(batches, 4096):
            x = _matrix(batch.column(0), dim, np.float64) / unit
            lists, codes = index.encode(x.astype(np.float32))
            off = x - index.centroids[lists]
            words = np.concatenate([w[codes[:, j]] for j, w in enumerate(index.words)], axis=1)[:, :dim].astype(np.float64)
            size = np.linalg.norm(index.centroids[lists], axis=1).astype(np.float64)
            # What single precision may add is far below a 100,000th of the lengths that are summed.
            far = np.linalg.norm(off - words, axis=1) * (1 + 1e-6) + 1e-5 * (size + np.linalg.norm(words, axis=1))
            out = [batch.column(0), batch.column(1), pa.array(lists.astype(np.int32)), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(far), pa.array(np.linalg.norm(off, axis=1) * (1 + 1e-6) + 1e-5 * size)]
            yield pa.RecordBatch.from_arrays(out, names=["v", "ids", "list", "code", "far", "off"])

    coded = cut(distinct.select("v", "ids").mapInArrow(encode, f"v {kind}, ids array<long>, list int, code binary, far double, off double"))
    lists = coded.groupBy("list").agg(F.count("*").alias("count"), F.max("off").alias("radius")).collect()  # at most MOST_LISTS rows
    radius = np.full(n_lists, -np.inf)  # an empty list is never visited
    radius[[r["list"] for r in lists]] = [r["radius"] for r in lists]
    parts, group, filled = [], 0, 0
    for name, count in sorted((r["list"], r["count"]) for r in lists):
        blocks = -(-count // BLOCK)
        for block in range(blocks):
            group, filled = (group + 1, 0) if filled and filled + count // blocks > BLOCK else (group, filled)
            filled += count // blocks
            parts.append((name, block, blocks, group))
    placing = spark.createDataFrame(parts, "list int, block int, blocks int, part int")
    blocks = placing.select("list", "blocks").distinct()
    placed = coded.join(F.broadcast(blocks), "list").withColumn("block", F.pmod(F.xxhash64("v"), F.col("blocks")).cast("int")).join(F.broadcast(placing.drop("blocks")), ["list", "block"]).select("part", "list", "ids", "v", "code", "far")
    at = np.array([(name, group) for name, _, _, group in parts])
    at = at[np.argsort(at[:, 1], kind="stable")]  # lists by their groups, group after group
    starts = np.flatnonzero(np.diff(at[:, 1], prepend=-1))

    def reachable(q: np.ndarray, least: np.ndarray | None) -> np.ndarray:
        """Which lists queries (in single precision) visit: the best ones, or those that may hold what reaches least."""
        near = q @ index.centroids.T
        if least is not None:
            return near + np.linalg.norm(q, axis=1)[:, None] * radius >= least[:, None]
        near[:, np.isneginf(radius)] = -np.inf
        seen = np.zeros(near.shape, bool)
        np.put_along_axis(seen, np.argsort(-near, axis=1, kind="stable")[:, :visit], True, axis=1)
        return seen

    def visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_pieces(batches, 1024):
            x = (_matrix(batch.column(1), dim, np.float64) / unit).astype(np.float32)
            least = batch.column(2).to_numpy(zero_copy_only=False) if batch.num_columns > 2 else None
            own, group = np.nonzero(np.logical_or.reduceat(reachable(x, least)[:, at[:, 0]], starts, axis=1))
            for a in range(0, len(own), 4096):
                some = pa.array(own[a : a + 4096])
                yield pa.RecordBatch.from_arrays([*[c.take(some) for c in batch.columns], pa.array(at[starts, 1][group[a : a + 4096]].astype(np.int32))], names=[*batch.schema.names, "part"])

    def scanned(asked: DataFrame, compare, schema: str) -> DataFrame:
        """What compare makes of each group of rows and the queries that visit it."""
        goes = cut(asked.mapInArrow(visits, ", ".join(f"{c} {t}" for c, t in asked.dtypes) + ", part int"))
        turns = cut(goes.groupBy("part").agg((F.floor(F.count("*") / QUERIES) + 1).cast("int").alias("turns")))  # a row for each group
        there = placed.join(turns, "part").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("turns") - 1))).drop("turns")
        sent = goes.join(turns, "part").withColumn("block", F.pmod(F.xxhash64("query_id", "q"), F.col("turns")).cast("int")).drop("turns")
        return there.groupBy("part", "block").cogroup(sent.groupBy("part", "block")).applyInArrow(compare, schema)

    class Rows:
        """A group of rows, and what its codes tell of queries."""

        def __init__(self, table: pa.Table) -> None:
            self.lists, self.far = table.column("list").to_numpy(), table.column("far").to_numpy()
            self.v = _matrix(table.column("v").combine_chunks(), dim, np.float64)
            self.x = self.v / unit
            self.length = np.linalg.norm(self.x, axis=1)
            self.codes = np.frombuffer(b"".join(table.column("code").to_pylist()), np.uint8).reshape(len(self.x), -1).T.astype(np.int64)
            ids = table.column("ids").combine_chunks()
            starts, flat = ids.offsets.to_numpy()[:-1], ids.values.to_numpy()
            self.first, self.lone = flat[starts], np.diff(ids.offsets.to_numpy()) == 1
            self.second = flat[np.where(self.lone, starts, starts + 1)]

        def about(self, q: np.ndarray, seen: np.ndarray) -> np.ndarray:
            """Inner products of queries with codes; minus infinity in lists that they don't visit."""
            table = index.tables(q)
            score = np.where(seen, q @ index.centroids.T, -np.inf).astype(np.float32).take(self.lists, axis=1)
            for j in range(len(self.codes)):
                score += table[:, j].take(self.codes[j], axis=1)
            return score

        def own(self, ids: np.ndarray) -> np.ndarray:
            """Queries, rows: rows that are the query's own alone."""
            return (self.first == ids[:, None]) & self.lone

    def tell(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        tops = []
        if left.num_rows and right.num_rows:
            rows, ids = Rows(left), right.column("query_id").to_numpy()
            take = min(rerank * k, left.num_rows)
            for a in range(0, right.num_rows, 64):
                q = _matrix(right.column("q").slice(a, 64).combine_chunks(), dim, np.float64) / unit
                narrow = q.astype(np.float32)
                score = np.where(rows.own(ids[a : a + 64]), -np.inf, rows.about(narrow, reachable(narrow, None)))
                best = np.argpartition(-score, take - 1, axis=1)[:, :take]
                for i, found in enumerate(best):
                    found = found[np.isfinite(score[i, found])]
                    tops.append(-np.sort(-(rows.x[found] @ q[i]))[:k])
        return pa.table({"query_id": right.column("query_id").slice(0, len(tops)), "q": right.column("q").slice(0, len(tops)), "top": pa.array(tops, pa.list_(pa.float64()))})

    def scan(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        got_q, got_r, got_s = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
        if left.num_rows and right.num_rows:
            rows, ids, bound = Rows(left), right.column("query_id").to_numpy(), right.column("least").to_numpy()
            for a in range(0, right.num_rows, 64):
                whole, least, own = _matrix(right.column("q").slice(a, 64).combine_chunks(), dim, np.float64), bound[a : a + 64, None], ids[a : a + 64]
                q = whole / unit
                narrow, length = q.astype(np.float32), np.linalg.norm(q, axis=1)[:, None]
                may = (rows.about(narrow, reachable(narrow, bound[a : a + 64])) + length * rows.far >= least) & ~rows.own(own)
                some = np.flatnonzero(may.any(axis=0))
                at_q, at_r = np.nonzero(may[:, some] & (q @ rows.x[some].T >= least - 1e-12 * length * rows.length[some]))
                at_r = some[at_r]
                score = np.concatenate([np.zeros(0), *[np.einsum("ij,ij->i", rows.v[at_r[b : b + 65536]], whole[at_q[b : b + 65536]]) for b in range(0, len(at_r), 65536)]])
                name = np.where(rows.first[at_r] == own[at_q], rows.second[at_r], rows.first[at_r])
                order = np.lexsort((name, -score, at_q))
                place = np.arange(len(order)) - np.searchsorted(at_q[order], at_q[order])
                order = order[place < k]
                for all_, part in ((got_q, own[at_q[order]]), (got_r, at_r[order]), (got_s, score[order])):
                    all_.append(part)
        return pa.table({"query_id": np.concatenate(got_q), "ids": left.column("ids").combine_chunks().take(pa.array(np.concatenate(got_r))), "score": np.concatenate(got_s)})

    asked = cut(queries.select(F.col(id).cast("long").alias("query_id"), F.col(vector).cast(kind).alias("q")).where(F.col("query_id").isNotNull() & usable("q")).where(F.size("q") == dim).distinct())
    told = scanned(asked, tell, f"query_id long, q {kind}, top array<double>")
    reached = F.try_element_at(F.sort_array(F.flatten(F.collect_list("top")), False), F.lit(k))
    # Where fewer than k are known, all may be among them.
    least = told.groupBy("query_id", "q").agg(F.coalesce(reached - F.abs(reached) * 1e-12, F.lit(float("-inf"))).alias("least"))
    met = scanned(cut(least), scan, "query_id long, ids array<long>, score double")
    scored = met.select("query_id", F.explode("ids").alias("vec_id"), "score").where("vec_id != query_id")
    scored = scored.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    ranked = scored.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return search(vectors, vectors.where(F.col("vec_id") % 20 == 0))
