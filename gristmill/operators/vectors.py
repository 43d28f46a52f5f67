"""Joins of vectors by cosine that leave out what cannot be near: balls around centres, cut into shells, under the triangle inequality.

Vectors are taken as points on the unit sphere, where the distance of two points with cosine s is sqrt(2 - 2 s). A bounded sample is halved
again and again, and the middles of the parts are centres. Each known row is at home with its nearest centre, in the shell of its distance from
it, so all rows of a shell are at least as far from a query as its own distance from the centre and the shell's least and largest distance
allow. A query is compared with the shells that may hold what it looks for, and with no others; results are exact. How much that saves depends
on the vectors: those without clusters are all about as far from each other, and little is left out. Shells are small, so they are dealt in
groups of many rows; a query is sent once to each group that holds one of its shells, and a group once to each block of its queries.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..session import cut, ship

SLACK = 1e-9
#: A row that shares its length with no row of the sample has no centre: it is at home in one cell of its length, which no bound excludes.
FREE = -1


def chord(cosine: float | np.ndarray) -> float | np.ndarray:
    """The distance of two points of the unit sphere with this cosine."""
    return np.sqrt(np.maximum(0, 2 - 2 * np.asarray(cosine, np.float64)))


def halved(points: np.ndarray, leaves: int) -> np.ndarray:
    """Middles of parts of points: the part with the most points is cut in two between two points far from each other, until there are so many."""
    parts = [np.arange(len(points))]
    done: list[np.ndarray] = []
    while parts and len(parts) + len(done) < leaves:
        parts.sort(key=len)
        own = parts.pop()
        x = points[own]
        a = x[((x - x.mean(axis=0)) ** 2).sum(axis=1).argmax()]
        b = x[((x - a) ** 2).sum(axis=1).argmax()]
        near = ((x - a) ** 2).sum(axis=1) <= ((x - b) ** 2).sum(axis=1)
        if len(own) < 2 or near.all():
            done.append(own)
        else:
            parts += [own[near], own[~near]]
    middles = [points[p].mean(axis=0) for p in (*done, *parts) if len(p)]
    return np.stack(middles) if middles else np.zeros((0, points.shape[1]))


def by_length(column: pa.Array | pa.ChunkedArray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Of a column of vectors, for each length: the length, the rows that have it, and their directions."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    offsets = column.offsets.to_numpy()
    flat, sizes = column.values.to_numpy(zero_copy_only=False).astype(np.float64, copy=False), np.diff(offsets)
    for n in np.unique(sizes[sizes > 0]).tolist():
        at = np.flatnonzero(sizes == n)
        x = flat[offsets[at][:, None] + np.arange(n)]
        yield n, at, x / np.linalg.norm(x, axis=1, keepdims=True)


def sound(df: DataFrame, id: str, vector: str) -> DataFrame:
    """id and v of the rows that have a direction: not null, not all 0, nothing null, infinite or NaN in it. Floats stay floats, which is half the bytes."""
    v = F.col(vector) if df.select(vector).dtypes[0][1] == "array<float>" else F.col(vector).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return df.select(F.col(id).cast("long").alias("id"), v.alias("v")).where(F.col("id").isNotNull() & F.exists("v", lambda x: x != 0) & finite)


class Balls:
    """An index of known rows (id, v): cells (length, ball, shell), of which groups of about so many rows are made; large cells are dealt over several groups.

    Without rows, groups hold a sixteenth of all rows, but 4,096 at least and 65,536 at most.
    """

    def __init__(self, known: DataFrame, leaves: int = 256, sample: int = 4096, shells: int = 8, rows: int | None = None) -> None:
        ship(known.sparkSession)
        picked = [np.asarray(r[0], np.float64) for r in known.orderBy(F.xxhash64("id"), "id").limit(sample).select("v").collect()]  # a bounded sample
        self.centres: dict[int, np.ndarray] = {}
        for n in {len(p) for p in picked}:
            x = np.stack([p for p in picked if len(p) == n])
            x = np.unique(x / np.linalg.norm(x, axis=1, keepdims=True), axis=0)
            self.centres[n] = halved(x, min(leaves, len(x) // 8 + 1))
        centres, kind = self.centres, dict(known.dtypes)["v"]

        def home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ball, far, length = np.full(batch.num_rows, FREE), np.zeros(batch.num_rows), np.zeros(batch.num_rows, np.int64)
                for n, at, x in by_length(batch.column(1)):
                    length[at] = n
                    if n in centres:
                        apart = distances(x, centres[n])
                        ball[at] = apart.argmin(axis=1)
                        far[at] = apart.min(axis=1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(length, pa.int32()), pa.array(ball, pa.int32()), pa.array(far)], names=["id", "v", "length", "ball", "far"])

        homes = cut(known.select("id", "v").mapInArrow(home, f"id long, v {kind}, length int, ball int, far double"))
        steps = F.percentile_approx("far", F.array(*[F.lit(k / shells) for k in range(1, shells)]), F.lit(1000))
        edges = homes.groupBy("length", "ball").agg(steps.alias("edges"))  # a row for each ball
        shelled = homes.join(F.broadcast(edges), ["length", "ball"]).withColumn("shell", F.size(F.filter("edges", lambda e: e < F.col("far"))))
        cells = shelled.groupBy("length", "ball", "shell").agg(F.count("*").alias("n"), F.min("far").alias("low"), F.max("far").alias("high"))
        found = sorted(tuple(r) for r in cells.collect())  # at most shells rows for each ball, and one for each length without centres
        rows = rows or min(65_536, max(4096, sum(c[3] for c in found) // 16))
        self.cells: dict[int, np.ndarray] = {}  # of each length: ball, rows of one part, low, high
        self.held: dict[int, np.ndarray] = {}  # of each length: cell and group, group after group
        table, group, filled = [], 0, 0
        for n in sorted({c[0] for c in found}):
            group, filled, own = group + (filled > 0), 0, [c for c in found if c[0] == n]
            held = []
            for cell, (_, ball, shell, count, _, _) in enumerate(own):
                parts = count // rows + 1
                for part in range(parts):
                    group, filled = (group + 1, 0) if filled and filled + count / parts > rows else (group, filled)
                    filled += count / parts
                    held.append((cell, group))
                    table.append((n, ball, shell, parts, part, cell, group))
            self.cells[n] = np.array([(c[1], c[3] / (c[3] // rows + 1), c[4], c[5], c[3]) for c in own], np.float64)
            self.held[n] = np.array(held)
        dealt = known.sparkSession.createDataFrame(table, "length int, ball int, shell int, parts int, part int, cell int, group int")
        counted = shelled.join(F.broadcast(dealt.select("length", "ball", "shell", "parts").distinct()), ["length", "ball", "shell"])
        placed = counted.withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")).drop("parts").join(F.broadcast(dealt.drop("parts")), ["length", "ball", "shell", "part"])
        self.rows = cut(placed.select("group", "cell", "id", "v"))

    def needs(self, n: int, x: np.ndarray, reach: np.ndarray) -> np.ndarray:
        """Queries, cells of this length: whether a cell may hold what is within reach. A reach of -k stands for the most promising cells until these hold k rows."""
        ball, _, low, high, count = self.cells[n].T
        known, least = ball >= 0, np.zeros((len(x), len(ball)))
        if n in self.centres:
            apart = distances(x, self.centres[n])[:, ball[known].astype(int)]
            least[:, known] = np.maximum(0, np.maximum(apart - high[known], low[known] - apart))
        needed = least <= reach[:, None] + SLACK
        some = np.flatnonzero(reach < 0)
        if len(some):
            order = np.argsort(least[some], axis=1, kind="stable")
            before = np.cumsum(count[order], axis=1) - count[order]
            chosen = np.zeros((len(some), len(ball)), bool)
            np.put_along_axis(chosen, order, before < -reach[some][:, None], axis=1)
            needed[some] = chosen
        return needed

    def visits(self, queries: DataFrame, reach: float | None, first: int | None = None) -> DataFrame:
        """group, id, v, reach: the groups that queries (id, v and, if reach is None, reach of their own) are sent to.

        With first, a query is sent to its most promising cells instead, until these hold so many rows.
        """
        kind, balls = dict(queries.dtypes)["v"], self.plan()
        own = F.col("reach") if reach is None and not first else F.lit(float(-first if first else reach))

        def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                bound = batch.column(2).to_numpy(zero_copy_only=False)
                for n, at, x in by_length(batch.column(1)):
                    if n not in balls.cells:
                        continue
                    cell, group = balls.held[n].T
                    starts = np.flatnonzero(np.diff(group, prepend=-1))
                    for a in range(0, len(at), 256):
                        some = at[a : a + 256]
                        row, place = np.nonzero(np.logical_or.reduceat(balls.needs(n, x[a : a + 256], bound[some])[:, cell], starts, axis=1))
                        for b in range(0, len(row), 4096):
                            taken = pa.array(some[row[b : b + 4096]])
                            yield pa.RecordBatch.from_arrays([pa.array(group[starts][place[b : b + 4096]].astype(np.int32)), *[c.take(taken) for c in batch.columns]], names=["group", "id", "v", "reach"])

        return queries.select("id", "v", own.alias("reach")).mapInArrow(send, f"group int, id long, v {kind}, reach double")

    def plan(self) -> Balls:
        """What tasks need: centres, cells and groups, without the rows."""
        bare = object.__new__(Balls)
        bare.centres, bare.cells, bare.held = self.centres, self.cells, self.held
        return bare

    def met(self, visits: DataFrame, compare, schema: str, many: int = 65_536) -> DataFrame:
        """What compare makes of the queries sent to a group, at most about so many at once, and the group's rows."""
        sent = cut(visits)
        turns = cut(sent.groupBy("group").agg((F.floor(F.count("*") / many) + 1).cast("int").alias("turns")))
        asked = sent.join(F.broadcast(turns), "group").withColumn("turn", F.pmod(F.xxhash64("id"), F.col("turns")).cast("int")).drop("turns")
        there = self.rows.join(F.broadcast(turns), "group").withColumn("turn", F.explode(F.sequence(F.lit(0), F.col("turns") - 1))).drop("turns")
        both = asked.groupBy("group", "turn").cogroup(there.groupBy("group", "turn"))
        return both.applyInArrow(compare, schema)

    def blocks(self, left: pa.Table, right: pa.Table, many: int = 128) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Of the queries and rows of one group, block by block: ids and directions of queries, and ids and directions, by id, of the rows in cells that one of them needs."""
        if not left.num_rows or not right.num_rows:
            return
        (own, x), (ids, y) = _directions(left), _directions(right)
        n, cell = next(k for k, _, _ in by_length(left["v"])), right["cell"].to_numpy()[np.argsort(right["id"].to_numpy(), kind="stable")]
        reach = left["reach"].to_numpy()[np.argsort(left["id"].to_numpy(), kind="stable")]
        if n in self.centres:  # queries of one ball need about the same cells
            ball = np.concatenate([distances(x[a : a + 4096], self.centres[n]).argmin(axis=1) for a in range(0, len(x), 4096)])
            order = np.argsort(ball, kind="stable")
            if self.needs(n, x[:: len(x) // 256 + 1], reach[:: len(x) // 256 + 1]).mean() < 0.5:
                own, x, reach = own[order], x[order], reach[order]
        for a in range(0, len(own), many):
            s = slice(a, a + many)
            there = self.needs(n, x[s], reach[s]).any(axis=0)[cell]
            yield (own[s], x[s], ids, y) if there.all() else (own[s], x[s], ids[there], y[there])

    def pairs(self, visits: DataFrame) -> int:
        """How many pairs of rows these visits compare."""
        balls = self.plan()

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                total, group, bound = 0.0, batch.column(0).to_numpy(), batch.column(3).to_numpy()
                for n, at, x in by_length(batch.column(2)):
                    cell, held = balls.held[n].T
                    total += ((balls.needs(n, x, bound[at])[:, cell] & (held == group[at][:, None])) * balls.cells[n][cell, 1]).sum()
                yield pa.RecordBatch.from_arrays([pa.array([total])], names=["n"])

        return round(visits.mapInArrow(count, "n double").agg(F.coalesce(F.sum("n"), F.lit(0.0))).first()[0])


def distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Of points of the unit sphere to centres within it."""
    return np.sqrt(np.maximum(0, 1 + (centres**2).sum(axis=1) - 2 * x @ centres.T))


def _directions(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Ids and directions of rows of one length, by id."""
    (_, _, x), ids = next(by_length(table["v"])), table["id"].to_numpy()
    order = np.argsort(ids, kind="stable")
    return ids[order], x[order]


def nearest_rows(queries: DataFrame, known: DataFrame, id: str, vector: str, k: int, places: int = 9, **index) -> DataFrame:
    """Of each query row the k most similar known rows: id, nearest_id, similarity (cosine, rounded), rank from 1; ties to the smaller id.

    A query is compared with its most promising shells first, which bounds how far its k-th can be, and then with every shell within that.
    Of known rows with one vector only the k with the smallest ids can be among the results, so copies are left out beforehand. Rows without
    a direction, and known rows of another length, take no part.
    """
    asked = cut(sound(queries, id, vector))
    few = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    balls = Balls(sound(known, id, vector).withColumn("_r", few).where(F.col("_r") <= k).drop("_r"), **index)

    plan = balls.plan()

    def best(left: pa.Table, right: pa.Table) -> pa.Table:
        found = {n: [np.zeros(0, t)] for n, t in (("id", np.int64), ("nearest_id", np.int64), ("similarity", np.float64))}
        for own, x, ids, y in plan.blocks(left, right):
            if not len(ids):
                continue
            similar = x @ y.T
            # What may be among the k best once it is rounded; only that is rounded and put in order.
            least = np.partition(similar, len(ids) - k, axis=1)[:, len(ids) - k] if len(ids) > k else np.full(len(own), -2.0)
            row, at = np.nonzero(similar >= least[:, None] - 2 * 10.0**-places)
            value = np.round(similar[row, at], places)
            order = np.lexsort((at, -value, row))
            order = order[np.arange(len(order)) - np.searchsorted(row, row[order]) < k]
            for n, v in (("id", own[row[order]]), ("nearest_id", ids[at[order]]), ("similarity", value[order])):
                found[n].append(v)
        return pa.table({n: np.concatenate(v) for n, v in found.items()})

    schema = "id long, nearest_id long, similarity double"
    first = balls.met(balls.visits(asked, None, k), best, schema)
    ranked = lambda df: df.withColumn("rank", F.row_number().over(Window.partitionBy("id").orderBy(F.desc("similarity"), "nearest_id")).cast("long")).where(F.col("rank") <= k)
    worst = ranked(first).groupBy("id").agg(F.count("*").alias("n"), F.min("similarity").alias("s"))
    reach = F.when(F.col("n") == k, F.sqrt(F.greatest(F.lit(0.0), 2 - 2 * (F.col("s") - 2 * 10.0**-places)))).otherwise(F.lit(3.0))
    again = asked.join(worst.select("id", reach.alias("reach")), "id", "left").fillna(3.0, ["reach"])
    return ranked(balls.met(balls.visits(again, None), best, schema)).withColumnRenamed("id", id)


def resembling_earlier(df: DataFrame, id: str, vector: str, least: float, **index) -> DataFrame:
    """The ids of rows that an earlier row (a smaller id) resembles: their cosine is greater than least. A row counts even if it is itself one of these.

    Of rows with one vector only the first is compared with others; the rest resemble it. Rows without a direction take no part.
    """
    rows = cut(sound(df, id, vector))
    firsts = cut(rows.groupBy("v").agg(F.min("id").alias("id")))
    balls = Balls(firsts.select("id", "v"), **index)

    plan = balls.plan()

    def earlier(left: pa.Table, right: pa.Table) -> pa.Table:
        found = [np.zeros(0, np.int64)]
        for own, x, ids, y in plan.blocks(left, right):
            before = np.searchsorted(ids, own.max())
            like = (x @ y[:before].T > least) & (ids[None, :before] < own[:, None])
            found.append(own[like.any(axis=1)])
        return pa.table({"id": np.unique(np.concatenate(found))})

    met = balls.met(balls.visits(firsts, float(chord(least))), earlier, "id long")
    copies = rows.join(firsts.withColumnsRenamed({"v": "_v", "id": "_first"}), F.col("v") == F.col("_v")).where(F.col("id") > F.col("_first")).select("id") if least < 1 else rows.select("id").limit(0)
    return met.unionByName(copies).distinct().select(F.col("id").alias(id))
