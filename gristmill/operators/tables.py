"""Relational operators: rule chains, lookups, distributions, resolutions and rankings over any DataFrame."""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import cut, ship


def first_rule(rules: Sequence[tuple[Column, str]], otherwise: str | None = None) -> Column:
    """The label of the first rule that holds."""
    out = F.lit(otherwise).cast("string")
    for condition, label in reversed(rules):
        out = F.when(condition, F.lit(label)).otherwise(out)
    return out


def small(df: DataFrame, most: int = 10_000) -> DataFrame:
    """df, to be broadcast if it has at most so many rows (counted first); larger tables are left to the optimizer."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def tasks_for(df: DataFrame, rows: int = 1_000_000) -> int:
    """A number of tasks for repartition(): the session's, or more where one would get over so many of df's rows (counted first). It isn't lowered when the plan runs, as numbers of the session are by bytes."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), df.count() // rows + 1)


def running(df: DataFrame, by: Sequence[str], order: Sequence[str], value: str, name: str) -> DataFrame:
    """df with the sum of a long column over all rows of its group up to and with this one, in an order that no two rows of a group share.

    Rows are range-partitioned by group and order, summed within each range, and each range starts where those before it end; so a group
    that holds most of the rows is many tasks' work. What meets in one task is one sum for each range of a group. Rows that lagged() has left in
    ranges of this order stay there.
    """
    ranged = df if "_range" in df.columns else cut(df.repartitionByRange(*by, *order).withColumn("_range", F.spark_partition_id()))
    before = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy(*by, "_range").agg(F.sum(value).alias("_sum")).withColumn("_start", F.coalesce(F.sum("_sum").over(before), F.lit(0))).drop("_sum")
    within = F.sum(value).over(Window.partitionBy(*by, "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    starts = starts.withColumnsRenamed({c: f"_{c}_" for c in by})
    same = [F.col(c).eqNullSafe(F.col(f"_{c}_")) for c in by]
    met = ranged.withColumn("_within", within).join(small(starts.withColumnRenamed("_range", "_r")), reduce(lambda x, y: x & y, same, F.col("_range") == F.col("_r")))
    return met.withColumn(name, F.col("_within") + F.col("_start")).drop("_range", "_r", "_within", "_start", *[f"_{c}_" for c in by])


def numbered(df: DataFrame, by: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """df with its rows numbered from 1 within each group, in an order that no two rows of a group share; a group may hold most of the rows."""
    return running(df.withColumn("_one", F.lit(1).cast("long")), by, order, "_one", name).drop("_one")


def lagged(df: DataFrame, by: Sequence[str], order: Sequence[str], value: str, name: str, keep_ranges: bool = False) -> DataFrame:
    """df with the value of the row before in its group, in an order that no two rows of a group share; a group may hold most of the rows (see running()).

    keep_ranges: the rows stay marked with their ranges, for running() in the same order.
    """
    ranged = cut(df.repartitionByRange(*by, *order).withColumn("_range", F.spark_partition_id()))
    last = ranged.groupBy(*by, "_range").agg(F.max_by(F.struct(value), F.struct(*order)).alias("_last"))
    before = last.withColumn("_before", F.lag("_last").over(Window.partitionBy(*by).orderBy("_range"))).drop("_last")  # a row for each range of a group
    before = before.withColumnsRenamed({c: f"_{c}_" for c in by} | {"_range": "_r"})
    same = [F.col(c).eqNullSafe(F.col(f"_{c}_")) for c in by]
    inner = Window.partitionBy(*by, "_range").orderBy(*order)
    met = ranged.withColumns({"_first": F.row_number().over(inner) == 1, "_lag": F.lag(value).over(inner)}).join(small(before), reduce(lambda x, y: x & y, same, F.col("_range") == F.col("_r")))
    return met.withColumn(name, F.when(F.col("_first"), F.col(f"_before.{value}")).otherwise(F.col("_lag"))).drop(*["_range"] * (not keep_ranges), "_r", "_first", "_lag", "_before", *[f"_{c}_" for c in by])


def any_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def distribution(df: DataFrame, by: Sequence[str], value: str, books: str | None = None, places: int = 6) -> DataFrame:
    """n, min, nearest-rank p5, p25, median, p75, p95, max, mean and sample deviation (0 for one value) of each group; with books, n_books (its different values).

    Nearest rank: the value at place floor(q * n / 100) of the sorted values, at most the last. The values are counted before they are
    shuffled, and ranks are running sums of counts over the distinct values of a group, see running().
    """
    known = df.where(F.col(value).isNotNull())
    spread = F.coalesce(F.stddev_samp(value), F.lit(0.0))
    stats = known.groupBy(*by).agg(F.count("*").alias("n"), F.min(value).alias("min"), F.max(value).alias("max"), F.round(F.avg(value), places).alias("mean"), F.round(spread, places).alias("stdev"))
    counted = known.groupBy(*by, value).agg(F.count("*").alias("_c"))
    whole = stats.select(*[F.col(c).alias(f"_{c}") for c in by], F.col("n").alias("_n"))
    same = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by])
    ranked = running(counted, by, [value], "_c", "_to").join(whole, same)
    at = lambda q: F.min(F.when(F.col("_to") > F.least(F.floor(F.lit(q) * F.col("_n") / 100), F.col("_n") - 1), F.col(value)))
    ranks = ranked.groupBy(*[f"_{c}" for c in by]).agg(at(5).alias("p5"), at(25).alias("p25"), at(50).alias("median"), at(75).alias("p75"), at(95).alias("p95"))
    out = stats.join(ranks, same).drop(*[f"_{c}" for c in by])
    if books is None:
        return out
    several = known.select(*[F.col(c).alias(f"_{c}") for c in by], books).distinct().groupBy(*[f"_{c}" for c in by]).agg(F.count(books).alias("n_books"))
    return out.join(several, same).drop(*[f"_{c}" for c in by])


def within_bounds(df: DataFrame, bounds: DataFrame, on: Sequence[str], value: str) -> DataFrame:
    """Rows without a rule, without a value, or with a value inside their rule's (low, high). A small table of bounds is sent to the rows."""
    return df.join(small(bounds), list(on), "left").where(F.col("low").isNull() | F.col(value).isNull() | F.col(value).between(F.col("low"), F.col("high"))).drop("low", "high")


def cascade(df: DataFrame, levels: Sequence[tuple[Column, DataFrame, float]], method: Sequence[str]) -> DataFrame:
    """Looks a row up in one index after the other (key, id); the first level that hits gives id, confidence and method.

    Of index entries with one key the smallest id counts. Each level is one equality join.
    """
    out = df
    for k, (key, index, _) in enumerate(levels):
        one = index.where("key is not null").groupBy("key").agg(F.min("id").alias(f"_id{k}")).withColumnRenamed("key", f"_key{k}")
        out = out.withColumn(f"_probe{k}", key).join(one, F.col(f"_probe{k}") == F.col(f"_key{k}"), "left").drop(f"_key{k}", f"_probe{k}")
    hit = lambda value: F.coalesce(*[F.when(F.col(f"_id{k}").isNotNull(), F.lit(value(k))) for k in range(len(levels))])
    return out.withColumns({"id": F.coalesce(*[F.col(f"_id{k}") for k in range(len(levels))]), "confidence": hit(lambda k: levels[k][2]), "method": hit(lambda k: method[k])}).drop(*[f"_id{k}" for k in range(len(levels))])


def conflicts(df: DataFrame, id: str, keys: Sequence[str]) -> DataFrame:
    """Keys (name, value) that more than one id has, with the number of ids and the smallest one."""
    pairs = df.select(id, F.explode(F.array(*[F.struct(F.lit(k).alias("name"), F.col(k).cast("string").alias("value")) for k in keys])).alias("k")).where("k.value is not null and k.value <> ''")
    return pairs.groupBy("k.name", "k.value").agg(F.countDistinct(id).alias("n_ids"), F.min(id).alias("least_id")).where("n_ids > 1")


def in_interval(points: DataFrame, point: str, intervals: DataFrame) -> DataFrame:
    """Each point with the last (by ord, then by name) of the intervals (start, end, name, ord) that hold it, their ends included, or none.

    Starts, points and ends are sorted together into ranges, and each range is swept by itself. An interval is carried into the range where it
    ends; of those that span a range whole only the last counts, found over the dyadic blocks of ranges that intervals cover. So intervals and
    points are moved a fixed number of times, however many intervals hold a point. Numbers may have fractions. Equal points may lie in several
    ranges. Intervals with a null bound, or that end before they start, hold nothing; a null point has none.
    """
    ship(points.sparkSession)
    spans = intervals.select("start", "end", "name", "ord").where("start <= end")
    spans = cut(spans.withColumn("_no", F.monotonically_increasing_id()))
    columns = [f"_c{k}" for k in range(len(points.columns))]
    flat = points.toDF(*columns).withColumns({"_kind": F.lit(1), "_at": F.col(columns[points.columns.index(point)]), "_salt": F.monotonically_increasing_id()})
    mark = lambda at, kind: spans.select(F.col(at).alias("_at"), F.lit(kind).alias("_kind"), "_no", F.col("_no").alias("_salt"))
    both = flat.unionByName(mark("start", 0), allowMissingColumns=True).unionByName(mark("end", 2), allowMissingColumns=True)
    ranged = cut(both.repartitionByRange("_at", "_kind", "_salt").withColumn("_range", F.spark_partition_id()))
    found = ranged.where("_no is not null").groupBy("_no").agg(F.min(F.when(F.col("_kind") == 0, F.col("_range"))).alias("_from"), F.min(F.when(F.col("_kind") == 2, F.col("_range"))).alias("_to"))
    placed = cut(spans.join(found, "_no"))
    last = ranged.agg(F.max("_range")).first()[0] or 0
    depth = range(last.bit_length() + 1)
    blocks = placed.where("_to - _from > 1").select("ord", "name", F.explode(_blocks(F.col("_from") + 1, F.col("_to"), depth)).alias("_b")).groupBy("_b.level", "_b.block").agg(F.max(F.struct("ord", "name")).alias("_top"))
    every = points.sparkSession.range(last + 1).select(F.col("id").cast("int").alias("_range"), F.explode(F.array(*[F.struct(F.lit(k).alias("level"), F.shiftright(F.col("id"), k).cast("int").alias("block")) for k in depth])).alias("_b"))
    over = every.select("_range", "_b.*").join(blocks, ["level", "block"]).groupBy("_range").agg(F.max("_top").alias("_top"))  # a row for each range at most
    begins = placed.select(F.col("_from").alias("_range"), F.col("start").alias("_at"), F.lit(0).alias("_kind"), F.col("end").alias("_end"), "ord", "name")
    carried = placed.where("_to > _from").select(F.col("_to").alias("_range"), F.lit(None).cast(spans.schema["start"].dataType).alias("_at"), F.lit(-1).alias("_kind"), F.col("end").alias("_end"), "ord", "name")
    above = over.select("_range", F.lit(-2).alias("_kind"), F.col("_top.ord").alias("ord"), F.col("_top.name").alias("name"))
    rows = ranged.where("_kind = 1").select("_range", "_at", "_kind", *columns)
    for part in (begins, carried, above):
        rows = rows.unionByName(part, allowMissingColumns=True)
    kinds = [f"{c} {f.dataType.simpleString()}" for c, f in zip(columns, points.schema.fields, strict=True)]

    def sweep(table: pa.Table) -> pa.Table:
        table = table.sort_by([("_at", "ascending"), ("_kind", "ascending")])
        at, kind, end, order, name = (table[c].to_pylist() for c in ("_at", "_kind", "_end", "ord", "name"))
        top, heap, points, names = None, [], [], []
        for k in np.argsort([x >= 0 for x in kind], kind="stable").tolist():  # what begins before the range comes first
            if kind[k] == -2:
                top = (order[k], name[k])
            elif kind[k] != 1:
                heapq.heappush(heap, _Last(order[k], name[k], end[k]))
            else:
                points.append(k)
                if at[k] is None:
                    names.append(None)
                    continue
                while heap and heap[0].end < at[k]:
                    heapq.heappop(heap)
                best = max([x for x in (top, (heap[0].ord, heap[0].name) if heap else None) if x], key=lambda x: (x[0], x[1] or ""), default=(0, None))
                names.append(best[1])
        return table.select(columns).take(pa.array(points, pa.int64())).append_column("name", pa.array(names, pa.string()))

    swept = rows.groupBy("_range").applyInArrow(sweep, ", ".join([*kinds, "name string"]))
    return swept.toDF(*points.columns, "name")


class _Last:
    """An open interval; that with the greatest ord comes first out of a heap."""

    __slots__ = ("end", "name", "ord")

    def __init__(self, ord: object, name: str | None, end: object) -> None:
        self.ord, self.name, self.end = ord, name, end

    def __lt__(self, other: _Last) -> bool:
        return (self.ord, self.name or "") > (other.ord, other.name or "")


def _blocks(first: Column, after: Column, depth: range) -> Column:
    """The dyadic blocks (level, block) that make up the whole numbers from first to after - 1: two on a level at most."""
    made = []
    for k in depth:
        a, b = F.ceil(first / 2**k).cast("int"), F.floor(after / 2**k).cast("int")
        there = lambda x, k=k: F.struct(F.lit(k).alias("level"), x.alias("block"))
        made += [F.when((a < b) & (a % 2 == 1), there(a)), F.when((a < b) & (b % 2 == 1) & ((b - 1 > a) | (a % 2 == 0)), there(b - 1))]
    return F.array_compact(F.array(*made))


def rolling(df: DataFrame, by: Sequence[str], order: str, value: str, width: int, name: str) -> DataFrame:
    """by, order, n and name: for each different place (a long) of each group, its rows, and the sum of value over all rows of the group from width before it up to it.

    Rows of one place are added up before anything is moved. The places are sorted into ranges, and each range also gets those of its first
    group that lie within width before it; so a group that holds most of the rows is many tasks' work. The bounds of the ranges, a row for
    each, are what the driver sees. Null places are left out.
    """
    ship(df.sparkSession)
    summed = df.where(F.col(order).isNotNull()).groupBy(*by, F.col(order).cast("long").alias("_at")).agg(F.count("*").alias("n"), F.sum(value).alias("_sum"))
    ranged = cut(cut(summed.withColumn("_group", F.to_json(F.struct(*by), {"ignoreNullFields": "false"}))).repartitionByRange("_group", "_at").withColumn("_range", F.spark_partition_id()))
    begins: dict[str, list[tuple[int, int]]] = {}
    for r, first in ranged.groupBy("_range").agg(F.min(F.struct("_group", "_at")).alias("first")).collect():
        begins.setdefault(first["_group"], []).append((first["_at"], r))
    begins = {g: tuple(np.array(c, np.int64) for c in zip(*sorted(x), strict=True)) for g, x in begins.items()}

    def ahead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            groups, at = batch.column("_group").dictionary_encode(), batch.column("_at").to_numpy()
            code, rows, targets = groups.indices.to_numpy(), [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for k, group in enumerate(groups.dictionary.to_pylist()):
                if group in begins:
                    first, number = begins[group]
                    own = np.flatnonzero(code == k)
                    low, high = np.searchsorted(first, at[own], "right"), np.searchsorted(first, at[own] + width, "right")
                    many = high - low
                    rows.append(np.repeat(own, many))
                    targets.append(number[np.repeat(low, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)])
            taken = batch.take(pa.array(np.concatenate(rows)))
            yield taken.set_column(taken.schema.get_field_index("_range"), "_range", pa.array(np.concatenate(targets).astype(np.int32)))

    halo = ranged.mapInArrow(ahead, ranged.schema).withColumn("_own", F.lit(False))
    frame = Window.partitionBy("_range", "_group").orderBy("_at").rangeBetween(-width, 0)
    met = ranged.withColumn("_own", F.lit(True)).unionByName(halo).withColumn(name, F.sum("_sum").over(frame))
    return met.where("_own").select(*by, F.col("_at").alias(order), "n", name)


def by_priority(df: DataFrame, by: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Of each group the first row in an order."""
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where("_r = 1").drop("_r")


def top_n(df: DataFrame, by: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= n).withColumn("rank", F.col("rank").cast("long"))


def fused(rankings: Sequence[tuple[str, DataFrame]], id: str, k: int = 60) -> DataFrame:
    """Reciprocal-rank fusion: the sum of 1 / (k + rank) over rankings (id, rank from 1), and which of them had the row."""
    every = None
    for name, r in rankings:
        part = r.select(id, (1 / (k + F.col("rank"))).alias("_s"), F.lit(name).alias("_m"))
        every = part if every is None else every.unionByName(part)
    return every.groupBy(id).agg(F.sum("_s").alias("score"), F.array_join(F.sort_array(F.collect_set("_m")), "+").alias("method"))


def upsert(target: DataFrame, changes: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """target with each key's newest change instead of its row; changes with new keys are added."""
    newest = by_priority(changes, keys, order)
    return target.join(newest.select(*keys), list(keys), "left_anti").unionByName(newest)


def null_rates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """field, n, n_null (null or ''), rate."""
    counts = df.agg(F.count("*").alias("n"), *[F.sum((F.col(c).isNull() | (F.col(c).cast("string") == "")).cast("long")).alias(c) for c in columns])
    return counts.select("n", F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("n_null")) for c in columns])).alias("x")).select("x.field", "n", "x.n_null", F.round(F.col("x.n_null") / F.col("n"), 6).alias("rate"))


def first_distinct(df: DataFrame, by: Sequence[str], value: str, n: int, name: str, separator: str = ",") -> DataFrame:
    """The n smallest different values of each group, joined in order. A group is cut to n values before it is gathered."""
    few = df.where(F.col(value).isNotNull()).select(*by, F.col(value).cast("string").alias("_v")).distinct().withColumn("_r", F.row_number().over(Window.partitionBy(*by).orderBy("_v"))).where(F.col("_r") <= n)
    return few.groupBy(*by).agg(F.array_join(F.sort_array(F.collect_list("_v")), separator).alias(name))


def multimap(df: DataFrame, by: str, source: str, value: str) -> DataFrame:
    """by, ids map<source, array of different values in order>; rows without a source or value are left out. Pairs are made distinct before they are gathered."""
    pairs = df.select(by, source, value).dropna().distinct()
    lists = pairs.groupBy(by, source).agg(F.sort_array(F.collect_list(value)).alias("_v"))
    return lists.groupBy(by).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct(source, "_v")))).alias("ids"))


def offenders(rules: dict[str, DataFrame]) -> DataFrame:
    """rule, atom_id, n: of each rule's offending rows (atom_id), how many there are of each id."""
    parts = [df.groupBy("atom_id").agg(F.count("*").alias("n")).select(F.lit(name).alias("rule"), "atom_id", "n") for name, df in rules.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


def audited(checks: Sequence[tuple[str, DataFrame, float, DataFrame]]) -> DataFrame:
    """check_, n (offending rows) and status of each check (name, offending rows, share that is bearable, all rows): PASS for none, WARN within the share, FAIL beyond it."""
    out = []
    for name, bad, bound, whole in checks:
        n, total = bad.agg(F.count("*").alias("n")), whole.agg(F.count("*").alias("_all"))  # one row each
        status = F.when(F.col("n") == 0, "PASS").when(F.col("n") <= bound * F.col("_all"), "WARN").otherwise("FAIL")
        out.append(n.join(F.broadcast(total), F.lit(True)).select(F.lit(name).alias("check_"), "n", status.alias("status")))
    return reduce(lambda a, b: a.unionByName(b), out)
