"""Operators that decide which known thing a record is: by several keys, or by the nearest vector."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.text import cosine
from ..session import cut, settled, ship
from .vectors import nearest_rows, resembling_earlier

__all__ = ["nearest_rows", "resembling_earlier"]


def resolve(df: DataFrame, known: DataFrame, id: str, strong: Sequence[str], weak: Sequence[str], strict: bool = False) -> DataFrame:
    """df with match_id and match: strong, weak (only weak keys hit), conflict (keys lead to different ids) or none.

    Of known rows that share a key value the smallest id counts; null and '' are no values. match_id is null for conflicts, and for weak
    matches if strict. One equality join for each key.
    """
    out, keys = df, [*strong, *weak]
    for k, key in enumerate(keys):
        index = known.where(F.col(key).isNotNull() & (F.col(key) != "")).groupBy(F.col(key).alias(f"_k{k}")).agg(F.min(id).alias(f"_id{k}"))
        out = out.join(index, F.col(key) == F.col(f"_k{k}"), "left").drop(f"_k{k}")
    hits = [F.col(f"_id{k}") for k in range(len(keys))]
    ids = F.array_distinct(F.array_compact(F.array(*hits)))
    firm = F.coalesce(*hits[: len(strong)]).isNotNull() if strong else F.lit(False)
    match = F.when(F.size(ids) == 0, "none").when(F.size(ids) > 1, "conflict").when(firm, "strong").otherwise("weak")
    usable = F.col("match").isin(["strong"] if strict else ["strong", "weak"])
    return out.withColumns({"match": match, "_ids": ids}).withColumn("match_id", F.when(usable, F.get("_ids", F.lit(0)))).drop("_ids", *[f"_id{k}" for k in range(len(keys))])


def _taken_up(rows: pa.Table, known: pa.Table, strong: int, keys: int, strict: bool) -> tuple[list[tuple], dict]:
    """Of a range of records, in order: _order, entry, outcome and the entry's keys; and its values with the entry that took each up here, if one did.

    known: what ranges before it hold of its values: (key, value) is of an entry, or (filled) an entry has this value for a key.
    """
    index: dict[tuple[int, str], int] = {}
    entries: dict[int, dict[int, str]] = {}
    for key, value, entry, filled in zip(*(known.column(c).to_pylist() for c in ("key", "value", "entry", "filled")), strict=True):
        own = entries.setdefault(entry, {})
        if filled:
            own[key] = value
        else:
            index[key, value] = entry
    out, claimed = [], {}
    rows = rows.sort_by("_order")
    for number, *values in zip(*(rows.column(c).to_pylist() for c in ["_order", *map(str, range(keys))]), strict=True):
        own = [(k, v) for k, v in enumerate(values) if v is not None]
        ids = {index[x] for x in own if x in index}
        if len(ids) > 1:
            entry, outcome = None, "conflict"
        elif ids:
            firm = any(k < strong and (k, v) in index for k, v in own)
            outcome = "merged" if firm else "refused" if strict else "weak"
            entry = ids.pop() if firm or not strict else None
        else:
            entry, outcome = number, "new"
            entries[number] = {}
        for x in own:
            claimed.setdefault(x, None)
        held = entries[entry] if entry is not None else {}
        if entry is not None:
            for k, v in own:
                if k not in held:
                    held[k] = v
                    if (k, v) not in index:
                        index[k, v] = claimed[k, v] = entry
        out.append((number, entry, outcome, *[held.get(k) for k in range(keys)]))
    return out, claimed


def _held_before(state: DataFrame) -> DataFrame:
    """Of state (_range, key, value, entry: which took the value up in that range, if one did), what each range finds held by those before it."""
    before = Window.partitionBy("key", "value").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    held = cut(state.select("_range", "key", "value", F.first("entry", True).over(before).alias("entry")).where("entry is not null"))
    taken = state.where("entry is not null").select("entry", "key", "value", F.col("_range").alias("_at"))
    own = held.select("_range", "entry").distinct().join(taken, "entry").where("_at < _range").groupBy("_range", "entry", "key").agg(F.min_by("value", "_at").alias("value"))
    return cut(held.withColumn("filled", F.lit(False)).unionByName(own.withColumn("filled", F.lit(True))))


def registered(records: DataFrame, order: str, strong: Sequence[str], weak: Sequence[str], strict: bool = False, local: int = 100_000) -> DataFrame:
    """Records taken up in order: order, entry (the order of the record that founded its entry), outcome and the entry's keys after this record.

    A record none of whose keys is known founds an entry (new). If its keys lead to one entry it is merged into that, and fills the keys that
    the entry lacks; a key that the entry has with another value is not taken up. If only weak keys hit, it is merged as weak, or refused if
    strict. Keys that lead to different entries are a conflict, which changes nothing. Null and '' are no keys; order tells all records apart.

    Tasks take up ranges of about so many records, all at once, each with what the ranges before it held in the last round; a range for which
    that has changed is taken up again, until none has. The first k ranges are right after k rounds, so this ends, with the result of one loop.
    """
    spark = records.sparkSession
    ship(spark)
    keys, n_strong = [*strong, *weak], len(strong)
    kept = cut(records.select(F.col(order).cast("long").alias("_order"), *[F.nullif(F.col(k).cast("string"), F.lit("")).alias(str(i)) for i, k in enumerate(keys)]))
    ranges = kept.count() // local + 1
    ranged = cut(kept.repartitionByRange(ranges, "_order").withColumn("_range", F.spark_partition_id()))
    schema = ", ".join([f"`{order}` long, entry long, outcome string", *[f"`{k}` string" for k in keys]])
    kinds = pa.schema([(order, pa.int64()), ("entry", pa.int64()), ("outcome", pa.string()), *[(k, pa.string()) for k in keys]])

    def claims(key: tuple, rows: pa.Table, known: pa.Table) -> pa.Table:
        claimed = _taken_up(rows, known, n_strong, len(keys), strict)[1]
        columns = [pa.array([key[0].as_py()] * len(claimed), pa.int32()), pa.array([k for k, _ in claimed], pa.int32()), pa.array([v for _, v in claimed], pa.string()), pa.array(list(claimed.values()), pa.int64())]
        return pa.Table.from_arrays(columns, names=["_range", "key", "value", "entry"])

    def outcomes(rows: pa.Table, known: pa.Table) -> pa.Table:
        out = _taken_up(rows, known, n_strong, len(keys), strict)[0]
        return pa.Table.from_arrays([pa.array([x[i] for x in out], f.type) for i, f in enumerate(kinds)], schema=kinds)

    met = lambda rows, known: rows.groupBy("_range").cogroup(known.groupBy("_range"))
    known = spark.createDataFrame([], "_range int, key int, value string, entry long, filled boolean")
    state, found, changed = None, {}, list(range(ranges))
    while changed:
        these = F.col("_range").isin(changed)
        made = met(ranged.where(these), known.where(these)).applyInArrow(claims, "_range int, key int, value string, entry long")
        state = settled((made if state is None else made.unionByName(state.where(~these))).repartition("key", "value"))
        known = _held_before(state)
        now = {r[0]: tuple(r[1:]) for r in known.groupBy("_range").agg(F.count("*"), F.sum(F.xxhash64("key", "value", "entry", "filled").cast("decimal(38,0)"))).collect()}  # a row for each range
        changed, found = [r for r in range(ranges) if now.get(r) != found.get(r)], now
    return met(ranged, known).applyInArrow(outcomes, schema)


def nearest(queries: DataFrame, known: DataFrame, id: str, vector: str, **index) -> DataFrame:
    """Of each query row its id, nearest_id and similarity, as nearest_rows has them; 0 and no nearest_id for a query without one."""
    top = nearest_rows(queries, known, id, vector, 1, **index).drop("rank").withColumnRenamed(id, "_q")
    return queries.select(id).join(top, F.col("_q") == F.col(id), "left").select(id, "nearest_id", F.coalesce("similarity", F.lit(0.0)).alias("similarity"))


def nearest_of(df: DataFrame, known: DataFrame, id: str, vector: str, known_id: str, known_vector: str, k: int, block: int = 512, places: int = 6) -> DataFrame:
    """Of each row the k most similar of known (a table of centres): id, known, similarity (cosine, rounded), rank from 1; ties to the smaller known id.

    Known vectors are dealt over blocks of so many; a row meets each block in one array and keeps the k best of it, then the k best of all.
    """
    ranked = known.withColumn("_b", F.floor((F.row_number().over(Window.orderBy(known_id)) - 1) / block))  # centres alone meet in one task
    blocks = ranked.groupBy("_b").agg(F.collect_list(F.struct(F.col(known_id).alias("known"), F.col(known_vector).alias("v"))).alias("_ks"))
    n = blocks.count()
    # One block (its size is bounded) goes to all rows; of several, each row meets each by its number, in 32 parts, so that no block is one task's.
    rows = df if n <= 1 else df.withColumns({"_b": F.explode(F.sequence(F.lit(0), F.lit(n - 1)).cast("array<bigint>")), "_part": F.pmod(F.xxhash64(id), F.lit(32))})
    met = rows.join(F.broadcast(blocks.drop("_b")), F.lit(True)) if n <= 1 else rows.join(blocks.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(31)).cast("array<bigint>"))), ["_b", "_part"])
    scored = F.transform("_ks", lambda a: F.struct((-F.round(cosine(F.col(vector), a["v"]), places)).alias("less"), a["known"].alias("known")))
    few = met.select(id, F.slice(F.sort_array(scored), 1, k).alias("_s"))
    best = (few if n <= 1 else few.groupBy(id).agg(F.flatten(F.collect_list("_s")).alias("_s"))).select(id, F.posexplode(F.slice(F.sort_array("_s"), 1, k)).alias("_k", "x"))
    return best.select(id, "x.known", (-F.col("x.less")).alias("similarity"), (F.col("_k") + 1).cast("long").alias("rank"))


def novelty(similarity: Column, same: float = 0.9, similar: float = 0.75) -> Column:
    """duplicate above one bound, similar above the other, else novel."""
    return F.when(similarity > same, "duplicate").when(similarity > similar, "similar").otherwise("novel")


def link(df: DataFrame, id: str, item: str, known: DataFrame, known_id: str, levels: Sequence[tuple[str, str, float]], suffix: tuple[str, str, float, int], joint: str = "_") -> DataFrame:
    """df with id, confidence and method: the first of levels (method, column of known, confidence) whose column equals the item, else a name that the
    item ends with, the shortest of one to so many words first. Of known rows with one key that with the largest id counts."""
    out, hits = df.withColumnRenamed(id, "_row"), []
    for k, (_, column, _) in enumerate(levels):
        index = known.where(F.col(column).isNotNull()).groupBy(F.col(column).alias(f"_k{k}")).agg(F.max(known_id).alias(f"_id{k}"))
        out = out.join(index, F.col(item) == F.col(f"_k{k}"), "left").drop(f"_k{k}")
        hits.append(F.col(f"_id{k}"))
    method, column, sure, most = suffix
    words = F.split(item, joint)
    ends = F.transform(F.sequence(F.lit(1), F.least(F.lit(most), F.size(words) - 1)), lambda n: F.struct(n.alias("n"), F.array_join(F.slice(words, -n, n), joint).alias("key")))
    index = known.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("key")).agg(F.max(known_id).alias("_id"))
    rest = out.where(F.coalesce(*hits).isNull() & (F.size(words) > 1)).select("_row", F.explode(ends).alias("e")).select("_row", "e.*").join(index, "key")
    tail = rest.groupBy("_row").agg(F.min_by("_id", "n").alias("_tail"))
    names, sures = [m for m, _, _ in levels] + [method], [c for _, _, c in levels] + [sure]
    found = out.join(tail, "_row", "left")
    hits = [*hits, F.col("_tail")]
    said = lambda values: F.coalesce(*[F.when(h.isNotNull(), F.lit(v)) for h, v in zip(hits, values, strict=True)])
    return found.select(F.col("_row").alias(id), item, F.coalesce(*hits).alias("id"), said(sures).alias("confidence"), F.coalesce(said(names), F.lit("none")).alias("method"))


def filled_in(commands: DataFrame, outputs: DataFrame, group: str, order: str, command: str, value: str) -> DataFrame:
    """Commands in which {stepN.value} stands for the output of step N of their group, if it is an earlier one; adds unresolved (how many stay).

    Only outputs that a command names are joined to it.
    """
    pattern = r"\{step(\d+)\.value\}"
    named = commands.withColumn("_n", F.array_distinct(F.regexp_extract_all(command, F.lit(pattern), F.lit(1))))
    asked = named.select(group, order, F.explode(F.col("_n").cast("array<bigint>")).alias("_step")).where(F.col("_step") < F.col(order))
    got = asked.join(outputs.select(group, F.col(order).cast("long").alias("_step"), F.col(value).alias("_v")), [group, "_step"]).groupBy(group, order).agg(F.collect_list(F.struct("_step", "_v")).alias("_vs"))
    filled = F.aggregate(F.coalesce("_vs", F.array().cast("array<struct<_step:bigint,_v:string>>")), F.col(command), lambda s, x: F.replace(s, F.concat(F.lit("{step"), x["_step"].cast("string"), F.lit(".value}")), x["_v"]))
    return named.join(got, [group, order], "left").select(group, order, filled.alias(command)).withColumn("unresolved", F.regexp_count(command, F.lit(pattern)).cast("long"))
