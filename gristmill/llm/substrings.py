"""Repeated passages, found level by level: windows that repeat at one length alone are extended to twice that length.

Level 1 looks at a quarter of the window (5 words of 20). Not all of them need be counted: of the short windows inside a long one, the first
with the least hash is its anchor, and two equal long windows have the same anchor at the same place. So only anchors are counted, about one
word in eight. Level 2 extends the anchors that repeat to twice their length, to the right or, where the long window ends earlier, to the
left. Level 3 extends those that repeat to whole windows. A run (the windows that share an anchor) is compared as a whole first: of equal
runs the first one stays, and only it is opened into windows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .session import cut, done_with, key_of, small_batches, written
from .text import column_bytes, first_least, in_pieces, last_fit, mix, pieces, windows, words

U = np.uint64


def _runs(hashes: np.ndarray, first: np.ndarray, base: int, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The hashes of the base windows, the starts of the whole windows, and the anchor of each."""
    short = mix(windows(hashes, base))
    starts = np.flatnonzero(last_fit(first, length))
    return short, starts, first_least(short, length - base + 1)[starts] if len(starts) else starts


def _hashed(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    data, offsets = column_bytes(column)
    for i, j in pieces(offsets):
        _, _, hashes, first = words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
        yield i, hashes, first


def _changes(*arrays: np.ndarray) -> np.ndarray:
    """Where a run of equal values (in all arrays) begins."""
    new = np.ones(len(arrays[0]), bool)
    new[1:] = np.logical_or.reduce([a[1:] != a[:-1] for a in arrays])
    return np.flatnonzero(new)


def _anchors(docs: DataFrame, base: int, length: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_pieces(batches):
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for i, hashes, first in _hashed(batch.column(1)):
                short, _, anchor = _runs(hashes, first, base, length)
                if len(anchor):
                    at = anchor[_changes(anchor)]
                    row = np.searchsorted(first, at, "right") - 1
                    yield pa.RecordBatch.from_arrays([pa.array(short[at].view(np.int64)), pa.array(ids[i + row]), pa.array((at - first[row]).astype(np.int32))], names=["h", "key", "at"])

    return docs.select("key", "text").mapInArrow(run, "h long, key long, at int")


def _extended(docs: DataFrame, base: int, length: int) -> DataFrame:
    """Of documents (key, th, text, places of anchors that repeat): a row for each run of windows on such an anchor, with the hash of twice its length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_pieces(batches):
            keys, ths = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            places, ends = batch.column(3).flatten().to_numpy(zero_copy_only=False).astype(np.int64), batch.column(3).offsets.to_numpy().astype(np.int64)
            ends = ends - ends[0]
            for i, hashes, first in _hashed(batch.column(2)):
                _, starts, anchor = _runs(hashes, first, base, length)
                n = len(first) - 1
                wanted = np.repeat(first[:-1], np.diff(ends[i : i + n + 1])) + places[ends[i] : ends[i + n]]
                repeats = np.zeros(len(hashes) + 1, bool)
                repeats[np.minimum(wanted, len(hashes))] = True
                on = repeats[anchor] if len(anchor) else np.zeros(0, bool)
                starts, anchor = starts[on], anchor[on]
                if not len(starts):
                    continue
                right = anchor - starts <= length - 2 * base
                begin = _changes(anchor, right)
                double, whole = mix(windows(hashes, 2 * base)), mix(windows(hashes, length))[starts]
                size = np.diff(np.append(begin, len(starts)))
                step = np.arange(len(starts)) - np.repeat(begin, size)
                h2 = mix(double[np.where(right, anchor, anchor - base)[begin]] + right[begin].astype(U))
                alike = mix(np.add.reduceat(mix(whole + step.astype(U) * U(0x9E3779B97F4A7C15)), begin) + size.astype(U))
                row = np.searchsorted(first, starts[begin], "right") - 1
                lists = pa.ListArray.from_arrays(pa.array(np.append(begin, len(starts)).astype(np.int32)), pa.array(whole.view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h2.view(np.int64)), pa.array(alike.view(np.int64)), pa.array(keys[i + row]), pa.array(ths[i + row]), pa.array((starts[begin] - first[row]).astype(np.int32)), pa.array(size.astype(np.int32)), lists],
                    names=["h2", "alike", "key", "th", "at", "n", "whole"],
                )

    return docs.select("key", "th", "text", "places").mapInArrow(run, "h2 long, alike long, key long, th long, at int, n int, whole array<long>")


def repeats(docs: DataFrame, length: int = 20) -> DataFrame:
    """Of documents (key long, th long, text): key, th, spans array<struct<at int, n int>>: runs of n windows from word at on that start earlier too."""
    spark, base = docs.sparkSession, max(1, length // 4)
    places = _places(docs, base, length)
    rows, path = written(_extended(docs.join(places, "key"), base, length), "runs")
    del places
    done_with(spark)
    spans, classes_path = _spans(rows)
    spans = cut(spans)
    done_with(spark, path, classes_path)
    return spans


def _places(docs: DataFrame, base: int, length: int) -> DataFrame:
    """Level 1: key, places array<int> of the anchors whose words occur more than once."""
    anchors, path = written(_anchors(docs, base, length), "anchors")
    again = cut(anchors.groupBy("h").agg(F.count("*").alias("c")).where("c > 1").select("h"))
    places = cut(anchors.join(again, "h", "left_semi").groupBy("key").agg(F.sort_array(F.collect_set("at")).alias("places")))
    del anchors, again
    done_with(docs.sparkSession, path)
    return places


def _spans(rows: DataFrame) -> tuple[DataFrame, str]:
    """Levels 2 and 3, of the runs on anchors that repeat; and the path of a table that the caller may remove."""
    origin = F.struct("key", "th", "at")
    classes, path = written(rows.groupBy("h2", "alike").agg(F.min(origin).alias("origin"), F.count("*").alias("c"), F.first("whole").alias("whole")), "classes")
    done_with(rows.sparkSession)
    narrow, several = rows.select("h2", "alike", "key", "th", "at", "n"), classes.where("c > 1").select("h2", "alike", "origin")
    later = cut(narrow.join(several, ["h2", "alike"]).where(origin > F.col("origin")).groupBy("key", "th").agg(F.collect_list(F.struct("at", "n")).alias("spans")))
    del narrow, several
    done_with(rows.sparkSession)
    within = cut(_within(classes).groupBy("key", "th").agg(F.collect_list(F.struct("at", "n")).alias("spans")))
    done_with(rows.sparkSession)
    return later.unionByName(within).groupBy("key", "th").agg(F.flatten(F.collect_list("spans")).alias("spans")), path


def _within(classes: DataFrame) -> DataFrame:
    """Of the first of equal runs, where other runs have the same middle level: the single windows that start earlier."""
    origin = F.struct("key", "th", "at")
    shared = cut(classes.groupBy("h2").agg(F.count("*").alias("c")).where("c > 1").select("h2"))
    opened = classes.join(shared, "h2").select("h2", "origin.*", F.posexplode("whole").alias("step", "whole"))
    opened = cut(opened.select("h2", "whole", "key", "th", (F.col("at") + F.col("step")).alias("at")).distinct())
    starts = cut(opened.groupBy("h2", "whole").agg(F.min(origin).alias("origin"), F.count("*").alias("c")).where("c > 1").drop("c"))
    return opened.join(starts, ["h2", "whole"]).where(origin > F.col("origin")).select("key", "th", "at", F.lit(1).alias("n"))


def without_repeats(docs: DataFrame, id: str = "doc_id", text: str = "text", length: int = 20, carry: tuple[str, ...] = ()) -> DataFrame:
    """Per row of docs: id, the carried columns, n_words, n_removed and kept (the text of the words that stay, joined by single spaces).

    Words are runs of anything but ASCII white space, unchanged. A window of so many consecutive words is removed if the same words start
    earlier: in a document with a smaller id, or earlier in the same one. Windows are judged on the input, not on what is left. A null text
    has no words and an empty kept text. A null id counts as the largest. Rows with the same id and text don't remove each other; rows with
    the same id and different texts are ordered by a hash of the text. Texts may be of any length. Empty input gives no rows. length must be
    a multiple of 4 (other lengths take a shorter first level).

    Equal windows are told by 64 bits of hash within equal hashes of their middle level. Groups: counts and first places are aggregated
    before they are shuffled; joins on a passage that very many documents share are split by Spark's skew join.
    """
    spark = docs.sparkSession
    small_batches(spark)
    keyed = docs.select(F.col(id).alias("_id"), *[F.col(c).alias(f"_c{k}") for k, c in enumerate(carry)], F.col(text).alias("text"), key_of(id).alias("key"), F.xxhash64(text).alias("th"))
    spans = repeats(keyed.where("text is not null").select("key", "th", "text"), length).withColumnsRenamed({"key": "_k", "th": "_h"})
    wide = keyed.join(spans, (keyed.key == spans._k) & (keyed.th == spans._h), "left")
    kept_columns = ["_id", *[f"_c{k}" for k in range(len(carry))]]
    wide = wide.select(*kept_columns, "text", "spans")
    schema = wide.drop("text", "spans").withColumns({"n_words": F.lit(0).cast("long"), "n_removed": F.lit(0).cast("long"), "kept": F.lit("")}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_pieces(batches):
            at = batch.num_columns - 2
            data, offsets = column_bytes(batch.column(at))
            whole, spans_of = data.tobytes(), batch.column(at + 1)
            n, removed, kept = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64), []
            for k in range(batch.num_rows):
                parts = whole[offsets[k] : offsets[k + 1]].split()
                n[k] = len(parts)
                if spans_of[k].is_valid:
                    spans = spans_of[k].values
                    begin, count = (spans.field(f).to_numpy(zero_copy_only=False).astype(np.int64) for f in (0, 1))
                    edge = np.zeros(len(parts) + 1, np.int64)
                    np.add.at(edge, begin, 1)
                    np.add.at(edge, begin + count + length - 1, -1)
                    stay = np.cumsum(edge[:-1]) == 0
                    removed[k] = len(parts) - stay.sum()
                    parts = compress(parts, stay.tolist())
                kept.append(b" ".join(parts))
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], pa.array(n), pa.array(removed), pa.array(kept, pa.binary()).cast(pa.string())], names=[*batch.schema.names[:at], "n_words", "n_removed", "kept"])

    out = wide.mapInArrow(run, schema)
    return out.select(F.col("_id").alias(id), *[F.col(f"_c{k}").alias(c) for k, c in enumerate(carry)], "n_words", "n_removed", "kept")


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = without_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept"), 256).alias("kept_sha256"))


#: DuckDB SQL for op5.
OP5_SQL = r"""
with d as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
x as (select doc_id, s, array_to_string(w[s:s + 19], ' ') as win from (select *, unnest(range(1, len(w) - 18)) as s from d where len(w) >= 20)),
f as (select doc_id, s, row_number() over (partition by win order by doc_id, s) as k from x),
c as (select distinct doc_id, unnest(range(s, s + 20)) as p from f where k > 1),
r as (select doc_id, count(*) as n_removed, list(p) as ps from c group by 1),
k as (
  select t.doc_id, string_agg(t.word, ' ' order by t.p) as kept
  from (select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as p from d) t left join c on c.doc_id = t.doc_id and c.p = t.p
  where c.p is null group by 1)
select d.doc_id, len(d.w) as n_words, coalesce(n_removed, 0) as n_removed, sha256(coalesce(kept, '')) as kept_sha256
from d left join r using (doc_id) left join k using (doc_id)
"""
