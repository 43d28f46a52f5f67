"""Benchmark passages in documents, found through a positional inverted index of the documents' words.

1. How often each word of the benchmark occurs in the documents is counted.
2. Of every window of a benchmark item, its rarest words are its keys; a window with a word that never occurs can't be in any document.
3. Postings (term, document, position) are stored for all keys over all documents.
4. The postings of an item's keys are adjusted by the keys' own offsets in the item and intersected per document: an exact phrase gives one
   and the same adjusted offset for all keys of a window, a proximity match gives offsets within a slop of each other.
5. Documents with candidates are compared with the items word for word along these offsets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .session import cut, done_with, key_of, small_batches, written
from .text import ALNUM, FOLD, column_bytes, in_pieces, pieces, words

U = np.uint64
LENGTH, KEYS, SLOP = 10, 3, 5


def _words(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For runs of rows: the first row, the words' hashes, and the first word of each row (with the end last)."""
    data, offsets = column_bytes(column)
    for i, j in pieces(offsets):
        _, _, hashes, first = words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], ALNUM, FOLD)
        yield i, hashes, first


class Terms:
    """A table of 64-bit hashes that is asked for the number of many hashes at once; it is sent with the tasks, so its size is bounded by who makes it."""

    def __init__(self, hashes: np.ndarray):
        self.sorted = np.unique(hashes)
        self.bits = min(20, max(8, int(len(self.sorted)).bit_length() + 3))
        self.seen = np.zeros(1 << self.bits, bool)
        self.seen[(self.sorted >> U(64 - self.bits)).astype(np.int64)] = True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The places where a hash is in the table, and its number there."""
        at = np.flatnonzero(self.seen[(hashes >> U(64 - self.bits)).astype(np.int64)])
        if not len(self.sorted):
            return at[:0], at[:0]
        number = np.minimum(np.searchsorted(self.sorted, hashes[at]), len(self.sorted) - 1)
        hit = self.sorted[number] == hashes[at]
        return at[hit], number[hit]


def _tokens(items: DataFrame, text: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_pieces(batches):
            for i, hashes, first in _words(batch.column(1)):
                lists = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(hashes.view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, len(first) - 1), lists], names=["item", "tokens"])

    return items.select(F.col("item").cast("string"), F.col(text).alias("text")).mapInArrow(run, "item string, tokens array<long>")


def _frequencies(docs: DataFrame, terms: Terms) -> np.ndarray:
    """How often each term occurs in all documents; a task sends one row for each term that it has met."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(terms.sorted), np.int64)
        for batch in in_pieces(batches):
            for _, hashes, _ in _words(batch.column(0)):
                counts += np.bincount(terms.find(hashes)[1], minlength=len(counts))
        met = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(counts[met])], names=["term", "n"])

    out = np.zeros(len(terms.sorted), np.int64)
    for term, n in docs.select("_text").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n")).collect():
        out[term] = n
    return out


def postings(docs: DataFrame, terms: Terms) -> DataFrame:
    """The positional index of the documents (_key long, _text) for these terms: term int, doc long, pos int."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_pieces(batches):
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for i, hashes, first in _words(batch.column(1)):
                at, number = terms.find(hashes)
                row = np.searchsorted(first, at, "right") - 1
                yield pa.RecordBatch.from_arrays([pa.array(number.astype(np.int32)), pa.array(ids[i + row]), pa.array((at - first[row]).astype(np.int32))], names=["term", "doc", "pos"])

    return docs.select("_key", "_text").mapInArrow(run, "term int, doc long, pos int")


def window_keys(tokens: np.ndarray, numbers: np.ndarray, counts: np.ndarray, length: int, keys: int) -> list[list[int]]:
    """For each window of an item whose words all occur in the documents, the offsets in the item of its rarest words."""
    often, n = counts[numbers], len(tokens)
    width = min(length, n)
    out = []
    for s in range(n - width + 1):
        part = often[s : s + width]
        if part.min() > 0:
            out.append(sorted((s + np.argsort(part, kind="stable")[:keys]).tolist()))
    return out


def _candidates(docs: DataFrame, slice_: list[tuple[int, np.ndarray]], length: int, keys: int, slop: int) -> tuple[DataFrame, str]:
    """The path of the stored postings, and doc, and found: an array of struct<item int, hits array<struct<at, off>>, tokens, keys> for each item that may occur in the document."""
    spark = docs.sparkSession
    terms = Terms(np.concatenate([t for _, t in slice_]))
    counts = _frequencies(docs, terms)
    plan = [(i, t, n := np.searchsorted(terms.sorted, t), window_keys(t, n, counts, length, keys)) for i, t in slice_]
    plan = [p for p in plan if p[3]]
    wanted = sorted({(int(n[o]), i, o) for i, _, n, ks in plan for k in ks for o in k})
    index = Terms(terms.sorted[np.unique([w[0] for w in wanted])] if wanted else terms.sorted[:0])
    place = {int(h): k for k, h in enumerate(index.sorted)}
    least = {i: min(map(len, ks)) for i, _, _, ks in plan}
    offsets = spark.createDataFrame([(place[int(terms.sorted[t])], i, o, least[i]) for t, i, o in wanted], "term int, item int, off int, least int")
    items = spark.createDataFrame([(i, t.view(np.int64).tolist(), ks) for i, t, _, ks in plan], "item int, tokens array<long>, keys array<array<int>>")
    stored, path = written(postings(docs, index), "postings")
    hits = stored.join(offsets, "term").select("doc", "item", (F.col("pos") - F.col("off")).alias("at"), "off", "least")
    around = Window.partitionBy("doc", "item").orderBy("at").rangeBetween(-slop, slop)  # a few hits, however many the document has
    near = hits.withColumn("_enough", F.size(F.collect_set("off").over(around)) >= F.col("least"))
    near = near.withColumn("_near", F.max("_enough").over(around)).where("_near")
    met = near.groupBy("doc", "item").agg(F.collect_list(F.struct("at", "off")).alias("hits")).join(items, "item")
    return cut(met.select("doc", F.struct("item", "hits", "tokens", "keys").alias("found"))), path


def _judge(hashes: np.ndarray, found: list[dict], length: int, slop: int, hit: np.ndarray) -> tuple[set[int], set[int]]:
    """Marks the words of one document that item windows cover; the items that occur, and those that are met within the slop alone."""
    exact, close = set(), set()
    for f in found:
        tokens, ways = np.array(f["tokens"], np.int64).view(U), [frozenset(k) for k in f["keys"]]
        at, off = (np.array([h[n] for h in f["hits"]]) for n in ("at", "off"))
        order = np.lexsort((off, at))
        at, off = at[order], off[order].tolist()
        width, least = min(length, len(tokens)), min(map(len, ways))
        places, first = np.unique(at, return_index=True)
        last = [*first[1:].tolist(), len(at)]
        for d, a, b in zip(places.tolist(), first.tolist(), last, strict=True):
            lo, hi = max(0, d), min(len(hashes), d + len(tokens))
            if hi - lo < width or len(set(off[a:b])) < least:
                continue
            same = np.concatenate([[0], np.cumsum(hashes[lo:hi] == tokens[lo - d : hi - d])])
            for s in np.flatnonzero(same[width:] - same[:-width] == width).tolist():
                hit[lo + s : lo + s + width] = True
                exact.add(f["item"])
        if f["item"] not in exact:
            spans = zip(np.searchsorted(at, places - slop).tolist(), np.searchsorted(at, places + slop, "right").tolist(), strict=True)
            met = {frozenset(off[a:b]) for a, b in spans}
            if any(k <= m for m in met if len(m) >= least for k in ways):
                close.add(f["item"])
    return exact, close


def decontaminate(docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", length: int = LENGTH, keys: int = KEYS, slop: int = SLOP, carry: tuple[str, ...] = (), most_tokens: int = 2_000_000) -> DataFrame:
    """Per row of docs: id, the carried columns, n_words, n_hit, items (array of the item ids with occurring windows), near_items (ids of items of
    which all keys of a window lie within slop words of where the window has them, though no window occurs).

    Words are runs of ASCII letters (A-Z lower-cased), digits and non-ASCII characters. A word of a document is hit if an occurrence of a
    window of so many words (of all words, for a shorter item) covers it. Null texts and items without words have none. A null item id is
    listed as 'null'; items with one id count once. Repeated rows are judged one by one; rows that share an id may hold different texts. An
    empty benchmark hits nothing; an empty table gives no rows.

    The benchmark is taken in slices of at most so many words; what the tasks get of a slice is bounded by that (8 bytes a word), however
    large the benchmark. Postings of a key that is frequent are many rows of one join key, which Spark's skew join splits; they are not
    expanded beyond the items that have the key.
    """
    spark = docs.sparkSession
    small_batches(spark)
    keyed = docs.select(F.col(id).alias("_id"), *[F.col(c).alias(f"_c{k}") for k, c in enumerate(carry)], F.col(text).alias("_text"), key_of(id).alias("_key"))
    tokens = cut(_tokens(benchmark.select(F.coalesce(F.col(item).cast("string"), F.lit("null")).alias("item"), F.col(item_text).alias("text")), "text").where("size(tokens) > 0").distinct().withColumn("no", F.monotonically_increasing_id()))
    n_tokens = tokens.agg(F.coalesce(F.sum(F.size("tokens")), F.lit(0))).first()[0]
    n_slices = -(-n_tokens // most_tokens)
    parts = []
    for k in range(n_slices):
        rows = tokens.where(F.pmod(F.xxhash64("item", "tokens"), F.lit(n_slices)) == k).orderBy("item", "tokens").collect()
        names = [r["item"] for r in rows]
        if rows:
            found, path = _candidates(keyed, [(i, np.array(r["tokens"], np.int64).view(U)) for i, r in enumerate(rows)], length, keys, slop)
            named = spark.createDataFrame(list(enumerate(names)), "no int, name string")
            parts.append(found.join(named, found["found.item"] == named.no).select("doc", F.struct(F.col("name").alias("item"), "found.hits", "found.tokens", "found.keys").alias("found")))
            done_with(spark, path)
    wide = keyed
    if parts:
        every = parts[0]
        for p in parts[1:]:
            every = every.unionByName(p)
        lists = cut(every.groupBy("doc").agg(F.collect_list("found").alias("_found")))
        wide = keyed.join(lists, keyed._key == lists.doc, "left").drop("doc")
    else:
        wide = keyed.withColumn("_found", F.expr("cast(null as array<struct<item:string,hits:array<struct<at:int,off:int>>,tokens:array<bigint>,keys:array<array<int>>>>)"))
    kept = [f"_c{k}" for k in range(len(carry))]
    wide = wide.select("_id", *kept, "_text", "_found")
    schema = wide.drop("_text", "_found").withColumns({"n_words": F.lit(0).cast("long"), "n_hit": F.lit(0).cast("long"), "items": F.array(F.lit("")), "near_items": F.array(F.lit(""))}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_pieces(batches):
            text_at, found_at = batch.num_columns - 2, batch.num_columns - 1
            n, hits, items, near = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64), [[]] * batch.num_rows, [[]] * batch.num_rows
            some = batch.column(found_at)
            for i, hashes, first in _words(batch.column(text_at)):
                n[i : i + len(first) - 1] = np.diff(first)
                for k in range(len(first) - 1):
                    if some[i + k].is_valid:
                        mark = np.zeros(first[k + 1] - first[k], bool)
                        exact, close = _judge(hashes[first[k] : first[k + 1]], some[i + k].as_py(), length, slop, mark)
                        hits[i + k], items[i + k], near[i + k] = mark.sum(), sorted(exact), sorted(close - exact)
            yield pa.RecordBatch.from_arrays([*batch.columns[:text_at], pa.array(n), pa.array(hits), pa.array(items, pa.list_(pa.string())), pa.array(near, pa.list_(pa.string()))], names=[*batch.schema.names[:text_at], "n_words", "n_hit", "items", "near_items"])

    return wide.mapInArrow(run, schema).select(F.col("_id").alias(id), *[F.col(a).alias(b) for a, b in zip(kept, carry, strict=True)], "n_words", "n_hit", "items", "near_items")


def clean(docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text", **more) -> DataFrame:
    """The rows of docs, with all their columns, of which no word is hit."""
    columns = docs.columns
    flat = docs.select(*[F.col(c).alias(f"d{k}") for k, c in enumerate(columns)])
    found = decontaminate(flat.withColumn("d_id", F.col(f"d{columns.index(id)}")), benchmark, "d_id", f"d{columns.index(text)}", carry=tuple(flat.columns), **more)
    return found.where("n_hit = 0").select(*[F.col(f"d{k}").alias(c) for k, c in enumerate(columns)])


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join(F.sort_array("items"), ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


#: DuckDB SQL for op6.
OP6_SQL = r"""
with d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
b as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
bw as (
  select item_id, least(len(w), 10) as n, array_to_string(w[s:s + least(len(w), 10) - 1], ' ') as win
  from (select *, unnest(range(1, len(w) - least(len(w), 10) + 2)) as s from b where len(w) > 0)),
lens as (select distinct n from bw),
dw as (
  select doc_id, n, s, array_to_string(w[s:s + n - 1], ' ') as win
  from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as s from d, lens where len(w) >= n)),
m as (select distinct dw.doc_id, dw.n, dw.s, bw.item_id from dw join bw on dw.n = bw.n and dw.win = bw.win),
h as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(s, s + n)) as p from m) group by 1),
i as (select doc_id, count(*) as n_items, string_agg(id, ',' order by id) as ids from (select distinct doc_id, cast(item_id as varchar) as id from m) group by 1)
select d.doc_id, len(d.w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join h using (doc_id) left join i using (doc_id)
"""
