"""How far the sources of a language differ in their terms: every pair of sources, and the terms that mark each source off.

The counts of a language's terms by source are a matrix, most of it empty. It is cut into tiles (a block of sources by a block of terms), and
each tile is a K-squared tree: four bits for each quadrant that isn't all zero, level by level, and the counts of its leaves. Two tiles over the
same terms are walked together, for all pairs of their sources at once: where both quadrants are all zero, a pair's share depends on the two
sources' masses alone and is priced by the number of terms; only what is left goes down to single terms. All numbers are integers.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..operators.tables import small
from .session import cut, small_batches, written
from .text import FOLD, column_bytes, in_pieces

#: Bytes of [^\x00-\x40\x5B-\x60\x7B-\x7F]+ after folding; in UTF-8, bytes from 0x80 are parts of non-ASCII characters.
TERM, OTHER = re.compile(rb"[a-z\x80-\xff]+"), re.compile(rb"[^a-z\x80-\xff]")
PIECE = 1 << 20
UNIT = 10**9
SOURCES, TERMS = 256, 3000
FRONTIER = 1 << 17


def terms(text: bytes) -> Counter:
    """How often each term occurs in a text."""
    folded, found, at = text.translate(FOLD.tobytes()), Counter(), 0
    while at < len(folded):
        edge = OTHER.search(folded, at + PIECE)  # a piece ends after a term
        end = edge.start() if edge else len(folded)
        found.update(TERM.findall(folded, at, end))
        at = end
    return found


def term_counts(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", most: int = 400_000) -> DataFrame:
    """lang, source, term, count, docs (texts that have it), with nulls read as ''; rows are dealt by (lang, term).

    A task counts in memory, up to so many different (lang, source, term), before it hands on what it has.
    """
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple, tuple[Counter, Counter]] = {}
        held = 0

        def flushed() -> Iterator[pa.RecordBatch]:
            for (a, b), (many, some) in found.items():
                keys, values = pa.array(many.keys(), pa.binary()).cast(pa.string()), pa.array(many.values(), pa.int64())
                texts = pa.array(map(some.__getitem__, many), pa.int64())
                same = [pa.DictionaryArray.from_arrays(pa.array(np.zeros(len(keys), np.int32)), [v]).cast(pa.string()) for v in (a, b)]
                yield pa.RecordBatch.from_arrays([*same, keys, values, texts], names=["lang", "source", "term", "count", "docs"])
            found.clear()

        for batch in in_pieces(batches):
            data, offsets = column_bytes(batch.column(2))
            for k, key in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
                many, some = found.setdefault(key, (Counter(), Counter()))
                own, before = terms(data[offsets[k] : offsets[k + 1]].tobytes()), len(many)
                many.update(own)
                some.update(own.keys())
                held += len(many) - before
                if held > most:
                    yield from flushed()
                    held = 0
        yield from flushed()

    rows = docs.select(*named(docs, lang, source), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    found = rows.mapInArrow(run, "lang string, source string, term string, count long, docs long")
    dealt = found.repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "lang", "term")
    return dealt.groupBy("lang", "source", "term").agg(F.sum("count").alias("count"), F.sum("docs").alias("docs"))


def named(docs: DataFrame, lang: str, source: str) -> list[Column]:
    return [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"))]


def share(count: np.ndarray, mass: np.ndarray) -> np.ndarray:
    """1 + floor(UNIT * (count + 1) / mass) by long division, so that no product is larger than 1000 * mass; 1 where the mass is 0."""
    rest, out, mass = np.asarray(count) + 1, 0, np.maximum(mass, 1)
    for _ in range(3):
        out, rest = out * 1000 + rest * 1000 // mass, rest * 1000 % mass
    return out + 1


def share_of(count: Column, mass: Column) -> Column:
    """share() of columns: the quotient digit by digit in base 1000."""
    digits, rest = F.lit(0).cast("long"), count + 1
    whole = lambda a, b: F.call_function("div", a, b)
    for _ in range(3):
        digits, rest = digits * 1000 + whole(rest * 1000, mass), rest * 1000 % mass
    return digits + 1


def surplus(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


class Tree:
    """A K-squared tree of a matrix with 2 ** height rows and columns: bits of each level from the top, and the counts of its leaves."""

    def __init__(self, height: int, bits: list[np.ndarray], counts: np.ndarray) -> None:
        self.height, self.bits, self.counts = height, bits, counts
        self.ranks = [np.cumsum(b, dtype=np.int64) - 1 for b in bits]

    @classmethod
    def of(cls, height: int, rows: np.ndarray, cols: np.ndarray, counts: np.ndarray) -> Tree:
        code = np.zeros(len(rows), np.int64)
        for k in range(height):
            code |= ((cols >> k & 1) | (rows >> k & 1) << 1) << 2 * k
        order = np.argsort(code)
        code, bits, above = code[order], [], np.zeros(min(1, len(rows)), np.int64)
        for level in range(1, height + 1):
            here = np.unique(code >> 2 * (height - level))
            b = np.zeros(4 * len(above), bool)
            b[4 * np.searchsorted(above, here >> 2) + (here & 3)] = True
            bits.append(b)
            above = here
        return cls(height, bits, counts[order])

    def rows(self) -> np.ndarray:
        """The row of each leaf, read from the tree down."""
        out = np.zeros(min(1, len(self.counts)), np.int64)
        for b in self.bits:
            at = np.flatnonzero(b)
            out = 2 * out[at >> 2] + (at >> 1 & 1)
        return out

    def packed(self) -> bytes:
        return np.packbits(np.concatenate([*self.bits, np.zeros(0, bool)])).tobytes()

    @classmethod
    def unpacked(cls, height: int, packed: bytes, counts: np.ndarray) -> Tree:
        every, bits, at, nodes = np.unpackbits(np.frombuffer(packed, np.uint8)).astype(bool), [], 0, min(1, len(counts))
        for _ in range(height):
            bits.append(every[at : at + 4 * nodes])
            at += 4 * nodes
            nodes = int(bits[-1].sum())
        return cls(height, bits, counts)

    def below(self, level: int, nodes: np.ndarray, quadrant: int) -> np.ndarray:
        """The children of nodes of a level in one quadrant, -1 for all zero; likewise what is below -1."""
        if not len(self.counts):
            return np.full(len(nodes), -1, np.int64)
        at = 4 * np.maximum(nodes, 0) + quadrant
        return np.where((nodes >= 0) & self.bits[level][at], self.ranks[level][at], -1)


def walked(a: Tree, b: Tree, masses_a: np.ndarray, masses_b: np.ndarray, width: int, same: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """For each row of a and each of b, the surplus of the first over the second, and of the second over the first, summed over the terms of both.

    If b is the same tree as a, only pairs whose first row comes before the second are walked, and only their values are given.
    """
    m, n, height = len(masses_a), len(masses_b), a.height
    sums, empty = np.zeros((2, m * n), np.int64), np.zeros((m + 1) * (n + 1), np.int64)
    shares, zeros = zip(*((share(t.counts, masses[t.rows()]), share(np.zeros(len(masses), np.int64), masses)) for t, masses in ((a, masses_a), (b, masses_b))), strict=True)
    root = [np.array([0 if len(t.counts) else -1]) for t in (a, b)]
    todo = [(0, np.stack([*root, *[np.zeros(1, np.int64)] * 3]))]  # nodes of a and b, their first rows and their first term, counted in sides
    while todo:
        level, f = todo.pop()
        if f.shape[1] > FRONTIER:
            half = f.shape[1] // 2
            todo += [(level, f[:, :half]), (level, f[:, half:])]
            continue
        side = 1 << height - level
        none = (f[0] < 0) & (f[1] < 0)
        if none.any():  # all zero on both sides: the number of terms is all that counts, kept as corners of rectangles
            ra, rb, c = f[2:, none] * side
            span, ra2, rb2 = np.minimum(width, c + side) - c, np.minimum(m, ra + side), np.minimum(n, rb + side)
            for x, y, sign in ((ra, rb, 1), (ra2, rb, -1), (ra, rb2, -1), (ra2, rb2, 1)):
                np.add.at(empty, x * (n + 1) + y, sign * span)
            f = f[:, ~none]
        if not f.shape[1]:
            continue
        if level == height:
            p, q = (np.where(nodes >= 0, known[np.maximum(nodes, 0)], zero[rows]) if len(known) else zero[rows] for known, zero, nodes, rows in zip(shares, zeros, f[:2], f[2:4], strict=True))
            square, at = (p - q) ** 2, f[2] * n + f[3]
            np.add.at(sums[0], at, square // q)
            np.add.at(sums[1], at, square // p)
            continue
        below, half = [], side // 2
        for up, low, right in np.ndindex(2, 2, 2):
            ra, rb, c = 2 * f[2] + up, 2 * f[3] + low, 2 * f[4] + right
            fits = (ra * half < m) & (rb * half < n) & (c * half < width)
            if same:
                fits &= ra < rb if half == 1 else ra <= rb
            nodes = [t.below(level, x[fits], 2 * k + right) for t, x, k in ((a, f[0], up), (b, f[1], low))]
            below.append(np.stack([*nodes, ra[fits], rb[fits], c[fits]]))
        todo.append((level + 1, np.concatenate(below, axis=1)))
    many = empty.reshape(m + 1, n + 1).cumsum(0).cumsum(1)[:m, :n]
    p, q = zeros[0][:, None], zeros[1][None, :]
    return sums[0].reshape(m, n) + many * surplus(p, q), sums[1].reshape(m, n) + many * surplus(q, p)


def _height(sources: int, width: int) -> int:
    return max(0, int(max(sources, width, 1) - 1).bit_length())


def tiles(entries: DataFrame, frame: DataFrame) -> DataFrame:
    """lang, block, part, width, masses, bits, counts: the tiles of entries (lang, block, source, term, count), each a K-squared tree.

    frame (lang, block, source, no, mass) has each source of each block, numbered by language. A block is of so many terms that it stays small
    however many sources there are; its sources are cut into parts.
    """

    def run(table: pa.Table, sources: pa.Table) -> pa.Table:
        sources = sources.sort_by("no")
        masses, parts = sources["mass"].to_numpy(), -(-sources.num_rows // SOURCES)
        number = lambda column: column.combine_chunks().dictionary_encode()
        rows, cols = number(table["source"]), number(table["term"])
        row = np.zeros(0, np.int64)
        if table.num_rows:
            order = {v: k for k, v in enumerate(sources["source"].to_pylist())}
            row = np.array([order[v] for v in rows.dictionary.to_pylist()], np.int64)[rows.indices.to_numpy()]
        col, count, width = cols.indices.to_numpy().astype(np.int64), table["count"].to_numpy(), len(cols.dictionary)
        made = []
        for part in range(parts):
            own = row // SOURCES == part
            tree = Tree.of(_height(SOURCES, width), row[own] % SOURCES, col[own], count[own])
            made.append((masses[part * SOURCES : (part + 1) * SOURCES].astype(np.int64).tobytes(), tree.packed(), tree.counts.astype(np.int64).tobytes()))
        same = {n: pa.array(sources[n].to_pylist()[:1] * parts, t) for n, t in (("lang", pa.string()), ("block", pa.int64()))}
        return pa.table(same | {"part": pa.array(range(parts), pa.int32()), "width": pa.array([width] * parts, pa.int32())} | {k: pa.array(v, pa.binary()) for k, v in zip(("masses", "bits", "counts"), zip(*made, strict=True), strict=True)})

    both = entries.groupBy("lang", "block").cogroup(frame.groupBy("lang", "block"))
    return both.applyInArrow(run, "lang string, block long, part int, width int, masses binary, bits binary, counts binary")


def pair_values(made: DataFrame) -> DataFrame:
    """lang, one, other (numbers of two sources), value: of the tiles of a language, summed over its terms."""
    right = made.select("lang", "block", F.col("part").alias("part2"), *[F.col(c).alias(f"{c}2") for c in ("masses", "bits", "counts")])
    met = made.join(right, ["lang", "block"]).where("part <= part2").select("lang", "part", "part2", "width", "masses", "bits", "counts", "masses2", "bits2", "counts2")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        long = lambda b: np.frombuffer(b, np.int64)
        for batch in in_pieces(batches, 1):
            lang, part, part2, width, *parts = (c[0].as_py() for c in batch.columns)
            masses, other = long(parts[0]), long(parts[3])
            a, b = (Tree.unpacked(_height(SOURCES, width), bits, long(counts)) for _, bits, counts in (parts[:3], parts[3:]))
            there, back = walked(a, b, masses, other, width, part == part2)
            one, two = np.triu_indices(len(masses), 1) if part == part2 else (x.ravel() for x in np.indices(there.shape))
            values = np.concatenate([there[one, two], back[one, two]])
            one, two = one + part * SOURCES, two + part2 * SOURCES
            ends = [pa.array(np.concatenate(x), pa.int64()) for x in ((one, two), (two, one))]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(values), pa.string()), *ends, pa.array(values)], names=["lang", "one", "other", "value"])

    return met.mapInArrow(run, "lang string, one long, other long, value long").groupBy("lang", "one", "other").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", least_docs: int = 3, ranks: int = 200) -> DataFrame:
    """lang, source, part, item, value, rank: how far each source of a language is from each other one (part `pair`), and its marked terms (part `term`).

    Terms are runs of letters and non-ASCII characters, A-Z lower-cased; those in at least so many texts of their language count. A term's
    share p of a source is 1 + floor(UNIT * (count + 1) / (all + terms)), likewise q of another source or of the language; the value is
    (p - q) ** 2 / q, rounded down, over all terms for a pair. Of marked terms (there, and p > q) those of the first so many ranks are given.
    Null texts, languages and sources are read as ''. A language without terms gives pairs of value 0, an empty table no rows. Repeated rows
    count as often as they are there; other columns are not read. A language's sources are numbered in one task, and a term that is everywhere is a
    row for each source by then. The table of kept counts stays in the shared folder, as the result is read from it.
    """
    own = Window.partitionBy("lang", "term")  # a row for each source
    counts = term_counts(docs, lang, source, text).withColumns({"in_lang": F.sum("count").over(own), "_docs": F.sum("docs").over(own)})
    entries, _ = written(counts.where(F.col("_docs") >= least_docs).select("lang", "source", "term", "count", "in_lang"), "term-counts")
    masses = entries.groupBy("lang", "source").agg(F.sum("count").alias("n"))
    groups = docs.select(*named(docs, lang, source)).distinct().join(masses, ["lang", "source"], "left")
    kept = entries.groupBy("lang", "term").agg(F.min("in_lang").alias("in_lang")).groupBy("lang").agg(F.count("*").alias("n_terms"), F.sum("in_lang").alias("n_lang"))
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    groups = groups.join(kept, "lang", "left").fillna(0, ["n", "n_terms", "n_lang"]).withColumns({"no": number.cast("long"), "of": F.count("*").over(Window.partitionBy("lang"))})
    at_once = F.greatest(F.lit(16), F.least(F.lit(TERMS), F.floor(F.lit(1 << 20) / F.col("of"))))  # terms of a block
    blocks = F.greatest(F.lit(1), F.ceil(F.col("n_terms") / at_once)).cast("long")
    groups = cut(groups.select("lang", "source", "no", "n_lang", "n_terms", (F.col("n") + F.col("n_terms")).alias("mass"), blocks.alias("blocks")))

    frame = groups.select("lang", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), "source", "no", "mass")
    dealt = entries.join(small(groups), ["lang", "source"])
    blocked = dealt.select("lang", F.expr("pmod(xxhash64(term), blocks)").alias("block"), "source", "term", "count")
    names = groups.select("lang", F.col("no").alias("one"), "source")
    pairs = pair_values(cut(tiles(blocked, frame))).join(small(names), ["lang", "one"])
    pairs = pairs.join(small(names.withColumnsRenamed({"one": "other", "source": "item"})), ["lang", "other"])
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value")

    p, q = share_of(F.col("count"), F.col("mass")), share_of(F.col("in_lang"), F.col("n_lang") + F.col("n_terms"))
    marked = dealt.select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q")).where("p > q")
    marked = marked.select("lang", "source", F.lit("term").alias("part"), "item", F.expr("((p - q) * (p - q)) div q").alias("value"))
    order = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return pairs.withColumn("rank", order).unionByName(marked.withColumn("rank", order).where(F.col("rank") <= ranks))


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(spark.read.parquet(f"{sf_dir}/documents.parquet"))


#: DuckDB SQL for op12: each pair of sources over each term.
OP12_SQL = r"""
with d as (
  select row_number() over () as no, coalesce(lang, '') as lang, coalesce(source, '') as source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as w from documents),
each as (select no, lang, source, unnest(w) as t from d),
kept as (select lang, t, count(*) as c from each group by all having count(distinct no) >= 3),
langs as (select d.lang, coalesce(any_value(v), 0) as v, coalesce(any_value(n), 0) as n
  from d left join (select lang, count(*) as v, sum(c) as n from kept group by all) using (lang) group by d.lang),
counts as (select lang, source, t, count(*) as c from each join (select lang, t from kept) using (lang, t) group by all),
sources as (select d.lang, d.source, coalesce(any_value(m.n), 0) + any_value(langs.v) as mass
  from d join langs using (lang) left join (select lang, source, sum(c) as n from counts group by all) m on m.lang = d.lang and m.source = d.source group by all),
shares as (select s.lang, s.source, k.t, coalesce(c.c, 0) as c, 1 + 1000000000::hugeint * (coalesce(c.c, 0) + 1) // s.mass as p
  from sources s join kept k using (lang) left join counts c on c.lang = s.lang and c.source = s.source and c.t = k.t),
pairs as (
  select x.lang, x.source, 'pair' as part, y.source as item, coalesce(f, 0) as value
  from sources x join sources y on x.lang = y.lang and x.source <> y.source
  left join (select a.lang, a.source as one, b.source as two, sum((a.p - b.p) * (a.p - b.p) // b.p) as f from shares a join shares b on a.lang = b.lang and a.t = b.t group by all) z
    on z.lang = x.lang and z.one = x.source and z.two = y.source),
marked as (
  select lang, source, 'term' as part, t as item, (p - q) * (p - q) // q as value
  from (select s.*, 1 + 1000000000::hugeint * (k.c + 1) // (langs.n + langs.v) as q from shares s join kept k using (lang, t) join langs using (lang) where s.c > 0) where p > q),
ranked as (select *, row_number() over (partition by lang, source, part order by value desc, item) as rank from (from pairs union all from marked))
select lang, source, part, item, value::bigint as value, rank::integer as rank from ranked where part = 'pair' or rank <= 200
"""
