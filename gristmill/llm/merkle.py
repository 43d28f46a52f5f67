"""Merkle manifest of a table: a tree for each group of rows, one over the groups' roots, and a proof for each row.

A tree's nodes are kept in blocks: aligned subtrees of at most BLOCK leaves. Block roots are the leaves of the next tier of blocks, and so on,
until a tree has one block; the tree over the groups is made of blocks likewise. Within a block, nodes lie in van Emde Boas order: the top half
of its levels first, then each subtree below it, each in the same order. Where a node lies is arithmetic (place), both when a block is built
and when siblings are taken from it. No task ever holds more than a block, however many rows a group has, and what is shuffled is digests.
"""

from __future__ import annotations

import hashlib
import operator
from collections.abc import Iterator, Sequence
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..operators.tables import small
from .session import cut, small_batches
from .text import in_pieces

ARITY, DEPTH = 8, 4
BLOCK = ARITY**DEPTH
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PATH = "g string, at long, root binary, subroot binary, lefts array<string>, rights array<string>"


def digest(text: bytes) -> bytes:
    return hashlib.sha256(text).hexdigest().encode()


def place(levels: int, depth: int, index: np.ndarray) -> np.ndarray:
    """Where the nodes of these indices of a depth lie in a complete tree of so many levels."""
    index, at = np.asarray(index, np.int64), np.zeros(len(index), np.int64)
    while levels > 1:
        top = levels // 2
        if depth < top:
            levels = top
            continue
        below = levels - top  # the levels of each subtree under the top
        span = ARITY ** (depth - top)
        at += (ARITY**top - 1) // (ARITY - 1) + index // span * ((ARITY**below - 1) // (ARITY - 1))
        levels, depth, index = below, depth - top, index % span
    return at


@lru_cache(64)
def _places(levels: int, depth: int) -> np.ndarray:
    return place(levels, depth, np.arange(ARITY**depth))


def counts(leaves: int, rise: int) -> list[int]:
    """How many nodes a tree of so many leaves has on each level, from the leaves up, over so many rises."""
    out = [leaves]
    for _ in range(rise):
        out.append(-(-out[-1] // ARITY))
    return out


def rise_of(nodes: int) -> int:
    """Levels from so many nodes of a tier to the root of their block: DEPTH, or fewer where one block holds them all."""
    rise = 0
    while nodes > 1 and rise < DEPTH:
        nodes, rise = -(-nodes // ARITY), rise + 1
    return rise


def build(leaves: np.ndarray, rise: int) -> np.ndarray:
    """The nodes of a block in van Emde Boas order, up to the last one that is there; leaves: digests of 32 bytes."""
    levels, sizes = rise + 1, counts(len(leaves), rise)
    nodes = np.zeros(((ARITY**levels - 1) // (ARITY - 1), leaves.shape[1]), np.uint8)
    nodes[_places(levels, rise)[: len(leaves)]] = leaves
    for up in range(rise):
        below = nodes[_places(levels, rise - up)[: sizes[up]]].tobytes().hex().encode()
        made = b"".join(digest(below[a : a + 64 * ARITY]) for a in range(0, len(below), 64 * ARITY))
        nodes[_places(levels, rise - up - 1)[: sizes[up + 1]]] = np.frombuffer(bytes.fromhex(made.decode()), np.uint8).reshape(-1, 32)
    last = max(int(_places(levels, rise - up)[size - 1]) for up, size in enumerate(sizes))
    return nodes[: last + 1]


def siblings(nodes: np.ndarray, leaves: int, rise: int, up: int) -> tuple[list[str], list[str]]:
    """Of each node so many levels above a block's leaves: what stands before it and after it in its run, as hex text."""
    size = counts(leaves, up)[-1]
    row = nodes[_places(rise + 1, rise - up)[:size]].tobytes().hex()
    lefts, rights = [], []
    for k in range(size):
        run = k // ARITY * ARITY
        lefts.append(row[64 * run : 64 * k])
        rights.append(row[64 * (k + 1) : 64 * min(run + ARITY, size)])
    return lefts, rights


def paths(nodes: np.ndarray, leaves: int, rise: int, above: tuple[list[str], list[str]]) -> tuple[list[list[str]], list[list[str]]]:
    """Of each leaf of a block what stands before and after its path's nodes, level by level up to the root of the whole; above: the same of the block's root."""
    lefts, rights = [above[0]], [above[1]]
    for up in range(rise - 1, -1, -1):
        left, right = siblings(nodes, leaves, rise, up)
        lefts = [[x, *lefts[k // ARITY]] for k, x in enumerate(left)]
        rights = [[x, *rights[k // ARITY]] for k, x in enumerate(right)]
    return lefts, rights


def _array(column: pa.ChunkedArray | pa.Array, width: int = 32) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, width)


def leaf(fields: Sequence[Column]) -> Column:
    """The digest of a row's fields (32 bytes): each `-` if null, else its length in bytes, a colon and its value."""
    parts = [F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-")) for c in (f.cast("string") for f in fields)]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def ranked(leaves: DataFrame, order: Sequence[str]) -> DataFrame:
    """leaves with rank (from 0 in each g, in this order), block, and n, the number of leaves of g.

    Rows are sorted in ranges of (g, order), so a g may hold most of the rows; what is joined is a row for each g of each range.
    """
    ranged = leaves.repartitionByRange("g", *order).sortWithinPartitions("g", *order)
    ranged = cut(ranged.withColumn("_at", F.monotonically_increasing_id()).withColumn("_range", F.spark_partition_id()))
    parts = ranged.groupBy("g", "_range").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    own = Window.partitionBy("g")
    before = F.coalesce(F.sum("_n").over(own.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = cut(parts.withColumns({"_start": before - F.col("_first"), "n": F.sum("_n").over(own)}).drop("_n", "_first"))
    met = ranged.join(small(parts), ["g", "_range"]).withColumn("rank", F.col("_at") + F.col("_start")).drop("_at", "_range", "_start")
    return met.withColumn("block", F.floor(F.col("rank") / BLOCK))


def _built(nodes: DataFrame) -> DataFrame:
    """Of nodes (g, block, rank, n, digest) the blocks (g, block, n, leaves, nodes): n, of the group; leaves, of the block."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("rank")
        n = table["n"][0].as_py()
        made = build(_array(table["digest"]), rise_of(n))
        return pa.table({"g": table["g"][:1], "block": table["block"][:1], "n": pa.array([n], pa.int64()), "leaves": pa.array([table.num_rows], pa.int64()), "nodes": pa.array([made.tobytes()], pa.binary())})

    narrow = nodes.select("g", "block", "rank", F.col("n").cast("long").alias("n"), "digest")
    return narrow.groupBy("g", "block").applyInArrow(run, "g string, block long, n long, leaves long, nodes binary")


def _root(blocks: DataFrame) -> DataFrame:
    return blocks.select("*", F.substring("nodes", 1, 32).alias("digest"))


def grown(leaves: DataFrame) -> list[DataFrame]:
    """The tiers of blocks of ranked leaves (g, block, rank, n, digest), the lowest first."""
    tiers = [cut(_built(leaves))]
    while tiers[-1].where(F.col("n") > BLOCK).limit(1).count():
        roots = _root(tiers[-1].where(F.col("n") > BLOCK)).withColumnRenamed("block", "rank")
        upper = roots.select("g", "rank", F.ceil(F.col("n") / BLOCK).alias("n"), "digest", F.floor(F.col("rank") / BLOCK).alias("block"))
        tiers.append(cut(_built(upper)))
    return tiers


def roots(tiers: Sequence[DataFrame]) -> DataFrame:
    """g and the digest of its root."""
    return reduce(DataFrame.unionByName, [_root(t.where(F.col("n") <= BLOCK)).select("g", "digest") for t in tiers])


def _descended(blocks: DataFrame) -> DataFrame:
    """Of blocks with the path of their roots: the path of each leaf, whose rank is at."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_pieces(batches, 1):
            row = {n: batch.column(n)[0].as_py() for n in batch.schema.names}
            nodes = np.frombuffer(row["nodes"], np.uint8).reshape(-1, 32)
            lefts, rights = paths(nodes, row["leaves"], rise_of(row["n"]), (row["lefts"], row["rights"]))
            for a in range(0, row["leaves"], 512):
                part = slice(a, min(a + 512, row["leaves"]))
                m = part.stop - a
                at = pa.array(np.arange(a, part.stop) + row["block"] * BLOCK, pa.int64())
                same = [pa.array([row[n]] * m, t) for n, t in (("g", pa.string()), ("root", pa.binary()), ("subroot", pa.binary()))]
                texts = [pa.array(x[part], pa.list_(pa.string())) for x in (lefts, rights)]
                yield pa.RecordBatch.from_arrays([same[0], at, *same[1:], *texts], names=["g", "at", "root", "subroot", "lefts", "rights"])

    return blocks.select("g", "block", "n", "leaves", "nodes", "root", "subroot", "lefts", "rights").mapInArrow(run, PATH)


def _with_paths(tiers: Sequence[DataFrame], above: DataFrame) -> DataFrame:
    """The lowest tier's blocks with the paths of their roots; above (g, root, subroot, lefts, rights): the path of each group's root."""
    down = None
    for tier in reversed(tiers):
        met = tier.where(F.col("n") <= BLOCK).join(above, "g")
        if down is not None:
            met = met.unionByName(tier.where(F.col("n") > BLOCK).join(down.withColumnRenamed("at", "block"), ["g", "block"]))
        down = _descended(met)
    return met


def manifest(leaves: DataFrame, order: Sequence[str]) -> tuple[DataFrame, list[DataFrame], DataFrame]:
    """Of leaves (g, digest, order): the ranked leaves, the tiers of blocks of all groups, and above, the path of each group's root to the root of all.

    g is text that sorts as groups shall; groups may be many, their tree is made of blocks too.
    """
    base = ranked(leaves, order)
    tiers = grown(base)
    groups = cut(ranked(roots(tiers).select(F.lit("").alias("g"), F.col("g").alias("name"), "digest"), ["name"]))
    upper = grown(groups)
    whole = roots(upper).select("g", F.col("digest").alias("root"), F.lit(b"").alias("subroot"), F.array().cast("array<string>").alias("lefts"), F.array().cast("array<string>").alias("rights"))
    found = _descended(_with_paths(upper, whole)).select("at", "root", "lefts", "rights")
    above = groups.join(found, groups.rank == found["at"]).select(F.col("name").alias("g"), "root", F.col("digest").alias("subroot"), "lefts", "rights")
    return base, tiers, cut(above)


def fold(leaf: bytes, lefts: Sequence[str], rights: Sequence[str]) -> bytes:
    """The root (hex text) that a leaf (hex text) leads to beside these siblings; a level whose run has one node is hashed all the same."""
    for left, right in zip(lefts, rights, strict=True):
        leaf = digest(left.encode() + leaf + right.encode())
    return leaf


def proofs(leaves: DataFrame, order: Sequence[str], id: str) -> DataFrame:
    """Of leaves (g, id, digest, tampered, order): id, leaf, subroot, root, proof_sha256, folded_root and verified, all digests in lowercase hex.

    tampered is the digest that is folded instead of the leaf's own, or null. The proof of a row is the siblings of its path from its leaf to
    the root of all; the row's digest of it is the hash of their hex texts, of no text where there are none.
    """
    small_batches(leaves.sparkSession)
    base, tiers, above = manifest(leaves, order)
    kind = leaves.schema[id].dataType.simpleString()

    def run(own: pa.Table, blocks: pa.Table) -> pa.Table:
        own = own.sort_by("rank")
        row = {n: blocks[n][0].as_py() for n in blocks.schema.names}
        nodes, rise = np.frombuffer(row["nodes"], np.uint8).reshape(-1, 32), rise_of(row["n"])
        lefts, rights = paths(nodes, row["leaves"], rise, (row["lefts"], row["rights"]))
        found, tampered = own["digest"].to_pylist(), own["tampered"].to_pylist()
        tops = [fold((t or d).hex().encode(), a, b).decode() for d, t, a, b in zip(found, tampered, lefts, rights, strict=True)]
        taken = [hashlib.sha256("".join(map(operator.add, a, b)).encode()).hexdigest() for a, b in zip(lefts, rights, strict=True)]
        root, m = row["root"].hex(), len(found)
        made = {"leaf": [d.hex() for d in found], "subroot": [row["subroot"].hex()] * m, "root": [root] * m, "proof_sha256": taken, "folded_root": tops}
        return pa.table({id: own[id], **{k: pa.array(v, pa.string()) for k, v in made.items()}, "verified": pa.array([t == root for t in tops], pa.bool_())})

    texts = ", ".join(f"{n} string" for n in ("leaf", "subroot", "root", "proof_sha256", "folded_root"))
    rows = base.select("g", "block", "rank", id, "digest", "tampered").groupBy("g", "block")
    return rows.cogroup(_with_paths(tiers, above).groupBy("g", "block")).applyInArrow(run, f"{id} {kind}, {texts}, verified boolean")


def leaves_of(docs: DataFrame, fields: Sequence[str] = FIELDS, id: str = "doc_id", group: str = "lang", changed: tuple[Column, dict[str, Column]] | None = None) -> DataFrame:
    """g, id, digest and tampered of each row, for proofs(); changed: which rows are tampered with, and the columns that are put in there.

    A null group is one of its own and comes first, then groups follow in the order of their bytes. Rows of a null id are a group's last.
    """
    other = changed[1] if changed else {}
    tampered = F.when(changed[0], leaf([other.get(c, F.col(c)) for c in fields])) if changed else F.lit(None).cast("binary")
    g = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    return docs.select(g.alias("g"), F.col(id), leaf([F.col(c) for c in fields]).alias("digest"), tampered.alias("tampered"))


def proven(docs: DataFrame, fields: Sequence[str] = FIELDS, id: str = "doc_id", group: str = "lang", changed: tuple[Column, dict[str, Column]] | None = None) -> DataFrame:
    """A proof of each row of docs, folded from what changed makes of it, see proofs() and leaves_of().

    Rows with the same id follow each other in the order of their digests; equal rows are told apart by the order in which they are stored, so
    that a row that is there very often is spread over ranges. Other columns are not read. Empty tables give no rows.
    """
    rows = leaves_of(docs, fields, id, group, changed)
    order = {"_null": F.col(id).isNull(), "_id": F.col(id), "_digest": F.col("digest"), "_no": F.monotonically_increasing_id()}
    return proofs(cut(rows.withColumns(order)), list(order), id)


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    third = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.lit(False))
    return proven(docs, changed=(third, {"text": F.translate("text", UPPER, LOWER)}))


def _field(column: str) -> str:
    return f"coalesce(strlen({column}) || ':' || {column}, '-')"


def _levels(source: str, name: str) -> str:
    """Nodes (tree, l, i, h, n) of all levels above source (tree, i, h, n), and what stands beside each in its run."""
    return f"""{name} as (
  select tree, 0 as l, i, h, n from {source}
  union all
  select tree, l + 1, i // 8, sha256(string_agg(h, '' order by i)), (n + 7) // 8 from {name} where n > 1 group by tree, l, i // 8, n),
{name}_beside as (
  select tree, l, i, coalesce(string_agg(h, '') over (w rows between unbounded preceding and 1 preceding), '') as a,
    coalesce(string_agg(h, '') over (w rows between 1 following and unbounded following), '') as b
  from {name} where n > 1 window w as (partition by tree, l, i // 8 order by i))"""


#: DuckDB SQL for op11; crc32 bit by bit.
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295::bigint, flatten(list_transform(range(1, strlen(d) + 1),
  lambda k: [ascii(substr(d, k, 1))::bigint, -1, -1, -1, -1, -1, -1, -1, -1]))),
  lambda c, x: case when x >= 0 then xor(c, x) else xor(c >> 1, 3988292384 * (c & 1)) end))"""
_ROW = lambda text: "sha256(" + " || ".join([*(_field(c) for c in ("d", "source", "lang", "n")), _field(text)]) + ")"
OP11_SQL = f"""
with recursive rows_ as (select doc_id, doc_id::varchar as d, source, lang, n_chars::varchar as n, text, translate(text, '{UPPER}', '{LOWER}') as low from documents),
hashed as (select doc_id, coalesce('=' || lang, '') as tree, {_ROW("text")} as h, case when {_CRC} % 3 = 0 then {_ROW("low")} end as other from rows_),
leaves as (select *, row_number() over (partition by tree order by doc_id, h) - 1 as i, count(*) over (partition by tree) as n from hashed),
{_levels("leaves", "nodes")},
groups as (select '' as tree, tree as name, h, row_number() over (order by tree) - 1 as i, count(*) over () as n from nodes where n = 1),
{_levels("groups", "tops")},
steps as (
  select doc_id, leaves.i as no, l, a, b from leaves join nodes_beside x on leaves.tree = x.tree and x.i = leaves.i // (8 ** l)::bigint
  union all
  select doc_id, leaves.i, 100 + l, a, b from leaves join groups on leaves.tree = groups.name join tops_beside x on x.i = groups.i // (8 ** l)::bigint),
ordered as (select *, row_number() over (partition by doc_id, no order by l) as k from steps),
proof as (select doc_id, no, sha256(string_agg(a || b, '' order by k)) as p from ordered group by all),
folded as (
  select doc_id, i as no, 0 as k, coalesce(other, h) as f from leaves
  union all
  select f.doc_id, f.no, f.k + 1, sha256(a || f.f || b) from folded f join ordered o on f.doc_id = o.doc_id and f.no = o.no and o.k = f.k + 1),
last as (select doc_id, no, max_by(f, k) as f from folded group by all)
select leaves.doc_id, leaves.h as leaf, groups.h as subroot, top.h as root, coalesce(p, sha256('')) as proof_sha256, f as folded_root, f = top.h as verified
from leaves join groups on leaves.tree = groups.name join (select h from tops where n = 1) top on true
join last on last.doc_id = leaves.doc_id and last.no = leaves.i left join proof on proof.doc_id = leaves.doc_id and proof.no = leaves.i
"""
