"""Near copies by SimHash and anchor-point covering: fingerprints of five-word shingles propose pairs, an exact comparison of the shingle sets decides.

A link is a similarity (shared shingles over all shingles of both) of 0.8 or more. Two sets of that similarity differ in 15 % of the bits of
a SimHash fingerprint, far more than op9's three of 64, so fingerprints are wider (1024 bits) and the blocks that anchors cover are shorter
and more: BLOCKS blocks of 23 bits. In a block the anchors are the words of the Hamming code of length 15, each with all values of the
other 8 bits: the code is perfect, so with a threshold of 0 every block lies within the covering radius plus threshold (1 + 0) of exactly
one anchor. Fingerprints that agree in a block, or that differ from it on the same side, meet there. A pair of similarity 0.8 meets at one
anchor at least with probability 0.9947, one of 0.85 with 0.9998, one of 0.9 always but for 1e-7; whole fingerprints that differ in
at most 43 bits always do, because 44 blocks are disjoint.

Per anchor, members are compared by 96 further bits. What is near there hangs together in clusters, of which each task passes on a spanning
forest of its nearest pairs only, and the forests of tasks are thinned once more. Of these the clearly near ones are compared exactly, first the nearest of each set, then those that are not
connected by then. What a cluster still holds apart is compared exactly with the rest of its cluster, in blocks of shingle sets that meet in
tasks; no pair of a cluster is left out, and none becomes a row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .components import components
from .session import cut, key_of, small_batches
from .text import FOLD, column_bytes, in_pieces, mix

U = np.uint64
SHINGLE, SIMILARITY = 5, 0.8
WORDS, BLOCKS, CODED, PLAIN = 16, 128, 15, 8
#: How many of 96 bits may differ: 14.5 on the average at a similarity of 0.8, and 3.5 standard deviations more; and of what is clearly near.
NEAR, CLEAR = 27, 16
#: Members of an anchor that are compared each with each at once; sets of a block and of a part of a cluster that meet in a task.
EACH, BLOCK, PART = 256, 256, 1024
#: Edges of forests of many tasks that are thinned to a forest together, about.
EDGES = 2_000_000
_FOLD = FOLD.tobytes()
_RNG = np.random.default_rng(42)
_SEEDS = _RNG.integers(0, 2**63, (WORDS, 1), dtype=U)
# The first 44 blocks are disjoint, and so are the next 44 and the rest: each takes 23 bits of a shuffled list of all 1024.
_BITS = np.concatenate([_RNG.permutation(64 * WORDS)[: 44 * (CODED + PLAIN)] for _ in range(3)])[: BLOCKS * (CODED + PLAIN)]
_LANES = U(0x0101010101010101)
_POWERS = 1 << np.arange(CODED + PLAIN)


def _homes() -> np.ndarray:
    """Of each of 2 ** 15 values, the word of the Hamming code within distance 1."""
    value, syndrome = np.arange(1 << CODED), np.zeros(1 << CODED, np.int64)
    for bit in range(CODED):
        syndrome ^= np.where(value >> bit & 1, bit + 1, 0)
    return value ^ np.where(syndrome > 0, 1 << np.maximum(syndrome - 1, 0), 0)


_HOME = _homes()


def shingles(text: bytes, size: int = SHINGLE) -> np.ndarray:
    """The set of a text's shingles as sorted hashes: lower-cases A-Z, splits at ASCII white space; a shorter text is one shingle, one without words has none."""
    parts = text.translate(_FOLD).split()
    if not parts:
        return np.zeros(0, U)
    joined, digest = b" ".join(parts), xxhash.xxh64_intdigest
    if len(parts) <= size:
        return np.array([digest(joined, 42)], U)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1)
    starts = np.concatenate([[0], ends[:-1]])[: len(parts) - size + 1].tolist()
    return np.unique(np.fromiter((digest(joined[a:b], 42) for a, b in zip(starts, (ends[size - 1 :] - 1).tolist(), strict=True)), U, len(starts)))


def fingerprint(found: np.ndarray) -> np.ndarray:
    """The wide fingerprint of a set of hashes: WORDS words of 64 bits, each the majority over the set mixed with the word's seed."""
    counts = np.zeros((WORDS, 8, 8), np.int64)  # words, bytes, bits
    for a in range(0, len(found), 255 * 256):
        part = mix(found[None, a : a + 255 * 256] ^ _SEEDS)
        blocks = -(-part.shape[1] // 255)  # a byte of a word counts one bit of up to 255 hashes at once
        part = np.pad(part, ((0, 0), (0, blocks * 255 - part.shape[1]))).reshape(WORDS, blocks, 255)
        for bit in range(8):
            counts[:, :, bit] += ((part >> U(bit)) & _LANES).sum(axis=2).view(np.uint8).reshape(WORDS, blocks, 8).sum(axis=1, dtype=np.int64)
    return np.packbits(2 * counts > len(found), axis=2, bitorder="little").ravel().view(U)


def anchors(prints: np.ndarray) -> np.ndarray:
    """Rows, BLOCKS: each block's number and its anchor (the plain bits and the home of the coded ones) in one number below 2 ** 30."""
    bits = np.unpackbits(prints.view(np.uint8), axis=1, bitorder="little")
    value = bits[:, _BITS].reshape(len(prints), BLOCKS, -1) @ _POWERS
    return np.arange(BLOCKS) << (CODED + PLAIN) | value >> CODED << CODED | _HOME[value & ((1 << CODED) - 1)]


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / max(1, len(a) + len(b) - both)


def _sets(docs: DataFrame, text: str, keep: tuple[str, ...], more: str = "") -> DataFrame:
    """The kept columns, fp long (a digest of the text's set), and with more the set's wide fingerprint (wide) or the set itself (set), binary; null for a text without words."""
    small_batches(docs.sparkSession)
    narrow = docs.select(*keep, F.col(text).cast("binary").alias("_text"))
    schema = narrow.drop("_text").withColumn("fp", F.lit(0).cast("long"))
    schema = (schema.withColumn(more, F.lit(None).cast("binary")) if more else schema).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_pieces(batches):
            data, offsets = column_bytes(batch.column(batch.num_columns - 1))
            whole = data.tobytes()
            fps, extra = np.zeros(batch.num_rows, np.int64), []
            for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
                found = shingles(whole[a:b])
                fps[i] = np.array(xxhash.xxh64_intdigest(found.tobytes(), 42), U).view(np.int64)
                if more:
                    extra.append(None if not len(found) else fingerprint(found).tobytes() if more == "wide" else found.tobytes())
            columns = [*batch.columns[:-1], pa.array(fps)]
            columns += [pa.array(extra, pa.binary())] if more else []
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:-1], "fp", *([more] if more else [])])

    return narrow.mapInArrow(run, schema)


def _replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (fp, wide): fp, at (the anchor, and below it 32 bits of the fingerprint) and more (64 bits of it)."""
    for part in in_pieces(batches):
        prints = np.frombuffer(b"".join(part.column(1).to_pylist()), U).reshape(-1, WORDS)
        rows = pa.array(np.repeat(np.arange(len(prints)), BLOCKS))
        at = anchors(prints) << 32 | (prints[:, -1:] >> U(32)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([part.column(0).take(rows), pa.array(at.ravel()), pa.array(np.repeat(prints[:, 0].view(np.int64), BLOCKS))], names=["fp", "at", "more"])


def forest(i: np.ndarray, j: np.ndarray, d: np.ndarray, nodes: int) -> np.ndarray:
    """The places of edges (i, j) of a spanning forest, nearest first: in rounds, each tree takes its nearest edge to another."""
    order = np.argsort(d, kind="stable")
    tree, taken = np.arange(nodes), [order[:0]]
    while len(order := order[tree[i[order]] != tree[j[order]]]):
        ends = np.concatenate([tree[i[order]], tree[j[order]]])
        place = np.tile(np.arange(len(order)), 2)
        first = np.full(nodes, len(order))
        np.minimum.at(first, ends, place)
        new = order[np.unique(first[first < len(order)])]
        taken.append(new)
        while True:  # trees that an edge joins take the least name
            a, b = tree[i[new]], tree[j[new]]
            if (a == b).all():
                break
            low = np.arange(nodes)
            np.minimum.at(low, np.maximum(a, b), np.minimum(a, b))
            tree = low[low[tree]]
    return np.concatenate(taken)


def _near_pairs(key: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of members sorted by anchor: near pairs (places, distances), at anchors of very many members enough to hold together what is near."""
    begin = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    size = np.diff(np.append(begin, len(key)))
    apart = lambda i, j: np.bitwise_count(bits[i] ^ bits[j]).sum(axis=-1, dtype=np.int64)
    few, found = np.repeat(size <= EACH, size), [(begin[:0],) * 3]
    for gap in range(1, int(size[size <= EACH].max(initial=1))):
        i = np.flatnonzero(few[:-gap] & (key[:-gap] == key[gap:]))
        d = apart(i, i + gap)
        found.append((i[d <= NEAR], i[d <= NEAR] + gap, d[d <= NEAR]))
    for g in np.flatnonzero(size > EACH).tolist():
        left, reached = np.arange(begin[g], begin[g] + size[g]), []
        while len(left):  # from each member that is reached to all that aren't yet
            if not reached:
                reached, left = [left[0]], left[1:]
            one = reached.pop()
            d = np.concatenate([apart(np.array([one]), left[a : a + 65536]) for a in range(0, len(left), 65536)] or [left])
            found.append((np.full((d <= NEAR).sum(), one), left[d <= NEAR], d[d <= NEAR]))
            reached += left[d <= NEAR].tolist()
            left = left[d > NEAR]
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members (fp, at, more) come sorted by anchor; what is left of the last anchor is carried over. Yields a, b, d: a spanning forest of near pairs for each run of anchors."""

    def done(fp: np.ndarray, at: np.ndarray, more: np.ndarray) -> pa.RecordBatch:
        i, j, d = _near_pairs(at >> 32, np.stack([(at & 0xFFFFFFFF).view(U), more.view(U)], axis=1))
        names, node = np.unique(fp, return_inverse=True)
        keep = forest(node[i], node[j], d, len(names))
        a, b = fp[i[keep]], fp[j[keep]]
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), pa.array(d[keep])], names=["a", "b", "d"])

    rest: list[list[np.ndarray]] = []
    for batch in batches:
        if batch.num_rows:
            rest.append([x.to_numpy(zero_copy_only=False) for x in batch.columns])
        if rest and rest[-1][1][-1] >> 32 != rest[0][1][0] >> 32 and sum(len(x[0]) for x in rest) >= 1 << 18:
            whole = [np.concatenate(x) for x in zip(*rest, strict=True)]
            last = int(np.searchsorted(whole[1], whole[1][-1] >> 32 << 32))
            yield done(*(x[:last] for x in whole))
            rest = [[x[last:] for x in whole]]
    if rest:
        yield done(*(np.concatenate(x) for x in zip(*rest, strict=True)))


def _thinned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A spanning forest of all edges (a, b, d) of a task, nearest first."""
    whole = [b for b in batches if b.num_rows]
    if whole:
        a, b, d = (np.concatenate([x.column(k).to_numpy(zero_copy_only=False) for x in whole]) for k in range(3))
        names, node = np.unique(np.concatenate([a, b]), return_inverse=True)
        keep = forest(node[: len(a)], node[len(a) :], d, len(names))
        yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (a, b, d)], names=["a", "b", "d"])


def _links_of(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Of the askers and members of a group (node, c, asks, set): links between components (c) that have sets alike, enough to hold together all that are linked."""
    node, c, asks = (rows.column(k).to_numpy() for k in ("node", "c", "asks"))
    sets = [np.frombuffer(x, U) for x in rows.column("set").to_pylist()]
    others, found = np.flatnonzero(~asks), []
    if not len(others) or not asks.any():
        return node[:0], node[:0]
    size = np.array([len(sets[k]) for k in others])
    every, starts = np.concatenate([sets[k] for k in others]), np.cumsum(size) - size
    for k in np.flatnonzero(asks).tolist():
        own = sets[k]
        both = np.add.reduceat(own[np.minimum(np.searchsorted(own, every), len(own) - 1)] == every, starts, dtype=np.int64)
        hit = others[(both >= SIMILARITY * (len(own) + size - both)) & (c[others] != c[k])]
        _, one = np.unique(c[hit], return_index=True)
        found.append((np.full(len(one), k), hit[one]))
    a, b = (np.concatenate(x) for x in zip(*found, strict=True))
    names, at = np.unique(np.concatenate([c[a], c[b]]), return_inverse=True)
    keep = forest(at[: len(a)], at[len(a) :], np.zeros(len(a)), len(names))  # as many links as hold the components together
    return node[a[keep]], node[b[keep]]


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (group, node, c, asks, set) come sorted by group; what is left of the last group is carried over."""
    rest: pa.Table | None = None

    def done(rows: pa.Table) -> pa.RecordBatch:
        group = rows.column("group").to_numpy()
        edge = np.append(np.flatnonzero(np.append(True, group[1:] != group[:-1])), len(group))
        links = [_links_of(rows.slice(a, b - a)) for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*links, strict=True)], names=["a", "b"])

    for batch in batches:
        if batch.num_rows:
            rest = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
            group = rest.column("group").to_numpy()
            last = int(np.searchsorted(group, group[-1]))
            if last:
                yield done(rest.slice(0, last))
                rest = rest.slice(last)
    if rest is not None:
        yield done(rest)


def _alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in in_pieces(batches):
        left, right = (batch.column(k).to_pylist() for k in (2, 3))
        near = np.fromiter((similarity(np.frombuffer(x, U), np.frombuffer(y, U)) >= SIMILARITY for x, y in zip(left, right, strict=True)), bool, batch.num_rows)
        yield batch.select(["a", "b"]).filter(pa.array(near))


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    one, other = (sets.select(F.col("fp").alias(c), F.col("set").alias(f"s{c}")) for c in "ab")
    return cut(pairs.join(one, "a").join(other, "b").select("a", "b", "sa", "sb").mapInArrow(_alike, "a long, b long"))


def linked(rows: DataFrame, docs: DataFrame, id: str, text: str) -> DataFrame:
    """Of rows (_id, fp, wide) of docs, the components (node, component) of links between different sets of similarity 0.8 or more; every candidate that could connect two is compared."""
    prints = rows.where("wide is not null").groupBy("fp").agg(F.min("_id").alias("_id"), F.first("wide").alias("wide"))
    spread = prints.select("fp", "wide").mapInArrow(_replicate, "fp long, at long, more long")
    met = cut(spread.repartition(F.shiftright("at", 32)).sortWithinPartitions("at").mapInArrow(_compare, "a long, b long, d long").groupBy("a", "b").agg(F.min("d").alias("d")))
    met = cut(met.coalesce(met.count() // EDGES + 1).mapInArrow(_thinned, "a long, b long, d long"))  # as few tasks as can hold the edges, each leaves a forest
    clusters = components(met)
    sets = _sets_of(clusters.select(F.col("node").alias("fp")), prints, docs, id, text)
    clear = met.where(F.col("d") <= CLEAR)
    ends = clear.select("a", "b", "d", F.explode(F.array("a", "b")).alias("fp")).groupBy("fp").agg(F.min(F.struct("d", "a", "b")).alias("x"))
    lead = ends.select("x.a", "x.b").distinct()
    nodes = cut(components(_verified(lead, sets)))
    one, other = (nodes.select(F.col("node").alias(c), F.col("component").alias(f"c{c}")) for c in "ab")
    rest = clear.join(lead, ["a", "b"], "left_anti").join(one, "a", "left").join(other, "b", "left").where(F.coalesce("ca", "a") != F.coalesce("cb", "b"))
    nodes = _joined(nodes, _verified(rest.select("a", "b"), sets))
    return _joined(nodes, cut(_met_in_blocks(clusters.withColumnRenamed("component", "cluster"), nodes, sets)))


def _joined(nodes: DataFrame, links: DataFrame) -> DataFrame:
    return nodes if links.isEmpty() else cut(components(nodes.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(links)))


def _met_in_blocks(clusters: DataFrame, nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between sets of one cluster (node, cluster) that are in different components: all but the largest component of a cluster ask, in blocks, and meet all members, in parts."""
    named = cut(clusters.join(nodes, "node", "left").select("node", "cluster", F.coalesce("component", "node").alias("c")))
    counts = named.groupBy("cluster", "c").agg(F.count("*").alias("n")).groupBy("cluster").agg(F.sum("n").alias("n"), F.max(F.struct("n", "c")).alias("most")).where("n > most.n")
    parted = counts.select("cluster", F.col("most.c").alias("big"), F.floor((F.col("n") - F.col("most.n") - 1) / BLOCK).alias("blocks"), F.floor((F.col("n") - 1) / PART).alias("parts"))
    members = named.join(parted, "cluster").join(sets.withColumnRenamed("fp", "node"), "node")
    place = lambda n, seed: F.pmod(F.xxhash64("node", F.lit(seed)), F.col(n) + 1)
    spread = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n)))
    asking = members.where("c != big").withColumns({"block": place("blocks", 1), "asks": F.lit(True)}).withColumn("part", spread("parts"))
    met = members.withColumns({"part": place("parts", 2), "asks": F.lit(False)}).withColumn("block", spread("blocks"))
    every = asking.unionByName(met).select(F.xxhash64("cluster", "block", "part").alias("group"), "node", "c", "asks", "set")
    return every.repartition("group").sortWithinPartitions("group").mapInArrow(_meet, "a long, b long").distinct()


def _sets_of(nodes: DataFrame, prints: DataFrame, docs: DataFrame, id: str, text: str) -> DataFrame:
    """The shingle sets (fp, set) of nodes (fp)."""
    firsts = prints.join(nodes, "fp", "left_semi").select("_id").distinct()
    texts = docs.select(key_of(id).alias("_id"), F.col(text).alias("_t")).join(firsts, "_id", "left_semi")
    return cut(_sets(texts, "_t", (), "set").join(nodes, "fp", "left_semi").dropDuplicates(["fp"]))


def one_of_each(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs that stay, with all their columns: of texts connected by links, that with the smallest id (a null id counts as the largest).

    Texts without words are copies of each other. Of rows that share that id, those with the smallest digest are looked at, and of these one stays.
    """
    rows = cut(_sets(docs.select(key_of(id).alias("_id"), F.col(text).alias("_t")), "_t", ("_id",), "wide"))
    nodes = linked(rows, docs, id, text)
    prints = rows.groupBy("fp").agg(F.min("_id").alias("low"))
    named = cut(prints.join(nodes, prints.fp == nodes.node, "left").select("fp", "low", F.coalesce("component", "fp").alias("c")))
    lows = named.groupBy("c").agg(F.min("low").alias("low"))
    group = named.select("fp", "c").join(lows, "c")
    staying = cut(rows.select("_id", "fp").join(group, "fp").where("_id = low").groupBy("c", "_id").agg(F.min("fp").alias("_fp")))
    if staying.groupBy("_id").count().where("count > 1").isEmpty() and rows.select("_id").join(staying.select("_id"), "_id").groupBy("_id").count().where("count > 1").isEmpty():
        return docs.join(staying.select(F.col("_id").alias("_stays")), key_of(id) == F.col("_stays"), "left_semi")
    columns = [f"d{k}" for k in range(len(docs.columns))]
    named = docs.select(*[F.col(c).alias(d) for c, d in zip(docs.columns, columns, strict=True)], key_of(id).alias("_key"), F.col(text).alias("_text"))
    printed = _sets(named, "_text", (*columns, "_key"))
    kept = printed.join(staying, (printed._key == staying._id) & (printed.fp == staying._fp), "left_semi").dropDuplicates(["_key", "fp"])
    return kept.select(*[F.col(d).alias(c) for c, d in zip(docs.columns, columns, strict=True)])
