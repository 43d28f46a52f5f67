"""Documents packed into as few sequences of a fixed length as can be found, by a grouping genetic algorithm on islands.

Documents become token pieces; only what is longer than a sequence is cut. Pieces are dealt to blocks of a bounded number, and each block is
packed by several islands, tasks of their own. A packing is a grouping of pieces: a crossover injects well-filled sequences of one parent whole
into the other, takes out the sequences that hold the same pieces, and best-fits what that displaces. After each epoch an island's elite
migrates to the next one. The worst-filled sequences of all blocks are dissolved and dealt to fewer blocks, until there is one, so that no more
than its last sequences are left partly empty. Of a piece, only an id and a length is moved until it has its place.
"""

from __future__ import annotations

import os
import re
import zlib
from collections import defaultdict
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .session import cut, small_batches
from .text import in_pieces

TOKENIZER = "word_bpe_49k.json"
LENGTH, END = 4096, 1
MEMBERS = 4096
#: White space that the tokenizer drops whatever stands around it; no merge and no normalisation reaches across it.
WORD, SPACE = re.compile("[^\t\n\x0b\x0c\r ]+"), re.compile("[\t\n\x0b\x0c\r ]")
#: Words of ASCII (no apostrophes) and Latin-1 letters, which normalisation only lower-cases, and the parts that the tokenizer cuts these into.
PLAIN = re.compile("[!-&(-~À-ÖØ-öø-ÿ]+")
PARTS = re.compile("[a-zß-öø-ÿ]+|[0-9]|[^0-9a-zß-öø-ÿ]+")
#: What str.split() takes for white space and the tokenizer doesn't.
SEPARATOR = re.compile("[\x1c-\x1f]")
PIECE = 1 << 20
#: Longer words are not kept.
LONGEST = 64


class Ids:
    """Token ids of texts as little-endian unsigned 32-bit numbers, word by word. Ids of short words and of their parts are kept, up to so many of each."""

    def __init__(self, path: str, words: int = 600_000, parts: int = 900_000) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.most, self.words, self.parts = Tokenizer.from_file(path), (words, parts), {}, {}
        vocabulary = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values(), default=0) + 1, bool)  # tokens that end a part
        self.last[[k for t, k in vocabulary.items() if t.endswith("</w>")]] = True

    @classmethod
    @lru_cache(2)
    def of(cls, path: str) -> Ids:
        """One for all tasks of a worker, so that what it knows serves the next task too."""
        return cls(path)

    def _encoded(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encoded_parts(self, parts: list[str]) -> list[bytes]:
        """As _encoded, but as one text, which is cut after each token that ends a part."""
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(parts)], add_special_tokens=False)[0].ids, "<u4")
        ends = (4 * (np.flatnonzero(self.last[ids]) + 1)).tolist()
        if len(ends) != len(parts):  # a vocabulary without such tokens
            return self._encoded(parts)
        whole = ids.tobytes()
        return [whole[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]

    def _learn(self, words: Iterable[str]) -> None:
        """Keeps the ids of words; of plain ones by their parts, and of these only what is new goes to the tokenizer."""
        if len(self.parts) > self.most[1]:
            self.parts = {}
        found, known, late, odd = self.words, self.parts, [], []
        plain, cut_parts = PLAIN.fullmatch, PARTS.findall
        for w in words:
            if plain(w) and "<|" not in w:
                parts = cut_parts(w.lower())
                try:
                    found[w] = known[parts[0]] if len(parts) == 1 else b"".join([known[p] for p in parts])
                except KeyError:
                    late.append((w, parts))
            else:
                odd.append(w)
        if late:
            fresh = list({p for _, parts in late for p in parts}.difference(known))
            known.update(zip(fresh, self._encoded_parts(fresh), strict=True))
            found.update((w, b"".join([known[p] for p in parts])) for w, parts in late)
        if odd:
            found.update(zip(odd, self._encoded(odd), strict=True))

    def chunks(self, text: str) -> Iterator[bytes]:
        """The ids of a text, in chunks of about a million characters."""
        at = 0
        while at < len(text):
            edge = SPACE.search(text, at + PIECE) if len(text) - at > PIECE else None  # a chunk ends after a word
            end = edge.start() if edge else len(text)
            words = WORD.findall(text, at, end) if edge or at or SEPARATOR.search(text) else text.split()
            if len(self.words) > self.most[0]:
                self.words = {}
            different = set(words)
            self._learn(different.difference(self.words))
            yield b"".join(map(self.words.__getitem__, words))
            at = end
            if max(map(len, different), default=0) > LONGEST:
                self._forget(different)

    def _forget(self, words: Iterable[str]) -> None:
        for w in words:
            if len(w) > LONGEST:
                self.words.pop(w, None)
                for p in PARTS.findall(w.lower()):
                    if len(p) > LONGEST:
                        self.parts.pop(p, None)


def cut_up(chunks: Iterable[bytes], length: int = LENGTH, end: int = END) -> Iterator[tuple[int, bytes]]:
    """start and ids of each piece of a document: its ids and the end id, in pieces of so many, the last may be shorter."""
    held, start = b"", 0
    for chunk in chain(chunks, [np.array([end], "<u4").tobytes()]):
        held += chunk
        at = 0
        while len(held) - at > 4 * length:  # what fills a piece exactly may be the last
            yield start, held[at : at + 4 * length]
            at, start = at + 4 * length, start + length
        held = held[at:]
    yield start, held


def pieces(docs: DataFrame, id: str = "doc_id", text: str = "text", tokenizer: str | None = None, length: int = LENGTH, end: int = END, keep_ids: bool = False) -> DataFrame:
    """id, piece, start, length, ids_crc32 and, if they are kept, ids (array of int) of each piece of the documents.

    tokenizer: a vocabulary file, by default a public one, read where the executors are. A null text is read as an empty one, which is the end
    id alone.
    """
    small_batches(docs.sparkSession)
    kind = docs.schema[id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = tokenizer
        if path is None:
            import public_tokenizers

            path = public_tokenizers.path(TOKENIZER)
        ids = Ids.of(path)
        for batch in in_pieces(batches):
            rows: list[tuple[int, int, int, bytes]] = []
            size = 0

            def flushed(batch=batch, rows=rows) -> pa.RecordBatch:
                at, piece, start, made = zip(*rows, strict=True)
                out = [batch.column(0).take(pa.array(at, pa.int32())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array([len(x) // 4 for x in made], pa.int64()), pa.array(map(zlib.crc32, made), pa.int64())]
                if keep_ids:
                    out.append(pa.array([np.frombuffer(x, "<i4") for x in made], pa.list_(pa.int32())))
                return pa.RecordBatch.from_arrays(out, names=["id", "piece", "start", "length", "ids_crc32", "ids"][: len(out)])

            for k, text in enumerate(batch.column(1)):
                for n, (start, made) in enumerate(cut_up(ids.chunks(text.as_py() or ""), length, end)):
                    rows.append((k, n, start, made))
                    size += len(made)
                    if size > 1 << 24:
                        yield flushed()
                        rows.clear()
                        size = 0
            if rows:
                yield flushed()

    made = docs.select(F.col(id), F.col(text).cast("string")).mapInArrow(run, f"id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * keep_ids)
    return made.withColumnRenamed("id", id)


def best_fit(lengths: Sequence[int], items: Sequence[int], rooms: list[int], capacity: int) -> list[int]:
    """The sequence that each item enters, one after the other: that with the least room that holds it, or a new one. rooms, of the sequences, is kept up to date."""
    by_room: dict[int, list[int]] = defaultdict(list)
    there = 0  # bit r: there is a sequence with room r
    for box, room in enumerate(rooms):
        by_room[room].append(box)
        there |= 1 << room
    out = []
    for item in items:
        size = lengths[item]
        fits = there >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            box = by_room[room].pop()
            if not by_room[room]:
                there ^= 1 << room
        else:
            room, box = capacity, len(rooms)
            rooms.append(capacity)
        rooms[box] = room - size
        by_room[room - size].append(box)
        there |= 1 << room - size
        out.append(box)
    return out


def bound(lengths: np.ndarray, capacity: int) -> int:
    """No packing has fewer sequences: neither tokens nor pieces longer than half a sequence leave room for fewer."""
    return int(max(-(-lengths.sum() // capacity), (2 * lengths > capacity).sum()))


def quality(boxes: np.ndarray, lengths: np.ndarray) -> tuple[int, int]:
    """Smaller is better: the number of sequences, then how evenly they are filled, where uneven is better."""
    load = np.bincount(boxes, lengths).astype(np.int64)
    return len(load), -int((load * load).sum())


def _refit(boxes: np.ndarray, out: np.ndarray, lengths: np.ndarray, capacity: int) -> np.ndarray:
    """boxes with the items of a mask best-fitted anew, the largest first; numbers are made gapless."""
    stay = np.flatnonzero(~out)
    made = np.empty_like(boxes)
    names, made[stay] = np.unique(boxes[stay], return_inverse=True)
    rooms = (capacity - np.bincount(made[stay], lengths[stay], len(names)).astype(np.int64)).tolist()
    items = np.flatnonzero(out)
    items = items[np.argsort(-lengths[items], kind="stable")]
    made[items] = best_fit(lengths.tolist(), items.tolist(), rooms, capacity)
    return made


def crossed(one: np.ndarray, other: np.ndarray, lengths: np.ndarray, capacity: int, rng: np.random.Generator) -> np.ndarray:
    """one, with well-filled sequences of other injected whole: sequences that share a piece with them are taken out, and their other pieces best-fitted."""
    load = np.bincount(other, lengths)
    some = max(1, int(len(load) * rng.uniform(0.02, 0.15)))
    chosen = np.argsort(-(load / capacity + rng.uniform(0, 0.02, len(load))))[:some]
    injected = np.isin(other, chosen)
    hit = np.isin(one, one[injected])
    return _refit(np.where(injected, other + one.max() + 1, one), hit & ~injected, lengths, capacity)


def mutated(boxes: np.ndarray, lengths: np.ndarray, capacity: int, rng: np.random.Generator) -> np.ndarray:
    """The emptiest sequences and a few others are dissolved and their pieces best-fitted."""
    load = np.bincount(boxes, lengths)
    gone = np.union1d(np.argsort(load)[:2], rng.integers(0, len(load), max(1, len(load) // 50)))
    return _refit(boxes, np.isin(boxes, gone), lengths, capacity)


def founded(lengths: np.ndarray, capacity: int, population: int, rng: np.random.Generator) -> list[np.ndarray]:
    """Packings to begin with: best-fit decreasing, and best fit in orders near that one."""
    out = []
    for k in range(population):
        order = np.argsort(-lengths * (1 + rng.uniform(-0.2, 0.2, len(lengths)) * (k > 0)), kind="stable")
        boxes = np.empty(len(lengths), np.int64)
        boxes[order] = best_fit(lengths.tolist(), order.tolist(), [], capacity)
        out.append(boxes)
        if boxes.max() + 1 == bound(lengths, capacity):
            break
    return out


def evolved(packings: list[np.ndarray], lengths: np.ndarray, capacity: int, generations: int, population: int, rng: np.random.Generator) -> list[np.ndarray]:
    """The best packings after so many generations, the best first; at once, if one is as small as can be."""
    least = bound(lengths, capacity)
    ranked = sorted(((quality(p, lengths), k, p) for k, p in enumerate(packings)), key=lambda x: x[:2])[:population]
    for step in range(generations):
        if ranked[0][0][0] == least:
            break
        born = []
        for k in range(len(ranked)):
            one, other = (min(rng.integers(0, len(ranked), 2)) for _ in range(2))  # the better of two, by rank
            child = crossed(ranked[one][2], ranked[other][2], lengths, capacity, rng) if one != other else ranked[one][2]
            child = mutated(child, lengths, capacity, rng)
            born.append((quality(child, lengths), len(ranked) + k + step * population, child))
        ranked = sorted({x[0]: x for x in (*born, *ranked)}.values(), key=lambda x: x[:2])[:population]
    return [p for _, _, p in ranked]


def _int(b: bytes, kind: str = "<i4") -> np.ndarray:
    return np.frombuffer(b, kind).astype(np.int64)


STATE = "block long, island int, lengths binary, packings array<binary>, boxes int, least int"


def _epoch(state: DataFrame, capacity: int, generations: int, population: int, seed: int) -> DataFrame:
    """Each island (block, island, lengths, packings, elite of another island or null) after an epoch; one without packings founds them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_pieces(batches, 1):
            block, island, raw, packings, elite = (c[0].as_py() for c in batch.columns)
            lengths, rng = _int(raw), np.random.default_rng([seed, block, island])
            before = [_int(p) for p in (*packings, *([elite] if elite else []))] or founded(lengths, capacity, population, rng)
            after = evolved(before, lengths, capacity, generations, population, rng)
            best = int(after[0].max()) + 1
            row = [[block], [island], [raw], [[p.astype("<i4").tobytes() for p in after]], [best], [bound(lengths, capacity)]]
            kinds = [pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.binary()), pa.int32(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, kinds, strict=True)], names=["block", "island", "lengths", "packings", "boxes", "least"])

    return state.select("block", "island", "lengths", "packings", "elite").repartition(F.col("block"), F.col("island")).mapInArrow(run, STATE)


def _blocks(items: DataFrame) -> DataFrame:
    """block, uids and lengths (binary, the longest first) of items (block, uid, length)."""

    def run(table: pa.Table) -> pa.Table:
        uids, lengths = table["uid"].to_numpy(), table["length"].to_numpy()
        order = np.lexsort((uids, -lengths))
        return pa.table({"block": table["block"][:1], "uids": pa.array([uids[order].astype("<i8").tobytes()], pa.binary()), "lengths": pa.array([lengths[order].astype("<i4").tobytes()], pa.binary())})

    return items.groupBy("block").applyInArrow(run, "block long, uids binary, lengths binary")


def _placed(found: DataFrame, capacity: int, release: bool) -> DataFrame:
    """uid, length, sequence_id, offset of each member of blocks (uids, lengths, packing).

    If release is set, members of sequences that are less than 99 % full (of a quarter of a block's sequences at most, the emptiest, and of
    the emptiest one if it isn't full) have a null sequence_id: they are to be packed again.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_pieces(batches, 1):
            uids, lengths, boxes = (_int(batch.column(k)[0].as_py(), t) for k, t in enumerate(("<i8", "<i4", "<i4")))
            order = np.argsort(boxes, kind="stable")
            uids, lengths, boxes = uids[order], lengths[order], boxes[order]
            load = np.bincount(boxes, lengths).astype(np.int64)
            first = np.searchsorted(boxes, np.arange(len(load)))
            before = np.cumsum(lengths) - lengths
            names, gone = np.minimum.reduceat(uids, first), np.zeros(len(load), bool)
            if release:
                worst = np.argsort(load, kind="stable")[: max(1, len(load) // 4)]
                gone[worst[load[worst] < 0.99 * capacity]] = True
                gone[worst[0]] |= load[worst[0]] < capacity
            out = [pa.array(uids), pa.array(lengths), pa.array(names[boxes], mask=gone[boxes]), pa.array(before - before[first][boxes])]
            yield pa.RecordBatch.from_arrays(out, names=["uid", "length", "sequence_id", "offset"])

    return found.select("uids", "lengths", "packing").mapInArrow(run, "uid long, length long, sequence_id long, offset long")


def placements(items: DataFrame, capacity: int = LENGTH, islands: int = 3, epochs: int = 3, generations: int = 12, population: int = 6, members: int = MEMBERS) -> DataFrame:
    """uid, sequence_id (the least uid of its sequence) and offset of items (uid, length; lengths from 1 to capacity).

    uid tells all items apart. An item that fills a sequence is one. The driver sees counts only; a task holds a block, so many members or so.
    """
    full = items.where(F.col("length") == capacity).select("uid", F.col("uid").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    left, done = items.where(F.col("length") < capacity).select("uid", "length"), full
    step = 0
    while True:
        blocks = max(1, -(-left.count() // members))
        dealt = left.withColumn("block", F.pmod(F.xxhash64("uid", F.lit(step)), F.lit(blocks)).cast("long"))
        held = cut(_blocks(dealt))
        island = F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island")
        none = F.lit(None).cast("binary").alias("elite")
        state = held.select("block", island, "lengths", F.array().cast("array<binary>").alias("packings"), none)
        for epoch in range(epochs):
            state = cut(_epoch(state, capacity, generations, population, 1000 * step + epoch))
            best = state.groupBy("block").agg(F.min("boxes").alias("boxes"), F.min("least").alias("least"))
            if epoch == epochs - 1 or best.where(F.col("boxes") > F.col("least")).isEmpty():
                break
            elites = state.select("block", ((F.col("island") + 1) % islands).alias("island"), F.get("packings", F.lit(0)).alias("elite"))
            state = state.join(elites, ["block", "island"])
        best = state.groupBy("block").agg(F.min_by(F.get("packings", F.lit(0)), F.struct("boxes", "island")).alias("packing"))
        placed = cut(_placed(held.join(best, "block"), capacity, blocks > 1))
        done = done.unionByName(placed.where("sequence_id is not null").select("uid", "sequence_id", "offset"))
        if blocks == 1:
            return done
        left, step = placed.where("sequence_id is null").select("uid", "length"), step + 1


def packed(docs: DataFrame, id: str = "doc_id", text: str = "text", tokenizer: str | None = None, length: int = LENGTH, end: int = END, keep_ids: bool = False) -> DataFrame:
    """pieces() with sequence_id and offset: no sequence is longer than length, and offsets in it are gapless from 0.

    Null ids, repeated ids and repeated rows are pieces like others. Other columns are not read. An empty table gives no rows.
    """
    made = cut(pieces(docs, id, text, tokenizer, length, end, keep_ids).withColumn("_uid", F.monotonically_increasing_id()))
    found = placements(made.select(F.col("_uid").alias("uid"), "length"), length)
    return made.join(found.withColumnRenamed("uid", "_uid"), "_uid").drop("_uid")


def sequences(found: DataFrame) -> DataFrame:
    """sequence_id and ids (array of int) of what packed() gives with its ids."""
    parts = found.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))  # as many tokens as a sequence has
    return parts.select("sequence_id", F.flatten("parts.ids").alias("ids"))


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(spark.read.parquet(f"{sf_dir}/documents.parquet"))
