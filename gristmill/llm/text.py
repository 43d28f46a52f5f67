"""Words of Arrow text batches as numpy arrays: hashes, positions and windows, without a Python object per word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
_BASE, _STEP = U(0x9E3779B97F4A7C15 | 1), U(0xC2B2AE3D27D4EB4F | 1)
_PIECE = 1 << 20
_powers = np.ones(1, U)
_inverses = np.ones(1, U)


def byte_class(inside) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(inside)] = True
    return table


#: Word bytes of [^\x20\x09-\x0D]+ and of [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after folding; in UTF-8, bytes from 0x80 are parts of non-ASCII characters.
NOT_SPACE = byte_class(set(range(256)) - {0x20, *range(0x09, 0x0E)})
ALNUM = byte_class([*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 256)])
SAME = np.arange(256, dtype=np.uint8)
FOLD = SAME.copy()
FOLD[0x41:0x5B] += 0x20
#: As it is, but for white space, which is all one.
CLASS_SPACE = SAME.copy()
CLASS_SPACE[~NOT_SPACE] = 0x20


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string or binary column and the offsets of its rows; a null has none."""
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    buffers, n = column.buffers(), len(column)
    if not n or buffers[1] is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    offsets = np.frombuffer(buffers[1], np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def in_pieces(batches: Iterator[pa.RecordBatch], rows: int = 1024, bytes_: int = 1 << 24) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut into parts of at most so many rows and about so many bytes, without copying them; what a worker makes of a batch stays small whatever the session's batch size."""
    for batch in batches:
        step = max(1, min(rows, bytes_ * batch.num_rows // max(1, batch.nbytes)))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)


def pieces(offsets: np.ndarray, most: int = _PIECE) -> Iterator[tuple[int, int]]:
    """Runs of rows of at most so many bytes, or of one row that is longer."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads each bit of 64 over all."""
    x = x ^ (x >> U(32))
    x = x * U(0xD6E8FEB86659FD93)
    x = x ^ (x >> U(29))
    x = x * U(0xA3B195354A39B70D)
    return x ^ (x >> U(32))


def _grow(n: int) -> None:
    global _powers, _inverses
    if len(_powers) <= n:
        size = max(n + 1, _PIECE + 4096)
        for base, name in ((_BASE, "_powers"), (U(pow(int(_BASE), -1, 2**64)), "_inverses")):
            table = np.full(size, base, U)
            table[0] = 1
            globals()[name] = np.multiply.accumulate(table)


def words(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray = NOT_SPACE, fold: np.ndarray = SAME) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of texts that follow each other in data: each word's start and end there, its 64-bit hash, and the first word of each text (with the end last)."""
    edges = offsets[1:-1]
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    a, end = 0, len(data)
    while a < end:
        b = min(a + _PIECE, end)
        while b < end and inside[data[b]]:  # a piece ends between words, or at the end of a text
            b += 1
        part = data[a:b]
        is_in = inside[part]
        before, after = np.zeros(len(part), bool), np.zeros(len(part), bool)
        before[1:], after[:-1] = is_in[:-1], is_in[1:]
        cuts = edges[np.searchsorted(edges, a) : np.searchsorted(edges, b)] - a
        before[cuts] = False
        after[cuts[cuts > 0] - 1] = False
        starts = np.flatnonzero(is_in & ~before)
        ends = np.flatnonzero(is_in & ~after) + 1
        _grow(len(part))
        sums = np.zeros(len(part) + 1, U)
        np.cumsum((fold[part].astype(U) + U(1)) * _powers[: len(part)], out=sums[1:])
        found.append((starts + a, ends + a, mix((sums[ends] - sums[starts]) * _inverses[starts])))
        a = b
    starts, ends, hashes = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, U))
    return starts, ends, hashes, np.searchsorted(starts, offsets).astype(np.int64)


def windows(hashes: np.ndarray, length: int) -> np.ndarray:
    """A hash of every so many consecutive words, by doubling: the hash of a window is made from those of its two parts."""
    if length == 1:
        return hashes
    half = length // 2
    part = windows(hashes, half)
    if len(hashes) < length:
        return np.zeros(0, U)
    n = len(hashes) - length + 1
    out = part[:n] * U(pow(int(_STEP), half, 2**64)) + part[half : half + n]
    return out if length % 2 == 0 else out * _STEP + hashes[length - 1 : length - 1 + n]


def first_least(values: np.ndarray, span: int) -> np.ndarray:
    """The place of the least of every span consecutive values, the first of equal ones."""
    at, v, reach = np.arange(len(values)), values, 1
    while 2 * reach <= span:
        left = v[:-reach] <= v[reach:]
        at = np.where(left, at[:-reach], at[reach:])
        v = values[at]
        reach *= 2
    if reach < span:
        gap = span - reach
        at = np.where(v[:-gap] <= v[gap:], at[:-gap], at[gap:])
    return at


def last_fit(first: np.ndarray, length: int) -> np.ndarray:
    """For each word of the texts that first describes: whether a window that starts there ends in the same text."""
    counts = np.diff(first)
    left = np.repeat(first[1:], counts) - np.arange(first[0], first[-1])
    return left >= length
