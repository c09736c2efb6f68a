"""Texts of an Arrow batch as flat byte arrays, cut into blocks of bounded size.

The operators that need bytes or words work on blocks: whole texts, laid end to
end in one UTF-8 array, with the offsets of the texts in it.  A block holds at
most ``limit`` bytes, or one longer text.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 19
U64 = np.uint64


class Block(NamedTuple):
    """Rows of one batch and their texts; a null text is empty."""

    rows: pa.RecordBatch
    data: np.ndarray  # uint8, all texts end to end
    offsets: np.ndarray  # int64, one more than rows

    def strings(self) -> list[str]:
        return pc.fill_null(self.rows.column("text"), "").to_pylist()


def blocks(batches: Iterator[pa.RecordBatch], limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """The batches' rows in order; every batch has a string column ``text``."""
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column("text")
        if column.null_count:
            column = pc.fill_null(column, "")
        width = np.int64 if pa.types.is_large_string(column.type) else np.int32
        _, places, body = column.buffers()
        offsets = np.frombuffer(places, width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
        data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
        start = 0
        while start < len(column):
            end = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
            end = min(max(end, start + 1), len(column))
            yield Block(
                batch.slice(start, end - start),
                data[offsets[start] : offsets[end]],
                offsets[start : end + 1] - offsets[start],
            )
            start = end


def gathered(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` bytes of text, whatever the batches were."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        for block in blocks(iter([batch]), limit):
            if held and size + len(block.data) > limit:
                yield pa.concat_batches(held)
                held, size = [], 0
            held.append(block.rows)
            size += len(block.data)
    if held:
        yield pa.concat_batches(held)


def is_space(data: np.ndarray) -> np.ndarray:
    """Bytes that end a word: blank and the control characters 9 to 13."""
    return (data == 32) | ((data >= 9) & (data <= 13))


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the first word of every text (one more than texts)."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~is_space(data)
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | first[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | first[1:-1]
    starts = np.flatnonzero(starts)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offsets)


# ---- hashes -----------------------------------------------------------------
BASE = 0x9E3779B97F4A7C15 | 1
_powers = [np.ones(1, U64), np.ones(1, U64)]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE modulo 2**64 and of its inverse, at least ``size`` of each."""
    if len(_powers[0]) < size:
        size = max(size, 2 * len(_powers[0]), BLOCK_BYTES + 1024)
        for k, base in enumerate((BASE, pow(BASE, -1, 1 << 64))):
            table = np.full(size, base, U64)
            table[0] = 1
            _powers[k] = np.multiply.accumulate(table)
    return _powers[0], _powers[1]


class Hasher:
    """Hashes of any slices of a byte array, after one pass over it."""

    def __init__(self, data: np.ndarray) -> None:
        up, self.down = powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, U64)
        np.cumsum((data.astype(U64) + U64(1)) * up[: len(data)], out=self.sums[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        slices = (self.sums[ends] - self.sums[starts]) * self.down[starts]
        return mix(slices + (ends - starts).astype(U64) * U64(0xD6E8FEB86659FD93))


# Odd weights of the words in a window.
_WEIGHTS = [U64(w) for w in (0x9FB21C651E98DF25, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD1B54A32D192ED03, 0xA0761D6478BD642F)]
SHINGLE_WORDS = len(_WEIGHTS)


def windows(hashes: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of five words, and the first window of every text.

    ``firsts`` has the first word of every text.  A text of one to four words
    has one window, its whole sequence; a text without words has none.
    """
    counts = np.diff(firsts)
    full = np.maximum(counts - SHINGLE_WORDS + 1, 0)
    n_windows = np.where(counts > 0, np.maximum(full, 1), 0)
    first_window = np.concatenate([[0], np.cumsum(n_windows)])
    at = np.arange(first_window[-1]) - np.repeat(first_window[:-1] - firsts[:-1], n_windows)
    lengths = np.repeat(np.minimum(counts, SHINGLE_WORDS), n_windows)
    padded = np.concatenate([hashes, np.zeros(SHINGLE_WORDS, U64)])
    out = lengths.astype(U64) * U64(0xE7037ED1A0B428DB)
    for j, weight in enumerate(_WEIGHTS):
        out += np.where(lengths > j, padded[at + j], U64(0)) * weight
    return mix(out), first_window


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of every text, sorted, and where each text's begin.

    A-Z count as a-z.  A shingle is a 64-bit hash of five words.
    """
    data = lower_ascii(data)
    starts, ends, firsts = words(data, offsets)
    shingles, first_window = windows(Hasher(data)(starts, ends), firsts)
    sets = [np.unique(shingles[a:b]) for a, b in zip(first_window[:-1], first_window[1:])]
    return (
        np.concatenate(sets) if sets else np.zeros(0, U64),
        np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int64),
    )


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Rows of one key after another, from batches in which equal keys are adjacent.

    Holds one group and one batch; callers bound the size of a group.
    """
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_pylist() for k in keys]
        values = list(zip(*columns))
        cuts = [i for i in range(1, len(values)) if values[i] != values[i - 1]]
        for a, b in zip([0, *cuts], [*cuts, len(values)]):
            if held and values[a] != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = values[a]
    if held:
        yield pa.Table.from_batches(held)
