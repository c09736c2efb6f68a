"""Byte-level BPE encoding and decoding with rank files.

Texts are cut into pieces without a regular expression.  Every code point has a
class, a class is a function from state to state, and functions compose
associatively: the code points are laid out in short rows, the functions of a
row are composed for all rows at once, a scan over the rows gives each row's
first state, and a second pass marks where pieces begin.  Pieces are merged once
and remembered; the byte lengths of the ids are kept, so that ids of a block of
texts decode to each text's own bytes.

The pieces are those of ``public_tokenizers.PATTERN``.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import unicodedata
from collections.abc import Iterator
from functools import lru_cache, partial
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldleaf.llm.blocks import Block, blocks
from goldleaf.llm.remembered import Remembered
from goldleaf.llm.tasks import kept, map_arrow

REMEMBERED = 400_000
WIDEST = 32
ROW = 128
NO_PAIR, NO_PART = 1 << 40, (1 << 31) - 1
SLOTS = 1 << 20

# White space, and the letters after an apostrophe that make a piece with it.
SPACES = [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
SHORT_ENDINGS = ["s", "t", "m", "d"]
LONG_ENDINGS = ["re", "ve", "ll"]

# Classes of code points.
LETTER, NUMBER, OTHER, SPACE, LAST_BLANK, LAST_SPACE, APOSTROPHE_1, APOSTROPHE_2 = range(8)
FIRST = 8  # added at the begin of a text
NOTHING = 16  # leaves every state as it is
# States: what the code points so far have begun.
FRESH, IN_LETTERS, IN_NUMBERS, IN_OTHERS, IN_SPACES, AFTER_BLANK, ONE_TO_GO, TWO_TO_GO = range(8)


@lru_cache(1)
def tables() -> tuple[np.ndarray, np.ndarray]:
    """Next state, and whether a piece begins, at [class, state]."""
    step, begins = np.zeros((17, 8), np.uint8), np.zeros((17, 8), bool)
    for state in range(8):
        for kind, to in ((LETTER, IN_LETTERS), (NUMBER, IN_NUMBERS), (OTHER, IN_OTHERS)):
            step[kind, state], begins[kind, state] = to, state not in (to, AFTER_BLANK)
        for kind, to in ((APOSTROPHE_1, ONE_TO_GO), (APOSTROPHE_2, TWO_TO_GO)):
            joins = state in (IN_OTHERS, AFTER_BLANK)
            step[kind, state], begins[kind, state] = IN_OTHERS if joins else to, not joins
        step[SPACE, state], begins[SPACE, state] = IN_SPACES, state != IN_SPACES
        step[LAST_BLANK, state], begins[LAST_BLANK, state] = AFTER_BLANK, True
        step[LAST_SPACE, state], begins[LAST_SPACE, state] = FRESH, True
    for kind in range(8):
        step[kind, ONE_TO_GO], begins[kind, ONE_TO_GO] = FRESH, False
        step[kind, TWO_TO_GO], begins[kind, TWO_TO_GO] = ONE_TO_GO, False
        step[FIRST + kind], begins[FIRST + kind] = step[kind, FRESH], True
    step[NOTHING] = np.arange(8)
    return step, begins


@lru_cache(1)
def kinds() -> np.ndarray:
    """LETTER, NUMBER, SPACE or OTHER of every code point."""
    found = {"L": LETTER, "N": NUMBER}
    table = np.fromiter((found.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), np.uint8, 0x110000)
    table[SPACES] = SPACE
    return table


def classes(points: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Class of every code point; ``firsts`` has the places where a text begins."""
    n = len(points)
    ends = np.zeros(n + 2, bool)
    ends[firsts[firsts <= n]] = True
    ends[n:] = True
    kind = kinds()[points]
    space = kind == SPACE
    last = space & ~(np.append(space[1:], True) | ends[1 : n + 1])
    kind[last] = LAST_SPACE
    kind[last & (points == 32)] = LAST_BLANK
    marks = np.flatnonzero(points == 39)
    if len(marks):
        after = np.append(points, [0, 0])
        one = np.where(ends[marks + 1], 0, after[marks + 1])
        two = np.where(ends[marks + 1] | ends[marks + 2], 0, after[marks + 2])
        for ending in LONG_ENDINGS:
            kind[marks[(one == ord(ending[0])) & (two == ord(ending[1]))]] = APOSTROPHE_2
        kind[marks[np.isin(one, [ord(e) for e in SHORT_ENDINGS])]] = APOSTROPHE_1
    kind[firsts[firsts < n]] += FIRST
    return kind


def piece_starts(points: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Places where pieces begin, ascending."""
    n = len(points)
    if not n:
        return np.zeros(0, np.int64)
    step, begins = tables()
    step, begins = step.ravel(), begins.ravel()
    grid = np.full(-(-n // ROW) * ROW, NOTHING, np.uint8)
    grid[:n] = classes(points, firsts)
    grid = np.ascontiguousarray(grid.reshape(-1, ROW).T).astype(np.uint16) * np.uint16(8)
    rows = np.tile(np.arange(8, dtype=np.uint8), (grid.shape[1], 1))
    for kind in grid:
        rows = step[kind[:, None] + rows]
    # Inclusive scan of the rows' functions: first the earlier one, then the later one.
    reach = 1
    while reach < len(rows):
        rows[reach:] = np.take_along_axis(rows[reach:], rows[:-reach].copy(), axis=1)
        reach *= 2
    state = np.append(np.uint8(FRESH), rows[:-1, FRESH])
    marks = np.empty(grid.shape, bool)
    for k, kind in enumerate(grid):
        at = kind + state
        marks[k] = begins[at]
        state = step[at]
    return np.flatnonzero(marks.T.ravel()[:n])


def _slot(keys: np.ndarray) -> np.ndarray:
    spread = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (spread >> np.uint64(44)).astype(np.int64)


class Vocabulary:
    """Ids of pieces, by merging pairs of the lowest rank; remembers up to REMEMBERED pieces."""

    def __init__(self, path: str) -> None:
        self.known = Remembered(self.new_pieces, REMEMBERED)
        with open(path, "rb") as lines:
            pairs = (line.split() for line in lines if line.strip())
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.bytes = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.bytes[rank] = token
        self.sizes = np.array([len(b) for b in self.bytes])
        self.singles = np.array([self.ranks[bytes([b])] for b in range(256)])
        self.pairs = self._pair_table()

    def new_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = self.merged([p.encode() for p in pieces])
        return np.array(list(chain.from_iterable(ids)), np.int64), np.array([len(i) for i in ids])

    def merged(self, raws: list[bytes]) -> list[tuple[int, ...]]:
        out: list[tuple[int, ...]] = [()] * len(raws)
        by_width: dict[int, list[int]] = {}
        for i, raw in enumerate(raws):
            whole = self.ranks.get(raw)
            if whole is not None:
                out[i] = (whole,)
            elif len(raw) > WIDEST:
                out[i] = self._long(raw)
            else:
                by_width.setdefault(-(-len(raw) // 4) * 4, []).append(i)
        for width, rows in by_width.items():
            for i, ids in zip(rows, self._together([raws[i] for i in rows], width)):
                out[i] = ids
        return out

    def _pair_table(self) -> tuple[np.ndarray, np.ndarray, int]:
        """Merged ids by pair of ids: keys and values by slot, and the most slots to try."""
        pairs = {}
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                left, right = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        keys, values, tries = np.full(SLOTS + 64, -1, np.int64), np.full(SLOTS + 64, NO_PAIR, np.int64), 1
        for key, at in zip(pairs, _slot(np.array(list(pairs), np.int64)).tolist()):
            start = at
            while keys[at] != -1:
                at += 1
            keys[at], values[at], tries = key, pairs[key], max(tries, at - start + 1)
        return keys, values, tries

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys, values, tries = self.pairs
        key = left << 32 | right
        at = _slot(key)
        out = np.where(keys[at] == key, values[at], NO_PAIR)
        for k in range(1, tries):
            left_over = np.flatnonzero((out == NO_PAIR) & (keys[at] != -1))
            if not len(left_over):
                break
            at.ravel()[left_over] += 1
            out = np.where((out == NO_PAIR) & (keys[at] == key), values[at], out)
        return out

    def _together(self, raws: list[bytes], width: int) -> list[tuple[int, ...]]:
        """One merge in every piece at a time, pieces as rows of a matrix."""
        sizes = np.array([len(r) for r in raws])
        bytes_ = np.frombuffer(b"".join(r.ljust(width, b"\0") for r in raws), np.uint8).reshape(-1, width)
        parts = np.where(np.arange(width) < sizes[:, None], self.singles[bytes_], NO_PART)
        ranks = self._rank(parts[:, :-1], parts[:, 1:])
        rows = np.arange(len(raws))
        done = np.full((len(raws), width), NO_PART, np.int64)
        columns = np.arange(width - 1)
        while len(rows):
            best = ranks.argmin(axis=1)
            each = np.arange(len(rows))
            merges = ranks[each, best] != NO_PAIR
            done[rows[~merges]] = parts[~merges]
            rows, parts, ranks, best = rows[merges], parts[merges], ranks[merges], best[merges]
            each = each[: len(rows)]
            parts[each, best] = ranks[each, best]
            # The part behind the merged one goes; the others move up.
            from_ = columns + (columns > best[:, None])
            parts[:, :-1] = np.take_along_axis(parts, from_, axis=1)
            parts[:, -1] = NO_PART
            ranks[:, :-1] = np.take_along_axis(ranks, from_[:, :-1], axis=1)
            ranks[:, -1] = NO_PAIR
            padded = np.pad(parts, ((0, 0), (0, 1)), constant_values=NO_PART)
            in_front = np.maximum(best - 1, 0)
            ranks[each, in_front] = self._rank(padded[each, in_front], padded[each, in_front + 1])
            behind = np.minimum(best, width - 2)
            ranks[each, behind] = self._rank(padded[each, behind], padded[each, behind + 1])
        counts = (done != NO_PART).sum(axis=1).tolist()
        return [tuple(ids[:n]) for ids, n in zip(done.tolist(), counts)]

    def _long(self, raw: bytes) -> tuple[int, ...]:
        """The same merges by a heap of pairs, for pieces of any length."""
        n, rank = len(raw), self.ranks.get
        end = list(range(1, n + 1))  # of the part that begins here; 0 when it is gone
        before = list(range(-1, n))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank(raw[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            middle = end[i]
            if not middle or middle >= n or end[middle] != stop:
                continue
            end[i], end[middle] = stop, 0
            if stop < n:
                before[stop] = i
                r = rank(raw[i : end[stop]])
                if r is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            if i:
                r = rank(raw[before[i] : stop])
                if r is not None:
                    heapq.heappush(heap, (r, before[i], stop))
        ids, i = [], 0
        while i < n:
            ids.append(self.ranks[raw[i : end[i]]])
            i = end[i]
        return tuple(ids)

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids.tolist()))


@kept(2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def encode(block: Block, words: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts of a block, and the first id of each text (one more than texts)."""
    text = block.data.tobytes().decode()
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    # A byte that continues a code point begins none.
    index = np.append(0, np.cumsum((block.data & 0xC0) != 0x80))
    firsts = index[block.offsets]
    starts = piece_starts(points, firsts)
    places = starts.tolist()
    ids, at = words.known.look_up([text[a:b] for a, b in zip(places, [*places[1:], len(text)])])
    return ids, at[np.searchsorted(starts, firsts)]


def _encoded(batches: Iterator[pa.RecordBatch], path: str, keep_ids: bool) -> Iterator[pa.RecordBatch]:
    words = vocabulary(path)
    for block in blocks(batches):
        ids, firsts = encode(block, words)
        decoded = words.decode(ids)
        cuts = np.append(0, np.cumsum(words.sizes[ids]))[firsts]
        pairs = list(zip(firsts.tolist(), firsts[1:].tolist()))
        columns = [
            block.rows.column("doc_id"),
            pa.array(np.diff(firsts)),
            pa.array([hashlib.sha256(ids[a:b].astype("<u4").tobytes()).hexdigest() for a, b in pairs]),
            pa.array([hashlib.sha256(decoded[a:b]).hexdigest() for a, b in zip(cuts.tolist(), cuts[1:].tolist())]),
        ]
        names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
        if keep_ids:
            columns.append(pa.ListArray.from_arrays(firsts.astype(np.int32), ids.astype(np.int64)))
            names.append("ids")
        yield pa.RecordBatch.from_arrays(columns, names)


def encode_texts(docs: DataFrame, ranks_path: str, keep_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row of (doc_id, text), and its ids if wanted.

    ``ranks_path`` is a rank file that every executor can open.  A null or empty
    text has no ids.  Rows keep their order and repeat as given; doc_id may be
    null.  Other columns are ignored.  Texts are encoded in blocks of about a
    million bytes; a longer one is a block of its own.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return map_arrow(
        docs, partial(_encoded, path=ranks_path, keep_ids=keep_ids), schema + ", ids array<bigint>" * keep_ids
    )


def _decoded(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    words = vocabulary(path)
    for batch in batches:
        texts = [words.decode(np.array(ids or [], np.int64)) for ids in batch.column("ids").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.binary())], ["doc_id", "bytes"])


def decode_texts(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """doc_id and bytes of every row of (doc_id, ids); null ids are empty."""
    return map_arrow(encoded.select("doc_id", "ids"), partial(_decoded, path=ranks_path), "doc_id bigint, bytes binary")
