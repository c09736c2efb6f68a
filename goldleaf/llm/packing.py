"""Packing token pieces into sequences by bin completion.

Texts become ids, longer ones are cut, and the lengths of the pieces are counted:
at most ``capacity`` numbers, whatever the corpus.  Bins are completed over that
histogram on the driver, and its patterns say which places the n-th piece of a
length takes.  Pieces of one length are numbered in salted groups, so that a
length that many copies share is spread over tasks.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Iterator
from functools import partial
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from goldleaf.llm.bins import Pattern, pack
from goldleaf.llm.blocks import Block, blocks
from goldleaf.llm.remembered import Remembered
from goldleaf.llm.tasks import kept, map_arrow
from goldleaf.sources.tables import materialize

CAPACITY = 4096
END = 1
REMEMBERED = 400_000
SALTED_ROWS = 50_000

# The words of the vocabulary file, after lower-casing; and the same in ASCII.
WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
ASCII_WORD = re.compile(r"'(?:[stmd]|re|ve|ll)|[a-z]+|[0-9]|[^\sa-z0-9]+", re.ASCII)
# And in letters up to U+017F, which most texts in Latin script stay with.
_LATIN = {kind: "".join(chr(c) for c in range(128, 0x180) if unicodedata.category(chr(c))[0] == kind) for kind in "LN"}
LATIN_WORD = re.compile(
    rf"'(?:[stmd]|re|ve|ll)|[a-z{_LATIN['L']}]+|[0-9{_LATIN['N']}]|[^\t-\r \x85\xa0a-z0-9{_LATIN['L']}{_LATIN['N']}]+"
)
BEYOND_LATIN = re.compile("[^\0-\u017f]")
# The vocabulary file spells words with a character for each byte: its own, or one from U+0100 on.
_OWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTES = {byte: 256 + k for k, byte in enumerate(sorted({*range(256)} - {*_OWN}))}
# Texts with these go through the tokenizer as they are: special tokens, a letter
# whose lower case depends on its place, and controls that count as blank in some libraries only.
UNUSUAL = ["<|startoftext|>", "<|endoftext|>", "\u03a3", "\x1c", "\x1d", "\x1e", "\x1f"]


def split(text: str) -> list[str]:
    if text.isascii():
        return ASCII_WORD.findall(text.lower())
    text = unicodedata.normalize("NFC", text).lower()
    return (WORD if BEYOND_LATIN.search(text) else LATIN_WORD).findall(text)


def spelled(word: str) -> str:
    """A word in the characters of the vocabulary file."""
    if word.isascii() and word.isprintable():
        return word
    return word.encode().decode("latin-1").translate(BYTES)


class Words:
    """Ids of texts, by remembered words; new words in Latin letters go to its model one by one, others together."""

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        vocab = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for token, i in vocab.items() if token.endswith("</w>")]] = True
        self.known = Remembered(self.tokenized, REMEMBERED)

    def exactly(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def tokenized(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        # Beyond Latin letters the tokenizer may know other characters than ``regex`` and split a word again.
        each = [None if BEYOND_LATIN.search(word) else [token.id for token in self.model.tokenize(spelled(word))] for word in words]
        others = [i for i, ids in enumerate(each) if ids is None]
        if others:
            ids = np.array(self.exactly(" ".join([words[i] for i in others])), np.int64)
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) == len(others):
                parts = [part.tolist() for part in np.split(ids, cuts[:-1])]
            else:  # a word that doesn't stand alone
                parts = [self.exactly(words[i]) for i in others]
            for i, part in zip(others, parts):
                each[i] = part
        return np.array(list(chain.from_iterable(each)), np.int64), np.array([len(e) for e in each])

    def encode(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a block, and the first id of each text (one more than texts)."""
        texts = block.strings()
        whole = block.data.tobytes().decode()
        marks = [mark for mark in UNUSUAL if mark in whole]
        unusual = {i for i, text in enumerate(texts) if any(mark in text for mark in marks)} if marks else set()
        words = [[] if i in unusual else split(text) for i, text in enumerate(texts)]
        flat, at = self.known.look_up(list(chain.from_iterable(words)))
        firsts = at[np.append(0, np.cumsum([len(w) for w in words]))]
        if unusual:
            parts = [flat[a:b] for a, b in zip(firsts[:-1], firsts[1:])]
            for i in unusual:
                parts[i] = np.array(self.exactly(texts[i]), np.uint32)
            flat, firsts = np.concatenate(parts), np.append(0, np.cumsum([len(p) for p in parts]))
        return flat, firsts


@kept(2)
def vocabulary(path: str) -> Words:
    return Words(path)


def _pieces(batches: Iterator[pa.RecordBatch], path: str, capacity: int, keep_ids: bool) -> Iterator[pa.RecordBatch]:
    words = vocabulary(path)
    for block in blocks(batches):
        flat, firsts = words.encode(block)
        flat, firsts = np.insert(flat, firsts[1:], END), firsts + np.arange(len(firsts))
        sizes = np.diff(firsts)
        n = -(-sizes // capacity)
        row = np.repeat(np.arange(len(sizes)), n)
        piece = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        start = piece * capacity
        length = np.minimum(sizes[row] - start, capacity)
        raw = flat.astype("<u4")
        at = (firsts[row] + start).tolist()
        columns = [
            block.rows.column("doc_id").take(pa.array(row)),
            pa.array(piece.astype(np.int32)),
            pa.array(start),
            pa.array(length),
            pa.array([zlib.crc32(raw[a : a + k]) for a, k in zip(at, length.tolist())], pa.int64()),
        ]
        names = ["doc_id", "piece", "start", "length", "ids_crc32"]
        if keep_ids:
            # Pieces lie end to end, in the order of their rows.
            columns.append(pa.ListArray.from_arrays(np.append(at, len(flat)).astype(np.int32), flat.astype(np.int64)))
            names.append("ids")
        yield pa.RecordBatch.from_arrays(columns, names)


def token_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece of every row of (doc_id, text)."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_arrow(
        docs,
        partial(_pieces, path=path, capacity=capacity, keep_ids=keep_ids),
        "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids array<bigint>" * keep_ids,
    )


def places(patterns: list[Pattern]) -> dict[str, np.ndarray]:
    """Rows (length, first, sequence, offset): from the ``first``-th piece of a length on,
    pieces take that offset in sequences that count up from ``sequence``."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for pattern, times in patterns:
        offset = 0
        for length in pattern:
            rows.append((length, used.get(length, 0), sequence, offset))
            used[length] = used.get(length, 0) + times
            offset += length
        sequence += times
    rows.sort()
    columns = np.array(rows, np.int64).reshape(-1, 4).T
    return dict(zip(("length", "first", "sequence", "offset"), columns))


def _placed(batches: Iterator[pa.RecordBatch], plan: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    keys = (plan["length"] << 48) + plan["first"]
    for batch in batches:
        number = batch.column("number").to_numpy()
        at = np.searchsorted(keys, (batch.column("length").to_numpy() << 48) + number, side="right") - 1
        names = [n for n in batch.schema.names if n != "number"]
        yield pa.RecordBatch.from_arrays(
            [
                *[batch.column(n) for n in names],
                pa.array(plan["sequence"][at] + number - plan["first"][at]),
                pa.array(plan["offset"][at]),
            ],
            [*names, "sequence_id", "offset"],
        )


def numbered(pieces: DataFrame, total: int) -> DataFrame:
    """Pieces with ``number``, from 0 within each length."""
    salts = max(1, -(-total // SALTED_ROWS))
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        salted.groupBy("length", "salt")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    )
    inside = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    return (
        salted.withColumn("number", F.row_number().over(inside) - 1)
        .join(starts, ["length", "salt"])
        .withColumn("number", (F.col("number") + F.col("earlier")).cast("bigint"))
        .drop("salt", "earlier")
    )


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Stored pieces with sequence_id and offset; every length is at most ``capacity``."""
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in pieces.groupBy("length").count().collect():  # at most ``capacity`` rows
        counts[length] = n
    plan = places(pack(counts, capacity))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema)
    return map_arrow(
        numbered(pieces, int(counts.sum())).select(*pieces.columns, "number"),
        partial(_placed, plan=plan),
        f"{schema}, sequence_id bigint, offset bigint",
    )


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """Pieces of every row of (doc_id, text) and their places in sequences.

    One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id,
    offset, and the ids if wanted.  A null or empty text is the single end id.
    Rows that repeat are packed as often as they occur; doc_id may be null.
    Other columns are ignored.  An empty table gives no rows.
    """
    return pack_pieces(materialize(token_pieces(docs, path, capacity, keep_ids), "pieces"), capacity)
