"""Removal of repeated passages, by suffix arrays over the places that can repeat.

A byte goes if it lies in a string of ``LENGTH`` bytes that starts anywhere else
too.  Suffix arrays over whole corpora would have to be merged all with all;
here the texts say first where a repeat is possible:

1. Every string of LENGTH bytes has an anchor, its least hashed run of KEY bytes,
   and equal strings have equal anchors.  Anchors of one key are counted; a key
   that occurs once can't be in a repeat.
2. The context of an anchor holds all strings whose anchor it is.  Contexts with
   equal hashes repeat as a whole, so of each only one representative goes on,
   however many documents share the passage.
3. Keys with different contexts are compared byte by byte.  A shard is all
   contexts of some keys: its suffix array is refined to LENGTH bytes, and runs
   of common prefixes of LENGTH bytes from different places are repeats.  The
   contexts of a key with very many are dealt out to several shards, which are
   merged: each sends its sorted strings' hashes by ranges, and a range task looks
   them up in each other by binary search.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldleaf.llm.blocks import Hasher, blocks, mix, runs
from goldleaf.llm.suffixes import common_prefixes, packed, remaining, suffix_array
from goldleaf.llm.tasks import map_arrow
from goldleaf.sources.tables import materialize

LENGTH = 200
KEY = 64
SHARD_CONTEXTS = 4096
SHARD_BYTES = 1 << 20

U64, I64 = np.uint64, np.int64


def _first_least(values: np.ndarray, width: int) -> np.ndarray:
    """Where the least of every ``width`` neighbours is, the first of equal ones."""
    n = len(values) - width + 1
    grid = np.full(-(-len(values) // width) * width, np.iinfo(U64).max, U64)
    grid[: len(values)] = values
    grid = grid.reshape(-1, width)
    at = np.arange(grid.size).reshape(-1, width)
    # From the left a later value must be less to be taken, from the right it may be equal.
    new = np.ones(grid.shape, bool)
    new[:, 1:] = grid[:, 1:] < np.minimum.accumulate(grid, axis=1)[:, :-1]
    left = np.maximum.accumulate(np.where(new, at, 0), axis=1).ravel()
    back = grid[:, ::-1]
    new[:, 1:] = back[:, 1:] <= np.minimum.accumulate(back, axis=1)[:, :-1]
    right = np.minimum.accumulate(np.where(new, at[:, ::-1], grid.size), axis=1)[:, ::-1].ravel()
    a, b = right[:n], left[width - 1 : width - 1 + n]
    return np.where(values[a] <= values[b], a, b)


def anchors(data: np.ndarray, offsets: np.ndarray, length: int, key: int) -> tuple[np.ndarray, ...]:
    """Of every anchor of a block: text, begin and end of its context in the text, key and context hash."""
    none = (np.zeros(0, I64),) * 5
    if len(data) < length:
        return none
    hashes = Hasher(data)
    at = np.arange(len(data) - key + 1)
    keys = hashes(at, at + key)
    # All bits of a key count, and the first of equal ones wins, so an anchor depends on its string alone.
    least = _first_least(keys, length - key + 1)
    # Starts of strings that don't leave their text; starts of one anchor follow each other.
    starts = np.concatenate([np.arange(a, b - length + 1) for a, b in zip(offsets[:-1], offsets[1:])])
    if not len(starts):
        return none
    places = least[starts]
    new = np.flatnonzero(np.append(True, places[1:] != places[:-1]))
    places, begin = places[new], starts[new]
    end = starts[np.append(new[1:], len(starts)) - 1] + length
    text = np.searchsorted(offsets, places, side="right") - 1
    context = mix(hashes(begin, end) + (places - begin).astype(U64) * U64(0xD6E8FEB86659FD93))
    base = offsets[text]
    return text, begin - base, end - base, keys[places].view(I64), context.view(I64)


def _anchor_rows(batches: Iterator[pa.RecordBatch], length: int, key: int) -> Iterator[pa.RecordBatch]:
    for block in blocks(batches):
        text, begin, end, keys, contexts = anchors(block.data, block.offsets, length, key)
        yield pa.RecordBatch.from_arrays(
            [
                block.rows.column("row").take(pa.array(text)),
                *map(pa.array, (begin.astype(np.int32), end.astype(np.int32), keys, contexts)),
            ],
            ["row", "begin", "end", "key", "context"],
        )


def _context_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the wanted contexts of every text."""
    for block in blocks(batches):
        wanted = block.rows.column("wanted")
        counts = np.diff(wanted.offsets.to_numpy())
        text = np.repeat(np.arange(len(counts)), counts)
        picked = wanted.values.slice(wanted.offsets[0].as_py(), len(text))
        begin, end = (picked.field(n).to_numpy().astype(I64) + block.offsets[text] for n in ("begin", "end"))
        raw = block.data.tobytes()
        yield pa.RecordBatch.from_arrays(
            [
                picked.field("key"),
                picked.field("contexts"),
                block.rows.column("row").take(pa.array(text)),
                picked.field("begin"),
                pa.array([raw[a:b] for a, b in zip(begin.tolist(), end.tolist())], pa.binary()),
            ],
            ["key", "contexts", "row", "begin", "bytes"],
        )


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Whole groups of (key, salt), some SHARD_BYTES together."""
    held, size = [], 0
    for group in runs(batches, ["key", "salt"]):
        held.append(group)
        size += group.nbytes
        if size >= SHARD_BYTES:
            yield pa.concat_tables(held)
            held, size = [], 0
    if held:
        yield pa.concat_tables(held)


def _spans(rows: np.ndarray, starts: np.ndarray, length: int) -> pa.RecordBatch:
    """Runs of window starts as spans (row, start, end)."""
    order = np.lexsort((starts, rows))
    rows, starts = rows[order], starts[order]
    first = np.ones(len(rows), bool)
    first[1:] = (rows[1:] != rows[:-1]) | (starts[1:] - starts[:-1] > length)
    at = np.flatnonzero(first)
    last = np.append(at[1:], len(rows)) - 1
    return pa.RecordBatch.from_arrays(
        [pa.array(rows[at]), pa.array(starts[at].astype(np.int32)), pa.array((starts[last] + length).astype(np.int32))],
        ["row", "start", "end"],
    )


SPANS = "row bigint, start int, end int"
LISTS = "key bigint, part int, parts int, shard int, hashes binary, rows binary, starts binary"


def _refined(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Spans of repeats inside the shards, and lists of what shards of one key must look up in each other.

    Lists and spans share a schema; a list has parts, a span has none.
    """
    for shard in _shards(batches):
        texts = shard.column("bytes").to_pylist()
        sizes = np.fromiter(map(len, texts), I64, len(texts))
        data = np.frombuffer(b"".join(texts), np.uint8)
        keys, left = packed(data), remaining(sizes)
        order = suffix_array(keys, left, length)
        if not len(order):
            continue
        shared = common_prefixes(data, keys, sizes, order, length)
        context = np.repeat(np.arange(len(sizes)), sizes)[order]
        row = shard.column("row").to_numpy()[context]
        start = shard.column("begin").to_numpy()[context] + order - (np.cumsum(sizes) - sizes)[context]
        # A run of common prefixes is one string; it repeats if it has two places.
        begins = np.flatnonzero(shared < length)
        place = mix(row.view(U64)) + start.astype(U64)
        two = np.minimum.reduceat(place, begins) != np.maximum.reduceat(place, begins)
        repeated = np.repeat(two, np.diff(np.append(begins, len(order))))
        if repeated.any():
            spans = _spans(row[repeated], start[repeated], length)
            yield _both(spans=spans)
        salts = shard.column("salts").to_numpy()[context]
        if salts.max() > 1:
            yield from _lists(shard, context, begins, data, order, row, start, length)


def _both(spans: pa.RecordBatch | None = None, lists: pa.RecordBatch | None = None) -> pa.RecordBatch:
    n = (spans or lists).num_rows
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    columns, names = [], []
    for source, schema in ((spans, SPANS), (lists, LISTS)):
        for name, kind in (field.split() for field in schema.split(", ")):
            names.append(name)
            columns.append(source.column(name) if source is not None else pa.nulls(n, kinds[kind]))
    return pa.RecordBatch.from_arrays(columns, names)


def _lists(shard, context, begins, data, order, row, start, length) -> Iterator[pa.RecordBatch]:
    """One place per string and salted key, sorted by hash and cut by ranges of the hash."""
    # Every string of the shard once; others of its run are repeats already.
    one = order[begins]
    hashes = Hasher(data)(one, one + length)
    of = context[begins]
    key, salt, salts = (shard.column(n).to_numpy()[of] for n in ("key", "salt", "salts"))
    rows = []
    for k in np.unique(key[salts > 1]):
        mine = np.flatnonzero(key == k)
        mine = mine[np.argsort(hashes[mine], kind="stable")]
        parts = int(salts[mine[0]])
        part = (hashes[mine] >> U64(32)).astype(I64) * parts >> 32
        for p in np.unique(part):
            here = mine[part == p]
            rows.append(
                (int(k), int(p), parts, int(salt[here[0]]), hashes[here].tobytes(), row[begins][here].tobytes(), start[begins][here].astype(I64).tobytes())
            )
    if rows:
        columns = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()))]
        yield _both(lists=pa.RecordBatch.from_arrays(columns, ["key", "part", "parts", "shard", "hashes", "rows", "starts"]))


def _merged(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Strings that two or more shards of a key have, by binary search in each other's lists."""
    for table in runs(batches, ["key", "part"]):
        lists = [
            tuple(np.frombuffer(table.column(c)[i].as_buffer(), t) for c, t in (("hashes", U64), ("rows", I64), ("starts", I64)))
            for i in range(table.num_rows)
        ]
        seen = np.unique(np.concatenate([h for h, _, _ in lists]))
        count = np.zeros(len(seen), np.int32)
        for hashes, _, _ in lists:
            count[np.unique(np.searchsorted(seen, hashes))] += 1
        found = [(rows[hit], starts[hit]) for hashes, rows, starts in lists if (hit := count[np.searchsorted(seen, hashes)] > 1).any()]
        if found:
            yield _spans(np.concatenate([r for r, _ in found]), np.concatenate([s for _, s in found]), length)


def repeated_spans(docs: DataFrame, length: int = LENGTH, key: int = KEY, shard_contexts: int = SHARD_CONTEXTS) -> DataFrame:
    """row and spans, an array of (start, end), of rows (row, text) with repeated passages.

    Spans may overlap.
    """
    found = materialize(
        map_arrow(
            docs, partial(_anchor_rows, length=length, key=key), "row bigint, begin int, end int, key bigint, context bigint"
        ),
        "places",
    )
    # Stored, so that both sides of the join are plain exchanges and a hot key's rows can be split.
    often = materialize(found.groupBy("key").count().where("count > 1").select("key"), "often")
    shared = materialize(found.join(often.hint("merge"), "key"), "anchors")
    classes = materialize(
        shared.groupBy("key", "context").agg(
            F.count(F.lit(1)).alias("n"), F.min(F.struct("row", "begin", "end")).alias("one")
        ),
        "contexts",
    )
    whole = shared.join(classes.where("n > 1").select("key", "context"), ["key", "context"]).select(
        "row", F.col("begin").alias("start"), "end"
    )
    mixed = classes.groupBy("key").agg(F.count(F.lit(1)).alias("contexts")).where("contexts > 1")
    wanted = (
        classes.join(mixed, "key")
        .select("one.row", F.struct("key", F.col("contexts").cast("int").alias("contexts"), "one.begin", "one.end").alias("anchor"))
        .groupBy("row")
        .agg(F.collect_list("anchor").alias("wanted"))
    )
    salts = F.ceil(F.col("contexts") / shard_contexts).cast("int")
    contexts = (
        map_arrow(
            docs.join(wanted.hint("merge"), "row"),
            _context_rows,
            "key bigint, contexts int, row bigint, begin int, bytes binary",
        )
        .withColumn("salts", salts)
        .withColumn("salt", F.pmod(F.xxhash64("row", "begin"), F.col("salts")).cast("int"))
    )
    refined = materialize(
        map_arrow(
            contexts.repartition("key", "salt").sortWithinPartitions("key", "salt"),
            partial(_refined, length=length),
            f"{SPANS}, {LISTS}",
        ),
        "refined",
    )
    lists = refined.where("parts IS NOT NULL").select("key", "part", "hashes", "rows", "starts")
    merged = map_arrow(
        lists.repartition("key", "part").sortWithinPartitions("key", "part"), partial(_merged, length=length), SPANS
    )
    spans = whole.unionByName(refined.where("parts IS NULL").select("row", "start", "end")).unionByName(merged)
    return spans.groupBy("row").agg(F.collect_set(F.struct("start", "end")).alias("spans"))


def _cut(batches: Iterator[pa.RecordBatch], text: bool) -> Iterator[pa.RecordBatch]:
    for block in blocks(batches):
        out = []
        for spans, a, b in zip(block.rows.column("spans").to_pylist(), block.offsets[:-1], block.offsets[1:]):
            raw, parts, at, removed, n = block.data[a:b].tobytes(), [], 0, 0, 0
            reach = 0
            for start, end in sorted((s["start"], s["end"]) for s in spans or []):
                if not n or start > reach:
                    parts.append(raw[at:start])
                    n, reach, removed = n + 1, end, removed + end - start
                elif end > reach:
                    removed, reach = removed + end - reach, end
                at = reach
            parts.append(raw[at:])
            kept = b"".join(parts)
            out.append((len(raw), removed, n, hashlib.sha256(kept).hexdigest(), kept.decode(errors="ignore") if text else None))
        columns = list(zip(*out))
        yield pa.RecordBatch.from_arrays(
            [
                block.rows.column("doc_id"),
                *[pa.array(c, pa.int64()) for c in columns[:3]],
                pa.array(columns[3], pa.string()),
                pa.array(columns[4], pa.string()),
                block.rows.column("carried"),
            ],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text", "carried"],
        )


def without_repeats(
    docs: DataFrame,
    length: int = LENGTH,
    key: int = KEY,
    shard_contexts: int = SHARD_CONTEXTS,
    text: bool = False,
    carried: list[str] | None = None,
) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row of (doc_id, text).

    Bytes are those of UTF-8; a null text is empty, and texts under ``length``
    bytes keep all.  Two equal rows are two documents.  With ``text`` there is
    kept_text too; a cut may split a character, of which kept_text leaves out the
    rest while the other columns count it.  doc_id may be null.  Columns named in
    ``carried`` are passed on, others are ignored.
    """
    others = [F.col(f"`{c}`") for c in carried or []]
    docs = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.struct(F.lit(None).cast("int").alias("none"), *others).alias("carried"),
    ).withColumn("row", F.xxhash64("doc_id", "text"))
    spans = repeated_spans(docs.select("row", "text"), length, key, shard_contexts)
    out = map_arrow(
        docs.join(spans.hint("merge"), "row", "left").select("doc_id", "text", "spans", "carried"),
        partial(_cut, text=text),
        "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept_text string, "
        f"carried {docs.schema['carried'].dataType.simpleString()}",
    )
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", *["kept_text"] * text]
    return out.select(*names, *[F.col(f"carried.`{c}`") for c in carried or []])
