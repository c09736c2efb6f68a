"""Vector code compression: product codes found with an integer Walsh-Hadamard transform.

A vector becomes integers and is cut into equal parts; each part is coded by the
nearest entry of its codebook.  Distances are compared after the transform,
which multiplies each squared distance by the padded width: differences are
summed in sequency order, coarse patterns first, and an entry goes as soon as
its sum is over that of a candidate.  All arithmetic is on integers.

A round is one pass of tasks over the vectors.  Each task sends sums and counts
per part and entry, Spark adds them up, and the driver holds the codebooks,
whose size the parameters fix.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldleaf.llm.tasks import map_arrow
from goldleaf.sources.tables import materialize

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
ROWS = 4096  # coded at once
LIMB = 30  # bits of the numbers in which sums travel
LONG = 1 << 63


# ---- the transform ----------------------------------------------------------
def sequency_order(width: int) -> np.ndarray:
    """Places of the Walsh functions in the transform's output, by rising number of sign changes."""
    bits = width.bit_length() - 1
    gray = [s ^ (s >> 1) for s in range(width)]
    return np.array([int(format(g, f"0{bits}b")[::-1], 2) if bits else 0 for g in gray])


def transformed(parts: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of the last axis, padded with zeros to a power of two, in sequency order."""
    width = 1 << max(parts.shape[-1] - 1, 0).bit_length()
    out = np.zeros((*parts.shape[:-1], width), parts.dtype)
    out[..., : parts.shape[-1]] = parts
    step = 1
    while step < width:
        pairs = out.reshape(*parts.shape[:-1], width // (2 * step), 2, step)
        out = np.stack([pairs[..., 0, :] + pairs[..., 1, :], pairs[..., 0, :] - pairs[..., 1, :]], -2).reshape(out.shape)
        step *= 2
    return out[..., sequency_order(width)]


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of every part, the lower index in ties, and the squared distance.

    Both arguments are transformed.  After the first coefficients the entry with
    the least sum is followed to its end; pairs whose sum exceeds that distance
    are dropped from one step to the next, equal ones stay.
    """
    n, width = parts.shape
    step = max(1, width // 4)
    every = np.arange(n)
    sums = ((parts[:, None, :step] - entries[None, :, :step]) ** 2).sum(-1)
    first = sums.argmin(1)
    bound = sums[every, first] + ((parts[:, step:] - entries[first, step:]) ** 2).sum(-1)
    row, entry = np.nonzero(sums <= bound[:, None])
    total = sums[row, entry]
    for at in range(step, width, step):
        total = total + ((parts[row, at : at + step] - entries[entry, at : at + step]) ** 2).sum(-1)
        alive = total <= bound[row]
        row, entry, total = row[alive], entry[alive], total[alive]
    # pairs are in order of row and entry: the first with the row's least sum is its entry
    begins = np.searchsorted(row, every)
    least = np.minimum.reduceat(total, begins) if n else total
    hits = np.flatnonzero(total == least[row])
    chosen = hits[np.searchsorted(row[hits], every)]
    return entry[chosen], least // width


# ---- vectors as integers ----------------------------------------------------
def _integer(x: float) -> int:
    """floor(4096 x) of any finite number; from 2**53 on a number is whole."""
    return math.floor(x * SCALE) if abs(x) < 2.0**53 else int(x) * SCALE


def integers(vectors: pa.Array, width: int, book_most: int = 0) -> np.ndarray:
    """A row of ``width`` integers a vector, zeros behind the end of shorter ones.

    64-bit numbers where neither they nor the codebook can overflow a scaled
    squared distance, Python's numbers otherwise.
    """
    lengths = np.diff(vectors.offsets.to_numpy())
    values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if not (lengths == width).all():
        full = np.zeros((len(lengths), width))
        full[np.arange(width)[None, :] < lengths[:, None]] = values
        values = full.reshape(-1)
    padded = 1 << max(width // PARTS - 1, 0).bit_length()
    # |difference| <= 2 most, times padded under the transform, squared, times padded in the sum
    limit = math.isqrt((LONG - 1) // (4 * padded**3)) - 1
    if float(np.abs(values).max(initial=0.0)) * SCALE < limit and book_most < limit:
        return np.floor(values * SCALE).astype(np.int64).reshape(-1, width)
    return np.array([_integer(x) for x in values.tolist()], object).reshape(-1, width)


def book_most(book: list) -> int:
    return max((abs(x) for part in book for entry in part for x in entry), default=0)


def _coded(batches: Iterator[pa.RecordBatch], book: list, width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, list, list]]:
    """Rows, their parts, and per part the codes and distances."""
    most = book_most(book)
    as_int = [np.array(part, object) for part in book]
    ready: dict[type, list[np.ndarray]] = {}
    for whole in batches:
        for at in range(0, whole.num_rows, ROWS):
            batch = whole.slice(at, ROWS)
            parts = integers(batch.column("vector"), width, most).reshape(batch.num_rows, PARTS, width // PARTS)
            kind = object if parts.dtype == object else np.int64
            if kind not in ready:
                ready[kind] = [transformed(entries.astype(kind)) for entries in as_int]
            lying = transformed(parts)
            found = [nearest(lying[:, p], ready[kind][p]) for p in range(PARTS)]
            yield batch, parts, [codes for codes, _ in found], [far for _, far in found]


def limbs(number: int) -> list[int]:
    """A whole number of any size in base 2**30, the last limb signed."""
    out = []
    while not -(1 << LIMB) <= number < 1 << LIMB:
        out.append(number & ((1 << LIMB) - 1))
        number >>= LIMB
    return [*out, number]


def _sums(batches: Iterator[pa.RecordBatch], book: list, width: int) -> Iterator[pa.RecordBatch]:
    """Counts (position -1) and componentwise sums of the parts at each entry, as limbs."""
    here = width // PARTS
    sums = np.zeros((PARTS, len(book[0]), here + 1), object)
    for _, parts, codes, _ in _coded(batches, book, width):
        for p in range(PARTS):
            add = np.zeros((len(book[p]), here + 1), parts.dtype)
            np.add.at(add, codes[p], np.concatenate([parts[:, p], np.ones((len(parts), 1), parts.dtype)], 1))
            sums[p] += add.astype(object)
    out = [
        (p, e, -1 if x == here else x, limb, value)
        for p, e, x in zip(*np.nonzero(sums))
        for limb, value in enumerate(limbs(int(sums[p, e, x])))
    ]
    if out:
        names = ["part", "entry", "position", "limb", "value"]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=names)


def _codes(batches: Iterator[pa.RecordBatch], book: list, width: int) -> Iterator[pa.RecordBatch]:
    for batch, _, codes, far in _coded(batches, book, width):
        error = sum(d.astype(object) for d in far)
        digits = np.stack(codes, 1)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("vec_id"),
                batch.column("label"),
                pa.array(["".join(f"{c:02x}" for c in row) for row in digits.tolist()], pa.string()),
                pa.array([int(e) if e < LONG else None for e in error], pa.int64()),
            ],
            names=["vec_id", "label", "code", "error"],
        )


# ---- the operator -----------------------------------------------------------
def kept(vector: Column) -> Column:
    """Neither null nor with a null or non-finite component."""
    plain = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(plain, F.lit(False))


def train(vectors: DataFrame, width: int, rounds: int = ROUNDS) -> list:
    """The codebooks: [part][entry][position], from (vec_id, vector) rows."""
    first = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(ENTRIES)
    rows = pa.array([r.vector for r in first.select("vector").collect()], pa.list_(pa.float64()))
    start = integers(rows, width).reshape(len(rows), PARTS, width // PARTS)
    book = [[[int(x) for x in entry] for entry in start[:, p]] for p in range(PARTS)]
    for _ in range(rounds if len(rows) else 0):
        told = map_arrow(
            vectors, partial(_sums, book=book, width=width), "part long, entry long, position long, limb long, value long"
        )
        added: dict[tuple[int, int], dict[int, int]] = {}
        for r in told.groupBy("part", "entry", "position", "limb").agg(F.sum("value").alias("value")).collect():
            at = added.setdefault((r.part, r.entry), {})
            at[r.position] = at.get(r.position, 0) + (r.value << (LIMB * r.limb))
        for (p, e), sums in added.items():
            book[p][e] = [sums.get(x, 0) // sums[-1] for x in range(width // PARTS)]
    return book


def book_sha256(book: list) -> str:
    """Of all components' decimal digits, joined by commas."""
    return hashlib.sha256(",".join(str(x) for part in book for entry in part for x in entry).encode()).hexdigest()


def compress(vectors: DataFrame, rounds: int = ROUNDS, vector: str = "embedding") -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of the rows of (vec_id, vector, label) that are kept.

    A row goes if its vector is null or has a null or non-finite component.
    Repeated rows count as often as they stand; among the first entries, equal
    vec_ids are ordered by vector and null comes last.  Shorter vectors count as
    padded with zeros to the longest one, rounded up to a multiple of the parts.
    With fewer than 16 rows the codebooks are as much shorter.  An error over 64
    bits is null.  Other columns are ignored.
    """
    rows = vectors.select("vec_id", F.col(vector).alias("vector"), "label").where(kept(F.col("vector")))
    longest = rows.agg(F.max(F.size("vector"))).first()[0] or 1
    width = -(-max(longest, 1) // PARTS) * PARTS
    book = train(rows.select("vec_id", "vector"), width, rounds)
    label_type = vectors.schema["label"].dataType.simpleString()
    id_type = vectors.schema["vec_id"].dataType.simpleString()
    coded = materialize(
        map_arrow(
            rows, partial(_codes, book=book, width=width), f"vec_id {id_type}, label {label_type}, code string, error long"
        ),
        "vector-codes",
    )
    # stored, so that a join with a hot label can be split on its other side
    per_label = materialize(
        coded.groupBy(F.col("label").alias("of")).agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("sum")), "label-errors"
    )
    return coded.join(per_label, F.col("label").eqNullSafe(F.col("of")), "left").select(
        "vec_id",
        "code",
        "error",
        F.col("sum").try_cast("bigint").alias("label_error"),
        F.lit(book_sha256(book)).alias("codebooks_sha256"),
    )


def _round_sql(k: int) -> str:
    """Assignment to codebook k, and codebook k + 1."""
    return f"""
far{k} AS MATERIALIZED (
  SELECT id, part, entry, sum((v - c) * (v - c)) AS d FROM comps JOIN book{k} USING (part, pos) GROUP BY ALL),
near{k} AS MATERIALIZED (
  SELECT id, part, min(entry) AS entry, any_value(d) AS d FROM far{k}
  JOIN (SELECT id, part, min(d) AS d FROM far{k} GROUP BY ALL) USING (id, part, d) GROUP BY id, part),
means{k} AS (
  SELECT part, entry, pos, sum(v) AS s, count(*) AS n FROM comps JOIN near{k} USING (id, part) GROUP BY ALL),
book{k + 1} AS MATERIALIZED (
  SELECT part, entry, pos, CASE WHEN n IS NULL THEN c ELSE (s - ((s % n + n) % n)) // n END AS c
  FROM book{k} LEFT JOIN means{k} USING (part, entry, pos)),"""


SQL = f"""
WITH rows_in AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS id, vec_id, label, embedding FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
comps AS MATERIALIZED (
  SELECT id, (i - 1) // (len(embedding) // {PARTS}) AS part, (i - 1) % (len(embedding) // {PARTS}) AS pos,
         CAST(floor({SCALE} * CAST(embedding[i] AS DOUBLE)) AS HUGEINT) AS v
  FROM (SELECT id, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM rows_in)),
book0 AS MATERIALIZED (SELECT part, id - 1 AS entry, pos, v AS c FROM comps WHERE id <= {ENTRIES}),
{"".join(_round_sql(k) for k in range(ROUNDS + 1))}
coded AS (
  SELECT id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d) AS error FROM near{ROUNDS} GROUP BY id),
digest AS (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY part, entry, pos)) AS sha FROM book{ROUNDS})
SELECT vec_id, code, CAST(error AS BIGINT) AS error,
       CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, sha AS codebooks_sha256
FROM rows_in JOIN coded USING (id), digest
"""
