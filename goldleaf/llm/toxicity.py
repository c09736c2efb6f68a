"""A toxicity classifier that is trained not to react to who is mentioned.

A logistic model over words and their first letters, as hashed features that
are present or not.  Every labelled text in which a group is mentioned gets a
counterfactual, the same text with each identity term swapped for the next of
its group, and the training penalises the squared change of the score between
the two.  So a term that is frequent in toxic texts carries no weight by itself.

Training uses a bounded sample of labelled texts, FIT_ROWS of each class, drawn
by a hash of doc_id; scoring reads every text as a whole, in one scan.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldleaf.llm.bitmaps import possible
from goldleaf.llm.blocks import Block, Hasher, blocks, lower_ascii
from goldleaf.llm.tasks import map_arrow

FIT_ROWS = 3_000
HASH_BITS = 22
PREFIXES = range(3, 9)
FEWEST_TEXTS = 4
EVIDENCE = 3.0  # standard errors of a feature's log odds
PENALTY = 1.0
RIDGE = 0.002
TOXIC_WEIGHT = 3.0  # a missed toxic text costs as much as so many false alarms
STEPS = 200

# Terms that name groups of people, by group; a term is swapped for the next one.
IDENTITY_TERMS = [
    ["women", "men"], ["woman", "man"], ["girls", "boys"], ["female", "male"],
    ["muslim", "christian", "jewish", "hindu", "buddhist", "atheist"],
    ["muslims", "christians", "jews", "hindus", "buddhists", "atheists"],
    ["black", "white", "asian", "latino", "african", "european"],
    ["gay", "straight", "lesbian", "bisexual", "transgender", "queer"],
    ["immigrants", "natives", "refugees", "foreigners"],
    ["deaf", "blind", "disabled"], ["old", "young"],
    ["frauen", "männer"], ["frau", "mann"], ["muslime", "christen", "juden"], ["ausländer", "einheimische"],
    ["femmes", "hommes"], ["femme", "homme"], ["musulmans", "chrétiens", "juifs"], ["immigrés", "étrangers"],
    ["mujeres", "hombres"], ["mujer", "hombre"], ["musulmanes", "cristianos", "judíos"], ["inmigrantes", "extranjeros"],
]


def _next_terms(groups: list[list[str]]) -> dict[str, str]:
    return {term: group[(k + 1) % len(group)] for group in groups for k, term in enumerate(group)}


def swapped(text: str, following: dict[str, str]) -> str | None:
    """The text with every identity term swapped, or None if it has none."""
    found = False

    def swap(match: regex.Match) -> str:
        nonlocal found
        other = following.get(match[0].lower())
        found |= other is not None
        return match[0] if other is None else other

    out = regex.sub(r"\p{L}+", swap, text)
    return out if found else None


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Text and feature of every word and word beginning; features repeat.

    A word is a run of letters: a-z, A-Z, and all characters beyond ASCII.
    """
    data = lower_ascii(data)
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = ((data >= 97) & (data <= 122)) | (data >= 128)
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1] | first[1:-1]
    ends[:-1] &= ~inside[1:] | first[1:-1]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    hashes = Hasher(data)
    text = np.searchsorted(offsets, starts, side="right") - 1
    mask = np.uint64((1 << HASH_BITS) - 1)
    begins = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
    character = np.searchsorted(begins, starts)
    texts, found = [text], [hashes(starts, ends) & mask]
    for k in PREFIXES:
        stop = begins[np.minimum(character + k, len(begins) - 1)]
        here = stop < ends
        texts.append(text[here])
        found.append((hashes(starts[here], stop[here]) + np.uint64(0x51ED270B)) & mask)
    return np.concatenate(texts), np.concatenate(found).astype(np.int64)


class Model(NamedTuple):
    column: np.ndarray  # of a feature, or -1
    weights: np.ndarray
    bias: float


def _matrix(batches: Iterator[pa.RecordBatch], following: dict[str, str]) -> Iterator[pa.RecordBatch]:
    """Distinct features of every text and of its counterfactual."""

    def lists(block: Block) -> list[np.ndarray]:
        text, found = features(block.data, block.offsets)
        pairs = np.unique(text << HASH_BITS | found)
        cuts = np.searchsorted(pairs, np.arange(len(block.offsets)) << HASH_BITS)
        found = (pairs & ((1 << HASH_BITS) - 1)).astype(np.int32)
        return [found[a:b] for a, b in zip(cuts[:-1], cuts[1:])]

    for block in blocks(batches):
        others = [swapped(t, following) for t in block.strings()]
        other_rows = pa.RecordBatch.from_arrays([pa.array([t or "" for t in others])], ["text"])
        changed = [x for b in blocks(iter([other_rows]), 1 << 62) for x in lists(b)]
        yield pa.RecordBatch.from_arrays(
            [
                block.rows.column("toxic"),
                pa.array([x.tobytes() for x in lists(block)], pa.binary()),
                pa.array([None if o is None else x.tobytes() for o, x in zip(others, changed)], pa.binary()),
            ],
            ["toxic", "features", "changed"],
        )


class _Rows:
    """Sparse 0/1 rows over the chosen columns."""

    def __init__(self, rows: list[np.ndarray], column: np.ndarray) -> None:
        chosen = [c[c >= 0] for c in (column[r] for r in rows)]
        self.row = np.repeat(np.arange(len(rows)), [len(c) for c in chosen])
        self.col = np.concatenate(chosen) if chosen else np.zeros(0, np.int64)
        self.n = len(rows)

    def dot(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights[self.col], self.n)

    def back(self, values: np.ndarray, width: int) -> np.ndarray:
        return np.bincount(self.col, values[self.row], width)


def fit(
    toxic: np.ndarray, rows: list[np.ndarray], changed: list[np.ndarray | None], prior: float, penalty: float = PENALTY
) -> Model:
    """The model of sampled rows; ``prior`` is the share of toxic ones among all labelled.

    Features count that FEWEST_TEXTS have and whose log odds are EVIDENCE standard errors from none.
    """
    width = 1 << HASH_BITS
    with_toxic = np.bincount(np.concatenate([np.zeros(0, int), *[r for r, t in zip(rows, toxic) if t]]), minlength=width)
    without = np.bincount(np.concatenate([np.zeros(0, int), *[r for r, t in zip(rows, toxic) if not t]]), minlength=width)
    n1, n0 = max(int(toxic.sum()), 1), max(int((~toxic).sum()), 1)
    a, b = with_toxic + 0.5, without + 0.5
    odds = np.log(a / (n1 + 1 - a)) - np.log(b / (n0 + 1 - b))
    error = np.sqrt(1 / a + 1 / b + 1 / (n1 + 1 - a) + 1 / (n0 + 1 - b))
    chosen = np.flatnonzero((with_toxic + without >= FEWEST_TEXTS) & (np.abs(odds) > EVIDENCE * error))
    column = np.full(width, -1, np.int64)
    column[chosen] = np.arange(len(chosen))
    x = _Rows(rows, column)
    pairs = [(r, c) for r, c in zip(rows, changed) if c is not None]
    one, two = _Rows([r for r, _ in pairs], column), _Rows([c for _, c in pairs], column)
    weights, bias, k = np.zeros(len(chosen)), 0.0, len(chosen)
    target = toxic.astype(float)
    squares, square = np.full(k, 1e-8), 1e-8
    for _ in range(STEPS):
        wrong = 1 / (1 + np.exp(-np.clip(x.dot(weights) + bias, -30, 30))) - target
        slope = x.back(wrong, k) / max(x.n, 1) + RIDGE * weights
        if pairs:
            change = 2 * penalty * (one.dot(weights) - two.dot(weights)) / one.n
            slope += one.back(change, k) - two.back(change, k)
        squares += slope**2
        weights -= 0.5 * slope / np.sqrt(squares)
        at = wrong.mean() if len(wrong) else 0.0
        square += at**2
        bias -= 0.5 * at / np.sqrt(square)
    prior = min(max(prior, 1e-6), 1 - 1e-6)
    return Model(column, weights, bias + np.log(TOXIC_WEIGHT * prior / (1 - prior)) - np.log(n1 / n0))


def _scored(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for block in blocks(batches):
        text, found = features(block.data, block.offsets)
        column = model.column[found]
        known = np.flatnonzero(column >= 0)
        pairs = np.unique(text[known] * len(model.weights) + column[known])
        n = len(block.offsets) - 1
        width = max(len(model.weights), 1)
        sums = np.bincount(pairs // width, model.weights[pairs % width] if len(pairs) else None, n)
        scores = 1 / (1 + np.exp(-np.clip(sums + model.bias, -30, 30)))
        yield pa.RecordBatch.from_arrays(
            [block.rows.column("doc_id"), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))],
            ["doc_id", "score", "predicted"],
        )


def train(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, groups: list[list[str]] | None = None, penalty: float = PENALTY) -> Model:
    """The model of (doc_id, text) and (doc_id, toxic), of at most ``fit_rows`` texts of each class."""
    marked = (
        labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)")
        .groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
        .agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    )
    counts = dict(marked.groupBy("toxic").count().collect())
    # A draw by hash, a little larger than wanted, and of these the first by hash: the same rows in any run.
    place = F.xxhash64("doc_id", F.lit(17)) / F.lit(float(1 << 63))
    drawn = [
        marked.where((F.col("toxic") == c) & (place < 2.2 * fit_rows / max(counts.get(c, 0), 1) - 1))
        .orderBy(place, "doc_id")
        .limit(fit_rows)
        for c in (0, 1)
    ]
    sample = drawn[0].unionByName(drawn[1])
    ids = docs.select("doc_id", "text")
    rows = possible(ids, sample, "doc_id").join(sample, "doc_id").select("text", "toxic")
    table = map_arrow(
        rows,
        partial(_matrix, following=_next_terms(IDENTITY_TERMS if groups is None else groups)),
        "toxic int, features binary, changed binary",
    ).toPandas()
    # sums of floats depend on the order of the rows
    table = table.iloc[sorted(range(len(table)), key=lambda i: [bytes(x or b"") for x in (table["features"][i], table["changed"][i])])]
    as_row = lambda raw: None if raw is None else np.frombuffer(raw, np.int32)
    return fit(
        table["toxic"].to_numpy().astype(bool),
        [as_row(r) for r in table["features"]],
        [as_row(r) for r in table["changed"]],
        counts.get(1, 0) / max(sum(counts.values()), 1),
        penalty,
    )


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score, predicted of every row of (doc_id, text).

    A null or empty text gets the score of a text without any feature.  Rows that
    repeat get the same score; doc_id may be null; other columns are ignored.
    Without labels all scores are those of the bias alone.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_arrow(docs, partial(_scored, model=model), "doc_id bigint, score double, predicted int")
