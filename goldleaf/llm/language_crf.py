"""Language identification by a linear-chain conditional random field over words.

Every word gets a language, so that code-switched text can be told apart; the
language of a text is the one with most letters.  A word's features are the word
itself, its beginnings and ends, its letter n-grams, and whether a lexicon has
it; transitions between languages are learned with them.  Labelled texts have
one language each, so the training sequences are cut and mixed from them.

Probabilities come from the forward-backward algorithm, exactly and without a
loop over the words of a text: the words are laid out in short rows, the
transfer matrices of all rows are multiplied at once, a pass over the rows of the
texts gives what enters each row from either side, and a second pass over the
rows gives every word's marginals.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldleaf.llm.blocks import Block, Hasher, blocks, mix
from goldleaf.llm.byte_bpe import LETTER, kinds
from goldleaf.llm.tasks import map_arrow

FIT_ROWS = 400  # texts of each language
SEQUENCES, SEQUENCE_WORDS = 3_000, 48
SWITCH = 0.12  # chance that the mixed text goes on with another language
HASH_BITS = 18
BEGINNINGS, ENDS, NGRAMS = (1, 2, 3), (1, 2, 3, 4), (2, 3)
LEXICON_COUNT, LEXICON_SHARE = 3, 0.9
STEPS, RIDGE = 60, 1e-4
ROW = 32
UNDETERMINED = "und"

U64 = np.uint64


@lru_cache(1)
def lower_points() -> np.ndarray:
    """The lower-case code point of every code point, where that is a single one."""
    table = np.arange(0x110000, dtype=np.uint32)
    for c in range(0x110000):
        low = chr(c).lower()
        if len(low) == 1:
            table[c] = ord(low)
    return table


class Words(NamedTuple):
    """Words of the texts of a block: runs of letters, in code points of the block."""

    points: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    firsts: np.ndarray  # the first word of every text, one more than texts
    bases: np.ndarray  # the first code point of every text, one more than texts


def find_words(block: Block) -> Words:
    points = np.frombuffer(block.data.tobytes().decode().encode("utf-32-le"), np.uint32)
    bases = np.append(0, np.cumsum((block.data & 0xC0) != 0x80))[block.offsets]
    inside = kinds()[points] == LETTER
    first = np.zeros(len(points) + 1, bool)
    first[bases] = True
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1] | first[1:-1]
    ends[:-1] &= ~inside[1:] | first[1:-1]
    starts = np.flatnonzero(starts)
    return Words(lower_points()[points], starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, bases), bases)


def word_features(hashes: Hasher, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word number and hashed feature: the word, its beginnings, ends and n-grams."""
    number = np.arange(len(starts))
    sizes = ends - starts
    parts = [(number, hashes(starts, ends))]
    for k in BEGINNINGS:
        n = number[sizes > k]
        parts.append((n, hashes(starts[n], starts[n] + k) + U64(101 * k)))
    for k in ENDS:
        n = number[sizes > k]
        parts.append((n, hashes(ends[n] - k, ends[n]) + U64(1009 * k)))
    for k in NGRAMS:
        counts = np.maximum(sizes - k + 1, 0)
        n = np.repeat(number, counts)
        at = starts[n] + np.arange(len(n)) - np.repeat(np.cumsum(counts) - counts, counts)
        parts.append((n, hashes(at, at + k)))
    numbers = np.concatenate([n for n, _ in parts])
    found = (mix(np.concatenate([f for _, f in parts])) >> U64(64 - HASH_BITS)).astype(np.int64)
    order = np.argsort(numbers, kind="stable")
    return numbers[order], found[order]


class Model(NamedTuple):
    languages: list[str]
    weights: np.ndarray  # feature x language; the last rows are those of the lexicon
    transitions: np.ndarray  # from x to
    lexicon: np.ndarray  # hashes of words, sorted
    lexicon_of: np.ndarray  # language of each


def _lexicon_feature(model_lexicon: np.ndarray, lexicon_of: np.ndarray, words: np.ndarray) -> np.ndarray:
    """The lexicon's language of every word, or -1."""
    if not len(model_lexicon):
        return np.full(len(words), -1)
    at = np.minimum(np.searchsorted(model_lexicon, words), len(model_lexicon) - 1)
    return np.where(model_lexicon[at] == words, lexicon_of[at], -1)


def emissions(model: Model, words: Words) -> np.ndarray:
    """Score of every language for every word; equal words are scored once."""
    hashes = Hasher(words.points)
    whole = hashes(words.starts, words.ends)
    unlike, one, which = np.unique(whole, return_index=True, return_inverse=True)
    number, found = word_features(hashes, words.starts[one], words.ends[one])
    scores = np.add.reduceat(model.weights[found], np.searchsorted(number, np.arange(len(one))), axis=0)
    known = _lexicon_feature(model.lexicon, model.lexicon_of, unlike)
    scores[known >= 0] += model.weights[(1 << HASH_BITS) + known[known >= 0]]
    return scores[which]


def _row_normal(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(x.sum(axis=-1, keepdims=True), 1e-300)


def marginals(model: Model, scores: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Probability of every language for every word, by forward-backward over each text."""
    n, width = scores.shape
    factors = np.exp(scores - scores.max(axis=1, keepdims=True))
    step = np.exp(model.transitions - model.transitions.max())
    counts = np.diff(firsts)
    rows = -(-counts // ROW)
    first_row = np.append(0, np.cumsum(rows))
    # Words of a row that is not full leave everything as it is: factor 1, no transition.
    text = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(n) - firsts[:-1][text]
    row, column = first_row[:-1][text] + place // ROW, place % ROW
    total = int(first_row[-1])
    grid = np.ones((ROW, total, width))
    grid[column, row] = factors
    there = np.zeros((ROW, total), bool)
    there[column, row] = True
    # A text's first word has no transition.
    free = first_row[:-1][counts > 0]
    # Transfer matrices: into a word by a transition, then its factor.
    transfer = np.tile(np.eye(width), (total, 1, 1))
    for k in range(ROW):
        moved = (transfer.reshape(-1, width) @ step).reshape(total, width, width)
        if k == 0:
            moved[free] = transfer[free]
        moved *= grid[k][:, None, :]
        moved /= np.maximum(moved.sum(axis=(1, 2), keepdims=True), 1e-300)
        transfer = np.where(there[k][:, None, None], moved, transfer)
    entering, leaving = np.ones((total, width)), np.ones((total, width))
    longest = int(rows.max()) if len(rows) else 0
    active = np.flatnonzero(rows)
    state = np.ones((len(counts), width))
    for k in range(longest):
        active = active[rows[active] > k]
        at = first_row[active] + k
        entering[at] = state[active]
        state[active] = _row_normal(np.einsum("ni,nij->nj", state[active], transfer[at]))
    state = np.ones((len(counts), width))
    active = np.flatnonzero(rows)
    for k in range(longest):
        active = active[rows[active] > k]
        at = first_row[active] + rows[active] - 1 - k
        leaving[at] = state[active]
        state[active] = _row_normal(np.einsum("nij,nj->ni", transfer[at], state[active]))
    forward = np.empty((ROW, total, width))
    state = entering
    for k in range(ROW):
        moved = state @ step
        if k == 0:
            moved[free] = state[free]
        state = np.where(there[k][:, None], _row_normal(moved * grid[k]), state)
        forward[k] = state
    out = np.empty((ROW, total, width))
    state = leaving
    for k in range(ROW - 1, -1, -1):
        out[k] = _row_normal(forward[k] * state)
        moved = _row_normal((state * grid[k]) @ step.T)
        state = np.where(there[k][:, None], moved, state)
    return out[column, row]


# ---- training ---------------------------------------------------------------
def mixed_sequences(texts: list[Words], language: np.ndarray, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Text and word number of the words of SEQUENCES mixed sequences.

    A sequence follows one text; at every word it goes on, with chance SWITCH,
    somewhere in a text of another language.
    """
    random = np.random.default_rng(seed)
    usable = [np.flatnonzero((language == y) & [len(t.starts) > 0 for t in texts]) for y in range(language.max() + 1)]
    usable = [u for u in usable if len(u)]
    chosen = np.empty((SEQUENCES, SEQUENCE_WORDS, 2), np.int64)
    for s in range(SEQUENCES):
        y = random.integers(len(usable))
        text, at = -1, 0
        for k in range(SEQUENCE_WORDS):
            fresh = text < 0 or at >= len(texts[text].starts)
            if k and len(usable) > 1 and random.random() < SWITCH:
                y, fresh = (y + 1 + random.integers(len(usable) - 1)) % len(usable), True
            if fresh:
                text = int(random.choice(usable[y]))
                at = int(random.integers(len(texts[text].starts)))
            chosen[s, k] = text, at
            at += 1
    return chosen[:, :, 0], chosen[:, :, 1]


def fit(texts: list[str], labels: list[str]) -> Model:
    """The model of labelled texts, by AdaGrad on the exact gradient."""
    languages = sorted(set(labels))
    language = np.array([languages.index(y) for y in labels])
    width = len(languages)
    body = pa.array(texts)
    block = next(blocks(iter([pa.RecordBatch.from_arrays([body], ["text"])]), 1 << 62))
    words = find_words(block)
    per_text = [
        Words(words.points, words.starts[a:b], words.ends[a:b], words.firsts, words.bases)
        for a, b in zip(words.firsts[:-1], words.firsts[1:])
    ]
    hashes = Hasher(words.points)
    whole = hashes(words.starts, words.ends)
    of_word = np.repeat(language, np.diff(words.firsts))
    unlike, one, which = np.unique(whole, return_index=True, return_inverse=True)
    counts = np.bincount(which * width + of_word, minlength=len(unlike) * width).reshape(-1, width)
    total = counts.sum(axis=1)
    sure = (total >= LEXICON_COUNT) & (counts.max(axis=1) >= LEXICON_SHARE * total)
    lexicon, lexicon_of = unlike[sure], counts[sure].argmax(axis=1)

    text, at = mixed_sequences(per_text, language)
    word = which[words.firsts[text] + at]
    gold = language[text]
    used, word = np.unique(word, return_inverse=True)
    word = word.reshape(gold.shape)
    number, found = word_features(hashes, words.starts[one[used]], words.ends[one[used]])
    known = _lexicon_feature(lexicon, lexicon_of, unlike[used])
    extra = np.flatnonzero(known >= 0)
    number, found = np.append(number, extra), np.append(found, (1 << HASH_BITS) + known[extra])
    order = np.argsort(number, kind="stable")
    number, found = number[order], found[order]
    begins = np.searchsorted(number, np.arange(len(used)))

    n_features = (1 << HASH_BITS) + width
    weights, transitions = np.zeros((n_features, width)), np.zeros((width, width))
    square_w, square_t = np.full((n_features, width), 1e-6), np.full((width, width), 1e-6)
    hot = np.eye(width)[gold]
    seen_t = np.einsum("ski,skj->ij", hot[:, :-1], hot[:, 1:])
    for _ in range(STEPS):
        scores = np.add.reduceat(weights[found], begins, axis=0)[word]
        factors = np.exp(scores - scores.max(axis=2, keepdims=True))
        step = np.exp(transitions - transitions.max())
        forward, backward = np.empty_like(factors), np.ones_like(factors)
        forward[:, 0] = _row_normal(factors[:, 0])
        for k in range(1, SEQUENCE_WORDS):
            forward[:, k] = _row_normal((forward[:, k - 1] @ step) * factors[:, k])
        for k in range(SEQUENCE_WORDS - 2, -1, -1):
            backward[:, k] = _row_normal((backward[:, k + 1] * factors[:, k + 1]) @ step.T)
        expected = _row_normal(forward * backward)
        pair = forward[:, :-1, :, None] * step * (factors[:, 1:] * backward[:, 1:])[:, :, None, :]
        pair /= np.maximum(pair.sum(axis=(2, 3), keepdims=True), 1e-300)
        wrong = (expected - hot).reshape(-1, width)
        by_word = np.stack([np.bincount(word.ravel(), wrong[:, y], len(used)) for y in range(width)], axis=1)
        slope = np.stack([np.bincount(found, by_word[number, y], n_features) for y in range(width)], axis=1)
        slope = slope / SEQUENCES + RIDGE * weights
        slope_t = (pair.sum(axis=(0, 1)) - seen_t) / SEQUENCES + RIDGE * transitions
        square_w += slope**2
        square_t += slope_t**2
        weights -= 0.3 * slope / np.sqrt(square_w)
        transitions -= 0.3 * slope_t / np.sqrt(square_t)
    return Model(languages, weights.astype(np.float32), transitions, lexicon, lexicon_of)


def train(docs: DataFrame, fit_rows: int = FIT_ROWS) -> Model | None:
    """The model of (doc_id, text, lang), from about ``fit_rows`` texts of each language, drawn by a hash of doc_id.

    At most twice as many are read to the driver.  Rows without any of the three
    are left out; without rows there is no model.
    """
    labelled = docs.where("doc_id IS NOT NULL AND text IS NOT NULL AND lang IS NOT NULL").select("doc_id", "text", "lang")
    counts = dict(labelled.groupBy("lang").count().collect())
    place = F.xxhash64("doc_id", F.lit(41)) / F.lit(float(1 << 63))
    rows = []
    for language in sorted(counts):
        share = min(1.0, 1.2 * fit_rows / counts[language])
        rows.append(labelled.where((F.col("lang") == language) & (place < 2 * share - 1)).limit(2 * fit_rows))
    if not rows:
        return None
    sample = rows[0]
    for other in rows[1:]:
        sample = sample.unionByName(other)
    drawn = sample.toPandas().sort_values(["lang", "doc_id", "text"], kind="stable").groupby("lang").head(fit_rows)
    drawn = drawn[[any(c.isalpha() for c in t) for t in drawn["text"]]]
    return fit(drawn["text"].tolist(), drawn["lang"].tolist()) if len(drawn) else None


# ---- prediction -------------------------------------------------------------
def _predicted(batches: Iterator[pa.RecordBatch], model: Model | None, spans: bool) -> Iterator[pa.RecordBatch]:
    for block in blocks(batches):
        n = len(block.offsets) - 1
        words = find_words(block)
        names = [*(model.languages if model else []), UNDETERMINED]
        shares = np.zeros((n, len(names)))
        chances = np.zeros((0, len(names) - 1))
        if model and len(words.starts):
            chances = marginals(model, emissions(model, words), words.firsts)
            text = np.repeat(np.arange(n), np.diff(words.firsts))
            letters = (words.ends - words.starts).astype(float)
            for y in range(len(model.languages)):
                shares[:, y] = np.bincount(text, letters * chances[:, y], n)
        total = shares.sum(axis=1)
        shares = shares / np.where(total > 0, total, 1)[:, None]
        best = np.where(total > 0, shares.argmax(axis=1), len(names) - 1)
        columns = [
            block.rows.column("doc_id"),
            pa.array([names[b] for b in best]),
            pa.array(np.clip(shares[np.arange(n), best], 0, 1)),
        ]
        fields = ["doc_id", "lang_pred", "score"]
        if spans:
            columns.append(_spans(words, chances, names))
            fields.append("spans")
        yield pa.RecordBatch.from_arrays(columns, fields)


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))


def _spans(words: Words, chances: np.ndarray, names: list[str]) -> pa.Array:
    """Runs of words of one language of every text, in code points of the text."""
    label = chances.argmax(axis=1) if len(chances) else np.full(len(words.starts), len(names) - 1)
    out = []
    for a, b, base in zip(words.firsts[:-1], words.firsts[1:], words.bases[:-1]):
        cuts = np.flatnonzero(np.diff(label[a:b])) + a + 1
        edges = [a, *cuts.tolist(), b] if b > a else [a]
        out.append(
            [
                {"start": int(words.starts[i] - base), "end": int(words.ends[j - 1] - base), "lang": names[label[i]]}
                for i, j in zip(edges[:-1], edges[1:])
            ]
        )
    return pa.array(out, SPANS)


def predict(docs: DataFrame, model: Model | None, spans: bool = False) -> DataFrame:
    """doc_id, lang_pred, score of every row of (doc_id, text), and the spans of the languages if wanted.

    ``lang_pred`` is the language with the largest expected share of letters and
    ``score`` that share.  A text that is null or has no letters is ``und`` with
    score 0, and so is every text without a model.  Rows that repeat get the same
    result; doc_id may be null; other columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id bigint, lang_pred string, score double"
    if spans:
        schema += ", spans array<struct<start: bigint, end: bigint, lang: string>>"
    return map_arrow(docs, partial(_predicted, model=model, spans=spans), schema)
