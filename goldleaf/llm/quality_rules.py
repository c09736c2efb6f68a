"""Quality rules as a learned decision list.

Statistics of every text come from one scan.  Rules are learned from the
statistics of labelled documents by sequential covering: a rule grows, one
threshold after another, on two thirds of the rows that no earlier rule covers,
and is pruned on the other third; it joins the list if it is precise enough
there.  The list becomes an ordered conditional expression of Spark.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldleaf.llm.blocks import SHINGLE_WORDS, Hasher, blocks, mix, windows, words
from goldleaf.llm.tasks import map_arrow
from goldleaf.sources.tables import materialize

# Characters counted as symbols.
SYMBOLS = "#*$%&|<>"

FIT_ROWS = 20_000
CUTS = 48
MOST_CONDITIONS = 4
MOST_RULES = 24
PRECISION = 0.97
FEWEST_COVERED = 5

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MORE_COUNTS = ["n_lines", "n_capitals", "n_letters", "n_digits", "n_marks", "n_unlike_words"]
U64 = np.uint64


def _per_text(marks: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(np.append(0, np.cumsum(marks))[offsets])


def statistics(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """COUNTS and MORE_COUNTS of every text of a block."""
    n = len(offsets) - 1
    starts, ends, firsts = words(data, offsets)
    hashes = Hasher(data)
    word = hashes(starts, ends)
    text_of_word = np.repeat(np.arange(n), np.diff(firsts))
    out = {"n_words": np.diff(firsts)}

    inside = np.zeros(len(data) + 1, np.int64)
    np.add.at(inside, starts, 1)
    np.add.at(inside, ends, -1)
    inside = np.cumsum(inside)[:-1] > 0
    out["word_chars"] = _per_text(inside & ((data & 0xC0) != 0x80), offsets)
    out["n_symbols"] = _per_text(np.isin(data, np.frombuffer(SYMBOLS.encode(), np.uint8)), offsets)

    # Lines end at a line feed or at the end of their text.
    feeds = np.flatnonzero(data == 10)
    line_starts = np.sort(np.concatenate([offsets[:-1], feeds + 1]))
    line_ends = np.sort(np.concatenate([feeds, offsets[1:]]))
    # Starts, ends and texts are each ascending, so the k-th of one belongs to the k-th of the others.
    line_text = np.sort(np.concatenate([np.arange(n), np.searchsorted(offsets, feeds, side="right") - 1]))
    with_word = np.append(0, np.cumsum(inside))
    filled = np.flatnonzero(with_word[line_ends] > with_word[line_starts])
    line = mix(hashes(line_starts[filled], line_ends[filled]) + line_text[filled].astype(U64) * U64(0x9FB21C651E98DF25))
    _, first_lines = np.unique(line, return_index=True)
    filled_text = line_text[filled]
    out["n_lines"] = np.bincount(filled_text, minlength=n)
    out["n_dup_lines"] = out["n_lines"] - np.bincount(filled_text[first_lines], minlength=n)

    window, first_window = windows(word, firsts)
    n_windows = np.diff(first_window)
    text_of_window = np.repeat(np.arange(n), n_windows)
    full = out["n_words"][text_of_window] >= SHINGLE_WORDS
    window, text_of_window = window[full], text_of_window[full]
    first_word = (np.arange(len(full)) - np.repeat(first_window[:-1] - firsts[:-1], n_windows))[full]
    _, which, often = np.unique(
        mix(window + text_of_window.astype(U64) * U64(0xC2B2AE3D27D4EB4F)), return_inverse=True, return_counts=True
    )
    again = first_word[often[which] > 1]
    covered = np.zeros(len(word) + SHINGLE_WORDS + 1, np.int64)
    np.add.at(covered, again, 1)
    np.add.at(covered, again + SHINGLE_WORDS, -1)
    repeated = np.cumsum(covered)[: len(word)] > 0
    out["n_repeat_words"] = np.bincount(text_of_word[repeated], minlength=n)

    capital = (data >= 65) & (data <= 90)
    out["n_capitals"] = _per_text(capital, offsets)
    digit = (data >= 48) & (data <= 57)
    out["n_digits"] = _per_text(digit, offsets)
    letter = capital | ((data >= 97) & (data <= 122)) | ((data >= 0xC0) & (data < 0xF8))
    out["n_letters"] = _per_text(letter, offsets)
    out["n_marks"] = _per_text((data > 32) & (data < 127) & ~letter & ~digit, offsets)
    _, unlike = np.unique(mix(word + text_of_word.astype(U64) * U64(0x165667B19E3779F9)), return_index=True)
    out["n_unlike_words"] = np.bincount(text_of_word[unlike], minlength=n)
    return out


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in blocks(batches):
        found = statistics(block.data, block.offsets)
        names = [*COUNTS, *MORE_COUNTS]
        yield pa.RecordBatch.from_arrays(
            [block.rows.column("doc_id"), *[pa.array(found[c].astype(np.int64)) for c in names]], ["doc_id", *names]
        )


def text_statistics(docs: DataFrame) -> DataFrame:
    """doc_id, COUNTS and MORE_COUNTS of every row of (doc_id, text); a null text has none of anything."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_arrow(docs, _statistics, ", ".join(["doc_id bigint", *[f"{c} bigint" for c in [*COUNTS, *MORE_COUNTS]]]))


def measures() -> dict[str, Column]:
    """What the rules may ask, as ratios of the counts; 0 where there is nothing to divide by."""

    def share(a: str, b: str) -> Column:
        return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))

    return {
        "words": F.col("n_words").cast("double"),
        "word_length": share("word_chars", "n_words"),
        "symbols_per_word": share("n_symbols", "n_words"),
        "duplicate_lines": share("n_dup_lines", "n_lines"),
        "repeated_words": share("n_repeat_words", "n_words"),
        "words_per_line": share("n_words", "n_lines"),
        "capitals": share("n_capitals", "n_letters"),
        "letters": share("n_letters", "word_chars"),
        "digits": share("n_digits", "word_chars"),
        "marks_per_word": share("n_marks", "n_words"),
        "unlike_words": share("n_unlike_words", "n_words"),
    }


class Condition(NamedTuple):
    measure: str
    over: bool  # value >= cut, else value < cut
    cut: float


Rule = list[Condition]


def holds(rule: Rule, columns: dict[str, np.ndarray]) -> np.ndarray:
    out = np.ones(len(next(iter(columns.values()))), bool)
    for name, over, cut in rule:
        out &= (columns[name] >= cut) if over else (columns[name] < cut)
    return out


def _gain(p: np.ndarray, n: np.ndarray, p0: int, n0: int) -> np.ndarray:
    """First-order gain of narrowing p0 bad and n0 good rows to p and n."""
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(p > 0, p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0))), -np.inf)


def grow(columns: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    """Conditions that lead to rows which are bad, the best one at a time."""
    rule: Rule = []
    here = np.ones(len(bad), bool)
    while len(rule) < MOST_CONDITIONS and here.any() and (~bad[here]).any() and bad[here].any():
        p0, n0 = int(bad[here].sum()), int((~bad[here]).sum())
        best: tuple[float, Condition] | None = None
        for name, values in columns.items():
            mine = values[here]
            for cut in np.unique(np.quantile(mine, np.linspace(0, 1, CUTS + 1)[1:])):
                over = mine >= cut
                p, n = int((over & bad[here]).sum()), int((over & ~bad[here]).sum())
                for condition, a, b in ((Condition(name, True, float(cut)), p, n), (Condition(name, False, float(cut)), p0 - p, n0 - n)):
                    gain = float(_gain(np.array(a), np.array(b), p0, n0))
                    if best is None or gain > best[0] + 1e-12:
                        best = gain, condition
        if best is None or best[0] <= 0:
            break
        rule.append(best[1])
        here &= holds([best[1]], columns)
    return rule


def prune(rule: Rule, columns: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    """The shortest beginning of the rule that is worth most on rows it has not seen."""

    def worth(candidate: Rule) -> float:
        covered = holds(candidate, columns)
        p, n = int((covered & bad).sum()), int((covered & ~bad).sum())
        return (p - n) / (p + n) if p + n else -1.0

    return max((rule[:k] for k in range(1, len(rule) + 1)), key=lambda r: (worth(r), -len(r)))


def learn(columns: dict[str, np.ndarray], bad: np.ndarray, third: np.ndarray) -> list[Rule]:
    """Rules for bad rows, in order; ``third`` marks the rows kept for pruning."""
    rules: list[Rule] = []
    left = np.ones(len(bad), bool)

    def part(mask: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
        return {k: v[mask] for k, v in columns.items()}, bad[mask]

    while len(rules) < MOST_RULES and (left & bad).any():
        grown = grow(*part(left & ~third))
        if not grown:
            break
        rule = prune(grown, *part(left & third)) if (left & third).any() else grown
        covered = left & holds(rule, columns)
        n, right = int(covered.sum()), int((covered & bad).sum())
        if n < FEWEST_COVERED or right < PRECISION * n:
            break
        rules.append(rule)
        left &= ~covered
    return rules


def fit(counts: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> list[Rule]:
    """Rules learned from at most ``fit_rows`` labelled rows of ``text_statistics``, the first by a hash of doc_id."""
    marked = (
        labels.where("doc_id IS NOT NULL AND quality IN (0, 1)")
        .groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
        .agg(F.min(F.col("quality").cast("int")).alias("quality"))
    )
    share = min(1.0, fit_rows / max(marked.count(), 1))
    place = F.xxhash64("doc_id", F.lit(29)) / F.lit(float(1 << 63))
    # about as many rows as wanted, and of those the first by hash: the same rows in any run
    drawn = marked.where(place < 2.2 * share - 1).orderBy(place, "doc_id").limit(fit_rows)
    rows = (
        counts.join(drawn, "doc_id")
        .select("doc_id", "quality", *[c.alias(name) for name, c in measures().items()])
        .orderBy("doc_id", *measures())
        .limit(fit_rows)
        .toPandas()
    )
    if rows.empty:
        return []
    columns = {name: rows[name].to_numpy() for name in measures()}
    third = mix(rows["doc_id"].to_numpy().astype(np.int64).view(U64)) % U64(3) == 0
    return learn(columns, rows["quality"].to_numpy() == 0, third)


def verdict(rules: list[Rule]) -> Column:
    """Number of the first rule that holds, from 1, or null; an ordered conditional expression over the counts."""
    columns = measures()
    out = None
    for k, rule in enumerate(rules, 1):
        test = F.lit(True)
        for name, over, cut in rule:
            test = test & ((columns[name] >= cut) if over else (columns[name] < cut))
        out = F.when(test, F.lit(k)) if out is None else out.when(test, F.lit(k))
    return F.lit(None).cast("int") if out is None else out


def apply_rules(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """doc_id, COUNTS, base_failed, kept, rule of every row of (doc_id, text).

    ``base_failed`` is fewer than 10 words, or more than a fifth of the words in
    repeated windows.  ``kept`` is false for those and where a rule holds.  A null
    or empty text fails.  Without labels (doc_id, quality) there are no rules.
    Rows that repeat get the same result; doc_id may be null; other columns are
    ignored.
    """
    counts = materialize(text_statistics(docs), "text-statistics")
    rules = fit(counts, labels, fit_rows)
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return (
        counts.withColumn("base_failed", failed)
        .withColumn("rule", verdict(rules))
        .select("doc_id", *COUNTS, "base_failed", (~F.col("base_failed") & F.col("rule").isNull()).alias("kept"), "rule")
    )
