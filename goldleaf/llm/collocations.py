"""Phrase collocations: frequent phrases, scored by how much likelier they are than their two halves.

Counting goes up level by level over the texts.  A phrase can only be frequent
if its parts are, so each pass counts the phrases whose shorter ones may be
frequent, by a bitmap of fixed size; what the bitmap lets through wrongly is
counted and then falls under the threshold.

The counts are laid out as for external estimation: as one stream in prefix
order (by the first word, then the second, ...) and one in suffix order (by the
last word, then the one before, ...).  In either, a phrase directly follows the
phrases that it continues, so one pass that merges all lengths in lockstep
knows the counts of all beginnings (endings) and the best count of a phrase one
word longer; nothing is looked up.  The streams are cut into ranges of about
equal length.  A range begins with copies of the phrases that its first row
continues, so a word with a third of all phrases may lie over many ranges.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from goldleaf.llm.blocks import Hasher, blocks, gathered, lower_ascii, mix
from goldleaf.llm.tasks import map_arrow
from goldleaf.sources.tables import materialize

MIN_COUNT, MOST_WORDS, TOP = 100, 5, 2000
TEXT_BYTES = 1 << 22  # counted at once
BITS = 1 << 25  # of a bitmap, 4 MB
PART = 1 << 15  # bits that Spark's bitmap functions hold
RANGE_ROWS = 200_000  # rows of a range of a count stream
SALTS = 64
U64 = np.uint64
# Passes over the texts: the phrase lengths that each one counts.
PASSES = [(1, 1), (2, 2), (3, 3), (4, MOST_WORDS)]
COUNTS = "lang string, n_words int, phrase string, n long"


# ---- words ------------------------------------------------------------------
class Words(NamedTuple):
    """The words of a block in order: an id for (lang, word), the piece, and of each id the lang, word and hash."""

    ids: np.ndarray
    piece: np.ndarray
    lang: pa.Array
    word: pa.Array
    hashes: np.ndarray


def _slices(data: np.ndarray, inside: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """The marked bytes as one string per length."""
    places = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=places[1:])
    return pa.LargeStringArray.from_buffers(len(lengths), pa.py_buffer(places), pa.py_buffer(np.ascontiguousarray(data[inside])))


def _hashes(strings: pa.Array) -> np.ndarray:
    places, body = strings.buffers()[1:]
    at = np.frombuffer(places, np.int64)[strings.offset : strings.offset + len(strings) + 1]
    data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    return Hasher(data[at[0] : at[-1]])(at[:-1] - at[0], at[1:] - at[0]) if len(strings) else np.zeros(0, U64)


def words_of(data: np.ndarray, offsets: np.ndarray, langs: pa.Array) -> Words:
    """Words are ended by blanks and tabs; pieces by ``.,;:!?``, line ends and the end of the text."""
    data = lower_ascii(data)
    stop = (data >= 10) & (data <= 13)
    for mark in b".,;:!?":
        stop |= data == mark
    inside = ~(stop | (data == 32) | (data == 9))
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1] | edge[1:-1]
    ends[:-1] &= ~inside[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    coded = _slices(data, inside, ends - starts).dictionary_encode()
    text = np.searchsorted(offsets, starts, side="right") - 1
    named = langs.dictionary_encode()
    pairs = named.indices.to_numpy()[text].astype(np.int64) * max(len(coded.dictionary), 1) + coded.indices.to_numpy()
    known, ids = np.unique(pairs, return_inverse=True)
    of_lang, of_word = known // max(len(coded.dictionary), 1), known % max(len(coded.dictionary), 1)
    hashes = _hashes(coded.dictionary)[of_word] + _hashes(named.dictionary.cast(pa.large_string()))[of_lang] * U64(0xD6E8FEB86659FD93)
    return Words(
        ids,
        np.cumsum(stop, dtype=np.int64)[starts] + text,
        named.dictionary.take(pa.array(of_lang)),
        coded.dictionary.take(pa.array(of_word)),
        mix(hashes),
    )


def joined(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The hash of a phrase from those of its words so far and of its next word."""
    return mix(first * U64(0x9E3779B97F4A7C15) + last)


def may_have(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    place = hashes % U64(len(bitmap) * 8)
    return (bitmap[(place >> U64(3)).astype(np.int64)] >> (place & U64(7)).astype(np.uint8)) & 1 == 1


# ---- counting ---------------------------------------------------------------
def _count(
    batches: Iterator[pa.RecordBatch], least: int, most: int, frequent: dict[int, bytes]
) -> Iterator[pa.RecordBatch]:
    """lang, n_words, phrase, n: counts of the phrases of ``least`` to ``most`` words, block by block.

    ``frequent`` has bitmaps of the frequent phrases of so many words.  The empty
    phrase, beside single words, has the number of all words.
    """
    bitmaps = {n_words: np.frombuffer(bits, np.uint8) for n_words, bits in frequent.items()}
    for batch in gathered(batches, TEXT_BYTES):
        for block in blocks(iter([batch]), TEXT_BYTES):
            w = words_of(block.data, block.offsets, block.rows.column("lang").cast(pa.string()).fill_null("und"))
            if not len(w.ids):
                continue
            yield from _count_block(w, least, most, bitmaps)


def _rows(lang: pa.Array, n_words: int, phrase: pa.Array, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [lang.cast(pa.string()), pa.array(np.full(len(n), n_words, np.int32)), phrase.cast(pa.string()), pa.array(n.astype(np.int64))],
        names=["lang", "n_words", "phrase", "n"],
    )


def _count_block(w: Words, least: int, most: int, bitmaps: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    if least == 1:
        n = np.bincount(w.ids, minlength=len(w.word))
        yield _rows(w.lang, 1, w.word, n)
        totals = pa.table({"lang": w.lang, "n": n}).group_by("lang").aggregate([("n", "sum")]).combine_chunks()
        yield _rows(totals["lang"].chunk(0), 0, pa.array([""] * len(totals), pa.string()), totals["n_sum"].to_numpy())
    # where the phrases of the present length begin, which ones they are, and of each its text, lang and hash
    at, ids, phrase, lang, hashes = np.arange(len(w.ids)), w.ids, w.word, w.lang, w.hashes
    for size in range(2, most + 1):
        if size - 1 in bitmaps:
            may = may_have(bitmaps[size - 1], hashes)[ids]
            at, ids = at[may], ids[may]
        begins = np.zeros(len(w.ids) + 1, bool)
        begins[at] = True
        grows = begins[at + 1]  # the phrase without its first word
        at, ids = at[grows], ids[grows]
        end = at + size - 1
        fits = end < len(w.ids)
        fits[fits] = w.piece[end[fits]] == w.piece[at[fits]]
        at, ids, end = at[fits], ids[fits], end[fits]
        if not len(at):
            return
        pairs, ids, n = np.unique(ids * len(w.word) + w.ids[end], return_inverse=True, return_counts=True)
        before, last = pairs // len(w.word), pairs % len(w.word)
        phrase = pc.binary_join_element_wise(phrase.take(pa.array(before)), w.word.take(pa.array(last)), pa.scalar(" ", phrase.type))
        lang = lang.take(pa.array(before))
        hashes = joined(hashes[before], w.hashes[last])
        if size >= least:
            yield _rows(lang, size, phrase, n)


def _places(batches: Iterator[pa.RecordBatch], n_words: int) -> Iterator[pa.RecordBatch]:
    """The bits of phrases that all have ``n_words`` words."""
    for batch in batches:
        for block in blocks(iter([batch]), TEXT_BYTES):
            w = words_of(block.data, block.offsets, block.rows.column("lang").cast(pa.string()))
            of_word = w.hashes[w.ids].reshape(-1, n_words)
            hashes = of_word[:, 0]
            for k in range(1, n_words):
                hashes = joined(hashes, of_word[:, k])
            yield pa.RecordBatch.from_arrays([pa.array((hashes % U64(BITS)).astype(np.int64))], names=["place"])


def bitmap_of(frequent: DataFrame, n_words: int) -> bytes:
    """The bitmap of the (lang, phrase) rows, BITS large whatever their number."""
    places = map_arrow(frequent.select("lang", F.col("phrase").alias("text")), partial(_places, n_words=n_words), "place long")
    parts = (
        places.groupBy(F.floor(F.col("place") / PART).alias("part"))
        .agg(F.bitmap_construct_agg(F.pmod("place", F.lit(PART))).alias("bits"))
        .collect()
    )
    out = bytearray(BITS // 8)
    for r in parts:
        out[r.part * PART // 8 : (r.part + 1) * PART // 8] = r.bits
    return bytes(out)


def phrase_counts(docs: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """lang, n_words, phrase, n of all phrases that occur ``min_count`` times, stored; the empty phrase has all words."""
    texts = docs.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).where("text != ''")
    levels, bitmaps = [], {}
    for least, most in PASSES:
        told = map_arrow(texts, partial(_count, least=least, most=most, frequent=dict(bitmaps)), COUNTS)
        counts = materialize(
            told.groupBy("lang", "n_words", "phrase").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count),
            f"phrases-{least}",
        )
        levels.append(counts)
        if most < MOST_WORDS:
            bitmaps[least] = bitmap_of(counts.where(F.col("n_words") == least), least)
    out = levels[0]
    for more in levels[1:]:
        out = out.unionByName(more)
    return out


# ---- the two streams --------------------------------------------------------
def _ranges(batches: Iterator[pa.RecordBatch], cuts: list, copies: dict) -> Iterator[pa.RecordBatch]:
    """Rows with their range, and copies of those that the first row of a later range continues."""
    for batch in batches:
        keys = list(zip(batch.column("lang").to_pylist(), map(tuple, batch.column("words").to_pylist())))
        row, number, copy = [], [], []
        for i, key in enumerate(keys):
            more = copies.get(key, ())
            row += [i] * (1 + len(more))
            number += [bisect_right(cuts, key), *more]
            copy += [False, *[True] * len(more)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(number, pa.int32()), *batch.take(pa.array(row, pa.int64())).columns, pa.array(copy, pa.bool_())],
            names=["range", "lang", "words", "n", "copy"],
        )


def _lockstep(batches: Iterator[pa.RecordBatch], backwards: bool) -> Iterator[pa.RecordBatch]:
    """Of every row the counts of the phrases that it continues and the best count of those that continue it.

    The open phrases, each continuing the one before, are at most MOST_WORDS.
    """
    out: list[tuple] = []
    opened: list[list] = []  # range, lang, words, n, copy, shorter counts, longer

    def close(keep: int) -> None:
        while len(opened) > keep:
            _, lang, words, n, copy, shorter, longer = opened.pop()
            phrase = " ".join(reversed(words) if backwards else words)
            out.append((lang, phrase, None if copy else n, None if copy else shorter, longer))

    def told() -> pa.RecordBatch:
        columns = list(zip(*out)) or [()] * 5
        out.clear()
        kinds = [pa.string(), pa.string(), pa.int64(), pa.list_(pa.int64()), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["lang", "phrase", "a", "shorter", "longer"])

    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("range", "lang", "words", "n", "copy"))
        for number, lang, words, n, copy in zip(*columns):
            keep = 0
            for one in opened:
                if one[0] != number or one[1] != lang or one[2] != words[: len(one[2])]:
                    break
                keep += 1
            close(keep)
            if opened:
                opened[-1][6] = max(opened[-1][6], n)
            opened.append([number, lang, words, n, copy, [one[3] for one in opened], 0])
        yield told()
    close(0)
    yield told()


def stream(counts: DataFrame, backwards: bool, n_ranges: int) -> DataFrame:
    """lang, phrase, a, shorter, longer over the stream in prefix order, or backwards in suffix order.

    ``shorter`` has the counts of the beginnings (endings) of 1, 2, ... words.
    A phrase may have several rows; all but one are of copies and have neither ``a`` nor ``shorter``.
    """
    words = F.split("phrase", " ")
    rows = counts.select("lang", (F.reverse(words) if backwards else words).alias("words"), "n")
    cuts = []
    if n_ranges > 1:
        firsts = rows.repartitionByRange(n_ranges, "lang", "words").groupBy(F.spark_partition_id()).agg(F.min(F.struct("lang", "words")).alias("first"))
        cuts = sorted((r.first.lang, tuple(r.first.words)) for r in firsts.select("first").collect())[1:]
    copies: dict[tuple, list[int]] = {}
    for number, (lang, first) in enumerate(cuts, 1):
        for size in range(1, len(first)):
            copies.setdefault((lang, first[:size]), []).append(number)
    kinds = "range int, lang string, words array<string>, n long, copy boolean"
    placed = map_arrow(rows, partial(_ranges, cuts=cuts, copies=copies), kinds)
    ordered = placed.repartition(n_ranges, "range").sortWithinPartitions("range", "lang", "words")
    return map_arrow(ordered, partial(_lockstep, backwards=backwards), "lang string, phrase string, a long, shorter array<long>, longer long")


# ---- the operator -----------------------------------------------------------
def _big(column: Column) -> Column:
    return column.cast("decimal(19,0)")


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, top: int = TOP, range_rows: int = RANGE_ROWS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of the rows of (text, lang): each lang's ``top`` phrases.

    A phrase of 2 to 5 words within a piece of text is a candidate from
    ``min_count`` occurrences on, and goes if one longer by a word has as many
    (so does then, step by step, any longer one).  The score is that of the cut
    with the lowest; ties go to the shortest first part.  A null lang is ``und``;
    null and empty texts have no words; repeated rows count each.  Other columns
    are ignored.
    """
    counts = phrase_counts(docs, min_count)
    phrases = counts.where("n_words > 0")
    n_ranges = max(1, -(-phrases.count() // range_rows))
    sides = [stream(phrases, backwards, n_ranges).withColumn("last", F.lit(backwards)) for backwards in (False, True)]
    found = (
        sides[0]
        .unionByName(sides[1])
        .groupBy("lang", "phrase")
        .agg(
            F.max("a").alias("a"),
            F.max(F.when(~F.col("last"), F.col("shorter"))).alias("begins"),
            F.max(F.when(F.col("last"), F.col("shorter"))).alias("ends"),
            F.max("longer").alias("longer"),
        )
        .where((F.size("begins") > 0) & (F.col("longer") < F.col("a")))
    )
    totals = counts.where("n_words = 0").select("lang", F.col("n").alias("words"))
    size = F.size("begins")

    def cut(k: Column) -> Column:
        before, after = F.get("begins", k - 1), F.get("ends", size - k)
        score = F.call_function("div", F.lit(1000).cast("decimal(4,0)") * _big(F.col("a")) * _big(F.col("words")), _big(before) * _big(after))
        return F.struct(score.alias("score"), k.alias("k"), before.alias("l"), after.alias("r"))

    scored = found.join(totals, "lang").withColumn("cut", F.array_min(F.transform(F.sequence(F.lit(1), size), cut)))
    scored = scored.select("lang", "phrase", "a", "cut.l", "cut.r", F.col("words").alias("n"), "cut.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # the best of each part of a lang first, so that no task ranks a whole lang
    parts = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).orderBy(*order)
    best = scored.withColumn("rank", F.row_number().over(parts)).where(F.col("rank") <= top)
    whole = Window.partitionBy("lang").orderBy(*order)
    ranked = best.withColumn("rank", F.row_number().over(whole).cast("bigint")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SQL = f"""
WITH pieces AS (
  SELECT row_number() OVER () AS piece, lang, list_filter(string_split_regex(text, '[ \t]+'), lambda w: w <> '') AS ws
  FROM (SELECT coalesce(lang, 'und') AS lang,
               unnest(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\n\x0B\x0C\r]')) AS text
        FROM documents)),
places AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM pieces),
grams AS (
  SELECT lang, ws[i:i + k - 1] AS g, k
  FROM (SELECT lang, ws, i, unnest(range(1, {MOST_WORDS + 1})) AS k FROM places) WHERE i + k - 1 <= len(ws)),
f AS MATERIALIZED (SELECT lang, g, k, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= {MIN_COUNT}),
n AS (SELECT lang, sum(len(ws)) AS n FROM pieces GROUP BY lang),
longer AS (
  SELECT lang, g, max(a) AS m FROM (
    SELECT lang, g[1:k - 1] AS g, a FROM f WHERE k > 1 UNION ALL SELECT lang, g[2:k] AS g, a FROM f WHERE k > 1)
  GROUP BY ALL),
cuts AS (
  SELECT c.lang, c.g, c.a, c.cut, l.a AS l, r.a AS r, n.n,
         (CAST(1000 AS HUGEINT) * c.a * n.n) // (CAST(l.a AS HUGEINT) * r.a) AS score
  FROM (SELECT lang, g, k, a, unnest(range(1, k)) AS cut FROM f WHERE k > 1) c
  JOIN n ON n.lang = c.lang
  JOIN f l ON l.lang = c.lang AND l.g = c.g[1:c.cut]
  JOIN f r ON r.lang = c.lang AND r.g = c.g[c.cut + 1:c.k]),
lowest AS (SELECT *, row_number() OVER (PARTITION BY lang, g ORDER BY score, cut) AS pick FROM cuts),
ranked AS (
  SELECT lang, array_to_string(g, ' ') AS phrase, lowest.a, l, r, n, score,
         row_number() OVER (PARTITION BY lang ORDER BY score DESC, lowest.a DESC, encode(array_to_string(g, ' '))) AS rank
  FROM lowest LEFT JOIN longer USING (lang, g) WHERE pick = 1 AND coalesce(m, 0) < lowest.a)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= {TOP}
"""
