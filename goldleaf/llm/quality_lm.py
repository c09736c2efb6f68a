"""A quality classifier: how surprising a document is to a model of trusted text.

The model is an interpolated modified Kneser-Ney model of ORDER characters,
trained on all documents that are labelled as good.  Characters keep the number
of different n-grams, and so the joins, small against the text, and know every
word form.  Counts and the model's tables stay in Spark.  For scoring, texts are
dealt out in parts of some MB; the different n-grams of a part are joined with
the model, shard by shard, and come back to the part, which adds up the
logarithms of its documents.  A document is rejected if its perplexity is beyond
a quantile of the trusted documents of its language.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from goldleaf.llm.bitmaps import possible
from goldleaf.llm.blocks import Block, blocks, gathered, runs
from goldleaf.llm.tasks import map_arrow
from goldleaf.sources.tables import materialize

ORDER = 4
CHARACTER_BITS = 16
PART_BYTES = 1 << 23
QUANTILE = 0.995
MARGIN = 0.05  # of the logarithm
FEWEST = 50
BINS = 1000  # of the logarithm, in one unit

START, END, LARGEST = 2, 3, (1 << CHARACTER_BITS) - 1


def grams(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """ORDER-grams of all texts of a block as 64-bit numbers, and the first of each text.

    A text stands between ORDER - 1 start marks and an end mark; characters
    beyond the first 65,535 code points count as one.
    """
    points = np.frombuffer(block.data.tobytes().decode().encode("utf-32-le"), np.uint32)
    points = np.minimum(points, LARGEST).astype(np.uint64)
    index = np.append(0, np.cumsum((block.data & 0xC0) != 0x80))[block.offsets]
    n = len(index) - 1
    marks = np.tile(np.array([START] * (ORDER - 1) + [END], np.uint64), n)
    at = np.stack([index[:-1]] * (ORDER - 1) + [index[1:]], axis=1).ravel()
    line = np.insert(points, at, marks) if n else points
    out = np.zeros(max(len(line) - ORDER + 1, 0), np.uint64)
    for k in range(ORDER):
        out = out << np.uint64(CHARACTER_BITS) | line[k : k + len(out)]
    firsts = index + ORDER * np.arange(n + 1)
    counts = np.diff(firsts) - ORDER + 1
    keep = np.arange(counts.sum()) + np.repeat((ORDER - 1) * np.arange(n), counts)
    return out[keep].view(np.int64), np.append(0, np.cumsum(counts))


def _unlike(part: pa.RecordBatch) -> np.ndarray:
    """The different n-grams of a part, found a block at a time."""
    return np.unique(np.concatenate([np.unique(grams(block)[0]) for block in blocks(iter([part]))]))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in blocks(batches):
        found, counts = np.unique(grams(block)[0], return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(counts)], ["gram", "n"])


def _part_number(number: int) -> int:
    return TaskContext.get().partitionId() << 32 | number


def _needed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The different n-grams of every part."""
    for number, part in enumerate(gathered(batches, PART_BYTES)):
        found = _unlike(part)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(found), _part_number(number))), pa.array(found)], ["part", "gram"]
        )


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The documents of every part, compressed."""
    for number, part in enumerate(gathered(batches, PART_BYTES)):
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, part.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
            stream.write_batch(part)
        yield pa.RecordBatch.from_arrays(
            [pa.array([_part_number(number)]), pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["part", "pack"]
        )


def _scored(batches: Iterator[pa.RecordBatch], carried: Sequence[str] = ()) -> Iterator[pa.RecordBatch]:
    """Documents of a part with the sum of their n-grams' logarithms."""
    for table in runs(batches, ["part"]):
        pack = table.column("pack").drop_null()
        scores = table.filter(pa.compute.is_valid(table.column("gram")))
        known = scores.column("gram").to_numpy()
        order = np.argsort(known)
        known, logs = known[order], scores.column("log").to_numpy()[order]
        for part in pa.ipc.open_stream(pack[0].as_buffer()):
            for block in blocks(iter([part])):
                found, firsts = grams(block)
                at = np.minimum(np.searchsorted(known, found), len(known) - 1)
                if not np.array_equal(known[at], found):
                    raise RuntimeError("the table was read in another order the second time")
                sums = np.add.reduceat(logs[at], firsts[:-1])
                counts = np.diff(firsts)
                yield pa.RecordBatch.from_arrays(
                    [
                        block.rows.column("doc_id"),
                        block.rows.column("lang"),
                        pa.array(counts - 1),
                        pa.array(-sums / counts),
                        *[block.rows.column(c) for c in carried],
                    ],
                    ["doc_id", "lang", "n_chars", "log_perplexity", *carried],
                )


# ---- the model's tables -----------------------------------------------------
def _head(order: int, column: str = "gram") -> Column:
    """An n-gram without its last character."""
    return F.shiftrightunsigned(column, CHARACTER_BITS) if order > 1 else F.lit(0).cast("bigint")


def _tail(order: int, column: str = "gram") -> Column:
    """An n-gram without its first character."""
    return F.col(column).bitwiseAND(F.lit((1 << CHARACTER_BITS * (order - 1)) - 1).cast("bigint"))


def discounts(counts: DataFrame) -> tuple[float, float, float]:
    """Discounts for counts of one, two, and three or more."""
    n1, n2, n3, n4 = counts.agg(*[F.count(F.when(F.col("n") == k, 1)) for k in (1, 2, 3, 4)]).first()
    if not (n1 and n2 and n3 and n4):
        return 0.5, 1.0, 1.5
    y = n1 / (n1 + 2 * n2)
    return tuple(min(max(k - (k + 1) * y * b / a, 0.0), float(k)) for k, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4)))


def level(counts: DataFrame, order: int) -> tuple[DataFrame, DataFrame]:
    """(gram, own) and (head, rest) of one order.

    ``own`` is the discounted share of a gram among those of its head; ``rest``
    is what the head leaves to the next order.
    """
    d1, d2, d3 = discounts(counts)
    n = F.col("n")
    discount = F.when(n == 1, d1).when(n == 2, d2).otherwise(d3)
    heads = (
        counts.groupBy(_head(order).alias("head"))
        .agg(F.sum("n").alias("total"), F.sum(discount).alias("taken"))
        .select("head", "total", (F.col("taken") / F.col("total")).alias("rest"))
    )
    own = (
        counts.withColumn("head", _head(order))
        .join(heads.select("head", "total"), "head")
        .select("gram", (F.greatest(n - discount, F.lit(0.0)) / F.col("total")).alias("own"))
    )
    return own, heads.select("head", "rest")


def model(counts: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
    """Levels from ORDER down to 1; lower orders count the different characters in front."""
    levels, order = [], ORDER
    while True:
        levels.append(level(counts, order))
        if order == 1:
            return levels
        counts = materialize(
            counts.groupBy(_tail(order).alias("gram")).agg(F.count(F.lit(1)).alias("n")), f"grams{order - 1}"
        )
        order -= 1


def logarithms(wanted: DataFrame, levels: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """(gram, log) of every wanted n-gram of ORDER characters."""
    alphabet = levels[-1][0].count() + 1  # and the unknown one
    rows, share, left = wanted, F.lit(0.0), F.lit(1.0)
    for order, (own, heads) in zip(range(ORDER, 0, -1), levels):
        part = _suffix(order)
        rows = (
            rows.withColumn("part_gram", part)
            .withColumn("part_head", _head(order, "part_gram"))
            .join(own.toDF("part_gram", f"own{order}"), "part_gram", "left")
            .join(heads.toDF("part_head", f"rest{order}"), "part_head", "left")
            .drop("part_gram", "part_head")
        )
        share = share + left * F.coalesce(F.col(f"own{order}"), F.lit(0.0))
        left = left * F.coalesce(F.col(f"rest{order}"), F.lit(1.0))
    return rows.select("gram", F.log(share + left / F.lit(float(alphabet))).alias("log"))


def _suffix(order: int) -> Column:
    """The last ``order`` characters of a gram of ORDER."""
    if order == ORDER:
        return F.col("gram")
    return F.col("gram").bitwiseAND(F.lit((1 << CHARACTER_BITS * order) - 1).cast("bigint"))


def train(texts: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
    """The model of all rows of (text)."""
    counts = materialize(
        map_arrow(texts, _counted, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n")), f"grams{ORDER}"
    )
    return model(counts)


def perplexities(docs: DataFrame, levels: list[tuple[DataFrame, DataFrame]], carried: Sequence[str] = ()) -> DataFrame:
    """doc_id, lang, n_chars, log_perplexity and ``carried`` of every row of (doc_id, text, lang) and those.

    The rows are read twice and must come in the same order, as those of a stored
    table do.
    """
    needed = materialize(map_arrow(docs, _needed, "part bigint, gram bigint"), "needed")
    logs = materialize(logarithms(needed.select("gram").distinct(), levels), "logs")
    packs = map_arrow(docs, _packed, "part bigint, pack binary")
    rows = packs.select("part", "pack", F.lit(None).cast("bigint").alias("gram"), F.lit(None).cast("double").alias("log")).unionByName(
        needed.join(logs, "gram").select("part", F.lit(None).cast("binary").alias("pack"), "gram", "log")
    )
    return map_arrow(
        rows.repartition("part").sortWithinPartitions("part"),
        partial(_scored, carried=carried),
        ", ".join(
            ["doc_id bigint, lang string, n_chars bigint, log_perplexity double"]
            + [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in carried]
        ),
    )


def thresholds(trusted: DataFrame, quantile: float, margin: float, fewest: int) -> tuple[DataFrame, float | None]:
    """(lang, threshold) of languages with at least ``fewest`` trusted rows, and that of all together.

    Logarithms are counted in BINS bins a unit, so the quantile is exact to a
    bin and does not depend on the order of the rows.
    """
    bins = trusted.groupBy("lang", F.floor(F.col("log_perplexity") * BINS).alias("bin")).agg(F.count(F.lit(1)).alias("n"))

    def at_quantile(df: DataFrame, keys: list[str]) -> DataFrame:
        below = Window.partitionBy(*keys).orderBy("bin")
        whole = Window.partitionBy(*keys)
        return (
            df.withColumn("below", F.sum("n").over(below))
            .withColumn("total", F.sum("n").over(whole))
            .where(F.col("below") >= quantile * F.col("total"))
            .groupBy(*keys)
            .agg(F.min("bin").alias("bin"), F.first("total").alias("total"))
            .withColumn("threshold", (F.col("bin") + 1) / BINS + margin)
        )

    all_together = bins.groupBy("bin").agg(F.sum("n").alias("n")).withColumn("everything", F.lit(1))
    first = at_quantile(all_together, ["everything"]).select("threshold").first()
    own = at_quantile(bins, ["lang"]).where(F.col("total") >= fewest).select("lang", "threshold")
    return own, first[0] if first else None


def classify(
    docs: DataFrame,
    labels: DataFrame,
    quantile: float = QUANTILE,
    margin: float = MARGIN,
    fewest: int = FEWEST,
    carried: Sequence[str] = (),
) -> DataFrame:
    """doc_id, n_chars, perplexity, threshold, kept of every row of (doc_id, text, lang).

    Trusted are documents with quality 1 and not toxic in ``labels`` (doc_id,
    quality, toxic).  A language is compared with its own trusted documents, or
    with all if it has fewer than ``fewest`` or is null.  A null or empty text is
    rejected.  Without any trusted document nothing else is.  Rows that repeat
    get the same result each; doc_id may be null; columns named in ``carried`` are
    passed on, others are ignored.
    """
    docs = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"), *carried
    )
    good = labels.where("quality = 1 AND coalesce(toxic, 0) = 0 AND doc_id IS NOT NULL").select(F.col("doc_id").cast("bigint").alias("doc_id")).distinct()
    trusted = possible(docs, good, "doc_id").join(good.hint("merge"), "doc_id", "left_semi")
    scored = materialize(perplexities(docs, train(trusted.select("text")), carried), "perplexities")
    limits, common = thresholds(
        scored.where("n_chars > 0").join(good, "doc_id", "left_semi"), quantile, margin, fewest
    )
    rows = scored.join(F.broadcast(limits) if limits.count() <= 10_000 else limits, "lang", "left")
    threshold = F.coalesce(F.col("threshold"), F.lit(common).cast("double"))
    return rows.select(
        "doc_id",
        "n_chars",
        F.exp("log_perplexity").alias("perplexity"),
        F.exp(threshold).alias("threshold"),
        ((F.col("n_chars") > 0) & F.coalesce(F.col("log_perplexity") <= threshold, F.lit(True))).alias("kept"),
        *carried,
    )
