"""Exact duplicates by an extendible-hash index on shared files.

Native Spark throughout.  Keys are 64-bit hashes of texts.  The directory has one
cell per leading bits of a key; it is doubled while a bucket is overfull, and a
bucket that fits stays at its own, smaller depth with several cells pointing to
it.  Hashes that one row has are filed as they are.  Texts of the others go to
the owners of their cells, each a range of keys: an owner compares the bytes of
the texts of one hash and chains those that differ.  Rows find their bucket by
the directory and their entry by hash and, along a chain, by SHA-256.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from goldleaf.llm.bitmaps import possible
from goldleaf.sources.tables import materialize

CAPACITY = 1 << 12
MOST_DOUBLINGS = 24
COPY_PARTS = 8


def cell(depth: int) -> Column:
    """The leading ``depth`` bits of ``hash``."""
    return F.shiftrightunsigned("hash", 64 - depth) if depth else F.lit(0).cast("bigint")


def directory(keys: DataFrame, capacity: int = CAPACITY) -> tuple[int, DataFrame]:
    """The global depth, and one row per cell: cell, bucket, depth.

    Keys are counted once, at the finest depth, and the counts are folded.  A
    prefix is a bucket if it fits and the prefix it was split from didn't; keys
    that more than MOST_DOUBLINGS bits would have to tell apart share a bucket
    over capacity.  Bucket b splits into 2b and 2b + 1; the first one is 1.
    """
    finest = MOST_DOUBLINGS
    prefixes = materialize(
        keys.groupBy(cell(finest).alias("finest"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select("finest", "n", F.explode(F.sequence(F.lit(0), F.lit(finest))).alias("depth"))
        .groupBy("depth", F.expr(f"shiftrightunsigned(finest, {finest} - depth)").alias("prefix"))
        .agg(F.sum("n").alias("n")),
        "prefixes",
    )
    overfull = (F.col("n") > capacity) & (F.col("depth") < finest)
    halves = prefixes.where(overfull).select(
        (F.col("depth") + 1).alias("depth"), F.explode(F.array(F.col("prefix") * 2, F.col("prefix") * 2 + 1)).alias("prefix")
    )
    split = prefixes.join(halves, ["depth", "prefix"], "left_semi")
    buckets = materialize(
        split.unionByName(prefixes.where("depth = 0")).where(~overfull).select("depth", "prefix"), "buckets"
    )
    depth = buckets.agg(F.max("depth")).first()[0] or 0
    spread = F.expr(f"shiftleft(1L, {depth} - depth)")
    cells = buckets.select(
        F.explode(F.sequence(F.col("prefix") * spread, (F.col("prefix") + 1) * spread - 1)).alias("cell"),
        (F.expr("shiftleft(1L, depth)") + F.col("prefix")).alias("bucket"),
        "depth",
    )
    return depth, materialize(cells, "directory")


def build_index(docs: DataFrame, prints: DataFrame, capacity: int = CAPACITY) -> tuple[int, DataFrame, DataFrame]:
    """The global depth, the directory, and one entry per different text.

    An entry has bucket, depth, hash, chain (its place among the texts of the
    hash), links (their number), text_sha256, keep_id and group_size.  ``prints``
    are the rows of ``docs`` as (doc_id, hash, text_sha256).  Copies meet map
    side and in COPY_PARTS parts first, so an owner sees a text a few times
    however often it occurs.
    """
    hashes = materialize(
        prints.groupBy("hash").agg(
            F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("keep_id"), F.any_value("text_sha256").alias("text_sha256")
        ),
        "hashes",
    )
    depth, cells = directory(hashes, capacity)
    one = F.lit(1).cast("bigint")
    alone = (
        hashes.where("n = 1")
        .withColumn("cell", cell(depth))
        .join(cells, "cell")
        .select("bucket", "depth", "hash", one.alias("chain"), one.alias("links"), "text_sha256", "keep_id", F.col("n").alias("group_size"))
    )
    copies = (
        possible(docs.select("doc_id", "text", F.xxhash64("text").alias("hash")), hashes.where("n > 1").select("hash"), "hash")
        .groupBy("hash", "text", F.pmod(F.xxhash64("doc_id"), F.lit(COPY_PARTS)).alias("part"))
        .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    )
    # Equal bytes get equal ranks.
    chain = F.dense_rank().over(Window.partitionBy("cell", "hash").orderBy("text")).cast("bigint")
    of_hash = Window.partitionBy("cell", "hash")
    chained = (
        copies.withColumn("cell", cell(depth))
        .repartition("cell")
        .withColumn("chain", chain)
        .withColumn("text_sha256", F.unhex(F.sha2("text", 256)))
        .groupBy("cell", "hash", "chain")
        .agg(F.any_value("text_sha256").alias("text_sha256"), F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))
        .withColumn("links", F.count(F.lit(1)).over(of_hash))
        .withColumn("rows", F.sum("group_size").over(of_hash))
        # The bitmap lets some hashes of one row through, which are filed already.
        .where("rows > 1")
        .join(cells, "cell")
        .select(alone.columns)
    )
    return depth, cells, materialize(alone.unionByName(chained), "exact-index")


def exact_duplicates(docs: DataFrame, capacity: int = CAPACITY, carried: Sequence[str] = ()) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row of (doc_id, text).

    Null counts as the empty text.  Of equal texts the largest doc_id stays; rows
    that repeat it stay too.  A row without doc_id stays only if no row of its
    text has one.  Columns named in ``carried`` are passed on, others are ignored.
    """
    docs = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *carried
    )
    prints = materialize(
        docs.select("doc_id", F.xxhash64("text").alias("hash"), F.unhex(F.sha2("text", 256)).alias("text_sha256"), *carried), "prints"
    )
    depth, cells, index = build_index(docs.select("doc_id", "text"), prints, capacity)
    entry = index.select("bucket", "hash", "links", F.col("text_sha256").alias("entry_sha256"), "keep_id", "group_size").alias("entry")
    rows = prints.withColumn("cell", cell(depth)).join(cells.select("cell", "bucket"), "cell").alias("row")
    same = (F.col("links") == 1) | (F.col("text_sha256") == F.col("entry_sha256"))
    return rows.join(entry, (F.col("row.bucket") == F.col("entry.bucket")) & (F.col("row.hash") == F.col("entry.hash")) & same).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.coalesce(F.col("doc_id") == F.col("keep_id"), F.col("keep_id").isNull()).alias("kept"),
        F.lower(F.hex("text_sha256")).alias("text_sha256"),
        *carried,
    )


SQL = """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       coalesce(doc_id = max(doc_id) OVER same, max(doc_id) OVER same IS NULL) AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""
