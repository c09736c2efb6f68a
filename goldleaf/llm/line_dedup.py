"""Lines that several documents share, dropped from all but one of them.

Native Spark throughout.  Lines are exploded and normalised, their keys hashed
to 128 bits, and the documents per hash counted.  Rows look up which of their
places go, and put the rest together by position.  The text itself is never
sent with its lines, and crosses the network once at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldleaf.llm.bitmaps import possible
from goldleaf.sources.tables import materialize

MIN_CHARS, MIN_DOCS = 20, 3
SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z as a-z."""
    key = F.btrim(line, F.lit(SPACE))
    # lower() is much the faster one, and the same where all characters are ASCII
    return F.when(F.length(key) == F.octet_length(key), F.lower(key)).otherwise(F.translate(key, UPPER, LOWER))


def key_hashes(*columns: Column) -> tuple[Column, Column]:
    """Two 64-bit hashes; one would let a few of 10**12 lines meet."""
    return F.xxhash64(*columns), F.xxhash64(F.lit(1), *columns)


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text, and the hashes that name a row; rows with both equal have one name, and one result."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    row_1, row_2 = key_hashes(F.col("text"), F.col("doc_id"))
    return docs.withColumns({"row_1": row_1, "row_2": row_2})


def long_lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """row_1, row_2, doc_id, at, line_1, line_2: a row per line whose key is long enough."""
    lines = docs.select("row_1", "row_2", "doc_id", F.posexplode(F.split("text", "\n")).alias("at", "line"))
    lines = lines.withColumn("key", line_key(F.col("line"))).where(F.length("key") >= min_chars)
    line_1, line_2 = key_hashes(F.col("key"))
    return lines.select("row_1", "row_2", "doc_id", "at", line_1.alias("line_1"), line_2.alias("line_2"))


def shared_lines(lines: DataFrame, min_docs: int) -> DataFrame:
    """line_1, line_2, keep_id of the keys in at least ``min_docs`` documents.

    A document is counted once per line in the first step, dealt out by line
    and document, and a line's documents are added up before they meet.
    """
    return (
        lines.select("line_1", "line_2", "doc_id")
        .distinct()
        .groupBy("line_1", "line_2")
        .agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("keep_id"))
        .where(F.col("n_docs") >= min_docs)
        .select("line_1", "line_2", "keep_id")
    )


def drop_shared_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """The rows with ``text`` less its dropped lines, and n_lines, n_dropped.

    A null text is one empty line.  Rows of one doc_id are one document, and so
    are those without doc_id, which counts as the smallest.  A line is dropped if its
    key has ``min_chars`` code points or more, ``min_docs`` documents hold the
    key, and another one of them has a larger doc_id.  All columns are passed on
    but ones named n_lines or n_dropped.
    """
    source = keyed(docs)
    lines = long_lines(source, min_chars)
    shared = materialize(shared_lines(lines, min_docs), "shared-lines")
    gone = (
        possible(lines, shared, "line_1")
        .join(shared, ["line_1", "line_2"])
        .where(~F.col("doc_id").eqNullSafe(F.col("keep_id")))
        .groupBy("row_1", "row_2")
        .agg(F.collect_set("at").alias("gone"))
    )
    gone = materialize(gone, "dropped-lines")  # stored, so that a join with many equal rows can be split
    others = [c for c in docs.columns if c not in ("text", "n_lines", "n_dropped")]
    row_1, row_2 = key_hashes(F.coalesce(F.col("text").cast("string"), F.lit("")), F.col("doc_id").cast("bigint"))
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in others]).alias("row"),
        F.split(F.coalesce(F.col("text").cast("string"), F.lit("")), "\n").alias("lines"),
        row_1.alias("row_1"),
        row_2.alias("row_2"),
    )
    places = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    left = F.transform(places, lambda at: F.get("lines", at))
    done = rows.join(gone, ["row_1", "row_2"], "left").select(
        "row",
        F.array_join(F.when(F.col("gone").isNull(), F.col("lines")).otherwise(left), "\n").alias("text"),
        F.size("lines").cast("bigint").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("bigint").alias("n_dropped"),
    )
    named = [F.col(f"row.`{c}`").alias(c) if c in others else F.col(c) for c in docs.columns if c in others or c == "text"]
    return done.select(*named, "n_lines", "n_dropped")


SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS id, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
keys AS (
  SELECT id, doc_id, place, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}') AS key
  FROM (SELECT id, doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS place FROM docs)),
shared AS (
  SELECT key, max(doc_id) AS keep_id FROM keys WHERE length(key) >= {MIN_CHARS}
  GROUP BY key HAVING count(DISTINCT doc_id) + max(CASE WHEN doc_id IS NULL THEN 1 ELSE 0 END) >= {MIN_DOCS}),
marked AS (
  SELECT id, k.doc_id, place, line, shared.key IS NOT NULL AND k.doc_id IS DISTINCT FROM keep_id AS gone
  FROM keys k LEFT JOIN shared ON shared.key = k.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY id, doc_id
"""
