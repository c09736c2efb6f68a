"""Chunking of Markdown texts and retrieval of the chunks a question asks for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from goldleaf.functions import phrases as P
from goldleaf.functions.text import blank_to_empty, long_words, strip_space
from goldleaf.sources.tables import materialize


BLOCK = 256  # questions that meet a guide at once


def chunks(text: Column) -> Column:
    """Sections of a Markdown text: split before headings, stripped, longer than 40."""
    sections = F.transform(F.split(text, r"\n(?=#+ )"), strip_space)
    return F.filter(sections, lambda c: F.length(c) > P.MIN_CHUNK_CHARS)


def with_context(rows: DataFrame, text: Column, question: Column, into: str = "context") -> DataFrame:
    """Adds the retrieved context of one question over one text, row by row.

    A chunk scores the number of distinct question words (longer than three,
    lowered, punctuation kept) among its own words.  The best two chunks with a
    score are joined by a blank line, earlier chunks first on ties; without any,
    the opening chunk is taken.  A text without chunks gives empty text.

    The steps are separate columns because each is used more than once; Spark
    keeps them apart, so a text is split and scored once.
    """
    asked = F.array_distinct(long_words(F.lower(blank_to_empty(question)), P.MIN_QUESTION_WORD_CHARS))

    def scored(part: Column, place: Column) -> Column:
        hits = F.size(F.array_intersect(F.col("_asked"), F.split(F.lower(part), r"\s+")))
        return F.struct((-hits).alias("rank"), place.alias("place"), part.alias("part"))

    best = F.slice(F.array_sort(F.transform("_parts", scored)), 1, P.CHUNKS_KEPT)
    relevant = F.transform(F.filter(best, lambda c: c["rank"] < 0), lambda c: c["part"])
    kept = F.when(F.size("_relevant") > 0, F.col("_relevant")).otherwise(F.slice("_parts", 1, 1))
    return (
        rows.withColumns({"_parts": chunks(text), "_asked": asked})
        .withColumn("_relevant", relevant)
        .withColumn(into, F.substring(F.array_join(kept, "\n\n"), 1, P.CONTEXT_CHARS))
        .drop("_parts", "_asked", "_relevant")
    )


def context_of_guides(questions: DataFrame, guides: DataFrame, by: str) -> DataFrame:
    """``by`` and context: the context of one question per ``by`` over all its guides, as if they were one text.

    ``questions`` has ``by`` and question, a row for each; ``guides`` has ``by``,
    guide_id and description, and are in the order of their ids.  Scores and ties
    are those of with_context.  A guide is chunked and scored in its row, and each
    task keeps the best two chunks of a ``by``, so the guides may be any number.
    One without any text has no row.
    """
    words = F.array_distinct(long_words(F.lower(blank_to_empty(F.col("question"))), P.MIN_QUESTION_WORD_CHARS))
    # stored: Spark knows the size, and where it is small it sends the questions to the guides and not the texts about
    asked = materialize(questions.select(by, words.alias("asked")), "place-questions")
    parts = guides.where(blank_to_empty(F.col("description")) != "").select(
        by, "guide_id", F.posexplode_outer(chunks(F.col("description"))).alias("chunk_no", "chunk")
    )
    scored = parts.join(asked, by).select(
        by,
        F.coalesce(F.size(F.array_intersect("asked", F.split(F.lower("chunk"), r"\s+"))), F.lit(0)).alias("hits"),
        F.col("chunk").isNull().alias("no_chunk"),
        "guide_id",
        "chunk_no",
        F.coalesce("chunk", F.lit("")).alias("chunk"),
    )
    best_first = Window.partitionBy(by).orderBy(F.desc("hits"), "no_chunk", "guide_id", "chunk_no")
    kept = (
        scored.withColumn("place", F.row_number().over(best_first))
        .where(F.col("place") <= P.CHUNKS_KEPT)
        .where((F.col("hits") > 0) | (F.col("place") == 1))
    )
    joined = F.transform(F.array_sort(F.collect_list(F.struct("place", "chunk"))), lambda one: one["chunk"])
    return kept.groupBy(by).agg(F.substring(F.array_join(joined, "\n\n"), 1, P.CONTEXT_CHARS).alias("context"))


def document_lengths(texts: DataFrame, preview_chars: int = 1200) -> DataFrame:
    """Length and opening of each text; a missing text has length zero."""
    text = blank_to_empty(F.col("description"))
    return texts.select(
        "guide_id",
        F.length(text).alias("n_chars"),
        F.substring(text, 1, preview_chars).alias("preview"),
    )


def document_length_summary(texts: DataFrame) -> DataFrame:
    return texts.agg(
        F.count(F.lit(1)).alias("n_texts"),
        F.max(F.length(blank_to_empty(F.col("description")))).alias("longest"),
    )


def chunk_documents(texts: DataFrame) -> DataFrame:
    """One row per chunk: guide_id, chunk_no from 0, chunk."""
    return texts.select(
        "guide_id", F.posexplode(chunks(F.col("description"))).alias("chunk_no", "chunk")
    )


def question_blocks(asked: DataFrame, keys: list[str]) -> DataFrame:
    """guide_id and questions: the different questions of each guide in blocks of about BLOCK.

    ``asked`` has the keys, guide_id and question; a question keeps its keys and its long words.
    """
    sizes = asked.groupBy("guide_id").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("n_blocks"))
    words = F.array_distinct(long_words(F.lower(blank_to_empty(F.col("question"))), P.MIN_QUESTION_WORD_CHARS))
    return (
        asked.join(sizes, "guide_id")
        .withColumn("block", F.pmod(F.xxhash64(*keys), F.col("n_blocks")))
        .groupBy("guide_id", "block")
        .agg(F.collect_list(F.struct(*keys, words.alias("words"))).alias("questions"))
    )


def block_contexts(blocks: DataFrame, texts: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` and context of every question of the blocks whose guide has a text.

    The guide of a block is split once, and an index made of it: of each chunk the
    words that the block asks for.  The questions are scored on the index alone.
    """
    written = texts.select("guide_id", blank_to_empty(F.col("description")).alias("description")).where("description != ''")
    asked_for = F.array_distinct(F.flatten(F.transform("questions", lambda q: q["words"])))
    index = F.transform("parts", lambda part: F.array_intersect(F.split(F.lower(part), r"\s+"), F.col("asked_for")))

    def best(question: Column) -> Column:
        hits = F.transform(
            "index", lambda own, place: F.struct((-F.size(F.array_intersect(own, question["words"]))).alias("rank"), place.alias("place"))
        )
        return F.filter(F.slice(F.array_sort(hits), 1, P.CHUNKS_KEPT), lambda hit: hit["rank"] < 0)

    found = F.transform("questions", lambda q: F.struct(*[q[k].alias(k) for k in keys], best(q).alias("best")))
    kept = F.transform("best", lambda hit: F.get("parts", hit["place"]))
    shown = F.when(F.size("best") > 0, kept).otherwise(F.slice("parts", 1, 1))
    return (
        blocks.join(written, "guide_id")
        .withColumns({"parts": chunks(F.col("description")), "asked_for": asked_for})
        .withColumn("index", index)
        .select("parts", F.inline(found))
        .select(*keys, F.substring(F.array_join(shown, "\n\n"), 1, P.CONTEXT_CHARS).alias("context"))
    )


def retrieve_chunks(requests: DataFrame, texts: DataFrame, missing: Column | None = None) -> DataFrame:
    """Context for each (request columns, guide_id, question) row; rules as in with_context.

    Equal requests are answered once.  The different questions of a guide meet its
    text in blocks, so a guide is sent, split and indexed once for each BLOCK of
    them, also one that a third of all requests ask.  ``texts`` has one row per
    guide.  ``missing`` is the context where there is no text (empty by default).
    """
    keys = ["ask_1", "ask_2"]  # two hashes of guide and question
    named = [F.col("guide_id"), blank_to_empty(F.col("question"))]
    keyed = requests.select(
        F.struct(*[F.col(f"`{c}`") for c in requests.columns]).alias("row"),
        F.xxhash64(*named).alias("ask_1"),
        F.xxhash64(F.lit(1), *named).alias("ask_2"),
    )
    asked = materialize(
        keyed.where("row.guide_id IS NOT NULL").select(*keys, "row.guide_id", "row.question").distinct(), "guide-questions"
    )
    # stored, so that the join can be split where very many rows ask the same
    contexts = materialize(block_contexts(question_blocks(asked, keys), texts, keys), "guide-contexts")
    no_text = F.lit("") if missing is None else missing
    return (
        keyed.join(contexts, keys, "left")
        .select("row.*", F.col("context").alias("_context"))
        .select(*requests.columns, F.coalesce("_context", no_text).alias("context"))
    )
