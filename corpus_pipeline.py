"""The corpus pipeline: stages applied to `documents`, one after another.

Quality first, then exact copies, near copies and repeated passages, and what is
left is packed into sequences of tokens.  All stages but the last return the
columns of `documents`.  They decide about each row, with or without doc_id; rows
are told apart by a 64-bit hash of what the decision depends on.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldleaf.llm.bitmaps import one_of_each, possible, without_keys
from goldleaf.llm.exact_dedup import exact_duplicates
from goldleaf.llm.near_dedup import near_duplicates
from goldleaf.llm.packing import pack_documents
from goldleaf.llm.passages import without_repeats
from goldleaf.llm.quality_lm import classify
from goldleaf.sources.tables import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


#: Name of the rows' key while a stage decides.
KEY = "row_key_of_stage"


def _keyed(docs: DataFrame, *others: str) -> DataFrame:
    """Rows with a key of doc_id, text and ``others``; a null text is the empty one."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.withColumn(KEY, F.xxhash64(F.col("doc_id").cast("bigint"), text, *others))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the Kneser-Ney model of trusted text rejects go."""
    keyed = _keyed(docs, "lang")
    judged = classify(keyed, spark.read.parquet(f"{sf_dir}/labels.parquet"), carried=[KEY])
    rejected = materialize(judged.where("NOT kept").select(KEY), "rejected")
    return without_keys(keyed, rejected, KEY).select(docs.columns)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one row with the largest doc_id stays, or one without if none has any."""
    keyed = _keyed(docs)
    judged = materialize(exact_duplicates(keyed, carried=[KEY]).where("group_size > 1").select(KEY, "kept"), "copies")
    rest = without_keys(keyed, judged.where("NOT kept"), KEY)
    again = judged.where("kept").groupBy(KEY).count().where("count > 1").select(KEY)
    return one_of_each(rest, materialize(again, "again"), KEY).select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates stays: that with the least doc_id, or one without if none has any."""
    keyed = _keyed(docs)
    judged = near_duplicates(keyed.select(F.col(KEY).alias("doc_id"), "text")).withColumnRenamed("doc_id", KEY)
    judged = materialize(judged.select(KEY, "component_id", "kept"), "near")
    groups = judged.where("NOT kept").select("component_id").distinct()
    members = judged.join(groups, "component_id", "left_semi").select(KEY, "component_id")
    names = possible(keyed.select(KEY, "doc_id"), members, KEY)
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", KEY))[KEY]
    stay = members.join(names.hint("merge"), KEY).groupBy("component_id").agg(first.alias(KEY))
    dropped = materialize(members.select(KEY).join(stay.select(KEY), KEY, "left_anti"), "near-copies")
    return without_keys(keyed, dropped, KEY).select(docs.columns)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages go from the texts; a document stays, even with an empty text."""
    carried = [c for c in docs.columns if c not in ("doc_id", "text", "n_chars")]
    cut = without_repeats(docs, text=True, carried=carried)
    new = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("bigint")}
    return cut.select(*[new.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of tokens and their places in sequences of 4096."""
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("suffix_array_dedup", suffix_array_dedup),
    ("packing", packing),
]

# The language model, near copies and passages have no SQL form.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages on `documents`, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
