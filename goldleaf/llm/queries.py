"""The registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from goldleaf.llm import exact_dedup, language_crf, line_dedup, toxicity, url_lists, vector_codes
from goldleaf.llm.byte_bpe import encode_texts
from goldleaf.llm.collocations import SQL as COLLOCATIONS_SQL
from goldleaf.llm.collocations import collocations
from goldleaf.llm.near_dedup import near_duplicates
from goldleaf.llm.packing import pack_documents
from goldleaf.llm.passages import without_repeats
from goldleaf.llm.quality_lm import classify
from goldleaf.llm.quality_rules import apply_rules

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(n: int) -> Column:
    """The fold of a row: crc32 of doc_id as text, modulo n."""
    return F.crc32(F.col("doc_id").cast("string")) % n


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


@query
def op1_language_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_crf.train(docs.where(remainder(4) != 2))
    return language_crf.predict(docs, model).select(
        "doc_id", F.coalesce(remainder(4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score"
    )


@query
def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_texts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


@query
def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


@query
def op4_counterfactual_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels.where(remainder(5) != 0))
    return toxicity.score(docs, model).select(
        "doc_id", F.coalesce(remainder(5) == 0, F.lit(False)).alias("held_out"), "score", "predicted"
    )


@query
def op5_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents"))


@query
def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


ORACLES["op6_exact_dedup"] = exact_dedup.SQL


@query
def op7_kneser_ney_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op9_temporal_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, events = table(spark, sf_dir, "pages"), table(spark, sf_dir, "events")
    return url_lists.evaluate(url_lists.page_captures(pages), url_lists.all_list_lines(events, pages))


ORACLES["op9_temporal_url_lists"] = url_lists.SQL
# The name under which the query over all events was registered beside one over fewer.
MORE_QUERIES = {"temporal_url_lists_all_events": op9_temporal_url_lists}
MORE_ORACLES = {"temporal_url_lists_all_events": url_lists.SQL}


@query
def op10_decision_list_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(table(spark, sf_dir, "embeddings"))


ORACLES["op11_vector_codes"] = vector_codes.SQL


@query
def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.drop_shared_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


ORACLES["op12_line_dedup"] = line_dedup.SQL


@query
def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


ORACLES["op13_phrase_collocations"] = COLLOCATIONS_SQL
