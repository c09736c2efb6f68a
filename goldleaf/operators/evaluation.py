"""Scored evaluation of agent replies against golden cases."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from goldleaf.functions import phrases as P
from goldleaf.functions.text import contains_any, strip_space

ITEMS = (
    "array<struct<type: string, name: string, arguments: string, "
    "content: array<struct<type: string, text: string>>>>"
)


def parse_responses(raw: DataFrame) -> DataFrame:
    """Structured replies from (case_id, status_code, body) rows.

    The answer is the last output text of the message items; tools and arguments
    come from the function calls.  A status other than 200 gives ok = false, an
    empty answer and no tools.  A body that cannot be read has no answer.
    """
    ok = F.coalesce(F.col("status_code") == 200, F.lit(False))
    items = F.coalesce(F.col("items"), F.array().cast(ITEMS))
    texts = F.flatten(
        F.transform(
            F.filter(items, lambda i: (i["type"] == "message") & i["content"].isNotNull()),
            lambda i: F.transform(
                F.filter(i["content"], lambda c: c["type"] == "output_text"),
                lambda c: F.coalesce(c["text"], F.lit("")),
            ),
        )
    )
    calls = F.filter(items, lambda i: i["type"] == "function_call")
    return raw.select(
        "case_id",
        ok.alias("ok"),
        F.when(
            ~ok,
            F.concat(
                F.lit("HTTP "),
                F.col("status_code").cast("string"),
                F.lit(": "),
                F.substring("body", 1, P.ERROR_BODY_CHARS),
            ),
        ).alias("error"),
        F.when(ok, F.from_json("body", f"output {ITEMS}")["output"]).alias("items"),
    ).select(
        "case_id",
        "ok",
        "error",
        F.coalesce(F.try_element_at(texts, F.lit(-1)), F.lit("")).alias("answer"),
        F.transform(calls, lambda i: i["name"]).alias("tools_called"),
        F.transform(calls, lambda i: i["arguments"]).alias("tool_args"),
    )


def responded() -> Column:
    return F.coalesce(F.col("ok"), F.lit(False)) & (
        strip_space(F.coalesce("answer", F.lit(""))) != ""
    )


def routed() -> Column:
    """The expected tool is a substring of any called tool."""
    called = F.coalesce(F.col("tools_called"), F.array().cast("array<string>"))
    return F.exists(called, lambda t: F.contains(F.coalesce(t, F.lit("")), F.col("expect_tool")))


def _low_answer() -> Column:
    return F.lower(F.coalesce("answer", F.lit("")))


def _literal_hit() -> Column:
    return F.contains(_low_answer(), F.lower("expect_contains"))


def correct_strict() -> Column:
    """First scorer: a governance case needs a low-data and a caution signal."""
    both = contains_any(_low_answer(), P.LOW_DATA_SIGNALS) & contains_any(_low_answer(), P.CAUTION_SIGNALS)
    return F.when(F.col("expect_contains") == P.GOVERNANCE_MARKER, both).otherwise(_literal_hit())


def correct() -> Column:
    """Effective scorer: a governance case passes on any warning phrase."""
    any_phrase = contains_any(_low_answer(), P.GOVERNANCE_PHRASES)
    return F.when(F.col("expect_contains") == P.GOVERNANCE_MARKER, any_phrase).otherwise(_literal_hit())


def _quoted(text: Column) -> Column:
    return F.concat(F.lit("'"), text, F.lit("'"))


def score_details(strict: bool = False) -> Column:
    """Per dimension: name, pass and detail text, as an array of structs."""
    governance = F.col("expect_contains") == P.GOVERNANCE_MARKER
    if strict:
        low, caution = (
            contains_any(_low_answer(), signals).cast("string")
            for signals in (P.LOW_DATA_SIGNALS, P.CAUTION_SIGNALS)
        )
        warned = F.concat(
            F.lit("governance: low_data="), F.initcap(low), F.lit(", caution="), F.initcap(caution)
        )
    else:
        listed = ", ".join(f"'{p}'" for p in P.GOVERNANCE_PHRASES)
        warned = F.lit(f"governance warning present (any of [{listed}])")
    called = F.concat(
        F.lit("["),
        F.array_join(F.transform("tools_called", lambda t: F.coalesce(_quoted(t), F.lit("None"))), ", "),
        F.lit("]"),
    )

    def dimension(name: str, passed: Column, detail: Column) -> Column:
        return F.struct(F.lit(name).alias("dimension"), passed.alias("pass"), detail.alias("detail"))

    return F.array(
        dimension("responded", responded(), F.coalesce("error", F.lit("non-empty answer returned"))),
        dimension(
            "routing", routed(), F.concat(F.lit("expected "), _quoted(F.col("expect_tool")), F.lit(" in "), called)
        ),
        dimension(
            "correctness",
            correct_strict() if strict else correct(),
            F.when(governance, warned).otherwise(
                F.concat(F.lit("expected answer to contain "), _quoted(F.col("expect_contains")))
            ),
        ),
    )


def score_cases(golden: DataFrame, responses: DataFrame, strict: bool = False) -> DataFrame:
    """One scored row per golden case; a case without a reply fails.

    ``scores`` holds the per-dimension details.  ``strict`` takes the first of
    the two correctness scorers.
    """
    paired = golden.join(responses, "case_id", "left").withColumns(
        {
            "responded": responded(),
            "routing": routed(),
            "correctness": correct_strict() if strict else correct(),
        }
    )
    return paired.select(
        "case_id",
        "agent",
        "verifies",
        "responded",
        "routing",
        "correctness",
        (F.col("responded") & F.col("routing") & F.col("correctness")).alias("overall_pass"),
        F.substring(F.coalesce("answer", F.lit("")), 1, P.ANSWER_SNIPPET_CHARS).alias("answer_snippet"),
        score_details(strict).alias("scores"),
    )


def evaluation_run(
    golden: DataFrame, responses: DataFrame, run_id: str | Column, run_ts: Column, strict: bool = False
) -> DataFrame:
    """History rows of one run.  Run id and time are arguments, so a retry repeats them."""
    return score_cases(golden, responses, strict).select(
        (F.lit(run_id) if isinstance(run_id, str) else run_id).alias("run_id"),
        run_ts.alias("run_ts"),
        "case_id",
        "agent",
        "verifies",
        "responded",
        "routing",
        "correctness",
        "overall_pass",
        "answer_snippet",
    )


def new_run_id() -> str:
    """A short random id, drawn once by the caller of a run."""
    return uuid4().hex[:8]


def evaluation_summary(history: DataFrame) -> DataFrame:
    """Total, passed and percent per run."""
    return history.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("n_total"),
        F.count_if("overall_pass").alias("n_passed"),
        F.round(100 * F.count_if("overall_pass") / F.count(F.lit(1)), 0).alias("pct"),
    )


def golden_cases(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """A golden set from literal rows, with the schema stated."""
    return spark.createDataFrame(
        rows,
        "case_id string, agent string, question string, expect_tool string, "
        "expect_contains string, verifies string",
    )
