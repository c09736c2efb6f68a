"""Question routing, guardrails and guarded answers, as batch jobs.

All checks are column expressions on the question row, so a batch of questions
needs no shuffle; only the four-row table of tool texts is looked up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldleaf.functions import phrases as P
from goldleaf.functions.text import blank_to_empty, contains_any, first_json_object, strip_chars, strip_space
from goldleaf.operators.dashboards import tool_text
from goldleaf.operators.skew import lookup_join

TOOL_NAMES = list(P.TOOL_HEADINGS)


def route(question: Column, guarded: bool = False) -> Column:
    """Tool name by keywords; the first matching rule wins, substrings count."""
    low = F.lower(blank_to_empty(question))
    property_words = P.PROPERTY_WORDS_GUARDED if guarded else P.PROPERTY_WORDS
    return (
        F.when(contains_any(low, P.TREND_WORDS), "monthly_trend")
        .when(contains_any(low, property_words), "revenue_by_property_type")
        .when(contains_any(low, P.PAYMENT_WORDS), "payment_methods")
        .otherwise("top_destinations")
    )


def input_reason(question: Column) -> Column:
    """'ok', or why the question is refused; checks run in this order."""
    text = strip_space(blank_to_empty(question))
    low = F.lower(text)
    return (
        F.when(text == "", P.REASON_EMPTY_QUESTION)
        .when(F.length(text) > P.MAX_QUESTION_CHARS, P.REASON_TOO_LONG)
        .when(contains_any(low, P.BLOCKED_WORDS), P.REASON_BLOCKED)
        .when(~contains_any(low, P.TOPIC_WORDS), P.REASON_OFF_TOPIC)
        .otherwise(P.REASON_OK)
    )


def _grounding_tokens(text: Column) -> Column:
    """Tokens longer than four, stripped of punctuation and lowered afterwards.

    The length is taken before stripping, so '.....' stays as an empty token.
    """
    return F.transform(
        F.filter(F.split(text, r"\s+"), lambda w: F.length(w) > 4),
        lambda w: F.lower(strip_chars(w, P.TOKEN_EDGES)),
    )


def output_reason(answer: Column, tool_text: Column) -> Column:
    """'ok', or why the answer is refused: blank, or no token shared with the data."""
    text = strip_space(blank_to_empty(answer))
    shared = F.arrays_overlap(_grounding_tokens(blank_to_empty(tool_text)), _grounding_tokens(text))
    return (
        F.when(text == "", P.REASON_EMPTY_ANSWER)
        .when(~shared, P.REASON_NOT_GROUNDED)
        .otherwise(P.REASON_OK)
    )


def route_questions(questions: DataFrame) -> DataFrame:
    """Both routing variants per question."""
    return questions.select(
        "question_id",
        route(F.col("question")).alias("tool"),
        route(F.col("question"), guarded=True).alias("guarded_tool"),
    )


def input_guardrail(questions: DataFrame) -> DataFrame:
    reason = input_reason(F.col("question"))
    return questions.select("question_id", reason.alias("reason")).select(
        "question_id", (F.col("reason") == P.REASON_OK).alias("allowed"), "reason"
    )


def output_guardrail(answers: DataFrame) -> DataFrame:
    """Check of (answer_id, answer, tool_text) rows."""
    reason = output_reason(F.col("answer"), F.col("tool_text"))
    return answers.select("answer_id", reason.alias("reason")).select(
        "answer_id", (F.col("reason") == P.REASON_OK).alias("allowed"), "reason"
    )


def parse_tool_choices(replies: DataFrame, guarded: bool = False) -> DataFrame:
    """Tool choice from raw routing replies (question_id, question, reply).

    A reply without a readable JSON object falls back to keywords without
    arguments.  A readable choice of an unknown tool stays, with known = false.
    ``rows_wanted`` is the tool's row argument.  As with a call that does not fit
    the tool, arguments the tool does not have make it run with its defaults.
    """
    body = first_json_object(F.col("reply"))
    readable = F.json_object_keys("body").isNotNull()
    parameter = (
        F.when(F.col("tool") == "top_destinations", "limit")
        .when(F.col("tool") == "monthly_trend", "months")
        .otherwise("")
    )
    fits = F.size(F.array_except(F.col("names"), F.array("parameter"))) == 0
    number = F.when(F.col("parameter") == "limit", F.get_json_object("args", "$.limit")).otherwise(
        F.get_json_object("args", "$.months")
    )
    rows = F.floor(number.try_cast("double")).try_cast("int")
    return (
        replies.select("question_id", "question", body.alias("body"))
        .withColumn("from_reply", readable)
        .select(
            "question_id",
            "from_reply",
            F.when(F.col("from_reply"), F.get_json_object("body", "$.tool"))
            .otherwise(route(F.col("question"), guarded))
            .alias("tool"),
            F.when(F.col("from_reply"), F.get_json_object("body", "$.args")).alias("args"),
        )
        .withColumns({"names": F.json_object_keys("args"), "parameter": parameter})
        .withColumn("rows", F.when(fits, rows))
        .select(
            "question_id",
            "from_reply",
            "tool",
            F.when(F.col("rows") >= 0, F.col("rows")).alias("rows_wanted"),
            F.coalesce(F.col("tool").isin(TOOL_NAMES), F.lit(False)).alias("known"),
        )
    )


def most_rows_wanted(choices: DataFrame) -> int:
    """The largest row argument of a batch, for ``tool_texts(most=...)``."""
    return choices.agg(F.coalesce(F.max("rows_wanted"), F.lit(0))).first()[0]


def _with_tool(asked: DataFrame, tool_texts: DataFrame) -> DataFrame:
    """Adds ``data``, the tool's text with the wanted number of rows; NULL if unknown.

    Texts of ``sized_texts`` are joined by tool and number of rows.  There are four
    tools, so each is a hot key; either side is a plain exchange, which adaptive
    execution splits where the texts are too large to broadcast.  Texts that come
    with their lines in one row per tool (``tool_texts``) are cut per question.
    """
    if "rows_wanted" in tool_texts.columns:
        wanted = F.col("rows_wanted") if "rows_wanted" in asked.columns else F.lit(None).cast("int")
        texts = tool_texts.select(
            F.col("tool").alias("_tool"),
            F.coalesce("rows_wanted", F.lit(-1)).alias("_rows"),
            F.col("tool_text").alias("data"),
            *[c for c in tool_texts.columns if c == "out_reason"],
        )
        same = (F.col("tool") == F.col("_tool")) & (F.coalesce(wanted, F.lit(-1)) == F.col("_rows"))
        return asked.join(texts, same, "left").drop("_tool", "_rows")
    joined = lookup_join(asked, tool_texts, "tool", spread_by="question_id")
    if "rows_wanted" not in asked.columns:
        return joined.withColumn("data", F.col("tool_text"))
    return joined.withColumn(
        "data",
        F.when(F.col("rows_wanted").isNull(), F.col("tool_text")).otherwise(tool_text(F.col("rows_wanted"))),
    )


def agent_answers(questions: DataFrame, tool_texts: DataFrame, choices: DataFrame | None = None) -> DataFrame:
    """Answers without guardrails: the chosen tool's text, or a list of the tools.

    ``choices`` (question_id, tool, rows_wanted) replaces the keyword route; each
    question id must occur at most once in it, and a question without a choice
    takes the keyword route.  A column ``answer`` in ``questions`` holds answers
    worded elsewhere, which stand for the tool's text where they are not NULL.
    """
    worded = F.col("answer") if "answer" in questions.columns else F.lit(None).cast("string")
    asked = questions.select("question_id", route(F.col("question")).alias("tool"), worded.alias("worded"))
    if choices is not None:
        chosen = choices.select("question_id", F.col("tool").alias("chosen"), "rows_wanted", F.lit(True).alias("has_choice"))
        asked = asked.join(chosen, "question_id", "left").select(
            "question_id", F.when(F.col("has_choice"), F.col("chosen")).otherwise(F.col("tool")).alias("tool"), "rows_wanted", "worded"
        )
    return _with_tool(asked, tool_texts).select(
        "question_id",
        "tool",
        F.when(F.col("data").isNull(), P.NO_TOOL_OPEN)
        .when(F.col("worded").isNotNull(), F.concat(F.lit("AGENT: "), strip_space(F.col("worded"))))
        .otherwise(F.concat(F.lit("AGENT (raw tool data):\n"), "data"))
        .alias("answer"),
    )


def guarded_answers(
    questions: DataFrame, tool_texts: DataFrame, choices: DataFrame | None = None
) -> DataFrame:
    """Input check, route, tool, output check; refusals are fixed messages.

    ``choices`` is as in agent_answers.  A column ``answer`` in ``questions`` holds
    answers worded elsewhere; each is checked against its tool's text, and where
    it is NULL the text itself is the answer.  Without worded answers the output
    check runs once per text instead of once per question.
    """
    worded = "answer" in questions.columns
    asked = questions.withColumn("reason", input_reason(F.col("question")))
    allowed = F.col("reason") == P.REASON_OK
    if choices is None:
        asked = asked.withColumn("tool", F.when(allowed, route(F.col("question"), guarded=True)))
    else:
        chosen = choices.select("question_id", "tool", "rows_wanted")
        asked = asked.join(chosen, "question_id", "left").withColumn("tool", F.when(allowed, F.col("tool")))
    answer = F.coalesce("answer", "data") if worded else F.col("data")
    if worded or (choices is not None and "rows_wanted" not in tool_texts.columns):
        joined = _with_tool(asked, tool_texts).withColumn("out_reason", output_reason(answer, F.col("data")))
    else:
        checked = tool_texts.withColumn("out_reason", output_reason(F.col("tool_text"), F.col("tool_text")))
        joined = _with_tool(asked, checked)
    reply = (
        F.when(~allowed, F.concat(F.lit(P.REFUSED_PREFIX), "reason"))
        .when(F.col("data").isNull(), P.NO_TOOL_GUARDED)
        .when(F.col("out_reason") != P.REASON_OK, P.NO_RELIABLE_ANSWER)
        .otherwise(F.concat(F.lit("AGENT: "), answer))
    )
    return joined.select("question_id", allowed.alias("allowed"), "tool", reply.alias("reply"))
