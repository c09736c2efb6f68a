"""Routing and guardrails against plain Python written from the rules."""

import random

from goldleaf.functions import phrases as P
from goldleaf.operators import questions as Q

EDGES = ".,:%$()"


def python_route(q, guarded):
    low = (q or "").lower()
    words = P.PROPERTY_WORDS_GUARDED if guarded else P.PROPERTY_WORDS
    for tool, hints in (
        ("monthly_trend", P.TREND_WORDS), ("revenue_by_property_type", words), ("payment_methods", P.PAYMENT_WORDS),
    ):
        if any(h in low for h in hints):
            return tool
    return "top_destinations"


def python_input(q):
    q = (q or "").strip()
    if not q:
        return P.REASON_EMPTY_QUESTION
    if len(q) > 500:
        return P.REASON_TOO_LONG
    if any(b in q.lower() for b in P.BLOCKED_WORDS):
        return P.REASON_BLOCKED
    return P.REASON_OK if any(t in q.lower() for t in P.TOPIC_WORDS) else P.REASON_OFF_TOPIC


def python_output(answer, data):
    a = (answer or "").strip()
    if not a:
        return P.REASON_EMPTY_ANSWER
    def tokens(text):
        return {w.strip(EDGES).lower() for w in text.split() if len(w) > 4}
    return P.REASON_OK if tokens(data) & tokens(a) else P.REASON_NOT_GROUNDED


def random_texts(seed, n):
    rng = random.Random(seed)
    vocabulary = (
        P.TREND_WORDS + P.PROPERTY_WORDS + P.PAYMENT_WORDS + P.BLOCKED_WORDS + P.TOPIC_WORDS
        + ["stop", "learn", "the", "Paris", "(Paris):", "$1,234", ".....", "%%%%%", "a" * 120, "Über", "\t", "\n", "  "]
    )
    texts = [None, "", " \t\n", "x" * 500 + "top", " " * 600 + "top", "a" * 497 + "top", "a" * 498 + "top"]
    while len(texts) < n:
        text = rng.choice([" ", "  ", "\n", ", "]).join(rng.choices(vocabulary, k=rng.randint(1, 9)))
        texts.append(rng.choice([str, str.upper, str.title])(text))
    return texts


def test_router_examples(spark):
    asked = {
        "Where did bookings bring in most money?": "top_destinations",
        "Show the growth of bookings over time": "monthly_trend",
        "Which kind of property do guests book?": "revenue_by_property_type",
        "Share of each payment method among guests": "payment_methods",
    }
    df = spark.createDataFrame([(q, q) for q in asked], "question_id string, question string")
    assert {r.question_id: r.tool for r in Q.route_questions(df).collect()} == asked


def test_router_and_input_guardrail_match_python(spark):
    texts = random_texts(1, 400)
    df = spark.createDataFrame(list(enumerate(texts)), "question_id long, question string")
    for r in Q.route_questions(df).collect():
        assert r.tool == python_route(texts[r.question_id], False)
        assert r.guarded_tool == python_route(texts[r.question_id], True)
    for r in Q.input_guardrail(df).collect():
        assert r.reason == python_input(texts[r.question_id]), repr(texts[r.question_id])
        assert r.allowed == (r.reason == "ok")


def test_input_guardrail_examples(spark):
    asked = {
        "Where did bookings bring in most money?": "ok",
        "": "Empty question.",
        "Will it rain in Paris on Sunday?": P.REASON_OFF_TOPIC,
        "please hack the account": "Question contains blocked content.",
    }
    df = spark.createDataFrame([(q, q) for q in asked], "question_id string, question string")
    assert {r.question_id: r.reason for r in Q.input_guardrail(df).collect()} == asked


def test_output_guardrail_matches_python(spark):
    answers, data = random_texts(2, 300), [t or "" for t in random_texts(3, 300)]
    triples = [(i, a, d) for i, (a, d) in enumerate(zip(answers, data))]
    triples.append((300, "so ..... it is", "then ..... it was"))  # empty token on both sides
    df = spark.createDataFrame(triples, "answer_id long, answer string, tool_text string")
    for r in Q.output_guardrail(df).collect():
        _, answer, tool_text = triples[r.answer_id]
        assert r.reason == python_output(answer, tool_text), (answer, tool_text)


def tools(spark):
    texts = {
        "top_destinations": ("Top destinations by revenue:", ["Paris", "Rome", "Oslo"]),
        "monthly_trend": ("a", ["b", "c"]),
        "revenue_by_property_type": ("Revenue by property type:", ["house"]),
        "payment_methods": ("Payment methods", []),
    }
    return spark.createDataFrame(
        [(t, h, lines, "\n".join([h, *lines])) for t, (h, lines) in texts.items()],
        "tool string, heading string, lines array<string>, tool_text string",
    )


TOP = "Top destinations by revenue:\nParis\nRome\nOslo"


def test_guarded_answers(spark):
    df = spark.createDataFrame(
        [(1, "top places"), (2, None), (3, "hack the trip"), (4, "monthly money")], "question_id long, question string"
    )
    replies = {r.question_id: r.reply for r in Q.guarded_answers(df, tools(spark)).collect()}
    assert replies == {
        1: "AGENT: " + TOP,
        2: "AGENT: I can't help with that. Empty question.",
        3: "AGENT: I can't help with that. Question contains blocked content.",
        4: P.NO_RELIABLE_ANSWER,  # no token of the data is longer than four
    }


def test_guarded_answers_check_worded_answers(spark):
    df = spark.createDataFrame(
        [(1, "top places", "The destinations are fine"), (2, "top places", "I do not know"), (3, "top places", None)],
        "question_id long, question string, answer string",
    )
    replies = {r.question_id: r.reply for r in Q.guarded_answers(df, tools(spark)).collect()}
    assert replies == {
        1: "AGENT: The destinations are fine",
        2: P.NO_RELIABLE_ANSWER,
        3: "AGENT: " + TOP,
    }


def test_tool_choices_from_replies(spark):
    replies = {
        1: ('Sure: {"tool": "monthly_trend", "args": {"months": 1}} ok?', "monthly_trend", 1, True),
        2: ('{"tool": "payment_methods"}', "payment_methods", None, True),
        3: ('{"tool": broken}', "payment_methods", None, True),
        4: ("no json", "payment_methods", None, True),
        5: ('{"tool": "flights", "args": {"limit": 2}}', "flights", None, False),
        6: ('{"args": {}}', None, None, False),
        7: (None, "payment_methods", None, True),
        8: ('{"tool": "top_destinations", "args": {"limit": "2"}}', "top_destinations", 2, True),
        9: ('{"tool": "top_destinations", "args": {"limit": 2, "x": 1}}', "top_destinations", None, True),
        10: ('{"tool": "top_destinations", "args": {"months": 2}}', "top_destinations", None, True),
        11: ('{"tool": "top_destinations", "args": null}', "top_destinations", None, True),
        12: ('{"tool": "top_destinations", "args": {"limit": -1}}', "top_destinations", None, True),
        13: ('{"tool": "monthly_trend", "args": {"months": 2.9}}', "monthly_trend", 2, True),
        14: ('{"tool": "top_destinations", "args": {"limit": 99}}', "top_destinations", 99, True),
    }
    df = spark.createDataFrame(
        [(k, "what do they pay", v[0]) for k, v in replies.items()], "question_id long, question string, reply string"
    )
    choices = Q.parse_tool_choices(df)
    got = {r.question_id: (r.tool, r.rows_wanted, r.known) for r in choices.collect()}
    assert got == {k: v[1:] for k, v in replies.items()}
    assert Q.most_rows_wanted(choices) == 99
    answers = {r.question_id: r.answer for r in Q.agent_answers(df, tools(spark), choices).collect()}
    assert answers[5] == answers[6] == P.NO_TOOL_OPEN
    assert answers[1] == "AGENT (raw tool data):\na\nb"
    assert answers[8] == "AGENT (raw tool data):\nTop destinations by revenue:\nParis\nRome"
    assert answers[9] == answers[14] == "AGENT (raw tool data):\n" + TOP
    assert answers[13] == "AGENT (raw tool data):\na\nc\nb"  # the trend runs oldest first
    guarded = {r.question_id: r.reply for r in Q.guarded_answers(df, tools(spark), choices).collect()}
    assert guarded[5] == guarded[6] == P.NO_TOOL_GUARDED
    assert guarded[8] == "AGENT: Top destinations by revenue:\nParis\nRome"


def test_answers_lose_no_question_and_take_worded_ones(spark):
    texts = Q.agent_answers(
        spark.createDataFrame(
            [("a", "revenue by month", None), ("b", "payment methods", "  Cards lead.\n"), ("c", "x", None), ("d", "y", "words")],
            "question_id string, question string, answer string",
        ),
        spark.createDataFrame([(t, t + " text", []) for t in ("monthly_trend", "payment_methods", "top_destinations")], "tool string, tool_text string, lines array<string>"),
    )
    assert {r.question_id: r.answer for r in texts.collect()} == {
        "a": "AGENT (raw tool data):\nmonthly_trend text", "b": "AGENT: Cards lead.",
        "c": "AGENT (raw tool data):\ntop_destinations text", "d": "AGENT: words",
    }


def test_questions_without_a_choice_take_the_keyword_route(spark):
    questions = spark.createDataFrame([("a", "revenue by month"), ("b", "payment methods")], "question_id string, question string")
    choices = spark.createDataFrame([("a", "nonsense", None)], "question_id string, tool string, rows_wanted int")
    tools = spark.createDataFrame([("payment_methods", "text", "head", ["l"])], "tool string, tool_text string, heading string, lines array<string>")
    got = {r.question_id: (r.tool, r.answer) for r in Q.agent_answers(questions, tools, choices).collect()}
    assert got["b"] == ("payment_methods", "AGENT (raw tool data):\ntext")
    assert got["a"][0] == "nonsense" and got["a"][1].startswith("AGENT")
