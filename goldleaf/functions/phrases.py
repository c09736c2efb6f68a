"""Fixed values.

Word lists, messages and limits that decide results.  They are stated as plain
text because equal results need equal values.
"""

from __future__ import annotations

# ---- vendor evidence ------------------------------------------------------
MIN_EVIDENCE_LINES = 30
LOW_EVIDENCE = "LOW - too few orders, treat rates with caution"
ENOUGH_EVIDENCE = "OK"

# ---- question routing: checked in this order, first hit wins --------------
TREND_WORDS = ["trend", "month", "over time", "growing", "growth"]
PROPERTY_WORDS = ["property type", "kind of property", "house", "apartment", "hotel", "ski", "type"]
PROPERTY_WORDS_GUARDED = ["property type", "kind of property", "type", "ski"]
PAYMENT_WORDS = ["payment", "pay", "credit card", "paypal"]

# ---- guardrails -----------------------------------------------------------
MAX_QUESTION_CHARS = 500
BLOCKED_WORDS = ["password", "credit card number", "ssn", "hack", "exploit"]
TOPIC_WORDS = [
    "destination", "revenue", "booking", "trend", "month", "property", "payment", "pay", "travel",
    "trip", "earn", "money", "popular", "top", "growth", "growing", "country", "hotel", "guest",
]
TOKEN_EDGES = ".,:%$()"
REASON_OK = "ok"
REASON_EMPTY_QUESTION = "Empty question."
REASON_TOO_LONG = "Question too long (over 500 characters)."
REASON_BLOCKED = "Question contains blocked content."
REASON_OFF_TOPIC = (
    "Off-topic. This agent only answers travel-booking analytics questions "
    "(destinations, revenue, bookings, property types, payments, trends)."
)
REASON_EMPTY_ANSWER = "Empty answer."
REASON_NOT_GROUNDED = "Answer does not appear grounded in the tool data."
REFUSED_PREFIX = "AGENT: I can't help with that. "
NO_RELIABLE_ANSWER = "AGENT: I could not produce a reliable answer for that. Please rephrase."
NO_TOOL_GUARDED = "AGENT: No tool available for that."
NO_TOOL_OPEN = (
    "AGENT: I don't have a tool for that. Available: "
    "top_destinations, monthly_trend, revenue_by_property_type, payment_methods"
)

# ---- tool headings --------------------------------------------------------
TOOL_HEADINGS = {
    "top_destinations": "Top destinations by revenue:",
    "monthly_trend": "Monthly revenue trend (most recent):",
    "revenue_by_property_type": "Revenue by property type:",
    "payment_methods": "Payment methods (completed payments):",
}

# ---- retrieval ------------------------------------------------------------
MIN_CHUNK_CHARS = 40
MIN_QUESTION_WORD_CHARS = 3
CHUNKS_KEPT = 2
CONTEXT_CHARS = 1800

# ---- evaluation -----------------------------------------------------------
GOVERNANCE_MARKER = "GOVERNANCE"
LOW_DATA_SIGNALS = [
    "1 purchase order", "one purchase order", "few orders", "limited data", "limited order",
    "single order", "1 order", "one order", "insufficient", "only 1", "1 po",
]
CAUTION_SIGNALS = [
    "caution", "not statistically reliable", "not reliable", "unreliable", "not representative",
    "treat", "cannot be", "should not", "limited", "too few",
]
GOVERNANCE_PHRASES = [
    "caution", "too few orders", "not statistically reliable", "not reliable", "unreliable",
    "limited order", "insufficient",
]
ANSWER_SNIPPET_CHARS = 300
ERROR_BODY_CHARS = 300
