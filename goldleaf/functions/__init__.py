from goldleaf.functions.numbers import grouped_number, money, plain_number, share
from goldleaf.functions.text import (
    blank_to_empty,
    contains_any,
    first_json_object,
    long_words,
    normal_key,
    strip_chars,
    strip_space,
)

__all__ = [
    "blank_to_empty",
    "contains_any",
    "first_json_object",
    "grouped_number",
    "long_words",
    "money",
    "normal_key",
    "plain_number",
    "share",
    "strip_chars",
    "strip_space",
]
