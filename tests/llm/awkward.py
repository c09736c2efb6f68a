"""Rows that every operator must take: nulls, empty and long texts, repeats, clashing names."""

import random

from pyspark.sql import functions as F

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
CLASHING = ["row", "key", "node", "component", "place", "part", "may", "hash", "n", "begin", "end", "bucket", "score"]


def prose(seed, words=120, letters="abcdefgh"):
    r = random.Random(seed)
    return " ".join("".join(r.choices(letters, k=r.randint(2, 7))) for _ in range(words))


def rows():
    one, near = prose(1), prose(1).replace(" ", " x ", 1)
    return [
        (1, None), (2, ""), (3, " \n\t "), (4, prose(4, 40_000)), (5, one), (5, one), (6, one), (7, near),
        (None, one), (None, None), (8, "one two"), (9, "One  TWO"), (10, "Straße ça \U0001f600 Ñandú 中文 " * 3),
        (11, "###!!!"), (12, "a\n" * 300),
    ]


def documents(spark, with_rows=True):
    data = [(i, t, "en" if t else None, None, None) for i, t in rows()] if with_rows else []
    df = spark.createDataFrame(data, SCHEMA)
    for name in CLASHING:
        df = df.withColumn(name, F.lit("other"))
    return df


def labels(spark, data=()):
    return spark.createDataFrame(list(data), "doc_id bigint, quality int, toxic int")
