import math
from collections import Counter

import pandas as pd
import pytest
from awkward import documents, labels, rows

from goldleaf.llm import quality_lm as Q


def brute_model(texts, order=4):
    """Interpolated modified Kneser-Ney over characters, by its definition."""
    lines = ["\x02" * (order - 1) + t + "\x03" for t in texts]
    counts = {order: Counter(x[i : i + order] for x in lines for i in range(len(x) - order + 1))}
    for k in range(order - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    cut, totals, kinds = {}, {}, {}
    for k, table in counts.items():
        n = Counter(table.values())
        if all(n[j] for j in (1, 2, 3, 4)):
            y = n[1] / (n[1] + 2 * n[2])
            cut[k] = [0] + [min(max(j - (j + 1) * y * n[j + 1] / n[j], 0), j) for j in (1, 2, 3)]
        else:
            cut[k] = [0, 0.5, 1.0, 1.5]
        totals[k], kinds[k] = Counter(), Counter()
        for g, c in table.items():
            totals[k][g[:-1]] += c
            kinds[k][g[:-1]] += cut[k][min(c, 3)]
    alphabet = len(counts[1]) + 1

    def chance(gram):
        k = len(gram)
        if not k:
            return 1 / alphabet
        total = totals[k][gram[:-1]]
        if not total:
            return chance(gram[1:])
        c = counts[k][gram]
        return max(c - cut[k][min(c, 3)], 0) / total + kinds[k][gram[:-1]] / total * chance(gram[1:])

    def log_perplexity(text):
        line = "\x02" * (order - 1) + text + "\x03"
        grams = [line[i : i + order] for i in range(len(line) - order + 1)]
        return -sum(math.log(chance(g)) for g in grams) / len(grams)

    return log_perplexity


def test_perplexities_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(Q, "PART_BYTES", 5_000)
    table = pd.read_parquet("/root/testdata/sf0.001/documents.parquet").head(60)
    want = brute_model(table.text[:30])
    docs = spark.createDataFrame(table[["doc_id", "text", "lang"]])
    good = spark.createDataFrame([(t,) for t in table.text[:30]], "text string")
    got = {r.doc_id: r.log_perplexity for r in Q.perplexities(docs, Q.train(good)).collect()}
    for i, text in zip(table.doc_id, table.text):
        assert got[i] == pytest.approx(want(text), rel=1e-9)


def test_junk_goes_and_clean_documents_stay(spark):
    sf = "/root/testdata/sf0.01"
    docs, marks = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    got = Q.classify(docs, marks).join(marks, "doc_id").toPandas()
    assert got[(got.quality == 1) & (got.toxic == 0)].kept.mean() > 0.98
    assert got[got.quality == 0].kept.mean() < 0.35


def test_thresholds_are_quantiles_of_each_language(spark):
    data = [("a", k / 100) for k in range(1, 101)] + [("b", 7.0)] * 3 + [(None, 9.0)]
    df = spark.createDataFrame(data, "lang string, log_perplexity double")
    own, common = Q.thresholds(df, 0.95, 0.0, 50)
    assert {r.lang: round(r.threshold, 3) for r in own.collect()} == {"a": 0.951}
    # The 99th of 104 values.
    assert common == pytest.approx(0.991, abs=1e-9)


def test_awkward_rows(spark):
    marks = labels(spark, [(4, 1, 0), (5, 1, None), (10, 1, 0), (2, 1, 0), (7, 0, 0), (None, 1, 0)])
    got = Q.classify(documents(spark), marks).collect()
    assert len(got) == len(rows())
    assert all(not r.kept for r in got if r.doc_id in (1, 2))
    assert all(r.kept for r in got if r.doc_id in (4, 5))
    assert all(r.perplexity > 0 for r in got)
    nothing = Q.classify(documents(spark), labels(spark)).collect()
    assert {r.kept for r in nothing if r.n_chars} == {True}
    assert Q.classify(documents(spark, False), marks).count() == 0
