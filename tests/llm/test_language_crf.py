import numpy as np
import pandas as pd
import pytest
from awkward import documents, rows
from pyspark.sql import functions as F

from goldleaf.llm import language_crf as L

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    return L.train(docs.where(F.crc32(F.col("doc_id").cast("string")) % 4 != 2), 100)


def brute_marginals(scores, transitions):
    """Sums over all paths, in logarithms, one text."""
    n, width = scores.shape
    forward, backward = np.zeros((n, width)), np.zeros((n, width))
    forward[0] = scores[0]
    for k in range(1, n):
        forward[k] = np.logaddexp.reduce(forward[k - 1][:, None] + transitions, axis=0) + scores[k]
    for k in range(n - 2, -1, -1):
        backward[k] = np.logaddexp.reduce(transitions + (scores[k + 1] + backward[k + 1])[None, :], axis=1)
    both = forward + backward
    both = np.exp(both - both.max(axis=1, keepdims=True))
    return both / both.sum(axis=1, keepdims=True)


def test_marginals_equal_brute_force():
    random = np.random.default_rng(0)
    for _ in range(20):
        firsts = np.append(0, np.cumsum(random.integers(0, 110, 6)))
        scores, transitions = random.normal(0, 3, (firsts[-1], 3)), random.normal(0, 2, (3, 3))
        model = L.Model(["a", "b", "c"], np.zeros((1, 3)), transitions, np.zeros(0, np.uint64), np.zeros(0, int))
        got = L.marginals(model, scores, firsts)
        for a, b in zip(firsts[:-1], firsts[1:]):
            if b > a:
                assert np.allclose(got[a:b], brute_marginals(scores[a:b], transitions), atol=1e-8)


def test_held_out_accuracy(spark, model):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    held = docs.where(F.crc32(F.col("doc_id").cast("string")) % 4 == 2)
    got = L.predict(held, model).join(held.select("doc_id", "lang"), "doc_id").toPandas()
    assert len(got) > 200
    assert (got.lang == got.lang_pred).mean() > 0.98
    assert got.score.between(0, 1).all()


def test_code_switching_is_found(spark, model):
    docs = pd.read_parquet(f"{SF}/documents.parquet").query("n_chars > 400").drop_duplicates("lang").set_index("lang")
    german, spanish = (" ".join(docs.text[y].split()[:40]) for y in ("de", "es"))
    df = spark.createDataFrame([(1, f"{german} {spanish}")], "doc_id bigint, text string")
    spans = L.predict(df, model, spans=True).first()["spans"]
    assert [s["lang"] for s in spans] == ["de", "es"]
    assert abs(spans[1]["start"] - len(german) - 1) < 40


def test_awkward_rows(spark, model):
    got = L.predict(documents(spark), model, spans=True).collect()
    assert len(got) == len(rows())
    for row, (_, text) in zip(got, rows()):
        if not text or not any(c.isalpha() for c in text):
            assert (row.lang_pred, row.score, row.spans) == ("und", 0.0, [])
    assert L.predict(documents(spark, False), model).count() == 0
    assert L.train(documents(spark, False)) is None
    assert {r.lang_pred for r in L.predict(documents(spark), None).collect()} == {"und"}
