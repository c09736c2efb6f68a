import re
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from awkward import documents, labels, rows

from goldleaf.llm import quality_rules as R


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    seen, doubled = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            doubled += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if often[w] > 1:
            covered.update(range(i, i + 5))
    return len(words), sum(map(len, words)), sum((text or "").count(c) for c in R.SYMBOLS), doubled, len(covered)


def test_counts_equal_brute_force(spark):
    table = pd.read_parquet("/root/testdata/sf0.001/documents.parquet")
    more = ["", "  ", "a", "\n\n", "a\na\n a\na", "x " * 30, "é " * 9, "a b c d e a b c d e f", "1 2 3 4", "#|#\n#|#"]
    texts = [*table.text, *more]
    got = R.text_statistics(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()
    for row in got:
        assert tuple(row[c] for c in R.COUNTS) == brute(texts[row.doc_id])


def test_rules_are_learned_and_applied_in_order():
    random = np.random.default_rng(1)
    columns = {"a": random.random(3000), "b": random.random(3000), "c": random.random(3000)}
    bad = (columns["a"] > 0.9) | ((columns["b"] < 0.2) & (columns["a"] > 0.5))
    rules = R.learn(columns, bad, np.arange(3000) % 3 == 0)
    found = np.zeros(3000, bool)
    for rule in rules:
        found |= R.holds(rule, columns)
    assert (found & bad).sum() > 0.85 * bad.sum() and (found & ~bad).sum() < 0.03 * bad.sum()
    noise = random.random(3000) < 0.1
    assert R.learn(columns, noise, np.arange(3000) % 3 == 0) == []


def test_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    docs, marks = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    got = R.apply_rules(docs, marks.where("doc_id % 2 = 0")).join(marks.where("doc_id % 2 = 1"), "doc_id").toPandas()
    assert got[got.quality == 1].kept.mean() > 0.95
    assert got[got.quality == 0].kept.mean() < 0.05
    assert (got.base_failed == ((got.n_words < 10) | (100 * got.n_repeat_words > 20 * got.n_words))).all()


@pytest.mark.parametrize("data", [[], [(4, 1, 0), (5, 0, 0), (None, 0, 0), (6, None, 0), (77, 1, 1)]])
def test_awkward_rows(spark, data):
    got = R.apply_rules(documents(spark), labels(spark, data)).collect()
    assert len(got) == len(rows())
    assert all(r.base_failed and not r.kept and r.n_words == 0 for r in got if r.doc_id in (1, 2, 3))
    assert R.apply_rules(documents(spark, False), labels(spark, data)).count() == 0


def test_a_fit_on_a_bounded_draw_is_the_same_in_any_run(spark):
    """More labels than the bound, under other numbers of shuffle partitions and other files."""
    docs, marks = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    before, fits = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for n in (3, 8):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            fits.append(R.fit(R.text_statistics(docs.repartition(n)), marks.repartition(n + 1), fit_rows=1500))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert fits[0] == fits[1] and fits[0]
