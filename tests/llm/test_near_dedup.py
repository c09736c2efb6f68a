import random
import re
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
from awkward import documents, prose, rows

from goldleaf.llm import near_dedup as N
from goldleaf.llm.components import components


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def brute_components(texts):
    sets = {i: shingles(t) for i, t in texts.items()}
    having, root = defaultdict(list), {i: i for i in texts}
    for i, s in sets.items():
        for x in s:
            having[x].append(i)

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, s in sets.items():
        common = Counter(j for x in s for j in having[x] if j < i)
        for j, n in common.items():
            if 100 * n >= 75 * (len(s) + len(sets[j]) - n):
                a, b = top(i), top(j)
                root[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), top(i)) for i in texts}


def got_of(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in N.near_duplicates(df).collect()}


def test_documents_equal_brute_force(spark):
    table = pd.read_parquet("/root/testdata/sf0.001/documents.parquet")
    texts = dict(zip(table.doc_id, table.text))
    assert got_of(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")) == brute_components(texts)


def test_large_groups_equal_brute_force(spark, monkeypatch):
    """Near copies at all distances from one base, in buckets of more than one block."""
    monkeypatch.setattr(N, "BLOCK_NODES", 16)
    r = random.Random(11)
    base = prose(21, 90).split()
    texts = {}
    for i in range(220):
        words = list(base)
        for _ in range(r.choice([0, 1, 2, 3, 5, 8])):
            words[r.randrange(len(words))] = f"w{r.randrange(40)}"
        texts[i] = " ".join(words)
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    want = brute_components(texts)
    assert 1 < len({c for _, c in want.values()}) < 220
    assert got_of(df) == want


def test_signature_coordinates_estimate_similarity():
    a, b = set(range(900)), set(range(300, 1200))
    values = {x: np.uint64(x * 2_654_435_761 + 17) for x in a | b}
    signatures = [
        N.signatures(N.mix(np.array([values[x] for x in sorted(s)], np.uint64)), np.array([0]))[0] for s in (a, b)
    ]
    assert abs((signatures[0] == signatures[1]).mean() - 0.5) < 0.13


def test_components_of_chains_and_stars(spark):
    links = [(k, k + 1) for k in range(30)] + [(100, k) for k in range(101, 140)] + [(7, 7), (3, 2), (200, 201), (201, 200)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "u bigint, v bigint")).collect()}
    assert got == {**{k: 0 for k in range(1, 31)}, **{k: 100 for k in range(101, 140)}, 201: 200}


def test_awkward_rows(spark):
    got = N.near_duplicates(documents(spark)).collect()
    assert len(got) == len(rows())
    by_id = defaultdict(set)
    for r in got:
        by_id[r.doc_id].add((r.n_shingles, r.component_id, r.kept))
    assert by_id[1] == {(0, 1, True)} and by_id[2] == {(0, 2, True)} and by_id[3] == {(0, 3, True)}
    assert by_id[5] == {(116, 5, True)} and by_id[6] == {(116, 5, False)} and {c for _, c, _ in by_id[7]} == {5}
    assert {(c, k) for _, c, k in by_id[None]} == {(None, True)}
    assert by_id[9] == {(1, 8, False)}
    assert N.near_duplicates(documents(spark, False)).count() == 0
