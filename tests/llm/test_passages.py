import hashlib
import random

import numpy as np
import pytest
from awkward import documents, rows

from goldleaf.llm import passages as P
from goldleaf.llm.suffixes import common_prefixes, packed, remaining, suffix_array


def brute(texts, length):
    seen = {}
    for t in texts:
        for a in range(len(t) - length + 1):
            seen[t[a : a + length]] = seen.get(t[a : a + length], 0) + 1
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for a in range(len(t) - length + 1):
            if seen[t[a : a + length]] > 1:
                gone[a : a + length] = True
        kept = bytes(np.frombuffer(t, np.uint8)[~gone])
        spans = int((gone & ~np.append(False, gone[:-1])).sum())
        out.append((len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def got_of(df, **options):
    rows = P.without_repeats(df, **options).orderBy("doc_id").collect()
    return [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows]


@pytest.mark.parametrize("shard_contexts", [4096, 3])
def test_equals_brute_force(spark, shard_contexts):
    """Passages with shared and different surroundings, periods, repeats in one text; small and salted shards."""
    r = random.Random(2)
    passages = ["".join(r.choices("abc de\u00e9", k=r.randint(20, 90))) for _ in range(6)]
    texts = []
    for k in range(120):
        text = "".join(r.choices("abcdefgh ", k=r.randint(0, 60)))
        for _ in range(r.randint(0, 2)):
            piece = r.choice(passages)
            cut = r.randint(0, len(piece) // 2)
            text += piece[cut:] + "".join(r.choices("xyz", k=r.randint(0, 9)))
        texts.append(text * (2 if k % 10 == 0 else 1))
    texts += ["a" * 100, "ab" * 40, texts[5], ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = got_of(df, length=30, key=12, shard_contexts=shard_contexts)
    assert got == brute([t.encode() for t in texts], 30)


def test_anchors_depend_on_their_string_alone():
    """The same text in blocks of different sizes, with periods in which keys are equal."""
    r = random.Random(6)
    text = ("".join(r.choices("abcd", k=700)) + "ab" * 150 + "x" * 90 + "".join(r.choices("ab", k=400))).encode()
    found = []
    for before in (0, 1, 37, 70_000):
        data = np.frombuffer(bytes(r.choices(range(256), k=before)) + text, np.uint8)
        at, begin, end, keys, contexts = P.anchors(data, np.array([0, before, len(data)]), 30, 12)
        found.append([c[at == 1].tolist() for c in (begin, end, keys, contexts)])
    assert len(found[0][0]) > 50 and all(f == found[0] for f in found)


def test_the_first_least_of_neighbours():
    r = random.Random(8)
    for n, width in ((1, 1), (5, 5), (40, 7), (203, 10)):
        values = [r.choice([0, 1, 2, 3, 2**64 - 1]) for _ in range(n)]
        want = [k + min(range(width), key=lambda j: values[k + j]) for k in range(n - width + 1)]
        assert P._first_least(np.array(values, np.uint64), width).tolist() == want


def test_suffix_array_and_common_prefixes():
    r = random.Random(4)
    strings = ["".join(r.choices("ab", k=r.randint(1, 70))).encode() for _ in range(60)]
    data, sizes = np.frombuffer(b"".join(strings), np.uint8), np.array([len(s) for s in strings])
    for depth in (10, 20, 33):
        keys, left = packed(data), remaining(sizes)
        order = suffix_array(keys, left, depth)
        raw = data.tobytes()
        cut = [raw[a : a + depth] for a in order]
        assert sorted(order) == [a for a in range(len(raw)) if left[a] >= depth] and cut == sorted(cut)
        want = [0] + [next((k for k in range(depth) if a[k] != b[k]), depth) for a, b in zip(cut, cut[1:])]
        assert common_prefixes(data, keys, sizes, order, depth).tolist() == want


def test_awkward_rows(spark):
    got = P.without_repeats(documents(spark), text=True, carried=["lang"])
    got = got.collect()
    assert len(got) == len(rows())
    copies = [r for r in got if r.doc_id in (5, 6)]
    assert len(copies) == 3 and all(r.n_removed == r.n_bytes and r.n_spans == 1 and r.kept_text == "" for r in copies)
    assert {(r.n_bytes, r.n_removed) for r in got if r.doc_id in (1, 2)} == {(0, 0)}
    assert P.without_repeats(documents(spark, False)).count() == 0


def test_a_cut_through_a_character(spark):
    """é and © end in the same byte, which goes with the passage behind it."""
    passage = "p" * 20 + "q" * 20
    data = [(1, "x\u00e9" + passage), (2, "y\u0129" + passage)]
    assert "\u00e9".encode()[-1] == "\u0129".encode()[-1]
    got = P.without_repeats(spark.createDataFrame(data, "doc_id bigint, text string"), length=30, key=12, text=True)
    assert [(r.n_removed, r.kept_text) for r in got.orderBy("doc_id").collect()] == [(41, "x"), (41, "y")]
