import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from awkward import documents

from goldleaf.llm import collocations as C
from goldleaf.plans.compare import connect, spark_rows, twin_rows

SF = "/root/testdata/sf0.01"


def brute(rows, min_count, top=C.TOP):
    """The result as a list, of (text, lang) rows."""
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(words)
            for k in range(1, C.MOST_WORDS + 1):
                f[lang or "und"].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        frequent = {g: a for g, a in counts.items() if a >= min_count and len(g) > 1}
        inside = set()
        for g, a in frequent.items():
            for size in range(2, len(g)):
                inside |= {h for i in range(len(g) - size + 1) if a >= frequent[h := g[i : i + size]]}
        found = []
        for g, a in frequent.items():
            if g in inside:
                continue
            cuts = [(1000 * a * n[lang] // (counts[g[:k]] * counts[g[k:]]), k) for k in range(1, len(g))]
            score, k = min(cuts)
            phrase = " ".join(g)
            found.append(((-score, -a, phrase.encode()), (phrase, a, counts[g[:k]], counts[g[k:]], n[lang], score)))
        out += [(lang, i, *row) for i, (_, row) in enumerate(sorted(found)[:top], 1)]
    return sorted(out)


def told(df, min_count, **more):
    return sorted(tuple(r) for r in C.collocations(df, min_count, **more).collect())


def test_equals_sql(spark):
    got = spark_rows(C.collocations(spark.read.parquet(f"{SF}/documents.parquet")))
    assert len(got[1]) > 50
    assert got == twin_rows(connect(SF), C.SQL)


@pytest.fixture(scope="module")
def mixed():
    r = random.Random(4)
    words = ["a", "b", "A", "c\x01", "c", "c\x00d", "É", "é", "ab", "a-b", "\U0001f600"]
    text = lambda: "".join(r.choice(words) + r.choice([" ", " ", "  ", "\t", ". ", "\n", ",", "\x0b"]) for _ in range(r.randint(0, 60)))
    return [(text(), r.choice(["en", "en", None, "und", "ça"])) for _ in range(200)] + [(None, "en"), ("", None), ("a b " * 3000, "en"), (" .\n", "xx")]


@pytest.mark.parametrize("range_rows", [C.RANGE_ROWS, 7])
def test_equals_brute_force(spark, mixed, range_rows):
    df = spark.createDataFrame(mixed, "text string, lang string").repartition(4)
    got = told(df, 5, range_rows=range_rows)
    assert got == brute(mixed, 5) and len(got) > 100


def test_top_is_cut_after_ranking(spark, mixed):
    df = spark.createDataFrame(mixed, "text string, lang string")
    assert told(df, 5, top=9) == brute(mixed, 5, 9)


def test_full_bitmap(spark, mixed, monkeypatch):
    """What the bitmap lets through wrongly is counted out."""
    wanted = brute(mixed, 20)
    df = spark.createDataFrame(mixed, "text string, lang string").repartition(3)
    monkeypatch.setattr(C, "bitmap_of", lambda *_: b"\xff" * 64)
    assert told(df, 20) == wanted


def test_bitmap_has_the_frequent_phrases(spark):
    rows = [("en", "a b"), ("de", "a b"), ("en", "b ç")]
    bits = np.frombuffer(C.bitmap_of(spark.createDataFrame(rows, "lang string, phrase string"), 2), np.uint8)
    assert np.unpackbits(bits).sum() == 3


def test_products_beyond_64_bits(spark):
    """Counts of 10**13 words: the stored counts stand for a corpus that can't be made here."""
    big = 10**13
    rows = [("en", 0, "", big), ("en", 1, "x", big // 2), ("en", 1, "y", 3 * 10**12), ("en", 2, "x y", 10**12 + 1)]
    counts = spark.createDataFrame(rows, "lang string, n_words int, phrase string, n long")
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(C, "phrase_counts", lambda *_: counts)
        got = C.collocations(spark.createDataFrame([], "text string, lang string")).collect()
    assert [r.score for r in got] == [1000 * (10**12 + 1) * big // (big // 2 * 3 * 10**12)]


def test_awkward_rows(spark):
    docs = documents(spark)
    rows = [(r.text, r.lang) for r in docs.collect()]
    assert told(docs, 3) == brute(rows, 3)
    assert told(docs, 100) == brute(rows, 100)
    assert told(documents(spark, False), 3) == []
