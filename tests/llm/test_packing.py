import itertools
import random
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from awkward import documents, rows
from tokenizers import Tokenizer

from goldleaf.llm import packing as K
from goldleaf.llm.bins import Sums, best_fit, fillings, lower_bound, pack
from goldleaf.llm.blocks import blocks

PATH = public_tokenizers.path("word_bpe_49k.json")


def wanted(texts, capacity):
    library = Tokenizer.from_file(PATH)
    out = []
    for i, text in texts:
        ids = library.encode(text or "", add_special_tokens=False).ids + [1]
        for k in range(0, len(ids), capacity):
            cut = ids[k : k + capacity]
            out.append((i, k // capacity, k, len(cut), zlib.crc32(np.array(cut, "<u4").tobytes())))
    return out


def check(df, texts, capacity):
    got = K.pack_documents(df, PATH, capacity).collect()
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted([tuple(r)[:5] for r in got], key=key) == sorted(wanted(texts, capacity), key=key)
    held = {}
    for r in got:
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in held.values():
        places.sort()
        assert [o for o, _ in places] == list(itertools.accumulate([0, *[n for _, n in places]]))[:-1]
        assert sum(n for _, n in places) <= capacity
    counts = np.bincount([r.length for r in got], minlength=capacity + 1)
    return len(held), lower_bound(counts, capacity)


def test_pieces_and_places(spark):
    r = random.Random(6)
    parts = [*"aAbBstmdrevl''  \n\t é中١½!?.,9#\u3000\x85İßÉÑ’", "'s", "'RE", "  ", "e\u0301", "<|endoftext|>", "ΑΣ", "\x1c"]
    texts = [(i, "".join(r.choices(parts, k=r.randint(0, 60)))) for i in range(800)]
    used, bound = check(spark.createDataFrame(texts, "doc_id bigint, text string"), texts, 64)
    assert used == bound


def test_awkward_rows(spark):
    used, bound = check(documents(spark), rows(), K.CAPACITY)
    assert used == bound
    assert K.pack_documents(documents(spark, False), PATH).count() == 0


def test_words_in_latin_letters_need_no_whole_tokenizer(monkeypatch):
    """Every character up to U+0250, alone and inside words; the tokenizer itself runs for other scripts only."""
    words = K.Words(PATH)
    r = random.Random(7)
    parts = [chr(c) for c in range(0x250) if chr(c) not in K.UNUSUAL]
    texts = ["".join(r.choices(parts, k=r.randint(1, 30))) for _ in range(3000)]
    texts += [f"a{c}b '{c} {c}{c} 1{c}x" for c in parts] + ["\u00e9\u4e2d \u0416\u0436 e\u0301 \u0558"]
    library = Tokenizer.from_file(PATH)
    got = lambda some: [x.tolist() for x in np.split(*encoded(words, some))]
    assert got(texts) == [library.encode(t, add_special_tokens=False).ids for t in texts]
    monkeypatch.setattr(words, "exactly", None)
    words.known.forget()
    some = [t for t in texts if max(t) < "\u0180" and "\u0130" not in t]
    assert got(some) == [library.encode(t, add_special_tokens=False).ids for t in some]


def encoded(words, texts):
    (block,) = blocks(iter([pa.RecordBatch.from_pydict({"text": texts})]))
    ids, firsts = words.encode(block)
    return ids, firsts[1:-1]


def test_sums_after_changes_are_those_of_new_counts():
    r = random.Random(5)
    kept, counts = Sums(60), np.zeros(61, np.int64)
    for _ in range(300):
        counts[r.randint(1, 60)] = r.choice([0, 0, 1, 2, 9])
        sizes, made, there = kept.of(counts)
        fresh = Sums(60).of(counts)
        assert (list(sizes), made, there) == (list(fresh[0]), *fresh[1:]) and list(sizes) == np.flatnonzero(counts).tolist()
        each = [0]
        for size in sizes:
            each = {a + n * size for a in each for n in range(counts[size] + 1) if a + n * size <= 60}
        assert sum(1 << a for a in each) == (made[-1] if made else 1)


def test_waiting_searches_hold_no_sums():
    r = np.random.default_rng(4)
    counts, kept, waiting = r.integers(0, 9, 4097), Sums(4096), []
    counts[:200] = 0
    tracemalloc.start()
    for _ in range(40):
        counts = np.maximum(counts - (r.random(4097) < 0.01), 0)
        waiting.append(fillings(counts, 3000, kept))
        next(waiting[-1])
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert held < 40 * 100_000  # with the 2 MB of sums of each it would be 80 MB
    assert all(sum(next(w)[0]) <= 3000 for w in waiting)


def fewest(sizes, capacity):
    """Exhaustive search over bins of a few items."""
    best = [len(sizes)]

    def place(k, bins):
        if len(bins) >= best[0]:
            return
        if k == len(sizes):
            best[0] = len(bins)
            return
        for i in range(len(bins)):
            if bins[i] + sizes[k] <= capacity and bins[i] not in bins[:i]:
                place(k + 1, bins[:i] + [bins[i] + sizes[k]] + bins[i + 1 :])
        place(k + 1, [*bins, sizes[k]])

    place(0, [])
    return best[0]


def test_bins_are_as_few_as_can_be():
    r = random.Random(9)
    better = 0
    for _ in range(150):
        sizes = sorted((r.randint(1, 40) for _ in range(r.randint(0, 11))), reverse=True)
        counts = np.bincount(sizes, minlength=51)
        patterns = pack(counts, 50)
        assert sorted(x for p, n in patterns for x in p * n) == sorted(sizes)
        assert all(sum(p) <= 50 for p, _ in patterns)
        used = sum(n for _, n in patterns)
        assert lower_bound(counts, 50) <= used == fewest(sizes, 50)
        better += used < sum(n for _, n in best_fit(counts, 50))
    hard = np.zeros(101, np.int64)
    hard[[51, 27, 26, 23, 24, 49]] = 20, 20, 20, 20, 20, 10  # best fit leaves gaps here
    assert sum(n for _, n in pack(hard, 100)) <= sum(n for _, n in best_fit(hard, 100))


def test_completions_of_any_number_of_items():
    counts = np.bincount([510, 510, 166, 165, 112, 110, 109, 108, 107, 103], minlength=1001)
    assert sum(n for _, n in best_fit(counts, 1000)) == 3
    patterns = pack(counts, 1000)
    assert sorted(x for p, n in patterns for x in p * n) == [103, 107, 108, 109, 110, 112, 165, 166, 510, 510]
    assert [sum(p) for p, n in patterns for _ in range(n)] == [1000, 1000]


def test_fillings_are_all_of_them():
    counts = np.zeros(31, np.int64)
    counts[[2, 3, 5, 7, 11]] = 4, 2, 1, 2, 1
    got = [items for items, _ in fillings(counts, 30)]
    every = itertools.product(*[[(x,) * n for n in range(counts[x] + 1)] for x in (11, 7, 5, 3, 2)])
    every = {sum(parts, ()) for parts in every}
    assert len(got) == len(set(got)) and set(got) == {items for items in every if sum(items) <= 30}
    assert sorted(map(sum, got), reverse=True) == list(map(sum, got))


def test_hot_lengths_are_numbered_in_salted_groups(spark, monkeypatch):
    monkeypatch.setattr(K, "SALTED_ROWS", 10)
    texts = [(i, "the same words") for i in range(100)] + [(200 + i, "a " * i) for i in range(30)]
    used, bound = check(spark.createDataFrame(texts, "doc_id bigint, text string"), texts, 40)
    assert used == bound
