import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from awkward import documents, rows

from goldleaf.llm import byte_bpe as B

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def digest(ids):
    return hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()


def test_ids_equal_the_library(spark, library):
    r = random.Random(3)
    parts = [*"aabstmdrevl''  \n\t é中١½!?.,9#\u3000\u00a0\x1c\x85İß’", "'s", "'re", "'ve", "  ", " '", "  \n"]
    texts = ["".join(r.choices(parts, k=r.randint(0, 40))) for _ in range(3000)]
    texts += ["a" * 3000, "ab " * 2000, " " * 3000, "\n" * 700 + "x", "!" * 300, "'" * 99, "x'", "it's'll 'd"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {x.doc_id: x for x in B.encode_texts(df, PATH).collect()}
    for i, text in enumerate(texts):
        ids = library.encode_ordinary(text)
        assert (got[i].n_tokens, got[i].ids_sha256) == (len(ids), digest(ids)), repr(text)
        assert got[i].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_long_pieces_merge_as_short_ones():
    words = B.vocabulary(PATH)
    r = random.Random(5)
    for _ in range(300):
        raw = "".join(r.choices("thering", k=r.randint(2, 32))).encode()
        assert words.merged([raw])[0] == (words._long(raw) if raw not in words.ranks else (words.ranks[raw],))


def test_round_trip_and_awkward_rows(spark):
    encoded = B.encode_texts(documents(spark), PATH, keep_ids=True)
    texts = [bytes(x["bytes"]) for x in B.decode_texts(encoded, PATH).collect()]
    assert texts == [(t or "").encode() for _, t in rows()]
    assert [x.n_tokens for x in encoded.collect()][:2] == [0, 0]
    assert B.encode_texts(documents(spark, False), PATH).count() == 0
