import hashlib
import random
import time

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from qaspark.llm import bpe

RANKS = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
PLAIN = tiktoken.Encoding(
    "plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={}
)


def test_replay_agrees_with_the_library():
    rng = random.Random(5)
    texts = [
        "", "a", " ", "\n\n  x", "aaaaaaaaaaaaaa", "ababababab", "it's we'll", "日本語 ñandú ß 😀‍😀",
        "x" * 50_000, "hello world " * 500,
        *("".join(rng.choices("abcde étion \n\t12.!", k=rng.randrange(300))) for _ in range(300)),
        *("".join(chr(rng.randrange(1, 0xD000)) for _ in range(60)) for _ in range(60)),
    ]
    encoder = bpe.Encoder(RANKS, public_tokenizers.PATTERN)
    assert encoder.encode(texts).to_pylist() == [PLAIN.encode_ordinary(t) for t in texts]


def test_long_words_take_work_in_proportion():
    rng = random.Random(8)
    long = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=n)) for n in (257, 1_000, 50_000, 1_000_000)]
    long += ["ab" * 40_000, " " * 70_000, "é" * 9_000, "aaab" * 500]
    encoder = bpe.Encoder(RANKS, public_tokenizers.PATTERN)
    began = time.time()
    found = encoder.encode(long)
    assert time.time() - began < 60  # seconds even on a slow machine; quadratic work takes hours
    assert found.to_pylist() == [PLAIN.encode_ordinary(t) for t in long]


@pytest.mark.parametrize("way", [bpe._by_index, bpe._by_steps])
def test_both_ways_of_replay_agree_with_the_library(way):
    rng = random.Random(9)
    words = ["".join(rng.choices("abcdeé 1n", k=rng.randint(1, 40))) for _ in range(800)]
    plain = tiktoken.Encoding("whole", pat_str=r"[\s\S]+", mergeable_ranks=RANKS, special_tokens={})
    found = way([w.encode() for w in words], bpe.Merges(RANKS))
    assert [np.frombuffer(ids, np.int32).tolist() for ids in found] == [plain.encode_ordinary(w) for w in words]


def test_a_merge_may_make_a_lower_one():
    # "ab" leads to "abc", which ranks below "ab": the second "ab" of the word has to wait
    ranks = {bytes([v]): v + 10 for v in range(256)}
    ranks |= {b"ab": 400, b"abc": 1, b"cab": 2}
    own = tiktoken.Encoding("own", pat_str=r".+", mergeable_ranks=ranks, special_tokens={})
    words = ["abcab", "ababc", "cabcab", "abcabcabc", "bcaab"]
    words.append("abcabab" * 100)
    for way in (bpe._by_index, bpe._by_steps):
        found = way([w.encode() for w in words], bpe.Merges(ranks))
        assert [np.frombuffer(ids, np.int32).tolist() for ids in found] == [own.encode_ordinary(w) for w in words]


def test_rows(spark):
    texts = ["one two", None, "", "one two", "é" * 3000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr(
        "*", "'mine' as ids_"
    )
    coded = bpe.decode(bpe.encode(docs, RANKS, public_tokenizers.PATTERN), RANKS)
    rows = {r.doc_id: r for r in coded.collect()}
    for doc, text in enumerate(texts):
        assert rows[doc].ids == PLAIN.encode_ordinary(text or "")
        assert bytes(rows[doc].decoded) == (text or "").encode()
    assert rows[0].text == "one two" and rows[0].ids_ == "mine"
    assert bpe.encode(docs.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001"])
def test_query(spark, folder):
    found = {r.doc_id: r for r in bpe.op6_byte_bpe(spark, folder).collect()}
    given = spark.read.parquet(f"{folder}/documents.parquet").collect()
    assert len(found) == len(given)
    for row in given:
        ids = PLAIN.encode_ordinary(row.text or "")
        digest = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert (found[row.doc_id].n_tokens, found[row.doc_id].ids_sha256) == (len(ids), digest)
        assert found[row.doc_id].decoded_sha256 == hashlib.sha256((row.text or "").encode()).hexdigest()
