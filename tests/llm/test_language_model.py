import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from qaspark.llm import language_model as lm


def tokens(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lowered), None]


def brute(rows):
    """rows: (text, held out) -> (n_tokens, n_known, train_tokens, base, score)."""
    uni, grams = Counter(), Counter()
    for text, held in rows:
        if not held:
            own = tokens(text)
            uni.update(own)
            grams.update(zip([0, *own], own))
    n, v = sum(uni.values()), len(uni)
    contexts = uni | Counter({0: uni[None]})
    out = []
    for text, _ in rows:
        own = tokens(text)
        p = {w: (uni[w] + 1) / (n + v + 1) for w in own}
        score = sum(
            math.log10((grams[h, w] + lm.MASS * p[w]) / (contexts[h] + lm.MASS)) for h, w in zip([0, *own], own)
        )
        out.append((len(own), sum(uni[w] > 0 for w in own), n, sum(math.log10(p[w]) for w in own), score))
    return out


@pytest.mark.parametrize("learned", [True, False])
def test_against_brute_force(spark, learned):
    rng = random.Random(6)
    texts = [None, "", " \n\t", "Aa aA", "ß É é", "x " * 2000]
    texts += [" ".join(rng.choice(["a", "B", "é", "cc", "d,"]) for _ in range(rng.randrange(30))) for _ in range(80)]
    rows = [(t, not learned or n % 4 == 0) for n, t in enumerate(texts)]
    docs = spark.createDataFrame([(n, *r, 1) for n, r in enumerate(rows)], "doc_id long, text string, held boolean, lm int").repartition(3)
    for size in (1 << 20, 500):
        found = {r.row.doc_id: r for r in lm.score(docs, F.col("held"), block_bytes=size).collect()}
        assert found[3].row.text == "Aa aA" and found[3].row.lm == 1
        for n, expected in enumerate(brute(rows)):
            assert tuple(found[n].lm)[:3] == expected[:3]
            assert np.allclose(tuple(found[n].lm)[3:], expected[3:])
            assert found[n].held_out == rows[n][1]


def test_repeated_rows_no_rows_and_a_sum_of_one(spark):
    docs = spark.createDataFrame([(None, "a b")] * 3, "doc_id long, text string")
    rows = lm.score(docs, F.lit(False)).collect()
    assert len(rows) == 3 and {tuple(r.lm) for r in rows} == {tuple(rows[0].lm)} and rows[0].lm.train_tokens == 9
    assert lm.score(docs.limit(0), F.lit(False)).collect() == []
    # over all words, one unknown one and the end, what follows a word sums to one
    given = spark.createDataFrame([(n, t) for n, t in enumerate(["a b a", "b b", "b a", "a", "b unseen", "b"])], "doc_id long, text string")
    scored = {r.row.doc_id: r.lm.score for r in lm.score(given, F.col("doc_id") >= 2).collect()}
    start_b = scored[5] - math.log10((1 + lm.MASS * 3 / 11) / (3 + lm.MASS))  # "b" without its end
    assert start_b < 0 and scored[4] < scored[5]


def test_pack():
    values = np.sort(np.random.default_rng(1).integers(0, 1 << 63, 500, np.uint64) * np.uint64(2))
    assert (lm.unpack_sorted(lm.pack_sorted(values)) == values).all()
    assert len(lm.unpack(lm.pack(values[:0]))) == 0


def test_requests_travel_in_batches():
    rows = [{"block": n, "words": bytes(300_000 if n % 3 == 0 else 10)} for n in range(20)]
    batches = list(lm._batches(iter(rows)))
    assert [one for batch in batches for one in batch.to_pylist()] == rows
    assert 1 < len(batches) < 6 and list(lm._batches(iter([]))) == []
    many = list(lm._batches({"block": n, "words": b""} for n in range(2 * lm.BATCH_ROWS + 1)))
    assert [b.num_rows for b in many] == [lm.BATCH_ROWS, lm.BATCH_ROWS, 1]
