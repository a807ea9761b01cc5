import random
import re
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from qaspark.llm import minhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, size):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[n : n + size]) for n in range(max(len(words) - size + 1, 1))} if words else set()


def brute(rows, size):
    sets = [shingles(text, size) for _, text in rows]
    label = list(range(len(rows)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in combinations(range(len(rows)), 2):
        if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            label[root(a)] = root(b)
    least = {}
    for n, (doc, _) in enumerate(rows):
        least.setdefault(root(n), []).append(doc)
    least = {k: min((d for d in v if d is not None), default=None) for k, v in least.items()}
    return [(doc, len(sets[n]), least[root(n)]) for n, (doc, _) in enumerate(rows)]


def changed(rng, words, share):
    return [rng.choice("pqrstuvw") + str(rng.randrange(999)) if rng.random() < share else w for w in words]


def corpus(seed=1):
    rng, rows = random.Random(seed), []
    bases = [[f"w{rng.randrange(3000)}" for _ in range(rng.choice([3, 6, 12, 60, 200]))] for _ in range(25)]
    for base in bases:
        for _ in range(rng.randint(1, 12)):
            rows.append((len(rows), " ".join(changed(rng, base, rng.choice([0, 0.01, 0.03, 0.06, 0.1])))))
    rows += [(1000 + n, rows[3][1].upper()) for n in range(5)]
    rows += [(2000, None), (2001, ""), (2002, " \n"), (2003, None), (None, rows[0][1]), (None, "alone on earth"), (2004, "One"), (2005, "one")]
    rows += [rows[7], rows[7]]  # repeated rows
    rows += [(3000, "very long text " * 60_000), (3001, "very long text " * 60_000 + "end")]
    return rows


@pytest.mark.parametrize("size", [2, 5])
def test_groups_against_all_pairs(spark, size):
    rows = corpus()
    found, _ = minhash.group_documents(spark.createDataFrame(rows, "doc_id long, text string"), shingle=size)
    got = [(r.id, r.n, r.component) for r in found.collect()]
    order = lambda r: tuple((v is not None, v) for v in r)
    assert sorted(got, key=order) == sorted(brute(rows, size), key=order)


def test_pairs_unlike_their_centre_are_found(spark):
    # a hub of six words' difference from its leaves, and leaves alike in pairs: few blocks, then many
    rng = random.Random(7)
    base = [f"b{n}" for n in range(120)]
    rows = []
    for pair in range(12):
        far = changed(rng, base, 0.09)
        rows += [(2 * pair + 10, " ".join(far)), (2 * pair + 11, " ".join(changed(rng, far, 0.02)))]
    rows.append((1, " ".join(base)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted((d, n, c) for d, n, c in brute(rows, 2))
    assert len({c for _, _, c in want}) > 3
    before = minhash.BLOCK_SHINGLES
    for size in (before, 300):
        minhash.BLOCK_SHINGLES = size
        try:
            found, _ = minhash.group_documents(docs, shingle=2)
            assert sorted((r.id, r.n, r.component) for r in found.collect()) == want
        finally:
            minhash.BLOCK_SHINGLES = before


def test_signatures_estimate_similarity():
    rng = random.Random(2)
    hasher = minhash.Shingles(2)
    for words in (8, 40, 400):
        base = [f"w{n}" for n in range(words)]
        real, seen = [], []
        for _ in range(60):
            a, b = " ".join(changed(rng, base, 0.05)), " ".join(changed(rng, base, 0.05))
            one, two = shingles(a, 2), shingles(b, 2)
            prints = minhash.signatures(*hasher(pa.array([a, b])))
            real.append(len(one & two) / len(one | two))
            seen.append(float((prints[0] == prints[1]).mean()))
        assert abs(np.mean(real) - np.mean(seen)) < 0.03
    lone = minhash.signatures(*hasher(pa.array(["one", "", None])))
    assert len(set(lone[0].tolist())) == 1 and not lone[1:].any()


def test_one_of_each_group_stays_with_its_columns(spark):
    rows = corpus()
    docs = spark.createDataFrame([(*r, "k", 1) for r in rows], "doc_id long, text string, node string, row long")
    kept = minhash.keep_one(docs)
    groups = brute(rows, 5)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert {i for i in ids if i is not None} == {c for _, _, c in groups if c is not None}
    assert ids.count(None) == 1  # the one alone; the other has a group with an id


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    found, chosen = minhash.group_documents(none)
    assert found.count() == chosen.count() == 0
