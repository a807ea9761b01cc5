import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest

from qaspark.llm import suffix


def brute(docs, length, keep):
    """docs: (id, text) -> id: (n_bytes, n_removed, n_spans, kept)."""
    places = defaultdict(list)
    raws = {doc: (text or "").encode() for doc, text in docs}
    for doc, raw in raws.items():
        for at in range(len(raw) - length + 1):
            places[raw[at : at + length]].append((doc, at))
    gone = {doc: [False] * len(raw) for doc, raw in raws.items()}
    for found in places.values():
        if len(found) > 1:
            for doc, at in found if keep == "none" else sorted(found)[1:]:
                gone[doc][at : at + length] = [True] * length
    out = {}
    for doc, raw in raws.items():
        flags = gone[doc]
        spans = sum(f and not (n and flags[n - 1]) for n, f in enumerate(flags))
        out[doc] = (len(raw), sum(flags), spans, bytes(b for b, f in zip(raw, flags) if not f))
    return out


def made(seed):
    rng = random.Random(seed)
    say = lambda n: "".join(rng.choice("abé \n") for _ in range(n))
    shared = [say(30) for _ in range(4)]
    texts = [None, "", "ab", "a" * 900, "ab" * 40, "a" * 25]
    for _ in range(50):
        parts = [say(rng.randrange(25)) for _ in range(3)] + rng.sample(shared, 2)
        rng.shuffle(parts)
        texts.append("".join(parts))
    texts += texts[-3:] + ["x" + texts[-1], texts[-2] + "y"]
    return list(enumerate(texts))


def test_arrays_against_plain_loops():
    rng = np.random.default_rng(2)
    for size in (1, 2, 7, 150):
        for length in (1, 5, 12):
            content = rng.integers(97, 99, size).astype(np.uint8)
            raw = content.tobytes()
            order, common = suffix.suffix_array(content, length)
            keys = [raw[i : i + length] for i in order]
            assert keys == sorted(keys)
            match = lambda a, b: next((n for n in range(length) if n >= size - max(a, b) or raw[a + n] != raw[b + n]), length)
            assert common[1:].tolist() == [match(a, b) for a, b in zip(order, order[1:])]
            found = suffix.longest_previous_factor(order, common)
            assert found.tolist() == [max((match(i, j) for j in range(i)), default=0) for i in range(size)]


@pytest.mark.parametrize(("keep", "group"), [("none", 512), ("first", 512), ("none", 2), ("first", 2)])
def test_against_brute_force(spark, monkeypatch, keep, group):
    monkeypatch.setattr(suffix, "BLOCK", 600)
    docs = made(3)
    table = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as k1").repartition(3)
    rows = suffix.remove_repeats(table, 12, keep, gram=4, group=group).collect()
    found = {r.row.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in rows}
    assert found == brute(docs, 12, keep)
    assert all(r.row.k1 == 1 for r in rows)


def test_repeated_rows_and_no_rows(spark):
    docs = spark.createDataFrame([(None, "abcdefghijkl")] * 2 + [(1, "0123456789")], "doc_id long, text string")
    for keep, left in (("none", b""), ("first", b"abcdefghijkl")):
        rows = suffix.remove_repeats(docs, 8, keep, gram=4).collect()
        assert sorted(bytes(r.kept) for r in rows) == sorted([left, left, b"0123456789"])
    assert suffix.remove_repeats(docs.limit(0), 8, "none", gram=4).collect() == []


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    expected = brute(docs, 200, "none")
    rows = suffix.op1_suffix_dedup(spark, folder).collect()
    assert sum(e[1] for e in expected.values()) > 1000
    assert {r.doc_id: tuple(r)[1:] for r in rows} == {
        d: (*e[:3], hashlib.sha256(e[3]).hexdigest()) for d, e in expected.items()
    }
