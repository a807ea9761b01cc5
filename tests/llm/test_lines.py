import random
from collections import Counter

import pytest

from qaspark.llm import bloom, lines


def key(line):
    stripped = line.strip(" \t\n\x0b\x0c\r")
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in stripped)


def brute(docs, min_docs, min_chars, keep):
    """docs: (id, text); the kept text of each."""
    seen, first = Counter(), {}
    for place, (_, text) in enumerate(sorted(docs, key=lambda d: (d[0] is None, d[0]))):
        for at, one in enumerate((text or "").split("\n")):
            first.setdefault(key(one), (place, at))
    for _, text in docs:
        seen.update({key(one) for one in (text or "").split("\n")})
    out = {}
    for place, (doc, text) in enumerate(sorted(docs, key=lambda d: (d[0] is None, d[0]))):
        rows = (text or "").split("\n")
        kept = [
            one
            for at, one in enumerate(rows)
            if len(key(one)) < min_chars
            or seen[key(one)] < min_docs
            or (keep == "first" and first[key(one)] == (place, at))
        ]
        out[doc] = (len(rows), len(rows) - len(kept), "\n".join(kept))
    return out


def made(seed, count=120):
    rng = random.Random(seed)
    pool = ["Hello", " hello\t", "HELLO", "é È", "  ", "", "\x0b\x0cx\r", "x", *(f"line {n}" for n in range(30))]
    docs = [(n, "\n".join(rng.choice(pool) for _ in range(rng.randrange(9)))) for n in range(count)]
    return [*docs, (count, None), (count + 1, ""), (count + 2, "\n\n"), (count + 3, "hello\n" * 4000)]


@pytest.mark.parametrize(("min_docs", "min_chars", "keep"), [(10, 1, "none"), (2, 1, "none"), (3, 2, "first"), (2, 7, "first")])
def test_against_brute_force(spark, min_docs, min_chars, keep):
    docs = made(min_docs)
    table = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "doc_id as _edit", "1 as line").repartition(4)
    rows = lines.drop_lines(table, min_docs, min_chars, keep, counts=("n", "gone")).collect()
    assert {r.doc_id: (r.n, r.gone, r.text or "") for r in rows} == brute(docs, min_docs, min_chars, keep)
    assert all(r._edit == r.doc_id and r.line == 1 for r in rows)


def test_a_full_filter_changes_nothing(spark, monkeypatch):
    docs = made(8, 300)
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    monkeypatch.setattr(bloom, "SHARD_BITS", 64)
    rows = lines.drop_lines(table, bits=128).collect()
    assert {r.doc_id: r.text or "" for r in rows} == {d: t[2] for d, t in brute(docs, 10, 1, "none").items()}


def test_repeated_rows_and_no_rows(spark):
    table = spark.createDataFrame([(1, "a\nb")] * 9 + [(None, "A\nc")], "doc_id long, text string")
    rows = lines.drop_lines(table).collect()
    assert sorted((str(r.doc_id), r.text) for r in rows) == [("1", "b")] * 9 + [("None", "c")]
    assert lines.drop_lines(table.limit(0)).collect() == []
