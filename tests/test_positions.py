"""Prefixes, numbers, look-ups and joins that leave the rows where they are."""

import random

from pyspark.sql import functions as F

from qaspark.operators import chunks as ch, corpus as ops, prepare
from qaspark.plans.skewed import join_hot


def test_prefix_with_nulls_and_ends(spark):
    given = [(None, 2), (None, 1), ("a", 5), ("a", None), ("b", 0)]
    df = spark.createDataFrame([(a, b, "x" * 9) for a, b in given], "a string, b int, text string")
    order = sorted(given, key=lambda r: tuple((v is not None, v or 0 if not isinstance(v, str) else v) for v in r))
    for n in (0, 1, 3, 5, 9):
        got = ops.split_prefix(df, ["a", "b"], n)
        assert got.columns == ["a", "b", "text", "in_prefix"]
        assert {(r.a, r.b) for r in got.collect() if r.in_prefix} == set(order[:n])
    assert ops.split_prefix(df.limit(0), ["a", "b"], 2).count() == 0


def test_ids_with_and_without_file_number(spark, rows):
    df = spark.createDataFrame([(1, None, "z"), (0, "k", "y"), (1, "a", "x")], "file_no int, k string, text string")
    both = prepare.assign_ids(df, "p", ["file_no", "k"])
    assert rows(both.select("text", "id"), "text") == [("x", "p-01-000002"), ("y", "p-00-000000"), ("z", "p-01-000001")]
    bare = prepare.assign_ids(df, "p", ["file_no", "k"], file_no=None)
    assert rows(bare.select("text", "id"), "text") == [("x", "p-000002"), ("y", "p-000000"), ("z", "p-000001")]


def test_sample_with_replacement_of_nothing(spark):
    empty = ops.sample_rows(spark.range(0).withColumnRenamed("id", "k"), "k", 3, replace=True)
    assert empty.count() == 0 and empty.columns == ["k", "draw"]


def test_look_up_in_several_passes_is_the_same(spark, rows):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(300)]
    known = {w: i + 10 for i, w in enumerate(words[:200])}
    given = [(i, rng.choices([*words, *["[CLS]"] * 30], k=rng.choice([0, 1, 40]))) for i in range(30)]
    df = spark.createDataFrame(given, "id int, tokens array<string>")
    pairs = [*known.items(), ("w1", 999), (None, 7), ("w250", None), ("[CLS]", 50)]
    vocabulary = spark.createDataFrame(pairs, "token string, token_id int")
    want = [(i, [2 if t == "[CLS]" else known.get(t) for t in tokens]) for i, tokens in given]
    for limit in (1 << 20, 3000):
        got = ch.look_up(df, "tokens", vocabulary, {"[CLS]": 2}, limit)
        assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
        assert rows(got.select("id", "_ids"), "id") == want
    got = ch.look_up(df, "tokens", vocabulary.limit(0), {"[CLS]": 2}).collect()
    assert {x for r in got for x in r._ids} == {2, None}


def test_features_without_a_question_have_no_row(spark):
    cut = spark.createDataFrame([(1, 0, "q", ["a"]), (2, 0, None, ["a"])], "id int, chunk_no int, question string, tokens array<string>")
    vocabulary = spark.createDataFrame([("a", 9)], "token string, token_id int")
    ids = {ch.PAD: 0, ch.UNKNOWN: 1, ch.CLS: 2, ch.SEP: 3}
    assert [tuple(r) for r in ch.encode_pad(cut, vocabulary, ids).collect()] == [
        (1, 0, [2, 1, 3, 9, 3, 0, 0, 0], [1, 1, 1, 1, 1, 0, 0, 0])
    ]


def test_hot_join_equals_a_plain_left_join(spark):
    keys = ["hot"] * 60 + ["b", "b", "c", None, None, "lost"]
    rows = spark.createDataFrame(list(enumerate(keys)), "n int, k string")
    facts = spark.createDataFrame([("hot", 1), ("b", 2), ("c", 3), ("d", 4), (None, 5)], "k string, v int")
    want = sorted((n, k, {"hot": 1, "b": 2, "c": 3}.get(k)) for n, k in enumerate(keys) if k) + [
        (n, k, None) for n, k in enumerate(keys) if k is None
    ]
    for shares in (1, 4, 1000):
        got = join_hot(rows, facts, "k", shares).select("n", "k", "v").collect()
        assert sorted(map(tuple, got)) == sorted(want)
    assert join_hot(rows.limit(0), facts, "k").count() == 0


def test_negatives_when_one_title_holds_most(spark):
    titles = ["hot"] * 50 + [f"t{i}" for i in range(10)]
    docs = spark.createDataFrame(list(enumerate(titles)), "doc_id long, title string")
    asked = docs.select(F.col("doc_id").alias("qid"), "title")
    got = ops.sample_negatives(asked, docs, 12).collect()
    title = dict(enumerate(titles))
    per = {}
    for r in got:
        assert title[r.qid] != r.title == title[r.doc_id]
        per.setdefault(r.qid, set()).add(r.doc_id)
    assert {len(v) for q, v in per.items() if title[q] == "hot"} == {10}
    assert {len(v) for q, v in per.items() if title[q] != "hot"} == {12}
