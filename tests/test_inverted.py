import random

import pytest

from qaspark.operators import bm25, inverted


def made(spark, count=900, seed=4):
    """The word "the" stands in every document, rare words in few."""
    rng = random.Random(seed)
    texts = []
    for _ in range(count):
        words = ["the"] * rng.randint(1, 9) + [f"w{int(rng.paretovariate(0.7))}" for _ in range(rng.randint(0, 40))]
        rng.shuffle(words)
        texts.append(" ".join(words))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    asked = [" ".join(["the", *(f"w{int(rng.paretovariate(0.4))}" for _ in range(rng.randint(0, 4)))]) for _ in range(25)]
    asked += ["the the w1 w1 w2", "nowhere", "", "the"]
    return docs, spark.createDataFrame(list(enumerate(asked)), "qid long, question string")


@pytest.fixture(scope="module")
def case(spark):
    docs, asked = made(spark)
    index = bm25.build_index(docs)
    return asked, index, inverted.build_lists(index, shard=200, block=16)


@pytest.mark.parametrize("k", [1, 7, 2000])
def test_the_ranking_is_the_exact_one(case, rows, k):
    asked, index, lists = case
    got = rows(inverted.retrieve(asked, index, lists, k), "qid", "rank")
    assert got == rows(bm25.retrieve(asked, index, k), "qid", "rank") and got


def test_small_blocks_of_questions_and_subsets(spark, case, rows):
    asked, index, lists = case
    some = spark.range(0, 900, 3).withColumnRenamed("id", "doc_id")
    want = rows(bm25.retrieve(asked, index, 5, some), "qid", "rank")
    assert rows(inverted.retrieve(asked, index, lists, 5, some), "qid", "rank") == want
    assert rows(inverted.retrieve(asked, index, lists, 5, some, block_bytes=2000), "qid", "rank") == want


def test_fewer_postings_are_touched_than_match(spark, case):
    asked, index, lists = case
    touched = spark.sparkContext.accumulator(0)
    rare = asked.filter("question like 'the w%'")
    assert inverted.retrieve(rare, index, lists, 3, touched=touched).count()
    weights = bm25.question_weights(rare, index)
    matched = weights.join(lists.stats, "term").agg({"df": "sum"}).first()[0]
    assert 0 < touched.value < 0.75 * matched  # 0.65 here


def test_layout(case):
    _, index, lists = case
    rows = lists.parts.collect()
    assert sum(r["size"] for r in rows) == index.forward.selectExpr("sum(size(terms))").first()[0]
    assert len([r for r in rows if r.term == "the"]) > 50 and max(r["size"] for r in rows) <= 16
    assert all(r.impacts == sorted(r.impacts, reverse=True) and r.impacts[0] == r.bound for r in rows)
    lists_of = {}
    for r in sorted(rows, key=lambda r: r.part):
        assert r.bound <= lists_of.setdefault((r.term, r.shard), r.bound)
    plan = lists.parts.filter("bucket in (1, 2)")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in plan


def test_negative_weights_read_everything(spark, rows):
    # every word in most documents: inverse frequencies and their mean are negative
    docs = spark.createDataFrame([(n, "a b" if n % 5 else "a b c d e f") for n in range(10)], "doc_id long, text string")
    index = bm25.build_index(docs)
    asked = spark.createDataFrame([(0, "a b"), (1, "a c")], "qid long, question string")
    lists = inverted.build_lists(index)
    assert rows(inverted.retrieve(asked, index, lists, 4), "qid", "rank") == rows(bm25.retrieve(asked, index, 4), "qid", "rank")


def test_empty_tables(spark):
    docs, asked = made(spark, 3)
    index = bm25.build_index(docs)
    lists = inverted.build_lists(index)
    assert inverted.retrieve(asked.limit(0), index, lists, 3).count() == 0


def test_postings_stay_in_the_task_of_their_shard(case):
    _, index, _ = case
    plan = inverted.list_parts(index, shard=200, block=16)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and "Aggregate" not in plan
