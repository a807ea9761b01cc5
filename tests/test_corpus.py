import pytest
from pyspark.sql import functions as F

from qaspark.operators import corpus as ops, stats
from qaspark.plans.broadcasts import measured_bytes, split_blocks
from qaspark.plans.order import exact_quantiles, row_index, running_total, value_counts_by
from qaspark.plans.topk import top_n


def test_row_index_is_dense_with_a_hot_value(spark):
    df = spark.range(1000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("v"), "id")
    got = row_index(df, ["v", "id"]).orderBy("row_no").collect()
    assert [r["row_no"] for r in got] == list(range(1000))
    assert [(r["v"], r["id"]) for r in got] == sorted((r["v"], r["id"]) for r in got)


def test_running_total(spark):
    df = spark.range(100).withColumn("w", F.col("id") + 1)
    got = running_total(df, ["id"], "w").orderBy("id").collect()
    assert [r["running"] for r in got] == [sum(range(1, i + 2)) for i in range(100)]


def test_exact_quantiles_match_percentile(spark):
    df = spark.range(997).select(F.lit("m").alias("metric"), ((F.col("id") * 37) % 101 * 1.5).alias("value"))
    counts = value_counts_by(df, "metric", "value")
    got = {r["fraction"]: r["quantile"] for r in exact_quantiles(counts, "metric", "value", [0.1, 0.5, 0.9]).collect()}
    want = df.select(F.percentile("value", F.array(F.lit(0.1), F.lit(0.5), F.lit(0.9)))).first()[0]
    assert [got[f] for f in (0.1, 0.5, 0.9)] == pytest.approx(want)


def test_top_n_equals_sorted_head(spark):
    df = spark.range(5000).withColumn("v", F.col("id") * 7919 % 1000)
    got = [r["id"] for r in top_n(df, [F.col("v").desc(), F.col("id")], 77, ["id"]).collect()]
    assert got == [r["id"] for r in sorted(df.collect(), key=lambda r: (-r["v"], r["id"]))[:77]]


def test_blocks_cover_every_key_once(spark):
    df = spark.range(500).select((F.col("id") % 50).alias("qid"), F.lit("term").alias("term"))
    blocks = split_blocks(df, "qid", measured_bytes(df) // 5)
    assert len(blocks) > 5
    keys = [set(r["qid"] for r in b.collect()) for b in blocks]
    assert sum(map(len, keys)) == len(set().union(*keys)) == 50


def test_dedup_keeps_first_and_numbers(spark, rows):
    df = spark.createDataFrame([(5, "a"), (3, "b"), (9, "a"), (4, "a"), (7, "b")], "doc_id long, text string")
    assert rows(ops.dedup_corpus(df, dense_id="n").select("doc_id", "text", "n"), "n") == [(3, "b", 0), (4, "a", 1)]
    assert rows(ops.dedup_corpus(df).select("doc_id"), "doc_id") == [(3,), (4,)]
    assert [r["doc_id"] for r in ops.find_duplicates(df).collect()] == [5, 7, 9]


def test_union_conforms_and_keeps_all_rows(spark):
    base = spark.createDataFrame([("a", "train")], "id string, split string")
    more = spark.createDataFrame([(1, "x", "validation")], "id int, other string, split string")
    bare = spark.createDataFrame([("c",)], "id string")
    union = ops.augment(base, [more, bare])
    assert union.columns == ["id", "split"] and union.count() == 3
    assert {r["split"] for r in union.collect()} == {"train", "validation", None}


def test_holdout_is_exact_and_disjoint(spark):
    df = spark.range(107).select(F.col("id").cast("string").alias("id"))
    flagged = ops.split_holdout(df, "id")
    assert flagged.filter("held_out").count() == 10 and flagged.count() == 107
    again = ops.split_holdout(df.repartition(3), "id").filter("held_out").select("id")
    assert again.exceptAll(flagged.filter("held_out").select("id")).count() == 0


def test_sampling(spark):
    df = spark.range(30).withColumnRenamed("id", "k")
    assert ops.sample_rows(df, "k", 8).distinct().count() == 8
    assert ops.sample_rows(df, "k", 50, replace=True).count() == 50


@pytest.mark.parametrize("n", [5, 31, 200])
def test_negatives_exclude_the_title_even_when_it_is_a_third_of_all(spark, n):
    docs = spark.range(120).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("t"), F.col("id") % 7)).alias("title")
    )
    asked = docs.select(F.col("doc_id").alias("qid"), "title")
    got = ops.sample_negatives(asked, docs, n)
    sizes = {r["title"]: r["c"] for r in docs.groupBy("title").agg(F.count("*").alias("c")).collect()}
    own = {r["qid"]: r["title"] for r in asked.collect()}
    per = {}
    for r in got.collect():
        assert r["title"] != own[r["qid"]]
        per.setdefault(r["qid"], []).append(r["doc_id"])
    for qid, title in own.items():
        assert len(per[qid]) == len(set(per[qid])) == min(n, 120 - sizes[title])


def test_negatives_for_an_unknown_title(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, title string")
    asked = spark.createDataFrame([(9, "z")], "qid long, title string")
    assert sorted(r["doc_id"] for r in ops.sample_negatives(asked, docs, 5).collect()) == [1, 2]


def test_context_is_joined_in_rank_order(spark, rows):
    hits = spark.createDataFrame([(1, 2, "b"), (1, 1, "a"), (1, 3, "c")], "qid long, rank int, text string")
    asked = spark.createDataFrame([(1, "q"), (2, "r")], "qid long, question string")
    assert rows(ops.concat_context(hits, asked), "qid") == [(1, "q", "a b c"), (2, "r", "")]


def test_histogram_edges(spark, rows):
    df = spark.createDataFrame([(v,) for v in (5, 10, 11, 20, 21, 95)], "v int")
    got = rows(stats.histogram(df, {"v": F.col("v")}, 10, 5), "bin")
    assert got == [("v", -1, 0), ("v", 0, 2), ("v", 1, 2), ("v", 2, 1), ("v", 3, 0), ("v", 4, 0), ("v", 5, 1)]
    below = spark.createDataFrame([(0,), (-7,), (None,), (300,)], "v int")
    assert sum(r[2] for r in rows(stats.histogram(below, {"v": F.col("v")}, 10, 5), "bin")) == 3


def test_describe_and_box(spark):
    df = spark.createDataFrame([(float(v),) for v in (1, 2, 3, 4, 100)], "v double")
    row = stats.describe_num(df, {"v": F.col("v")}).first()
    assert (row["count"], row["mean"], row["p25"], row["p50"], row["p75"]) == (5, 22.0, 2.0, 3.0, 4.0)
    assert row["std"] == pytest.approx(43.617657)
    box = stats.box_stats(df, {"v": F.col("v")}).first()
    assert (box["low_whisker"], box["high_whisker"], box["outliers"]) == (1.0, 4.0, 1)
    rough = stats.describe_num(df, {"v": F.col("v")}, approximate=True).first()
    assert rough["p50"] == 3.0


def test_describe_text_prefers_the_first_key(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, "a"), (4, "b"), (5, None)], "k long, t string")
    assert tuple(stats.describe_str(df, "t", "k").first()) == (4, 2, "b", 2)


def test_count_tables(spark, rows):
    left = spark.createDataFrame([("a", 4), ("b", 1), ("c", 9)], "title string, count long")
    right = spark.createDataFrame([("a", 10), ("b", 30)], "title string, count long")
    joined = stats.join_counts(left, right, "title")
    assert rows(joined) == [("a", 4, 10), ("b", 1, 30)]
    norm = stats.normalize_counts(joined, "title", ["count_train", "count_wiki"])
    assert sorted(rows(norm)) == [("a", 1, 0), ("b", 0, 1)]
    assert tuple(stats.ratio_above(left, F.col("count"), 3).first()) == (2, pytest.approx(2 / 3))
