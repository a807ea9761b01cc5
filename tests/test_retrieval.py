import numpy as np
import pytest
from pyspark.sql import functions as F

from qaspark.operators import bm25, dense, losses, rerank, termindex, tfidf
from qaspark.operators.quality import recall_at_k
from qaspark.plans.bestk import BestK

DOCS = [(0, "a b a"), (1, "b c"), (2, "c d e")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "doc_id long, text string")


@pytest.fixture(scope="module")
def index(docs):
    return bm25.build_index(docs)


def ask(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "qid long, question string")


def scores(hits):
    return {(r["qid"], r["doc_id"]): r["score"] for r in hits.collect()}


def test_idf(index):
    assert index.mean_idf == pytest.approx(0.102165, abs=1e-6)
    idf = {r["term"]: r["idf"] for r in index.idf(index.frequencies).collect()}
    assert idf["a"] == pytest.approx(0.510826, abs=1e-6)
    assert idf["b"] == idf["c"] == pytest.approx(0.025541, abs=1e-6)


def test_bm25_scores_and_repeated_terms(spark, index):
    got = scores(bm25.retrieve(ask(spark, "a c", "a a c"), index, 5))
    assert got == {
        (0, 0): 0.701563, (0, 1): 0.028779, (0, 2): 0.024181,
        (1, 0): 1.403126, (1, 1): 0.028779, (1, 2): 0.024181,
    }
    assert scores(bm25.bm25_scores(ask(spark, "a c", "a a c"), index)) == got


def test_small_blocks_give_the_same_ranking(spark, index):
    asked = ask(spark, *["a c", "b", "d e a", "c c", "e"])
    whole = bm25.retrieve(asked, index, 2)
    parts = bm25.retrieve(asked, index, 2, block_bytes=100)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, parts.collect()))


def test_subset_keeps_global_statistics(spark, index):
    subset = spark.createDataFrame([(1,), (2,)], "doc_id long")
    assert scores(bm25.retrieve(ask(spark, "a c"), index, 5, subset)) == {(0, 1): 0.028779, (0, 2): 0.024181}


def test_unknown_terms_and_filling(spark, index):
    asked = ask(spark, "zz", "a")
    assert {q for q, _ in scores(bm25.retrieve(asked, index, 2))} == {1}
    filled = bm25.retrieve(asked, index, 2, fill=True).orderBy("qid", "rank").collect()
    assert [(r["qid"], r["doc_id"], r["rank"]) for r in filled] == [(0, 0, 1), (0, 1, 2), (1, 0, 1), (1, 1, 2)]


def test_only_unknown_terms(spark, index):
    assert bm25.retrieve(ask(spark, "zz"), index, 2).count() == 0


def test_single_question(docs, index):
    best = bm25.top_n("a c", index, docs, 2).orderBy(F.col("score").desc()).collect()
    assert [r["text"] for r in best] == ["a b a", "b c"]


def test_tfidf_cosines(spark, docs):
    model = tfidf.fit(docs)
    assert model.vocabulary.count() == 10
    expected = {(0, 0): 0.153555, (0, 1): 1.0, (0, 2): 0.184063}
    assert scores(tfidf.retrieve(ask(spark, "b c"), model, 5)) == expected
    shuffled = tfidf.retrieve(ask(spark, "b c"), model, 5, block_bytes=10)
    assert scores(shuffled) == expected


def test_tfidf_vocabulary_cut_and_oov(spark, docs):
    model = tfidf.fit(docs, max_features=3)
    assert sorted(r["term"] for r in model.vocabulary.collect()) == ["a", "b", "c"]
    assert [r["qid"] for r in tfidf.oov_questions(ask(spark, "zz", "d", "a zz"), model).orderBy("qid").collect()] == [0, 1]


def test_matches_brute_force_with_a_hot_term(spark):
    import math
    import random

    rng = random.Random(3)
    texts = [" ".join(["the"] * rng.randint(1, 9) + [f"w{rng.randint(0, 40)}" for _ in range(rng.randint(0, 30))]) for _ in range(120)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    questions = [" ".join(["the"] + [f"w{rng.randint(0, 45)}" for _ in range(4)]) for _ in range(9)]
    tokens = [t.split() for t in texts]
    n, mean = len(texts), sum(map(len, tokens)) / len(texts)
    df = {w: sum(w in t for t in tokens) for w in {w for t in tokens for w in t}}
    raw = {w: math.log(n - d + 0.5) - math.log(d + 0.5) for w, d in df.items()}
    floor = 0.25 * sum(raw.values()) / len(raw)
    idf = {w: floor if r < 0 else r for w, r in raw.items()}
    want = {}
    for q, text in enumerate(questions):
        ranked = []
        for d, words in enumerate(tokens):
            if set(words) & set(text.split()):
                s = sum(
                    idf.get(w, 0) * words.count(w) * 2.5 / (words.count(w) + 1.5 * (0.25 + 0.75 * len(words) / mean))
                    for w in text.split()
                )
                ranked.append((-round(s, 6), d))
        want[q] = [d for _, d in sorted(ranked)[:7]]
    hits = bm25.retrieve(ask(spark, *questions), bm25.build_index(docs.repartition(5)), 7)
    got = {q: [] for q in want}
    for r in hits.orderBy("qid", "rank").collect():
        got[r["qid"]].append(r["doc_id"])
    assert got == want


def test_recall(spark, rows):
    hits = spark.createDataFrame([(1, 1, "x"), (1, 2, "gold y"), (2, 1, "gold")], "qid long, rank int, text string")
    gold = spark.createDataFrame([(1, "gold"), (2, "gold"), (3, "none")], "qid long, gold string")
    assert rows(recall_at_k(hits, gold, [1, 2]), "k") == [(1, 3, 1, pytest.approx(1 / 3)), (2, 3, 2, pytest.approx(2 / 3))]
    assert rows(recall_at_k(hits, gold, [1], equal=True)) == [(1, 3, 1, pytest.approx(1 / 3))]


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(5)
    data = rng.normal(size=(300, 6))
    data[::3] = data[0] + rng.normal(scale=0.01, size=(100, 6))  # a third sits in one place
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(data)]
    return data, spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)


def _nearest(data, q, k, metric):
    cost = -np.round(data @ q, 6) if metric == "dot" else np.round(((data - q) ** 2).sum(axis=1), 6)
    return list(np.lexsort((np.arange(len(data)), cost))[:k])


@pytest.mark.parametrize("metric", ["dot", "l2"])
@pytest.mark.parametrize("block", [1 << 20, 150])
def test_dense_search_is_exact(spark, vectors, metric, block):
    data, table = vectors
    data = data.astype(np.float32).astype(np.float64)
    asked = spark.createDataFrame([(q, [float(x) for x in data[q * 20]]) for q in range(5)], "qid long, embedding array<double>")
    got = dense.retrieve_dense(asked, table, 8, metric, block).orderBy("qid", "rank").collect()
    for q in range(5):
        assert [r["vec_id"] for r in got if r["qid"] == q] == _nearest(data, data[q * 20], 8, metric)


def test_probing_all_cells_equals_exact_search(spark, vectors):
    data, table = vectors
    cells = dense.train_cells(table, 7, seed=1, iterations=5)
    index = dense.assign_cells(table, cells)
    asked = table.filter("vec_id < 6").select(F.col("vec_id").alias("qid"), "embedding")
    exact = dense.retrieve_dense(asked, table, 9, "l2").collect()
    probed = dense.ivf_search(asked, index, cells, 9, nprobe=len(cells)).collect()
    assert sorted(map(tuple, exact)) == sorted(map(tuple, probed))
    one = dense.ivf_search(asked, index, cells, 9, nprobe=1)
    assert one.filter("rank = 1 and qid = vec_id").count() == 6


def test_quantised_values_stay_close(vectors):
    data, table = vectors
    ranges = dense.value_ranges(table, 6)
    back = dense.sq_decode(dense.sq_encode(table, ranges), ranges).collect()
    step = max(b - a for a, b in ranges) / 255
    for r in back:
        assert np.abs(np.array(r["embedding"]) - data[r["vec_id"]]).max() <= step
        assert all(0 <= c <= 255 for c in r["codes"])


def test_pooling(spark):
    tokens = spark.createDataFrame([("a", 1, [3.0, 4.0]), ("a", 0, [1.0, 0.0])], "qid string, pos int, embedding array<double>")
    assert dense.pool_first(tokens, "qid").first()["embedding"] == [1.0, 0.0]
    assert dense.pool_mean(tokens, "qid", 2).first()["embedding"] == [2.0, 2.0]


def test_external_encoder(spark):
    texts = spark.createDataFrame([(1, "aa"), (2, "b")], "k long, text string")

    def load():
        return lambda batch: np.array([[len(t), 1.0] for t in batch])

    got = dense.embed(texts, "k", "text", load, batch=1).orderBy("k").collect()
    assert [r["embedding"] for r in got] == [[2.0, 1.0], [1.0, 1.0]]


def test_hash_embedding_is_normalised(spark):
    texts = spark.createDataFrame([(1, "one two two"), (2, "")], "doc_id long, text string")
    got = {r["doc_id"]: r["embedding"] for r in dense.hash_embed(texts, dim=16).collect()}
    assert np.linalg.norm(got[1]) == pytest.approx(1.0) and not any(got[2])


def test_pair_scores(spark):
    rng = np.random.default_rng(2)
    codes, hidden, cand = rng.normal(size=(3, 4)), rng.normal(size=(50, 4)), rng.normal(size=(2, 4))
    tokens = spark.createDataFrame([(1, [float(x) for x in v]) for v in hidden], "qid long, embedding array<double>").repartition(5)
    cands = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(cand)], "cand_id long, embedding array<double>")
    pairs = spark.createDataFrame([(1, 0), (1, 1)], "qid long, cand_id long")

    def attend(q, k, v):
        w = np.exp(q @ k.T - (q @ k.T).max(axis=-1, keepdims=True))
        return (w / w.sum(axis=-1, keepdims=True)) @ v

    summaries = attend(codes, hidden, hidden)
    want = [float(attend(c[None], summaries, summaries)[0] @ c) for c in cand]
    got = rerank.score_poly(pairs, tokens, cands, codes).orderBy("cand_id").collect()
    assert [r["score"] for r in got] == pytest.approx(want)
    pooled = spark.createDataFrame([(1, [1.0, 0.0, 0.0, 2.0])], "qid long, embedding array<double>")
    got = rerank.score_bi(pairs, pooled, cands).orderBy("cand_id").collect()
    assert [r["score"] for r in got] == pytest.approx([c[0] + 2 * c[3] for c in cand])
    got = rerank.score_linear(cands, "embedding", [1, 1, 1, 1], 0.5).orderBy("cand_id").collect()
    assert [r["score"] for r in got] == pytest.approx([c.sum() + 0.5 for c in cand])


def test_losses(spark):
    grid = [(0, r, c, s) for r, line in enumerate([[2.0, 0.0], [1.0, 1.0]]) for c, s in enumerate(line)]
    scores = spark.createDataFrame(grid, "batch int, row int, col int, score double")
    assert losses.inbatch_nll(scores).first()["loss"] == pytest.approx(0.410038, abs=1e-6)
    listed = spark.createDataFrame([(1, 1, 3.0), (1, 0, 2.0), (1, 0, 0.0)], "qid long, label int, score double")
    assert losses.list_loss(listed).first()["loss"] == pytest.approx(0.349012, abs=1e-6)


@pytest.mark.parametrize("metric, value", [("dot", 1.0 + 1e-8), ("l2", 1.0 - 1e-8)])
def test_dense_ranks_beyond_six_digits(spark, metric, value):
    stored = spark.createDataFrame([(1, [1.0, 0.0]), (2, [value, 0.0])], "vec_id long, embedding array<double>")
    asked = spark.createDataFrame([(1, [1.0 if metric == "dot" else 0.0, 0.0])], "qid long, embedding array<double>")
    assert [(r["vec_id"], r["score"]) for r in dense.retrieve_dense(asked, stored, 1, metric).collect()] == [(2, 1.0)]


def test_sparse_ranks_beyond_six_digits(spark):
    best = BestK(1, 1)
    asked = np.array([1]), np.array([0, 1]), np.array([0]), np.array([1.0])
    termindex._score_batch(best, asked, np.array([1, 2]), np.array([0, 1]), np.array([0, 0]), np.array([0.5, 0.5 + 1e-8]))
    assert best.ids[0].tolist() == [2]
    pairs = spark.createDataFrame([(1, 1, 0.5), (1, 2, 0.5 + 1e-8)], "qid long, doc_id long, score double")
    assert [(r["doc_id"], r["score"]) for r in termindex.rank_pairs(pairs, 1).collect()] == [(2, 0.5)]
