"""What a task holds does not grow with the input."""

import numpy as np
import pyarrow as pa

from qaspark import session
from qaspark.operators import bm25, chunks, sparse_cells, termindex
from qaspark.plans.bestk import BestK
from qaspark.sources import readers, writers


def _brute(asked, docs, of_doc, term_ids, weights, k):
    qids, bounds, terms, factors = asked
    dense = np.zeros((len(docs), 60))
    dense[of_doc, term_ids] = weights
    out = []
    for n in range(len(qids)):
        own = slice(bounds[n], bounds[n + 1])
        met = np.flatnonzero((dense[:, terms[own]] > 0).any(axis=1))
        scores = np.round(dense[:, terms[own]] @ factors[own], termindex.RANK_DIGITS)
        out.append(sorted(((-scores[d], docs[d]) for d in met))[:k])
    return out


def _case(seed):
    rng = np.random.default_rng(seed)
    pairs = [(d, t) for d in range(400) for t in range(60) if rng.random() < 1 / (1 + t % 30)]
    of_doc, term_ids = (np.array(c) for c in zip(*pairs))
    weights = np.round(rng.random(len(pairs)) * (1 + term_ids % 30), 1) + 0.1  # many ties
    lists = [np.sort(rng.choice(60, rng.integers(0, 12), replace=False))[::-1] for _ in range(40)]
    bounds = np.cumsum([0, *map(len, lists)])
    asked = np.arange(40), bounds, np.concatenate(lists), rng.integers(1, 3, bounds[-1]).astype(float)
    return asked, np.arange(400) * 3, of_doc, term_ids, weights


def test_f1_pruned_scores_are_the_exact_ranking():
    for seed in range(4):
        asked, docs, of_doc, term_ids, weights = _case(seed)
        best = BestK(40, 5)
        gathered = termindex._Gathered(lambda *p: termindex._score_batch(best, asked, *p), limit=700)
        for at in range(0, 400, 20):
            own = (of_doc >= at) & (of_doc < at + 20)
            gathered.add(docs[at : at + 20], of_doc[own] - at, term_ids[own], weights[own])
        gathered.settle()
        got = [sorted(zip(best.cost[n], best.ids[n])) for n in range(40)]
        want = _brute(asked, docs, of_doc, term_ids, weights, 5)
        assert [[i for _, i in one] for one in got] == [[i for _, i in one] for one in want]


def test_f1_documents_that_cannot_get_in_are_not_scored(monkeypatch):
    asked = np.array([1]), np.array([0, 2]), np.array([0, 1]), np.array([1.0, 1.0])
    best = BestK(1, 2)
    two = np.array([0, 1])
    termindex._score_batch(best, asked, np.array([5, 6]), two, np.array([0, 0]), np.array([9.0, 8.0]))
    seen = []
    monkeypatch.setattr(BestK, "offer", lambda self, *a: seen.append(a))
    termindex._score_batch(best, asked, np.array([7, 8]), two, np.array([1, 1]), np.array([1.0, 2.0]))
    assert not seen
    termindex._score_batch(best, asked, np.array([3]), np.array([0]), np.array([1]), np.array([8.0]))
    assert seen  # a tie with a smaller id


def test_f1_questions_of_a_cell_come_as_arrays_or_lists():
    for kind in (list, np.array):
        ids, weights = [kind([3, 5]), kind([]), kind([1, 2])], [kind([0.1, 0.9]), kind([]), kind([0.5, 0.5])]
        some = sparse_cells._Some(BestK(3, 1), np.array([0, 1]), ids, weights)
        numbers, bounds, terms, shares = some.asked
        assert bounds.tolist() == [0, 2, 2] and terms.tolist() == [5, 3] and shares.tolist() == [0.9, 0.1]
        termindex._score_batch(some, some.asked, np.array([4]), np.array([0]), np.array([5]), np.array([1.0]))
        assert some.best.ids[0].tolist() == [4] and some.worst.tolist() == [-0.9, np.inf]


def test_f3_f4_f14_a_batch_is_scored_in_pieces():
    lists = pa.array([["a"] * n for n in (3, 0, 4, 9, 1)], pa.list_(pa.string()))
    batch = pa.RecordBatch.from_arrays([pa.array(range(5)), lists], ["doc_id", "words"])
    got = [p.column("doc_id").to_pylist() for p in termindex.pieces(iter([batch]), "words", 7)]
    assert got == [[0, 1, 2], [3], [4]]


def test_f5_f6_f11_small_tables_get_tasks_by_size(spark, tmp_path, monkeypatch):
    spark.range(1000).write.parquet(f"{tmp_path}/t")
    stored = readers.stored_bytes(spark, f"{tmp_path}/t")
    monkeypatch.setattr(readers, "SPREAD_BYTES", stored // 20)
    got = readers.read_table(spark, f"{tmp_path}/t", ["id"])
    assert got.rdd.getNumPartitions() >= 20 and got.count() == 1000


def test_f10_pairs_are_summed_up_in_tasks_of_bounded_size(spark, monkeypatch, capsys):
    docs = spark.createDataFrame([(n, f"a b{n % 7} c{n}") for n in range(50)], "doc_id long, text string")
    asked = spark.createDataFrame([(n, f"b{n} a") for n in range(9)], "qid long, question string")
    index = bm25.build_index(docs)
    want = sorted(map(tuple, bm25.bm25_scores(asked, index).collect()))
    monkeypatch.setattr(termindex, "_PAIRS", 10)
    pairs = bm25.bm25_scores(asked, index)
    pairs.explain()
    assert "45), REPARTITION_BY_NUM" in capsys.readouterr().out
    assert sorted(map(tuple, pairs.collect())) == want


def test_f13_ids_are_looked_up_without_python_objects():
    fill = chunks._known_ids(pa.array(["x", "y"]), pa.array([7, 8], pa.int32())).func
    found = pa.array([[None, 1], [], [None]], pa.list_(pa.int32()))
    got = fill(pa.array([["y", "x"], [], ["z"]]), found)
    assert isinstance(got, pa.Array) and got.to_pylist() == [[8, 1], [], [None]]


def test_f17_objects_pass_in_batches_of_bounded_bytes(spark, tmp_path):
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    df = spark.createDataFrame([("a", "x" * 10), ("b", "y")], "k string, v string")
    writers.write_objects(df, f"{tmp_path}/o", "k", df.v)
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == str(session.BATCH_BYTES)
