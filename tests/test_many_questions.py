"""Many questions over one corpus: what a question costs a task, and that the ranking stays exact."""

import numpy as np
import pytest

from qaspark.operators import bm25, termindex
from qaspark.plans.bestk import BestK


def _batch(seed, docs=600, terms=80, top=30.0):
    rng = np.random.default_rng(seed)
    of_doc, term_ids = np.nonzero(rng.random((docs, terms)) < 1 / (1 + np.arange(terms) % 40))
    weights = np.round(rng.random(len(of_doc)) * top, 1) + 0.1  # many ties
    return np.arange(docs) * 2, of_doc, term_ids, weights


def _asked(seed, questions=50, terms=80, most=4):
    rng = np.random.default_rng(seed)
    lists = [np.sort(rng.choice(terms, rng.integers(0, 30), replace=False))[::-1] for _ in range(questions)]
    bounds = np.cumsum([0, *map(len, lists)])
    return np.arange(questions), bounds, np.concatenate(lists), rng.integers(1, most, bounds[-1]).astype(float)


def _brute(asked, docs, of_doc, term_ids, weights, k):
    _, bounds, terms, factors = asked
    dense = np.zeros((len(docs), 80))
    dense[of_doc, term_ids] = weights
    out = []
    for begin, end in zip(bounds, bounds[1:]):
        own = dense[:, terms[begin:end]]
        scores = np.round(own @ factors[begin:end], termindex.RANK_DIGITS)
        out.append([i for _, i in sorted((-scores[d], docs[d]) for d in np.flatnonzero((own > 0).any(axis=1)))[:k]])
    return out


def _kept(best):
    return [[i for _, i in sorted(zip(cost, ids))] for cost, ids in zip(best.cost, best.ids)]


@pytest.mark.parametrize("most, top", [(4, 30.0), (30, 30.0), (4, 1e-6), (2, 1e6)])  # 30 repeats are not counted in units
@pytest.mark.parametrize("often", [1, 40, 10**9])
def test_f1_bounds_in_units_leave_the_ranking_exact(monkeypatch, most, top, often):
    monkeypatch.setattr(termindex, "_OFTEN", often)
    for seed in range(3):
        asked, (docs, of_doc, term_ids, weights) = _asked(seed, most=most), _batch(seed, top=top)
        best = BestK(50, 7)
        gathered = termindex._Gathered(lambda *p: termindex._score_batch(best, asked, *p), limit=2000)
        for at in range(0, 600, 50):
            own = (of_doc >= at) & (of_doc < at + 50)
            gathered.add(docs[at : at + 50], of_doc[own] - at, term_ids[own], weights[own])
        gathered.settle()
        assert _kept(best) == _brute(asked, docs, of_doc, term_ids, weights, 7)


def test_f1_long_questions_add_up_beyond_sixteen_bits(monkeypatch):
    monkeypatch.setattr(termindex, "_FITS", 0.5)  # half of the questions do not fit
    asked, (docs, of_doc, term_ids, weights) = _asked(5, most=16), _batch(5)
    best = BestK(50, 7)
    termindex._score_batch(best, asked, docs, of_doc, term_ids, weights)
    assert _kept(best) == _brute(asked, docs, of_doc, term_ids, weights, 7)


def test_f1_only_documents_within_reach_are_scored(monkeypatch):
    asked, (docs, of_doc, term_ids, weights) = _asked(1, most=2), _batch(1)
    looked, look_up = [], termindex._Postings.look_up
    monkeypatch.setattr(termindex._Postings, "look_up", lambda self, t, d: looked.append(len(d)) or look_up(self, t, d))
    first = BestK(50, 5)
    termindex._score_batch(first, asked, docs, of_doc, term_ids, weights)
    again = BestK(50, 5, first.worst)
    termindex._score_batch(again, asked, docs, of_doc, term_ids, weights)
    pairs = sum(len(np.unique(of_doc[np.isin(term_ids, asked[2][b:e])])) for b, e in zip(asked[1], asked[1][1:]))
    assert sum(map(len, again.ids)) >= 5 * 45 and _kept(again) == _kept(first)
    assert sum(looked) < pairs  # lookups of both passes together: less than one for each pair with a common term


@pytest.fixture(scope="module")
def many(spark):
    rng = np.random.default_rng(0)
    draw = lambda n: " ".join(f"w{int(x)}" for x in rng.zipf(1.3, n) if x < 500)
    docs = spark.createDataFrame([(n, draw(rng.integers(0, 60))) for n in range(300)], "doc_id long, text string")
    asked = [(f"q{n % 90}", draw(rng.integers(0, 20))) for n in range(100)]  # ten come in two rows
    asked += [("none", None), ("unknown", "zz yy"), (None, "w1 w7")]
    return bm25.build_index(docs), spark.createDataFrame(asked, "qid string, question string")


def test_f1_many_questions_scan_the_words_once(spark, many, monkeypatch):
    index, asked = many
    want = {(r.qid, r.doc_id): r.score for r in bm25.bm25_scores(asked, index).collect()}
    few = bm25.retrieve(asked, index, 4)
    assert any("/forward-" in file for file in few.inputFiles())  # one scan is all there is
    monkeypatch.setattr(termindex, "_SAMPLE", 2)
    hits = bm25.retrieve(asked, index, 4, block_bytes=16000)
    assert not any("/forward-" in file for file in hits.inputFiles())
    rows = sorted(map(tuple, hits.collect()), key=str)
    assert rows == sorted(map(tuple, few.collect()), key=str)
    best = {}
    for (qid, doc), score in want.items():
        best.setdefault(qid, []).append((-score, doc))
    ranked = {(q, d, -s, n + 1) for q, own in best.items() for n, (s, d) in enumerate(sorted(own)[:4])}
    assert set(rows) == ranked


def test_f1_nothing_below_a_floor_leaves_a_task(spark):
    rows = [(n, 5, [0, 1], [1, n % 7 + 1]) for n in range(40)]
    documents = spark.createDataFrame(rows, "doc_id long, length long, numbers array<int>, counts array<int>").coalesce(3)
    asked = spark.createDataFrame([("a", [0, 1], [1.0, 1.0], 7.5), ("b", [1], [1.0], None)], "qid string, numbers array<int>, factors array<double>, floor double")
    found = termindex._found(documents, [asked], 50, lambda ids, counts, docs, lengths: counts, None, "string").collect()
    assert sorted((r.doc_id, r.score) for r in found if r.qid == "a") == [(n, 8.0) for n in range(6, 40, 7)]
    assert len([r for r in found if r.qid == "b"]) == 40
