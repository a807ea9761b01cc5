import math
from collections import Counter, defaultdict
from hashlib import md5

import pytest

from qaspark.operators import sparse_cells, tfidf

TOPICS = ["sun moon star sky", "bread salt oil flour", "goal ball team match", "river lake sea rain"]


def _texts():
    rows = []
    for i in range(120):
        words = TOPICS[0 if i % 3 == 0 else i % 4].split()
        rows.append((i, " ".join(words[(i * j) % 4] for j in range(1, 9)) + f" the word{i % 7}"))
    return rows + [(120, ""), (121, None)]


@pytest.fixture(scope="module")
def case(spark):
    corpus = spark.createDataFrame(_texts(), "doc_id long, text string").repartition(4)
    model = tfidf.fit(corpus, max_features=60)
    vocabulary = sparse_cells.numbered_terms(model)
    return model, vocabulary, sparse_cells.corpus_vectors(model, vocabulary)


def _plain(vectors):
    return {r.doc_id: dict(zip(r.ids, r.weights)) for r in vectors.collect()}


def _normed(weights, top):
    kept = dict(sorted(((t, round(w, 12)) for t, w in weights.items()), key=lambda e: (-e[1], e[0]))[:top])
    norm = math.sqrt(sum(w * w for w in kept.values()))
    return {t: w / norm for t, w in kept.items()}


def _dot(a, b):
    return round(sum(w * b[t] for t, w in a.items() if t in b), 12)


def _lloyd(vectors, n_cells, top, iterations):
    ids = sorted((d for d, v in vectors.items() if v), key=lambda d: md5(str(d).encode()).hexdigest())[:n_cells]
    centroids = [_normed(vectors[d], top) for d in ids]
    for _ in range(iterations):
        sums = defaultdict(Counter)
        for v in vectors.values():
            cell = max(range(n_cells), key=lambda c: (_dot(v, centroids[c]), -c))
            for t, w in v.items():
                sums[cell][t] += w
        centroids = [_normed(sums[c], top) if sums[c] else centroids[c] for c in range(n_cells)]
    return centroids


def test_rows_hold_the_weights_of_the_model(case):
    model, vocabulary, vectors = case
    number = {r.term: r.number for r in vocabulary.collect()}
    want = defaultdict(dict)
    for r in tfidf.transform_corpus(model).collect():
        want[r.doc_id][number[r.term]] = r.weight
    got = _plain(vectors)
    assert set(got) == set(range(122)) and got[120] == got[121] == {}
    for doc, weights in got.items():
        assert weights == pytest.approx(want.get(doc, {}))
    # beyond the broadcast limit, by joins
    far = _plain(sparse_cells.corpus_vectors(model, vocabulary, block_bytes=0))
    assert set(far) == set(got) and all(far[d] == pytest.approx(got[d]) for d in got)


@pytest.mark.parametrize("iterations", [0, 1, 5])
def test_training_and_cells_against_plain_python(case, iterations):
    vectors = case[2]
    plain = _plain(vectors)
    want = _lloyd(plain, 6, 5, iterations)
    centroids = sparse_cells.train(vectors, 6, top=5, iterations=iterations, sample=None)
    got = [{} for _ in range(6)]
    for term, cell, weight in zip(centroids.terms, centroids.cells, centroids.weights):
        got[cell][int(term)] = weight
    assert [g == pytest.approx(w) for g, w in zip(got, want)] == [True] * 6
    for r in sparse_cells.assign(vectors, centroids).collect():
        near = max(range(6), key=lambda c: (_dot(plain[r.doc_id], want[c]), -c))
        assert (r.cell, r.similarity) == (near, pytest.approx(_dot(plain[r.doc_id], want[near])))


def test_search_is_exact_within_the_probed_cells(spark, case, rows):
    model, vocabulary, vectors = case
    centroids = sparse_cells.train(vectors, 6, top=5, iterations=3)
    index = sparse_cells.build(vectors, centroids, rows=16)  # a third of the rows in one cell: several parts
    assert index.vectors.select("cell", "part").distinct().count() > 6
    asked = spark.createDataFrame(
        [(0, "sun sky bread"), (1, "goal the rain"), (2, "nothing known"), (3, None), (4, "salt oil word3")],
        "qid long, question string",
    )
    questions = sparse_cells.question_vectors(asked, model, vocabulary)
    everything = rows(sparse_cells.search(questions, index, 9, nprobe=6), "qid", "rank")
    exact = rows(tfidf.retrieve(asked, model, 9), "qid", "rank")
    assert [(r[0], r[1], r[3]) for r in everything] == [(r[0], r[1], r[3]) for r in exact]
    assert [r[2] for r in everything] == pytest.approx([r[2] for r in exact], abs=1e-6)

    cell = {r.doc_id: r.cell for r in index.vectors.collect()}
    plain = _plain(vectors)
    probed = defaultdict(set)
    for r in sparse_cells.probes(questions, centroids, 2).collect():
        probed[r.qid].add(r.cell)
    want = []
    for q in questions.orderBy("qid").collect():
        own = dict(zip(q.ids, q.weights))
        hits = [(-_dot(own, v), d) for d, v in plain.items() if cell[d] in probed[q.qid] and set(own) & set(v)]
        want += [(q.qid, d, n) for n, (_, d) in enumerate(sorted(hits)[:9], 1)]
    found = sparse_cells.search(questions, index, 9, nprobe=2)
    assert "PartitionFilters: [cell" in found._jdf.queryExecution().toString()
    got = rows(found, "qid", "rank")
    assert [(r[0], r[1], r[3]) for r in got] == want
    assert rows(sparse_cells.search(questions, index, 9, nprobe=2, block_bytes=200), "qid", "rank") == got


def test_nothing_to_make_cells_of(spark, case):
    model, vocabulary, vectors = case
    with pytest.raises(ValueError):
        sparse_cells.train(vectors.filter("doc_id >= 120"), 3)
    assert sparse_cells.corpus_vectors(model, vocabulary).filter("false").count() == 0


def test_all_rows_are_trained_on_where_they_are_stored(case, monkeypatch):
    _, _, vectors = case
    stored = []
    monkeypatch.setattr(sparse_cells, "store", lambda rows, name: stored.append(name) or rows)
    sparse_cells.train(vectors, 4, 10, iterations=1, sample=None)
    assert stored == []
    sparse_cells.train(vectors, 4, 10, iterations=1, sample=5)
    assert stored == ["sample"]
