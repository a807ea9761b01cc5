"""Toxicity grammar and quality network: rules on small texts, accuracy on rows not learned from."""

import numpy as np
import pyarrow as pa
import pytest

from qaspark.llm import quality, toxicity
from qaspark.llm.labelled import held_out

FOLDER = "/root/testdata/sf0.01"


def kinds(text):
    hasher = toxicity._hasher()
    rows = sorted(toxicity._seeds(hasher))
    grammar = toxicity.Grammar(
        np.array([r[0] for r in rows], np.uint64), np.array([r[1] for r in rows], np.int8),
        np.ones(len(rows)), toxicity.PRIOR,
    )
    found = grammar.features(pa.array([text]), hasher, *toxicity.compose())[0]
    return np.rint(np.expm1(found[1:7])).astype(int).tolist()


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        (None, [0, 0, 0, 0, 0, 0]),
        ("", [0, 0, 0, 0, 0, 0]),
        ("What a MORON.", [1, 0, 0, 0, 0, 0]),
        ("you utter moron", [0, 1, 0, 0, 0, 0]),
        ("you. moron", [1, 0, 0, 0, 0, 0]),
        ("that is not stupid", [0, 0, 1, 0, 0, 0]),
        ("it was not, as far as all could see, stupid", [1, 0, 0, 0, 0, 0]),
        ("she said: trash", [1, 0, 0, 0, 0, 0]),
        ("the paper wrote trash", [0, 0, 0, 1, 0, 0]),
        ("I will hurt you", [0, 0, 0, 0, 1, 0]),
        ("I will never hurt you", [0, 0, 0, 0, 0, 1]),
        ("hurt nothing that we have seen, you", [0, 0, 0, 0, 0, 0]),
        ("idiot Idiot", [2, 0, 0, 0, 0, 0]),
    ],
)
def test_clauses(text, expected):
    assert kinds(text) == expected


def brute_probability(text, model):
    filters, bias, weights = model
    raw = list((text or "").encode())
    halves = max(2, -(-(len(raw) + quality.WIDTH - 1) // quality.HALF))
    raw += [quality.PAD] * (halves * quality.HALF + quality.WIDTH - 1 - len(raw))
    response = [
        sum(filters[j][raw[p + j]].astype(float) for j in range(quality.WIDTH)) + bias
        for p in range(halves * quality.HALF)
    ]
    chunks = [
        np.maximum(np.max(response[n * quality.HALF : (n + 2) * quality.HALF], axis=0), 0)
        for n in range(halves - 1)
    ]
    z = np.concatenate((np.max(chunks, axis=0), np.mean(chunks, axis=0), [1])) @ weights
    return 1 / (1 + np.exp(-z))


def test_network_against_plain_loops():
    texts = [None, "", "é", "x" * 256, "abc " * 200, "z" * 1500, "q" * 513]
    model = quality.start_model(3)
    found = quality.probabilities(pa.array(texts), model)
    assert np.allclose(found, [brute_probability(t, model) for t in texts], atol=1e-5)
    assert np.allclose(quality.probabilities(pa.array(["abc " * 200]), model), found[4])


def test_gradients():
    texts, y, model = ["good text here", "BAD!! " * 150, "x" * 700], np.array([1.0, 0.0, 1.0]), quality.start_model(5)
    on_filters, _, on_weights = quality._gradients(texts, y, model)

    def loss():
        p = quality.probabilities(pa.array(texts), model)
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    for place, byte, column in [(0, ord("x"), 2), (3, ord("!"), 5), (5, ord("B"), 9)]:
        before = model[0][place, byte, column]
        values = []
        for change in (1e-2, -1e-2):
            model[0][place, byte, column] = before + change
            values.append(loss())
        model[0][place, byte, column] = before
        assert abs((values[0] - values[1]) / 2e-2 - on_filters[place, byte, column]) < 2e-3
    assert np.abs(on_weights).max() > 0


@pytest.mark.parametrize(("query", "label", "least"), [(toxicity.op7_toxicity, "toxic", 0.93), (quality.op8_quality_cnn, "quality", 0.93)])
def test_accuracy_on_rows_not_learned_from(spark, query, label, least):
    rows = query(spark, FOLDER)
    assert rows.count() == spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    known = rows.filter("held_out").join(labels, "doc_id").select("predicted", label, "score").collect()
    assert all(0 <= r.score <= 1 for r in known)
    assert np.mean([r.predicted == r[label] for r in known]) >= least


def test_no_labels_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, None, "a"), (1, None, "a"), (None, "", "b"), (3, "fine words", "c")], "doc_id long, text string, score string"
    )
    labels = spark.createDataFrame([(3, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    kept = toxicity.reject(docs, labels)
    assert sorted(map(str, kept.collect())) == sorted(map(str, docs.collect()))
    model = quality.fit(docs, labels)
    assert quality.score(docs.limit(0), model, to="q").collect() == []
    assert quality.score(docs, model, to="q").select("score", "q").count() == 4
    assert docs.select(held_out("doc_id", 3, 1).alias("h")).filter("h is null").count() == 0
