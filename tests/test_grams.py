import math
import random
from collections import Counter, defaultdict

import pytest

from qaspark.operators import grams, tfidf
from qaspark.operators.termindex import forward_index


def _texts(count=300, seed=7):
    rng = random.Random(seed)
    return [" ".join(f"w{int(rng.paretovariate(0.6))}" for _ in range(rng.randint(0, 30))) for _ in range(count)] + ["", None, "  lone "]


def _docs(spark):
    return spark.createDataFrame(list(enumerate(_texts())), "doc_id long, text string").repartition(3)


def _plain():
    cf, df = Counter(), Counter()
    for text in _texts():
        words = (text or "").split()
        terms = words + [" ".join(p) for p in zip(words, words[1:])]
        cf.update(terms)
        df.update(set(terms))
    return cf, df


@pytest.mark.parametrize("n", [1, 5, 40, 300, 100_000])
def test_most_frequent_against_counting_everything(spark, rows, n):
    cf, df = _plain()
    want = sorted((t, c, df[t]) for t, c in sorted(cf.items(), key=lambda x: (-x[1], x[0]))[:n])
    joined = grams.joined_words(_docs(spark), "doc_id", "text", "space", True)
    assert rows(grams.most_frequent(joined, True, n), "term") == want


def test_rare_pairs_are_not_counted_by_name(spark):
    joined = grams.joined_words(_docs(spark), "doc_id", "text", "space", True)
    pairs = {t for t in _plain()[0] if " " in t}
    found = {r.term for r in grams.pair_statistics(joined, 20).collect()}
    assert {t for t in pairs if _plain()[0][t] >= 20} <= found and len(found) * 10 < len(pairs)


def test_the_forward_index_holds_the_vocabulary(spark, rows):
    model = tfidf.fit(_docs(spark), max_features=50)
    known = {r.term for r in model.vocabulary.collect()}
    want = forward_index(_docs(spark), "doc_id", "text", "space", True, True).collect()
    want = sorted((r.doc_id, r.length, [(t.term, t.tf) for t in r.terms if t.term in known]) for r in want)
    assert [(a, b, [tuple(t) for t in c]) for a, b, c in rows(model.forward, "doc_id")] == want
    assert model.documents == len(want)


def test_weights_need_no_exchange(spark):
    model = tfidf.fit(_docs(spark), max_features=50)
    plan = tfidf.transform_corpus(model)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan


def test_rows_of_one_key_share_their_norm(spark):
    docs = [(1, "a b"), (1, "a c"), (None, "a"), (None, "c"), (2, "b c")]
    model = tfidf.fit(spark.createDataFrame(docs, "doc_id long, text string"), bigrams=False)
    idf = {r.term: r.idf for r in model.vocabulary.collect()}
    squares = defaultdict(float)
    for key, text in docs:
        squares[key] += sum(idf[t] ** 2 for t in text.split())
    want = sorted((str(key), t, round(idf[t] / math.sqrt(squares[key]), 9)) for key, text in docs for t in text.split())
    got = tfidf.transform_corpus(model).collect()
    assert sorted((str(r.doc_id), r.term, round(r.weight, 9)) for r in got) == want
