import random

import pytest

from qaspark.operators import tfidf
from qaspark.plans import select


@pytest.mark.parametrize("ways", [2, 7, 4096])
def test_cut_against_sorting(spark, ways):
    rng = random.Random(2)
    values = [int(rng.paretovariate(0.3)) % 10**15 - 5 for _ in range(400)] + [7] * 150
    df = spark.createDataFrame([(v,) for v in values], "v long").repartition(3)
    ordered = sorted(values, reverse=True)
    for n in (1, 2, 100, 300, 549, 550):
        cut, above = select.cut_value(df, "v", n, ways)
        assert cut == ordered[n - 1] and above == sum(v > cut for v in values)
    assert select.cut_value(df, "v", 551, ways) is None


def test_largest_with_ties_at_the_cut(spark, rows):
    given = [("t%03d" % n, n % 5) for n in range(100)]
    df = spark.createDataFrame(given, "term string, cf long").repartition(4)
    for n in (0, 1, 20, 25, 99, 100, 500):
        want = sorted(sorted(given, key=lambda r: (-r[1], r[0]))[:n])
        assert rows(select.largest(df, "cf", ["term"], n), "term") == want
    assert select.largest(df.limit(0), "cf", ["term"], 3).count() == 0


def test_vocabulary_is_cut_without_a_window(spark):
    docs = spark.createDataFrame([(0, "a b a"), (1, "b c"), (2, "c d e")], "doc_id long, text string")
    best = select.largest(tfidf.term_statistics(tfidf.fit(docs).forward), "cf", ["term"], 4)
    assert "Window" not in best._jdf.queryExecution().toString()
    assert sorted(r.term for r in best.collect()) == ["a", "a b", "b", "c"]
