import numpy as np
import pytest

from qaspark.llm import permutation_index as pi

FOLDER = "/root/testdata/sf0.1"


def brute(rows, queries, k):
    """rows: (id, vector) usable ones only."""
    out = {}
    for query, target in queries:
        far = sorted(
            (float(np.sqrt(((np.array(v) - np.array(target)) ** 2).sum())), i) for i, v in rows if i != query
        )
        out[query] = [(n, i, d) for n, (d, i) in enumerate(far[:k], 1)]
    return out


def test_footrule():
    rng = np.random.default_rng(1)
    vectors, pivots = rng.normal(size=(30, 5)), rng.normal(size=(9, 5))
    orders = pi.orders(vectors, pivots, 4)
    for vector, order in zip(vectors, orders):
        assert order.tolist() == np.argsort(((pivots - vector) ** 2).sum(axis=1))[:4].tolist()
    places = pi.places(orders, 9)
    for order, row in zip(orders.tolist(), places.tolist()):
        assert row == [order.index(p) if p in order else 4 for p in range(9)]
    assert pi.footrule(places[0], places)[0] == 0
    assert pi.footrule(places[0], places)[3] == sum(abs(a - b) for a, b in zip(places[0].tolist(), places[3].tolist()))


def test_whole_when_all_files_are_opened(spark):
    rng = np.random.default_rng(2)
    vectors = [[float(x) for x in row] for row in rng.integers(-2, 3, (90, 3))]
    rows = [(n, v) for n, v in enumerate(vectors)] + [(500 + n, [1.0, 1.0, 1.0]) for n in range(60)]
    bad = [(900, None), (901, [0.0, 0.0, 0.0]), (902, [1.0, None, 2.0]), (903, [1.0, float("nan"), 2.0]), (904, [float("inf"), 1.0, 1.0]), (905, []), (906, [1.0]), (None, [1.0, 1.0, 2.0])]
    table = spark.createDataFrame(rows + rows[:5] + bad, "vec_id long, embedding array<double>").selectExpr("*", "'x' as entry")
    queries = table.filter("vec_id % 10 = 0 or vec_id > 899")
    for file in (4096, 20):
        found = pi.search(table, queries, 5, opened=1.0, measured=1.0, file=file).collect()
        got = {}
        for r in sorted(found, key=lambda r: (r.query_id, r["rank"])):
            got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
        usable = [(i, v) for i, v in rows if any(v)]
        expected = brute(usable, [(i, v) for i, v in usable if i % 10 == 0], 5)
        assert got == expected
    assert pi.search(table.limit(0), queries.limit(0)).collect() == []


@pytest.mark.parametrize("count", [1, 2, 5, 8, 11, 12, 13, 20, 30])
def test_default_shares_find_k_on_small_tables(spark, count):
    rng = np.random.default_rng(count)
    rows = [(n, [float(x) for x in row]) for n, row in enumerate(rng.normal(size=(count, 16)))]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    expected = brute(rows, rows, count)
    got = {}
    for r in sorted(pi.search(table, table).collect(), key=lambda r: (r.query_id, r["rank"])):
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    for query, near in expected.items():
        found = got.get(query, [])
        assert len(found) == min(10, count - 1)
        assert [score for _, _, score in found] == sorted(score for _, _, score in found)
        assert {n[1:] for n in found} <= {n[1:] for n in near}
        if count <= 11:
            assert found == near


def test_nearly_equal_vectors_are_found_too(spark):
    rows = [(n, [1.0 + n * 1e-15, 1.0]) for n in range(6)] + [(n, [float(n), 2.0]) for n in range(6, 14)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = pi.search(table, table).groupBy("query_id").count().collect()
    assert [r["count"] for r in got] == [10] * 14
    few = pi.search(table, table, pivot_bounds=(3, 3)).groupBy("query_id").count().collect()
    assert [r["count"] for r in few] == [10] * 14


def test_recall(spark):
    rows = spark.read.parquet(f"{FOLDER}/embeddings.parquet").select("vec_id", "embedding")
    exact = pi.exact_search(rows, rows.filter("vec_id % 100 = 0"), 10).cache()
    found = pi.op2_permutation_index(spark, FOLDER).cache()
    assert found.count() == exact.count() == 200
    assert pi.recall(found, exact) >= 0.95


def test_two_lengths_of_vectors(spark):
    rng = np.random.default_rng(4)
    rows = [(n, [float(x) for x in rng.normal(size=8 if n % 100 == 0 else 16)]) for n in range(300)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    # the length is that of most rows, so the short queries take no part
    assert pi.search(table, table.filter("vec_id % 100 = 0")).collect() == []
    mixed = pi.search(table, table.filter("vec_id % 50 = 0")).collect()
    assert {r.query_id for r in mixed} == {50, 150, 250} and len(mixed) == 30
    assert not {r.vec_id for r in mixed} & {0, 100, 200}
