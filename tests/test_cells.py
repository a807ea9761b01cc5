import numpy as np
import pytest

from qaspark.operators import cells, dense


@pytest.fixture(scope="module")
def case(spark):
    rng = np.random.default_rng(9)
    data = rng.normal(size=(900, 12))
    data[::3] = data[0] + rng.normal(scale=0.05, size=(300, 12))  # a third sits in one cell
    centroids = np.vstack([data[0], rng.normal(size=(9, 12))])
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(data)]
    asked = [(q, [float(x) for x in data[0] + rng.normal(scale=0.3, size=12)] if q % 2 else [float(x) for x in rng.normal(size=12)]) for q in range(20)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
    questions = spark.createDataFrame(asked, "qid long, embedding array<double>")
    return vectors, questions, centroids, cells.build_cells(vectors, centroids, rows=64)


def test_agrees_with_the_search_over_an_unstored_index(case, rows):
    vectors, questions, centroids, index = case
    want = rows(dense.ivf_search(questions, dense.assign_cells(vectors, centroids), centroids, 7, nprobe=3), "qid", "rank")
    got = rows(cells.search(questions, index, 7, nprobe=3), "qid", "rank")
    assert [r[:2] for r in got] == [r[:2] for r in want]
    assert [r[2] for r in got] == pytest.approx([r[2] for r in want], abs=1e-5)
    assert rows(cells.search(questions, index, 7, nprobe=3, block_bytes=1500), "qid", "rank") == got


def test_codes_find_what_the_exact_search_finds(case, rows):
    vectors, questions, centroids, index = case
    every = len(centroids)
    want = {r[:2] for r in rows(dense.retrieve_dense(questions, vectors, 10, "l2"))}
    got = rows(cells.search_codes(questions, index, 10, nprobe=every), "qid", "rank")
    assert len({r[:2] for r in got} & want) >= 0.95 * len(want)
    assert got == rows(cells.search_codes(questions, index, 10, nprobe=every, block_bytes=3000), "qid", "rank")
    # with a factor that takes everything, codes change nothing
    exact = rows(cells.search(questions, index, 10, nprobe=2), "qid", "rank")
    assert rows(cells.search_codes(questions, index, 10, nprobe=2, factor=100), "qid", "rank") == exact


def test_only_probed_partitions_are_read(spark, case):
    _, questions, centroids, index = case
    one = questions.filter("qid = 1")
    scans = []
    for search in (cells.search, cells.search_codes):
        plan = search(one, index, 3)._jdf.queryExecution().executedPlan().toString()
        scans += [line for line in plan.splitlines() if "FileScan" in line]
    assert scans and all("PartitionFilters: [" in line and "cell#" in line.split("PartitionFilters")[1] for line in scans)
    assert "embedding" not in cells._probed(index, cells.probes(one, centroids, 1), 3, "codes", cells._ByCodes, 1 << 20)._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[1]
    hot = index.vectors.filter("cell = 0")
    assert hot.select("part").distinct().count() > 3  # the hot cell is several parts
    assert index.vectors.count() == 900 and index.sizes.agg({"n": "sum"}).first()[0] == 900


def test_odd_tables(spark, case):
    vectors, questions, centroids, index = case
    assert cells.search(questions.limit(0), index, 3).count() == 0
    none = cells.build_cells(vectors.limit(0), centroids)
    assert cells.search(questions, none, 3).count() == cells.search_codes(questions, none, 3).count() == 0
    same = spark.createDataFrame([(n, [1.0, 1.0]) for n in range(30)], "vec_id long, embedding array<double>")
    flat = cells.build_cells(same, np.array([[0.0, 0.0], [5.0, 5.0]]))  # no spread in any dimension, ties
    asked = spark.createDataFrame([(1, [1.0, 2.0])], "qid long, embedding array<double>")
    for found in (cells.search(asked, flat, 4), cells.search_codes(asked, flat, 4)):
        assert [(r.vec_id, r.score) for r in found.orderBy("rank").collect()] == [(n, 1.0) for n in range(4)]
