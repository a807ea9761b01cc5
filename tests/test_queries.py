import os

import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"


def test_every_query_has_its_sql():
    own = {name for group in entry._GROUPS for name in group.QUERIES}
    assert own <= set(entry.queries()) and own <= set(entry.oracle_sql()) <= set(entry.queries())
    assert len(own) >= 90
    assert all(isinstance(sql, str) for sql in entry.oracle_sql().values())


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not there")
def test_flagship(spark):
    rows = entry.entry(spark)
    assert rows.columns == ["qid", "doc_id", "score", "rank"]
    assert rows.count() > 0


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not there")
@pytest.mark.parametrize("name", ["bm25_topk", "tfidf_topk", "dense_topk", "corpus_dedup", "negative_sampling", "span_decode"])
def test_plans_have_no_cartesian_product(spark, name):
    plan = entry.queries()[name](spark, FOLDER)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_task_functions_travel_without_the_package(tmp_path):
    import subprocess
    import sys

    from pyspark import cloudpickle

    from qaspark.plans.bestk import BestK

    (tmp_path / "best").write_bytes(cloudpickle.dumps(BestK))
    code = "import pickle, sys; sys.path = [p for p in sys.path if 'repo' not in p]; pickle.load(open('best', 'rb'))(1, 2)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True)
