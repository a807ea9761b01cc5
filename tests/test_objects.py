import json
import random

import pytest
from pyspark.sql import functions as F, types as T

from qaspark.sources import objects, readers, writers

RECORD = T.StructType([T.StructField("text", T.StringType()), T.StructField("n", T.LongType())])
PARTS = ["a", '"', "\\", "{", "}", "[", "]", ",", ":", "\n", " ", "본문", "\\\"", "}}", '","', "\\\\", "é"]


@pytest.fixture
def ranges(spark):
    """Splits as small as asked for."""
    names = "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"
    before = [spark.conf.get(n) for n in names]

    def use(size):
        for name in names:
            spark.conf.set(name, str(size))

    yield use
    for name, value in zip(names, before):
        spark.conf.set(name, value)


def told(seed, n, longest):
    rng = random.Random(seed)
    return {
        f"k{i}{rng.choice(PARTS)}": {"text": "".join(rng.choices(PARTS, k=rng.randrange(longest))), "n": i}
        for i in range(n)
    }


@pytest.mark.parametrize("size,indent,separator", [(300, None, "}"), (700, 2, ","), (400, 1, "]")])
def test_one_object_is_read_by_many_tasks(spark, ranges, tmp_path, size, indent, separator):
    want = told(size, 30, 120)
    path = tmp_path / "wiki.json"
    path.write_text(json.dumps(want, ensure_ascii=False, indent=indent), encoding="utf-8")
    ranges(size)
    assert spark.read.text(str(path), lineSep=separator).rdd.getNumPartitions() > 5
    got = objects.read_entries(spark, str(path), RECORD, separator).collect()
    assert len(got) == len(want)
    assert {r.key: r.value.asDict() for r in got} == want


def test_entries_longer_than_several_ranges_and_several_files(spark, ranges, tmp_path):
    one = {"a": {"text": '"{}\\' * 500, "n": 1}, "b": {"text": "", "n": 2}, "c": {"text": "x}" * 700, "n": 3}}
    two = {"d": {"text": None, "n": None}, "e": None}
    for name, value in (("1.json", one), ("2.json", two), ("3.json", {})):
        (tmp_path / name).write_text(json.dumps(value) + "\n")
    (tmp_path / "4.json").write_text("")
    ranges(400)
    got = objects.read_entries(spark, str(tmp_path), RECORD).collect()
    assert {r.key: r.value and r.value.asDict() for r in got} == {**one, **two}
    assert {r.file[-6:] for r in got} == {"1.json", "2.json"}


def test_plain_values_and_lists(spark, ranges, tmp_path):
    want = {str(i): "v,\"}" * (i % 5) for i in range(120)}
    (tmp_path / "plain.json").write_text(json.dumps(want))
    ranges(500)
    got = objects.read_entries(spark, str(tmp_path / "plain.json"), T.StringType(), ",")
    assert {r.key: r.value for r in got.collect()} == want
    lists = {str(i): [[i, {"a": "]"}], []] for i in range(50)}
    (tmp_path / "lists.json").write_text(json.dumps(lists))
    got = objects.read_entries(spark, str(tmp_path / "lists.json"), T.StringType(), "]")
    assert {r.key: json.loads(r.value) for r in got.collect()} == lists
    with pytest.raises(ValueError):
        objects.read_entries(spark, str(tmp_path), T.StringType(), '"')


def test_written_objects_come_back(spark, ranges, tmp_path, rows):
    given = spark.createDataFrame(
        [(i, "".join(random.Random(i).choices(PARTS, k=i))) for i in range(90)], "id long, text string"
    ).repartition(3, "id")
    path = str(tmp_path / "objects")
    writers.write_objects(given, path, "id", F.struct("text"))
    for file in (tmp_path / "objects").glob("part-*"):
        json.loads(file.read_text(encoding="utf-8"))
    ranges(1500)
    got = readers.read_corpus(spark, path).select(F.col("key").cast("long"), "text")
    assert rows(got, "key") == rows(given, "id")
    writers.write_objects(given.limit(0), str(tmp_path / "none"), "id", F.struct("text"))
    assert readers.read_corpus(spark, str(tmp_path / "none")).count() == 0
    with pytest.raises(Exception, match="without a key"):
        writers.write_objects(given.select(F.lit(None).alias("id"), "text"), str(tmp_path / "x"), "id", F.struct("text"))
