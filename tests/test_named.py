import json
import os

import pytest
from pyspark.sql import functions as F

from qaspark.operators import decode
from qaspark.sources import named, readers, writers


def _files(path):
    return {one: open(os.path.join(path, one), encoding="utf-8").read() for one in sorted(os.listdir(path))}


def test_files_have_the_names_and_the_order_asked_for(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.range(25).select((24 - F.col("id")).alias("k"), F.lit("a \"b").alias("t")).repartition(5)
    writers.write_shard_files(df, path, 10, ["k"], "part")
    got = _files(path)
    assert list(got) == ["part-1.json", "part-2.json", "part.json"]
    back = {name: [json.loads(one) for one in text.split("\n") if one] for name, text in got.items()}
    assert [r["k"] for r in back["part.json"]] == list(range(10))
    assert [r["k"] for r in back["part-1.json"]] == list(range(10, 20))
    assert [r["k"] for r in back["part-2.json"]] == list(range(20, 25))
    assert {r["t"] for rows in back.values() for r in rows} == {'a "b'}


def test_frames(spark, tmp_path):
    df = spark.createDataFrame([("x", 1), ("y", 2), ("x", 3)], "f string, n int")
    for frame, want in (("lines", "1\n3\n"), ("array", "[1,\n3]"), ("object", "{1,\n3}")):
        path = f"file:{tmp_path}/{frame}"
        named.write_named(df, path, F.concat("f", F.lit(".txt")), F.col("n").cast("string"), ["n"], frame)
        assert _files(f"{tmp_path}/{frame}")["x.txt"] == want
    with pytest.raises(ValueError):
        named.write_named(df, str(tmp_path / "no"), F.col("f"), F.col("f"), frame="xml")


def test_nothing_is_seen_of_a_job_that_fails(spark, tmp_path):
    path = str(tmp_path / "out")
    entry = F.when(F.col("id") == 37, F.raise_error(F.lit("broken")).cast("string")).otherwise(F.col("id").cast("string"))
    with pytest.raises(Exception, match="broken"):
        named.write_named(spark.range(40), path, F.concat(F.lit("f"), F.col("id") % 4), entry, ["id"])
    assert not os.path.isdir(path) or os.listdir(path) == []
    # the same folder can be used afterwards, once
    named.write_named(spark.range(40), path, F.concat(F.lit("f"), F.col("id") % 4), F.col("id").cast("string"), ["id"])
    assert list(_files(path)) == ["f0", "f1", "f2", "f3"]
    assert _files(path)["f3"].split() == [str(n) for n in range(3, 40, 4)]
    with pytest.raises(FileExistsError):
        named.write_named(spark.range(4), path, F.lit("g"), F.col("id").cast("string"))


@pytest.mark.parametrize("name", ["a/b", "", ".hidden", "_pending", "..", None])
def test_names_that_are_refused(spark, tmp_path, name):
    path = str(tmp_path / "out")
    with pytest.raises(Exception, match="not the name of a file"):
        named.write_named(spark.range(3), path, F.lit(name).cast("string"), F.lit("x"))
    assert not os.path.isdir(path) or os.listdir(path) == []


def test_null_entries_are_refused_and_no_rows_give_no_files(spark, tmp_path):
    with pytest.raises(Exception, match="an entry is null"):
        named.write_named(spark.range(3), str(tmp_path / "a"), F.lit("f"), F.lit(None).cast("string"))
    named.write_named(spark.range(0), str(tmp_path / "b"), F.lit("f"), F.lit("x"))
    assert not os.path.isdir(tmp_path / "b") or os.listdir(tmp_path / "b") == []


def test_a_second_attempt_counts_alone(tmp_path):
    import pyarrow as pa

    writer = named._Writer(str(tmp_path), "lines")
    batch = pa.RecordBatch.from_pydict({"file": ["a", "a", "b"], "entry": ["1", "2", "3"]})
    writer.write(iter([batch.slice(0, 1)]))  # an attempt that was lost
    message = writer.write(iter([batch]))
    writer.commit([message, None])
    assert _files(str(tmp_path)) == {"a": "1\n2\n", "b": "3\n"}
    with pytest.raises(ValueError, match="stand together"):
        named._Writer(str(tmp_path), "lines").write(iter([batch, batch]))


def test_nbest_files_round_trip(spark, tmp_path, rows):
    features = spark.createDataFrame(
        [(q, 0, [None, (0, 2), (3, 5)], [0.0, 2.0, 1.0], [0.0, 1.0, 3.0]) for q in ("p", 'q"{', "r")],
        "id string, chunk_no int, offsets array<struct<s:int,e:int>>, start_logits array<double>, end_logits array<double>",
    )
    examples = spark.createDataFrame([("p", "ab cd"), ('q"{', '}" }{'), ("r", None)], "id string, context string")
    decoded = decode.decode_spans(features, examples).filter("nbest is not null")
    writers.write_nbest_files(decoded, str(tmp_path / "out"), "70", rows=2)
    assert list(_files(tmp_path / "out"))[-1] == "70.json"
    for text in _files(tmp_path / "out").values():
        json.loads(text)
    back = readers.read_nbest(spark, str(tmp_path / "out"))
    want = decode.nbest_rows(decoded).select("id", "rank", "text", "probability")
    assert rows(back.select("id", "rank", "text", "probability"), "id", "rank") == rows(want, "id", "rank")
    assert {r["weight"] for r in back.collect()} == {0.7}
