import hashlib
import json
import os

import pytest
from pyspark.sql import functions as F

from qaspark.checks import corpora
from qaspark.operators import decode
from qaspark.sources import readers, writers
from qaspark.sources.index_store import IndexStore, fingerprint

FOLDER = "/root/testdata/sf0.001"


def dump(path, value):
    path.write_text(json.dumps(value, ensure_ascii=False), encoding="utf-8")


def test_corpus_layouts(spark, tmp_path, rows):
    record = {"text": "본문\n둘", "title": "t", "corpus_source": "s", "url": None, "domain": None, "author": None}
    dump(tmp_path / "wiki.json", {"0": record, "1": {**record, "text": "b"}})
    got = readers.read_corpus(spark, str(tmp_path / "wiki.json"))
    assert rows(got.select("key", "text", "title"), "key") == [("0", "본문\n둘", "t"), ("1", "b", "t")]
    got.write.parquet(str(tmp_path / "parquet"))
    got.write.json(str(tmp_path / "lines"))
    for layout in ("parquet", "lines"):
        again = readers.read_corpus(spark, str(tmp_path / layout), layout)
        assert rows(again.select("key", "text"), "key") == rows(got.select("key", "text"), "key")
    with pytest.raises(ValueError):
        readers.read_corpus(spark, str(tmp_path), "other")


def test_long_documents_take_the_first_question(spark, tmp_path, rows):
    def doc(n):
        qa = {"id": str(n), "question": f"q{n}", "answer": {"text": "a", "answer_start": n}}
        return {"title": f"t{n}", "context": "<p>", "qas": [qa, {**qa, "id": "no"}], "url": "dropped"}

    dump(tmp_path / "x_00.json", {"version": "1", "data": [doc(1), doc(2)]})
    dump(tmp_path / "x_07.json", {"version": "1", "data": [doc(3)]})
    got = readers.read_longdoc_qa(spark, str(tmp_path / "x_*.json"))
    assert rows(got.select("file_no", "doc_no", "question_id", "answer_start"), "file_no", "doc_no") == [
        (0, 0, "1", 1), (0, 1, "2", 2), (7, 0, "3", 3),
    ]


def test_squad_takes_every_question_of_the_first_paragraph(spark, tmp_path, rows):
    def qa(n):
        return {"id": f"x_{n}-1", "question": "q", "answers": [{"text": "a", "answer_start": n}, {"text": "b", "answer_start": 0}]}

    dump(tmp_path / "s.json", {"data": [{"title": "t", "paragraphs": [{"context": "c", "qas": [qa(1), qa(2)]}, {"context": "d", "qas": [qa(3)]}]}]})
    got = readers.read_squad_qa(spark, str(tmp_path / "s.json"))
    assert rows(got.select("id", "context", "answer_text", "answer_start"), "id") == [("x_1-1", "c", "a", 1), ("x_2-1", "c", "a", 2)]


def test_qa_json(spark, tmp_path):
    row = {"id": "a", "question": "q", "context": "c", "answers": {"text": ["c"], "answer_start": [0]}, "title": "t", "document_id": 1}
    dump(tmp_path / "train.json", [row])
    got = readers.read_qa_json(spark, str(tmp_path / "train.json"), multi_line=True)
    writers.write_qa_json(got, str(tmp_path / "out"))
    back = readers.read_qa_json(spark, str(tmp_path / "out")).first()
    assert back["answers"]["text"] == ["c"] and back["document_id"] == 1


def test_split_folder_reads_only_its_partition(spark, tmp_path):
    path = str(tmp_path / "splits")
    spark.range(10).select("id", F.when(F.col("id") < 7, "train").otherwise("validation").alias("split")).write.partitionBy("split").parquet(path)
    got = readers.read_split(spark, path, "validation")
    assert got.count() == 3 and all("split=validation" in f for f in got.inputFiles() if "validation" in f)
    assert "PartitionFilters: [isnotnull(split" in got._jdf.queryExecution().toString()
    assert readers.read_split(spark, path).count() == 10


def test_shards_are_consecutive_slices(spark, tmp_path):
    df = spark.range(25).select((24 - F.col("id")).alias("k"))
    writers.write_shards(df, str(tmp_path / "shards"), 10, ["k"])
    back = spark.read.json(str(tmp_path / "shards")).groupBy("shard").agg(F.min("k"), F.max("k")).orderBy("shard")
    assert [tuple(r) for r in back.collect()] == [(0, 0, 9), (1, 10, 19), (2, 20, 24)]


def test_csv(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "b", c'), (2, "")], "k int, t string")
    writers.write_csv(df, str(tmp_path / "csv"))
    back = spark.read.csv(str(tmp_path / "csv"), header=True, schema="k int, t string", quote='"', escape='"')
    assert {(r["k"], r["t"] or "") for r in back.collect()} == {(1, 'a "b", c'), (2, "")}


def test_csv_keeps_raw_texts(spark, tmp_path):
    texts = ["one\ntwo", 'a "b\nc" d', '"', "\n", " blank ends ", "back\\slash", 'x\\"y', "a,b", "r\r\nn", "r\rr", "\ttab\n"]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
    writers.write_csv(df, str(tmp_path / "csv"))
    back = readers.read_csv(spark, str(tmp_path / "csv"), df.schema)
    assert sorted(map(tuple, back.collect())) == list(enumerate(texts))


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not there")
def test_csv_query_writes_whole_texts(spark):
    given = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    assert any("\n" in r.text for r in given)
    assert sorted(corpora.csv_texts(spark, FOLDER).collect()) == sorted(given)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not there")
def test_long_document_query_gives_whole_pages(spark):
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet").collect()
    got = {r.question_id: (r.title, r.question, r.answer_text, r.context_md5) for r in corpora.longdoc_scan(spark, FOLDER).collect()}
    assert got == {str(p.page_id): (p.url, p.url, p.url, hashlib.md5(p.html.encode()).hexdigest()) for p in pages}


def test_long_document_query_carries_the_conversations(spark, tmp_path):
    spark.createDataFrame([(1, "u1", "<p>"), (2, "u2", "<li>x")], "page_id long, url string, html string").write.parquet(
        f"{tmp_path}/pages.parquet"
    )
    turns = [(1, 1, "assistant", 'b "quoted"'), (1, 0, "user", "a"), (3, 0, "user", "no page")]
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.question_id: (r.question, r.n, r.n_asked, r.asked) for r in corpora.longdoc_scan(spark, str(tmp_path)).collect()}
    assert got == {"1": ("u1", 3, 2, 'a\nb "quoted"'), "2": ("u2", 5, 0, "")}


def test_nbest_weights_come_from_file_names(spark, tmp_path, rows):
    entry = {"text": "x", "start_logit": 1.0, "end_logit": 2.0, "probability": 0.5}
    dump(tmp_path / "70.json", {"q": [entry, {**entry, "text": "y"}]})
    dump(tmp_path / "65.2.json", {"r": [entry]})
    got = readers.read_nbest(spark, str(tmp_path))
    assert rows(got.select("model", "weight", "id", "rank", "text"), "id", "rank") == [
        ("70", 0.7, "q", 1, "x"), ("70", 0.7, "q", 2, "y"), ("65", 0.65, "r", 1, "x"),
    ]


def test_predictions_round_trip(spark, tmp_path, rows):
    features = spark.createDataFrame(
        [("q", 0, [None, (0, 2), (3, 5)], [0.0, 2.0, 1.0], [0.0, 1.0, 3.0])],
        "id string, chunk_no int, offsets array<struct<s:int,e:int>>, start_logits array<double>, end_logits array<double>",
    )
    examples = spark.createDataFrame([("q", "ab cd")], "id string, context string")
    decoded = decode.decode_spans(features, examples, allow_null=True)
    writers.write_predictions(decoded, str(tmp_path / "out"), "70")
    back = readers.read_nbest_lines(spark, str(tmp_path / "out" / "nbest_predictions_*"))
    want = decode.nbest_rows(decoded).select("id", "rank", "text", "probability")
    assert rows(back.select("id", "rank", "text", "probability"), "rank") == rows(want, "rank")
    assert {r["weight"] for r in back.collect()} == {0.7}
    assert spark.read.json(str(tmp_path / "out" / "predictions_70")).first()["prediction_text"] == "ab cd"
    assert spark.read.json(str(tmp_path / "out" / "null_odds_70")).first()["null_odds"] == -5.0


def test_index_store_builds_once_per_content(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string")
    store, built = IndexStore(spark, str(tmp_path / "store")), []

    def build():
        built.append(1)
        return {"docs": docs}

    mark = fingerprint(docs, "doc_id", "text", k1=1.5)
    assert mark == fingerprint(docs.repartition(2), "doc_id", "text", k1=1.5)
    for _ in range(2):
        assert store.get_or_build(mark, build)["docs"].count() == 2
    assert len(built) == 1
    other = fingerprint(docs.filter("doc_id = 1"), "doc_id", "text", k1=1.5)
    store.get_or_build(other, build)
    assert other != mark and len(built) == 2
