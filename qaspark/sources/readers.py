"""Scans: files of the supported layouts to typed rows, with explicit schemas throughout."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from qaspark.sources.objects import read_entries
from qaspark.sources.schemas import LONGDOC, NBEST_ENTRY, PASSAGE, QA, SQUAD


SMALL_INPUT = 1 << 30
SPREAD_BYTES = 4 << 20  # stored bytes of a small table that one task gets


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Size of the files below ``path``, from the file system's own records."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(place).getLength()


def read_table(spark: SparkSession, path: str, spread_by: Sequence[str] = ()) -> DataFrame:
    """A Parquet table. ``spread_by`` is for heavy per-row work on few files.

    A file is split by row group at best, so a small table may arrive in a single task. Such a
    table is spread by its key over the cores, or over more tasks when it has more than ``SPREAD_BYTES`` for
    each of them, so that what a task holds does not grow with the table; a table above ``SMALL_INPUT`` has splits enough
    and is read as it lies.
    """
    rows = spark.read.parquet(path)
    stored = stored_bytes(spark, path) if spread_by else 0
    if not spread_by or stored > SMALL_INPUT:
        return rows
    return rows.repartition(max(spark.sparkContext.defaultParallelism, -(-stored // SPREAD_BYTES)), *spread_by)


def read_corpus(
    spark: SparkSession, path: str, layout: str = "map", record: T.StructType = PASSAGE
) -> DataFrame:
    """Passages as (key, record fields).

    ``map`` reads JSON objects keyed by id, however large (``objects.read_entries``); ``lines`` and
    ``parquet`` take one pass instead of two.
    """
    if layout == "map":
        return read_entries(spark, path, record).select("key", "value.*")
    keyed = T.StructType([T.StructField("key", T.StringType()), *record.fields])
    if layout == "lines":
        return spark.read.schema(keyed).json(path)
    if layout == "parquet":
        return spark.read.parquet(path)
    raise ValueError(f"unknown corpus layout: {layout}")


def read_split(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """A dataset folder partitioned by ``split``; other splits' files are not opened."""
    rows = spark.read.parquet(path)
    return rows if split is None else rows.filter(F.col("split") == split)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """CSV as ``write_csv`` leaves it; a value may hold line breaks and quotes over several lines."""
    return spark.read.csv(
        path, header=True, schema=schema, quote='"', escape='"', multiLine=True, lineSep="\n"
    )


def read_qa_json(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Flat QA rows; ``multi_line`` for files that hold one JSON array."""
    return spark.read.schema(QA).json(path, multiLine=multi_line)


def _file_number(pattern: str) -> Column:
    return F.regexp_extract(F.col("_metadata.file_path"), pattern, 1).cast("int")


def read_longdoc_qa(
    spark: SparkSession, path: str, number_pattern: str = r"_(\d+)\.json$"
) -> DataFrame:
    """First question of each document of numbered nested files; ``doc_no`` is its place there.

    ``others`` has the texts of the document's further questions, in the file's order.
    """
    files = spark.read.schema(LONGDOC).json(path, multiLine=True)
    documents = files.select(
        _file_number(number_pattern).alias("file_no"), F.posexplode("data").alias("doc_no", "doc")
    )
    first = F.get("doc.qas", F.lit(0))
    return documents.select(
        "file_no",
        "doc_no",
        F.col("doc.title").alias("title"),
        F.col("doc.context").alias("context"),
        first["id"].alias("question_id"),
        first["question"].alias("question"),
        first["answer"]["text"].alias("answer_text"),
        first["answer"]["answer_start"].alias("answer_start"),
        F.slice("doc.qas.question", F.lit(2), F.greatest(F.size("doc.qas") - 1, F.lit(0))).alias("others"),
    )


def read_squad_qa(spark: SparkSession, path: str) -> DataFrame:
    """Every question of each document's first paragraph, with its first answer."""
    files = spark.read.schema(SQUAD).json(path, multiLine=True)
    documents = files.select(F.explode("data").alias("doc"))
    paragraph = F.get("doc.paragraphs", F.lit(0))
    asked = documents.select(
        F.col("doc.title").alias("title"),
        paragraph["context"].alias("context"),
        F.explode(paragraph["qas"]).alias("qa"),
    )
    answer = F.get("qa.answers", F.lit(0))
    return asked.select(
        F.col("qa.id").alias("id"),
        "title",
        "context",
        F.col("qa.question").alias("question"),
        answer["text"].alias("answer_text"),
        answer["answer_start"].alias("answer_start"),
    )


def _nbest_rows(entries: DataFrame, pattern: str) -> DataFrame:
    weight = F.regexp_extract("file", pattern, 1).cast("int")
    return entries.select(
        weight.cast("string").alias("model"),
        (weight / 100).alias("weight"),
        "id",
        F.posexplode("nbest").alias("_at", "entry"),
    ).select("model", "weight", "id", (F.col("_at") + 1).alias("rank"), "entry.*")


def read_nbest(spark: SparkSession, path: str, pattern: str = r"(\d+)[^/]*\.json$") -> DataFrame:
    """n-best files that map question id to candidates; ``70.json`` stands for a weight of 0.70."""
    entries = read_entries(spark, path, T.ArrayType(NBEST_ENTRY))
    named = entries.select("file", F.col("key").alias("id"), F.col("value").alias("nbest"))
    return _nbest_rows(named, pattern)


def read_nbest_lines(
    spark: SparkSession, path: str, pattern: str = r"/nbest_predictions_(\d+)/"
) -> DataFrame:
    """n-best folders as ``write_predictions`` leaves them: one line per question, splittable."""
    schema = T.StructType(
        [T.StructField("id", T.StringType()), T.StructField("nbest", T.ArrayType(NBEST_ENTRY))]
    )
    lines = spark.read.schema(schema).json(path).withColumn("file", F.col("_metadata.file_path"))
    return _nbest_rows(lines, pattern)
