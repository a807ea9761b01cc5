"""From raw documents to token ids, in five stages. Each stage's rows are stored and read again.

Every stage takes rows as they come: null and empty texts, texts of any length, repeated rows, null ids,
no rows at all, further columns (they are kept, whatever they are called). What a stage makes of odd
rows stands with it. ``n_chars`` follows a changed text where the column is there.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from qaspark.llm import bpe, decontaminate, lines, simhash, toxicity
from qaspark.session import store

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
BATCH_BYTES = 4 << 20


def _bounded(spark: SparkSession) -> None:
    """Arrow batches end by bytes, not by rows: texts here differ in length by a factor of thousands."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def _counted(docs: DataFrame) -> DataFrame:
    """The length column follows a text that was changed; a null text leaves it as it is."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity grammar rejects go.

    A null or empty text scores as one without insults and stays; repeats of a row share its score.
    """
    _bounded(spark)
    return toxicity.reject(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in many documents stay in the one with the smallest id only.

    So a text with any number of copies leaves once. Repeats of that row (equal id and text) keep the line
    as well; a null text stays null, an empty one empty; a text may become empty, its document stays.
    """
    _bounded(spark)
    return _counted(lines.drop_lines(docs, keep="first"))


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays.

    Null and empty texts have one fingerprint and are one group; so are repeated rows, of which one stays.
    """
    _bounded(spark)
    return simhash.keep_one(docs)


def cut_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words that occur in benchmark items go; documents that mostly consist of them go whole.

    Null and texts without words stay as they are; repeated rows fare alike.
    """
    _bounded(spark)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _counted(decontaminate.remove_spans(docs, items))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, with the text that decoding them gives back; columns ``ids`` and ``n_tokens`` are set.

    A null or empty text has no ids and an empty text; repeated rows stay repeated.
    """
    _bounded(spark)
    ranks = bpe.read_ranks(RANKS)
    rows = docs.select(F.struct("*").alias("row"), F.col("text").alias("text"))
    coded = bpe.encode_and_decode(rows, ranks, public_tokenizers.PATTERN)
    made = {
        "text": F.col("coded.decoded").cast("string"),
        "n_tokens": F.size("coded.ids").cast("long"),
        "ids": F.col("coded.ids"),
    }
    row = F.col("row")
    for name, value in made.items():
        row = row.withField(name, value)
    return coded.select(row.alias("row")).select("row.*")


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("simhash_near_dedup", keep_one_of_near_copies),
    ("benchmark_decontamination", cut_benchmark_passages),
    ("byte_bpe", encode),
]

# token ids, fingerprints and a fitted model have no SQL form; tests compare with plain Python
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), name)
    return docs
