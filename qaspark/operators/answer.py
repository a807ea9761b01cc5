"""The whole way from a question to a scored answer, with retriever and reader as callables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from qaspark.operators.chunks import MAX_LEN, OVERLAP, chunk, with_feature_offsets
from qaspark.operators.corpus import attach_text, concat_context
from qaspark.operators.decode import decode_spans
from qaspark.operators.metrics import qa_scores
from qaspark.session import store

Retriever = Callable[[DataFrame], DataFrame]
Reader = Callable[[DataFrame], DataFrame]


def answer_questions(
    questions: DataFrame,
    passages: DataFrame,
    retrieve: Retriever,
    read: Reader,
    max_len: int = MAX_LEN,
    overlap: int = OVERLAP,
    **decoding,
) -> DataFrame:
    """(qid, question, context, nbest, prediction_text[, null_odds]), one row per question.

    ``questions`` is (qid, question), ``passages`` is (doc_id, text). ``retrieve`` gives (qid, doc_id, rank)
    for the questions, cut to the passages wanted; ``read`` adds ``start_logits`` and ``end_logits`` to
    features (id, chunk_no, question, tokens, offsets, q_len, …). ``decoding`` goes to ``decode_spans``.
    A question without passages has an empty context and answers ``empty``.

    Contexts are stored once, as features and texts both come from them, spread by question: reading is the
    heavy part, and few questions would end up in one task.
    """
    hits = attach_text(retrieve(questions), passages)
    joined = concat_context(hits.select("qid", "rank", "text"), questions.select("qid", "question"))
    tasks = int(passages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    asked = store(joined.repartition(tasks, "qid"), "contexts")
    rows = asked.withColumnRenamed("qid", "id")
    features = with_feature_offsets(chunk(rows, max_len, overlap))
    decoded = decode_spans(read(features), rows.select("id", "context"), **decoding)
    return asked.join(decoded.withColumnRenamed("id", "qid"), "qid")


def score_answers(answers: DataFrame, references: DataFrame) -> DataFrame:
    """(qid, prediction_text, exact_match, f1) against (qid, text), a row per reference.

    A question without references has null scores.
    """
    told = answers.select(F.col("qid").alias("id"), "prediction_text")
    wanted = references.select(F.col("qid").alias("id"), "text")
    scores = qa_scores(told, wanted).withColumnRenamed("id", "qid")
    return answers.select("qid", "prediction_text").join(scores, "qid", "left")
