from pyspark.sql import functions as F

from qaspark.operators import answer


def test_questions_are_answered_from_what_was_retrieved(spark, rows):
    """A reader that points at the token named by the question, a retriever that is a table."""
    passages = spark.createDataFrame([(1, "red fox"), (2, "blue whale sings"), (3, "unused")], "doc_id long, text string")
    questions = spark.createDataFrame([("a", "whale"), ("b", "fox"), ("c", "none")], "qid string, question string")
    found = spark.createDataFrame(
        [("a", 1, 1), ("a", 2, 2), ("b", 1, 1)], "qid string, doc_id long, rank int"
    )

    def read(features):
        words = F.concat(F.array(F.lit(""), F.lit(""), F.lit("")), "tokens", F.array(F.lit("")))
        marks = F.transform(words, lambda w: F.when(w == F.col("question"), 5.0).otherwise(0.0))
        return features.withColumns({"start_logits": marks, "end_logits": marks})

    for max_len in (64, 6):  # whole contexts, and chunks of two tokens
        got = answer.answer_questions(
            questions, passages, lambda asked: found.join(asked.select("qid"), "qid"), read, max_len, 1, n_best=3
        )
        assert rows(got.select("qid", "context", "prediction_text"), "qid") == [
            ("a", "red fox blue whale sings", "whale"), ("b", "red fox", "fox"), ("c", "", "empty"),
        ]
        gold = spark.createDataFrame([("a", "the whale"), ("b", "red fox"), ("b", "dog")], "qid string, text string")
        scores = answer.score_answers(got, gold)
        assert rows(scores.select("qid", "exact_match", F.round("f1", 4)), "qid") == [
            ("a", 1.0, 1.0), ("b", 0.0, 0.6667), ("c", None, None),
        ]


def test_no_questions(spark):
    questions = spark.createDataFrame([], "qid string, question string")
    passages = spark.createDataFrame([(1, "red fox")], "doc_id long, text string")
    found = spark.createDataFrame([], "qid string, doc_id long, rank int")
    zeros = F.array_repeat(F.lit(0.0), F.size("offsets"))
    got = answer.answer_questions(
        questions, passages, lambda asked: found, lambda rows: rows.withColumns({"start_logits": zeros, "end_logits": zeros})
    )
    assert got.count() == 0 and "prediction_text" in got.columns
