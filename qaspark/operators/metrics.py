"""Exact match and token F1 of predictions against one or more references."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from qaspark.functions.tokens import term_counts, tokenize

# fixed values of the public metric: what normalisation removes
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
ARTICLES = ["a", "an", "the"]

_WORD = "\\p{L}\\p{N}_"


def answer_tokens(text: Column) -> Column:
    """Lower-case tokens without punctuation and articles."""
    bare = F.translate(F.lower(text), PUNCTUATION, "")
    articles = f"(?<![{_WORD}])(?:{'|'.join(ARTICLES)})(?![{_WORD}])"
    return tokenize(F.regexp_replace(bare, articles, " "))


def _numbered(tokens: Column) -> Column:
    """Each occurrence of a token under its own name, so that sets behave as multisets."""
    return F.flatten(
        F.transform(
            term_counts(tokens),
            lambda t: F.transform(
                F.sequence(F.lit(1), t["tf"]), lambda i: F.concat_ws(":", i, t["term"])
            ),
        )
    )


def qa_scores(predictions: DataFrame, references: DataFrame) -> DataFrame:
    """(id, exact_match, f1) as 0..1, best over the references of each id.

    ``predictions`` is (id, prediction_text), ``references`` is (id, text) with a row per reference.
    An id without a prediction scores 0.
    """
    told = predictions.select("id", _numbered(answer_tokens(F.col("prediction_text"))).alias("_p"),
                              F.array_join(answer_tokens(F.col("prediction_text")), " ").alias("_ps"))
    wanted = references.select("id", _numbered(answer_tokens(F.col("text"))).alias("_r"),
                               F.array_join(answer_tokens(F.col("text")), " ").alias("_rs"))
    both = wanted.join(told, "id", "left").withColumn(
        "_same", F.size(F.array_intersect("_p", "_r"))
    )
    precision, recall = F.col("_same") / F.size("_p"), F.col("_same") / F.size("_r")
    f1 = F.when(F.col("_same") > 0, 2 * precision * recall / (precision + recall)).otherwise(0.0)
    exact = F.coalesce((F.col("_ps") == F.col("_rs")).cast("double"), F.lit(0.0))
    return both.groupBy("id").agg(F.max(exact).alias("exact_match"), F.max(f1).alias("f1"))


def qa_metrics(predictions: DataFrame, references: DataFrame) -> DataFrame:
    """One row: both scores averaged over the ids, times 100."""
    return qa_scores(predictions, references).agg(
        (F.avg("exact_match") * 100).alias("exact_match"), (F.avg("f1") * 100).alias("f1")
    )
