"""Weighted vote over the n-best lists of several models."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from qaspark.plans.topk import topk_per

BONUS = 0.01
RANK_DIGITS = 12  # ranks are compared to this precision, so they do not depend on summation order
SCORE_DIGITS = 6  # of the output


def ensemble(
    nbest: DataFrame,
    weight_mode: str = "multiply",
    combine: str = "sum",
    bonus: float = BONUS,
    n: int = 1,
) -> DataFrame:
    """Best ``n`` texts per question: (id, rank, text, score), ties by text.

    ``nbest`` is (id, text, probability, weight). A text listed once keeps its value; one listed
    more often gets its combined value plus ``bonus`` per listing.
    """
    values = {
        "multiply": F.col("probability") * F.col("weight"),
        "add": F.col("probability") + F.col("weight"),
        "none": F.col("probability"),
    }
    combined = {
        "sum": F.col("total"),
        "mean": F.col("total") / F.col("listed"),
        "half_mean": F.col("total") / (2 * F.col("listed")),
    }
    if weight_mode not in values or combine not in combined:
        raise ValueError(f"unknown ensemble setting: {weight_mode}, {combine}")
    votes = nbest.groupBy("id", "text").agg(
        F.count(F.lit(1)).alias("listed"), F.sum(values[weight_mode]).alias("total")
    )
    several = combined[combine] + F.col("listed") * bonus
    score = F.round(F.when(F.col("listed") == 1, F.col("total")).otherwise(several), RANK_DIGITS)
    scored = votes.select("id", "text", score.alias("score"))
    best = topk_per(scored, "id", [F.col("score").desc(), F.col("text")], n)
    return best.withColumn("score", F.round("score", SCORE_DIGITS))
