"""Ranking and reader losses from scores that are already there."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from qaspark.functions.vectors import log_sum_exp


def inbatch_nll(scores: DataFrame, by: tuple[str, str] = ("batch", "row")) -> DataFrame:
    """(batch, loss): mean over the rows of ``ln(sum exp) - score of the own column``.

    ``scores`` is (batch, row, col, score); a batch is as large as the caller's batch size.
    """
    batch, row = by
    own = F.max(F.when(F.col(row) == F.col("col"), F.col("score")))
    tops = scores.groupBy(batch, row).agg(F.max("score").alias("top"), own.alias("own"))
    shifted = F.sum(F.exp(F.col("score") - F.col("top"))).alias("total")
    lines = scores.join(tops, [batch, row]).groupBy(batch, row, "top", "own").agg(shifted)
    return lines.groupBy(batch).agg(
        F.avg(F.col("top") + F.ln("total") - F.col("own")).alias("loss")
    )


def list_loss(scores: DataFrame, key: str = "qid") -> DataFrame:
    """(key, loss): ``-ln(e^s_gold / (sum e^s + 1e-9)) + 1e-9`` over a candidate list.

    ``scores`` is (key, label, score) with one label 1; computed shifted by the largest score.
    """
    tiny = 1e-9
    tops = scores.groupBy(key).agg(
        F.max("score").alias("top"),
        F.max(F.when(F.col("label") == 1, F.col("score"))).alias("gold"),
    )
    shifted = F.sum(F.exp(F.col("score") - F.col("top"))).alias("total")
    lines = scores.join(tops, key).groupBy(key, "top", "gold").agg(shifted)
    log_total = F.col("top") + F.ln(F.col("total") + F.lit(tiny) * F.exp(-F.col("top")))
    return lines.select(key, (log_total - F.col("gold") + tiny).alias("loss"))


def mean_list_loss(scores: DataFrame, key: str = "qid") -> DataFrame:
    """One row: the mean of ``list_loss`` over all lists."""
    return list_loss(scores, key).agg(F.avg("loss").alias("loss"))


def reader_loss(logits: DataFrame) -> DataFrame:
    """One row: mean cross-entropy of start and end, and their mean.

    ``logits`` is (start_logits, end_logits, start_pos, end_pos), one row per chunk.
    """

    def cross_entropy(side: str):
        values = F.col(f"{side}_logits")
        return log_sum_exp(values) - F.get(values, F.col(f"{side}_pos"))

    both = logits.select(cross_entropy("start").alias("s"), cross_entropy("end").alias("e"))
    return both.agg(F.avg("s").alias("start_loss"), F.avg("e").alias("end_loss")).withColumn(
        "loss", (F.col("start_loss") + F.col("end_loss")) / 2
    )
