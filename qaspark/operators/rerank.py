"""Scores of (question, candidate) pairs that were retrieved before."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window as W, functions as F

from qaspark.functions.vectors import dot, literal_vector, softmax_mean
from qaspark.plans.broadcasts import broadcast_if_small
from qaspark.session import materialize

_HELD_BYTES = 64 << 20  # partial sums a task holds before it hands them on


def score_bi(pairs: DataFrame, questions: DataFrame, candidates: DataFrame) -> DataFrame:
    """Two-tower score: dot product of the pooled vectors of (qid, cand_id) pairs."""
    q = materialize(questions.select("qid", F.col("embedding").alias("_q")))
    c = candidates.select("cand_id", F.col("embedding").alias("_c"))
    joined = pairs.join(c, "cand_id").join(broadcast_if_small(q), "qid")
    return joined.withColumn("score", dot(F.col("_q"), F.col("_c"))).drop("_q", "_c")


def score_linear(pairs: DataFrame, vector: str, weights: Sequence[float], bias: float = 0.0) -> DataFrame:
    """Joint-text score: a linear head on the pooled vector of each pair."""
    return pairs.withColumn("score", dot(F.col(vector), literal_vector(weights)) + F.lit(bias))


def attend_codes(tokens: DataFrame, codes: np.ndarray) -> DataFrame:
    """(qid, summaries): for every code, the softmax-attention mean of the question's tokens.

    ``tokens`` is (qid, embedding), in any number per question. Each task adds up weights and
    weighted vectors shifted by its own maximum; the partial sums are merged with the overall one,
    so no task needs to see a whole sequence.
    """
    n_codes, dim = codes.shape
    shared = tokens.sparkSession.sparkContext.broadcast(codes)

    def partial(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[object, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}

        def release() -> pd.DataFrame:
            rows = [
                (qid, code, top[code], total[code], moved[code])
                for qid, (top, total, moved) in held.items()
                for code in range(n_codes)
            ]
            held.clear()
            return pd.DataFrame(rows, columns=["qid", "code", "top", "total", "moved"])

        for frame in frames:
            for qid, group in frame.groupby("qid"):
                vectors = np.stack(group["embedding"].to_numpy()).astype(np.float64)
                scores = shared.value @ vectors.T
                top = scores.max(axis=1)
                weights = np.exp(scores - top[:, None])
                now = top, weights.sum(axis=1), weights @ vectors
                held[qid] = _merge(held[qid], now) if qid in held else now
            if len(held) * n_codes * dim * 8 > _HELD_BYTES:
                yield release()
        if held:
            yield release()

    kind = tokens.schema["qid"].dataType.simpleString()
    parts = tokens.select("qid", "embedding").mapInPandas(
        partial, f"qid {kind}, code int, top double, total double, moved array<double>"
    )
    shift = F.exp(F.col("top") - F.max("top").over(W.partitionBy("qid", "code")))
    parts = parts.select("qid", "code", "total", "moved", shift.alias("shift"))
    merged = parts.groupBy("qid", "code").agg(
        F.sum(F.col("total") * F.col("shift")).alias("total"),
        F.array(
            *[F.sum(F.get("moved", F.lit(i)) * F.col("shift")) for i in range(dim)]
        ).alias("moved"),
    )
    summary = F.transform("moved", lambda x: x / F.col("total"))
    ordered = F.sort_array(F.collect_list(F.struct("code", summary.alias("summary"))))
    return merged.groupBy("qid").agg(ordered.getField("summary").alias("summaries"))


def _merge(a, b):
    top = np.maximum(a[0], b[0])
    left, right = np.exp(a[0] - top), np.exp(b[0] - top)
    return top, a[1] * left + b[1] * right, a[2] * left[:, None] + b[2] * right[:, None]


def score_poly(
    pairs: DataFrame, tokens: DataFrame, candidates: DataFrame, codes: np.ndarray
) -> DataFrame:
    """Attention-code score of (qid, cand_id) pairs.

    The candidate attends over the question's code summaries; the dot product of that mean with the
    candidate equals the mean of the single dot products under the same weights.
    """
    summaries = materialize(attend_codes(tokens, codes))
    c = candidates.select("cand_id", F.col("embedding").alias("_c"))
    joined = pairs.join(c, "cand_id").join(broadcast_if_small(summaries), "qid")
    products = F.transform("summaries", lambda y: dot(y, F.col("_c")))
    scored = joined.withColumn("_products", products)
    return scored.withColumn("score", softmax_mean(F.col("_products"))).drop(
        "summaries", "_c", "_products"
    )
