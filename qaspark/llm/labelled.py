"""Bounded samples of labelled documents, and a ridge logistic fit with a prior."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

SAMPLE_ROWS = 12_000
_SCALE = 1 << 20


def held_out(doc_id: str, modulus: int, remainder: int) -> Column:
    """True where crc32 of the id as text leaves that remainder; a null id is not held out."""
    digest = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    return F.coalesce(digest % modulus == remainder, F.lit(False))


def training_sample(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    modulus: int,
    remainder: int,
    doc_id: str = "doc_id",
    text: str = "text",
    rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """(text, y) of labelled documents that are not held out: all of them, or about ``rows``.

    Which ones is decided by a hash of the id. Only the ids are broadcast, about ``rows`` of them.
    """
    usable = labels.filter(
        F.col(label).isin(0, 1) & F.col(doc_id).isNotNull() & ~held_out(doc_id, modulus, remainder)
    ).select(F.col(doc_id).alias("id"), F.col(label).cast("double").alias("y"))
    known = usable.groupBy("id").agg(F.max("y").alias("y"))
    share = int(min(1.0, rows / max(known.count(), 1)) * _SCALE)
    chosen = known.filter(F.pmod(F.xxhash64("id"), F.lit(_SCALE)) < share)
    texts = docs.select(F.col(doc_id).alias("id"), F.coalesce(text, F.lit("")).alias("text"))
    return texts.join(F.broadcast(chosen), "id").select("text", "y")


def fit_logistic(x: np.ndarray, y: np.ndarray, prior: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights of a logistic model by Newton steps, drawn towards ``prior``; no rows give the prior."""
    w = prior.copy()
    for _ in range(25):
        p = sigmoid(x @ w)
        gradient = x.T @ (p - y) + ridge * (w - prior)
        hessian = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w -= step * min(1.0, 4 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-6:
            break
    return w


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))
