"""Top-k selection that prunes before the shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, Window as W


def topk_per(
    df: DataFrame, key: str | Sequence[str], order: Sequence[Column], k: int, rank: str = "rank"
) -> DataFrame:
    """Best ``k`` rows per key; ``row_number <= k`` lets Spark cut each map task's rows first."""
    keys = [key] if isinstance(key, str) else list(key)
    window = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= k)


def top_n(
    df: DataFrame, order: Sequence[Column], n: int, spread: Sequence[str], groups: int = 64
) -> DataFrame:
    """Global best ``n`` rows for a large ``n``: first within hashed groups, then over the winners.

    The last step sees at most ``groups * n`` rows however large the input is.
    """
    group = F.pmod(F.xxhash64(*spread), F.lit(groups))
    winners = topk_per(df.withColumn("_group", group), "_group", order, n, "_rank")
    return winners.drop("_group", "_rank").orderBy(*order).limit(n)
