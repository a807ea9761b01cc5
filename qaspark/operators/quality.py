"""Retrieval quality at k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def recall_at_k(
    hits: DataFrame, gold: DataFrame, ks: Sequence[int], equal: bool = False, key: str = "qid"
) -> DataFrame:
    """Share of questions whose gold text is in the joined best k texts: (k, n, n_hit, rate).

    ``hits`` is (key, rank, text) and holds at most ``max(ks)`` rows per question; ``gold`` is
    (key, gold). ``equal`` asks for identity of the joined text instead. Questions without hits count.
    """
    ordered = F.sort_array(F.collect_list(F.struct("rank", "text"))).getField("text")
    found = hits.groupBy(key).agg(ordered.alias("texts"))

    def correct(k: int):
        joined = F.array_join(F.slice("texts", 1, k), " ")
        return joined == F.col("gold") if equal else F.contains(joined, F.col("gold"))

    flags = gold.join(found, key, "left").select(
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(k).cast("long").alias("k"),
                        F.coalesce(correct(k), F.lit(False)).cast("long").alias("hit"),
                    )
                    for k in ks
                ]
            )
        ).alias("one")
    )
    return (
        flags.groupBy("one.k")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("one.hit").alias("n_hit"),
            F.avg("one.hit").alias("rate"),
        )
    )
