"""Global order without a single-task sort: running positions, totals and exact quantiles.

All of them range-partition on a total order, keep that layout with a reliable checkpoint, and
combine per-partition totals (one row per partition) with positions inside each partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, Window as W

from qaspark.session import materialize

_POSITION_BITS = 33  # monotonically_increasing_id: partition number above, row position below


def _ranged(df: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    return materialize(df.repartitionByRange(*order).sortWithinPartitions(*order))


def _offsets(totals: DataFrame) -> DataFrame:
    """Exclusive running sum of per-partition totals; the input has one row per partition."""
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    return totals.select("_part", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_before"))


def row_index(df: DataFrame, order: Sequence[Column | str], name: str = "row_no") -> DataFrame:
    """Add the 0-based global position of each row under ``order``, which has to be a total order."""
    ordinal = F.col("_ordinal")
    placed = (
        _ranged(df, order)
        .withColumn("_ordinal", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright(ordinal, _POSITION_BITS))
        .withColumn("_at", ordinal.bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)))
    )
    offsets = _offsets(placed.groupBy("_part").agg((F.max("_at") + 1).alias("_total")))
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_before") + F.col("_at"))
        .drop("_ordinal", "_part", "_at", "_before")
    )


def running_total(
    df: DataFrame, order: Sequence[str], weight: str, name: str = "running"
) -> DataFrame:
    """Add the inclusive global running sum of ``weight`` under the total order ``order``."""
    placed = _ranged(df, order).withColumn("_part", F.spark_partition_id())
    offsets = _offsets(placed.groupBy("_part").agg(F.sum(weight).alias("_total")))
    inside = W.partitionBy("_part").orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    return (
        placed.withColumn("_inside", F.sum(weight).over(inside))
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_before") + F.col("_inside"))
        .drop("_part", "_inside", "_before")
    )


def value_counts_by(df: DataFrame, metric: str, value: str) -> DataFrame:
    """Distinct values with their multiplicity; repeated values shrink before any shuffle."""
    return (
        df.filter(F.col(value).isNotNull()).groupBy(metric, value).agg(F.count(F.lit(1)).alias("n"))
    )


def exact_quantiles(
    counts: DataFrame, metric: str, value: str, fractions: Sequence[float]
) -> DataFrame:
    """Linear-interpolated quantiles per metric from ``value_counts_by`` rows.

    Returns (metric, fraction, quantile). No task ever holds the values of a whole metric.
    """
    placed = running_total(counts.select(metric, value, "n"), [metric, value], "n", "_end")
    placed = placed.withColumn("_begin", F.col("_end") - F.col("n"))
    spans = placed.groupBy(metric).agg(F.min("_begin").alias("_base"), F.sum("n").alias("_size"))
    wanted = spans.select(
        metric, "_base", F.explode(F.array(*[F.lit(float(f)) for f in fractions])).alias("fraction"),
        "_size",
    ).withColumn("_rank", F.col("fraction") * (F.col("_size") - 1))
    wanted = wanted.select(
        metric,
        "fraction",
        (F.col("_rank") - F.floor("_rank")).alias("_share"),
        (F.col("_base") + F.floor("_rank")).alias("_low"),
        (F.col("_base") + F.ceil("_rank")).alias("_high"),
    )

    def covers(rank: str) -> Column:
        return (F.col("_begin") <= F.col(rank)) & (F.col(rank) < F.col("_end"))

    # one row per metric and fraction on the broadcast side
    hits = placed.join(F.broadcast(wanted), metric).filter(covers("_low") | covers("_high"))
    return (
        hits.groupBy(metric, "fraction")
        .agg(
            F.max("_share").alias("_share"),
            F.max(F.when(covers("_low"), F.col(value))).alias("_lo"),
            F.max(F.when(covers("_high"), F.col(value))).alias("_hi"),
        )
        .select(
            metric,
            "fraction",
            (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("_share")).alias("quantile"),
        )
    )
