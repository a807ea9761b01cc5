"""Descriptive statistics over lengths, counts and titles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, Window as W

from qaspark.plans.order import exact_quantiles, value_counts_by
from qaspark.plans.topk import top_n
from qaspark.session import materialize

QUARTILES = (0.25, 0.5, 0.75)


def as_metrics(df: DataFrame, metrics: Mapping[str, Column]) -> DataFrame:
    """Long form (metric, value) of several numeric columns, in one pass over ``df``."""
    entries = [
        F.struct(F.lit(name).alias("metric"), column.cast("double").alias("value"))
        for name, column in metrics.items()
    ]
    return df.select(F.explode(F.array(*entries)).alias("one")).select("one.*")


def _quartiles(df: DataFrame, counts: DataFrame, approximate: bool) -> DataFrame:
    if approximate:
        return df.groupBy("metric").agg(
            *[F.percentile_approx("value", f).alias(f"p{int(f * 100)}") for f in QUARTILES]
        )
    return (
        exact_quantiles(counts, "metric", "value", QUARTILES)
        .groupBy("metric")
        .agg(
            *[
                F.max(F.when(F.col("fraction") == f, F.col("quantile"))).alias(f"p{int(f * 100)}")
                for f in QUARTILES
            ]
        )
    )


def describe_num(
    df: DataFrame, metrics: Mapping[str, Column], approximate: bool = False
) -> DataFrame:
    """Count, mean, sample deviation, extremes and quartiles, one row per metric."""
    return describe_metrics(as_metrics(df, metrics), approximate)


def describe_metrics(long: DataFrame, approximate: bool = False) -> DataFrame:
    """``describe_num`` of (metric, value) rows, which may come from several tables."""
    long = long.filter("value is not null")
    basics = long.groupBy("metric").agg(
        F.count(F.lit(1)).alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    counts = value_counts_by(long, "metric", "value")
    return basics.join(F.broadcast(_quartiles(long, counts, approximate)), "metric")


def describe_str(df: DataFrame, text: str, key: str) -> DataFrame:
    """Count, number of distinct values, most frequent value (smallest key first) and its count.

    Counting goes by digest; only the winner's text is looked up.
    """
    groups = (
        df.filter(F.col(text).isNotNull())
        .groupBy(F.sha2(text, 256).alias("_digest"))
        .agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("first"))
    )
    summary = groups.agg(
        F.sum("n").alias("count"),
        F.count(F.lit(1)).alias("unique"),
        F.max("n").alias("freq"),
        F.min_by("first", F.struct(-F.col("n"), F.col("first"))).alias(key),
    )
    top = df.select(key, F.col(text).alias("top"))
    return top.join(F.broadcast(summary), key).select("count", "unique", "top", "freq")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return (
        df.groupBy(column)
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.col("count").desc(), column)
    )


def distinct_values(df: DataFrame, column: str, approximate: bool = False) -> DataFrame:
    """Number of distinct values."""
    if approximate:
        return df.agg(F.approx_count_distinct(column).alias("n_distinct"))
    return df.agg(F.count_distinct(column).alias("n_distinct"))


def histogram(df: DataFrame, metrics: Mapping[str, Column], width: float, bins: int) -> DataFrame:
    """Counts of ``i*width < x <= (i+1)*width`` for ``bins`` bins; empty bins stay.

    Bin -1 counts what lies at or below 0, bin ``bins`` what lies above the last, so that the counts
    add up to the values there are.
    """
    long = as_metrics(df, metrics)
    found = (
        long.filter(F.col("value").isNotNull())
        .withColumn("bin", (F.ceil(F.col("value") / width) - 1).cast("long"))
        .withColumn("bin", F.least(F.greatest("bin", F.lit(-1)), F.lit(bins)).cast("long"))
        .groupBy("metric", "bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    frame = df.sparkSession.range(-1, bins + 1).select(
        F.col("id").alias("bin"),
        F.explode(F.array(*[F.lit(name) for name in metrics])).alias("metric"),
    )
    return frame.join(found, ["metric", "bin"], "left").fillna(0, ["n"]).select("metric", "bin", "n")


def box_stats(df: DataFrame, metrics: Mapping[str, Column], whis: float = 2.5) -> DataFrame:
    """Quartiles, whiskers (last values within ``whis`` times the IQR) and number of outliers."""
    return box_metrics(as_metrics(df, metrics), whis)


def box_metrics(long: DataFrame, whis: float = 2.5) -> DataFrame:
    """``box_stats`` of (metric, value) rows. Values are counted once and the counts are kept."""
    counts = materialize(value_counts_by(long, "metric", "value"))
    quartiles = _quartiles(counts, counts, False)
    reach = (F.col("p75") - F.col("p25")) * whis
    inside = F.col("value").between(F.col("p25") - reach, F.col("p75") + reach)
    return (
        counts.join(F.broadcast(quartiles), "metric")
        .groupBy("metric", "p25", "p50", "p75")
        .agg(
            F.min(F.when(inside, F.col("value"))).alias("low_whisker"),
            F.max(F.when(inside, F.col("value"))).alias("high_whisker"),
            F.coalesce(F.sum(F.when(~inside, F.col("n"))), F.lit(0)).alias("outliers"),
        )
    )


def ratio_above(df: DataFrame, value: Column, threshold: float) -> DataFrame:
    above = (value > threshold).cast("int")
    return df.agg(
        F.coalesce(F.sum(above), F.lit(0)).alias("n_above"), F.avg(above).alias("share_above")
    )


def join_counts(
    left: DataFrame, right: DataFrame, on: str, suffixes: Sequence[str] = ("_train", "_wiki")
) -> DataFrame:
    """Inner join of two count tables, largest left count first."""
    a, b = (
        df.select(on, F.col("count").alias(f"count{suffix}"))
        for df, suffix in zip((left, right), suffixes)
    )
    return a.join(b, on).orderBy(F.col(f"count{suffixes[0]}").desc(), on)


def normalize_counts(
    counts: DataFrame, key: str, columns: Sequence[str], rows: int = 100
) -> DataFrame:
    """First ``rows`` rows by the first column, each count floor-divided by that frame's mean."""
    order = [F.col(columns[0]).desc(), F.col(key)]
    head = top_n(counts, order, rows, [key])
    whole = W.partitionBy(F.lit(1))  # the frame has at most ``rows`` rows
    return head.select(
        key, *[F.floor(F.col(c) / F.avg(c).over(whole)).alias(f"{c}_norm") for c in columns]
    )


def max_lengths(df: DataFrame, group: str, columns: Sequence[str]) -> DataFrame:
    return df.groupBy(group).agg(*[F.max(F.length(c)).alias(f"max_{c}") for c in columns])


def top_values(df: DataFrame, column: str, key: str, n: int) -> DataFrame:
    """Head of the table sorted by one column, largest first."""
    return top_n(df, [F.col(column).desc(), F.col(key)], n, [key])
