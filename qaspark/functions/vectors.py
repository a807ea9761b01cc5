"""Arithmetic on ``array<float|double>`` columns, in double precision."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from qaspark.functions.bind import let


def literal_vector(values: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def dot(left: Column, right: Column) -> Column:
    products = F.zip_with(left, right, lambda a, b: a.cast("double") * b.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def squared_l2(left: Column, right: Column) -> Column:
    gaps = F.zip_with(left, right, lambda a, b: a.cast("double") - b.cast("double"))
    return F.aggregate(gaps, F.lit(0.0), lambda total, x: total + x * x)


def log_sum_exp(values: Column) -> Column:
    """``ln(sum(exp(x)))``, shifted by the largest value."""
    return let(
        F.array_max(values),
        lambda top: top
        + F.ln(F.aggregate(values, F.lit(0.0), lambda total, x: total + F.exp(x - top))),
    )


def softmax_mean(values: Column) -> Column:
    """Mean of the values under their own softmax weights."""

    def weighted(top: Column) -> Column:
        return F.aggregate(
            values,
            F.struct(F.lit(0.0).alias("w"), F.lit(0.0).alias("wx")),
            lambda acc, x: F.struct(
                (acc["w"] + F.exp(x - top)).alias("w"), (acc["wx"] + F.exp(x - top) * x).alias("wx")
            ),
            lambda acc: acc["wx"] / acc["w"],
        )

    return let(F.array_max(values), weighted)


def hash_int(text: Column) -> Column:
    """First 60 bits of the md5 digest as a non-negative long."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")
