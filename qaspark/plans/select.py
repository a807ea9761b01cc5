"""Selection instead of sorting: the value at which a count is reached, by counts of ranges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

WAYS = 4096


def cut_value(df: DataFrame, value: str, n: int, ways: int = WAYS) -> tuple[int, int] | None:
    """(cut, above): rows with ``value > cut`` are ``above`` < n, with ``value >= cut`` at least n.

    ``value`` holds whole numbers. None if there are fewer than ``n`` rows. Each round counts the rows of
    up to ``ways`` ranges, one partial aggregate whose result is that small, and goes on with the one
    range the cut is in; give it stored rows.
    """
    low, high, total = df.agg(F.min(value), F.max(value), F.count(value)).first()
    if total < n or n < 1:
        return None
    above = 0
    while True:
        width = max(-(-(high - low + 1) // ways), 1)
        inside = df.filter(F.col(value).between(low, high))
        part = F.expr(f"({value} - {low}L) div {width}L").alias("part")
        counts = {r.part: r.n for r in inside.groupBy(part).agg(F.count(F.lit(1)).alias("n")).collect()}
        for number in sorted(counts, reverse=True):
            if above + counts[number] >= n:
                break
            above += counts[number]
        low, high = low + number * width, min(high, low + (number + 1) * width - 1)
        if low == high or width == 1:
            return low, above


def largest(df: DataFrame, value: str, ties: Sequence[str], n: int) -> DataFrame:
    """The ``n`` rows with the largest ``value``, of equal ones the first by ``ties``; all if there are fewer.

    Only rows at the cut itself are ordered, and at most ``n`` of those are brought together.
    """
    found = cut_value(df, value, n)
    if found is None:
        return df if n > 0 else df.limit(0)
    cut, above = found
    at_cut = df.filter(F.col(value) == cut).orderBy(*ties).limit(n - above)
    return df.filter(F.col(value) > cut).unionByName(at_cut)
