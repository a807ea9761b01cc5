"""Row identity without numbering, and joins that stay even when one key holds most rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

HOT_SHARE = 2_000


def with_row_key(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(row, k1, k2): the columns as one struct, so that no name of theirs can clash, and 128 bits
    that stand for (id, text), nulls included.

    The bits come from the values alone, so a task that is run again gives the same ones; rows that
    agree in both are repeats of each other and get the same result.
    """
    identity = [F.col(doc_id).isNull(), doc_id, F.col(text).isNull(), text]
    return docs.select(
        F.struct("*").alias("row"),
        F.xxhash64(*identity).alias("k1"),
        F.xxhash64(F.lit("row"), *reversed(identity)).alias("k2"),
    )


def join_counted(
    rows: DataFrame, groups: DataFrame, keys: Sequence[str], size: str, total: int
) -> DataFrame:
    """Inner join of stored ``rows`` with ``groups``: one line per key with its number of rows.

    A key that holds at least ``total / HOT_SHARE`` of the rows is broadcast; by that condition there
    are at most ``HOT_SHARE`` such keys, whatever the data. All others are too small to weigh on the
    task that gets them.
    """
    least = max(total // HOT_SHARE, 1)
    hot = groups.filter(F.col(size) > least)
    rest = groups.filter(F.col(size) <= least)
    names = F.broadcast(hot.select(*keys))
    return rows.join(F.broadcast(hot), list(keys)).unionByName(
        rows.join(names, list(keys), "left_anti").join(rest, list(keys))
    )


def text_bytes(df: DataFrame, text: str) -> int:
    """Bytes of all texts. For choosing a number of parts only: results do not depend on it."""
    return int(df.agg(F.coalesce(F.sum(F.octet_length(F.col(text)).cast("long")), F.lit(0))).first()[0])
