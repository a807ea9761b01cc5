"""Broadcast only what was measured, and split what is too large into blocks that are not."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

BLOCK_BYTES = 64 << 20
_ROW_OVERHEAD = 32


def _width(column: Column, kind: T.DataType) -> Column:
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(column), F.lit(0)).cast("long")
    if isinstance(kind, T.ArrayType):
        if isinstance(kind.elementType, (T.StringType, T.BinaryType, T.ArrayType)):
            return F.coalesce(
                F.aggregate(
                    column,
                    F.lit(_ROW_OVERHEAD).cast("long"),
                    lambda total, one: total + 8 + _width(one, kind.elementType),
                ),
                F.lit(0),
            )
        return F.greatest(F.size(column), F.lit(0)).cast("long") * 8
    return F.lit(8).cast("long")


def measured_bytes(df: DataFrame) -> int:
    """Size of the rows, added up by Spark (strings and arrays by content, 8 bytes otherwise)."""
    size = F.lit(_ROW_OVERHEAD).cast("long")
    for field in df.schema.fields:
        size = size + _width(F.col(field.name), field.dataType)
    return int(df.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0])


def broadcast_if_small(df: DataFrame, limit: int = BLOCK_BYTES) -> DataFrame:
    """Broadcast hint when the measured size allows it; otherwise Spark shuffles both sides.

    Measuring runs ``df`` once, so give it stored rows.
    """
    return F.broadcast(df) if measured_bytes(df) <= limit else df


def split_blocks(df: DataFrame, key: str, limit: int = BLOCK_BYTES, least: int = 1) -> list[DataFrame]:
    """Cut ``df`` by key hash into parts of about ``limit`` bytes, for one broadcast each, and ``least`` parts or more.

    Rows of one key stay together. The usual answer is one block.
    """
    size = measured_bytes(df)
    blocks = max(2 * size // limit + 1 if size > limit else 1, least)
    if blocks == 1:
        return [df]
    part = F.pmod(F.xxhash64(key), F.lit(blocks))
    return [df.filter(part == number) for number in range(blocks)]


def union_all(parts: list[DataFrame]) -> DataFrame:
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result
