"""A join whose left side may have most of its rows under one key."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from qaspark.session import materialize

SHARES = 1000


def join_hot(rows: DataFrame, facts: DataFrame, key: str, shares: int = SHARES) -> DataFrame:
    """Left join of ``rows`` with ``facts``, which has one row per key.

    A key is hot when it has more than one in ``shares`` of the rows; so there are fewer than ``shares`` hot
    keys, and their facts are broadcast while the rows stay where they are. All others meet by shuffle,
    where no key has more than that share. Null keys find nothing.
    """
    counts = materialize(rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_rows")))
    total = counts.agg(F.coalesce(F.sum("_rows"), F.lit(0))).first()[0]
    hot = materialize(counts.filter(F.col("_rows") * shares > total).select(key))
    # stored, as both sides of the split read it
    known = materialize(facts.join(F.broadcast(hot.withColumn("_hot", F.lit(True))), key, "left"))
    lively = known.filter("_hot").drop("_hot")
    others = known.filter("_hot is null").drop("_hot")
    here = rows.join(F.broadcast(hot), key, "left_semi").join(F.broadcast(lively), key, "left")
    rest = rows.join(F.broadcast(hot), key, "left_anti")
    lone = rest.filter(F.col(key).isNull())
    met = rest.filter(F.col(key).isNotNull()).join(others, key, "left")
    nothing = [F.lit(None).cast(kind).alias(name) for name, kind in facts.dtypes if name != key]
    return here.unionByName(met).unionByName(lone.select("*", *nothing))
