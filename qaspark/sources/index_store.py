"""Build an index once, keep it as Parquet tables, and load it while its inputs stay the same."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

_MARK = "_index"


def fingerprint(df: DataFrame, key: str, text: str, **settings: object) -> str:
    """Digest of the content and the settings an index depends on; independent of row order."""
    per_row = F.xxhash64(key, text)
    rows, mixed = df.agg(
        F.count(F.lit(1)), F.sum(per_row.cast("decimal(20,0)")).cast("string")
    ).first()
    content = json.dumps([rows, mixed, sorted(settings.items())], default=str)
    return hashlib.md5(content.encode()).hexdigest()


class IndexStore:
    """Named tables below ``path``; the marker is written last, so half-built tables do not count."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _load(self, mark: str) -> dict[str, DataFrame] | None:
        # a folder per fingerprint: nothing is overwritten, and a stale index cannot be picked up
        folder = f"{self.path}/{mark}"
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{_MARK}/_SUCCESS")
        files = hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(hadoop):
            return None
        names = [row.name for row in self.spark.read.json(f"{folder}/{_MARK}").collect()]
        return {name: self.spark.read.parquet(f"{folder}/{name}") for name in names}

    def get_or_build(
        self, mark: str, build: Callable[[], Mapping[str, DataFrame]]
    ) -> dict[str, DataFrame]:
        stored = self._load(mark)
        if stored is not None:
            return stored
        folder = f"{self.path}/{mark}"
        tables = build()
        for name, table in tables.items():
            table.write.mode("overwrite").parquet(f"{folder}/{name}")
        names = self.spark.createDataFrame([(name,) for name in tables], "name string")
        names.write.mode("overwrite").json(f"{folder}/{_MARK}")
        loaded = self._load(mark)
        assert loaded is not None
        return loaded
