"""Two Bloom filters over a whole table: keys seen once, and keys seen again.

Every task fills its own pair; pairs are merged by shard, bit by bit: what two tasks have both seen once
has been seen twice. A repeated key is always in the second filter. The filters follow the input up to
``MAX_BITS``, so what is sent to the tasks is bounded; beyond it more keys pass that do not repeat.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

SHARD_BITS = 1 << 20
MAX_BITS = 1 << 29


class Bits:
    """A Bloom filter of two probes; the bits of a key come from its two halves."""

    def __init__(self, size: int, content: np.ndarray | None = None):
        self.mask = np.uint64(size - 1)
        self.content = np.zeros(size // 8, np.uint8) if content is None else content

    def _places(self, keys: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for half in (keys & self.mask, (keys >> np.uint64(32)) & self.mask):
            yield (half >> np.uint64(3)).astype(np.int64), np.uint8(1) << (half & np.uint64(7)).astype(np.uint8)

    def add(self, keys: np.ndarray) -> None:
        for at, bit in self._places(keys):
            np.bitwise_or.at(self.content, at, bit)

    def has(self, keys: np.ndarray) -> np.ndarray:
        found = np.ones(len(keys), bool)
        for at, bit in self._places(keys):
            found &= (self.content[at] & bit) != 0
        return found


def filter_bits(keys: int) -> int:
    """Bits of each filter for about so many keys: sixteen each, a power of two, within bounds."""
    return 1 << (min(max(16 * keys, SHARD_BITS), MAX_BITS) - 1).bit_length()


def seen_twice(
    rows: DataFrame, keys: Callable[[], Callable[[pa.RecordBatch], Iterator[np.ndarray]]], bits: int
) -> np.ndarray:
    """The merged second filter, ``bits / 8`` bytes; ``keys()`` reads the keys off a batch in a task."""
    shard_bytes = SHARD_BITS // 8

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read, once, twice = keys(), Bits(bits), Bits(bits)
        for batch in batches:
            for found in read(batch):
                found, counts = np.unique(found, return_counts=True)
                twice.add(found[(counts > 1) | once.has(found)])
                once.add(found)
        for shard in range(bits // SHARD_BITS):
            part = slice(shard * shard_bytes, (shard + 1) * shard_bytes)
            if once.content[part].any():
                packed = [zlib.compress(x.content[part].tobytes(), 1) for x in (once, twice)]
                yield pa.RecordBatch.from_pydict({"shard": [shard], "once": packed[:1], "twice": packed[1:]})

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                new = [np.frombuffer(zlib.decompress(row[n]), np.uint8) for n in ("once", "twice")]
                if row["shard"] not in found:
                    found[row["shard"]] = new[0].copy(), new[1].copy()
                    continue
                once, twice = found[row["shard"]]
                twice |= new[1]
                twice |= once & new[0]
                once |= new[0]
        for shard, (_, twice) in found.items():
            yield pa.RecordBatch.from_pydict({"shard": [shard], "twice": [zlib.compress(twice.tobytes(), 1)]})

    shards = (
        rows.mapInArrow(fill, "shard long, once binary, twice binary")
        .repartition(min(bits // SHARD_BITS, 256), "shard")
        .mapInArrow(merge, "shard long, twice binary")
    )
    whole = np.zeros(bits // 8, np.uint8)
    for row in shards.collect():  # bits / 8 bytes altogether
        part = np.frombuffer(zlib.decompress(row.twice), np.uint8)
        whole[row.shard * shard_bytes : (row.shard + 1) * shard_bytes] = part
    return whole
