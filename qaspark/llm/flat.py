"""Arrow text columns as flat byte arrays, and the array steps that several operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 512 << 10


def flat_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(UTF-8 bytes of all texts end to end, offsets of the texts); a null text is empty."""
    filled = pc.fill_null(pc.cast(texts, pa.large_string()), "")
    if not len(filled):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    filled = pa.concat_arrays([filled])
    _, places, data = filled.buffers()
    offsets = np.frombuffer(places, np.int64)[filled.offset : filled.offset + len(filled) + 1]
    content = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return content[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(texts: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[pa.Array]:
    """The texts in order, in slices of about ``limit`` bytes; a longer text is a slice of its own."""
    if not len(texts):
        return
    sizes = pc.fill_null(pc.binary_length(pc.cast(texts, pa.large_string())), 0)
    ends = np.cumsum(sizes.to_numpy(zero_copy_only=False))
    at = 0
    while at < len(texts):
        before = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield texts.slice(at, stop - at)
        at = stop


def powers(base: int, count: int) -> np.ndarray:
    """base ** 0 .. base ** (count - 1), modulo 2 ** 64."""
    out = np.empty(max(count, 1), np.uint64)
    out[0] = 1
    have = 1
    while have < count:
        step = min(have, count - have)
        out[have : have + step] = out[:step] * np.uint64(pow(base, have, 1 << 64))
        have += step
    return out[:count]


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the maximal runs of true values; an end is exclusive."""
    edges = np.flatnonzero(np.diff(np.concatenate(([False], mask, [False])).view(np.int8)))
    return edges[::2], edges[1::2]


def words_of(
    content: np.ndarray, offsets: np.ndarray, inside: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, text number) of each maximal run of bytes with ``inside[byte]``, per text."""
    mask = inside[content]
    size = len(content)
    if not size:
        none = np.empty(0, np.int64)
        return none, none, none
    fresh = np.zeros(size + 1, bool)
    fresh[offsets] = True
    first = mask.copy()
    first[1:] &= ~mask[:-1] | fresh[1:size]
    last = mask.copy()
    last[:-1] &= ~mask[1:] | fresh[1:size]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


class SpanHash:
    """64-bit polynomial hashes of byte spans, all spans of a block at once."""

    BASE = 0x9E3779B97F4A7C15
    INVERSE = pow(BASE, -1, 1 << 64)

    def __init__(self, fold: np.ndarray | None = None, seed: int = 11):
        values = np.random.default_rng(seed).integers(1, 1 << 63, 256, np.uint64)
        self.values = values if fold is None else values[fold]
        self.up = self.down = np.empty(0, np.uint64)

    def __call__(self, content: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        size = len(content)
        if size + 1 > len(self.up):
            self.up, self.down = powers(self.BASE, size + 1), powers(self.INVERSE, size + 1)
        sums = np.empty(size + 1, np.uint64)
        sums[0] = 0
        np.cumsum(self.values[content] * self.up[:size], out=sums[1:])
        mixed = (sums[ends] - sums[starts]) * self.down[starts]
        # the length keeps apart what would differ by nothing else, the shifts mix high bits down
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= (ends - starts).astype(np.uint64) * np.uint64(0x94D049BB133111EB)
        return mixed ^ (mixed >> np.uint64(32))


def fold_case() -> np.ndarray:
    """Byte table that lower-cases A-Z only."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """Byte table: true inside any of the (first, last) ranges."""
    table = np.zeros(256, bool)
    for first, last in ranges:
        table[first : last + 1] = True
    return table
