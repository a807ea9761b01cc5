"""JSON objects of any size read entry by entry, several tasks to a file.

The text reader cuts a file into byte ranges at a separator. What a range means depends on what stands
before it: whether it begins inside a string, and how deep. A first pass sums up each range for both
cases; folding those sums, one small row per range, gives where each range really begins. The second
pass cuts entries at the commas of the outermost level. Only what crosses a border is put together by a
shuffle, at most two pieces per range.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F, types as T

from qaspark.plans.broadcasts import split_blocks, union_all
from qaspark.session import bound_batches, materialize, store

HEAD, MIDDLE, TAIL, WHOLE = range(4)

_STRING_REST = re.compile(r'[^"\\]*(?:\\.[^"\\]*)*', re.S)
_MARK = re.compile(r'["{}\[\],]')
_ESCAPED = re.compile(r"\\.", re.S)


def _depth(text: str) -> int:
    return text.count("{") + text.count("[") - text.count("}") - text.count("]")


class _Range:
    """Both readings of a range: [begun outside a string, begun inside one]."""

    def __init__(self) -> None:
        self.depth = [0, 0]
        self.inside = [False, True]

    def add(self, piece: str) -> None:
        parts = _ESCAPED.sub("", piece).split('"')
        # every other part is within a string
        change = _depth("".join(parts[0::2])), _depth("".join(parts[1::2]))
        odd = len(parts) % 2 == 0
        for case in (0, 1):
            self.depth[case] += change[self.inside[case]]
            self.inside[case] ^= odd


class _Cutter:
    """Cuts the pieces of one range, in order, into entries."""

    def __init__(self, inside: bool, depth: int) -> None:
        self.inside, self.depth = inside, depth
        self.held: list[str] = []
        self.kind = WHOLE if depth == 0 else HEAD

    def _close(self) -> tuple[int, str]:
        entry = self.kind, "".join(self.held)
        self.held, self.kind = [], WHOLE
        return entry

    def add(self, piece: str) -> Iterator[tuple[int, str]]:
        begin = at = 0
        while at < len(piece):
            if self.inside:
                at = _STRING_REST.match(piece, at).end()
                if at == len(piece):
                    break
                self.inside, at = False, at + 1
                continue
            mark = _MARK.search(piece, at)
            if mark is None:
                break
            at, one = mark.end(), mark.group()
            if one == '"':
                self.inside = True
            elif one in "{[":
                self.depth += 1
                if self.depth == 1:
                    begin = at
            elif one in "}]":
                self.depth -= 1
                if self.depth == 0:
                    self.held.append(piece[begin : at - 1])
                    yield self._close()
            elif self.depth == 1:
                self.held.append(piece[begin : at - 1])
                yield self._close()
                begin = at
        if self.depth >= 1:
            self.held.append(piece[begin:])

    def end(self) -> Iterator[tuple[int, str]]:
        if self.depth >= 1:
            yield (TAIL if self.kind == WHOLE else MIDDLE), "".join(self.held)


def _summaries(separator: str):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple[str, int], _Range] = {}
        for batch in batches:
            for file, block, value in zip(*(batch.column(i).to_pylist() for i in range(3))):
                known.setdefault((file, block), _Range()).add(value + separator)
        for (file, block), one in known.items():
            yield pa.RecordBatch.from_pydict(
                {
                    "file": [file],
                    "block": [block],
                    "odd": [one.inside[0]],
                    "depth_out": pa.array([one.depth[0]], pa.int64()),
                    "depth_in": pa.array([one.depth[1]], pa.int64()),
                }
            )

    return scan


def _beginnings(ranges: pd.DataFrame) -> pd.DataFrame:
    """Fold the ranges of one file, in order, into the state each of them begins in."""
    inside, depth, rows = False, 0, []
    for one in ranges.sort_values("block").itertuples():
        rows.append((one.file, one.block, inside, depth))
        depth += one.depth_in if inside else one.depth_out
        inside ^= bool(one.odd)
    return pd.DataFrame(rows, columns=["file", "block", "inside", "depth"])


def _cuts(separator: str):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, cutter = None, None
        for batch in batches:
            found: list[tuple[str, int, int, str]] = []
            for file, block, inside, depth, value in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if (file, block) != at:
                    if cutter:
                        found += [(*at, *entry) for entry in cutter.end()]
                    at, cutter = (file, block), _Cutter(inside, depth)
                found += [(*at, *entry) for entry in cutter.add(value + separator)]
            yield from _batch(found)
        if cutter:
            yield from _batch([(*at, *entry) for entry in cutter.end()])

    return scan


def _batch(found: list[tuple[str, int, int, str]]) -> Iterator[pa.RecordBatch]:
    if found:
        files, blocks, kinds, texts = zip(*found)
        arrays = pa.array(files), pa.array(blocks, pa.int64()), pa.array(kinds, pa.int32()), pa.array(texts)
        yield pa.RecordBatch.from_arrays(list(arrays), ["file", "block", "kind", "entry"])


def _entries(spark: SparkSession, path: str, separator: str) -> DataFrame:
    """(file, entry): the texts between the commas of the outermost level."""
    bound_batches(spark)
    pieces = spark.read.text(path, lineSep=separator).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        "value",
    )
    summed = pieces.mapInArrow(
        _summaries(separator), "file string, block long, odd boolean, depth_out long, depth_in long"
    )
    begun = materialize(
        summed.groupBy("file").applyInPandas(
            _beginnings, "file string, block long, inside boolean, depth long"
        )
    )
    # one row per range; beyond the broadcast limit in several passes, as the pieces must keep their order
    passes = [
        pieces.join(F.broadcast(part), ["file", "block"])
        .select("file", "block", "inside", "depth", "value")
        .mapInArrow(_cuts(separator), "file string, block long, kind int, entry string")
        for part in split_blocks(begun, "file")
    ]
    cut = store(union_all(passes), "entries")
    whole = cut.filter(F.col("kind") == WHOLE).select("file", "entry")
    crossing = cut.filter(F.col("kind") != WHOLE)
    # a tail begins an entry; what follows up to the next tail belongs to it
    before = W.partitionBy("file").orderBy("block", "kind")
    numbered = crossing.withColumn("entry_no", F.sum((F.col("kind") == TAIL).cast("int")).over(before))
    parts = F.sort_array(F.collect_list(F.struct("block", "kind", "entry")))
    joined = numbered.groupBy("file", "entry_no").agg(F.array_join(parts["entry"], "").alias("entry"))
    return whole.unionByName(joined.select("file", "entry"))


def read_entries(spark: SparkSession, path: str, value: T.DataType, separator: str = "}") -> DataFrame:
    """(file, key, value) of files that hold JSON objects, a row per entry, in no order.

    Files are split like text (``spark.sql.files.maxPartitionBytes``); an entry may be cut anywhere.
    ``separator`` is what ranges are cut at: a character that JSON never escapes and that is frequent,
    ``,`` for objects of plain values. It may occur inside texts. An object without entries gives no rows, an
    entry that is not JSON neither; a repeated key gives a row each time; a value that is JSON's null or not
    of the type is null.
    """
    if separator not in ("}", "]", ","):
        raise ValueError("the separator is one of } ] ,")
    entries = _entries(spark, path, separator).filter(F.trim(F.translate("entry", "\t\r\n", "   ")) != "")
    parsed = F.from_json(F.concat(F.lit("{"), "entry", F.lit("}")), T.MapType(T.StringType(), value))
    return entries.select("file", F.explode(parsed).alias("key", "value"))
