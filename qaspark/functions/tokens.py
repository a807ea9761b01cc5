"""Tokenisers, offsets, n-grams and term counts, all inside the row.

Working inside the row keeps a text's tokens where the scan put them: nothing is shuffled to count
the terms of a document or to find where a token starts.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F, types as T

from qaspark.functions.bind import let

# fixed values: the blanks that end a token, and the shipped tokeniser patterns
SPACES = " \\t\\n\\x0B\\f\\r"
SCHEMES = {
    "space": f"[^{SPACES}]+",
    "word": "[\\p{L}\\p{N}]+",
    "piece": f"[\\p{{L}}\\p{{N}}]+|[^{SPACES}\\p{{L}}\\p{{N}}]",
}

Scheme = str | Callable[[Column], Column]


def tokenize(text: Column, scheme: Scheme = "space", lower: bool = False) -> Column:
    """Array of tokens. A callable scheme may wrap a pandas UDF that returns ``array<string>``."""
    source = F.lower(text) if lower else text
    if callable(scheme):
        return scheme(source)
    if scheme not in SCHEMES:
        raise ValueError(f"unknown tokeniser scheme: {scheme}")
    if scheme == "space":
        return F.array_remove(F.split(source, f"[{SPACES}]+"), "")
    return F.regexp_extract_all(source, F.lit(SCHEMES[scheme]), F.lit(0))


_BLANK_BYTES = np.frombuffer(b" \t\n\x0b\f\r", np.uint8)


@F.arrow_udf(T.ArrayType(T.StructType([T.StructField("s", T.IntegerType()), T.StructField("e", T.IntegerType())])))
def _offsets(texts: pa.Array) -> pa.Array:
    edges, sizes = [np.empty(0, np.int64)], []
    for text in texts.to_pylist():
        raw = np.frombuffer((text or "").encode(), np.uint8)
        blank = np.isin(raw[(raw & 0xC0) != 0x80], _BLANK_BYTES)  # the first byte of each code point
        found = np.flatnonzero(np.diff(blank, prepend=True, append=True))
        edges.append(found)
        sizes.append(len(found) // 2)
    every = np.concatenate(edges)
    columns = [pa.array(every[at::2], pa.int32()) for at in (0, 1)]
    ends = pa.array(np.cumsum([0, *sizes]), pa.int32())
    return pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays(columns, ["s", "e"]))


def space_offsets(text: Column) -> Column:
    """``array<struct<s,e>>`` of the blank-separated tokens, in code points, end exclusive.

    A position is an edge when it and its left neighbour differ in being blank (outside the text
    counts as blank), so edges alternate between token starts and ends. Linear in the text length.
    """
    return _offsets(text)


def with_bigrams(tokens: Column) -> Column:
    """The tokens, then each pair of neighbours joined by a space."""

    def both(words: Column) -> Column:
        rest = F.greatest(F.size(words) - 1, F.lit(0))
        pairs = F.zip_with(
            F.slice(words, F.lit(1), rest),
            F.slice(words, F.lit(2), rest),
            lambda left, right: F.concat_ws(" ", left, right),
        )
        return F.concat(words, pairs)

    return let(tokens, both)


def term_counts(tokens: Column) -> Column:
    """``array<struct<term,tf>>`` of one token array: run lengths of its sorted tokens."""

    def starts(words: Column) -> Column:
        return F.filter(
            F.sequence(F.lit(0), F.size(words) - 1),
            lambda i: (i == 0) | (F.get(words, i) != F.get(words, i - 1)),
        )

    def runs(words: Column, begins: Column) -> Column:
        ends = F.concat(F.slice(begins, F.lit(2), F.size(begins)), F.array(F.size(words)))
        return F.zip_with(
            begins,
            ends,
            lambda s, e: F.struct(F.get(words, s).alias("term"), (e - s).alias("tf")),
        )

    return let(
        F.sort_array(tokens),
        lambda words: F.when(
            F.size(words) > 0, let(starts(words), lambda begins: runs(words, begins))
        ).otherwise(F.array().cast("array<struct<term:string,tf:int>>")),
    )
