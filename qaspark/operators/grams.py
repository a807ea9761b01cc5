"""Vocabulary of the most frequent words and pairs of neighbours, without counting every pair by name.

Most pairs of a corpus are rare, and naming them all moves several times the corpus. So words are counted first.
The n-th largest count of a word is a floor: a pair below it is not among the n most frequent terms. Pairs
are then counted in ``BUCKETS`` by hash; as a pair never occurs more often than its bucket, only those of buckets
that reach the floor are counted by name. What is found is exact. A corpus with fewer than n words has
no floor, and all its pairs are counted.

Texts are kept as words joined by a space, which no word of a named scheme holds.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from qaspark.functions.tokens import Scheme, tokenize
from qaspark.plans.select import cut_value, largest
from qaspark.session import store

BUCKETS = 1 << 20
BLOCK = 1 << 14  # buckets that travel in one row
_MIX = np.uint64(0x9E3779B97F4A7C15)
_COUNTS = "term string, cf long, df long"


def joined_words(corpus: DataFrame, doc_id: str, text: str, scheme: Scheme, lower: bool) -> DataFrame:
    """(doc_id, words): the words of a text, joined by a space."""
    words = F.array_join(tokenize(F.col(text), scheme, lower), " ")
    return corpus.select(F.col(doc_id).alias("doc_id"), words.alias("words"))


class _Words:
    """The words of a batch: ``names`` without repeats, ``codes`` and ``rows`` of every word in order."""

    def __init__(self, batch: pa.RecordBatch):
        lists = pc.split_pattern(pc.fill_null(batch.column("words"), ""), " ")
        words = lists.flatten()
        rows = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy())
        there = pc.not_equal(words, "").to_numpy(zero_copy_only=False)  # an empty text splits into one empty word
        coded = words.filter(pa.array(there)).dictionary_encode()
        self.names, self.codes, self.rows = coded.dictionary, coded.indices.to_numpy().astype(np.int64), rows[there]

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Codes of both words, and the row, of all neighbours."""
        first = np.flatnonzero(self.rows[1:] == self.rows[:-1])
        return self.codes[first], self.codes[first + 1], self.rows[first]

    def buckets(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        hashed = pd.util.hash_array(np.array(self.names.to_pylist(), object), categorize=False)
        mixed = (hashed[left] * _MIX ^ hashed[right]) * _MIX
        return (mixed >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)


def _statistics(rows: np.ndarray, codes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code, occurrences, rows with it) of codes below ``size``."""
    own, counts = np.unique(rows * size + codes, return_counts=True)
    each, place = np.unique(own % max(size, 1), return_inverse=True)
    return each, np.bincount(place, counts, len(each)).astype(np.int64), np.bincount(place, minlength=len(each))


def _counts_batch(names: pa.Array, cf: np.ndarray, df: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([names, pa.array(cf), pa.array(df)], ["term", "cf", "df"])


def _summed(counts: DataFrame) -> DataFrame:
    return counts.groupBy("term").agg(F.sum("cf").alias("cf"), F.sum("df").alias("df"))


def word_statistics(joined: DataFrame) -> DataFrame:
    """(term, cf, df) of all words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = _Words(batch)
            each, cf, df = _statistics(words.rows, words.codes, len(words.names))
            yield _counts_batch(words.names.take(pa.array(each)), cf, df)

    return _summed(joined.select("words").mapInArrow(run, _COUNTS))


def _full_buckets(joined: DataFrame, floor: int) -> np.ndarray:
    """Whether each bucket of pairs has ``floor`` of them; the driver gets a bit per bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            words = _Words(batch)
            left, right, _ = words.pairs()
            if len(left):
                total += np.bincount(words.buckets(left, right), minlength=BUCKETS)
        kind = np.uint32 if total.max() < 1 << 32 else np.int64
        for block, own in enumerate(total.reshape(-1, BLOCK)):
            if own.any():
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([own.astype(kind).tobytes()])], ["block", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}  # as many as all buckets at most
        for batch in batches:
            for block, counts in zip(batch.column("block").to_pylist(), batch.column("counts").to_pylist()):
                own = np.frombuffer(counts, np.uint32 if len(counts) == 4 * BLOCK else np.int64)
                totals[block] = totals.get(block, 0) + own.astype(np.int64)
        bits = [np.packbits(total >= floor).tobytes() for total in totals.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(totals), pa.int32()), pa.array(bits, pa.binary())], ["block", "bits"])

    parts = joined.select("words").mapInArrow(count, "block int, counts binary")
    full = np.zeros((BUCKETS // BLOCK, BLOCK), bool)
    for row in parts.repartition("block").mapInArrow(add, "block int, bits binary").collect():
        full[row.block] = np.unpackbits(np.frombuffer(row.bits, np.uint8)).astype(bool)
    return full.ravel()


def pair_statistics(joined: DataFrame, floor: int) -> DataFrame:
    """(term, cf, df) of pairs of neighbours, among them all that occur ``floor`` times."""
    full = _full_buckets(joined, floor) if floor > 1 else None
    shared = joined.sparkSession.sparkContext.broadcast(full)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        full = shared.value
        for batch in batches:
            words = _Words(batch)
            left, right, rows = words.pairs()
            if full is not None and len(left):
                some = full[words.buckets(left, right)]
                left, right, rows = left[some], right[some], rows[some]
            size = len(words.names)
            pairs, codes = np.unique(left * size + right, return_inverse=True)
            each, cf, df = _statistics(rows, codes, len(pairs))
            first, second = (words.names.take(pa.array(x)) for x in np.divmod(pairs[each], max(size, 1)))
            yield _counts_batch(pc.binary_join_element_wise(first, second, " "), cf, df)

    return _summed(joined.select("words").mapInArrow(run, _COUNTS))


def most_frequent(joined: DataFrame, bigrams: bool, n: int) -> DataFrame:
    """(term, cf, df) of the ``n`` most frequent words and, with ``bigrams``, pairs; ties by term."""
    words = store(word_statistics(joined), "words")
    if not bigrams:
        return largest(words, "cf", ["term"], n)
    found = cut_value(words, "cf", n)
    floor = found[0] if found else 1
    # both sides hold all terms that occur as often as the floor, of which there are at least n
    pairs = pair_statistics(joined, floor).filter(F.col("cf") >= floor)
    return largest(store(words.filter(F.col("cf") >= floor).unionByName(pairs), "terms"), "cf", ["term"], n)


def _known(terms: pa.Array) -> Callable[[pa.RecordBatch], tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Of a batch: (row, term number, occurrences), ordered, for the given terms; and the number of words by row."""
    parts = pc.split_pattern(terms, " ")
    sizes = parts.value_lengths().to_numpy()
    words = parts.flatten()
    every = pc.unique(words)
    numbers = pc.index_in(words, value_set=every).to_numpy().astype(np.int64)
    begin = np.cumsum(sizes) - sizes
    lone, two = np.flatnonzero(sizes == 1), np.flatnonzero(sizes == 2)
    count = len(every) + 1  # the last one stands for all other words
    term_of = np.full(count, -1)
    term_of[numbers[begin[lone]]] = lone
    keys = numbers[begin[two]] * count + numbers[begin[two] + 1]
    order = np.argsort(keys)
    keys, two = keys[order], two[order]

    def find(batch: pa.RecordBatch):
        words = _Words(batch)
        number = pc.fill_null(pc.index_in(words.names, value_set=every), count - 1).to_numpy().astype(np.int64)
        found = term_of[number[words.codes]]
        rows = words.rows
        if len(keys):
            left, right, of_pair = words.pairs()
            key = number[left] * count + number[right]
            at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            found = np.concatenate([found, np.where(keys[at] == key, two[at], -1)])
            rows = np.concatenate([rows, of_pair])
        met = found >= 0
        size = max(len(terms), 1)
        own, counts = np.unique(rows[met] * size + found[met], return_counts=True)
        return own // size, own % size, counts, np.bincount(words.rows, minlength=batch.num_rows)

    return find


def known_terms(joined: DataFrame, vocabulary: DataFrame, bigrams: bool) -> DataFrame:
    """(doc_id, length, terms array<struct<term,tf>>): as ``forward_index``, with the vocabulary's terms only.

    ``length`` counts the others as well. The caller vouches for the size of the vocabulary.
    """
    names = np.sort(vocabulary.select("term").toPandas()["term"].to_numpy(object))
    shared = joined.sparkSession.sparkContext.broadcast(pa.array(names, pa.string()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = shared.value
        find = _known(terms)
        for batch in batches:
            rows, numbers, counts, words = find(batch)
            length = words + np.maximum(words - 1, 0) if bigrams else words
            offsets = pa.array(np.searchsorted(rows, np.arange(batch.num_rows + 1)), pa.int32())
            one = pa.StructArray.from_arrays([terms.take(pa.array(numbers)), pa.array(counts, pa.int32())], ["term", "tf"])
            columns = [batch.column("doc_id"), pa.array(length, pa.int64()), pa.ListArray.from_arrays(offsets, one)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "length", "terms"])

    kind = joined.schema["doc_id"].dataType.simpleString()
    return joined.mapInArrow(run, f"doc_id {kind}, length long, terms array<struct<term:string,tf:int>>")
