"""Byte-level BPE encoding and decoding by merge replay over the distinct words of a block of text.

The words of a block are laid out once each as a chain of byte tokens, end to end, and merges are replayed
on those chains; only the two neighbours of a merged place are looked up anew. Every text is then the
concatenation of its words' tokens. Words do not touch each other, so ids are those of a replay over the
whole corpus; the words met so far are kept up to a fixed number.

Words beyond ``LONG`` bytes go by an inverted index from a token pair (named by the rank of the merge it
allows) to the positions that hold it. A heap has the ranks with positions; a merge goes through its
positions from left to right, in all those words. Entries that a merge has outdated are skipped when
they come up; a merge that makes a pair of a lower rank hands the rest of its positions back and waits.
So a word of any length takes work in proportion to its merges. For short words, the bulk of any
text, the same order is kept word by word as array operations: each step takes every word's lowest
merge, of all words at once. With the index alone, all words of 20 MB took 2.8 to 3.5 times as long.

Rows: a null text counts as empty and gives an empty list of ids; a word of any length is one chain, so
a text without blanks is no special case; repeated rows are encoded like any other. Columns other
than the one named are kept as they are. The ranks are one entry per vocabulary item, so what is
broadcast does not grow with the data.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator, Mapping
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from qaspark.llm.flat import blocks

BLOCK_BYTES = 256 << 10
CACHED_WORDS = 100_000
LONG = 256
SMALL = 4 << 20
NONE = np.int64(1) << 40


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a file of ``base64 rank`` lines."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Merges:
    """The vocabulary as tables: which pairs of tokens make a token."""

    def __init__(self, ranks: Mapping[bytes, int]):
        pairs, made = array("q"), array("q")
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                one, two = ranks.get(token[:cut]), ranks.get(token[cut:])
                if one is not None and two is not None:
                    pairs.append(one << 32 | two)
                    made.append(rank)
        order = np.argsort(np.array(pairs, np.int64))
        self.pairs, self.made = np.array(pairs, np.int64)[order], np.array(made, np.int64)[order]
        self.by_pair = dict(zip(self.pairs.tolist(), self.made.tolist()))
        self.single = np.array([ranks[bytes([value])] for value in range(256)], np.int64)

    def ranks(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Rank of the token that each pair makes; NONE if it makes none."""
        wanted, places = np.unique(one << 32 | two, return_inverse=True)
        if not len(self.pairs):
            return np.full(len(one), NONE)
        at = np.minimum(np.searchsorted(self.pairs, wanted), len(self.pairs) - 1)
        return np.where(self.pairs[at] == wanted, self.made[at], NONE)[places]


def _by_index(words: list[bytes], merges: Merges) -> list[bytes]:
    """Merges in rank order from an index of their positions; work follows the merges made."""
    if not words:
        return []
    sizes = np.array([len(word) for word in words])
    ends = np.cumsum(sizes)
    size = int(ends[-1])
    start = merges.single[np.frombuffer(b"".join(words), np.uint8)]
    allowed = np.full(size, NONE)  # rank of the merge with the right neighbour
    paired = np.ones(size, bool)
    paired[ends - 1] = False
    paired = np.flatnonzero(paired)
    allowed[paired] = merges.ranks(start[paired], start[paired + 1])
    allowed[allowed == NONE] = -1
    after, before = np.arange(1, size + 1), np.arange(-1, size - 1)
    after[ends - 1] = -1
    before[ends - sizes] = -1
    # the index: positions by rank, each list from left to right
    held = np.flatnonzero(allowed >= 0)
    held = held[np.argsort(allowed[held], kind="stable")]
    cuts = np.flatnonzero(np.diff(allowed[held], prepend=-1))
    index = {
        int(allowed[part[0]]): part.tolist() if size <= SMALL else array("q", part.astype(np.int64).tobytes())
        for part in np.split(held, cuts[1:])
        if len(part)
    }
    heap = sorted(index)
    # lists are quicker, arrays a fifth of their size
    held_as = np.ndarray.tolist if size <= SMALL else lambda x: array("q", x.astype(np.int64).tobytes())
    ids, right, left, want = (held_as(x) for x in (start, after, before, allowed))
    rank_of = merges.by_pair.get
    while heap:
        rank = heappop(heap)
        todo = sorted(index.pop(rank))
        high = rank << 32
        for n, place in enumerate(todo):
            if want[place] != rank:
                continue  # merged away, or part of another pair by now
            gone = right[place]
            after = right[gone]
            before = left[place]
            ids[place] = rank
            want[gone] = -1
            right[place] = after
            lower, new = False, -1
            if after >= 0:
                left[after] = place
                new = rank_of(high | ids[after], -1)
                if new >= 0:
                    lower = new < rank
                    if new in index:
                        index[new].append(place)
                    else:
                        index[new] = [place]
                        heappush(heap, new)
            want[place] = new
            if before >= 0:
                new = rank_of(ids[before] << 32 | rank, -1)
                want[before] = new
                if new >= 0:
                    lower = lower or new < rank
                    if new in index:
                        index[new].append(before)
                    else:
                        index[new] = [before]
                        heappush(heap, new)
            if lower and n + 1 < len(todo):  # the rest waits for the lower one
                if rank in index:
                    index[rank].extend(todo[n + 1 :])
                else:
                    index[rank] = todo[n + 1 :]
                    heappush(heap, rank)
                break
    right, left, ids = (np.array(x, np.int64) for x in (right, left, ids))
    # a place is alive if its left neighbour's right one is the place itself
    kept = np.ones(size, bool)
    inside = np.flatnonzero(left >= 0)
    kept[inside] = right[left[inside]] == inside
    content = ids[kept].astype(np.int32).tobytes()
    bounds = 4 * np.concatenate(([0], np.cumsum(kept)[ends - 1]))
    return [content[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]


def _by_steps(words: list[bytes], merges: Merges) -> list[bytes]:
    """One merge of every word in each step, its lowest; all words of a block as arrays."""
    if not words:
        return []
    sizes = np.array([len(word) for word in words])
    ids = merges.single[np.frombuffer(b"".join(words), np.uint8)]
    ends = np.cumsum(sizes)
    size = len(ids)
    right = np.arange(1, size + 1)
    left = np.arange(-1, size - 1)
    right[ends - 1] = -1
    left[ends - sizes] = -1
    rank = np.full(size, NONE)  # of the merge with the right neighbour
    paired = np.flatnonzero(right >= 0)
    rank[paired] = merges.ranks(ids[paired], ids[right[paired]])
    alive = np.ones(size, bool)
    # places of the words that may have a merge left; a place that is merged away stays until the
    # next time the list is cut down
    starts, lengths, steps = ends - sizes, sizes, 0
    places, begins = np.arange(size), starts
    while len(starts):
        best = np.minimum.reduceat(rank[places], begins)
        going = best < NONE
        if not going.all() or steps % 4 == 3:
            keep = np.repeat(going, lengths) & alive[places]
            owner = np.repeat(np.arange(len(lengths)), lengths)[keep]
            places = places[keep]
            lengths = np.bincount(owner, minlength=len(lengths))[going]
            best = best[going]
            begins = np.cumsum(lengths) - lengths
            if not len(lengths):
                break
        steps += 1
        # the leftmost place of the lowest rank in each word
        hit = np.flatnonzero(rank[places] == np.repeat(best, lengths))
        owner = np.searchsorted(begins, hit, side="right")
        at = places[hit[np.concatenate(([True], owner[1:] != owner[:-1]))]]
        gone = right[at]
        after = right[gone]
        ids[at] = rank[at]
        alive[gone] = False
        rank[gone] = rank[at] = NONE
        right[at] = after
        more = after >= 0
        left[after[more]] = at[more]
        rank[at[more]] = merges.ranks(ids[at[more]], ids[after[more]])
        before = left[at]
        more = before >= 0
        rank[before[more]] = merges.ranks(ids[before[more]], ids[at[more]])
    content = ids[alive].astype(np.int32).tobytes()
    bounds = 4 * np.concatenate(([0], np.cumsum(alive)[ends - 1]))
    return [content[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]


def replay(words: list[bytes], merges: Merges) -> list[bytes]:
    """Token ids of each non-empty word, as the bytes of int32 values."""
    size = np.array([len(word) for word in words], np.int64)
    out = np.empty(len(words), object)
    for chosen, way in ((size > LONG, _by_index), (size <= LONG, _by_steps)):
        at = np.flatnonzero(chosen)
        out[at] = way([words[n] for n in at.tolist()], merges) if len(at) else []
    return out.tolist()


class Encoder:
    """Encodes blocks of texts; words already met are kept up to a fixed number."""

    def __init__(self, ranks: Mapping[bytes, int], pattern: str):
        import regex

        self.merges, self.find = Merges(ranks), regex.compile(pattern).findall
        self.met: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> pa.ListArray:
        parts = [self.find(text) for text in texts]
        if len(self.met) > CACHED_WORDS:
            self.met.clear()
        met = self.met
        new = list({word for words in parts for word in words if word not in met})
        met.update(zip(new, replay([w.encode() for w in new], self.merges), strict=True))
        rows = [b"".join([met[word] for word in words]) for words in parts]
        offsets = np.concatenate(([0], np.cumsum([len(row) // 4 for row in rows]))).astype(np.int32)
        values = pa.array(np.frombuffer(b"".join(rows), np.int32))
        return pa.ListArray.from_arrays(pa.array(offsets), values)


class Decoder:
    """Decodes lists of ids by one look-up of all their tokens."""

    def __init__(self, ranks: Mapping[bytes, int]):
        known = sorted(ranks.items(), key=lambda item: item[1])
        self.places = np.full(known[-1][1] + 1 if known else 0, -1)
        self.places[[rank for _, rank in known]] = np.arange(len(known))
        self.tokens = pa.array([token for token, _ in known], pa.large_binary())

    def decode(self, rows: pa.ListArray) -> pa.Array:
        given = pc.fill_null(rows, pa.scalar([], rows.type))
        ids = given.flatten().to_numpy(zero_copy_only=False)
        if not len(ids):
            return pa.array([b""] * len(given), pa.binary())
        if ids.min() < 0 or ids.max() >= len(self.places) or self.places[ids].min() < 0:
            raise ValueError("an id is not in the vocabulary")
        joined = self.tokens.take(pa.array(self.places[ids]))
        _, inside, content = joined.buffers()
        sizes = pc.list_value_length(given).to_numpy(zero_copy_only=False)
        bounds = np.frombuffer(inside, np.int64)[np.concatenate(([0], np.cumsum(sizes)))]
        offsets = pa.py_buffer(bounds.tobytes())
        whole = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(given), [None, offsets, content])
        return pc.cast(whole, pa.binary())


def encode(
    docs: DataFrame, ranks: Mapping[bytes, int], pattern: str, text: str = "text", to: str = "ids"
) -> DataFrame:
    """Add ``to``: the token ids of ``text``, each match of ``pattern`` encoded separately."""
    shared = docs.sparkSession.sparkContext.broadcast(dict(ranks))

    @F.arrow_udf("array<int>")
    def token_ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = Encoder(shared.value, pattern)
        for batch in batches:
            for block in blocks(batch, BLOCK_BYTES):
                yield encoder.encode([text or "" for text in block.to_pylist()])

    return docs.withColumn(to, token_ids(F.col(text)))


def decode(
    encoded: DataFrame, ranks: Mapping[bytes, int], ids: str = "ids", to: str = "decoded"
) -> DataFrame:
    """Add ``to``: the bytes that the ids stand for, end to end. A null list decodes to no bytes.

    An id outside the vocabulary raises.
    """
    shared = encoded.sparkSession.sparkContext.broadcast(dict(ranks))

    @F.arrow_udf("binary")
    def token_bytes(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        decoder = Decoder(shared.value)
        for batch in batches:
            for at in range(0, len(batch), 512):
                yield decoder.decode(batch.slice(at, 512))

    return encoded.withColumn(to, token_bytes(F.col(ids)))


def encode_and_decode(
    docs: DataFrame, ranks: Mapping[bytes, int], pattern: str, text: str = "text", to: str = "coded"
) -> DataFrame:
    """Add ``to``: a struct of the ids and of the bytes they decode to, in one Python step.

    As ``decode`` after ``encode``, with half the Python workers and so half their memory.
    """
    shared = docs.sparkSession.sparkContext.broadcast(dict(ranks))

    @F.arrow_udf("struct<ids:array<int>,decoded:binary>")
    def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder, decoder = Encoder(shared.value, pattern), Decoder(shared.value)
        for batch in batches:
            for block in blocks(batch, BLOCK_BYTES):
                ids = encoder.encode([text or "" for text in block.to_pylist()])
                yield pa.StructArray.from_arrays([ids, decoder.decode(ids)], ["ids", "decoded"])

    return docs.withColumn(to, both(F.col(text)))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: ids and round trip of every document, as digests."""
    import public_tokenizers

    ranks = read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    coded = encode_and_decode(docs, ranks, public_tokenizers.PATTERN).select("doc_id", "coded.*")
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
