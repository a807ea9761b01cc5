"""SimHash near-duplicates by Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into two segments of 23 bits and a rest of 18. The perfect binary Golay
code puts every 23-bit word within three bits of exactly one of 4096 codewords; a segment's keys are
the indices of the codewords of all words at most one bit away from it (one to six). Two segments at
most two bits apart have the word half way in common, and so share a key. With at most four
differing bits in all, a + b + c <= 4 over the segments and the rest:

* c = 0: a <= 2 or b <= 2, so the pair shares (rest, key of that segment);
* c > 0: a + b <= 3, so a = 0 or b = 0 and the pair shares that whole segment, or both are one or two
  and c is at most two: then the pair shares (key of the one, key of the other, one third of the rest).

Fingerprints that share a key are compared bit by bit. Equal fingerprints are one node from the
start, so exact copies meet nowhere. The fingerprints of a key are not paired with each other: a
key's linked groups are found by a search that compares each fingerprint only with those not reached
yet, and one link per fingerprint leaves the task. A key with more than ``GROUP`` fingerprints is
split by pigeonhole again: five parts of the fingerprint, one of which has to agree, then one of fifteen
pairs of six parts, and beyond 32 times ``GROUP`` one of seventy fours of eight parts. Components of the links are then found by label contraction, stored each round.

Rows: null and empty texts have no words and fingerprint zero, which links like any other; a text
with fewer words than a shingle is one shingle; rows with the same id are separate rows of one label;
a null id takes part, but is never the smallest id unless all are null. Columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from qaspark.llm.flat import blocks, byte_class, flat_bytes, fold_case, words_of
from qaspark.llm.skew import join_counted, with_row_key
from qaspark.plans.broadcasts import union_all
from qaspark.session import store

SHINGLE = 4
MAX_BITS = 4
SEED = 42
GROUP = 2048
# (parts, parts without an error, groups a key may be large before it is split so): four errors leave one of
# five parts alone, two of six, four of eight; seventy keys a print cost more than comparing up to 65536
SPLITS = ((5, 1, 1), (6, 2, 1), (8, 4, 32))
WORD = ~byte_class((0x09, 0x0D), (0x20, 0x20))
GENERATOR = 0b101011100011  # x^11 + x^9 + x^7 + x^6 + x^5 + x + 1
SEGMENT = (1 << 23) - 1


# --- fingerprints -----------------------------------------------------------------------------


def fingerprints(texts: pa.Array, shingle: int) -> np.ndarray:
    """SimHash of each text: a bit is set if it is set in over half of the shingles' XXH64."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    fold = fold_case()
    content, offsets = flat_bytes(texts)
    starts, ends, owner = words_of(content, offsets, WORD)
    sizes = ends - starts
    # all words end to end with one space between them, so that a shingle is one slice
    stops = np.cumsum(sizes + 1)
    begins = stops - sizes - 1
    joined = np.full(int(stops[-1]) if len(stops) else 0, 32, np.uint8)
    joined[np.repeat(begins - starts, sizes) + _ranges(starts, sizes)] = fold[content[_ranges(starts, sizes)]]
    line = joined.tobytes()
    words = np.bincount(owner, minlength=len(offsets) - 1)
    last = np.cumsum(words)
    first = last - words
    count = np.where(words >= shingle, words - shingle + 1, np.minimum(words, 1))
    shingles = _ranges(first, count)
    until = np.minimum(shingles + shingle, np.repeat(last, count)) - 1
    froms, tos = begins[shingles].tolist(), (stops[until] - 1).tolist()
    hashes = np.array([digest(line[a:b], SEED) for a, b in zip(froms, tos)], np.uint64)
    found = np.zeros(len(words), np.uint64)
    full = np.flatnonzero(count)
    if len(full):
        at = (np.cumsum(count) - count)[full]
        half = count[full]
        for bit in range(64):
            ones = np.add.reduceat((hashes >> np.uint64(bit)) & np.uint64(1), at)
            found[full] |= (2 * ones.astype(np.int64) > half).astype(np.uint64) << np.uint64(bit)
    return found


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of every span, end to end."""
    total = int(sizes.sum())
    before = np.cumsum(sizes) - sizes
    return np.arange(total) + np.repeat(starts - before, sizes)


def with_fingerprint(docs: DataFrame, text: str = "text", shingle: int = SHINGLE, to: str = "fingerprint") -> DataFrame:
    """Add ``to``: the SimHash as a long with the same 64 bits."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            parts = [fingerprints(block, shingle).view(np.int64) for block in blocks(batch)]
            yield pa.array(np.concatenate([np.empty(0, np.int64), *parts]), pa.int64())

    return docs.withColumn(to, F.arrow_udf(run, "long")(F.col(text)))


# --- Golay keys -------------------------------------------------------------------------------


def _remainder(words: np.ndarray) -> np.ndarray:
    """Remainder of 23-bit polynomials by the generator: the syndrome."""
    left = words.copy()
    for bit in range(22, 10, -1):
        left ^= ((left >> bit) & 1) * (GENERATOR << (bit - 11))
    return left


def golay_tables() -> np.ndarray:
    """The error pattern of each of the 2048 syndromes: all patterns of at most three bits."""
    bits = 1 << np.arange(23)
    patterns = {0}
    patterns |= {int(a | b | c) for a in bits for b in bits for c in bits}
    errors = np.array(sorted(patterns), np.int64)
    table = np.full(2048, -1, np.int64)
    table[_remainder(errors)] = errors
    return table


def segment_keys(segments: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place in ``segments``, codeword index) for all words at most one bit away, without repeats."""
    near = segments[:, None] ^ np.concatenate(([0], 1 << np.arange(23)))[None, :]
    index = (near ^ table[_remainder(near)]) >> 11  # the message bits of a systematic reading
    index.sort(axis=1)
    new = np.ones(index.shape, bool)
    new[:, 1:] = index[:, 1:] != index[:, :-1]
    place, column = np.nonzero(new)
    return place, index[place, column]


def fuzzy_keys(prints: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place in ``prints``, key): any two prints at most four bits apart share a key."""
    word = prints.view(np.uint64)
    one = (word & np.uint64(SEGMENT)).astype(np.int64)
    two = ((word >> np.uint64(23)) & np.uint64(SEGMENT)).astype(np.int64)
    rest = (word >> np.uint64(46)).astype(np.int64)
    every = np.arange(len(prints))
    p1, k1 = segment_keys(one, table)
    p2, k2 = segment_keys(two, table)
    # both segments: each key of the one with each key of the other
    n2 = np.bincount(p2, minlength=len(prints))
    at2 = np.cumsum(n2) - n2
    repeat = n2[p1]
    both = _ranges(at2[p1], repeat)
    pair, pair_key = np.repeat(p1, repeat), np.repeat(k1, repeat) << 12 | k2[both]
    places = [p1, p2, every, every, pair, pair, pair]
    keys = [
        rest[p1] << 12 | k1,
        1 << 40 | rest[p2] << 12 | k2,
        2 << 40 | one,
        3 << 40 | two,
        *((4 + third) << 40 | ((rest[pair] >> 6 * third) & 63) << 24 | pair_key for third in range(3)),
    ]
    return np.concatenate(places), np.concatenate(keys)


# --- links ------------------------------------------------------------------------------------


def local_links(prints: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """A link from each print to one it was reached from: the groups within ``max_bits``."""
    left, links = prints.view(np.uint64), []  # a count of a signed number's bits is that of its size
    while len(left) > 1:
        front, left = left[:1], left[1:]
        while len(front) and len(left):
            near, size = [], len(left)
            taken = np.zeros(size, bool)
            for one in front:
                hit = ~taken & (np.bitwise_count(left ^ one) <= max_bits)
                if hit.any():
                    found = left[hit]
                    near.append(found)
                    links += [(int(one), int(x)) for x in found]
                    taken |= hit
                    if taken.all():
                        break
            left = left[~taken]
            front = np.concatenate(near) if near else left[:0]
    return [(a - (1 << 64) * (a >> 63), b - (1 << 64) * (b >> 63)) for a, b in links]


def _link_groups(max_bits: int, group: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by key. A key's prints are held up to ``group``; of a larger key the rows
        are passed on, to be split."""
        key, held, size = None, [], 0

        def passing() -> bool:
            return group is not None and size > group

        def links() -> list[tuple[int, int]]:
            return local_links(np.unique(np.concatenate(held)), max_bits) if size > 1 and not passing() else []

        for batch in batches:
            keys, prints = (batch.column(n).to_numpy(zero_copy_only=False) for n in (0, 1))
            change = np.flatnonzero(keys[1:] != keys[:-1]) + 1
            edges = np.concatenate(([0], change, [len(keys)])).astype(np.int64)
            # keys of one print, inside the batch, have no links
            lone = np.flatnonzero(np.diff(edges) == 1)
            lone = set(lone[(lone > 0) & (lone < len(edges) - 2)].tolist())
            out = []
            for n, (a, b) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist())):
                if a == b or n in lone:
                    continue
                if keys[a] != key:
                    out += links()
                    key, held, size = keys[a], [], 0
                held.append(prints[a:b])
                size += b - a
                if passing():
                    for part in held:
                        yield _rows(np.column_stack((np.full(len(part), key), part)), True)
                    held = []
            yield _rows(np.array(out, np.int64).reshape(-1, 2), False)
        yield _rows(np.array(links(), np.int64).reshape(-1, 2), False)

    return run


def _rows(pairs: np.ndarray, large: bool) -> pa.RecordBatch:
    columns = [pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), pa.array(np.full(len(pairs), large))]
    return pa.RecordBatch.from_arrays(columns, ["a", "b", "large"])


def _part_keys(parts: int, choose: int) -> list[Column]:
    """Hashes of ``choose`` of ``parts`` parts of the print, for each choice, with the key so far.

    A part takes every ``parts``-th bit, so no part lies within the bits that a key fixes already.
    """
    masks = [sum(1 << bit for bit in range(part, 64, parts)) for part in range(parts)]
    signed = [mask - (1 << 64) if mask >> 63 else mask for mask in masks]
    pieces = [F.col("fp").bitwiseAND(F.lit(mask).cast("long")) for mask in signed]
    return [F.xxhash64("key", F.lit(n), *some) for n, some in enumerate(combinations(pieces, choose))]


def find_links(
    distinct: DataFrame, max_bits: int = MAX_BITS, group: int = GROUP, splits: Sequence[tuple[int, int, int]] = SPLITS
) -> DataFrame:
    """(a, b): links that connect what is at most ``max_bits`` apart; ``distinct`` has one ``fp``.

    ``max_bits`` up to four.
    """
    if max_bits > MAX_BITS:
        raise ValueError(f"the keys cover {MAX_BITS} differing bits")
    table = golay_tables()

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = batch.column(0).to_numpy(zero_copy_only=False)
            for at in range(0, len(prints), 4096):
                part = prints[at : at + 4096]
                places, keys = fuzzy_keys(part, table)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(part[places])], ["key", "fp"])

    level = distinct.mapInArrow(expand, "key long, fp long")
    found = []
    for parts, choose, size in (*splits, (0, 0, 0)):
        limit = size * group if parts else None
        settled = store(
            level.repartition("key")
            .sortWithinPartitions("key")
            .mapInArrow(_link_groups(max_bits, limit), "a long, b long, large boolean"),
            "links",
        )
        found.append(settled.filter("not large").select("a", "b"))
        large = settled.filter("large").select(F.col("a").alias("key"), F.col("b").alias("fp"))
        if not parts or not large.take(1):
            break
        level = large.select(F.explode(F.array(*_part_keys(parts, choose))).alias("key"), "fp")
    return union_all(found).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, label): the smallest node that each linked node can reach.

    Each round every node points at the smallest label among its neighbours and itself, and labels
    follow pointers; what no longer joins two labels goes. Rounds grow with the logarithm of the
    longest chain. The rows are stored each round, so a lost executor costs one round at most.
    """
    pairs = store(links.filter("a <> b").select("a", "b"), "links")
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    labels = store(nodes.select("node", F.col("node").alias("label")), "labels")
    while pairs.take(1):
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        best = both.groupBy("a").agg(F.min("b").alias("low"))
        # a label that is a local minimum stays; all others hang on a smaller one
        roots = best.select(F.col("a").alias("label"), F.least("a", "low").alias("up"))
        up = store(roots, "up")
        while True:  # shortcut chains of pointers
            over = up.select(F.col("label").alias("up"), F.col("up").alias("top"))
            jumped = store(up.join(over, "up").select("label", F.col("top").alias("up"), (F.col("top") != F.col("up")).alias("moved")), "up")
            up = jumped.select("label", "up")
            if not jumped.filter("moved").take(1):
                break
        labels = store(
            labels.join(up, "label", "left").select("node", F.coalesce("up", "label").alias("label")), "labels"
        )
        one, two = (up.select(F.col("label").alias(c), F.col("up").alias(f"new_{c}")) for c in "ab")
        pairs = store(
            pairs.join(one, "a").join(two, "b")
            .select(F.col("new_a").alias("a"), F.col("new_b").alias("b"))
            .filter("a <> b").distinct(),
            "links",
        )
    return labels


def group_documents(
    docs: DataFrame,
    max_bits: int = MAX_BITS,
    shingle: int = SHINGLE,
    doc_id: str = "doc_id",
    text: str = "text",
    group: int = GROUP,
) -> tuple[DataFrame, DataFrame]:
    """(id, fp, component) of every row, and (k1, k2) of the row that stands for each group.

    ``component`` is the smallest id of the group; the row that stands for it has that id.
    """
    keyed = with_row_key(docs, doc_id, text)
    given = keyed.select(
        "k1", "k2", F.col("row").getField(doc_id).alias("id"), F.col("row").getField(text).alias("text")
    )
    prints = store(with_fingerprint(given, "text", shingle, "fp").drop("text"), "prints")
    best = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "k1", "k2")).alias("best")
    owners = store(prints.groupBy("fp").agg(best, F.count(F.lit(1)).alias("n")), "owners")
    labels = components(find_links(owners.select("fp"), max_bits, group))
    named = store(
        owners.join(labels.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
            "label", F.coalesce("label", "fp")
        ),
        "named",
    )
    groups = store(named.groupBy("label").agg(F.min("best").alias("first"), F.count(F.lit(1)).alias("m")), "groups")
    found = join_counted(named, groups, ["label"], "m", named.count())
    found = store(found.select("fp", "n", F.col("first.id").alias("component")), "found")
    rows = join_counted(prints, found, ["fp"], "n", prints.count())
    return rows.select("id", "fp", "component"), groups.select("first.k1", "first.k2")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """The documents with one of each group: the one with the smallest id; of repeated rows, one."""
    _, chosen = group_documents(docs, doc_id=doc_id, text=text, **settings)
    kept = with_row_key(docs, doc_id, text).join(chosen, ["k1", "k2"], "left_semi")
    return kept.dropDuplicates(["k1", "k2"]).select("row.*")


def op9_simhash_golay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: fingerprint and group of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return group_documents(docs)[0].select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )
