"""MinHash near-duplicates: one-permutation hashing, optimal densification, bands, star-shaped candidates.

One hash of each shingle both picks one of ``BINS`` bins and competes for that bin's least value. An empty
bin takes the value of a bin drawn by hash of its number and the attempt, again and again until one is
not empty; all texts draw alike, so the bins agree as often as the sets do. A bin is kept as one byte,
a band is ``ROWS`` bins, and sets whose similarity is 0.8 or more share a band but for about three in a
million pairs: (1 - 0.8^5)^32.

Equal sets are one node from the start, so exact copies meet nowhere. In a bucket (sets that share a
band) no pairs are formed: the node with most bucket mates becomes the centre and each of the others
gets one edge to it, the same edge in whatever bucket it arises. Every edge is confirmed on full sets.

A star alone could miss a pair whose sets are both unlike their centre. So the nodes of a star that do
not end up in its centre's component are compared with all nodes of that star, on full sets, in blocks
of bounded size, inside a task; only links that join something leave it. As two nodes of one bucket are
always in one star, no pair of a bucket is lost.

Rows: null and empty texts, and texts without words, have no shingles and are linked with nothing; one
word less than a shingle makes the whole text one shingle; rows with equal id and text are one label;
a null id takes part, but is never the smallest id unless all are null; long texts are whole; columns
of whatever name are kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from qaspark.llm.flat import SpanHash, blocks, byte_class, flat_bytes, fold_case, words_of
from qaspark.llm.simhash import components
from qaspark.llm.skew import join_counted, with_row_key
from qaspark.session import store

SHINGLE = 5
SIMILAR = 80  # percent
BANDS, ROWS = 32, 5
BINS = BANDS * ROWS
BLOCK_SHINGLES = 1 << 18  # of the sets that one task compares with each other
EDGES_PER_COPY = 1 << 12
ATTEMPTS = 4096
WORD = ~byte_class((0x09, 0x0D), (0x20, 0x20))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


class Shingles:
    """Sets of hashed word shingles of a block of texts: (hashes, offsets), sorted and distinct per text."""

    def __init__(self, size: int):
        self.size, self.hash = size, SpanHash(fold_case(), 31)

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        content, offsets = flat_bytes(texts)
        count = len(offsets) - 1
        starts, ends, owner = words_of(content, offsets, WORD)
        words = _mix(self.hash(content, starts, ends))
        per = np.bincount(owner, minlength=count)
        first = np.cumsum(per) - per
        many = np.where(per >= self.size, per - self.size + 1, np.minimum(per, 1))
        text = np.repeat(np.arange(count), many)
        at = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many) + first[text]
        length = np.minimum(per, self.size)[text]
        found = np.zeros(len(at), np.uint64)
        for n in range(self.size):
            inside = n < length
            found[inside] = _mix(found[inside] * np.uint64(0x9E3779B97F4A7C15) + words[at[inside] + n] + np.uint64(n + 1))
        order = np.lexsort((found, text))
        found, text = found[order], text[order]
        new = np.ones(len(found), bool)
        new[1:] = (found[1:] != found[:-1]) | (text[1:] != text[:-1])
        found, text = found[new], text[new]
        return found, np.concatenate(([0], np.cumsum(np.bincount(text, minlength=count))))


def _draws(bins: np.ndarray, attempt: int) -> np.ndarray:
    """The bin that an empty bin looks into at that attempt."""
    return (_mix(bins.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(attempt)) % np.uint64(BINS)).astype(np.int64)


def signatures(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One byte for each text and bin; texts without shingles have zeros."""
    count = len(offsets) - 1
    sizes = np.diff(offsets)
    none = np.uint64(0xFFFFFFFFFFFFFFFF)
    table = np.full(count * BINS, none)
    text = np.repeat(np.arange(count), sizes)
    bins = (_mix(hashes) % np.uint64(BINS)).astype(np.int64)
    # hashes ascend inside a text: written from the last, the least one stays
    table[(text * BINS + bins)[::-1]] = hashes[::-1]
    table = table.reshape(count, BINS)
    full = table != none
    row, column = np.nonzero(~full & (sizes > 0)[:, None])
    for attempt in range(ATTEMPTS):
        if not len(row):
            break
        drawn = _draws(column, attempt)
        hit = full[row, drawn]
        table[row[hit], column[hit]] = table[row[hit], drawn[hit]]
        row, column = row[~hit], column[~hit]
    for r, c in zip(row.tolist(), column.tolist()):  # next to never: the nearest bin to the right
        table[r, c] = table[r, (c + int(np.argmax(np.roll(full[r], -c)))) % BINS]
    out = (_mix(table ^ np.uint64(0x51ED270B7F4A7C15)) >> np.uint64(17)).astype(np.uint8)
    out[sizes == 0] = 0
    return out


def band_keys(prints: np.ndarray) -> np.ndarray:
    """(text, band): five bytes of the signature, above them the number of the band."""
    parts = prints.reshape(len(prints), BANDS, ROWS).astype(np.int64)
    keys = np.broadcast_to(np.arange(BANDS), parts.shape[:2]).copy()
    for n in range(ROWS):
        keys = keys << 8 | parts[:, :, n]
    return keys


def _signed(keyed: DataFrame, shingle: int) -> DataFrame:
    """(k1, k2, id, node, n, bands): node is 128 bits of the set, null where it is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(shingle)
        for batch in batches:
            at = 0
            for block in blocks(batch.column(3)):
                hashes, offsets = shingles(block)
                sizes, line = np.diff(offsets), hashes.tobytes()
                nodes = [
                    hashlib.blake2b(line[8 * a : 8 * b], digest_size=16).digest() if b > a else None
                    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())
                ]
                keys = band_keys(signatures(hashes, offsets))
                bands = pa.ListArray.from_arrays(
                    pa.array(np.arange(0, keys.size + 1, BANDS), pa.int32()), pa.array(keys.reshape(-1))
                )
                rows = batch.slice(at, len(block)).select([0, 1, 2])
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, pa.array(nodes, pa.binary()), pa.array(sizes.astype(np.int64)), bands],
                    ["k1", "k2", "id", "node", "n", "bands"],
                )
                at += len(block)

    kind = keyed.schema["id"].dataType.simpleString()
    return keyed.mapInArrow(run, f"k1 long, k2 long, id {kind}, node binary, n long, bands array<long>")


def _sets(keyed: DataFrame, shingle: int) -> DataFrame:
    """(node, set): the hashed shingles of the given (node, text) rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(shingle)
        for batch in batches:
            at = 0
            for block in blocks(batch.column(1)):
                hashes, offsets = shingles(block)
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(hashes.view(np.int64)))
                nodes = batch.column(0).slice(at, len(block))
                yield pa.RecordBatch.from_arrays([nodes, lists], ["node", "set"])
                at += len(block)

    return keyed.mapInArrow(run, "node binary, set array<long>")


def stars(nodes: DataFrame) -> DataFrame:
    """(centre, node): in each bucket an edge from every node to the one with most bucket mates."""
    bands = nodes.select("node", F.explode("bands").alias("key"))
    sizes = bands.groupBy("key").agg(F.count(F.lit(1)).alias("m")).filter("m > 1")
    sizes = store(sizes, "buckets")
    # a bucket has at most one of the BANDS rows of a node; Spark splits what is skewed all the same
    met = store(bands.join(sizes, "key"), "met")
    mates = met.groupBy("node").agg(F.sum("m").alias("mates"))  # a node is in no more buckets than bands
    ranked = store(met.join(mates, "node"), "ranked")
    best = F.max(F.struct("mates", "node")).getField("node").alias("centre")
    centres = store(ranked.groupBy("key").agg(best), "centres")
    edges = ranked.select("key", "node").join(centres, "key")
    return edges.filter("centre <> node").select("centre", "node").distinct()


def _stars_with_sets(edges: DataFrame, sets: DataFrame) -> DataFrame:
    """(centre, node, core, set): both sets beside each edge. A centre's set is laid out once for every
    ``EDGES_PER_COPY`` edges, so a centre that a third of all nodes hang on is no single task's."""
    stars_ = store(edges.groupBy("centre").agg(F.count(F.lit(1)).alias("m")), "stars")
    copies = F.expr(f"cast(ceil(m / {EDGES_PER_COPY}) as int)")
    cores = stars_.join(sets.select(F.col("node").alias("centre"), F.col("set").alias("core")), "centre")
    cores = cores.select("centre", "core", F.explode(F.sequence(F.lit(0), copies - 1)).alias("copy"))
    dealt = join_counted(edges, stars_, ["centre"], "m", edges.count())
    dealt = dealt.withColumn("copy", F.pmod(F.xxhash64("node"), copies).cast("int")).drop("m")
    return dealt.join(sets, "node").join(cores, ["centre", "copy"]).drop("copy")


def _linked(common, one, other, percent: int):
    """For columns and arrays alike."""
    return 100 * common >= percent * (one + other - common)


def confirm(edges: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b) of the edges whose full sets are similar enough."""
    common = F.size(F.array_intersect("core", "set"))
    both = _stars_with_sets(edges, sets).select(
        "centre", "node", F.size("core").alias("one"), F.size("set").alias("other"), "core", "set"
    )
    # a set much smaller than the other needs no comparison
    least = 100 * F.least("one", "other") >= percent * F.greatest("one", "other")
    near = both.filter(least).withColumn("common", common)
    return near.filter(_linked(F.col("common"), F.col("one"), F.col("other"), percent)).select(
        F.col("centre").alias("a"), F.col("node").alias("b")
    )


def _compare(percent: int):
    """Links between the strays of a star's block and all nodes of another block of that star."""

    def links(nodes, labels, stray, sets) -> Iterator[tuple[bytes, bytes]]:
        if not stray.any() or len(nodes) < 2:
            return
        sizes = np.array([len(s) for s in sets])
        flat = np.concatenate(sets)
        known, places = np.unique(flat, return_inverse=True)
        starts = np.cumsum(sizes) - sizes
        group = {label: label for label in labels}

        def root(x):
            while group[x] != x:
                x = group[x]
            return x

        mask = np.zeros(len(known), np.int64)
        for x in np.flatnonzero(stray).tolist():
            own = places[starts[x] : starts[x] + sizes[x]]
            mask[own] = 1
            common = np.add.reduceat(mask[places], starts)
            mask[own] = 0
            for y in np.flatnonzero(_linked(common, sizes, sizes[x], percent)).tolist():
                one, other = root(labels[x]), root(labels[y])
                if one != other:
                    group[one] = other
                    yield nodes[x], nodes[y]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def flush() -> pa.RecordBatch:
            found = []
            if held:
                nodes, labels, stray, sets = zip(*held)
                found = list(links(nodes, labels, np.array(stray), sets))
            a, b = zip(*found) if found else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])

        for batch in batches:
            stars_, parts, nodes, labels, stray = (batch.column(n).to_pylist() for n in range(5))
            lists = batch.column(5)
            for n, one in enumerate(zip(stars_, parts)):
                if one != key:
                    if held:
                        yield flush()
                    key, held = one, []
                held.append((nodes[n], labels[n], stray[n], lists[n].values.to_numpy().view(np.uint64)))
        if held:
            yield flush()

    return run


def close_stars(edges: DataFrame, sets: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """(a, b): links between nodes of one star that are not in one component yet.

    At least one end of such a link is a stray: a node outside its centre's component. Strays and all
    nodes of the star are cut into blocks of bounded size; each block of strays meets each block of nodes.
    """
    named = labels.withColumnRenamed("label", "own")
    members = edges.unionByName(edges.select("centre", F.col("centre").alias("node")).distinct())
    sized = sets.select("node", F.size("set").cast("long").alias("n"))
    members = members.join(sized, "node").join(named, "node", "left").withColumn("own", F.coalesce("own", "node"))
    members = store(members, "members")
    core = members.filter("centre = node").select("centre", F.col("own").alias("main"))
    counts = members.groupBy("centre").agg(F.count(F.lit(1)).alias("m"))
    core = store(core.join(counts, "centre"), "cores")
    marked = join_counted(members, core, ["centre"], "m", members.count())
    marked = store(marked.withColumn("stray", F.col("own") != F.col("main")).drop("main", "m"), "marked")
    weights = marked.groupBy("centre").agg(
        F.count(F.lit(1)).alias("m"),
        F.sum("n").alias("all"),
        F.sum(F.when(F.col("stray"), F.col("n")).otherwise(0)).alias("strays"),
        F.count(F.when(F.col("stray"), 1)).alias("found"),
    )
    open_ = weights.filter("found > 0").select(
        "centre", "m",
        F.expr(f"cast(ceil(all / {BLOCK_SHINGLES}) as int)").alias("down"),
        F.expr(f"cast(ceil(strays / {BLOCK_SHINGLES}) as int)").alias("across"),
    )
    open_ = store(open_, "open")
    total = open_.agg(F.coalesce(F.sum("m"), F.lit(0))).first()[0]
    if not total:
        return edges.select(F.col("centre").alias("a"), F.col("node").alias("b")).limit(0)
    dealt = join_counted(marked, open_, ["centre"], "m", total)
    place = F.xxhash64("node")
    row, column = F.pmod(place, "down").cast("int"), F.pmod(place, "across").cast("int")
    each = lambda size: F.sequence(F.lit(0), F.col(size) - 1)
    as_node = dealt.select(
        "centre", "node", "own", F.lit(False).alias("stray"), row.alias("i"), F.explode(each("across")).alias("j")
    )
    as_stray = dealt.filter("stray").select(
        "centre", "node", "own", F.lit(True).alias("stray"), F.explode(each("down")).alias("i"), column.alias("j")
    )
    part = (F.col("i").cast("long") * F.lit(1 << 31) + F.col("j")).alias("part")
    met = as_node.unionByName(as_stray).groupBy("centre", "i", "j", "node").agg(
        F.max("stray").alias("stray"), F.first("own").alias("own")
    )
    return (
        met.select("centre", part, "node", F.col("own").alias("label"), "stray")
        .join(sets, "node")
        .select("centre", "part", "node", "label", "stray", "set")
        .repartition("centre", "part")
        .sortWithinPartitions("centre", "part")
        .mapInArrow(_compare(percent), "a binary, b binary")
    )


def group_documents(
    docs: DataFrame,
    shingle: int = SHINGLE,
    percent: int = SIMILAR,
    doc_id: str = "doc_id",
    text: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """(k1, k2, id, n, component) of every row, and (k1, k2) of the row that stands for each group.

    ``n`` is the size of the row's set, ``component`` the smallest id of its group. The bands are made
    for a similarity of 80 percent or more.
    """
    if percent < SIMILAR:
        raise ValueError(f"the bands are made for {SIMILAR} percent or more")
    keyed = with_row_key(docs, doc_id, text)
    given = keyed.select(
        "k1", "k2", F.col("row").getField(doc_id).alias("id"), F.col("row").getField(text).alias("text")
    )
    signed = store(_signed(given, shingle), "signed")
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "k1", "k2")).alias("best")
    full = signed.filter("node is not null")
    nodes = full.groupBy("node").agg(first, F.count(F.lit(1)).alias("m"), F.first("bands").alias("bands"))
    nodes = store(nodes, "nodes")
    edges = store(stars(nodes), "edges")
    asked = edges.select(F.explode(F.array("centre", "node")).alias("node")).distinct()
    owners = nodes.join(asked, "node").select("best.k1", "best.k2", "node")
    texts = given.join(owners, ["k1", "k2"]).select("node", "text")
    sets = store(_sets(texts, shingle).dropDuplicates(["node"]), "sets")
    links = store(confirm(edges, sets, percent), "links")
    labels = components(links)
    more = store(close_stars(edges, sets, labels, percent), "more")
    if more.take(1):
        labels = components(links.unionByName(more))
    named = nodes.select("node", "best", "m").join(labels, "node", "left")
    named = store(named.withColumn("label", F.coalesce("label", "node")), "named")
    groups = store(named.groupBy("label").agg(F.min("best").alias("first"), F.count(F.lit(1)).alias("g")), "groups")
    found = join_counted(named, groups, ["label"], "g", named.count())
    found = store(found.select("node", "m", F.col("first.id").alias("component")), "found")
    names = ["k1", "k2", "id", "n", "component"]
    rows = join_counted(full, found, ["node"], "m", full.count()).select(*names)
    lone = signed.filter("node is null").withColumn("component", F.col("id"))
    chosen = groups.select("first.k1", "first.k2").unionByName(lone.select("k1", "k2").distinct())
    return rows.unionByName(lone.select(*names)), chosen


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """The documents with one of each group, the one with the smallest id; of repeated rows, one."""
    _, chosen = group_documents(docs, doc_id=doc_id, text=text, **settings)
    kept = with_row_key(docs, doc_id, text).join(chosen, ["k1", "k2"], "left_semi")
    return kept.dropDuplicates(["k1", "k2"]).select("row.*")


def op11_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: two-word shingles, set size and group of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows, _ = group_documents(docs, shingle=2)
    return rows.select(
        F.col("id").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.col("component").alias("component_id"),
        F.coalesce(F.col("id") == F.col("component"), F.lit(False)).alias("kept"),
    )
