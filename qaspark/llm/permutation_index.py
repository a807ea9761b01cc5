"""Approximate nearest neighbours by a permutation index.

A vector is represented by its nearest pivots in order. It is posted in the inverted files of its first
``POSTED`` pivots; a query opens the files of the nearest ``OPENED`` share of all pivots, ranks what it
finds by the footrule distance of the two orders (a pivot that an order lacks stands behind its last
place), and measures the best ``MEASURED`` share of each file exactly. Where the files of that share hold too
few vectors, a query opens the next ones: entries are counted at their nearest pivot only, so each counts
once, until there are ``k + 1`` of them or all files are open. Every posting carries its whole
order, so a file is ranked where it lies and only the nearest of each file leave the task. The shares
suit vectors without any clusters, the hardest case; where there are clusters, less will do.

Equal vectors are one entry of the index with its smallest ids: at most ``k + 1`` of them can be asked
for, so a group of copies, however large, is one entry, and loses nothing. A file that holds more than
``FILE`` entries is split, and a query visits all its parts, in blocks of at most ``FILE`` queries.

The pivots are a bounded sample of the distinct vectors, drawn by hash: their number is the square root
of the number of vectors, within ``PIVOTS``. ``recall`` measures what is found against brute force.

Rows: vectors that are null, zero, or hold null or non-finite components take no part, neither do
vectors of another length than the commonest (the shorter, in a tie); a repeated id is one candidate
for each distinct vector it has; fewer candidates than ``k`` give fewer rows; a null id takes no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from qaspark.plans.topk import topk_per
from qaspark.session import store

PIVOTS = (128, 256)
ORDER = 128  # pivots in an order
POSTED = 2
OPENED = 0.5
MEASURED = 0.15
FILE = 4096


def _usable(vector: Column) -> Column:
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return whole & F.exists(vector, lambda x: x != 0)


def _given(rows: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(id, vector) of the usable vectors."""
    given = rows.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    # a zero has one sign only, so that equal vectors have equal bytes
    return given.filter(F.col("id").isNotNull() & _usable(F.col("vector"))).withColumn(
        "vector", F.transform("vector", lambda x: x + F.lit(0.0))
    )


def common_length(rows: DataFrame, vec_id: str, vector: str) -> int:
    """The commonest length of the usable vectors, of equally common ones the least; 0 if there is none."""
    sizes = _given(rows, vec_id, vector).groupBy(F.size("vector").alias("size")).count()
    first = sizes.orderBy(F.desc("count"), "size").first()
    return first["size"] if first else 0


def distinct_vectors(rows: DataFrame, vec_id: str, vector: str, copies: int, length: int) -> DataFrame:
    """(entry, vector, ids): each distinct usable vector of that length, with its ``copies`` smallest ids."""
    given = _given(rows, vec_id, vector).filter(F.size("vector") == length).distinct()
    digest = [F.xxhash64("vector").alias("e1"), F.xxhash64(F.lit("v"), "vector").alias("e2")]
    keyed = given.select("id", "vector", *digest)
    least = topk_per(keyed.select("e1", "e2", "id"), ["e1", "e2"], [F.col("id")], copies)
    ids = least.groupBy("e1", "e2").agg(F.sort_array(F.collect_list("id")).alias("ids"))  # copies at most
    one = keyed.groupBy("e1", "e2").agg(F.first("vector").alias("vector"))
    return one.join(ids, ["e1", "e2"]).withColumn("entry", F.xxhash64("e1", "e2"))


def choose_pivots(entries: DataFrame, count: int, bounds: tuple[int, int] = PIVOTS) -> np.ndarray:
    """At most ``bounds[1]`` vectors, the first by a hash of their content."""
    wanted = min(max(int(count**0.5), bounds[0]), bounds[1])
    found = entries.select("vector", "e1", "e2").orderBy("e1", "e2").limit(wanted).collect()
    return np.array([row.vector for row in found])


def orders(vectors: np.ndarray, pivots: np.ndarray, length: int) -> np.ndarray:
    """Numbers of the nearest pivots of each vector, nearest first."""
    length = min(length, len(pivots))
    out = np.empty((len(vectors), length), np.int16)
    for at in range(0, len(vectors), 2048):
        part = vectors[at : at + 2048]
        far = (pivots**2).sum(axis=1) - 2 * part @ pivots.T
        near = np.argpartition(far, length - 1, axis=1)[:, :length] if length < len(pivots) else np.tile(np.arange(length), (len(part), 1))
        near.sort(axis=1)
        own = np.argsort(np.take_along_axis(far, near, axis=1), axis=1, kind="stable")
        out[at : at + 2048] = np.take_along_axis(near, own, axis=1)
    return out


def places(orders: np.ndarray, pivots: int) -> np.ndarray:
    """The place of every pivot in each order; one that is not in it stands behind the last."""
    length = orders.shape[1]
    out = np.full((len(orders), pivots), length, np.int16)
    np.put_along_axis(out, orders, np.arange(length, dtype=np.int16)[None, :], axis=1)
    return out


def footrule(one: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Footrule distance of one order from others, all given by places."""
    return np.abs(others - one).sum(axis=1, dtype=np.int32)


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    return np.asarray(column.combine_chunks().flatten()).reshape(-1, dim)


def search(
    rows: DataFrame,
    queries: DataFrame,
    k: int = 10,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    order: int = ORDER,
    posted: int = POSTED,
    opened: float = OPENED,
    measured: float = MEASURED,
    file: int = FILE,
    pivot_bounds: tuple[int, int] = PIVOTS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest ``k`` found for each query id, by Euclidean distance."""
    length = common_length(rows, vec_id, vector)  # of rows and queries alike
    entries = store(distinct_vectors(rows, vec_id, vector, k + 1, length), "entries")
    asked = store(distinct_vectors(queries, vec_id, vector, 1, length), "asked").select("entry", "vector")
    count = entries.count()
    pivots = choose_pivots(entries, count, pivot_bounds)
    dim = pivots.shape[1] if len(pivots) else 1
    shared = rows.sparkSession.sparkContext.broadcast(pivots)

    def assign(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            found = orders(np.asarray(batch.flatten()).reshape(len(batch), -1), shared.value, order)
            yield pa.array(list(found), pa.list_(pa.int16()))

    placed = entries.select("entry", "vector", "ids", F.arrow_udf(assign, "array<smallint>")(F.col("vector")).alias("order"))
    postings = store(placed.withColumn("pivot", F.explode(F.slice("order", 1, posted))), "postings")
    # entries by their nearest pivot, one row per pivot: a lower bound of what a set of files holds
    held = np.zeros(len(pivots), np.int64)
    for row in postings.filter(F.col("pivot") == F.get("order", F.lit(0))).groupBy("pivot").count().collect():
        held[row["pivot"]] = row["count"]
    least = max(1, round(opened * len(pivots)))

    def probe(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            found = orders(np.asarray(batch.flatten()).reshape(len(batch), -1), shared.value, len(shared.value))
            enough = (np.cumsum(held[found], axis=1) < k + 1).sum(axis=1) + 1  # beyond the last: all
            files = [row[: max(least, int(n))] for row, n in zip(found, enough)]
            lists = pa.array(list(found[:, :order]), pa.list_(pa.int16())), pa.array(files, pa.list_(pa.int16()))
            yield pa.StructArray.from_arrays(lists, names=["order", "files"])

    seen = asked.withColumn("seen", F.arrow_udf(probe, "order array<smallint>, files array<smallint>")(F.col("vector")))
    probes = store(seen.select("entry", "vector", "seen.order", F.explode("seen.files").alias("pivot")), "probes")
    # the parts of a file and the blocks of its queries: one row per pivot, of a bounded number
    sizes = postings.groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) / file).cast("int").alias("parts"))
    widths = probes.groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) / file).cast("int").alias("blocks"))
    shape = F.broadcast(sizes.join(widths, "pivot"))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = (
        postings.join(shape, "pivot")
        .withColumn("part", F.pmod(F.xxhash64("entry"), "parts").cast("int"))
        .withColumn("block", every("blocks"))
    )
    right = (
        probes.join(shape, "pivot")
        .withColumn("block", F.pmod(F.xxhash64("entry"), "blocks").cast("int"))
        .withColumn("part", every("parts"))
    )
    cell = ["pivot", "part", "block"]

    def rank(stored: pa.Table, wanted: pa.Table) -> pa.Table:
        none = {"query": pa.array([], pa.int64()), "score": pa.array([], pa.float64()), "entry": pa.array([], pa.int64()), "ids": pa.array([], pa.list_(pa.int64()))}
        if not len(stored) or not len(wanted):
            return pa.table(none)
        vectors, targets = _matrix(stored["vector"], dim), _matrix(wanted["vector"], dim)
        width = len(stored["order"][0])
        one, two = (np.asarray(t["order"].combine_chunks().flatten()).reshape(-1, width) for t in (stored, wanted))
        owner, found, scores = [], [], []
        own, theirs = places(one, len(shared.value)), places(two, len(shared.value))
        most = max(int(measured * len(one)), 4 * k)
        for n, order_places in enumerate(theirs):
            near = np.arange(len(one))
            if most < len(one):
                far = footrule(order_places, own)
                near = np.flatnonzero(far <= np.partition(far, most - 1)[most - 1])  # with ties
            exact = np.sqrt(((vectors[near] - targets[n]) ** 2).sum(axis=1))
            if len(near) > k + 1:  # and ties of the last one
                keep = exact <= np.partition(exact, k)[k]
                near, exact = near[keep], exact[keep]
            owner.append(np.full(len(near), n))
            found.append(near)
            scores.append(exact)
        owner, found = np.concatenate(owner), np.concatenate(found)
        return pa.table(
            {
                "query": wanted["entry"].take(owner).combine_chunks(),
                "score": pa.array(np.concatenate(scores)),
                "entry": stored["entry"].take(found).combine_chunks(),
                "ids": stored["ids"].take(found).combine_chunks(),
            }
        )

    near = (
        left.select(*cell, "entry", "vector", "order", "ids")
        .groupBy(*cell)
        .cogroup(right.select(*cell, "entry", "vector", "order").groupBy(*cell))
        .applyInArrow(rank, "query long, score double, entry long, ids array<long>")
        .dropDuplicates(["query", "entry"])
        .select("query", "score", F.explode("ids").alias("vec_id"))
        .dropDuplicates(["query", "vec_id"])
    )
    best = store(topk_per(near, "query", [F.col("score"), F.col("vec_id")], k + 1), "nearest")
    # back to the query ids: equal queries share an entry, and each leaves itself out
    ids = queries.select(F.col(vec_id).cast("long").alias("query_id"), F.col(vector).cast("array<double>").alias("v"))
    ids = ids.filter(F.col("query_id").isNotNull() & _usable(F.col("v"))).withColumn("v", F.transform("v", lambda x: x + F.lit(0.0)))
    ids = ids.select("query_id", F.xxhash64(F.xxhash64("v"), F.xxhash64(F.lit("v"), "v")).alias("query")).distinct()
    pairs = ids.join(best.drop("rank"), "query").filter("query_id <> vec_id")
    return topk_per(pairs, "query_id", [F.col("score"), F.col("vec_id")], k).select("query_id", "rank", "vec_id", "score")


def exact_search(rows: DataFrame, queries: DataFrame, k: int, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Brute force, for measuring: each block of rows against all queries, which have to be few."""
    wanted = [(r[0], r[1]) for r in queries.select(vec_id, vector).filter(_usable(F.col(vector).cast("array<double>"))).collect()]
    shared = rows.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            vectors = np.array(batch.column(1).to_pylist(), np.float64)
            for query, target in shared.value if len(ids) else ():
                far = np.sqrt(((vectors - np.array(target, np.float64)) ** 2).sum(axis=1))
                far[ids == query] = np.inf
                near = np.lexsort((ids, far))[:k]
                near = near[np.isfinite(far[near])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(near), query)), pa.array(ids[near]), pa.array(far[near])], ["query_id", "vec_id", "score"]
                )

    given = rows.select(F.col(vec_id).cast("long").alias("i"), F.col(vector).cast("array<double>").alias("v")).filter(_usable(F.col("v")))
    found = given.mapInArrow(run, "query_id long, vec_id long, score double")
    return topk_per(found, "query_id", [F.col("score"), F.col("vec_id")], k)


def recall(found: DataFrame, exact: DataFrame) -> float:
    """Share of the true neighbours that were found."""
    hit = exact.join(found.select("query_id", "vec_id"), ["query_id", "vec_id"], "left_semi").count()
    return hit / max(exact.count(), 1)


def op2_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: neighbours of every hundredth vector among all others."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return search(rows, rows.filter(F.col("vec_id") % 100 == 0)).withColumn("rank", F.col("rank").cast("int"))
