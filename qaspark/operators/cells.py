"""Stored cell index over vectors, with 8-bit codes: search by probes, partition pruning and look-up tables.

Layout: one row per vector with its embedding and its codes, partitioned by ``cell`` and ``part``. A cell
beyond ``ROWS`` vectors has several parts, dealt by hash, so a cell with a third of all vectors is many
files and many tasks. ``sizes`` has the rows of each cell.

Probes are rows (qid, cell). A block of questions filters the table by the cells it probes, on the partition
column, so Spark lists only their folders and what is read follows the cells asked for. The
questions of a cell meet its vectors in Arrow batches, as a block product; k rows per question and
task leave it.

Search on codes keeps embeddings out of the first pass altogether. A code is one of 256 steps between a
dimension's ends, so a question has a look-up table of 256 squared distances per dimension, and the
distance to a vector is the sum of the entries that its codes name. The best ``k * factor`` by codes
are joined with their embeddings and ranked exactly.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from qaspark.operators import dense
from qaspark.operators.dense import RANK_DIGITS, SCORE_DIGITS
from qaspark.plans.bestk import BestK
from qaspark.plans.broadcasts import BLOCK_BYTES, broadcast_if_small, split_blocks, union_all
from qaspark.plans.topk import topk_per
from qaspark.session import materialize, scratch_path

ROWS = 1 << 18
STEPS = 255
_SLICE = 4096  # vectors looked up at a time


@dataclass(frozen=True)
class CellIndex:
    """``vectors``: vec_id, embedding, codes, cell, part; ``sizes``: cell, n; ``ranges`` of the codes."""

    vectors: DataFrame
    sizes: DataFrame
    centroids: np.ndarray
    ranges: list[tuple[float, float]]


def build_cells(vectors: DataFrame, centroids: np.ndarray, path: str | None = None, rows: int = ROWS) -> CellIndex:
    """Assign, encode and store (vec_id, embedding) rows; embeddings are kept as doubles."""
    spark = vectors.sparkSession
    path = path or scratch_path(spark, "cells")
    given = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    placed = materialize(dense.assign_cells(given, centroids))
    ranges = dense.value_ranges(placed, centroids.shape[1]) if placed.take(1) else [(0.0, 0.0)] * centroids.shape[1]
    placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).write.parquet(f"{path}/sizes")
    spark.createDataFrame([(n, *map(float, r)) for n, r in enumerate(ranges)], "dim int, low double, high double").write.parquet(
        f"{path}/ranges"
    )
    means = [(n, [float(x) for x in c]) for n, c in enumerate(centroids)]
    spark.createDataFrame(means, "cell int, centroid array<double>").write.parquet(f"{path}/centroids")
    sizes = spark.read.parquet(f"{path}/sizes")
    parts = sizes.select("cell", F.ceil(F.col("n") / rows).cast("int").alias("parts"))  # a row per cell
    codes = dense.sq_encode(placed, ranges).join(F.broadcast(parts), "cell")
    coded = codes.select(
        "vec_id", F.col("embedding").cast("array<double>").alias("embedding"), F.col("codes").cast("array<short>").alias("codes"),
        "cell", F.pmod(F.xxhash64("vec_id"), "parts").cast("int").alias("part"),
    )
    coded.repartition("cell", "part").write.partitionBy("cell", "part").parquet(f"{path}/vectors")
    return open_cells(spark, path)


def open_cells(spark: SparkSession, path: str) -> CellIndex:
    """A stored index; centroids and ranges are a row per cell and dimension."""
    means = spark.read.parquet(f"{path}/centroids").orderBy("cell").collect()
    ranges = spark.read.parquet(f"{path}/ranges").orderBy("dim").collect()
    schema = "vec_id long, embedding array<double>, codes array<short>, cell int, part int"
    vectors = spark.read.schema(schema).parquet(f"{path}/vectors")
    return CellIndex(
        vectors, spark.read.parquet(f"{path}/sizes"), np.array([r.centroid for r in means]), [(r.low, r.high) for r in ranges]
    )


def probes(questions: DataFrame, centroids: np.ndarray, nprobe: int) -> DataFrame:
    """(qid, embedding, cell): a row for each of the nearest cells of a question."""
    shared = questions.sparkSession.sparkContext.broadcast(centroids)
    kind = questions.schema["qid"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                near = dense._nearest(dense._as_matrix(batch.column("embedding")), shared.value, nprobe)
                rows = batch.take(pa.array(np.repeat(np.arange(batch.num_rows), near.shape[1])))
                yield rows.append_column("cell", pa.array(near.ravel(), pa.int32()))

    return questions.select("qid", "embedding").mapInArrow(run, f"qid {kind}, embedding array<double>, cell int")


class _Exact:
    """Squared distances of a batch of embeddings to some questions."""

    def __init__(self, wanted: np.ndarray, ranges: Sequence[tuple[float, float]]):
        self.wanted = wanted

    def __call__(self, lists: pa.ListArray, asking: np.ndarray) -> Iterator[np.ndarray]:
        stored = dense._as_matrix(lists)
        for at in range(0, len(asking), dense._SLICE):
            yield from dense._costs(stored, self.wanted[asking[at : at + dense._SLICE]], "l2")


class _ByCodes:
    """Squared distances to what codes stand for, from each question's tables."""

    def __init__(self, wanted: np.ndarray, ranges: Sequence[tuple[float, float]]):
        low = np.array([r[0] for r in ranges])
        step = np.array([(r[1] - r[0] or 1.0) / STEPS for r in ranges])
        self.levels = low[:, None] + np.arange(STEPS + 1) * step[:, None]  # (dim, code)
        self.wanted = wanted

    def __call__(self, lists: pa.ListArray, asking: np.ndarray) -> Iterator[np.ndarray]:
        codes = lists.flatten().to_numpy().reshape(len(lists), -1)
        dims = np.arange(codes.shape[1])
        for n in asking.tolist():
            table = (self.levels - self.wanted[n][:, None]) ** 2
            parts = [table[dims, codes[at : at + _SLICE]].sum(axis=1) for at in range(0, len(codes), _SLICE)]
            yield np.round(np.concatenate(parts), RANK_DIGITS)


def _probed(index: CellIndex, asked: DataFrame, k: int, column: str, measure, block_bytes: int) -> DataFrame:
    """(qid, vec_id, score) of the best ``k`` in the probed cells; ``asked`` is (qid, embedding, cell)."""
    spark = asked.sparkSession
    pair = f"qid {asked.schema['qid'].dataType.simpleString()}, vec_id long, score double"
    parts = []
    for block in split_blocks(materialize(asked), "qid", block_bytes):
        rows = block.toPandas()  # at most a block
        firsts = rows.drop_duplicates("qid").sort_values("qid")
        qids = firsts["qid"].to_numpy()
        wanted = np.stack(firsts["embedding"].to_list()).astype(np.float64) if len(firsts) else np.empty((0, 0))
        asking: dict[int, np.ndarray] = {}
        for cell, own in rows.groupby("cell"):
            asking[int(cell)] = np.sort(np.searchsorted(qids, own["qid"].to_numpy()))
        shared = spark.sparkContext.broadcast((qids, wanted, asking, index.ranges))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            qids, wanted, asking, ranges = shared.value
            best, costs = BestK(len(qids), k), measure(wanted, ranges)
            for batch in batches:
                cells = batch.column("cell").to_numpy()
                for cell in np.unique(cells).tolist():
                    own = pa.array(np.flatnonzero(cells == cell))
                    ids = batch.column("vec_id").take(own).to_numpy()
                    some = asking[cell]
                    for n, cost in zip(some.tolist(), costs(batch.column(column).take(own), some)):
                        best.offer(n, cost, ids)
            if len(qids):
                found = best.columns(qids, 1.0)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in found], names=["qid", "vec_id", "score"])

        stored = _of_cells(index, list(asking)).select("vec_id", column, "cell")
        parts.append(stored.mapInArrow(run, pair))
    return union_all(parts)


def _of_cells(index: CellIndex, probed: list[int]) -> DataFrame:
    """The partitions of the probed cells; there are no more cells than centroids, which are held here anyway."""
    return index.vectors.filter(F.col("cell").isin(probed))


def _best(found: DataFrame, k: int) -> DataFrame:
    ranked = topk_per(found, "qid", [F.col("score"), F.col("vec_id")], k)
    return ranked.withColumn("score", F.round("score", SCORE_DIGITS))


def search(questions: DataFrame, index: CellIndex, k: int, nprobe: int = 1, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Best ``k`` by squared L2 among the vectors of the ``nprobe`` nearest cells: (qid, vec_id, score, rank)."""
    asked = probes(questions, index.centroids, nprobe)
    return _best(_probed(index, asked, k, "embedding", _Exact, block_bytes), k)


def search_codes(
    questions: DataFrame,
    index: CellIndex,
    k: int,
    nprobe: int = 1,
    factor: int = 4,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """As ``search``, by codes first: the best ``k * factor`` of each question are then ranked exactly."""
    asked = materialize(probes(questions, index.centroids, nprobe))
    near = topk_per(
        _probed(index, asked, k * factor, "codes", _ByCodes, block_bytes), "qid", [F.col("score"), F.col("vec_id")], k * factor
    ).select("qid", "vec_id")
    near = materialize(near)
    ids = broadcast_if_small(near.select("vec_id").distinct())
    probed = [r.cell for r in asked.select("cell").distinct().collect()]
    stored = _of_cells(index, probed).join(ids, "vec_id").select("vec_id", "embedding")
    wanted = asked.select("qid", F.col("embedding").alias("q")).dropDuplicates(["qid"])
    pairs = near.join(broadcast_if_small(wanted), "qid").join(stored, "vec_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b = (dense._as_matrix(batch.column(c)) for c in ("q", "embedding"))
                cost = np.maximum((a**2).sum(1) + (b**2).sum(1) - 2 * (a * b).sum(1), 0.0)
                score = pa.array(np.round(cost, RANK_DIGITS))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("qid"), batch.column("vec_id"), score], names=["qid", "vec_id", "score"]
                )

    kind = questions.schema["qid"].dataType.simpleString()
    exact = pairs.select("qid", "vec_id", "q", "embedding").mapInArrow(run, f"qid {kind}, vec_id long, score double")
    return _best(exact, k)
