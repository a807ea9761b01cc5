"""Vector operators: embedding, exact search, coarse cells, quantisation, pooling.

Search is a block product: each task multiplies its batches of stored vectors with a broadcast block
of questions of measured size and keeps its own best k per question, so what is exchanged is k rows
per question and task, and a cell that holds a third of all vectors is just more batches.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, functions as F, types as T

from qaspark.functions.tokens import Scheme
from qaspark.functions.vectors import hash_int
from qaspark.operators.termindex import forward_index
from qaspark.plans.bestk import BestK
from qaspark.plans.broadcasts import BLOCK_BYTES, split_blocks, union_all
from qaspark.plans.topk import topk_per
from qaspark.session import materialize

RANK_DIGITS = 12  # costs are compared to this precision
SCORE_DIGITS = 6  # of the output
_SLICE = 512  # questions multiplied with one batch of vectors at a time

Encoder = Callable[[Sequence[str]], np.ndarray]


def embed(
    texts: DataFrame, key: str, text: str, encoder: Callable[[], Encoder], batch: int = 256
) -> DataFrame:
    """(key, embedding) by an external encoder; ``encoder()`` loads it, once per task."""
    schema = T.StructType(
        [texts.schema[key], T.StructField("embedding", T.ArrayType(T.DoubleType()))]
    )

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder()
        for frame in frames:
            for at in range(0, len(frame), batch):
                part = frame.iloc[at : at + batch]
                vectors = np.asarray(encode(part[text].tolist()), dtype=np.float64)
                yield pd.DataFrame({key: part[key].to_numpy(), "embedding": list(vectors)})

    return texts.select(key, text).mapInPandas(run, schema)


def hash_embed(
    texts: DataFrame, key: str = "doc_id", text: str = "text", dim: int = 64, scheme: Scheme = "space"
) -> DataFrame:
    """(doc_id, embedding) by signed term hashing, L2-normalised.

    Counting and hashing are native; a batch of rows is added up with one ``bincount``.
    """

    def accumulate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buckets, values = batch.column("bucket"), batch.column("value")
            rows = np.repeat(np.arange(batch.num_rows), buckets.value_lengths().to_numpy())
            flat = rows * dim + buckets.flatten().to_numpy()
            dense = np.bincount(flat, values.flatten().to_numpy(), batch.num_rows * dim)
            dense = dense.astype(np.float64).reshape(batch.num_rows, dim)
            norm = np.linalg.norm(dense, axis=1, keepdims=True)
            dense /= np.where(norm == 0, 1, norm)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), _as_lists(dense)], names=["doc_id", "embedding"]
            )

    hashed = forward_index(texts, key, text, scheme).select(
        "doc_id",
        F.transform(
            "terms",
            lambda t: F.struct(hash_int(t["term"]).alias("h"), t["tf"].cast("double").alias("tf")),
        ).alias("h"),
    )
    bucket = F.transform("h", lambda t: t["h"] % dim)
    value = F.transform(
        "h",
        lambda t: F.when(F.call_function("div", t["h"], F.lit(dim)) % 2 == 0, t["tf"]).otherwise(-t["tf"]),
    )
    kind = texts.schema[key].dataType.simpleString()
    lists = hashed.select("doc_id", bucket.alias("bucket"), value.alias("value"))
    return lists.mapInArrow(accumulate, f"doc_id {kind}, embedding array<double>")


def _as_lists(matrix: np.ndarray) -> pa.ListArray:
    rows, width = matrix.shape
    offsets = pa.array(np.arange(rows + 1) * width, pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.array(matrix.ravel()))


def _as_matrix(lists: pa.ListArray) -> np.ndarray:
    """Rows of one width as a matrix, without going through Python objects."""
    return lists.flatten().to_numpy().astype(np.float64).reshape(len(lists), -1)


def _costs(vectors: np.ndarray, block: np.ndarray, metric: str) -> np.ndarray:
    """(questions x vectors) rounded costs, smaller is better."""
    product = block @ vectors.T
    if metric == "dot":
        return -np.round(product, RANK_DIGITS)
    squares = (block**2).sum(axis=1)[:, None] + (vectors**2).sum(axis=1)[None, :]
    return np.round(np.maximum(squares - 2 * product, 0.0), RANK_DIGITS)


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64)


def _search(
    vectors: DataFrame,
    questions: DataFrame,
    k: int,
    metric: str,
    probes: Callable[[np.ndarray], np.ndarray] | None,
    block_bytes: int,
) -> DataFrame:
    """Best ``k`` vectors per question; ``probes`` gives the cells (questions x nprobe) to look at."""
    sign = -1.0 if metric == "dot" else 1.0
    pair = f"qid {questions.schema['qid'].dataType.simpleString()}, vec_id long, score double"
    questions = materialize(questions)  # measured, then collected block by block
    parts = []
    for block in split_blocks(questions, "qid", block_bytes):
        rows = block.toPandas()  # a block is at most ``block_bytes`` large
        if rows.empty:
            continue
        qids, matrix = rows["qid"].to_numpy(), _matrix(rows["embedding"])
        cells = None if probes is None else probes(matrix)
        asked = vectors.sparkSession.sparkContext.broadcast((qids, matrix, cells))

        def offer_all(best, numbers, wanted, stored, keys):
            for at in range(0, len(numbers), _SLICE):
                some = numbers[at : at + _SLICE]
                for question, cost in zip(some, _costs(stored, wanted[some], metric)):
                    best.offer(question, cost, keys)

        def scan(batches: Iterator[pa.RecordBatch], asked=asked) -> Iterator[pa.RecordBatch]:
            ids, wanted, cells = asked.value
            best = BestK(len(ids), k)
            for batch in batches:
                if not batch.num_rows:
                    continue
                keys, stored = batch.column("vec_id").to_numpy(), _as_matrix(batch.column("embedding"))
                if cells is None:
                    offer_all(best, np.arange(len(ids)), wanted, stored, keys)
                    continue
                of_row = batch.column("cell").to_numpy()
                for cell in np.unique(of_row):
                    inside = of_row == cell
                    probing = np.flatnonzero((cells == cell).any(axis=1))
                    offer_all(best, probing, wanted, stored[inside], keys[inside])
            found = [pa.array(column) for column in best.columns(ids, sign)]
            yield pa.RecordBatch.from_arrays(found, names=["qid", "vec_id", "score"])

        columns = [F.col("vec_id").cast("long").alias("vec_id"), "embedding"]
        stored = vectors
        if cells is not None:
            columns.append("cell")
            stored = vectors.filter(F.col("cell").isin([int(c) for c in np.unique(cells)]))
        parts.append(stored.select(*columns).mapInArrow(scan, pair))
    if not parts:
        return vectors.sparkSession.createDataFrame([], pair + ", rank int")
    better = F.col("score").desc() if metric == "dot" else F.col("score").asc()
    best = [topk_per(part, "qid", [better, F.col("vec_id")], k) for part in parts]
    return union_all([part.withColumn("score", F.round("score", SCORE_DIGITS)) for part in best])


def retrieve_dense(
    questions: DataFrame, vectors: DataFrame, k: int, metric: str = "dot", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """Exact search: (qid, vec_id, score, rank), by dot product or by squared L2 distance.

    ``questions`` is (qid, embedding), ``vectors`` is (vec_id, embedding).
    """
    if metric not in ("dot", "l2"):
        raise ValueError(f"unknown metric: {metric}")
    return _search(vectors, questions, k, metric, None, block_bytes)


# --- coarse cells ---------------------------------------------------------------------------


def train_cells(vectors: DataFrame, n_cells: int = 64, seed: int = 0, iterations: int = 20) -> np.ndarray:
    """Centroids (n_cells x dim) by distributed k-means."""
    features = vectors.select(array_to_vector("embedding").alias("features"))
    model = KMeans(k=n_cells, seed=seed, maxIter=iterations).fit(features)
    return np.stack(model.clusterCenters())


def mean_vectors(vectors: DataFrame, key: str, dim: int) -> DataFrame:
    """(key, n, embedding): element-wise mean per key; partial sums are ``dim`` numbers wide."""
    means = [F.avg(F.get("embedding", F.lit(i)).cast("double")) for i in range(dim)]
    return vectors.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.array(*means).alias("embedding"))


def _nearest(matrix: np.ndarray, centroids: np.ndarray, n: int) -> np.ndarray:
    """Cells by distance, then number: (rows x n)."""
    return np.argsort(_costs(centroids, matrix, "l2"), axis=1, kind="stable")[:, :n]


def assign_cells(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Add the nearest cell to (vec_id, embedding) rows; write the result partitioned by ``cell``."""
    shared = vectors.sparkSession.sparkContext.broadcast(centroids)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cell = _nearest(_as_matrix(batch.column("embedding")), shared.value, 1)[:, 0]
                yield batch.append_column("cell", pa.array(cell, pa.int32()))

    schema = T.StructType([*vectors.schema.fields, T.StructField("cell", T.IntegerType())])
    return vectors.mapInArrow(label, schema)


def ivf_search(
    questions: DataFrame,
    index: DataFrame,
    centroids: np.ndarray,
    k: int,
    nprobe: int = 1,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Best ``k`` by squared L2 among the vectors of the ``nprobe`` nearest cells."""
    return _search(
        index, questions, k, "l2", lambda matrix: _nearest(matrix, centroids, nprobe), block_bytes
    )


# --- quantisation ---------------------------------------------------------------------------


def value_ranges(vectors: DataFrame, dim: int) -> list[tuple[float, float]]:
    """Smallest and largest value per dimension: one row of statistics."""
    value = [F.get("embedding", F.lit(i)).cast("double") for i in range(dim)]
    row = vectors.agg(*[F.min(v) for v in value], *[F.max(v) for v in value]).first()
    return list(zip(row[:dim], row[dim:]))


def sq_encode(vectors: DataFrame, ranges: Sequence[tuple[float, float]], bits: int = 8) -> DataFrame:
    """Add ``codes``: each value on a scale of ``2**bits`` steps of its dimension's range."""
    steps = (1 << bits) - 1
    low = F.array(*[F.lit(float(a)) for a, _ in ranges])
    width = F.array(*[F.lit(float(b - a) or 1.0) for a, b in ranges])
    shifted = F.zip_with("embedding", low, lambda x, a: x.cast("double") - a)
    codes = F.zip_with(shifted, width, lambda x, w: F.round(x / w * steps).cast("int"))
    return vectors.withColumn("codes", codes)


def sq_decode(vectors: DataFrame, ranges: Sequence[tuple[float, float]], bits: int = 8) -> DataFrame:
    """Replace ``embedding`` by what ``codes`` stand for."""
    steps = (1 << bits) - 1
    low = F.array(*[F.lit(float(a)) for a, _ in ranges])
    width = F.array(*[F.lit(float(b - a) or 1.0) for a, b in ranges])
    scaled = F.zip_with("codes", width, lambda c, w: c / F.lit(float(steps)) * w)
    return vectors.withColumn("embedding", F.zip_with(scaled, low, lambda x, a: x + a))


def pool_first(tokens: DataFrame, key: str, pos: str = "pos") -> DataFrame:
    """Vector of the first token per sequence."""
    return tokens.groupBy(key).agg(F.min_by("embedding", pos).alias("embedding"))


def pool_mean(tokens: DataFrame, key: str, dim: int) -> DataFrame:
    return mean_vectors(tokens, key, dim).drop("n")

