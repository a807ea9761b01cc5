"""Cells over TF-IDF vectors: spherical k-means on sparse rows, a stored index by cell, search by probes.

A vector is a row (doc_id, ids, weights): numbers of its terms in the vocabulary and their normalised
weights. Weights are made inside the row, and nothing is ever as wide as the vocabulary.

A centroid keeps its ``top`` heaviest terms, normalised again, so all of them are ``n_cells * top`` entries at
most. Kept as postings by term, they are met by just the terms of a row: similarities cost what matches.
One round of training moves a partial sum per task, cell and term; the cut to ``top`` happens on Spark.

Layout of the index: partitioned by ``cell`` and ``part``; a cell beyond ``ROWS`` vectors has several parts, dealt
by hash. A block of questions reads the folders of the cells it probes.

Rows: a vector without a known term is similar to nothing (0) and lies in cell 0; ties go to the
smaller cell; an empty table has no centroids and cannot be trained.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window as W, functions as F

from qaspark.operators import termindex
from qaspark.operators.termindex import RANK_DIGITS, forward_index, postings, rank_pairs
from qaspark.operators.tfidf import TfidfModel
from qaspark.plans.bestk import BestK
from qaspark.plans.broadcasts import BLOCK_BYTES, measured_bytes, split_blocks, union_all
from qaspark.plans.order import row_index
from qaspark.session import materialize, scratch_path, store

TOP = 256  # terms a centroid keeps
SAMPLE = 256  # rows per cell that training looks at, chosen by hash
ROWS = 1 << 18
_SIMILARITIES = 1 << 22  # held at a time


@dataclass(frozen=True)
class Centroids:
    """Postings by term number: ``cells[i]`` holds term ``terms[i]`` with ``weights[i]``."""

    terms: np.ndarray
    cells: np.ndarray
    weights: np.ndarray
    count: int


@dataclass(frozen=True)
class SparseIndex:
    vectors: DataFrame  # doc_id, ids, weights, cell, part
    centroids: Centroids


def numbered_terms(model: TfidfModel) -> DataFrame:
    """(term, idf, number) of the vocabulary, numbered in the order of terms."""
    numbered = row_index(model.vocabulary.select("term", "idf"), ["term"], "number")
    return store(numbered.select("term", "idf", F.col("number").cast("int").alias("number")), "numbered")


def _in_rows(forward: DataFrame, vocabulary: DataFrame) -> DataFrame:
    known = vocabulary.toPandas()  # measured by the caller
    order = np.argsort(known["number"].to_numpy())
    terms = pa.array(known["term"].to_numpy()[order], pa.string())
    shared = forward.sparkSession.sparkContext.broadcast((terms, known["idf"].to_numpy()[order]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, idf = shared.value
        for batch in batches:
            lists = batch.column("words")
            number = pc.index_in(lists.flatten(), value_set=words)
            at = np.flatnonzero(number.is_valid().to_numpy(zero_copy_only=False))
            of_row = np.repeat(np.arange(batch.num_rows), lists.value_lengths().fill_null(0).to_numpy())[at]
            ids = number.fill_null(0).to_numpy()[at].astype(np.int32)
            raw = batch.column("counts").flatten().to_numpy()[at] * idf[ids]
            order = np.lexsort((ids, of_row))
            of_row, ids, raw = of_row[order], ids[order], raw[order]
            norm = np.sqrt(np.bincount(of_row, raw * raw, batch.num_rows))
            offsets = pa.array(np.searchsorted(of_row, np.arange(batch.num_rows + 1)), pa.int32())
            columns = [pa.ListArray.from_arrays(offsets, pa.array(v)) for v in (ids, raw / norm[of_row])]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "ids", "weights"])

    kind = forward.schema["doc_id"].dataType.simpleString()
    lists = forward.select("doc_id", F.col("terms.term").alias("words"), F.col("terms.tf").alias("counts"))
    return lists.mapInArrow(run, f"doc_id {kind}, ids array<int>, weights array<double>")


def _by_shuffle(forward: DataFrame, vocabulary: DataFrame) -> DataFrame:
    raw = postings(forward).join(vocabulary, "term").select("doc_id", "number", (F.col("tf") * F.col("idf")).alias("raw"))
    # the entries of a key are one row of the forward index, so a group is never larger than that
    lists = raw.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("number", "raw"))).alias("own"))
    norm = F.sqrt(F.aggregate("own", F.lit(0.0), lambda total, one: total + one["raw"] * one["raw"]))
    normed = lists.withColumn("norm", norm).select(
        "doc_id", F.col("own.number").alias("ids"), F.transform("own", lambda one: one["raw"] / F.col("norm")).alias("weights")
    )
    empty = F.array().cast("array<int>"), F.array().cast("array<double>")
    return forward.select("doc_id").join(normed, "doc_id", "left").select(
        "doc_id", F.coalesce("ids", empty[0]).alias("ids"), F.coalesce("weights", empty[1]).alias("weights")
    )


def weighted_rows(forward: DataFrame, vocabulary: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, ids, weights) of a forward index, a row each, ids ascending, weights L2-normalised.

    ``vocabulary`` is (term, idf, number). It goes to the rows when its measured size allows that; beyond,
    postings are joined with it, for which ``doc_id`` has to be unique.
    """
    weigh = _in_rows if measured_bytes(vocabulary) <= block_bytes else _by_shuffle
    return weigh(forward, vocabulary)


def corpus_vectors(model: TfidfModel, vocabulary: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    return weighted_rows(model.forward, vocabulary, block_bytes)


def question_vectors(
    questions: DataFrame, model: TfidfModel, vocabulary: DataFrame, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """(qid, ids, weights) of (qid, question) rows."""
    forward = forward_index(questions, "qid", "question", model.scheme, model.lower, model.bigrams)
    return weighted_rows(forward, vocabulary, block_bytes).withColumnRenamed("doc_id", "qid")


def _centroids(entries: DataFrame, top: int, before: Centroids | None = None) -> Centroids:
    """From (cell, number, weight) sums: the ``top`` heaviest terms of each cell, normalised.

    A cell without entries keeps what it had. What comes to the driver is ``top`` entries per cell.
    """
    place = W.partitionBy("cell").orderBy(F.col("weight").desc(), "number")
    rows = entries.withColumn("weight", F.round("weight", RANK_DIGITS)).filter("weight > 0")
    found = rows.withColumn("place", F.row_number().over(place)).filter(F.col("place") <= top).drop("place").toPandas()
    count = int(found["cell"].max()) + 1 if len(found) else 0
    if before is not None:
        old = pd.DataFrame({"cell": before.cells, "number": before.terms, "weight": before.weights})
        found = pd.concat([found, old[~old["cell"].isin(found["cell"])]])
        count = before.count
    cells, terms = found["cell"].to_numpy(np.int64), found["number"].to_numpy(np.int64)
    weights = found["weight"].to_numpy(np.float64)
    weights = weights / np.sqrt(np.bincount(cells, weights * weights, max(count, 1)))[cells]
    order = np.lexsort((cells, terms))
    return Centroids(terms[order], cells[order], weights[order], count)


def _similarities(centroids: Centroids, batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    """(rows x cells) for slices of the batch, from the postings that the rows' terms name."""
    step = max(1, _SIMILARITIES // centroids.count)
    for at in range(0, batch.num_rows, step):
        part = batch.slice(at, step)
        lists = part.column("ids")
        ids, weights = lists.flatten().to_numpy(), part.column("weights").flatten().to_numpy()
        of_row = np.repeat(np.arange(part.num_rows), lists.value_lengths().to_numpy())
        begin = np.searchsorted(centroids.terms, ids, "left")
        size = np.searchsorted(centroids.terms, ids, "right") - begin
        met = np.arange(int(size.sum())) + np.repeat(begin - np.cumsum(size) + size, size)
        place = np.repeat(of_row, size) * centroids.count + centroids.cells[met]
        total = np.bincount(place, np.repeat(weights, size) * centroids.weights[met], part.num_rows * centroids.count)
        yield np.round(total, RANK_DIGITS).reshape(part.num_rows, centroids.count)


def _labelled(centroids: Centroids, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Most similar cell of each row, and the similarity."""
    cells, best = [np.empty(0, np.int64)], [np.empty(0)]
    for part in _similarities(centroids, batch):
        near = part.argmax(axis=1)
        cells.append(near)
        best.append(part[np.arange(len(part)), near])
    return np.concatenate(cells), np.concatenate(best)


def seed_centroids(vectors: DataFrame, n_cells: int, top: int = TOP) -> Centroids:
    """The truncated vectors of the ``n_cells`` rows that have terms and the least MD5 of their id."""
    ranked = vectors.filter(F.size("ids") > 0).select("doc_id", F.md5(F.col("doc_id").cast("string")).alias("_mark"))
    chosen = ranked.orderBy("_mark", "doc_id").limit(n_cells)  # ids only
    places = [(row.doc_id, cell) for cell, row in enumerate(chosen.collect())]
    if not places:
        raise ValueError("no vector has a term, so there is nothing to make cells of")
    kind = vectors.schema["doc_id"].dataType.simpleString()
    seeds = vectors.sparkSession.createDataFrame(places, f"doc_id {kind}, cell int")
    own = vectors.join(F.broadcast(seeds), "doc_id").select("cell", F.explode(F.arrays_zip("ids", "weights")).alias("one"))
    return _centroids(own.select("cell", F.col("one.ids").alias("number"), F.col("one.weights").alias("weight")), top)


def _summed(vectors: DataFrame, centroids: Centroids) -> DataFrame:
    """(cell, number, weight): sums of the vectors in each cell, added up in the task first."""
    shared = vectors.sparkSession.sparkContext.broadcast(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, sums = np.empty(0, np.int64), np.empty(0)
        for batch in batches:
            cells, _ = _labelled(shared.value, batch)
            lists = batch.column("ids")
            own = np.repeat(cells, lists.value_lengths().to_numpy()) << 32 | lists.flatten().to_numpy().astype(np.int64)
            every, place = np.unique(np.concatenate([keys, own]), return_inverse=True)
            sums = np.bincount(place, np.concatenate([sums, batch.column("weights").flatten().to_numpy()]), len(every))
            keys = every
        columns = pa.array((keys >> 32).astype(np.int32)), pa.array((keys & 0xFFFFFFFF).astype(np.int32)), pa.array(sums)
        yield pa.RecordBatch.from_arrays(list(columns), ["cell", "number", "weight"])

    parts = vectors.select("ids", "weights").mapInArrow(run, "cell int, number int, weight double")
    return parts.groupBy("cell", "number").agg(F.sum("weight").alias("weight"))


def train(
    vectors: DataFrame, n_cells: int, top: int = TOP, iterations: int = 10, sample: int | None = SAMPLE
) -> Centroids:
    """Spherical k-means on about ``sample`` rows per cell (all with None), chosen by hash of the id.

    Each round reads the rows, so ``vectors`` is best given as stored rows; only a sample is stored here.
    """
    rows = vectors
    if sample is not None:
        share = min(1.0, sample * n_cells / max(vectors.count(), 1))
        if share < 1.0:
            chosen = rows.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)))
            rows = store(chosen, "sample")
    centroids = seed_centroids(rows, n_cells, top)
    for _ in range(iterations):
        centroids = _centroids(_summed(rows, centroids), top, centroids)
    return centroids


def assign(vectors: DataFrame, centroids: Centroids) -> DataFrame:
    """(doc_id, ids, weights, cell, similarity)."""
    shared = vectors.sparkSession.sparkContext.broadcast(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells, best = _labelled(shared.value, batch)
            yield batch.append_column("cell", pa.array(cells, pa.int32())).append_column("similarity", pa.array(best))

    given = vectors.select("doc_id", "ids", "weights")
    kind = vectors.schema["doc_id"].dataType.simpleString()
    return given.mapInArrow(run, f"doc_id {kind}, ids array<int>, weights array<double>, cell int, similarity double")


def build(vectors: DataFrame, centroids: Centroids, path: str | None = None, rows: int = ROWS) -> SparseIndex:
    """Assign and store; ``doc_id`` is a whole number."""
    spark = vectors.sparkSession
    path = path or scratch_path(spark, "sparse-cells")
    whole = F.col("doc_id").cast("long").alias("doc_id")
    placed = materialize(assign(vectors, centroids).select(whole, "ids", "weights", "cell"))
    sizes = placed.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / rows).cast("int").alias("parts"))  # a row per cell
    dealt = placed.join(F.broadcast(sizes), "cell").select(
        "doc_id", "ids", "weights", "cell", F.pmod(F.xxhash64("doc_id"), "parts").cast("int").alias("part")
    )
    dealt.repartition("cell", "part").write.partitionBy("cell", "part").parquet(f"{path}/vectors")
    schema = "doc_id long, ids array<int>, weights array<double>, cell int, part int"
    return SparseIndex(spark.read.schema(schema).parquet(f"{path}/vectors"), centroids)


def probes(questions: DataFrame, centroids: Centroids, nprobe: int) -> DataFrame:
    """(qid, ids, weights, cell): a row for each of the most similar cells of a question."""
    shared = questions.sparkSession.sparkContext.broadcast(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = [np.argsort(-part, axis=1, kind="stable")[:, :nprobe] for part in _similarities(shared.value, batch)]
            if near:
                cells = np.concatenate(near)
                rows = batch.take(pa.array(np.repeat(np.arange(batch.num_rows), cells.shape[1])))
                yield rows.append_column("cell", pa.array(cells.ravel(), pa.int32()))

    kind = questions.schema["qid"].dataType.simpleString()
    given = questions.select("qid", "ids", "weights")
    return given.mapInArrow(run, f"qid {kind}, ids array<int>, weights array<double>, cell int")


class _Some:
    """Some of the questions: their terms, and a ``BestK`` under their own numbers."""

    def __init__(self, best: BestK, numbers: np.ndarray, ids: list[np.ndarray], weights: list[np.ndarray]):
        self.best, self.numbers = best, numbers.tolist()
        sizes = [len(ids[n]) for n in self.numbers]
        # a row's lists come as arrays or as plain lists; the terms that decide are put first
        heavy = [np.argsort(-np.asarray(weights[n], np.float64), kind="stable") for n in self.numbers]
        terms = np.concatenate([np.asarray(ids[n], np.int64)[order] for n, order in zip(self.numbers, heavy)])
        shares = np.concatenate([np.asarray(weights[n], np.float64)[order] for n, order in zip(self.numbers, heavy)])
        self.asked = numbers, np.cumsum([0, *sizes]), terms, shares

    @property
    def k(self) -> int:
        return self.best.k

    @property
    def worst(self) -> np.ndarray:
        return self.best.worst[self.numbers]

    def offer(self, question: int, cost: np.ndarray, ids: np.ndarray) -> None:
        self.best.offer(self.numbers[question], cost, ids)


def search(
    questions: DataFrame, index: SparseIndex, k: int, nprobe: int = 1, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """Best ``k`` by cosine among the documents of the ``nprobe`` most similar cells: (qid, doc_id, score, rank).

    ``questions`` is (qid, ids, weights); documents without a common term are no hits.
    """
    context = questions.sparkSession.sparkContext
    kind = questions.schema["qid"].dataType.simpleString()
    parts = []
    for block in split_blocks(materialize(probes(questions, index.centroids, nprobe)), "qid", block_bytes):
        rows = block.toPandas()  # at most a block
        firsts = rows.drop_duplicates("qid").sort_values("qid")
        qids = firsts["qid"].to_numpy()
        asking = {int(c): np.sort(np.searchsorted(qids, own["qid"].to_numpy())) for c, own in rows.groupby("cell")}
        shared = context.broadcast((qids, firsts["ids"].tolist(), firsts["weights"].tolist(), asking))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            qids, ids, weights, asking = shared.value
            best = BestK(len(qids), k)
            some = {cell: _Some(best, numbers, ids, weights) for cell, numbers in asking.items()}
            for batch in batches:
                cells = batch.column("cell").to_numpy()
                for cell in np.unique(cells).tolist():
                    part = batch.filter(pa.array(cells == cell))
                    lists = part.column("ids")
                    of_doc = np.repeat(np.arange(part.num_rows), lists.value_lengths().to_numpy())
                    terms, own = lists.flatten().to_numpy(), part.column("weights").flatten().to_numpy()
                    docs = part.column("doc_id").to_numpy()
                    termindex._score_batch(some[cell], some[cell].asked, docs, of_doc, terms, own)
            if len(qids):
                columns = [pa.array(c) for c in best.columns(qids, -1.0)]
                yield pa.RecordBatch.from_arrays(columns, names=["qid", "doc_id", "score"])

        # the folders of the probed cells; there are no more cells than centroids
        read = index.vectors.filter(F.col("cell").isin(list(asking))).select("doc_id", "ids", "weights", "cell")
        parts.append(read.mapInArrow(run, f"qid {kind}, doc_id long, score double"))
    return rank_pairs(union_all(parts), k)
