"""Stored inverted lists for BM25, in impact order with bounds, searched by MaxScore.

Layout: documents are dealt by hash to shards of about ``SHARD`` documents. A row is a part of a term's
list inside a shard: up to ``BLOCK`` postings in order of impact (the share of a score that does not
depend on the question), with the best impact as its bound. A term that stands in every document is
spread over all shards like any other. Rows are partitioned by term bucket, and a file, which holds a few
shards, is sorted by term; a search reads the buckets of its terms. ``stats`` has each term's best impact.

A search brings the parts of the asked terms together by shard (postings of other terms are never read,
documents never moved) and scores each shard in one task against a broadcast block of questions. A
question's terms are taken by falling best gain. The k-th best sum so far is a floor for its k-th best
document; once the gains still to come do not add up to it, no further document can get in, and the
long lists of common words are only looked into for the candidates left. Parts whose bound, with the
best of all other terms, stays below the floor are skipped. The ranking is the exact one.

A question with a negative weight (in corpora so small that the mean inverse frequency is negative) is
scored without a floor.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from qaspark.operators.bm25 import B, K1, Bm25Index, question_weights
from qaspark.operators.termindex import RANK_DIGITS, rank_pairs
from qaspark.plans.bestk import BestK
from qaspark.plans.broadcasts import BLOCK_BYTES, broadcast_if_small, split_blocks, union_all
from qaspark.session import bound_batches, materialize, scratch_path, store

SHARD = 4096
BLOCK = 256
BUCKETS = 64
_TOGETHER = 4  # shards of a task, so files do not get too small
_ROWS = 1 << 14  # rows handed on together
SLACK = 1e-9  # sums in another order differ by less


@dataclass(frozen=True)
class Lists:
    """``parts``: bucket, term, shard, part, size, bound, docs, impacts; ``stats``: term, df, top."""

    parts: DataFrame
    stats: DataFrame


def _bucket(term: Column) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(BUCKETS)).cast("int")


def _inverted(shard: int, given: pa.Table, mean_length: float, block: int) -> Iterator[pa.RecordBatch]:
    """The rows of the lists of one shard, its documents given with their terms."""
    given = given.combine_chunks()
    lists, doc_ids, lengths = (given.column(c).combine_chunks() for c in ("words", "doc_id", "length"))
    coded = lists.flatten().dictionary_encode()
    codes = coded.indices.to_numpy()
    of_doc = np.repeat(np.arange(len(lists)), lists.value_lengths().fill_null(0).to_numpy())
    tf = given.column("counts").combine_chunks().flatten().to_numpy().astype(np.float64)
    saturation = K1 * (1 - B + B * lengths.to_numpy().astype(np.float64) / mean_length)
    impacts = tf * (K1 + 1) / (tf + saturation[of_doc])
    falling = ~doc_ids.fill_null(np.iinfo(np.int64).min).to_numpy()[of_doc]
    order = np.lexsort((falling, -impacts, codes))
    impacts, of_doc = impacts[order], of_doc[order]
    size = np.bincount(codes, minlength=len(coded.dictionary))
    begin = np.cumsum(size) - size
    cuts = -(-size // block)
    term = np.repeat(np.arange(len(size)), cuts)
    part = np.arange(len(term)) - np.repeat(np.cumsum(cuts) - cuts, cuts)
    first = begin[term] + part * block
    offsets = pa.array(np.append(first, len(codes)), pa.int32())
    columns = {
        "term": coded.dictionary.take(pa.array(term)),
        "shard": pa.array(np.full(len(term), shard), pa.int32()),
        "part": pa.array(part, pa.int32()),
        "size": pa.array(np.minimum(begin[term] + size[term] - first, block), pa.int32()),
        "bound": pa.array(impacts[first]),
        "docs": pa.ListArray.from_arrays(offsets, doc_ids.take(pa.array(of_doc))),
        "impacts": pa.ListArray.from_arrays(offsets, pa.array(impacts)),
    }
    rows = pa.RecordBatch.from_arrays(list(columns.values()), list(columns))
    for at in range(0, rows.num_rows, _ROWS):
        yield rows.slice(at, _ROWS)


def list_parts(index: Bm25Index, shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """The rows of the lists, in the order they are stored in.

    Documents move to their shard once, a row each; a shard is inverted in the task it came to, and its
    postings stay there.
    """
    spark = index.forward.sparkSession
    bound_batches(spark)
    shards = -(-max(index.documents, 1) // shard)
    mean_length = index.mean_length
    doc_id = F.col("doc_id").cast("long").alias("doc_id")
    dealt = index.forward.filter(F.size("terms") > 0).select(
        F.pmod(F.xxhash64("doc_id"), F.lit(shards)).cast("int").alias("shard"),
        doc_id, "length", F.col("terms.term").alias("words"), F.col("terms.tf").alias("counts"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = None, []
        for batch in batches:
            numbers = batch.column("shard").to_numpy()
            for at in np.flatnonzero(np.diff(numbers, prepend=-1)).tolist():
                number = int(numbers[at])
                if held and number != current:
                    yield from _inverted(current, pa.Table.from_batches(held), mean_length, block)
                    held = []
                count = int(np.argmax(np.append(numbers[at:] != number, True)))
                current, held = number, [*held, batch.slice(at, count)]
        if held:
            yield from _inverted(current, pa.Table.from_batches(held), mean_length, block)

    tasks = max(spark.sparkContext.defaultParallelism, shards // _TOGETHER)
    kind = "term string, shard int, part int, size int, bound double, docs array<long>, impacts array<double>"
    rows = dealt.repartition(tasks, "shard").sortWithinPartitions("shard").mapInArrow(run, kind)
    return rows.select(_bucket(F.col("term")).alias("bucket"), "*").sortWithinPartitions("bucket", "term", "shard", "part")


def build_lists(index: Bm25Index, path: str | None = None, shard: int = SHARD, block: int = BLOCK) -> Lists:
    """Write the lists below ``path`` (by default the shared folder) and open them."""
    spark = index.forward.sparkSession
    path = path or scratch_path(spark, "lists")
    list_parts(index, shard, block).write.partitionBy("bucket").parquet(f"{path}/parts")
    parts = spark.read.parquet(f"{path}/parts")
    stats = parts.groupBy("term").agg(F.sum("size").alias("df"), F.max("bound").alias("top"))
    stats.write.parquet(f"{path}/stats")
    return open_lists(spark, path)


def open_lists(spark: SparkSession, path: str) -> Lists:
    return Lists(spark.read.parquet(f"{path}/parts"), spark.read.parquet(f"{path}/stats"))


class _Shard:
    """The parts of one shard: lists by term number, documents numbered inside the shard."""

    def __init__(self, rows: list[tuple[int, int, float, np.ndarray, np.ndarray]]):
        self.docs, place = np.unique(np.concatenate([r[3] for r in rows]), return_inverse=True)
        ends = np.cumsum([len(r[3]) for r in rows])
        self.parts: dict[int, list[tuple[float, np.ndarray, np.ndarray]]] = {}
        for (term, _, bound, docs, impacts), end in sorted(zip(rows, ends.tolist()), key=lambda x: x[0][:2]):
            self.parts.setdefault(term, []).append((bound, place[end - len(docs) : end], impacts))
        self.sorted: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def look_up(self, term: int, wanted: np.ndarray) -> np.ndarray:
        """The impacts of the wanted documents in a term's list, zero where they do not have it."""
        if term not in self.sorted:
            parts = self.parts[term]
            places, impacts = np.concatenate([p[1] for p in parts]), np.concatenate([p[2] for p in parts])
            order = np.argsort(places)
            self.sorted[term] = places[order], impacts[order]
        places, impacts = self.sorted[term]
        at = np.minimum(np.searchsorted(places, wanted), len(places) - 1)
        return np.where(places[at] == wanted, impacts[at], 0.0)


def _score(shard: _Shard, terms, weights, tops, floor: float, k: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(document places, scores, postings touched) of those that can be among the best k; terms come by
    falling gain. ``floor`` is what the k-th best found elsewhere has."""
    pruning = bool((weights >= 0).all())
    gains = np.maximum(weights * tops, 0.0)
    total, rest = float(gains.sum()), float(gains.sum())
    sums, met = np.zeros(len(shard.docs)), np.zeros(len(shard.docs), bool)
    touched, some = 0, None
    for term, weight, gain in zip(terms.tolist(), weights.tolist(), gains.tolist()):
        if pruning and some is None and rest < floor - SLACK:
            some = np.flatnonzero(met & (sums + rest >= floor - SLACK))
        rest -= gain
        if term not in shard.parts:
            continue
        if some is not None:
            if len(some):
                sums[some] += weight * shard.look_up(term, some)
                touched += min(len(some), sum(len(p[1]) for p in shard.parts[term]))
                some = some[sums[some] + rest >= floor - SLACK]
            continue
        for bound, places, impacts in shard.parts[term]:
            if pruning and weight * bound + total - gain < floor - SLACK:
                break  # the parts after it are no better
            sums[places] += weight * impacts
            met[places] = True
            touched += len(places)
        if pruning and len(sums) >= k:
            floor = max(floor, float(np.partition(sums, len(sums) - k)[len(sums) - k]))
    if some is None:
        some = np.flatnonzero(met & (sums >= floor - SLACK) if pruning else met)
    return some, sums[some], touched


def _question_block(rows, terms: dict[str, int]) -> list[tuple]:
    """(qid, term numbers, weights, tops) of each question, terms by falling gain."""
    out = []
    for qid, own in rows.groupby("qid", sort=True):
        weights, tops = own["weight"].to_numpy(np.float64), own["top"].to_numpy(np.float64)
        order = np.argsort(-weights * tops, kind="stable")
        numbers = own["term"].map(terms).to_numpy(np.int64)
        out.append((qid, numbers[order], weights[order], tops[order]))
    return out


def retrieve(
    questions: DataFrame,
    index: Bm25Index,
    lists: Lists,
    k: int,
    doc_subset: DataFrame | None = None,
    block_bytes: int = BLOCK_BYTES,
    touched=None,
) -> DataFrame:
    """Best ``k`` documents of every question: (qid, doc_id, score, rank), as ``bm25.retrieve``.

    ``touched``, if given, is a Spark accumulator that counts the postings that were scored.
    """
    spark = index.forward.sparkSession
    kind = questions.schema["qid"].dataType.simpleString()
    weight = (F.col("idf") * F.col("qweight")).alias("weight")
    asked = question_weights(questions, index).select("qid", "term", weight).join(lists.stats.select("term", "top"), "term")
    chosen = None if doc_subset is None else broadcast_if_small(materialize(doc_subset.select(F.col("doc_id").cast("long"))))
    found = []
    for block in split_blocks(store(asked, "asked"), "qid", block_bytes):
        rows = block.toPandas()  # at most a block
        numbers = {term: n for n, term in enumerate(sorted(set(rows["term"])))}
        shared = spark.sparkContext.broadcast(_question_block(rows, numbers))
        names = spark.createDataFrame(list(numbers.items()), "term string, number int")
        buckets = [r.bucket for r in names.select(_bucket(F.col("term")).alias("bucket")).distinct().collect()]
        wanted = lists.parts.filter(F.col("bucket").isin(buckets)).join(F.broadcast(names), "term")
        if chosen is not None:
            wanted = _only(wanted, chosen)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            asked = shared.value
            best = BestK(len(asked), k)
            current, held = None, []

            def settle() -> None:
                shard, count = _Shard(held), 0
                for n, (_, terms, weights, tops) in enumerate(asked):
                    floor = -float(best.cost[n].max()) if len(best.cost[n]) >= k else 0.0
                    places, scores, seen = _score(shard, terms, weights, tops, floor, k)
                    count += seen
                    if len(places):
                        best.offer(n, -np.round(scores, RANK_DIGITS), shard.docs[places])
                if touched is not None:
                    touched.add(count)

            for batch in batches:
                shards = batch.column("shard").to_pylist()
                heads = zip(*(batch.column(c).to_pylist() for c in ("number", "part", "bound")))
                docs, impacts = batch.column("docs"), batch.column("impacts")
                for n, (shard, head) in enumerate(zip(shards, heads)):
                    if shard != current:
                        if held:
                            settle()
                        current, held = shard, []
                    held.append((*head, docs[n].values.to_numpy(), impacts[n].values.to_numpy()))
            if held:
                settle()
            if len(asked):
                qids = np.array([q[0] for q in asked])
                columns = best.columns(qids, -1.0)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["qid", "doc_id", "score"])

        together = (
            wanted.select("shard", "number", "part", "bound", "docs", "impacts")
            .repartition("shard")
            .sortWithinPartitions("shard")
        )
        found.append(rank_pairs(together.mapInArrow(run, f"qid {kind}, doc_id long, score double"), k))
    return union_all(found)


def _only(parts: DataFrame, chosen: DataFrame) -> DataFrame:
    """The parts with the postings of the chosen documents; bounds stay, which is safe."""
    rows = parts.select("term", "number", "shard", "part", "bound", F.explode(F.arrays_zip("docs", "impacts")).alias("one"))
    kept = rows.select("*", F.col("one.docs").alias("doc_id")).join(chosen, "doc_id", "left_semi")
    listed = kept.groupBy("number", "shard", "part", "bound").agg(F.collect_list("one").alias("rest"))
    return listed.select(
        "number", "shard", "part", "bound", F.col("rest.docs").alias("docs"), F.col("rest.impacts").alias("impacts")
    )
