"""From start and end logits to n-best answers.

Pairs are formed and cut to the n best chunk by chunk, so a chunk hands on at most n rows,
and an example at most n of them per task, however many chunks its context has.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from qaspark.functions.bind import let
from qaspark.plans.topk import topk_per
from qaspark.session import bound_batches

N_BEST, MAX_ANSWER = 20, 30
_CELLS = 1 << 20  # pairs looked at together

# what a candidate is ordered by, then what it is made of
_SPAN = ["cost", "no_answer", "chunk_no", "start_rank", "end_rank"]
_SPAN += ["start_logit", "end_logit", "s", "e"]
_ENTRY = "array<struct<text:string,start_logit:double,end_logit:double,score:double>>"


def _best_positions(logits: pa.ListArray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, costs) of the n largest logits of each row, ties by position; position -1 where there are fewer."""
    sizes = logits.value_lengths().fill_null(0).to_numpy().astype(np.int64)
    begin = np.cumsum(sizes) - sizes
    costs = -logits.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    of_row = np.repeat(np.arange(len(sizes)), sizes)
    order = np.lexsort((costs, of_row))  # stable, so ties stay by position
    place = np.arange(len(order)) - begin[of_row]
    near = place < n
    at = order[near]
    positions, best = np.full((len(sizes), n), -1, np.int64), np.zeros((len(sizes), n))
    positions[of_row[near], place[near]] = at - begin[of_row[near]]
    best[of_row[near], place[near]] = costs[at]
    return positions, best


def _looked_up(lists: pa.ListArray, positions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(whether there is such an element, its place in the flattened list) of positions by row."""
    sizes = lists.value_lengths().fill_null(0).to_numpy().astype(np.int64)[:, None]
    inside = (positions >= 0) & (positions < sizes)
    begin = np.cumsum(sizes)[:, None] - sizes
    return inside, np.where(inside, begin + positions, 0)


def _elements(values: np.ndarray, inside: np.ndarray, at: np.ndarray, missing) -> np.ndarray:
    return np.where(inside, values[at], missing) if len(values) else np.full(at.shape, missing)


def _pairs(batch: pa.RecordBatch, n: int, longest: int) -> pa.RecordBatch:
    """Valid (start, end) pairs of each row, best first, at most n."""
    starts, start_costs = _best_positions(batch.column("start_logits"), n)
    ends, end_costs = _best_positions(batch.column("end_logits"), n)
    spans = batch.column("offsets")
    flat = spans.flatten()
    known = flat.is_valid().to_numpy(zero_copy_only=False)
    first, last = (flat.field(name).fill_null(0).to_numpy() for name in ("s", "e"))
    start_in, start_at = _looked_up(spans, starts)
    end_in, end_at = _looked_up(spans, ends)
    may_start = _elements(known, start_in, start_at, False)
    may_end = _elements(known, end_in, end_at, False)
    if "fresh" in batch.schema.names:
        flags = batch.column("fresh")
        allowed = flags.flatten().fill_null(False).to_numpy(zero_copy_only=False)
        may_start &= _elements(allowed, *_looked_up(flags, starts), False)
    length = ends[:, None, :] - starts[:, :, None]
    valid = may_start[:, :, None] & may_end[:, None, :] & (length >= 0) & (length < longest)
    # by row, then cost; what comes in order of both ranks stays so among equals
    row, a, b = np.nonzero(valid)
    cost = start_costs[row, a] + end_costs[row, b]
    order = np.lexsort((cost, row))
    row, a, b, cost = row[order], a[order], b[order], cost[order]
    counts = np.bincount(row, minlength=batch.num_rows)
    near = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts) < n
    row, a, b, cost = row[near], a[near], b[near], cost[near]
    columns = {
        "id": batch.column("id").take(pa.array(row)),
        "no_answer": pa.array(np.zeros(len(row), np.int32)),
        "chunk_no": batch.column("chunk_no").take(pa.array(row)),
        "cost": pa.array(cost),
        "start_rank": pa.array(a, pa.int32()),
        "end_rank": pa.array(b, pa.int32()),
        "start_logit": pa.array(-start_costs[row, a]),
        "end_logit": pa.array(-end_costs[row, b]),
        "s": pa.array(first[start_at[row, a]], pa.int32()),
        "e": pa.array(last[end_at[row, b]], pa.int32()),
    }
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def _spans(features: DataFrame, n: int, longest: int, max_context: str | None) -> DataFrame:
    """(id, no_answer, chunk_no, cost, ranks, logits, s, e): the pairs of every chunk."""
    bound_batches(features.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(1, _CELLS // (n * n))
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                yield _pairs(batch.slice(at, step), n, longest)

    flags = [F.col(max_context).alias("fresh")] if max_context else []
    offsets = F.col("offsets").cast("array<struct<s:int,e:int>>").alias("offsets")
    logits = [F.col(c).cast("array<double>").alias(c) for c in ("start_logits", "end_logits")]
    given = features.select("id", F.col("chunk_no").cast("int"), offsets, *logits, *flags)
    kind = features.schema["id"].dataType.simpleString()
    ranks = "cost double, start_rank int, end_rank int, start_logit double, end_logit double, s int, e int"
    return given.mapInArrow(run, f"id {kind}, no_answer int, chunk_no int, {ranks}")


def _softmax(entries: Column) -> Column:
    """Add ``probability`` to the entries: softmax of their scores."""

    def weigh(top: Column) -> Column:
        total = F.aggregate(entries, F.lit(0.0), lambda acc, c: acc + F.exp(c["score"] - top))
        return let(
            total,
            lambda z: F.transform(
                entries, lambda c: c.withField("probability", F.exp(c["score"] - top) / z)
            ),
        )

    return let(F.array_max(F.transform(entries, lambda c: c["score"])), weigh)


def decode_spans(
    features: DataFrame,
    examples: DataFrame,
    n_best: int = N_BEST,
    max_answer_len: int = MAX_ANSWER,
    allow_null: bool = False,
    threshold: float = 0.0,
    max_context: str | None = None,
) -> DataFrame:
    """(id, nbest, prediction_text[, null_odds]), one row per example.

    ``features`` is (id, chunk_no, offsets, start_logits, end_logits), offsets by feature position
    and null outside the context; ``max_context`` names a boolean array saying where an answer may
    start. ``examples`` is (id, context); one without any valid span answers ``empty``.
    """
    spans = _spans(features, n_best, max_answer_len, max_context)
    order = [F.col(c) for c in _SPAN[:5]]
    columns = ["id", *_SPAN]
    kept = topk_per(spans.select(*columns), "id", order, n_best, "_rank").drop("_rank")
    if allow_null:
        first = F.get("start_logits", F.lit(0)), F.get("end_logits", F.lit(0))
        none = features.select(
            "id", "chunk_no", first[0].alias("start_logit"), first[1].alias("end_logit")
        ).withColumn("score", F.col("start_logit") + F.col("end_logit"))
        lowest = F.min_by(F.struct("start_logit", "end_logit"), F.struct("score", "chunk_no"))
        none = none.groupBy("id").agg(lowest.alias("low")).select("id", "low.*")
        zero = F.lit(0)
        none = none.select(
            "id",
            (-(F.col("start_logit") + F.col("end_logit"))).alias("cost"),
            F.lit(1).alias("no_answer"),
            *[zero.alias(c) for c in ("chunk_no", "start_rank", "end_rank")],
            "start_logit",
            "end_logit",
            zero.alias("s"),
            zero.alias("e"),
        )
        # one more candidate per example; the cut one comes back last, so at most n + 1 remain
        joined = kept.unionByName(none)
        ranked = topk_per(joined, "id", order, n_best + 1, "_rank")
        kept = ranked.filter((F.col("_rank") <= n_best) | (F.col("no_answer") == 1)).drop("_rank")
    listed = kept.groupBy("id").agg(
        F.sort_array(F.collect_list(F.struct(*_SPAN))).alias("spans")
    )
    return _answers(examples.join(listed, "id", "left"), allow_null, threshold)


def _answers(listed: DataFrame, allow_null: bool, threshold: float) -> DataFrame:
    texts = F.transform(
        "spans",
        lambda p: F.struct(
            F.substring(F.col("context"), p["s"] + 1, p["e"] - p["s"]).alias("text"),
            p["start_logit"].alias("start_logit"),
            p["end_logit"].alias("end_logit"),
            (-p["cost"]).alias("score"),
        ),
    )
    zero = F.lit(0.0)
    fallback = F.array(
        F.struct(
            F.lit("empty").alias("text"),
            zero.alias("start_logit"),
            zero.alias("end_logit"),
            zero.alias("score"),
        )
    )

    def with_fallback(found: Column) -> Column:
        bare = (F.size(found) == 0) | ((F.size(found) == 1) & (F.get(found, F.lit(0))["text"] == ""))
        return F.when(bare, F.concat(fallback, found)).otherwise(found)

    found = F.coalesce(texts.cast(_ENTRY), F.array().cast(_ENTRY))
    null_score = F.get(F.filter("spans", lambda p: p["no_answer"] == 1), F.lit(0))
    rows = listed.select(
        "id",
        let(let(found, with_fallback), _softmax).alias("nbest"),
        (-null_score["cost"]).alias("null_score"),
    )
    if not allow_null:
        best = F.get("nbest", F.lit(0))["text"]
        return rows.select("id", "nbest", best.alias("prediction_text"))
    best = F.get(F.filter("nbest", lambda c: c["text"] != ""), F.lit(0))
    odds = F.col("null_score") - best["start_logit"] - best["end_logit"]
    answer = F.when(odds > threshold, F.lit("")).otherwise(F.coalesce(best["text"], F.lit("")))
    return rows.select("id", "nbest", answer.alias("prediction_text"), odds.alias("null_odds"))


def nbest_rows(decoded: DataFrame) -> DataFrame:
    """(id, rank, text, start_logit, end_logit, score, probability)."""
    rows = decoded.select("id", F.posexplode("nbest").alias("at", "entry"))
    return rows.select("id", (F.col("at") + 1).alias("rank"), "entry.*")


def softmax_over(df: DataFrame, key: str, score: str, name: str = "probability") -> DataFrame:
    """Softmax of ``score`` over the rows of each key, shifted by the largest score.

    Maximum and sum are aggregated per key and joined back, so no task holds a whole key.
    """
    top = df.groupBy(key).agg(F.max(score).alias("_top"))
    shifted = df.join(top, key).withColumn("_w", F.exp(F.col(score) - F.col("_top")))
    total = shifted.groupBy(key).agg(F.sum("_w").alias("_z"))
    return shifted.join(total, key).withColumn(name, F.col("_w") / F.col("_z")).drop("_top", "_w", "_z")
