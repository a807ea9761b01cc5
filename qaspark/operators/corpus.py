"""Corpus operators: exact deduplication, union, splits, sampling, negatives, attaching texts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from qaspark.functions.vectors import hash_int
from qaspark.operators.prepare import conform
from qaspark.plans.broadcasts import broadcast_if_small, union_all
from qaspark.plans.order import row_index
from qaspark.plans.skewed import join_hot
from qaspark.plans.topk import top_n
from qaspark.session import materialize


def _first_seen(df: DataFrame, text: str, order: str) -> DataFrame:
    """Smallest ``order`` per distinct text, and how many rows have it. Only digests and keys travel,
    and equal texts shrink to one row per map task first, so a text that fills a third of the corpus
    costs no more."""
    return df.groupBy(F.sha2(text, 256).alias("_digest")).agg(
        F.min(order).alias(order), F.count(F.lit(1)).alias("_rows")
    )


def _later_keys(df: DataFrame, text: str, order: str) -> DataFrame:
    """Keys of the rows whose text occurred before: stored, and broadcast if they measure small.

    Texts that occur once are left out before their keys meet anything.
    """
    repeated = _first_seen(df, text, order).filter("_rows > 1").select("_digest", F.col(order).alias("_first"))
    keys = df.select(order, F.sha2(text, 256).alias("_digest"))
    later = keys.join(broadcast_if_small(materialize(repeated)), "_digest")
    return broadcast_if_small(materialize(later.filter(F.col(order) != F.col("_first")).select(order)))


def dedup_corpus(
    df: DataFrame, text: str = "text", order: str = "doc_id", dense_id: str | None = None
) -> DataFrame:
    """Keep the first row of each text by the unique key ``order``; optionally number the rest."""
    if dense_id is None:
        return df.join(_later_keys(df, text, order), order, "left_anti")
    first = _first_seen(df, text, order).select(order)
    return df.join(row_index(first, [order], dense_id), order)


def find_duplicates(df: DataFrame, text: str = "text", order: str = "doc_id") -> DataFrame:
    """Rows whose text occurred before, shortest first."""
    later = _later_keys(df, text, order)
    return df.join(later, order, "left_semi").orderBy(F.length(text), order)


def dedup_effect(df: DataFrame, before: Column, after: Column) -> DataFrame:
    """Number of distinct texts before and after a transformation."""
    tagged = df.select(
        F.explode(
            F.array(
                F.struct(F.lit("before").alias("stage"), F.sha2(before, 256).alias("digest")),
                F.struct(F.lit("after").alias("stage"), F.sha2(after, 256).alias("digest")),
            )
        ).alias("one")
    ).select("one.*")
    return tagged.distinct().groupBy("stage").agg(F.count(F.lit(1)).alias("distinct_texts"))


def augment(base: DataFrame, sources: Sequence[DataFrame]) -> DataFrame:
    """Append further sources, brought to the schema of ``base``; ``split`` is an ordinary column."""
    return union_all([base, *[conform(source, base.schema) for source in sources]])


def split_holdout(df: DataFrame, key: str, parts: int = 10, seed: str = "0") -> DataFrame:
    """Flag exactly ``n // parts`` rows as ``held_out``, chosen by a seeded hash of the unique key."""
    keyed = df.select(key, hash_int(F.concat(F.lit(seed), F.lit(":"), F.col(key))).alias("_hash"))
    ranked = row_index(keyed, ["_hash", key], "_rank")
    size = ranked.count() // parts
    return df.join(ranked.select(key, (F.col("_rank") < size).alias("held_out")), key)


def split_prefix(df: DataFrame, order: Sequence[str], rows: int) -> DataFrame:
    """Flag the first ``rows`` rows under the total order ``order`` as ``in_prefix``.

    Only keys are put in order; the last one inside is found and every row compares itself with it. Nulls
    come first.
    """
    if rows < 1:
        return df.withColumn("in_prefix", F.lit(False))
    keys = row_index(df.select(*order), order)
    last = keys.filter(F.col("row_no") == rows - 1).drop("row_no").first()
    if last is None:
        return df.withColumn("in_prefix", F.lit(True))
    kinds = dict(df.dtypes)
    cut = F.struct(*[F.lit(last[name]).cast(kinds[name]).alias(name) for name in order])
    return df.withColumn("in_prefix", F.struct(*order) <= cut)


def sample_rows(
    df: DataFrame, key: str, n: int, seed: str = "0", replace: bool = False
) -> DataFrame:
    """``n`` rows by seeded hash of the unique key; with replacement, a ``draw`` column counts them."""
    spark = df.sparkSession
    if not replace:
        hashed = df.withColumn("_hash", hash_int(F.concat(F.lit(f"{seed}:"), F.col(key))))
        return top_n(hashed, [F.col("_hash"), F.col(key)], n, [key]).drop("_hash")
    numbered = row_index(df.select(key), [key], "_row")
    size = numbered.count()
    if not size:
        return df.withColumn("draw", F.lit(None).cast("long"))
    draws = spark.range(n).select(
        F.col("id").alias("draw"),
        (hash_int(F.concat(F.lit(f"{seed}:"), F.col("id"))) % size).alias("_row"),
    )
    drawn = broadcast_if_small(materialize(numbered.join(draws, "_row").drop("_row")))
    return df.join(drawn, key)


def sample_negatives(
    questions: DataFrame,
    corpus: DataFrame,
    n: int = 31,
    seed: str = "0",
    question_id: str = "qid",
    doc_id: str = "doc_id",
    title: str = "title",
) -> DataFrame:
    """``n`` distinct passages per question whose title differs from the question's title.

    Passages are numbered in (title, id) order, so one title is one interval of numbers and all
    the others are what is left of the number line. That rest is cut into ``n`` equal strata and
    one passage is drawn by hash from each: no repeats, no rejected draws, no pair of a question
    with every passage. Fewer than ``n`` others: all of them. A title that many questions share meets its
    interval by broadcast.
    """
    numbered = row_index(corpus.select(title, doc_id), [title, doc_id], "_slot")
    spans = numbered.groupBy(title).agg(
        F.min("_slot").alias("_from"), F.count(F.lit(1)).alias("_own")
    )
    size = numbered.count()
    rest = F.lit(size) - F.col("_own")
    strata = F.least(F.lit(n).cast("long"), F.col("_rest"))
    draws = (
        join_hot(questions.select(question_id, title), spans, title)
        .fillna(0, ["_from", "_own"])
        .withColumn("_rest", rest)
        .filter("_rest > 0")
        .withColumn("_strata", strata)
        .withColumn("cand_no", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_strata"))))
        .withColumn("_low", F.expr("(cand_no - 1) * _rest div _strata"))
        .withColumn("_high", F.expr("cand_no * _rest div _strata"))
    )
    draw = F.concat_ws(":", F.lit(seed), F.col(question_id), F.col("cand_no"))
    place = F.col("_low") + hash_int(draw) % (F.col("_high") - F.col("_low"))
    slot = F.when(place < F.col("_from"), place).otherwise(place + F.col("_own"))
    return (
        draws.select(question_id, "cand_no", slot.alias("_slot"))
        .join(numbered, "_slot")
        .select(question_id, "cand_no", doc_id, title)
    )


def attach_text(hits: DataFrame, corpus: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Passages next to their ids.

    The hits are computed and measured first: while they fit a broadcast, the corpus is only
    scanned and its texts are not shuffled.
    """
    return corpus.join(broadcast_if_small(materialize(hits)), doc_id)


def attach_gold(
    answers: DataFrame, qa: DataFrame, key: str, columns: Mapping[str, str]
) -> DataFrame:
    """Put the gold columns (old name to new name) next to a retrieval result; keeps all its rows."""
    gold = qa.select(key, *[F.col(old).alias(new) for old, new in columns.items()])
    return answers.join(gold, key, "left")


def concat_context(hits: DataFrame, questions: DataFrame, key: str = "qid") -> DataFrame:
    """One row per question: its passages in rank order, joined by one space.

    ``hits`` carries (key, rank, text) and is already cut to k passages per question. A question
    without passages keeps its row with an empty context.
    """
    ordered = F.sort_array(F.collect_list(F.struct("rank", "text")))
    joined = hits.groupBy(key).agg(F.array_join(ordered.getField("text"), " ").alias("context"))
    return questions.join(joined, key, "left").fillna("", ["context"])
