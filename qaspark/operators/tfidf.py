"""TF-IDF vectors over unigrams and bigrams, and cosine retrieval with them."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, Window as W

from qaspark.functions.tokens import Scheme
from qaspark.operators.grams import joined_words, known_terms, most_frequent
from qaspark.operators.termindex import (
    forward_index,
    pieces,
    postings,
    question_terms,
    rank_documents,
    rank_pairs,
    score_blocks,
)
from qaspark.plans.broadcasts import BLOCK_BYTES, broadcast_if_small, measured_bytes
from qaspark.plans.select import largest
from qaspark.session import bound_batches, store

MAX_FEATURES = 50_000


@dataclass(frozen=True)
class TfidfModel:
    vocabulary: DataFrame  # term, cf, df, idf
    forward: DataFrame  # doc_id, length, terms (of the vocabulary, if that can be broadcast)
    documents: int
    scheme: Scheme = "space"
    lower: bool = True
    bigrams: bool = True


def term_statistics(forward: DataFrame) -> DataFrame:
    """(term, cf, df): occurrences in the corpus and number of documents."""
    return (
        postings(forward)
        .groupBy("term")
        .agg(F.sum("tf").alias("cf"), F.count(F.lit(1)).alias("df"))
    )


def smooth_idf(documents: int, df: Column) -> Column:
    return F.ln(F.lit(1.0 + documents) / (df + 1)) + 1


def fit(
    corpus: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    max_features: int = MAX_FEATURES,
    scheme: Scheme = "space",
    lower: bool = True,
    bigrams: bool = True,
) -> TfidfModel:
    """Keep the ``max_features`` most frequent terms (ties by term).

    The forward index then holds these terms only, unless they are too many to broadcast. Tokens of a callable
    scheme may hold spaces, so that a token may equal a pair: those are counted by name.
    """
    if callable(scheme):
        forward = store(forward_index(corpus, doc_id, text, scheme, lower, bigrams), "grams")
        best = largest(store(term_statistics(forward), "terms"), "cf", ["term"], max_features)
        documents = forward.count()
    else:
        bound_batches(corpus.sparkSession)
        joined = store(joined_words(corpus, doc_id, text, scheme, lower), "joined")
        best = most_frequent(joined, bigrams, max_features)
        documents = joined.count()
    vocabulary = store(best.withColumn("idf", smooth_idf(documents, F.col("df"))), "vocabulary")
    if not callable(scheme):
        small = measured_bytes(vocabulary.select("term", "idf")) <= BLOCK_BYTES
        # the joined words cut into tokens again where they were joined
        whole = forward_index(joined, "doc_id", "words", "space", False, bigrams)
        forward = store(known_terms(joined, vocabulary, bigrams) if small else whole, "grams")
    return TfidfModel(vocabulary, forward, documents, scheme, lower, bigrams)


def _normalised(counts: DataFrame, key: str, model: TfidfModel) -> DataFrame:
    """L2-normalised weights of (key, term, tf) rows; what one key holds stays in one task."""
    weighted = (
        counts.join(broadcast_if_small(model.vocabulary.select("term", "idf")), "term")
        .select(key, "term", (F.col("tf") * F.col("idf")).alias("raw"), "idf")
        .repartition(key)
    )
    norm = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(W.partitionBy(key)))
    return weighted.select(key, "term", "idf", (F.col("raw") / norm).alias("weight"))


def _in_rows(forward: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """As ``_normalised`` for keys that have one row each, inside these rows."""
    known = vocabulary.toPandas()  # measured by the caller
    terms = pa.array(known["term"].to_numpy(object), pa.string())
    shared = forward.sparkSession.sparkContext.broadcast((terms, known["idf"].to_numpy(np.float64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, idf = shared.value
        for batch in pieces(batches, "words"):
            lists = batch.column("words")
            number = pc.index_in(lists.flatten(), value_set=terms)
            at = np.flatnonzero(number.is_valid().to_numpy(zero_copy_only=False))
            of_row = np.repeat(np.arange(batch.num_rows), lists.value_lengths().fill_null(0).to_numpy())[at]
            ids = number.fill_null(0).to_numpy()[at]
            raw = batch.column("counts").flatten().to_numpy()[at] * idf[ids]
            norm = np.sqrt(np.bincount(of_row, raw * raw, batch.num_rows))
            columns = [batch.column("doc_id").take(pa.array(of_row)), terms.take(pa.array(ids))]
            columns += [pa.array(idf[ids]), pa.array(raw / norm[of_row])]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "term", "idf", "weight"])

    kind = forward.schema["doc_id"].dataType.simpleString()
    lists = forward.select("doc_id", F.col("terms.term").alias("words"), F.col("terms.tf").alias("counts"))
    return lists.mapInArrow(run, f"doc_id {kind}, term string, idf double, weight double")


def transform_corpus(model: TfidfModel, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, term, idf, weight) of the fitted corpus.

    With a vocabulary that can be broadcast, weights are made where the rows lie. Rows that share a
    ``doc_id`` have one norm, so those few meet by shuffle.
    """
    forward, vocabulary = model.forward, model.vocabulary.select("term", "idf")
    if measured_bytes(vocabulary) > block_bytes:
        return _normalised(postings(forward), "doc_id", model)
    bound_batches(forward.sparkSession)
    counted = forward.groupBy("doc_id").agg(F.count(F.lit(1)).alias("_rows")).filter("_rows > 1")
    repeated = store(counted.select(F.col("doc_id").alias("_repeated")), "repeated")
    if repeated.isEmpty():
        return _in_rows(forward, vocabulary)
    few, same = broadcast_if_small(repeated), F.col("doc_id").eqNullSafe(F.col("_repeated"))
    shared = _normalised(postings(forward.join(few, same, "left_semi")), "doc_id", model)
    return _in_rows(forward.join(few, same, "left_anti"), vocabulary).unionByName(shared)


def transform(texts: DataFrame, model: TfidfModel, qid: str = "qid", text: str = "question") -> DataFrame:
    """(qid, term, idf, weight) of new texts."""
    terms = question_terms(texts, qid, text, model.scheme, model.lower, model.bigrams)
    return _normalised(terms.withColumnRenamed("qtf", "tf"), "qid", model)


def _weigh(idf: np.ndarray):
    def weights(terms, counts, of_doc, lengths):
        raw = counts * idf[terms]
        norm = np.sqrt(np.bincount(of_doc, raw * raw, len(lengths)))
        return raw / norm[of_doc]

    return weights


def retrieve(
    questions: DataFrame, model: TfidfModel, k: int, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """Best ``k`` documents of every question by cosine: (qid, doc_id, score, rank).

    The norm of a document needs the whole vocabulary. When that is too large to broadcast, weights
    are joined and summed by shuffles instead.
    """
    asked = transform(questions, model).withColumnRenamed("weight", "qweight")
    vocabulary = model.vocabulary.select("term", "idf")
    if measured_bytes(vocabulary) <= block_bytes:
        return rank_documents(model.forward, asked, k, _weigh, vocabulary, block_bytes)
    documents = transform_corpus(model).drop("idf")
    pairs = score_blocks(
        asked, lambda terms: documents.join(terms, "term", "left_semi"), model.documents, block_bytes
    )
    return rank_pairs(pairs, k)


def oov_questions(questions: DataFrame, model: TfidfModel) -> DataFrame:
    """Questions without a single term of the vocabulary."""
    terms = question_terms(
        questions, scheme=model.scheme, lower=model.lower, bigrams=model.bigrams
    )
    known = terms.join(broadcast_if_small(model.vocabulary.select("term")), "term", "left_semi")
    return questions.join(known.select("qid").distinct(), "qid", "left_anti")
