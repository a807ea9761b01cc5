"""Toxicity by a weighted finite-state pattern grammar over clauses.

Words carry symbols: insult, threat, target, negation, reported speech. One small transducer each
tracks how long a target, a negation, a threat or a reporting verb stays in force; they are composed
into one table, which reads a clause from left to right and emits what kind of match an insult or a
threat is: plain, aimed at a target, negated, or reported. A document's features are the weights
emitted of each kind over all its clauses, and a logistic model, fitted on labelled documents, turns
them into a score. A word alone scores nothing: the kind of clause it stands in decides its weight.

The insult patterns are seed words of four languages, and words and word beginnings learned from
labelled documents: those found in many more toxic than clean ones, weighted by log odds. Every word
of a text is looked up by hash, for all texts of a block at once; only clauses that hold an insult or
a threat are read by the grammar.

The fit uses about ``labelled.SAMPLE_ROWS`` labelled documents at most; scoring reads every text whole.
Patterns and weights are what that sample supports, so their number is bounded by it.

Rows: null and empty texts have no clauses and get the score of a document without matches; without
labels the prior weights score alone; repeated rows score alike; columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import astuple, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from qaspark.llm.flat import SpanHash, blocks, byte_class, flat_bytes, fold_case, words_of
from qaspark.llm.labelled import fit_logistic, held_out, sigmoid, training_sample

THRESHOLD = 0.7
LETTER = byte_class((0x27, 0x27), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
CLAUSE_END = byte_class((0x0A, 0x0A), (0x21, 0x21), (0x2E, 0x2E), (0x3A, 0x3B), (0x3F, 0x3F))
BEGINNINGS = (4, 5, 6, 7)  # bytes
MIN_SHARE = 0.01  # of the toxic documents of the sample that have a learned pattern
MIN_ODDS = 3.0  # natural log

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)
SEEDS = {
    INSULT: "idiot idiots moron morons imbecile stupid dumb fool loser losers scum trash garbage "
    "worthless pathetic disgusting clown vermin coward liar jerk dummkopf trottel abschaum wertlos "
    "erbärmlich widerlich imbécile crétin minable ordure abruti imbécil estúpido basura inútil asqueroso",
    THREAT: "kill hurt destroy beat smash burn shoot stab töten umbringen schlagen verbrennen tuer "
    "frapper brûler détruire matar golpear quemar destruir",
    TARGET: "you your yours he she they them him her his people du dich dein ihr sie er euch tu toi ton "
    "vous il elle ils eux tú ti usted ustedes ellos ella él",
    NEGATION: "not no never isn't aren't wasn't don't doesn't nicht kein keine nie pas jamais aucun nunca "
    "jamás ningún",
    REPORT: "said says wrote claimed quoted reported sagte schrieb behauptete dit écrit affirme dijo "
    "escribió afirmó",
}
PLAIN, AIMED, NEGATED, REPORTED, THREATENED, DAMPED = range(6)
KINDS = 6
PRIOR = np.array([-3.0, 1.0, 1.5, 0.3, 0.3, 1.5, 0.3, 1.0])


def compose() -> tuple[np.ndarray, np.ndarray]:
    """(next state, emitted kind or -1) by state and symbol of the composed transducers.

    The parts, each a counter of words still in its scope: negation 3, target 5, threat 4, and a
    reporting verb up to the end of the clause.
    """
    scopes = (4, 6, 5, 2)  # negation, target, threat, report
    size = int(np.prod(scopes))
    step = np.zeros((size, 6), np.int32)
    emit = np.full((size, 6), -1, np.int8)
    for state in range(size):
        negation, target, threat, report = (int(v) for v in np.unravel_index(state, scopes))
        for symbol in range(6):
            n, g, t = max(negation - 1, 0), max(target - 1, 0), max(threat - 1, 0)
            r = report
            if symbol == NEGATION:
                n = 3
            elif symbol == REPORT:
                r = 1
            elif symbol == THREAT:
                t = 4
            elif symbol == TARGET:
                g = 5
                if threat:  # a threat finds its target
                    emit[state, symbol] = DAMPED if negation or report else THREATENED
                    t = 0
            elif symbol == INSULT:
                emit[state, symbol] = (
                    NEGATED if negation else REPORTED if report else AIMED if target else PLAIN
                )
            step[state, symbol] = np.ravel_multi_index((n, g, t, r), scopes)
    return step, emit


def _hasher() -> SpanHash:
    return SpanHash(fold_case(), 21)


def _spans(content: np.ndarray, offsets: np.ndarray, hasher: SpanHash):
    """Words with the hashes of the word and of its beginnings (0 where the word is too short)."""
    starts, ends, owner = words_of(content, offsets, LETTER)
    hashes = [hasher(content, starts, ends)]
    for size in BEGINNINGS:
        # the hash of a beginning has its own length mixed in, and one bit more than a word's
        long = ends - starts > size
        found = np.zeros(len(starts), np.uint64)
        found[long] = ~hasher(content, starts[long], starts[long] + size)
        hashes.append(found)
    return starts, ends, owner, hashes


def pattern_counts(sample: DataFrame) -> DataFrame:
    """(pattern, toxic, clean): labelled documents that hold each word and each word beginning."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = _hasher()
        for batch in batches:
            y, at = batch.column(1).to_numpy(zero_copy_only=False), 0
            for block in blocks(batch.column(0)):
                content, offsets = flat_bytes(block)
                _, _, owner, hashes = _spans(content, offsets, hasher)
                pattern, text = np.concatenate(hashes), np.tile(owner, len(hashes))
                order = np.lexsort((text, pattern))
                pattern, text = pattern[order], text[order]
                new = np.ones(len(pattern), bool)
                new[1:] = (pattern[1:] != pattern[:-1]) | (text[1:] != text[:-1])
                pattern, toxic = pattern[new], y[at + text[new]] > 0
                names, first = np.unique(pattern, return_index=True)
                if len(names):
                    sums = [np.add.reduceat(x.astype(np.int64), first) for x in (toxic, ~toxic)]
                    columns = [names.view(np.int64), *sums]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["pattern", "toxic", "clean"])
                at += len(block)

    rows = sample.select("text", "y").mapInArrow(count, "pattern long, toxic long, clean long")
    return rows.filter("pattern <> 0").groupBy("pattern").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


@dataclass
class Grammar:
    """Hashes of the patterns with their symbols and weights, and the weights of the kinds."""

    hashes: np.ndarray
    symbols: np.ndarray
    weights: np.ndarray
    model: np.ndarray

    def features(self, texts: pa.Array, hasher: SpanHash, step: np.ndarray, emit: np.ndarray) -> np.ndarray:
        content, offsets = flat_bytes(texts)
        starts, ends, owner, hashes = _spans(content, offsets, hasher)
        count = len(offsets) - 1
        sums = np.zeros((count, KINDS))
        symbols = np.zeros(len(starts), np.int8)
        weights = np.zeros(len(starts))
        for found in reversed(hashes):  # the word itself decides last
            at = np.minimum(np.searchsorted(self.hashes, found), len(self.hashes) - 1)
            hit = self.hashes[at] == found
            # an insult by word or beginning takes the larger weight; seeds of other symbols win
            symbols[hit] = self.symbols[at[hit]]
            weights[hit] = np.maximum(weights[hit], self.weights[at[hit]])
        if len(starts):
            ends_before = np.concatenate(([0], np.cumsum(CLAUSE_END[content])))[starts]
            new = np.ones(len(starts), bool)
            new[1:] = (ends_before[1:] != ends_before[:-1]) | (owner[1:] != owner[:-1])
            begins = np.flatnonzero(new)
            loud = np.logical_or.reduceat((symbols == INSULT) | (symbols == THREAT), begins)
            stops = np.append(begins[1:], len(starts))
            for a, b in zip(begins[loud].tolist(), stops[loud].tolist()):
                state, text = 0, owner[a]
                for symbol, weight in zip(symbols[a:b].tolist(), weights[a:b].tolist()):
                    kind = emit[state, symbol]
                    if kind >= 0:
                        sums[text, kind] += weight
                    state = step[state, symbol]
        words = np.bincount(owner, minlength=count)
        density = sums[:, [PLAIN, AIMED, THREATENED]].sum(1) * 10 / np.maximum(words, 10)
        return np.column_stack((np.ones(count), np.log1p(sums), np.log1p(density)))


def _seeds(hasher: SpanHash) -> list[tuple[int, int, float]]:
    rows = []
    for symbol, words in SEEDS.items():
        content, offsets = flat_bytes(pa.array(words.split()))
        for value in hasher(content, offsets[:-1], offsets[1:]).tolist():
            rows.append((value, symbol, 3.0))
    return rows


def fit(sample: DataFrame) -> Grammar:
    """Patterns and weights from (text, y) rows."""
    size = sample.agg(F.count(F.lit(1)), F.coalesce(F.sum("y"), F.lit(0.0))).first()
    toxic, clean = float(size[1]), float(size[0] - size[1])
    odds = F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("clean") + 0.5) / (clean + 1))
    learned = (
        pattern_counts(sample)
        .filter(F.col("toxic") >= max(2.0, MIN_SHARE * toxic))
        .select("pattern", odds.alias("odds"))
        .filter(F.col("odds") >= MIN_ODDS)
        .collect()  # patterns of at least MIN_SHARE of a bounded sample
    )
    table = {row.pattern & (1 << 64) - 1: (INSULT, float(row.odds)) for row in learned}
    for value, symbol, weight in _seeds(_hasher()):
        if symbol == INSULT or value not in table:
            table[value] = symbol, max(weight, table.get(value, (0, 0.0))[1])
    names = sorted(table)
    grammar = Grammar(
        np.array(names, np.uint64),
        np.array([table[n][0] for n in names], np.int8),
        np.array([table[n][1] for n in names]),
        PRIOR.copy(),
    )
    rows = _featured(sample, grammar).select("_features", "y").collect()
    if rows:
        x, y = np.array([r[0] for r in rows]), np.array([r.y for r in rows])
        grammar.model = fit_logistic(x, y, PRIOR)
    return grammar


def _featured(rows: DataFrame, grammar: Grammar) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(astuple(grammar))

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own, hasher, tables = Grammar(*shared.value), _hasher(), compose()
        for batch in batches:
            out = [pa.array([], pa.list_(pa.float64()))]
            out += [pa.array(list(own.features(b, hasher, *tables)), pa.list_(pa.float64())) for b in blocks(batch)]
            yield pa.concat_arrays(out)

    return rows.withColumn("_features", F.arrow_udf(run, "array<double>")(F.col("text")))


def score(docs: DataFrame, grammar: Grammar, text: str = "text", to: str = "score") -> DataFrame:
    """Add ``to``: 0 to 1, higher where the document is likelier toxic."""
    shared = docs.sparkSession.sparkContext.broadcast(astuple(grammar))

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own, hasher, tables = Grammar(*shared.value), _hasher(), compose()
        for batch in batches:
            out = [sigmoid(own.features(b, hasher, *tables) @ own.model) for b in blocks(batch)]
            yield pa.array(np.concatenate([np.empty(0), *out]))

    return docs.withColumn(to, F.arrow_udf(run, "double")(F.col(text)))


def fit_on(docs: DataFrame, labels: DataFrame) -> Grammar:
    sample = training_sample(docs, labels, "toxic", 3, 1).cache()
    grammar = fit(sample)
    sample.unpersist()
    return grammar


def reject(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score below ``threshold``, as they are."""
    rows = docs.select(F.struct("*").alias("row"), F.col("text").alias("text"))
    return score(rows, fit_on(docs, labels)).filter(F.col("score") < threshold).select("row.*")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: a score of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return score(docs, fit_on(docs, labels)).select(
        "doc_id",
        held_out("doc_id", 3, 1).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
