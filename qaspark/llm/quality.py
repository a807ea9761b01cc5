"""Quality score by a byte-level convolutional network, trained and run in numpy.

A document is read as bytes in overlapping chunks of ``2 * HALF`` that cover it from end to end.
Learned filters of ``WIDTH`` bytes run over every position; a chunk keeps the largest response of each
filter (never below zero), and the largest and the mean response over all chunks go through one
logistic unit. A filter is a table of one value per place and byte, so a convolution is ``WIDTH``
look-ups and sums over a whole block of texts; halves of chunks are pooled once and shared by the two
chunks that overlap there.

Training uses at most about ``FIT_ROWS`` labelled documents of at most ``FIT_BYTES`` bytes each, chosen
by hash; only the position that gave a maximum gets a gradient. Scoring reads every text whole, a very
long one in pieces, so memory is bounded.

Rows: a null or empty text is one chunk of padding; without labels every text scores the starting
model's value; repeated rows score alike; columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from qaspark.llm.flat import blocks, flat_bytes
from qaspark.llm.labelled import held_out, sigmoid, training_sample

THRESHOLD = 0.7
HALF = 256
WIDTH = 6
FILTERS = 16
PAD = 256
FIT_ROWS = 3_000
FIT_BYTES = 32 << 10
STEPS = 400
BATCH = 32
PIECE = 1 << 16  # bytes convolved at a time when scoring

Model = tuple[np.ndarray, np.ndarray, np.ndarray]  # filters (place, byte, filter), bias, output weights


def start_model(seed: int = 7) -> Model:
    rng = np.random.default_rng(seed)
    filters = rng.normal(0, 0.15, (WIDTH, 257, FILTERS)).astype(np.float32)
    filters[:, PAD] = 0
    return filters, np.zeros(FILTERS, np.float32), rng.normal(0, 0.1, 2 * FILTERS + 1)


def convolve(symbols: np.ndarray, model: Model) -> np.ndarray:
    """Responses at each position but the last ``WIDTH - 1``."""
    filters, bias, _ = model
    size = len(symbols) - WIDTH + 1
    out = filters[0][symbols[:size]]
    for place in range(1, WIDTH):
        out += filters[place][symbols[place : place + size]]
    out += bias
    return out


def halves_of(sizes: np.ndarray) -> np.ndarray:
    """Number of half chunks of each text, padding for the last byte's filters included; two at
    least, which make one chunk."""
    return np.maximum(2, -(-(sizes + WIDTH - 1) // HALF))


def seams(halves: np.ndarray) -> np.ndarray:
    """Positions of padding whose filters would reach into the next text."""
    return (np.cumsum(halves)[:, None] * HALF - np.arange(WIDTH - 1, 0, -1)).ravel()


def layout(content: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(symbols padded to whole halves, halves of each text)."""
    sizes = np.diff(offsets)
    halves = halves_of(sizes)
    begins = (np.cumsum(halves) - halves) * HALF
    symbols = np.full(int(halves.sum()) * HALF + WIDTH - 1, PAD, np.int16)
    if len(sizes) == 1:  # as every very long text comes
        symbols[: len(content)] = content
    else:
        symbols[np.arange(len(content)) + np.repeat(begins - offsets[:-1], sizes)] = content
    return symbols, halves


def pool_halves(symbols: np.ndarray, halves: np.ndarray, model: Model) -> np.ndarray:
    """Largest response per half and filter, zero at least."""
    count = int(halves.sum())
    blank = seams(halves)
    out = np.empty((count, FILTERS), np.float32)
    step = PIECE // HALF
    for at in range(0, count, step):
        stop = min(at + step, count)
        part = convolve(symbols[at * HALF : stop * HALF + WIDTH - 1], model)
        own = slice(*np.searchsorted(blank, (at * HALF, stop * HALF)))
        part[blank[own] - at * HALF] = model[1]
        out[at:stop] = part.reshape(stop - at, HALF, FILTERS).max(axis=1)
    return np.maximum(out, 0)


def combine(pooled: np.ndarray, halves: np.ndarray) -> np.ndarray:
    """(largest chunk response, mean chunk response, 1) of each text."""
    begins = np.cumsum(halves) - halves
    chunks = np.maximum(pooled[:-1], pooled[1:])
    inside = np.ones(len(pooled), bool)
    inside[begins + halves - 1] = False  # a chunk does not reach into the next text
    chunks = chunks[inside[:-1]]
    counts = halves - 1
    first = np.cumsum(counts) - counts
    top = np.maximum.reduceat(chunks, first)
    mean = np.add.reduceat(chunks, first) / counts[:, None]
    return np.column_stack((top, mean, np.ones(len(halves))))


def probabilities(texts: pa.Array, model: Model) -> np.ndarray:
    content, offsets = flat_bytes(texts)
    symbols, halves = layout(content, offsets)
    return sigmoid(combine(pool_halves(symbols, halves, model), halves) @ model[2])


def _gradients(texts: Sequence[str], y: np.ndarray, model: Model):
    filters, bias, weights = model
    content, offsets = flat_bytes(pa.array(texts, pa.string()))
    symbols, halves = layout(content, offsets)
    count = int(halves.sum())
    response = convolve(symbols, model)
    response[seams(halves)] = bias
    response = response.reshape(count, HALF, FILTERS)
    where = response.argmax(axis=1)
    pooled = np.take_along_axis(response, where[:, None, :], axis=1)[:, 0]
    active = pooled > 0
    pooled = np.maximum(pooled, 0)
    x = combine(pooled, halves)
    error = (sigmoid(x @ weights) - y) / len(y)
    on_weights = x.T @ error
    on_halves = np.zeros((count, FILTERS))
    at = 0
    columns = np.arange(FILTERS)
    for n, size in enumerate(halves.tolist()):
        own = pooled[at : at + size]
        second = own[1:] > own[:-1]  # which half a chunk's maximum comes from
        share = np.broadcast_to(error[n] * weights[FILTERS : 2 * FILTERS] / (size - 1), second.shape).copy()
        share[np.maximum(own[:-1], own[1:]).argmax(axis=0), columns] += error[n] * weights[:FILTERS]
        on_halves[at + 1 : at + size] += share * second
        on_halves[at : at + size - 1] += share * ~second
        at += size
    on_halves *= active
    rows, cols = np.nonzero(on_halves)
    value = on_halves[rows, cols]
    places = rows * HALF + where[rows, cols]
    on_filters = np.zeros(filters.shape)
    for place in range(WIDTH):
        np.add.at(on_filters[place], (symbols[places + place], cols), value)
    on_filters[:, PAD] = 0
    return on_filters, on_halves.sum(axis=0), on_weights


def train(texts: list[str], y: np.ndarray, least: int = STEPS, rate: float = 0.01, seed: int = 7) -> Model:
    """Adam on the logistic loss, whole passes until ``least`` steps; the seed fixes the order."""
    model = start_model(seed)
    share = np.clip(y.mean() if len(y) else 0.5, 0.02, 0.98)
    model[2][-1] = np.log(share / (1 - share))
    rng = np.random.default_rng(seed)
    first = [np.zeros(p.shape) for p in model]
    second = [np.zeros(p.shape) for p in model]
    steps = 0
    while len(texts) and steps < least:
        order = rng.permutation(len(texts))
        for at in range(0, len(order), BATCH):
            rows = order[at : at + BATCH]
            steps += 1
            for p, g, m, v in zip(model, _gradients([texts[n] for n in rows], y[rows], model), first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= (rate * (m / (1 - 0.9**steps)) / (np.sqrt(v / (1 - 0.999**steps)) + 1e-8)).astype(p.dtype)
    return model


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Model:
    """Train on a bounded sample of the labelled documents that are not held out."""
    short = docs.filter(F.coalesce(F.octet_length("text"), F.lit(0)) <= FIT_BYTES)
    sample = training_sample(short, labels, "quality", 4, 2, rows=rows)
    found = sorted((r.text, r.y) for r in sample.collect())  # at most rows * FIT_BYTES
    return train([t for t, _ in found], np.array([y for _, y in found]))


def score(docs: DataFrame, model: Model, text: str = "text", to: str = "score") -> DataFrame:
    """Add ``to``: 0 to 1, higher where the document is likelier good."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            parts = [probabilities(block, shared.value) for block in blocks(batch)]
            yield pa.array(np.concatenate([np.empty(0), *parts]))

    return docs.withColumn(to, F.arrow_udf(run, "double")(F.col(text)))


def op8_quality_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: a score of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return score(docs, fit(docs, labels)).select(
        "doc_id",
        held_out("doc_id", 4, 2).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
