"""Language-model scores by a weighted backoff automaton whose counts cover the whole corpus.

The model is a bigram model with Dirichlet smoothing over an add-one unigram:

    p(w)     = (c(w) + 1) / (N + V + 1)
    p(w | h) = (c(h w) + MASS * p(w)) / (c(h) + MASS)

As an automaton, a state is a context: a word met in training, or the start of a text. A bigram met in
training is an arc with its log-probability; a failure arc leads from each state to the root, weighted
by log10 MASS / (c(h) + MASS), and the root has an arc for every word. One traversal from left to
right carries the state and adds up the weights.

The automaton of the corpus is as large as the corpus' vocabulary of bigrams and is never in one
place. Documents are dealt into blocks of a few MB by a hash of their content. A block sends every
distinct word and bigram it holds, with its training count, to the shard of its hash; the shard adds
the counts up and answers each block with the totals of just the keys it sent. From those, the block
builds its part of the automaton and scores its texts. So what is moved is one entry per block and
distinct key, however often it occurs, and no key is a group: a word that is everywhere is one entry
of each block. Keys are 64-bit hashes, packed into byte columns.

Rows: null and empty texts are the end token alone; repeated rows count as often as they occur and
score alike; a null id is not held out; without training rows every token is unknown.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from qaspark.llm.flat import SpanHash, blocks, byte_class, flat_bytes, fold_case, words_of
from qaspark.llm.labelled import held_out
from qaspark.llm.skew import text_bytes, with_row_key
from qaspark.session import store

MASS = 200.0
BLOCK_BYTES = 12 << 20  # of text per block; there are as many shards as blocks
BATCH_BYTES, BATCH_ROWS = 1 << 20, 4096  # of an Arrow batch of requests or answers
WORD = ~byte_class((0x09, 0x0D), (0x20, 0x20))
END, START = np.uint64(0xE2D), np.uint64(0x57A27)
SCORES = T.StructType(
    [
        T.StructField("n_tokens", T.LongType()),
        T.StructField("n_known", T.LongType()),
        T.StructField("train_tokens", T.LongType()),
        T.StructField("base_score", T.DoubleType()),
        T.StructField("score", T.DoubleType()),
    ]
)


def pack(values: np.ndarray) -> bytes:
    """64-bit values byte column by byte column, so that the high zero bytes compress away."""
    return np.ascontiguousarray(values.astype(np.uint64)).view(np.uint8).reshape(-1, 8).T.tobytes()


def unpack(content: bytes) -> np.ndarray:
    planes = np.frombuffer(content, np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view(np.uint64).ravel()


def pack_sorted(keys: np.ndarray) -> bytes:
    return pack(np.diff(keys, prepend=np.uint64(0)))


def unpack_sorted(content: bytes) -> np.ndarray:
    return np.cumsum(unpack(content), dtype=np.uint64)


class Block:
    """The tokens of the texts of one block, and its distinct words and bigrams by shard."""

    def __init__(self, texts: Sequence[pa.Array], hasher: SpanHash, shards: int):
        words, sizes = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
        for batch in texts:
            for part in blocks(batch):
                content, offsets = flat_bytes(part)
                starts, ends, owner = words_of(content, offsets, WORD)
                words.append(hasher(content, starts, ends))
                sizes.append(np.bincount(owner, minlength=len(part)))
        words, counts = np.concatenate(words), np.concatenate(sizes)
        self.sizes = counts + 1  # with the end token
        stops = np.cumsum(self.sizes)
        tokens = np.full(int(stops[-1]) if len(stops) else 0, END, np.uint64)
        tokens[np.arange(len(words)) + np.repeat(np.arange(len(counts)), counts)] = words
        before = np.empty_like(tokens)
        before[1:] = tokens[:-1]
        before[stops - self.sizes] = START
        self.keys, self.word = np.unique(tokens, return_inverse=True)
        mixed = before * np.uint64(0x9E3779B97F4A7C15) + tokens * np.uint64(0xC2B2AE3D27D4EB4F)
        mixed ^= mixed >> np.uint64(31)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(29)
        self.grams, self.gram = np.unique(mixed, return_inverse=True)
        self.shards = shards

    def cuts(self, keys: np.ndarray) -> np.ndarray:
        """Where each shard's range of hash values begins in the sorted keys."""
        width = (1 << 64) // self.shards + 1
        edges = np.array([shard * width for shard in range(self.shards)], np.uint64)
        return np.append(np.searchsorted(keys, edges), len(keys))

    def requests(self, trained: np.ndarray) -> Iterator[tuple[int, bytes, bytes, bytes, bytes]]:
        """(shard, words, their counts, bigrams, their counts); ``trained`` by text."""
        weight = np.repeat(trained, self.sizes)
        sides = []
        for keys, place in ((self.keys, self.word), (self.grams, self.gram)):
            counts = np.bincount(place, weights=weight, minlength=len(keys)).astype(np.uint64)
            sides.append((keys, counts, self.cuts(keys)))
        for shard in range(self.shards):
            out = []
            for keys, counts, cut in sides:
                part = slice(cut[shard], cut[shard + 1])
                out += [pack_sorted(keys[part]), pack(counts[part])]
            if out[0] or out[2]:
                yield (shard, *out)

    def scores(self, words: dict[int, bytes], grams: dict[int, bytes], trained: int, distinct: int) -> dict[str, np.ndarray]:
        """Score the texts with the totals that the shards have sent for this block's keys."""
        count, together = (
            np.concatenate([np.empty(0, np.uint64), *(unpack(side[s]) for s in sorted(side))]).astype(np.float64)
            for side in (words, grams)
        )
        uni = (count + 1) / (trained + distinct + 1)
        size = len(count)
        root = size + 1  # states: the words, the start of a text, the root
        ends = count[np.searchsorted(self.keys, END)] if size else 0.0  # as many texts have begun
        context = np.append(count, ends)
        stops = np.cumsum(self.sizes)
        state = np.empty(len(self.word), np.int64)
        state[1:] = self.word[:-1]
        state[stops - self.sizes] = size
        first = np.zeros(len(together), np.int64)
        first[self.gram[::-1]] = np.arange(len(self.gram) - 1, -1, -1)
        met = first[together > 0]
        weight = np.log10((together[together > 0] + MASS * uni[self.word[met]]) / (context[state[met]] + MASS))
        arcs = dict(zip((state[met] * size + self.word[met]).tolist(), weight.tolist()))
        root_arc = np.log10(uni)
        failure = [*np.log10(MASS / (context + MASS)).tolist(), 0.0]
        leads_to = np.where(count > 0, np.arange(size), root).tolist()
        base = np.add.reduceat(root_arc[self.word], stops - self.sizes) if size else np.empty(0)
        known = np.add.reduceat((count > 0)[self.word].astype(np.int64), stops - self.sizes) if size else []
        return {
            "n_tokens": self.sizes,
            "n_known": known,
            "train_tokens": np.full(len(self.sizes), trained),
            "base_score": base,
            "score": self._traverse(arcs, root_arc.tolist(), failure, leads_to, size),
        }

    def _traverse(self, arcs, root_arc, failure, leads_to, start) -> list[float]:
        words, out, at = self.word.tolist(), [], 0
        for size in self.sizes.tolist():
            state, total = start, 0.0
            for word in words[at : at + size]:
                weight = arcs.get(state * start + word)
                total += failure[state] + root_arc[word] if weight is None else weight
                state = leads_to[word]
            out.append(total)
            at += size
        return out


def _gather(batches: Iterator[pa.RecordBatch]) -> dict[int, list[pa.RecordBatch]]:
    """The rows of each block; a task is dealt one block, whole."""
    found: dict[int, list[pa.RecordBatch]] = defaultdict(list)
    for batch in batches:
        numbers = batch.column("block").to_numpy(zero_copy_only=False)
        for number in np.unique(numbers).tolist():
            found[number].append(batch.filter(pa.array(numbers == number)))
    return found


def _batches(rows: Iterator[dict]) -> Iterator[pa.RecordBatch]:
    """Rows with binary values in batches of about ``BATCH_BYTES``."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(value) for value in row.values() if isinstance(value, bytes))
        if size >= BATCH_BYTES or len(held) >= BATCH_ROWS:
            yield pa.RecordBatch.from_pylist(held)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held)


def _requests(shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = SpanHash(fold_case(), 31)
        for number, rows in _gather(batches).items():
            trained = np.concatenate([r.column("trained").to_numpy(zero_copy_only=False) for r in rows])
            block = Block([r.column("text") for r in rows], hasher, shards)
            names = "shard", "block", "words", "word_n", "grams", "gram_n"
            sent = block.requests(trained.astype(float))
            yield from _batches(dict(zip(names, (shard, number, *columns))) for shard, *columns in sent)

    return run


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Totals of a shard's keys, sent back block by block; (tokens, words) of the shard once."""
    by_shard: dict[int, list[dict]] = defaultdict(list)
    for batch in batches:
        for row in batch.to_pylist():
            by_shard[row["shard"]].append(row)
    for shard, rows in by_shard.items():
        answers, sums = [], (0, 0)
        for keys, counts in (("words", "word_n"), ("grams", "gram_n")):
            sent = [unpack_sorted(row[keys]) for row in rows]
            _, place = np.unique(np.concatenate(sent), return_inverse=True)
            totals = np.bincount(place, weights=np.concatenate([unpack(row[counts]) for row in rows])) if len(place) else np.empty(0)
            if keys == "words":
                sums = int(totals.sum()), int((totals > 0).sum())
            bounds = np.cumsum([0, *map(len, sent)])
            answers.append([pack(totals[place[a:b]]) for a, b in zip(bounds[:-1], bounds[1:])])
        yield from _batches(
            {"block": row["block"], "shard": shard, "words": answers[0][n], "grams": answers[1][n], "tokens": sums[0] * (n == 0), "distinct": sums[1] * (n == 0)}
            for n, row in enumerate(rows)
        )


def score(
    docs: DataFrame,
    held: Column,
    doc_id: str = "doc_id",
    text: str = "text",
    keep: Sequence[str] | None = None,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(row, held_out, lm): the kept columns as one struct, and a struct with the ``SCORES``.

    Rows where ``held`` is true are scored but not learned from.
    """
    count = max(1, -(-text_bytes(docs, text) // block_bytes))
    given = with_row_key(docs.withColumn("held_out_", held), doc_id, text)
    row = F.col("row")
    kept = F.struct(*[row.getField(name).alias(name) for name in keep or docs.columns])
    texts = given.select(
        F.pmod("k1", F.lit(count)).alias("block"),
        kept.alias("row"),
        row.getField("held_out_").alias("held_out"),
        (~row.getField("held_out_")).alias("trained"),
        row.getField(text).alias("text"),
    )
    request = "shard long, block long, words binary, word_n binary, grams binary, gram_n binary"
    answer = "block long, shard long, words binary, grams binary, tokens long, distinct long"
    answers = store(
        texts.select("block", "trained", "text")
        .repartitionById(count, F.col("block").cast("int"))
        .mapInArrow(_requests(count), request)
        .repartitionById(count, F.col("shard").cast("int"))
        .mapInArrow(_add_up, answer),
        "totals",
    )
    tokens, distinct = answers.agg(
        F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("distinct"), F.lit(0))
    ).first()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = SpanHash(fold_case(), 31)
        for rows in _gather(batches).values():
            sent: tuple[dict, dict] = {}, {}
            held_rows = []
            for part in rows:
                is_answer = part.column("shard").is_valid()
                for one in part.filter(is_answer).select(["shard", "words", "grams"]).to_pylist():
                    sent[0][one["shard"]], sent[1][one["shard"]] = one["words"], one["grams"]
                held_rows.append(part.filter(part.column("shard").is_null()))
            block = Block([p.column("text") for p in held_rows], hasher, count)
            found = block.scores(*sent, tokens, distinct)
            at = 0
            for part in held_rows:
                cut = slice(at, at + len(part))
                fields = [pa.array(np.asarray(found[f.name])[cut], pa.float64() if f.dataType == T.DoubleType() else pa.int64()) for f in SCORES]
                scored = pa.StructArray.from_arrays(fields, SCORES.names)
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), part.column("held_out"), scored], ["row", "held_out", "lm"]
                )
                at += len(part)

    both = texts.drop("trained").unionByName(
        answers.select("block", "shard", "words", "grams"), allowMissingColumns=True
    )
    result = T.StructType(
        [texts.schema["row"], T.StructField("held_out", T.BooleanType()), T.StructField("lm", SCORES)]
    )
    return both.repartitionById(count, F.col("block").cast("int")).mapInArrow(run, result)


def op10_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: base and model score of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return score(docs, held_out("doc_id", 7, 2), keep=["doc_id"]).select("row.doc_id", "held_out", "lm.*")
