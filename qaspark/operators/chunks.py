"""Reader features: overlapping chunks, offsets, answer labels, padding, candidate sets.

A feature reads ``[CLS] question [SEP] context part [SEP]``; positions count from 0 at ``[CLS]``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from hashlib import md5

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from qaspark.functions.bind import let
from qaspark.functions.text import title_tag
from qaspark.functions.tokens import Scheme, space_offsets, tokenize
from qaspark.operators.corpus import attach_text, sample_negatives
from qaspark.plans.broadcasts import BLOCK_BYTES, split_blocks
from qaspark.session import materialize

MAX_LEN, OVERLAP, SPECIALS = 512, 256, 3
PAD, UNKNOWN, CLS, SEP = "[PAD]", "[UNK]", "[CLS]", "[SEP]"


def chunk(
    df: DataFrame,
    max_len: int = MAX_LEN,
    overlap: int = OVERLAP,
    scheme: Scheme = "space",
    offsets: Callable[[Column], Column] = space_offsets,
) -> DataFrame:
    """Cut the contexts of (id, question, context, …) rows: one row per chunk.

    Adds (chunk_no, q_len, shared, tokens, offsets); neighbours share ``overlap`` tokens, the last
    chunk is the first that reaches the end. No feature is longer than ``max_len``: next to a long
    question, neighbours share half of the room that is left (``shared``). A question that leaves no
    room raises. Other columns, apart from the context, go along.
    """
    q_len = F.size(tokenize(F.col("question"), scheme))
    room = F.lit(max_len - SPECIALS) - q_len
    full = F.raise_error(F.concat(F.lit("no room beside a question of words: "), q_len.cast("string")))
    prepared = F.struct(
        tokenize(F.col("context"), scheme).alias("tokens"),
        offsets(F.col("context")).alias("offsets"),
        F.when(room >= 1, room).otherwise(full.cast("int")).alias("room"),
    )

    def parts(row: Column) -> Column:
        room, size = row["room"], F.size(row["tokens"])
        shared = F.least(F.lit(overlap), F.floor(room / 2).cast("int"))
        step = room - shared
        last = F.when(size <= room, 0).otherwise(F.ceil((size - room) / step)).cast("int")
        return F.transform(
            F.sequence(F.lit(0), last),
            lambda i: F.struct(
                i.alias("chunk_no"),
                shared.alias("shared"),
                F.slice(row["tokens"], i * step + 1, room).alias("tokens"),
                F.slice(row["offsets"], i * step + 1, room).alias("offsets"),
            ),
        )

    kept = [c for c in df.columns if c != "context"]
    cut = df.select(*kept, q_len.alias("q_len"), F.explode(let(prepared, parts)).alias("part"))
    return cut.select(*kept, "q_len", "part.*")


def feature_offsets(offsets: Column, q_len: Column) -> Column:
    """Offsets by feature position; null at the question and the special tokens."""
    nothing = F.lit(None).cast("struct<s:int,e:int>")
    return F.concat(F.array_repeat(nothing, q_len + 2), offsets, F.array(nothing))


def with_feature_offsets(chunks: DataFrame) -> DataFrame:
    return chunks.withColumn("offsets", feature_offsets(F.col("offsets"), F.col("q_len")))


def align_labels(
    chunks: DataFrame, start_char: str = "start_char", end_char: str = "end_char"
) -> DataFrame:
    """Add ``start_pos`` and ``end_pos``: the answer's feature positions in this chunk.

    Both are 0, the ``[CLS]`` position, without an answer or when the chunk does not hold all of it.
    Only context tokens count.
    """
    spans, begin, end = F.col("offsets"), F.col(start_char), F.col(end_char)
    last = F.size(spans) - 1
    holds = (
        (last >= 0)
        & (F.get(spans, F.lit(0))["s"] <= begin)
        & (F.get(spans, F.greatest(last, F.lit(0)))["e"] >= end)
    )
    first_token = F.size(F.filter(spans, lambda o: o["s"] <= begin)) - 1
    last_token = F.size(F.filter(spans, lambda o: o["e"] < end))
    base = F.col("q_len") + 2

    def label(token: Column) -> Column:
        return F.when(F.coalesce(holds, F.lit(False)), base + token).otherwise(0)

    return chunks.withColumns({"start_pos": label(first_token), "end_pos": label(last_token)})


def feature_tokens(question: Column, tokens: Column, scheme: Scheme = "space") -> Column:
    return F.concat(
        F.array(F.lit(CLS)), tokenize(question, scheme), F.array(F.lit(SEP)), tokens,
        F.array(F.lit(SEP)),
    )


def _known_ids(words: pa.Array, ids: pa.Array):
    """Fills what is still null in the second column with the ids of the first column's tokens."""

    @F.arrow_udf("array<int>")
    def fill(tokens: pa.Array, found: pa.Array) -> pa.Array:
        looked = ids.take(pc.index_in(pc.cast(tokens.flatten(), pa.string()), value_set=words))
        ends = np.cumsum(tokens.value_lengths().to_numpy(zero_copy_only=False))
        offsets = pa.array(np.concatenate(([0], ends)), pa.int32())
        return pa.ListArray.from_arrays(offsets, pc.coalesce(found.flatten(), looked))

    return fill


def look_up(
    df: DataFrame, tokens: str, vocabulary: DataFrame, special_ids: Mapping[str, int], limit: int = BLOCK_BYTES
) -> DataFrame:
    """Add ``_ids``, the id of each token in place, null for unknown ones.

    Rows stay where they are: the vocabulary goes to them in parts of about ``limit`` bytes, each one more
    pass inside the row, so tokens are never shuffled however common they are. Token arrays are not null.
    """
    known = vocabulary.filter(F.col("token").isNotNull()).groupBy("token").agg(
        F.min("token_id").cast("int").alias("token_id")
    )
    marks = F.create_map(*[F.lit(x) for pair in special_ids.items() for x in pair])
    first = F.transform(tokens, lambda token: F.try_element_at(marks, token).cast("int"))
    df = df.withColumn("_ids", first)
    for part in split_blocks(materialize(known), "token", limit):
        table = part.toArrow().combine_chunks()  # no larger than a broadcast
        if table.num_rows:
            words, ids = (table.column(c).combine_chunks() for c in ("token", "token_id"))
            df = df.withColumn("_ids", _known_ids(words.cast(pa.string()), ids)(F.col(tokens), F.col("_ids")))
    return df


def encode_pad(
    chunks: DataFrame,
    vocabulary: DataFrame,
    special_ids: Mapping[str, int],
    length: int | None = None,
    multiple: int = 8,
    key: tuple[str, ...] = ("id", "chunk_no"),
) -> DataFrame:
    """(key…, input_ids, attention_mask) from (key…, question, tokens) and (token, token_id).

    Padded to ``length``, or to the next multiple. Tokens without an id, or with a null one, get the unknown
    one; special tokens go before the vocabulary; of a repeated token the smallest id counts. A chunk without
    question or tokens (null) has no row.
    """
    tokens = feature_tokens(F.col("question"), F.col("tokens"))
    placed = chunks.select(*key, tokens.alias("_tokens")).filter(F.col("_tokens").isNotNull())
    ids = look_up(placed, "_tokens", vocabulary, special_ids)
    ids = ids.select(
        *key, F.transform("_ids", lambda one: F.coalesce(one, F.lit(special_ids[UNKNOWN]))).alias("ids")
    )
    size = F.size("ids")
    target = F.lit(length) if length else (F.ceil(size / multiple) * multiple).cast("int")
    padding = F.greatest(target - size, F.lit(0))
    return ids.select(
        *key,
        F.concat("ids", F.array_repeat(F.lit(special_ids[PAD]), padding)).alias("input_ids"),
        F.concat(F.array_repeat(F.lit(1), size), F.array_repeat(F.lit(0), padding)).alias(
            "attention_mask"
        ),
    )


def build_candidates(questions: DataFrame, corpus: DataFrame, n: int = 31, seed: str = "0") -> DataFrame:
    """(qid, cand_no, label, doc_id, cand_text): the gold passage as number 0, then ``n`` negatives.

    ``questions`` is (qid, doc_id, title) with the gold passage's id and title.
    """
    gold = questions.select("qid", F.lit(0).cast("long").alias("cand_no"), F.lit(1).alias("label"), "doc_id")
    drawn = sample_negatives(questions.select("qid", "title"), corpus, n, seed)
    others = drawn.select("qid", "cand_no", F.lit(0).alias("label"), "doc_id")
    texts = corpus.select("doc_id", title_tag(F.col("title"), F.col("text")).alias("cand_text"))
    return attach_text(gold.unionByName(others), texts)


def pair_text(question: Column, candidate: Column) -> Column:
    return F.concat(question, F.lit(SEP), candidate)


@F.arrow_udf(T.ArrayType(T.DoubleType()))
def _hashed(sizes: pa.Array, keys: pa.Array) -> pa.Array:
    offsets, digests = [0], []
    for size, key in zip(sizes.to_pylist(), keys.to_pylist()):
        if size is not None:
            begun = md5(key.encode())
            for place in range(size) if size > 0 else range(0, size - 2, -1):  # as Spark's sequence
                one = begun.copy()
                one.update(b"%d" % place)
                digests.append(one.digest())
        offsets.append(len(digests))
    first = np.frombuffer(b"".join(digests), ">u8")[::2].astype(np.uint64) >> np.uint64(4)  # 60 bits, as hash_int
    logits = pa.array((first.astype(np.int64) % 2001 - 1000) / 64.0)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), logits, mask=sizes.is_null())


def hashed_logits(size: Column, *key: Column) -> Column:
    """Stand-in reader output: ``size`` logits fixed by the key and the position."""
    return _hashed(size, F.concat_ws("|", *key, F.lit("")))
