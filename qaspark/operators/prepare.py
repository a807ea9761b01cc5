"""From raw question-answer rows to typed, cleaned, filtered and numbered rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F, types as T

from qaspark.functions.text import clean_answer, clean_context, rebased_start, strip
from qaspark.functions.tokens import SCHEMES, Scheme, tokenize
from qaspark.plans.order import row_index


def clean_qa(
    df: DataFrame,
    context: str = "context",
    answer: str = "answer_text",
    start: str = "answer_start",
    variant: str = "wiki",
    legacy: bool = False,
) -> DataFrame:
    """Clean context and answer and move the answer offset to the cleaned context."""
    return df.withColumns(
        {
            context: clean_context(F.col(context), variant, legacy),
            answer: strip(clean_answer(F.col(answer))),
            start: rebased_start(F.col(context), F.col(start)),
        }
    )


def filter_qa(
    df: DataFrame,
    context: str = "context",
    answer: str = "answer_text",
    start: str = "answer_start",
    max_context: int = 2000,
    max_answer: int = 80,
) -> DataFrame:
    """Keep rows whose offset still points at the answer's first character."""
    ctx, text, at = F.col(context), F.col(answer), F.col(start)
    return df.filter(
        (F.length(text) > 0)
        & (F.length(text) <= max_answer)
        & (F.length(ctx) <= max_context)
        & (F.length(ctx) > at)
        & (F.substring(ctx, at + 1, F.lit(1)) == F.left(text, F.lit(1)))
    )


def assign_ids(
    df: DataFrame, prefix: str, order: Sequence[str], file_no: str | None = "file_no", name: str = "id"
) -> DataFrame:
    """``prefix-FF-NNNNNN``: file number and running row number over all files, zero-padded.

    Without ``file_no``, ``prefix-NNNNNN``. Numbers that outgrow their width keep all their digits. The columns
    of ``order`` are a key of the rows; only they are put in order, and the numbers are joined back.
    """

    def padded(number: Column, width: int) -> Column:
        digits = number.cast("string")
        return F.lpad(digits, F.greatest(F.length(digits), F.lit(width)), F.lit("0"))

    places = row_index(df.select(*order), order, "_row").select(
        *[F.col(c).alias(f"_{i}") for i, c in enumerate(order)], "_row"
    )
    same = [F.col(c).eqNullSafe(F.col(f"_{i}")) for i, c in enumerate(order)]
    numbered = df.join(places, reduce(and_, same)).drop(*[f"_{i}" for i in range(len(order))])
    parts = [padded(F.col(file_no), 2)] if file_no else []
    made = F.concat_ws("-", F.lit(prefix), *parts, padded(F.col("_row"), 6))
    return numbered.withColumn(name, made).drop("_row")


def conform(df: DataFrame, schema: T.StructType, rename: Mapping[str, str] | None = None) -> DataFrame:
    """Rename, keep only the columns of ``schema`` in its order, cast; absent ones become null."""
    for old, new in (rename or {}).items():
        df = df.withColumnRenamed(old, new)
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def with_lengths(df: DataFrame, columns: Sequence[str], total: str | None = None) -> DataFrame:
    """Add ``<column>_len`` for each column, and optionally their sum."""
    df = df.withColumns({f"{c}_len": F.length(c) for c in columns})
    if total:
        df = df.withColumn(total, sum((F.col(f"{c}_len") for c in columns), F.lit(0)))
    return df


def with_span(df: DataFrame, answers: str = "answers") -> DataFrame:
    """First answer of ``struct<text array, answer_start array>`` as start and end characters."""
    start = F.get(F.col(answers)["answer_start"], F.lit(0))
    text = F.get(F.col(answers)["text"], F.lit(0))
    return df.withColumns({"start_char": start, "end_char": start + F.length(text)})


def tokenize_rows(
    df: DataFrame, key: str, text: str, scheme: Scheme = "space", lower: bool = False
) -> DataFrame:
    """One row per token: (key, pos, token)."""
    return df.select(key, F.posexplode(tokenize(F.col(text), scheme, lower)).alias("pos", "token"))


def token_length_profile(
    df: DataFrame, key: str, text: str, schemes: Sequence[str] | Mapping[str, Scheme] = tuple(SCHEMES)
) -> DataFrame:
    """Length of the joined tokens under each scheme: (key, scheme, token_chars), in one pass."""
    named = schemes if isinstance(schemes, Mapping) else {name: name for name in schemes}
    entries = [
        F.struct(
            F.lit(name).alias("scheme"),
            F.length(F.array_join(tokenize(F.col(text), scheme), "")).alias("token_chars"),
        )
        for name, scheme in named.items()
    ]
    return df.select(key, F.explode(F.array(*entries)).alias("one")).select(key, "one.*")


def encoded_length(columns: Sequence[str], scheme: Scheme = "space", specials: int = 0) -> Column:
    """Token count of several columns together, with the special tokens of the encoder."""
    return sum((F.size(tokenize(F.col(c), scheme)) for c in columns), F.lit(specials))


def max_encoded_len(
    df: DataFrame, columns: Sequence[str], scheme: Scheme = "space", specials: int | None = None
) -> DataFrame:
    """Longest encoding. Each column is encoded by itself, with two special tokens of its own."""
    extra = 2 * len(columns) if specials is None else specials
    return df.agg(F.max(encoded_length(columns, scheme, extra)).alias("max_tokens"))
