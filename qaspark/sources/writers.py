"""Sinks for prepared rows and predictions."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from qaspark.plans.order import row_index
from qaspark.session import bound_batches, materialize
from qaspark.sources.named import write_named
from qaspark.sources.schemas import QA

PREDICTION_ROWS = 1_000_000  # of a named file


def write_qa_json(df: DataFrame, path: str, mode: str = "error") -> None:
    """Prepared QA rows as JSON lines."""
    df.select(*[name for name in QA.fieldNames() if name in df.columns]).write.mode(mode).json(path)


def with_shards(df: DataFrame, order: Sequence[str], rows: int) -> DataFrame:
    """Number of the fixed-size slice each row falls into under ``order``."""
    shard = F.floor(F.col("_row") / rows)
    return row_index(df, order, "_row").withColumn("shard", shard).drop("_row")


def write_shards(
    df: DataFrame, path: str, rows: int, order: Sequence[str], mode: str = "error"
) -> None:
    """Slices of ``rows`` rows in order, one folder each; a slice is written by one task."""
    sliced = with_shards(df, order, rows).repartition("shard").sortWithinPartitions(*order)
    sliced.write.mode(mode).partitionBy("shard").json(path)


def shard_name(prefix: str, shard: Column, suffix: str = ".json") -> Column:
    """``70.json`` for the first slice, ``70-1.json`` for the next one, and so on."""
    return F.concat(F.lit(prefix), F.when(shard > 0, F.concat(F.lit("-"), shard)).otherwise(F.lit("")), F.lit(suffix))


def write_shard_files(df: DataFrame, path: str, rows: int, order: Sequence[str], prefix: str = "shard") -> None:
    """Slices of ``rows`` rows as JSON lines in files ``shard.json``, ``shard-1.json``, …, all of them or none."""
    sliced = with_shards(df, order, rows)
    write_named(sliced, path, shard_name(prefix, F.col("shard")), F.to_json(F.struct(*df.columns)), order)


def _as_object(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of one task: an opening brace, entries after the first with a comma, a closing brace."""
    lead = "{"
    for batch in batches:
        entries = batch.column(0).to_pylist()
        if entries:
            lines = [lead + entries[0], *["," + one for one in entries[1:]]]
            lead = ","
            yield pa.RecordBatch.from_pydict({"value": lines})
    yield pa.RecordBatch.from_pydict({"value": ["}" if lead == "," else "{}"]})


def _inner(key: str, value: Column) -> Column:
    """``"key":value`` as it stands inside a JSON object."""
    named = F.coalesce(F.col(key).cast("string"), F.raise_error(F.lit("an entry without a key")).cast("string"))
    entry = F.to_json(F.create_map(named, value))
    return F.substring(entry, F.lit(2), F.length(entry) - 2)


def write_objects(df: DataFrame, path: str, key: str, value: Column, mode: str = "error") -> None:
    """A folder of files that are one JSON object each, from ``key`` to ``value``; a file per task.

    ``objects.read_entries`` reads them back. A null key has no form in JSON and raises.
    """
    bound_batches(df.sparkSession)
    lines = df.select(_inner(key, value).alias("value")).mapInArrow(_as_object, "value string")
    lines.write.mode(mode).text(path)


def write_csv(df: DataFrame, path: str, mode: str = "error") -> None:
    """CSV with a header and no index column; quotes inside values are doubled, blanks at their ends stay."""
    df.write.mode(mode).csv(
        path, header=True, quote='"', escape='"', emptyValue='""', quoteAll=True,
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    )


def _named(folder: str, stem: str, prefix: str | None) -> str:
    return f"{folder}/{stem}" if prefix is None else f"{folder}/{stem}_{prefix}"


def write_predictions(
    decoded: DataFrame, folder: str, prefix: str | None = None, mode: str = "error"
) -> None:
    """Answers, candidate lists and, if present, no-answer odds of decoded rows.

    ``decoded`` is (id, nbest, prediction_text[, null_odds]); it is computed once for all files.
    """
    rows = materialize(decoded)
    rows.select("id", "prediction_text").write.mode(mode).json(_named(folder, "predictions", prefix))
    plain = F.transform("nbest", lambda one: one.dropFields("score"))
    rows.select("id", plain.alias("nbest")).write.mode(mode).json(
        _named(folder, "nbest_predictions", prefix)
    )
    if "null_odds" in rows.columns:
        rows.select("id", "null_odds").write.mode(mode).json(_named(folder, "null_odds", prefix))


def write_nbest_files(decoded: DataFrame, folder: str, prefix: str, rows: int = PREDICTION_ROWS) -> None:
    """Candidate lists by id as JSON objects in ``70.json`` (``prefix`` 70), all files or none of them.

    Questions beyond ``rows``, in the order of ids, go to ``70-1.json`` and so on, so no task writes more.
    ``read_nbest`` takes the weight from the first number of a name and reads them all. Ids have to differ.
    """
    plain = F.transform("nbest", lambda one: one.dropFields("score"))
    entries = with_shards(decoded.select("id", _inner("id", plain).alias("entry")), ["id"], rows)
    write_named(entries, folder, shard_name(prefix, F.col("shard")), F.col("entry"), ["id"], "object")
