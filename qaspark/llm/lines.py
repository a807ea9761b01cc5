"""Line deduplication with two Bloom filters: lines seen once, and lines seen in a second document.

Pass 1 fills both filters in every task and merges them by shard, bit by bit: what two tasks have both
seen once has been seen twice. Pass 2 looks every line up in the second filter; only lines that may
repeat leave their task, as a 128-bit key, and are counted exactly. A false positive costs one row in
that shuffle and nothing else, so results do not depend on the filter size. That size follows the
input up to ``bloom.MAX_BITS`` (64 MB broadcast); beyond it the filter passes more lines on.

A line that very many documents share is counted by partial sums and joined back by a broadcast of
the few such keys. The texts are shuffled once, by row, to meet the list of their dropped lines.

Rows: null or empty texts are one empty line; lines whose key has fewer than ``min_chars`` code
points stay; a line that repeats inside one document only counts once; rows that agree in id and text
count as so many documents and get the same result; columns are kept, whatever they are called.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from qaspark.llm.bloom import Bits, filter_bits, seen_twice
from qaspark.llm.flat import SpanHash, blocks, byte_class, flat_bytes, fold_case
from qaspark.llm.skew import join_counted, text_bytes, with_row_key
from qaspark.session import store

MIN_DOCS = 10
MIN_CHARS = 1
BLANK = byte_class((0x09, 0x0D), (0x20, 0x20))


class LineKeys:
    """Keys of all lines of a block of texts: blanks stripped at both ends, A-Z lower-cased."""

    def __init__(self, min_chars: int):
        fold = fold_case()
        self.min_chars = min_chars
        self.hashes = SpanHash(fold, 11), SpanHash(fold, 12)

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, ...]:
        """(text number, line number, two hashes) of the lines with a key, and lines per text."""
        content, offsets = flat_bytes(texts)
        breaks = np.flatnonzero(content == 10)
        counts = np.diff(np.searchsorted(breaks, offsets)) + 1
        starts = np.sort(np.concatenate((offsets[:-1], breaks + 1)))
        ends = np.sort(np.concatenate((breaks, offsets[1:])))
        owner = np.repeat(np.arange(len(counts)), counts)
        line = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        solid = np.append(np.flatnonzero(~BLANK[content]), len(content))
        at, stop = np.searchsorted(solid, starts), np.searchsorted(solid, ends)
        full = stop > at
        first, last = solid[at[full]], solid[stop[full] - 1] + 1
        owner, line = owner[full], line[full]
        if self.min_chars > 1:
            points = np.concatenate(([0], np.cumsum((content & 0xC0) != 0x80)))
            enough = points[last] - points[first] >= self.min_chars
            first, last, owner, line = (x[enough] for x in (first, last, owner, line))
        one, two = (h(content, first, last) for h in self.hashes)
        return owner, line, one, two, counts


def _keys_per_text(min_chars: int):
    """For the filter: each key once for every text that has it."""

    def load():
        keys = LineKeys(min_chars)

        def run(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
            for block in blocks(batch.column(0)):
                owner, _, one, _, _ = keys(block)
                order = np.lexsort((owner, one))
                one, owner = one[order], owner[order]
                new = np.ones(len(one), bool)
                new[1:] = (one[1:] != one[:-1]) | (owner[1:] != owner[:-1])
                yield one[new]

        return run

    return load


def suspected(keyed: DataFrame, doc_id: str, text: str, min_chars: int, bits: int) -> DataFrame:
    """(k1, k2, doc, line, h1, h2): lines that may be in two documents, once per row."""
    shared = keyed.sparkSession.sparkContext.broadcast(
        seen_twice(keyed.select(F.col("row").getField(text).alias("text")), _keys_per_text(min_chars), bits)
    )
    given = keyed.select(
        "k1", "k2", F.col("row").getField(doc_id).alias("doc"), F.col("row").getField(text).alias("text")
    )
    kind = given.schema["doc"].dataType.simpleString()

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, twice = LineKeys(min_chars), Bits(bits, shared.value)
        for batch in batches:
            at = 0
            for block in blocks(batch.column(3)):
                owner, line, one, two, counts = keys(block)
                may = twice.has(one)
                owner, line, one, two = (x[may] for x in (owner, line, one, two))
                order = np.lexsort((line, two, one, owner))
                owner, line, one, two = (x[order] for x in (owner, line, one, two))
                same = (owner[1:] == owner[:-1]) & (one[1:] == one[:-1]) & (two[1:] == two[:-1])
                new = np.concatenate(([True], ~same))[: len(one)]
                rows = batch.select([0, 1, 2]).take(pa.array(owner[new] + at))
                columns = [pa.array(x[new].astype(np.int64)) for x in (line, one.view(np.int64), two.view(np.int64))]
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, *columns], ["k1", "k2", "doc", "line", "h1", "h2"]
                )
                at += len(counts)

    return given.mapInArrow(find, f"k1 long, k2 long, doc {kind}, line long, h1 long, h2 long")


def drop_lines(
    docs: DataFrame,
    min_docs: int = MIN_DOCS,
    min_chars: int = MIN_CHARS,
    keep: str = "none",
    doc_id: str = "doc_id",
    text: str = "text",
    counts: tuple[str, str] | None = None,
    bits: int | None = None,
) -> DataFrame:
    """The documents with their repeated lines dropped from ``text``.

    A line goes if its key is found in at least ``min_docs`` documents (two or more). ``keep="first"``
    leaves the first line of the document with the smallest id, repeats of that row included; ids
    compare by their own type, a null id comes last. ``counts`` names two columns to add: lines before, and lines dropped.
    """
    if min_docs < 2 or keep not in ("none", "first"):
        raise ValueError("min_docs starts at 2; keep is none or first")
    keyed = with_row_key(docs, doc_id, text)
    found = store(suspected(keyed, doc_id, text, min_chars, bits or filter_bits(text_bytes(docs, text) // 256)), "lines")
    total = found.count()
    first = F.min(F.struct(F.col("doc").isNull().alias("no_id"), "doc", "k1", "k2", "line")).alias("first")
    groups = found.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), first)
    groups = store(groups.filter(F.col("n") >= min_docs), "repeats")
    own = (F.col("first.k1") == F.col("k1")) & (F.col("first.k2") == F.col("k2"))
    stays = F.when(own & F.lit(keep == "first"), F.col("first.line")).otherwise(F.lit(-1))
    dropped = (
        join_counted(found, groups, ["h1", "h2"], "n", total)
        .groupBy("k1", "k2")  # at most the lines of one document
        .agg(F.collect_set(F.struct("h1", "h2", stays.alias("stays"))).alias("_drop"))
    )

    def edit(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        keys = LineKeys(min_chars)
        kind = pa.struct([("lines", pa.int64()), ("dropped", pa.int64()), ("text", pa.string())])
        for texts, drops in batches:
            at, out = 0, []
            for block in blocks(texts):
                owner, line, one, two, sizes = keys(block)
                bounds = np.searchsorted(owner, np.arange(len(sizes) + 1))
                for n, one_text in enumerate(block.to_pylist()):
                    gone, drop = set(), drops[at + n].as_py()
                    if drop:
                        named = {(d["h1"], d["h2"]): d["stays"] for d in drop}
                        part = slice(bounds[n], bounds[n + 1])
                        pairs = zip(one[part].view(np.int64).tolist(), two[part].view(np.int64).tolist())
                        gone = {
                            int(number)
                            for number, pair in zip(line[part], pairs)
                            if named.get(pair, number) != number
                        }
                    if gone:
                        kept = [x for number, x in enumerate(one_text.split("\n")) if number not in gone]
                        one_text = "\n".join(kept)
                    out.append({"lines": int(sizes[n]), "dropped": len(gone), "text": one_text})
                at += len(sizes)
            yield pa.array(out, kind)

    edited = F.arrow_udf(edit, "struct<lines:long,dropped:long,text:string>")
    joined = keyed.join(dropped, ["k1", "k2"], "left")
    result = joined.withColumn("edit", edited(F.col("row").getField(text), F.col("_drop")))
    more = [F.col("edit")[f].alias(n) for f, n in zip(("lines", "dropped"), counts or ())]
    return result.select(F.col("row").withField(text, F.col("edit")["text"]).alias("row"), *more).select(
        "row.*", *(counts or ())
    )


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: lines of every document before and after, kept text as a digest."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    kept = drop_lines(docs, counts=("n_lines", "n_dropped"))
    return kept.select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    )


OP5_SQL = r"""
with lines as (
  select r, pos, line, lower_ascii as key from (
    select r, pos, line,
           translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as lower_ascii
    from (select r, unnest(string_split(text, chr(10))) as line,
                 generate_subscripts(string_split(text, chr(10)), 1) as pos
          from (select row_number() over () as r, coalesce(text, '') as text from documents)))),
gone as (
  select key from lines where key <> '' group by key having count(distinct r) >= 10),
kept as (
  select r, count(*) as n_lines, count(g.key) as n_dropped,
         coalesce(string_agg(line, chr(10) order by pos) filter (where g.key is null), '') as text
  from lines left join gone g using (key) group by r)
select d.doc_id, cast(n_lines as bigint) as n_lines, cast(n_dropped as bigint) as n_dropped,
       sha256(k.text) as kept_sha256
from kept k join (select row_number() over () as r, doc_id from documents) d using (r)
"""
