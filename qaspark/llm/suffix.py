"""Repeated substrings by suffix arrays and longest previous factors.

Every window of ``length`` bytes is dealt to a bucket by its smallest k-gram hash (``GRAM`` bytes), so
equal windows meet wherever they stand. Windows next to each other mostly share that hash: such a run is
one segment, the bytes its windows cover. Buckets are settled in three steps:

1. Two Bloom filters over the buckets tell which may hold two segments; nothing else leaves its task.
   Segments are then counted by (bucket, hash of the segment's bytes): in a bucket with one segment
   nothing repeats, unless its text is periodic, which counts as two. Equal segments are one from here on, standing for all their places, so a
   group of copies, however large, is a single segment.
2. The other segments meet by bucket. A task lays the segments of its buckets end to end, sorts all
   window starts into a suffix array (by prefix doubling, up to ``length`` bytes), takes the lengths of
   the longest common prefixes, and from previous and next smaller positions in suffix order the
   longest previous factor of each start: the longest match with something earlier. Read backwards,
   the same array gives the longest match with something later.
3. A bucket with more than ``GROUP`` segments is cut into parts of about that many. The parts count
   their windows by a 128-bit hash, and the counts are added up over the parts.

What repeats goes back to its documents as spans; the texts are moved once, to meet them.

``keep="first"`` removes what an earlier place has, by (id, position), null ids first; ``keep="none"`` removes every
window that occurs twice. Strings are judged on the input, not on what is left; overlaps count.

Rows: null and short texts have no windows and stay as they are; rows that agree in id and text repeat
each other: with ``keep="none"`` all their windows go, with ``keep="first"`` they count as one text.
Removal is by bytes, so what is left is binary.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from qaspark.llm.bloom import Bits, filter_bits, seen_twice
from qaspark.llm.flat import SpanHash, flat_bytes, runs
from qaspark.llm.skew import join_counted, text_bytes, with_row_key
from qaspark.session import store

LENGTH = 200
GRAM = 64  # bytes, a power of two; at most the length
RUN = 256  # windows of one segment at most
GROUP = 512
BLOCK = 2 << 20
PLACE_BITS = 24  # more than a block with a window has


# --- segments ---------------------------------------------------------------------------------


def gram_hashes(content: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` bytes (a power of two) from each place on."""
    values = np.random.default_rng(41).integers(1, 1 << 63, 256, np.uint64)
    hashes, width = values[content], 1
    while width < size:
        factor = np.uint64(pow(0xD6E8FEB86659FD93, width, 1 << 64))
        hashes = hashes[:-width] * factor + hashes[width:]
        width *= 2
    hashes ^= hashes >> np.uint64(32)
    hashes *= np.uint64(0xD6E8FEB86659FD93)
    return hashes ^ (hashes >> np.uint64(32))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[: len(out) - step], out[step:])
        have += step
    return out


def segments(content: np.ndarray, offsets: np.ndarray, length: int, gram: int):
    """(bucket, text number, start in the text, windows, twin) of the runs of windows of one bucket.

    ``twin``: the gram that chose the bucket stands in the segment twice, as in periodic text. Only
    then can two windows of one segment be equal.
    """
    size = len(content)
    if size < length:
        none = np.empty(0, np.int64)
        return np.empty(0, np.uint64), none, none, none, none.astype(bool)
    hashes = gram_hashes(content, gram)
    mask = np.uint64((1 << PLACE_BITS) - 1)
    place = np.arange(len(hashes), dtype=np.uint64)
    high = hashes & ~mask
    # the leftmost and the rightmost place of the least gram of each window
    left = (sliding_min(high | place, length - gram + 1) & mask).astype(np.int64)
    right = (mask - (sliding_min(high | (mask - place), length - gram + 1) & mask)).astype(np.int64)
    bucket = hashes[left]
    # a window does not cross into the next text
    owner_end = np.repeat(offsets[1:], np.diff(offsets))
    valid = np.arange(len(bucket)) + length <= owner_end[: len(bucket)]
    new = np.ones(len(bucket), bool)
    new[1:] = (bucket[1:] != bucket[:-1]) | (valid[1:] != valid[:-1])
    new[offsets[:-1][offsets[:-1] < len(bucket)]] = True
    begins = np.flatnonzero(new)
    ends = np.append(begins[1:], len(bucket))
    begins, ends = begins[valid[begins]], ends[valid[begins]]
    # long runs, as in periodic text, are cut
    parts = -(-(ends - begins) // RUN)
    cut = np.repeat(begins, parts) + RUN * (np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts))
    stop = np.minimum(cut + RUN, np.repeat(ends, parts))
    owner = np.searchsorted(offsets, cut, side="right") - 1
    return bucket[cut], owner, cut - offsets[owner], stop - cut, left[cut] != right[stop - 1]


def _pieces(texts: pa.Array, length: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
    """(first text, bytes, offsets, place in that text): blocks of texts, and parts of long ones.

    Parts of one text overlap by all but one byte of a window, so each window is in exactly one.
    """
    at = 0
    sizes = np.array([len(t.as_buffer()) if t.is_valid else 0 for t in texts.cast(pa.large_binary())])
    while at < len(texts):
        stop, total = at, 0
        while stop < len(texts) and (stop == at or total + sizes[stop] <= BLOCK):
            total += sizes[stop]
            stop += 1
        content, offsets = flat_bytes(texts.slice(at, stop - at))
        if stop == at + 1 and total > BLOCK:
            for place in range(0, int(total) - length + 1, BLOCK):
                part = content[place : place + BLOCK + length - 1]
                yield at, part, np.array([0, len(part)]), place
        else:
            yield at, content, offsets, 0
        at = stop


def _buckets(length: int, gram: int):
    """For the filter: the bucket of each segment."""

    def load():
        def run(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
            for _, content, offsets, _ in _pieces(batch.column(0), length):
                bucket, *_, twin = segments(content, offsets, length, gram)
                yield np.concatenate((bucket, bucket[twin]))

        return run

    return load


def _find(length: int, gram: int, shared, bits: int):
    """The segments of buckets that may hold another one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, twice = SpanHash(seed=43), Bits(bits, shared.value)
        for batch in batches:
            for at, content, offsets, place in _pieces(batch.column(3), length):
                bucket, owner, start, windows, twin = segments(content, offsets, length, gram)
                may = twice.has(bucket)
                if not may.any():
                    continue
                bucket, owner, start, windows, twin = (x[may] for x in (bucket, owner, start, windows, twin))
                begin = start + offsets[owner]
                digest = hasher(content, begin, begin + windows + length - 1)
                own = batch.select([0, 1, 2]).take(pa.array(owner + at))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(bucket.view(np.int64)), pa.array(digest.view(np.int64)), *own.columns,
                        pa.array(start + place), pa.array(windows.astype(np.int32)), pa.array(twin.astype(np.int32)),
                    ],
                    ["bucket", "digest", "k1", "k2", "id", "start", "windows", "twin"],
                )

    return run


# --- suffix arrays ----------------------------------------------------------------------------


def suffix_array(content: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(starts in suffix order, common prefix with the one before): compared up to ``length``.

    Prefix doubling: the order by 2 n bytes comes from the orders by n bytes of both halves.
    """
    size = len(content)
    rank, width = content.astype(np.int64) + 1, 1
    levels = [(rank, 1)]
    while width < length:
        step = min(width, length - width)
        other = np.zeros(size, np.int64)
        other[: size - step] = rank[step:] if step < size else 0
        # with a step below the width, halves overlap, which orders the same
        _, rank = np.unique(rank * (int(rank.max()) + 2 + size) + other, return_inverse=True)
        rank += 1
        width += step
        levels.append((rank, width))
    order = np.argsort(rank, kind="stable")
    prefix = np.zeros(size, np.int64)
    one, two = order[:-1].copy(), order[1:].copy()
    common = np.zeros(max(size - 1, 0), np.int64)
    for ranks, wide in reversed(levels):
        # ranks are kept for each width, so a prefix grows by whole steps, largest first
        fits = (common + wide <= length) & (one < size) & (two < size)
        same = np.zeros(len(one), bool)
        same[fits] = ranks[one[fits]] == ranks[two[fits]]
        same &= (one + wide <= size) & (two + wide <= size)
        one[same] += wide
        two[same] += wide
        common[same] += wide
    prefix[1:] = common
    return order, prefix


def nearest_smaller(values: np.ndarray, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Common prefix with the nearest entry before, and after, that has a smaller value; 0: none.

    ``common[i]`` is the prefix shared by entries i - 1 and i. Halving steps over range minima of the
    values and of the prefixes: entries skipped are all larger, and the prefix is the least on the way.
    """
    return _before(values, common), _before(values[::-1], np.append(common[1:], 0)[::-1])[::-1]


def _before(values: np.ndarray, common: np.ndarray) -> np.ndarray:
    """For each entry: least of ``common`` back to the nearest smaller value before it."""
    size = len(values)
    low, least = [values], [common]  # over 2 ** n entries up to and with i
    while 1 << len(low) <= size:
        half = 1 << (len(low) - 1)
        for table, fill in ((low, np.iinfo(np.int64).min), (least, 0)):
            last = table[-1]
            shifted = np.full(size, fill, last.dtype)
            shifted[half:] = last[:-half]
            table.append(np.minimum(last, shifted))
    at, shared = np.arange(size) - 1, common.copy()
    for n in reversed(range(len(low))):
        inside = at - (1 << n) + 1 >= 0
        skip = np.zeros(size, bool)
        skip[inside] = low[n][at[inside]] > values[inside]
        shared[skip] = np.minimum(shared[skip], least[n][at[skip]])
        at[skip] -= 1 << n
    shared[at < 0] = 0
    return shared


def longest_previous_factor(order: np.ndarray, common: np.ndarray) -> np.ndarray:
    """By start: the longest match with an earlier start."""
    before, after = nearest_smaller(order, common)
    out = np.empty(len(order), np.int64)
    out[order] = np.maximum(before, after)
    return out


def repeated_starts(content: np.ndarray, starts: np.ndarray, length: int, keep: str) -> np.ndarray:
    """Whether the window at each of the starts has an equal window: an earlier one, or any.

    Starts are in the order in which a window counts as earlier.
    """
    order, common = suffix_array(content, length)
    wanted = np.full(len(content), -1)
    wanted[starts] = np.arange(len(starts))
    # only window starts stay in the array; a common prefix is the least one of those left out
    among = wanted[order] >= 0
    places = np.flatnonzero(among)
    if not len(places):
        return np.zeros(0, bool)
    common = np.minimum.reduceat(common[: places[-1] + 1], np.concatenate(([0], places[:-1] + 1)))
    ranks = wanted[order[among]]
    common[0] = 0
    found = longest_previous_factor(ranks, common) >= length
    if keep == "none":
        later = longest_previous_factor(len(ranks) - 1 - ranks, common)[::-1]
        found |= later >= length
    return found


def _settle(length: int, keep: str):
    """Rows come sorted by bucket; several buckets are settled with one array."""

    def flush(rows: list[dict]) -> pa.RecordBatch:
        # earlier first; a byte that no text has cannot stand between segments, so their starts are cut
        rows.sort(key=lambda r: (r["bucket"], r["first"] is not None, r["first"] or 0, r["f1"], r["f2"], r["fstart"]))
        content = np.frombuffer(b"".join(r["content"] for r in rows), np.uint8)
        sizes = np.array([len(r["content"]) for r in rows])
        begin = np.cumsum(sizes) - sizes
        windows = sizes - length + 1
        starts = np.repeat(begin, windows) + np.arange(int(windows.sum())) - np.repeat(np.cumsum(windows) - windows, windows)
        hit = repeated_starts(content, starts, length, keep)
        names = ["bucket", "digest", "starts", "stops"]
        columns: list[list] = [[], [], [], []]
        at = 0
        for row, count in zip(rows, windows.tolist()):
            froms, tos = runs(hit[at : at + count])
            at += count
            for column, value in zip(columns, (row["bucket"], row["digest"], froms.tolist(), tos.tolist())):
                column.append(value)
        kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for row in batch.to_pylist():
                if held and size >= BLOCK // 4 and row["bucket"] != held[-1]["bucket"]:
                    yield flush(held)
                    held, size = [], 0
                held.append(row)
                size += len(row["content"])
        if held:
            yield flush(held)

    return run


# --- the operator -----------------------------------------------------------------------------


def _cut_out(length: int):
    """The bytes of the segments asked for in each text."""

    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, asked in batches:
            out = []
            for text, spans in zip(texts, asked):
                raw = memoryview(text.as_buffer()) if text.is_valid else b""
                wanted = spans.as_py() or []
                out.append(
                    [{"bucket": s["bucket"], "digest": s["digest"], "content": bytes(raw[s["start"] : s["start"] + s["windows"] + length - 1])} for s in wanted]
                )
            yield pa.array(out, pa.list_(pa.struct([("bucket", pa.int64()), ("digest", pa.int64()), ("content", pa.binary())])))

    return run


def repeated_spans(
    keyed: DataFrame, doc_id: str, text: str, length: int, keep: str, gram: int, group: int
) -> DataFrame:
    """(k1, k2, spans): the byte spans of each text that windows found twice cover."""
    row = F.col("row")
    given = keyed.select("k1", "k2", row.getField(doc_id).alias("id"), row.getField(text).alias("text"))
    bits = filter_bits(text_bytes(given, "text") * 2 // (length - gram + 2))
    shared = keyed.sparkSession.sparkContext.broadcast(
        seen_twice(given.select("text"), _buckets(length, gram), bits)
    )
    kind = given.schema["id"].dataType.simpleString()
    schema = f"bucket long, digest long, k1 long, k2 long, id {kind}, start long, windows int, twin int"
    found = store(given.mapInArrow(_find(length, gram, shared, bits), schema), "segments")
    place = F.struct("id", "k1", "k2", "start", "windows")
    alike = found.groupBy("bucket", "digest").agg(
        F.count(F.lit(1)).alias("n"), F.min(place).alias("at"), F.max("twin").alias("twin")
    )
    sizes = alike.groupBy("bucket").agg(
        F.sum(1 + F.col("twin")).alias("kinds"), F.sum(F.col("n") + F.col("twin")).alias("all")
    )
    repeated = store(sizes.filter("all > 1"), "buckets")
    alike = store(alike.join(repeated, "bucket"), "alike")

    # one place of each kind of segment is asked for its bytes, if other kinds share its bucket
    asked = alike.filter("kinds > 1").select(
        "bucket", "digest", "kinds", "at.k1", "at.k2", F.struct("bucket", "digest", "at.start", "at.windows").alias("one")
    )
    lists = asked.groupBy("k1", "k2").agg(F.collect_set("one").alias("asked"))  # of one text
    cut = F.arrow_udf(_cut_out(length), "array<struct<bucket:long,digest:long,content:binary>>")
    contents = (
        given.join(lists, ["k1", "k2"])
        .dropDuplicates(["k1", "k2"])
        .select(F.explode(cut(F.col("text"), F.col("asked"))).alias("c"))
        .select("c.*")
    )
    columns = ["kinds", "n", "at"]
    contents = store(contents.join(alike.select("bucket", "digest", *columns), ["bucket", "digest"]), "contents")
    small = contents.filter(F.col("kinds") <= group).select(
        "bucket", "digest", "content", F.col("at.id").alias("first"), F.col("at.k1").alias("f1"),
        F.col("at.k2").alias("f2"), F.col("at.start").alias("fstart"),
    )
    settled = (
        small.repartition("bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(_settle(length, keep), "bucket long, digest long, starts array<long>, stops array<long>")
    )
    settled = settled.unionByName(_by_window(contents.filter(F.col("kinds") > group), length, keep, group))
    spans = F.arrays_zip("starts", "stops")
    settled = settled.select("bucket", "digest", spans.alias("spans"))

    # a kind of segment that stands in several places repeats whole, all but its first place
    kinds = alike.join(settled, ["bucket", "digest"], "left").select("bucket", "digest", "n", "at", "spans")
    kinds = store(kinds.filter("n > 1 or size(spans) > 0"), "kinds")
    whole = F.array(F.struct(F.lit(0).cast("long").alias("starts"), F.col("windows").cast("long").alias("stops")))
    first = (F.col("k1") == F.col("at.k1")) & (F.col("k2") == F.col("at.k2")) & (F.col("start") == F.col("at.start"))
    own = whole if keep == "none" else F.when(first, F.coalesce("spans", F.array().cast("array<struct<starts:long,stops:long>>"))).otherwise(whole)
    hits = join_counted(found, kinds, ["bucket", "digest"], "n", found.count()).withColumn(
        "own", F.when(F.col("n") > 1, own).otherwise(F.col("spans"))
    )
    return (
        hits.select("k1", "k2", "start", F.explode("own").alias("s"))
        .select("k1", "k2", F.struct((F.col("start") + F.col("s.starts")).alias("a"), (F.col("start") + F.col("s.stops") + length - 1).alias("b")).alias("span"))
        .groupBy("k1", "k2")
        .agg(F.collect_set("span").alias("spans"))  # of one text
    )


def _window_hashes(contents: pa.ChunkedArray, hashers, length: int):
    """(row, place in it, two hashes) of every window of the contents."""
    rows, at, one, two = ([np.empty(0, t)] for t in (np.int64, np.int64, np.uint64, np.uint64))
    for n, content in enumerate(contents):
        raw = np.frombuffer(content.as_buffer(), np.uint8)
        start = np.arange(len(raw) - length + 1)
        rows.append(np.full(len(start), n))
        at.append(start)
        one.append(hashers[0](raw, start, start + length))
        two.append(hashers[1](raw, start, start + length))
    return tuple(np.concatenate(x) for x in (rows, at, one, two))


def _by_window(contents: DataFrame, length: int, keep: str, group: int) -> DataFrame:
    """Settles large buckets by counting their windows, in parts of about ``group`` segments.

    A part asks for each distinct window it has, if the Bloom filter has seen that twice; the counts are
    added up over the parts, and every part gets the totals of what it asked for.
    """
    seeds = (44, 45)
    dealt = contents.withColumn("part", F.pmod("digest", F.ceil(F.col("kinds") / group)))
    dealt = store(dealt.select("bucket", "part", "digest", "content", "at.id", "at.k1", "at.k2", "at.start"), "parts")
    if not dealt.take(1):
        none = "bucket long, digest long, starts array<long>, stops array<long>"
        return dealt.sparkSession.createDataFrame([], none)

    def keys():
        hasher = SpanHash(seed=seeds[0])

        def run(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
            yield _window_hashes(batch.column(0), (hasher, hasher), length)[2]

        return run

    size = dealt.agg(F.sum(F.octet_length("content") - length + 1)).first()[0]
    bits = filter_bits(size)
    shared = dealt.sparkSession.sparkContext.broadcast(seen_twice(dealt.select("content"), keys, bits))

    def ask(table: pa.Table) -> pa.Table:
        names = ["id", "k1", "k2", "start"]
        order = pc.sort_indices(table, [(n, "ascending") for n in names], null_placement="at_start")
        table = table.take(order)  # earlier places first
        row, at, one, two = _window_hashes(table["content"], [SpanHash(seed=s) for s in seeds], length)
        may = Bits(bits, shared.value).has(one)
        row, at, one, two = (x[may] for x in (row, at, one, two))
        _, first, counts = np.unique(one, return_index=True, return_counts=True)
        own = table.take(pa.array(row[first]))
        place = own["start"].to_numpy() + at[first]
        columns = {n: own[n] for n in ("bucket", "part", "id", "k1", "k2")}
        hashes = {"h1": one[first].view(np.int64), "h2": two[first].view(np.int64), "n": counts, "place": place}
        return pa.table(columns | {n: pa.array(x) for n, x in hashes.items()})

    kind = dealt.schema["id"].dataType.simpleString()
    cell = ["bucket", "part"]
    asked = store(
        dealt.groupBy(*cell).applyInArrow(
            ask, f"bucket long, part long, id {kind}, k1 long, k2 long, h1 long, h2 long, n long, place long"
        ),
        "asked",
    )
    totals = asked.groupBy("h1", "h2").agg(
        F.sum("n").alias("n"), F.min(F.struct("id", "k1", "k2", "place")).alias("first")
    )
    answers = asked.select(*cell, "h1", "h2").join(totals.filter("n > 1"), ["h1", "h2"])
    answers = answers.select(*cell, "h1", "h2", "first.k1", "first.k2", "first.place")

    def mark(table: pa.Table, known: pa.Table) -> pa.Table:
        row, at, one, two = _window_hashes(table["content"], [SpanHash(seed=s) for s in seeds], length)
        hit = np.zeros(len(row), bool)
        if len(known):
            h1, h2, k1, k2, place = (known[n].to_numpy() for n in ("h1", "h2", "k1", "k2", "place"))
            order = np.argsort(h1)
            found = order[np.minimum(np.searchsorted(h1, one.view(np.int64), sorter=order), len(order) - 1)]
            hit = (h1[found] == one.view(np.int64)) & (h2[found] == two.view(np.int64))
            if keep == "first":
                own = [table[n].to_numpy()[row] for n in ("k1", "k2", "start")]
                hit &= (own[0] != k1[found]) | (own[1] != k2[found]) | (own[2] + at != place[found])
        bounds = np.searchsorted(row, np.arange(len(table) + 1))
        spans = [runs(hit[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
        lists = [pa.array([x[n].tolist() for x in spans], pa.list_(pa.int64())) for n in (0, 1)]
        return pa.table({"bucket": table["bucket"], "digest": table["digest"], "starts": lists[0], "stops": lists[1]})

    return (
        dealt.groupBy(*cell)
        .cogroup(answers.groupBy(*cell))
        .applyInArrow(mark, "bucket long, digest long, starts array<long>, stops array<long>")
    )


def remove_repeats(
    docs: DataFrame,
    length: int = LENGTH,
    keep: str = "first",
    doc_id: str = "doc_id",
    text: str = "text",
    gram: int = GRAM,
    group: int = GROUP,
) -> DataFrame:
    """(row, n_bytes, n_removed, n_spans, kept): the rows, and their texts without what repeats."""
    if keep not in ("first", "none") or length < gram or gram & (gram - 1):
        raise ValueError("keep is first or none; gram is a power of two and at most the length")
    keyed = with_row_key(docs, doc_id, text)
    spans = repeated_spans(keyed, doc_id, text, length, keep, gram, group)

    def cut(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        kind = pa.struct([("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary())])
        for texts, found in batches:
            out = []
            for one, listed in zip(texts, found):
                raw = one.as_buffer().to_pybytes() if one.is_valid else b""
                kept, at, removed, count = [], 0, 0, 0
                end = -1
                for a, b in sorted((s["a"], s["b"]) for s in listed.as_py() or ()):
                    if a > end:  # spans that touch are one
                        kept.append(raw[at:a])
                        count += 1
                    removed += max(b - max(a, end), 0)
                    end = at = max(b, end)
                out.append({"n_bytes": len(raw), "n_removed": removed, "n_spans": count, "kept": b"".join([*kept, raw[at:]])})
            yield pa.array(out, kind)

    edited = F.arrow_udf(cut, "struct<n_bytes:long,n_removed:long,n_spans:long,kept:binary>")
    joined = keyed.join(spans, ["k1", "k2"], "left")
    return joined.select("row", edited(F.col("row").getField(text), F.col("spans")).alias("cut")).select("row", "cut.*")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: bytes of every document that a repeated 200-byte string covers."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return remove_repeats(docs, keep="none").select(
        "row.doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


# two hexadecimal digits a byte; a span ends where no window starts within the next 200 bytes
OP1_SQL = """
with b as materialized (
  select row_number() over () as r, doc_id, hex(encode(coalesce(text, ''))) as h from documents),
w as materialized (
  select r, i, md5(substr(h, 2 * i + 1, 400)) as k
  from (select r, h, unnest(range(0, length(h) // 2 - 199)) as i from b)),
hits as (select r, i from w where k in (select k from w group by k having count(*) > 1)),
marked as (select r, i, coalesce(i > lag(i) over (partition by r order by i) + 200, true) as new from hits),
numbered as (select r, i, sum(case when new then 1 else 0 end) over (partition by r order by i) as s from marked),
spans as materialized (select r, s, min(i) as a, max(i) + 200 as e from numbered group by r, s),
gaps as (
  select r, s, substr(h, 2 * coalesce(lag(e) over (partition by r order by s), 0) + 1,
                      2 * (a - coalesce(lag(e) over (partition by r order by s), 0))) as g, a, e
  from spans join b using (r)),
kept as (
  select r, count(*) as n, sum(e - a) as gone, max(e) as last, string_agg(g, '' order by s) as head
  from gaps group by r)
select doc_id, cast(length(h) // 2 as bigint) as n_bytes, cast(coalesce(gone, 0) as bigint) as n_removed,
       cast(coalesce(n, 0) as bigint) as n_spans,
       sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(last, 0) + 1))) as kept_sha256
from b left join kept using (r)
"""
