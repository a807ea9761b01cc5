"""Benchmark decontamination with a generalised suffix automaton of the benchmark items.

The automaton is built over the normalised words of all items. The words of a document are streamed
through it, tracking the length of the longest suffix that occurs in an item; where that length
covers a window (``window`` consecutive item words, or a whole shorter item), the window's words are
hit. A word pair that no item has ends every match there, so a document is first cut at such pairs,
for all documents of a block at once, and only pieces long enough for a window are streamed.

What is broadcast is a block of items of at most ``ITEM_BYTES`` measured bytes; a larger benchmark
is cut into several blocks, one stored pass over the documents each.

Rows: null or empty texts have no words and are never hit; an item without words has no window;
repeated items count once by id, a null item id is hit but not listed; without items nothing is hit.
Repeated documents are judged one by one. Columns of the documents are kept; the added column is a
struct whose name is a parameter.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from qaspark.llm.flat import SpanHash, blocks, byte_class, flat_bytes, fold_case, words_of
from qaspark.plans.broadcasts import split_blocks
from qaspark.session import materialize

WINDOW = 10
ITEM_BYTES = 4 << 20  # about 100 MB of automaton a MB in each Python worker
WORD = byte_class((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
HITS = (
    "struct<n_words:int,spans:array<struct<first:int,last:int,start:int,end:int>>,items:array<string>>"
)


class Automaton:
    """Suffix automaton of several word sequences, with marks on the states that end a window.

    Almost every state has one arc, so a state is a place in flat arrays: its first arc, its suffix
    link, its length; only further arcs are in a dictionary. Marks are kept sorted, in runs of one
    state and window size.
    """

    def __init__(self, window: int):
        self.window = window
        self.word, self.to = array("i", [-2]), array("i", [-1])  # -2: no arc
        self.more: dict[int, dict[int, int]] = {}
        self.link, self.length = array("i", [-1]), array("i", [0])
        self.found: tuple[array, array, array] = array("i"), array("i"), array("i")

    def _next(self, state: int, word: int) -> int | None:
        if self.word[state] == word:
            return self.to[state]
        rest = self.more.get(state)
        return None if rest is None else rest.get(word)

    def _lead(self, state: int, word: int, to: int) -> None:
        if self.word[state] in (word, -2):
            self.word[state], self.to[state] = word, to
        else:
            self.more.setdefault(state, {})[word] = to

    def _state(self, length: int, link: int) -> int:
        for column, value in ((self.word, -2), (self.to, -1), (self.length, length), (self.link, link)):
            column.append(value)
        return len(self.word) - 1

    def _split(self, at: int, word: int, old: int) -> int:
        """A copy of ``old`` for the shorter strings, which end in more places."""
        copy = self._state(self.length[at] + 1, self.link[old])
        self.word[copy], self.to[copy] = self.word[old], self.to[old]
        if old in self.more:
            self.more[copy] = dict(self.more[old])
        self.link[old] = copy
        while at >= 0 and self._next(at, word) == old:
            self._lead(at, word, copy)
            at = self.link[at]
        return copy

    def add(self, words: list[int]) -> None:
        last = 0
        for word in words:
            known = self._next(last, word)
            if known is not None:
                exact = self.length[known] == self.length[last] + 1
                last = known if exact else self._split(last, word, known)
                continue
            new = self._state(self.length[last] + 1, 0)
            at = last
            while at >= 0 and self._next(at, word) is None:
                self._lead(at, word, new)
                at = self.link[at]
            if at >= 0:
                old = self._next(at, word)
                exact = self.length[old] == self.length[at] + 1
                self.link[new] = old if exact else self._split(at, word, old)
            last = new

    def _shorten(self, state: int, length: int) -> int:
        """The state of the suffix of that length."""
        while self.link[state] >= 0 and self.length[self.link[state]] >= length:
            state = self.link[state]
        return state

    def mark(self, words: list[int], item: int) -> None:
        """Register the windows of an item; all items have been added before."""
        size = min(self.window, len(words))
        state = 0
        for at, word in enumerate(words, 1):
            state = self._next(state, word)
            if at >= size:
                for column, value in zip(self.found, (self._shorten(state, size), size, item)):
                    column.append(value)

    def finish(self) -> None:
        """Sort the marks; nearest marked state on each suffix path, itself included; -1: none."""
        state, size, item = (np.frombuffer(column, np.int32) for column in self.found)
        order = np.lexsort((item, size, state))
        state, size, item = state[order], size[order], item[order]
        fresh = np.ones(len(state), bool)
        fresh[1:] = (state[1:] != state[:-1]) | (size[1:] != size[:-1]) | (item[1:] != item[:-1])
        state, size, self.items = state[fresh], size[fresh], item[fresh]
        run = np.ones(len(state), bool)
        run[1:] = (state[1:] != state[:-1]) | (size[1:] != size[:-1])
        begins = np.flatnonzero(run)
        self.run_begin = array("i", [*begins.tolist(), len(state)])
        self.run_size = array("i", size[begins].tolist())
        self.first_run = array("i", [-1]) * len(self.word)
        self.run_state = array("i", state[begins].tolist())
        for at in range(len(begins) - 1, -1, -1):
            self.first_run[self.run_state[at]] = at
        self.found = array("i"), array("i"), array("i")
        self.marked = array("i", [-1]) * len(self.word)
        for one in np.argsort(np.frombuffer(self.length, np.int32), kind="stable").tolist():
            up = self.link[one]
            self.marked[one] = one if self.first_run[one] >= 0 else self.marked[up] if up >= 0 else -1

    def stream(self, words: list[int]) -> Iterator[tuple[int, int, list[int]]]:
        """(first word, last word, items) of each window that occurs."""
        state = length = 0
        for at, word in enumerate(words):
            to = self._next(state, word)
            while to is None and state:
                state = self.link[state]
                length = self.length[state]
                to = self._next(state, word)
            if to is not None:
                state = to
                length += 1
            ends = self.marked[state]
            while ends >= 0:
                run = self.first_run[ends]
                while run < len(self.run_state) and self.run_state[run] == ends:
                    size = self.run_size[run]
                    if size <= length:
                        yield at - size + 1, at, self.items[self.run_begin[run] : self.run_begin[run + 1]].tolist()
                    run += 1
                up = self.link[ends]
                ends = self.marked[up] if up >= 0 else -1


class Matcher:
    """The automaton of a block of items, and the tables that cut documents into pieces for it."""

    def __init__(self, items: list[tuple[str | None, str]], window: int):
        self.fold = fold_case()
        self.hash = SpanHash(self.fold)
        texts = pa.array([text for _, text in items], pa.string())
        content, offsets = flat_bytes(texts)
        starts, ends, owner = words_of(content, offsets, WORD)
        folded = self.fold[content].tobytes()
        self.vocabulary: dict[bytes, int] = {}
        numbers = np.empty(len(starts), np.int64)
        for n, (a, b) in enumerate(zip(starts, ends, strict=True)):
            numbers[n] = self.vocabulary.setdefault(folded[a:b], len(self.vocabulary))
        self.names = [name for name, _ in items]
        self.automaton = Automaton(window)
        bounds = np.searchsorted(owner, np.arange(len(items) + 1))
        for a, b in zip(bounds[:-1], bounds[1:]):
            self.automaton.add(numbers[a:b].tolist())
        for item, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])):
            self.automaton.mark(numbers[a:b].tolist(), item)
        self.automaton.finish()
        sizes = np.diff(bounds)
        self.shortest = min(window, int(sizes[sizes > 0].min())) if len(starts) else 0
        hashes = self.hash(content, starts, ends)
        self.hashes, where = np.unique(hashes, return_index=True)
        self.numbers = numbers[where]
        beside = owner[1:] == owner[:-1]
        self.pairs = np.unique((numbers[:-1] * len(self.vocabulary) + numbers[1:])[beside])

    def _pieces(self, content, starts, ends, owner) -> tuple[np.ndarray, np.ndarray]:
        """(first, last + 1) of the runs of words whose neighbours are pairs of some item."""
        hashes = self.hash(content, starts, ends)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        known = self.hashes[at] == hashes
        number = np.where(known, self.numbers[at], -1)
        pair = number[:-1] * len(self.vocabulary) + number[1:]
        if len(self.pairs):
            at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
            tied = known[:-1] & known[1:] & (owner[:-1] == owner[1:]) & (self.pairs[at] == pair)
        else:
            tied = np.zeros(max(len(pair), 0), bool)
        begins = np.flatnonzero(known & ~np.concatenate(([False], tied)))
        stops = np.flatnonzero(known & ~np.concatenate((tied, [False]))) + 1
        enough = stops - begins >= self.shortest
        return begins[enough], stops[enough]

    def match(self, texts: pa.Array) -> list[dict]:
        content, offsets = flat_bytes(texts)
        starts, ends, owner = words_of(content, offsets, WORD)
        first = np.searchsorted(starts, offsets)  # of each text, among all words
        found = [
            {"n_words": int(n), "spans": [], "items": []} for n in np.diff(first)
        ]
        if not len(starts) or not self.shortest:
            return found
        hits: dict[int, tuple[list, set]] = {}
        for begin, stop in zip(*(x.tolist() for x in self._pieces(content, starts, ends, owner))):
            folded = [self.fold[content[a:b]].tobytes() for a, b in zip(starts[begin:stop], ends[begin:stop])]
            words = [self.vocabulary.get(word, -1) for word in folded]  # by the words themselves
            for a, b, items in self.automaton.stream(words):
                spans, named = hits.setdefault(int(owner[begin]), ([], set()))
                spans.append((begin + a, begin + b))
                named.update(items)
        for text, (spans, named) in hits.items():
            base, place = int(first[text]), int(offsets[text])
            found[text]["spans"] = [
                {"first": a - base, "last": b - base, "start": int(starts[a]) - place, "end": int(ends[b]) - place}
                for a, b in _union(spans)
            ]
            names = {self.names[item] for item in named} - {None}
            found[text]["items"] = sorted(names)
        return found


def _union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans of words (both ends included) that overlap or touch become one."""
    merged: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if merged and a <= merged[-1][1] + 1:
            merged[-1] = merged[-1][0], max(b, merged[-1][1])
        else:
            merged.append((a, b))
    return merged


def _merge(old: pa.Array, new: pa.Array) -> pa.Array:
    """Hits of two blocks of items in the same documents."""
    out = []
    for a, b in zip(old.to_pylist(), new.to_pylist(), strict=True):
        every = a["spans"] + b["spans"]
        start = {s["first"]: s["start"] for s in every}
        end = {s["last"]: s["end"] for s in every}
        spans = [
            {"first": x, "last": y, "start": start[x], "end": end[y]}
            for x, y in _union([(s["first"], s["last"]) for s in every])
        ]
        out.append(a | {"spans": spans, "items": sorted({*a["items"], *b["items"]})})
    return pa.array(out, old.type)


def find_hits(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    to: str = "hits",
    item_bytes: int = ITEM_BYTES,
) -> DataFrame:
    """Add ``to``: words of the text, spans hit (word numbers, byte places), ids of the items."""
    given = items.select(
        F.col(item_id).cast("string").alias("name"), F.coalesce(item_text, F.lit("")).alias("words")
    )
    parts = split_blocks(given, "name", item_bytes)
    spark = docs.sparkSession

    def searched(rows: DataFrame, part: DataFrame, name: str) -> DataFrame:
        # at most item_bytes, see split_blocks
        shared = spark.sparkContext.broadcast([(r.name, r.words) for r in part.collect()])

        @F.arrow_udf(HITS)
        def hits(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            matcher = Matcher(shared.value, window)
            kind = pa.struct(
                [
                    ("n_words", pa.int32()),
                    ("spans", pa.list_(pa.struct([(n, pa.int32()) for n in ("first", "last", "start", "end")]))),
                    ("items", pa.list_(pa.string())),
                ]
            )
            for batch in batches:
                pieces = [pa.array([], kind)]
                pieces += [pa.array(matcher.match(block), kind) for block in blocks(batch)]
                yield pa.concat_arrays(pieces)

        return rows.withColumn(name, hits(F.col(text)))

    merge = F.arrow_udf(_merge, HITS)
    rows = searched(docs, parts[0], to)
    for part in parts[1:]:
        more = f"{to}_more"
        rows = searched(materialize(rows), part, more)
        rows = rows.withColumn(to, merge(F.col(to), F.col(more))).drop(more)
    return rows


def n_hit(hits: str = "hits"):
    """Number of words inside the spans."""
    size = lambda total, s: total + s["last"] - s["first"] + 1
    return F.aggregate(F.col(hits)["spans"], F.lit(0), size).cast("long")


def remove_spans(
    docs: DataFrame,
    items: DataFrame,
    min_words: int = 1,
    max_coverage: float = 0.5,
    text: str = "text",
    **settings,
) -> DataFrame:
    """Cut every hit span of at least ``min_words`` words out of the texts.

    Documents of which more than ``max_coverage`` of the words are hit are dropped whole. Other
    columns stay as they are.
    """
    rows = docs.select(F.struct("*").alias("row"), F.col(text).alias("text"))
    found = find_hits(rows, items, text="text", to="hits", **settings)
    words = F.col("hits")["n_words"]
    kept = found.filter((words == 0) | (n_hit() <= max_coverage * words))
    long = F.filter(F.col("hits")["spans"], lambda s: s["last"] - s["first"] + 1 >= min_words)

    # what lies between the spans, by byte places; spans end at word ends, so no character is cut
    content = F.col("text").cast("binary")
    froms = F.concat(F.array(F.lit(0)), F.transform("cuts", lambda s: s["end"]))
    tos = F.concat(F.transform("cuts", lambda s: s["start"]), F.array(F.octet_length("text")))
    pieces = F.transform(
        F.arrays_zip(froms.alias("a"), tos.alias("b")),
        lambda p: F.substring(content, p["a"] + 1, p["b"] - p["a"]).cast("string"),
    )
    rest = F.when(F.size("cuts") > 0, F.array_join(pieces, "")).otherwise(F.col("text"))
    return kept.select("row", "text", long.alias("cuts")).select(F.col("row").withField(text, rest).alias("row")).select("row.*")


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: hit words and items of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = find_hits(docs, items)
    hit = n_hit()
    return found.select(
        "doc_id",
        F.col("hits")["n_words"].cast("long").alias("n_words"),
        hit.alias("n_hit"),
        F.size(F.col("hits")["items"]).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.col("hits")["items"]), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


OP3_SQL = r"""
with d as materialized (
  select row_number() over () as r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents),
items as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark),
sized as (select *, least(10, len(w)) as m from items where len(w) > 0),
wanted as materialized (
  select distinct item_id, m, array_to_string(w[i:i + m - 1], ' ') as words
  from (select *, unnest(range(1, len(w) - m + 2)) as i from sized)),
windows as (
  select r, m, i, array_to_string(w[i:i + m - 1], ' ') as words
  from (select r, m, w, unnest(range(1, len(w) - m + 2)) as i from d cross join (select distinct m from wanted))),
hits as materialized (select r, m, i, item_id from windows join wanted using (m, words)),
hit_words as (
  select r, count(distinct p) as n from (select r, unnest(range(i, i + m)) as p from hits) group by r),
hit_items as (
  select r, count(*) as n, string_agg(name, ',' order by name) as names
  from (select distinct r, cast(item_id as varchar) as name from hits) group by r)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(h.n, 0) as bigint) as n_hit,
       cast(coalesce(t.n, 0) as bigint) as n_items, sha256(coalesce(names, '')) as items_sha256,
       coalesce(h.n, 0) > 0 as contaminated
from d left join hit_words h using (r) left join hit_items t using (r)
"""
