"""Repair of conversation structure by Four-Russians block tables.

The cheapest edits of a conversation follow a cost vector: what it takes to finish from each of four
states (nothing yet, after system, after user, after assistant). Vectors less their least entry are
few, so what a row does to one is a table, and what ``BLOCK`` rows do to one is a table too: it is made
once, for every vector and every block of symbols (``Tables``). A conversation is read from its end
by block look-ups, which leave the vector at each block's edge. The trace then expands one block at a time
backward from its right edge, and walks it forward; as costs to the end are known, taking the least
letter of those that stay cheapest gives the least audit of all cheapest ones.

Two streams over rows sorted by conversation: the first sees no texts, only a byte for each row (role,
fault), and makes the report; the second brings each report in front of its conversation's rows and
edits (or hashes) them as they pass. So neither holds a conversation's texts: a conversation of n rows
takes n bytes for its symbols and n for its audit, which is one value of the result in any case. That a
row and its like came earlier is found by counts per (conversation, role, text digest), added up before
they are shuffled. The edits of one conversation, and a digest of its texts, are sequential: one task.

Rows: a null role or text is one space; rows of equal turn are ordered by role and text digest; a null
turn comes first; rows of null conversation are one conversation; an empty or unknown role fits nowhere,
so its row is given another or deleted; an empty table gives no rows; other columns play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from qaspark.llm.merkle import crc32_sql
from qaspark.llm.skew import HOT_SHARE
from qaspark.session import store

BLOCK = 4
SLICE = 512
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = (USER, USER, ASSISTANT, USER)  # the state after an inserted or rerolled row
LETTERS = "DIKR"
# symbols: 2 * role + truncated, role 0 other, 1 system, 2 user, 3 assistant; MUST_GO, then no row at all
MUST_GO, SYMBOLS, NO_ROW = 8, 9, 9
INITIALS = {"s": 1, "u": 2, "a": 3}
LEGAL = {(1, 2), (2, 3), (3, 2)}
BLANKS = " \t\n\x0b\x0c\r"


# --- the tables -------------------------------------------------------------------------------


def _kept(state: int, role: int) -> int | None:
    """The state after a row that keeps its role, if it may stand there."""
    if role == 1:
        return SYSTEM if state == START else None
    if role in (2, 3):
        return role if NEXT[state] == role else None
    return None


def _close(costs: list[int]) -> tuple[int, ...]:
    """The vector once rows may be inserted first."""
    for _ in range(3):
        costs = [min(costs[s], INSERT + costs[NEXT[s]]) for s in range(4)]
    return tuple(costs)


def _options(state: int, symbol: int) -> list[tuple[str, int, int]]:
    """(letter, cost, state after) of the edits of a row, without insertions."""
    found = [("D", DELETE, state)]
    if symbol != MUST_GO:
        extra = TRUNCATED * (symbol & 1)
        if (after := _kept(state, symbol >> 1)) is not None:
            found.append(("K", KEEP + extra, after))
        found.append(("R", REROLE + extra, NEXT[state]))
    return found


class Tables:
    """Vectors, and what a row or a block of rows makes of them, from right to left."""

    def __init__(self, block: int = BLOCK):
        end = _close([0, 10**6, 10**6, 0])
        self.vectors, known, rows = [end], {end: 0}, []
        at = 0
        while at < len(self.vectors):
            row = []
            for symbol in range(SYMBOLS):
                after = self.vectors[at]
                costs = _close([min(c + after[t] for _, c, t in _options(s, symbol)) for s in range(4)])
                least = min(costs)
                vector = tuple(c - least for c in costs)
                if vector not in known:
                    known[vector] = len(self.vectors)
                    self.vectors.append(vector)
                row.append((known[vector], least))
            rows.append(row)
            at += 1
        step = np.array(rows)  # (vector, symbol, (vector before, cost))
        self.step = [[tuple(x) for x in row] for row in step.tolist()]
        # a block's code has its first symbol highest; the last symbol acts first
        to, cost = np.arange(len(rows))[:, None], np.zeros((len(rows), 1), np.int64)
        for _ in range(block):
            cost = (cost[:, None, :] + step[to, :, 1].transpose(0, 2, 1)).reshape(len(rows), -1)
            to = step[to, :, 0].transpose(0, 2, 1).reshape(len(rows), -1)
        self.block, self.to, self.cost = block, to, cost
        self.weights = SYMBOLS ** np.arange(block - 1, -1, -1)
        self.pieces = [
            [[self._piece(v, symbol, s) for s in range(4)] for symbol in range(SYMBOLS)] for v in range(len(rows))
        ]
        self.tails = [self._tail(s) for s in range(4)]

    def _piece(self, after: int, symbol: int, state: int) -> tuple[str, int]:
        """The least cheapest letters for a row, insertions before it included, and the state after."""
        before, least = self.step[after][symbol]
        left, right = self.vectors[before], self.vectors[after]
        out = ""
        while True:
            best = [(x, t) for x, c, t in _options(state, symbol) if c + right[t] == left[state] + least]
            if INSERT + left[NEXT[state]] == left[state]:
                best.append(("I", NEXT[state]))
            letter, state = min(best)
            out += letter
            if letter != "I":
                return out, state

    def _tail(self, state: int) -> str:
        out = ""
        while self.vectors[0][state]:
            out, state = out + "I", NEXT[state]
        return out

    def edits(self, symbols: np.ndarray) -> tuple[int, str]:
        """(cost, audit): the least of the cheapest edits of a row of symbols."""
        rest = len(symbols) % self.block  # these rows, at the front, go one by one
        codes = symbols[rest:].reshape(-1, self.block).astype(np.int64) @ self.weights
        vector, total, edges = 0, 0, []
        for code in codes[::-1].tolist():
            edges.append(vector)
            total += int(self.cost[vector, code])
            vector = int(self.to[vector, code])
        front, edge = symbols[:rest].tolist(), vector
        for symbol in reversed(front):
            vector, cost = self.step[vector][symbol]
            total += cost
        out: list[str] = []
        state = self._walk(front, edge, START, out)
        for n, edge in enumerate(reversed(edges)):
            at = rest + n * self.block
            state = self._walk(symbols[at : at + self.block].tolist(), edge, state, out)
        out.append(self.tails[state])
        return total + self.vectors[vector][START], "".join(out)

    def _walk(self, symbols: list[int], edge: int, state: int, out: list[str]) -> int:
        """Expand a block backward from the vector at its right edge, then follow it forward."""
        after = [edge]
        for symbol in symbols[:0:-1]:
            after.append(self.step[after[-1]][symbol][0])
        for symbol, vector in zip(symbols, reversed(after)):
            piece, state = self.pieces[vector][symbol][state]
            out.append(piece)
        return state


# --- rows -------------------------------------------------------------------------------------


def damage(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turn, role, text, gone) after a damage drawn by CRC-32 of conversation and turn.

    Of twenty remainders 0 drops the row (``gone``), 1 empties its text, 2 removes full stops, exclamation
    and question marks, 3 repeats it, 4 makes it the user's.
    """
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col(conv).cast("string"), space), F.lit(":"), F.coalesce(F.col(turn).cast("string"), space))
    fault = (F.crc32(key.cast("binary")) % 20).alias("fault")
    given = rows.select(
        F.col(conv).alias("conv"), F.col(turn).alias("turn"),
        F.coalesce(F.col(role), space).alias("role"), F.coalesce(F.col(text), space).alias("text"), fault,
    )
    changed = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    times = F.array_repeat(F.col("fault") == 0, F.when(F.col("fault") == 3, 2).otherwise(1))
    return given.select(
        "conv", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
        changed.alias("text"), F.explode(times).alias("gone"),
    )


def _order() -> list[Column]:
    return [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")]


def _narrow(rows: DataFrame) -> DataFrame:
    """(conv, turn, role, digest, gone, symbol): what the edits depend on; duplicates come later."""
    role = F.coalesce(*[F.when(F.col("role").startswith(k), v) for k, v in INITIALS.items()], F.lit(0))
    solid = F.rtrim("text", F.lit(BLANKS))
    ends = F.substring(solid, -1, 1).isin(".", "!", "?")
    symbol = F.when(solid == "", MUST_GO).otherwise(2 * role + F.when(ends, 0).otherwise(1))
    return rows.select(
        "conv", "turn", "role", F.md5("text").alias("digest"), "gone", symbol.cast("int").alias("symbol"), role.alias("initial")
    )


def _with_first(rows: DataFrame) -> DataFrame:
    """Add ``repeated`` and ``first``: whether the conversation has more rows of that role and text, and
    the turn of the first. Groups of very many rows are broadcast; by their size they are few."""
    keys = ["conv", "role", "digest"]
    same = [F.col(f"r.{k}").eqNullSafe(F.col(f"g.{k}")) for k in keys]
    turn = F.min(F.struct(F.col("turn").isNotNull(), "turn")).getField("turn")
    groups = rows.filter("not gone").groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), turn.alias("first"))
    groups = store(groups.filter("n > 1"), "repeats")
    least = max(rows.count() // HOT_SHARE, 1)
    hot, rest = F.broadcast(groups.filter(F.col("n") > least)), groups.filter(F.col("n") <= least)

    def join(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
        joined = left.alias("r").join(right.alias("g"), same, how)
        return joined if how == "left_anti" else joined.select("r.*", F.col("g.n").isNotNull().alias("repeated"), "g.first")

    return join(rows, hot, "inner").unionByName(join(join(rows, hot, "left_anti"), rest, "left"))


REPORT = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _reports(rows: DataFrame, kind: str) -> DataFrame:
    """One row per conversation: counts of faults, cost and audit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = Tables()
        conv, open_, out = None, False, []
        symbols, counts, seen = bytearray(), [0] * 5, [None, None, 0, None, None]

        def close() -> None:
            low, high, distinct, _, _ = seen
            counts[0] = 0 if low is None else high - low + 1 - distinct
            cost, audit = tables.edits(np.frombuffer(bytes(symbols), np.uint8))
            out.append((conv, *counts, cost, audit))

        def flush(id_type: pa.DataType) -> pa.RecordBatch:
            columns = list(zip(*out)) or [[]] * 8
            kinds = [id_type, *[pa.int64()] * 6, pa.string()]
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["conv", *REPORT, "audit"])

        id_type = None
        for batch in batches:
            id_type = batch.schema.field("conv").type
            for one, turn, role, digest, gone, symbol, initial, repeated, first in zip(
                *(batch.column(n).to_pylist() for n in range(9))
            ):
                if not open_ or one != conv:
                    if open_:
                        close()
                    conv, open_ = one, True
                    symbols, counts, seen = bytearray(), [0] * 5, [None, None, 0, None, None]
                if gone:
                    continue
                if turn is not None and turn != seen[1]:
                    seen[0] = turn if seen[0] is None else seen[0]
                    seen[1], seen[2] = turn, seen[2] + 1
                row = turn, role, digest
                if symbol == MUST_GO:
                    counts[1] += 1
                elif repeated and (turn != first or row == seen[3]):
                    counts[2] += 1
                    symbol = MUST_GO
                elif symbol & 1:
                    counts[3] += 1
                if seen[4] is not None and (seen[4], initial) not in LEGAL:
                    counts[4] += 1
                seen[3], seen[4] = row, initial
                symbols.append(symbol)
            yield flush(id_type)
        if open_:
            close()
            yield flush(id_type)

    shape = ", ".join([f"conv {kind}", *[f"{n} long" for n in REPORT], "audit string"])
    return rows.mapInArrow(run, shape)


def _edited(rows: Iterator[tuple[str, str]], audit: str) -> Iterator[tuple[str, str, str]]:
    """(role, text, letter) of the rows that stay, in order, one conversation; ``rows``: (role, text)."""
    state, n = START, 0

    def inserted():
        nonlocal state, n
        while n < len(audit) and audit[n] == "I":
            state, n = NEXT[state], n + 1
            yield ("user", "assistant")[state - 2], "", "I"

    for role, text in rows:
        yield from inserted()
        letter, n = audit[n], n + 1
        if letter == "K":
            state = INITIALS[role[0]]
            yield role, text, letter
        elif letter == "R":
            state = NEXT[state]
            yield ("user", "assistant")[state - 2], text, letter
    yield from inserted()


def _stream(rows: DataFrame, reports: DataFrame) -> DataFrame:
    """Each conversation's report, then its rows in order, in one partition."""
    heads = reports.select(
        "conv", F.lit(True).alias("head"), F.lit(None).cast(rows.schema["turn"].dataType).alias("turn"),
        F.lit("").alias("role"), F.col("audit").alias("text"), F.lit("").alias("digest"), *REPORT,
    )
    body = rows.filter("not gone").select(
        "conv", F.lit(False).alias("head"), "turn", "role", "text", F.md5("text").alias("digest"),
        *[F.lit(None).cast("long").alias(n) for n in REPORT],
    )
    both = heads.unionByName(body).repartition("conv")
    first, *rest = _order()
    return both.sortWithinPartitions(first, F.col("head").desc(), *rest)


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv, report, audit, rows): rows is a stream, to be read before the next conversation."""

    def lines():
        for batch in batches:
            names = batch.schema.names
            columns = [batch.column(names.index(n)) for n in ("conv", "head", "role", "text", *REPORT)]
            for at in range(0, batch.num_rows, SLICE):
                yield from zip(*(c.slice(at, SLICE).to_pylist() for c in columns))

    source, waiting = lines(), []

    def body():
        for line in source:
            if line[1]:
                waiting.append(line)
                return
            yield line[2], line[3]

    for _ in body():
        raise ValueError("a row without its report")
    while waiting:
        conv, _, _, audit, *report = waiting.pop()
        yield conv, report, audit, body()


def _examined(rows: DataFrame) -> tuple[DataFrame, str]:
    kind = rows.schema["conv"].dataType.simpleString()
    narrow = store(_narrow(rows), "turns")
    ordered = _with_first(narrow).repartition("conv").sortWithinPartitions(*_order())
    ordered = ordered.select("conv", "turn", "role", "digest", "gone", "symbol", "initial", "repeated", "first")
    return _reports(ordered, kind), kind


def repair(rows: DataFrame) -> DataFrame:
    """(conv, place, role, text, edit): the repaired conversations; rows as ``damage`` gives them."""
    reports, kind = _examined(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, out, size = ["conv", "place", "role", "text", "edit"], [], 0
        kinds = None

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out)) or [[]] * 5
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

        def typed():
            nonlocal kinds
            for batch in batches:
                kinds = [batch.schema.field("conv").type, pa.int64(), pa.string(), pa.string(), pa.string()]
                yield batch

        for conv, _, audit, body in _conversations(typed()):
            for place, (role, text, letter) in enumerate(_edited(body, audit)):
                out.append((conv, place, role, text, letter))
                size += len(text)
                if size > 1 << 20 or len(out) >= 4096:
                    yield flush()
                    out, size = [], 0
        if kinds:
            yield flush()

    return _stream(rows, reports).mapInArrow(run, f"conv {kind}, place long, role string, text string, edit string")


def report(rows: DataFrame) -> DataFrame:
    """(conv, faults, cost, audit, repaired): a row per conversation; ``repaired`` is the SHA-256 of the
    repaired ``role:text`` lines."""
    reports, kind = _examined(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, out, kinds = ["conv", *REPORT, "audit", "repaired"], [], None

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out)) or [[]] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

        def typed():
            nonlocal kinds
            for batch in batches:
                kinds = [batch.schema.field("conv").type, *[pa.int64()] * len(REPORT), pa.string(), pa.string()]
                yield batch

        for conv, counts, audit, body in _conversations(typed()):
            state, before = hashlib.sha256(), b""
            for role, text, _ in _edited(body, audit):
                state.update(before + f"{role}:{text}".encode())
                before = b"\n"
            out.append((conv, *counts, audit, state.hexdigest()))
            if len(out) >= 4096:
                yield flush()
                out = []
        if kinds:
            yield flush()

    shape = ", ".join([f"conv {kind}", *[f"{n} long" for n in REPORT], "audit string, repaired string"])
    return _stream(rows, reports).mapInArrow(run, shape)


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: faults, cheapest edits and repaired text of every damaged conversation."""
    rows = damage(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return report(rows).select(
        F.col("conv").alias("conv_id"), *REPORT, "audit", F.col("repaired").alias("repaired_sha256")
    )


OP12_SQL = f"""
with recursive given as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
         {crc32_sql("(coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' '))")} % 20 as fault
  from conversations),
damaged as (
  select conv_id, turn, case when fault = 4 then 'user' else role end as role,
         case when fault = 1 then '' when fault = 2 then translate(text, '.!?', '') else text end as text,
         unnest(range(case when fault = 3 then 2 else 1 end)) as copy
  from given where fault <> 0),
placed as (
  select conv_id, turn, role, text, left(role, 1) as initial,
         rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as solid,
         row_number() over (partition by conv_id order by turn nulls first, role, md5(text)) as pos
  from damaged),
timed as (select *, row_number() over (partition by conv_id, role, text order by pos) as time from placed),
marked as (
  select *, case when solid = '' then 'blank' when time > 1 then 'duplicate'
                 when right(solid, 1) not in ('.', '!', '?') then 'truncated' else 'none' end as fault,
         lag(initial) over (partition by conv_id order by pos) || initial as pair
  from timed),
counts as (
  select conv_id, count(*) as n, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
         count(*) filter (where fault = 'blank') as blank, count(*) filter (where fault = 'duplicate') as duplicate,
         count(*) filter (where fault = 'truncated') as truncated,
         count(*) filter (where pos > 1 and pair not in ('su', 'ua', 'au')) as illegal
  from marked group by conv_id),
edits(s, letter, initial, t, cost) as (values
  (0, 'D', '', 0, 3), (1, 'D', '', 1, 3), (2, 'D', '', 2, 3), (3, 'D', '', 3, 3),
  (0, 'R', '', 2, 2), (1, 'R', '', 2, 2), (2, 'R', '', 3, 2), (3, 'R', '', 2, 2),
  (0, 'K', 's', 1, 0), (0, 'K', 'u', 2, 0), (1, 'K', 'u', 2, 0), (3, 'K', 'u', 2, 0), (2, 'K', 'a', 3, 0)),
moves as (
  select s, '' as before, letter, initial, t, cost, '' as line from edits
  union all
  select i.s, 'I', letter, initial, e.t, cost + 2, i.line
  from (values (0, 2, 'user:'), (1, 2, 'user:'), (2, 3, 'assistant:'), (3, 2, 'user:')) i(s, t, line)
  join edits e on e.s = i.t),
best as (
  select conv_id, n as pos, s, cast(v.cost as bigint) as cost, v.audit, v.kept
  from counts, (values (0, 0, '', []::varchar[]), (1, 4, 'II', ['user:', 'assistant:']), (2, 2, 'I', ['assistant:']),
                       (3, 0, '', []::varchar[])) v(s, cost, audit, kept)
  union all
  select conv_id, pos, s, w.cost, w.audit, w.kept from (
    select b.conv_id, b.pos - 1 as pos, v.s, min(struct_pack(
      cost := b.cost + v.cost + case when v.letter <> 'D' and m.fault = 'truncated' then 1 else 0 end,
      audit := v.before || v.letter || b.audit,
      kept := list_concat(
        case when v.line = '' then []::varchar[] else [v.line] end,
        case v.letter when 'D' then []::varchar[] when 'K' then [m.role || ':' || m.text]
                      else [case v.t when 2 then 'user:' else 'assistant:' end || m.text] end,
        b.kept))) as w
    from best b join marked m on m.conv_id is not distinct from b.conv_id and m.pos = b.pos
    join moves v on v.t = b.s
    where v.letter = 'D' or (m.fault in ('none', 'truncated') and (v.letter = 'R' or v.initial = m.initial))
    group by b.conv_id, b.pos, v.s))
select o.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
       coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, coalesce(cost, 0) as cost,
       coalesce(audit, '') as audit, sha256(coalesce(array_to_string(kept, chr(10)), '')) as repaired_sha256
from (select distinct conv_id from conversations) o
left join counts c on c.conv_id is not distinct from o.conv_id
left join best b on b.conv_id is not distinct from o.conv_id and b.pos = 0 and b.s = 0
"""
