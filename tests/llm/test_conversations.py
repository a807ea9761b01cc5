import hashlib
import random
import re
import zlib

import duckdb
import numpy as np

from qaspark.llm import conversations

SCHEMA = "conv_id long, turn long, role string, text string"
NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}
NAMES = {"u": "user", "a": "assistant"}


def cheapest(rows):
    """(cost, audit, lines) by trying every edit; rows: (initial, fault, role, text)."""
    memo = {}

    def best(n, last, spare):
        if (n, last, spare) in memo:
            return memo[n, last, spare]
        found = []
        if n == len(rows):
            if last in ("", "a"):
                found.append((0, "", []))
        else:
            initial, fault, role, text = rows[n]
            cost, audit, lines = best(n + 1, last, 2)
            found.append((cost + 3, "D" + audit, lines))
            if fault not in ("blank", "duplicate"):
                extra = int(fault == "truncated")
                if (initial == "s" and last == "") or initial == NEXT[last]:
                    cost, audit, lines = best(n + 1, initial, 2)
                    found.append((cost + extra, "K" + audit, [f"{role}:{text}", *lines]))
                cost, audit, lines = best(n + 1, NEXT[last], 2)
                found.append((cost + 2 + extra, "R" + audit, [f"{NAMES[NEXT[last]]}:{text}", *lines]))
        if spare:
            cost, audit, lines = best(n, NEXT[last], spare - 1)
            found.append((cost + 2, "I" + audit, [f"{NAMES[NEXT[last]]}:", *lines]))
        memo[n, last, spare] = min(found) if found else (10**9, "", [])
        return memo[n, last, spare]

    return best(0, "", 2)


def brute(rows):
    out = []
    for conv in {r[0] for r in rows}:
        damaged = []
        for _, turn, role, text in (r for r in rows if r[0] == conv):
            role, text = (" " if v is None else v for v in (role, text))
            name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
            fault = zlib.crc32(name.encode()) % 20
            if fault == 1:
                text = ""
            if fault == 2:
                text = re.sub("[.!?]", "", text)
            if fault == 4:
                role = "user"
            damaged += [(turn, role, text)] * {0: 0, 3: 2}.get(fault, 1)
        damaged.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(r[2].encode()).hexdigest()))
        marked, seen = [], set()
        for _, role, text in damaged:
            solid = text.rstrip(" \t\n\x0b\x0c\r")
            fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else ""
            seen.add((role, text))
            marked.append((role[:1], fault, role, text))
        turns = [r[0] for r in damaged if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        counts = [sum(m[1] == f for m in marked) for f in ("blank", "duplicate", "truncated")]
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(marked, marked[1:]))
        cost, audit, lines = cheapest(marked)
        out.append((conv, gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return out


def query(spark, folder, rows, extra=()):
    df = spark.createDataFrame(rows, SCHEMA)
    for name in extra:
        df = df.withColumn(name, df.role)
    df.repartition(3).write.parquet(str(folder / "conversations.parquet"))
    return conversations.op12_conversation_repair(spark, str(folder))


def key(row):
    return tuple((v is not None, str(v)) for v in row)


def made_up():
    rng, rows = random.Random(5), []
    texts = ["Yes.", "no", "", None, " \t\n", "Why?", "a ", "Stop!  \n", "é.\x0b", "x\u0085"]
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "User"]
    for conv in [None, *range(120)]:
        for _ in range(rng.randint(1, 14)):
            turn = rng.choice([None, *range(12)])
            rows.append((conv, turn, rng.choice(roles), rng.choice(texts)))
    rows += [(900, 1, "user", "Hi.")] * 5  # repeated rows
    rows += [(901, n, NAMES["ua"[n % 2]], f"Turn {n}.") for n in range(700)]
    rows += [(902, 0, "user", "word " * 200_000 + "."), (902, 1, "assistant", "ok.")]
    return rows


def test_against_every_edit_and_sql(spark, tmp_path):
    rows = made_up()
    got = sorted((tuple(r) for r in query(spark, tmp_path, rows, ["conv", "digest", "head"]).collect()), key=key)
    small = [r for r in rows if r[0] != 901]  # the plain search is recursive
    assert [r for r in got if r[0] != 901] == sorted(brute(small), key=key)
    con = duckdb.connect()
    con.sql(f"create view conversations as select * from '{tmp_path}/conversations.parquet/*.parquet'")
    assert got == sorted(con.sql(conversations.OP12_SQL).fetchall(), key=key)


def test_no_rows_after_damage_and_empty_table(spark, tmp_path):
    gone = next(n for n in range(1000) if zlib.crc32(f"{n}:0".encode()) % 20 == 0)
    (row,) = query(spark, tmp_path / "gone", [(gone, 0, "user", "Hi.")]).collect()
    assert tuple(row) == (gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert query(spark, tmp_path / "none", []).collect() == []


def test_repaired_rows(spark):
    rows = made_up()
    given = conversations.damage(spark.createDataFrame(rows, SCHEMA))
    found = {}
    for r in conversations.repair(given).orderBy("conv", "place").collect():
        found.setdefault(r.conv, []).append(r)
    for r in conversations.report(given).collect():
        own = found.get(r.conv, [])
        assert re.fullmatch("(s?(ua)+)?", "".join(x.role[0] for x in own))
        assert "".join(x.edit for x in own) == r.audit.replace("D", "")
        text = "\n".join(f"{x.role}:{x.text}" for x in own)
        assert hashlib.sha256(text.encode()).hexdigest() == r.repaired


def test_block_tables_against_every_edit():
    rng = random.Random(3)
    faults = {8: "blank"}
    for block in (1, 2, 4):
        tables = conversations.Tables(block)
        for _ in range(300):
            symbols = [rng.randrange(9) for _ in range(rng.randint(0, 13))]
            rows = [
                ("xsua"[s >> 1] if s < 8 else "u", faults.get(s, "truncated" if s & 1 else ""), "", "") for s in symbols
            ]
            assert tables.edits(np.array(symbols, np.uint8)) == cheapest(rows)[:2]


def test_a_long_conversation_is_read_by_blocks():
    symbols = np.random.default_rng(0).integers(0, 9, 200_001).astype(np.uint8)
    one, four = conversations.Tables(1).edits(symbols), conversations.Tables(4).edits(symbols)
    assert one == four and len(four[1]) >= len(symbols)
