import hashlib
import zlib

import duckdb
import pytest

from qaspark.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    values = [None if v is None else str(v) for v in row]
    return sha("".join("-" if v is None else f"{len(v.encode())}:{v}" for v in values))


def runs(nodes):
    return [nodes[n : n + 16] for n in range(0, len(nodes), 16)]


def top(nodes):
    while len(nodes) > 1:
        nodes = [sha("".join(run)) for run in runs(nodes)]
    return nodes[0]


def siblings(nodes, at):
    out = ""
    while len(nodes) > 1:
        run = runs(nodes)[at // 16]
        out += "".join(run[: at % 16] + run[at % 16 + 1 :])
        nodes, at = [sha("".join(r)) for r in runs(nodes)], at // 16
    return out


def brute(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for name in names:
        groups[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
    leaves = {name: [leaf_of(r) for r in groups[name]] for name in names}
    subroots = [top(leaves[name]) for name in names]
    root = top(subroots)
    out = []
    for place, name in enumerate(names):
        for at, row in enumerate(groups[name]):
            changed = leaves[name][at]
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and row[4] is not None:
                low = "".join(c.lower() if "A" <= c <= "Z" else c for c in row[4])
                changed = leaf_of((*row[:4], low))
            # plainly built anew, with that leaf in place
            new = top(leaves[name][:at] + [changed] + leaves[name][at + 1 :])
            folded = top(subroots[:place] + [new] + subroots[place + 1 :])
            proof = sha(siblings(leaves[name], at) + siblings(subroots, place))
            out.append((row[0], leaves[name][at], subroots[place], root, proof, folded, folded == root))
    return out


def query(spark, tmp_path, rows, schema=SCHEMA):
    df = spark.createDataFrame(rows, schema)
    df.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    return merkle.op13_merkle_manifest(spark, str(tmp_path))


def key(row):
    return tuple((v is not None, str(v)) for v in row)


ODD = [
    (1, "a", "en", 3, "Abc"),
    (1, "a", "en", 3, "Abc"),  # repeated row
    (1, "a", None, None, None),  # same id
    (None, None, None, None, None),
    (None, None, None, None, None),
    (7, None, "é", 0, ""),
    (8, "", "en", 1, "É\n\tZ"),  # an empty source is not a null one
    (9, "é", "en", 1, "X" * 300_000),
]


@pytest.mark.parametrize("many", [0, 3])
def test_against_trees_built_anew(spark, tmp_path, many):
    # 300 leaves of one source have three levels, with runs of one child; 20 sources have two
    rows = [(n, "hot", "en", n, f"Text {n}") for n in range(100 * many)]
    rows += [(1000 + n, f"s{n % 20}", "en", n, f"T {n}") for n in range(9 * many)]
    rows += ODD
    got = [tuple(r) for r in query(spark, tmp_path, rows).collect()]
    assert sorted(got, key=key) == sorted(brute(rows), key=key)
    assert not many or 0 < sum(not r[-1] for r in got) < len(got)


def test_sql_agrees_on_odd_rows(spark, tmp_path):
    got = [tuple(r) for r in query(spark, tmp_path, ODD).collect()]
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    assert sorted(got, key=key) == sorted(con.sql(merkle.OP13_SQL).fetchall(), key=key)


def test_empty_table_and_one_row(spark, tmp_path):
    assert query(spark, tmp_path / "none", []).collect() == []
    (row,) = query(spark, tmp_path / "one", [(5, "a", "en", 1, "x")]).collect()
    assert row.leaf == row.subroot == row.root and row.proof_sha256 == sha("") and row.verified


def test_other_fields_and_fans(spark):
    docs = spark.createDataFrame([(n, n % 2, "x", n, n) for n in range(40)], "id long, kind int, part string, idx long, digest long")
    made = merkle.build(docs, fields=["id", "part"], by="kind", order="id", fan=3)
    rows = merkle.prove(made).collect()
    assert len(rows) == 40 and {r.folded for r in rows} == {made.root}
    assert len(made.levels) == 3 and made.roots.count() == 2


def test_fold_hashes_only_the_right_side():
    kids = [sha(str(n)) for n in range(16)]
    parent = merkle.Parent(kids)
    for slot in range(16):
        assert parent.fold(slot, "x" * 64) == sha("".join([*kids[:slot], "x" * 64, *kids[slot + 1 :]]))
        assert parent.fold(slot, kids[slot]) == sha("".join(kids))
