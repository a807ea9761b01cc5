"""Merkle manifest of a dataset: one hash tree per group, one tree over the groups' roots.

Levels are built bottom up, each one stored: a node's digest is the SHA-256 of the hex digests of up to
``fan`` children. Positions come from a range-partitioned order (``plans.order``), so a group with a
third of all rows is spread like any other, and every later shuffle is keyed by (group, run), which has
at most ``fan`` rows. Paths are then handed down from the root, a level at a time, to the runs of leaves:
a run gets its ancestors' children once, for up to ``fan`` leaves.

Folding works on midstates. A parent keeps a copied hash state before each child slot (``Parent``);
to replace a child, the state of its slot is resumed with the replacement and the siblings to its right
only. The siblings to its left are never hashed again. Parents are kept while a task goes on.

Rows: a null field is ``-``; an empty text is ``0:``; a null group is a group of its own, the first; null
ids come first; rows with equal ids are ordered by their leaf, rows equal in every hashed field are
leaves of their own; an empty table has no rows and no root; texts of any length are hashed whole; other
columns, whatever they are called, play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from qaspark.llm.skew import join_counted
from qaspark.plans.order import row_index
from qaspark.session import store

FAN = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
GROUP = ["some", "part"]
KEPT_PARENTS = 1024
SLICE = 128
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass
class Manifest:
    """``runs``: the lowest parents with their leaves; ``levels``: stored parents of the groups' trees,
    lowest first; ``lone``: groups of one leaf; ``tops``: parents above the groups' roots; ``roots``: a row
    per group; ``root``: hex digest of the whole table, None if it is empty."""

    fan: int
    levels: list[DataFrame]
    lone: DataFrame
    roots: DataFrame
    tops: list[DataFrame]
    root: str | None


def leaf_digest(fields: Sequence[Column]) -> Column:
    """Hex SHA-256 of the fields, each as byte count, colon and value, or ``-`` for a null."""
    texts = [field.cast("string") for field in fields]
    sized = [F.concat(F.octet_length(text).cast("string"), F.lit(":"), text) for text in texts]
    return F.sha2(F.concat(*[F.coalesce(one, F.lit("-")) for one in sized]), 256)


def _climb(nodes: DataFrame, key: list[str], fan: int, most: int, name: str) -> list[DataFrame]:
    """Stored parents, level by level, of ``nodes`` (key, idx, n, digest and maybe item) with n > 1."""
    levels = []
    while most > 1:
        items = ["idx", "digest", *(["item"] if "item" in nodes.columns else [])]
        runs = nodes.filter("n > 1").groupBy(*key, F.expr(f"idx div {fan}").alias("up"))
        runs = runs.agg(F.max("n").alias("m"), F.sort_array(F.collect_list(F.struct(*items))).alias("run"))
        kids = F.transform("run", lambda one: one["digest"])
        parents = runs.select(
            *key,
            F.col("up").alias("idx"),
            F.expr(f"(m + {fan - 1}) div {fan}").alias("n"),
            F.sha2(F.array_join(kids, ""), 256).alias("digest"),
            kids.alias("kids"),
            *([F.transform("run", lambda one: one["item"]).alias("items")] if "item" in items else []),
        )
        nodes = store(parents, name)
        levels.append(nodes)
        most = -(-most // fan)
    return levels


def build(
    docs: DataFrame,
    fields: Sequence[str] = FIELDS,
    by: str = "source",
    order: str = "doc_id",
    fan: int = FAN,
    replaced: Column | None = None,
) -> Manifest:
    """The trees of all groups and the tree above them.

    ``replaced`` is the hex digest of a leaf to be folded in its place, null where it stays.
    """
    if fan < 2:
        raise ValueError("a parent has two children or more")
    spare = F.lit(None).cast("string") if replaced is None else replaced
    leaves = docs.select(
        F.col(by).isNotNull().alias("some"),
        F.coalesce(F.col(by).cast("string"), F.lit("")).alias("part"),
        F.col(order).alias("id"),
        leaf_digest([F.col(f) for f in fields]).alias("digest"),
        spare.alias("spare"),
        F.monotonically_increasing_id().alias("tie"),  # stored before it is used
    )
    leaves = store(leaves, "leaves")
    placed = row_index(leaves, [*GROUP, "id", "digest", "tie"], "row_no")
    sizes = store(placed.groupBy(*GROUP).agg(F.min("row_no").alias("first"), F.count(F.lit(1)).alias("n")), "sizes")
    total, most = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    nodes = join_counted(placed, sizes, GROUP, "n", total).select(
        *GROUP, (F.col("row_no") - F.col("first")).alias("idx"), "n", "digest",
        F.struct("id", "spare").alias("item"),
    )
    levels = _climb(nodes, GROUP, fan, most, "parents")
    lone = leaves.join(sizes.filter("n = 1").select(*GROUP), GROUP).select(
        *GROUP, "digest", F.array("digest").alias("kids"), F.array(F.struct("id", "spare")).alias("items")
    )
    ends = [level.filter("n = 1").select(*GROUP, "digest") for level in levels]
    roots = lone.select(*GROUP, "digest")
    for end in ends:
        roots = roots.unionByName(end)
    roots = row_index(store(roots, "roots"), GROUP, "idx")
    count = sizes.count()
    tops = _climb(roots.select("idx", F.lit(count).cast("long").alias("n"), "digest"), [], fan, count, "tops")
    last = tops[-1] if tops else roots
    found = last.select("digest").take(1)
    return Manifest(fan, levels, lone, roots, tops, found[0][0] if found else None)


def _hand_down(parents: DataFrame, key: list[str], fan: int, carried: list[str]) -> DataFrame:
    """(key, idx, path, carried) of the children of ``parents``: each gets its parent's level in front."""
    step = F.struct(F.col("slot").cast("int").alias("slot"), "kids")
    return (
        parents.select(*key, "idx", "kids", "path", *carried, F.posexplode("kids").alias("slot", "kid"))
        .select(*key, (F.col("idx") * fan + F.col("slot")).alias("idx"), F.concat(F.array(step), "path").alias("path"), *carried)
    )


def _runs(made: Manifest) -> DataFrame:
    """(items, kids, path, lone, subroot) of every run of leaves, with the path from there to the root."""
    kind = "array<struct<slot:int,kids:array<string>>>"
    empty = F.from_json(F.lit("[]"), kind).alias("path")
    paths = None
    for level in reversed(made.tops):
        above = level.select("idx", "kids", empty) if paths is None else level.select("idx", "kids").join(paths, "idx")
        paths = _hand_down(above, [], made.fan, [])
    roots = made.roots.withColumnRenamed("digest", "subroot")
    entry = roots.withColumn("path", empty) if paths is None else roots.join(paths, "idx")
    entry = store(entry.select(*GROUP, "subroot", "path"), "entries")
    done = made.lone.select(*GROUP, "items", "kids").join(entry, GROUP).withColumn("lone", F.lit(True))
    columns = ["items", "kids", "path", "lone", "subroot"]
    done, coming = done.select(*columns), None
    for number, level in reversed(list(enumerate(made.levels))):
        own = level.select(*GROUP, "idx", "n", "kids", *(["items"] if number == 0 else []))
        above = own.filter("n = 1").join(entry, GROUP)
        if coming is not None:
            above = above.unionByName(own.filter("n > 1").join(coming, [*GROUP, "idx"]))
        if number:
            coming = _hand_down(above, GROUP, made.fan, ["subroot"])
        else:
            done = done.unionByName(above.withColumn("lone", F.lit(False)).select(*columns))
    return done


class Parent:
    """Hash states before each child slot, copied while the children are hashed once."""

    def __init__(self, kids: Sequence[str]):
        self.kids = [kid.encode() for kid in kids]
        self.states = []
        state = hashlib.sha256()
        for kid in self.kids:
            self.states.append(state.copy())
            state.update(kid)

    def fold(self, slot: int, digest: str) -> str:
        """The parent's digest with another child: only that child and those after it are hashed."""
        state = self.states[slot].copy()
        state.update(b"".join([digest.encode(), *self.kids[slot + 1 :]]))
        return state.hexdigest()

    def others(self, slot: int) -> bytes:
        return b"".join(self.kids[:slot] + self.kids[slot + 1 :])


def prove(made: Manifest) -> DataFrame:
    """(id, leaf, subroot, proof, folded) of every leaf.

    ``proof`` is the digest of all siblings from the leaf up; ``folded`` the root as recomputed from the
    replaced leaf, or from the leaf itself where nothing replaces it.
    """
    runs = _runs(made)
    kind = next(f.dataType for f in made.lone.schema["items"].dataType.elementType.fields if f.name == "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parents: dict[tuple[str, ...], Parent] = {}

        def parent(kids: list[str]) -> Parent:
            if len(parents) >= KEPT_PARENTS:
                parents.clear()
            name = tuple(kids)
            if name not in parents:
                parents[name] = Parent(kids)
            return parents[name]

        for batch in batches:
            ids = batch.schema.field("items").type.value_type.field("id").type
            for at in range(0, batch.num_rows, SLICE):
                out = []
                for row in batch.slice(at, SLICE).to_pylist():
                    above = [(parent(step["kids"]), step["slot"]) for step in row["path"]]
                    rest = b"".join(p.others(slot) for p, slot in above)
                    own = None if row["lone"] else Parent(row["kids"])
                    for slot, (item, leaf) in enumerate(zip(row["items"], row["kids"])):
                        digest = item["spare"] or leaf
                        if own:
                            digest = own.fold(slot, digest)
                        for p, place in above:
                            digest = p.fold(place, digest)
                        near = own.others(slot) if own else b""
                        proof = hashlib.sha256(near + rest).hexdigest()
                        out.append((item["id"], leaf, row["subroot"], proof, digest))
                columns = list(zip(*out)) or [[]] * 5
                kinds = [ids, *[pa.string()] * 4]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)], ["id", "leaf", "subroot", "proof", "folded"]
                )

    shape = f"id {kind.simpleString()}, leaf string, subroot string, proof string, folded string"
    return runs.mapInArrow(run, shape)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: digests and proof of every document, and the root folded from tampered leaves."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*FIELDS)
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    lowered = [F.translate("text", UPPER, LOWER) if f == "text" else F.col(f) for f in FIELDS]
    made = build(docs, replaced=F.when(tampered, leaf_digest(lowered)))
    root = F.lit(made.root)
    return prove(made).select(
        F.col("id").alias("doc_id"),
        "leaf",
        "subroot",
        root.alias("root"),
        F.col("proof").alias("proof_sha256"),
        F.col("folded").alias("folded_root"),
        (F.col("folded") == root).alias("verified"),
    )


# --- SQL --------------------------------------------------------------------------------------


def crc32_sql(text: str) -> str:
    """DuckDB expression: CRC-32 of an ASCII text, bit by bit."""
    bits = f"list_transform(range(8 * length({text})), lambda i: (ascii(substr({text}, i // 8 + 1, 1)) >> (i % 8)) & 1)"
    step = "(xor(c, b) >> 1)"
    return (
        f"xor(list_reduce(list_concat([4294967295::bigint], {bits}), "
        f"lambda c, b: xor({step}, 3988292384 * (xor(c, b) & 1))), 4294967295)"
    )


def _sql(depth: int = 8) -> str:
    def field(name: str, text: str = "text") -> str:
        value = f"cast({text if name == 'text' else name} as varchar)"
        return f"coalesce(octet_length(encode({value})) || ':' || {value}, '-')"

    leaf = " || ".join(field(f) for f in FIELDS)
    other = " || ".join(field(f, f"translate(text, '{UPPER}', '{LOWER}')") for f in FIELDS)
    window = "over (partition by {key}idx // 16 order by idx rows between "
    parts = [
        f"""l0 as (select *, row_number() over (partition by source order by doc_id nulls first, digest) - 1 as idx,
  count(*) over (partition by source) as n from (
  select doc_id, source, sha256({leaf}) as digest,
         case when {crc32_sql("cast(doc_id as varchar)")} % 5 = 0 then sha256({other}) end as spare from documents))"""
    ]
    for tree, key in (("l", "source, "), ("t", "")):
        if tree == "t":
            ends = " union all ".join(f"select source, digest from l{k} where n = 1" for k in range(depth + 1))
            parts.append(f"roots as ({ends})")
            parts.append(
                "t0 as (select *, row_number() over (order by source nulls first) - 1 as idx, "
                "count(*) over () as n from roots)"
            )
        for k in range(1, depth + 1):
            parts.append(
                f"{tree}{k} as (select {key}idx // 16 as idx, (max(n) + 15) // 16 as n, "
                f"sha256(string_agg(digest, '' order by idx)) as digest from {tree}{k - 1} where n > 1 group by {key}idx // 16)"
            )
        for k in range(depth):
            w = window.format(key=key)
            parts.append(
                f"{tree}s{k} as (select {key}idx, "
                f"coalesce(string_agg(digest, '') {w} unbounded preceding and 1 preceding), '') as a, "
                f"coalesce(string_agg(digest, '') {w} 1 following and unbounded following), '') as b "
                f"from {tree}{k} where n > 1)"
            )
    parts.append("""p0 as (select l0.doc_id, l0.source, l0.digest as leaf, coalesce(l0.spare, l0.digest) as d, '' as proof,
  l0.idx as at, t0.idx as top, t0.digest as subroot from l0 join t0 on l0.source is not distinct from t0.source)""")
    done = 0
    for tree, place in (("l", "at"), ("t", "top")):
        for k in range(depth):
            same = " and p.source is not distinct from s.source" if tree == "l" else ""
            parts.append(
                f"p{done + 1} as (select p.* replace (p.proof || coalesce(s.a || s.b, '') as proof, "
                f"case when s.idx is null then p.d else sha256(s.a || p.d || s.b) end as d) "
                f"from p{done} p left join {tree}s{k} s on s.idx = p.{place} // {16**k}{same})"
            )
            done += 1
    root = " union all ".join(f"select digest from t{k} where n = 1" for k in range(depth + 1))
    parts.append(f"root as ({root})")
    steps = ",\n".join(parts)
    return f"""with {steps}
select p.doc_id, p.leaf, p.subroot, root.digest as root, sha256(p.proof) as proof_sha256, p.d as folded_root,
       p.d = root.digest as verified from p{done} p, root"""


OP13_SQL = _sql()
