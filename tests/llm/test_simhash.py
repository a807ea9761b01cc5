import random
import re

import numpy as np
import pyarrow as pa
import xxhash

from pyspark.sql import functions as F

from qaspark.llm import simhash


def plain(text, shingle=4):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    shingles = [" ".join(words[n : n + shingle]) for n in range(max(len(words) - shingle + 1, min(len(words), 1)))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(prints, ids):
    label = list(range(len(prints)))
    for a in range(len(prints)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 4 and label[a] != label[b]:
                old, new = label[a], label[b]
                label = [new if x == old else x for x in label]
    low = {x: min((i for i, y in zip(ids, label) if y == x and i is not None), default=None) for x in set(label)}
    return [low[x] for x in label]


def test_the_code_is_perfect():
    table = simhash.golay_tables()
    assert table.min() == 0 and len(np.unique(table)) == 2048
    rng = np.random.default_rng(1)
    words = rng.integers(0, 1 << 23, 500)
    for flips in range(3):
        other = words.copy()
        for n in range(len(words)):
            other[n] ^= sum(1 << int(b) for b in rng.choice(23, flips, replace=False))
        mine, yours = (simhash.segment_keys(x, table) for x in (words, other))
        sets = [{(p, k) for p, k in zip(*x)} for x in (mine, yours)]
        shared = {p for p, _ in sets[0] & sets[1]}
        assert shared == set(range(len(words)))
        assert np.bincount(mine[0]).max() <= 6


def test_four_bits_always_share_a_key():
    table, rng = simhash.golay_tables(), np.random.default_rng(2)
    prints = rng.integers(-(1 << 63), 1 << 63, 3000, np.int64)
    other = prints.view(np.uint64).copy()
    for n in range(len(prints)):
        for bit in rng.choice(64, n % 5, replace=False):
            other[n] ^= np.uint64(1) << np.uint64(bit)
    sets = [set(zip(*(x.tolist() for x in simhash.fuzzy_keys(p, table)))) for p in (prints, other.view(np.int64))]
    assert {p for p, _ in sets[0] & sets[1]} == set(range(len(prints)))


def test_fingerprints():
    rng = random.Random(3)
    texts = [None, "", " \n", "One", "a b c", "A b\x0bc\td", "ÄÖ ü é", "x " * 3000]
    texts += [" ".join(rng.choice(["É", "b", "Cc", "d"]) for _ in range(rng.randrange(40))) for _ in range(60)]
    found = simhash.fingerprints(pa.array(texts), 4)
    assert found.tolist() == [plain(t) for t in texts]


def test_groups(spark):
    rng = random.Random(4)
    text = lambda n: " ".join(rng.choice("abcdefghij") for _ in range(n))
    base = [text(400) for _ in range(12)]
    texts = [None, "", "one", "one"] + base * 2
    for one in base:  # chains of small edits
        for _ in range(5):
            words = one.split()
            words[rng.randrange(len(words))] = "zz"
            one = " ".join(words)
            texts.append(one)
    ids = [None, *range(1, len(texts))]
    rng.shuffle(ids)
    docs = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string").selectExpr("*", "'e' as fp").repartition(3)
    expected = brute([plain(t) for t in texts], ids)
    assert len(set(expected)) < len(texts) - 20
    for group in (2048, 3):
        rows, _ = simhash.group_documents(docs, group=group)
        found = {r.id: (r.fp & (1 << 64) - 1, r.component) for r in rows.collect()}
        assert found == {i: (plain(t), c) for i, t, c in zip(ids, texts, expected)}
    kept = simhash.keep_one(docs).collect()
    assert {r.doc_id for r in kept} == set(expected) and len(kept) == len(set(expected))
    assert all(r.fp == "e" for r in kept)


def test_no_rows_and_repeated_rows(spark):
    docs = spark.createDataFrame([(1, "a b c d e"), (1, "a b c d e"), (None, "q")], "doc_id long, text string")
    assert sorted(simhash.keep_one(docs).collect(), key=str) == sorted(docs.distinct().collect(), key=str)
    assert simhash.keep_one(docs.limit(0)).collect() == []


def test_parts_split_a_large_key_without_losing_a_link(spark):
    rng = random.Random(8)
    prints = [rng.getrandbits(64)]
    for _ in range(40):  # a chain; every step is at the limit
        one = prints[-1]
        for bit in rng.sample(range(64), 4):
            one ^= 1 << bit
        prints.append(one)
    signed = [one - (1 << 64) * (one >> 63) for one in prints]
    distinct = spark.createDataFrame([(one,) for one in signed], "fp long")
    assert all(parts - choose == simhash.MAX_BITS for parts, choose, _ in simhash.SPLITS)
    # each level alone: prints of neighbours share a key, whatever the four bits are
    pairs = spark.createDataFrame(list(enumerate(zip(signed, signed[1:]))), "n long, two struct<_1:long,_2:long>")
    for parts, choose, _ in simhash.SPLITS:
        rows = pairs.select("n", F.explode(F.array("two._1", "two._2")).alias("fp")).withColumn("key", F.col("n"))
        keys = rows.select("n", "fp", F.explode(F.array(*simhash._part_keys(parts, choose))).alias("k"))
        met = keys.groupBy("n", "k").agg(F.count_distinct("fp").alias("prints")).filter("prints = 2")
        assert met.select("n").distinct().count() == len(prints) - 1
    # the finest level right after the first keys, whatever their size
    found = simhash.find_links(distinct, group=1, splits=((8, 4, 1),)).collect()
    near = {one: {one} for one in signed}
    for r in found:
        union = near[r.a] | near[r.b]
        for one in union:
            near[one] = union
    assert near[signed[0]] == set(signed)
    assert all(bin((r.a ^ r.b) & (1 << 64) - 1).count("1") <= 4 for r in found)
