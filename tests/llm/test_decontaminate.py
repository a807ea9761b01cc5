import hashlib
import random
import re

from qaspark.llm import decontaminate as dec

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return WORD.findall(lowered)


def brute(texts, items, window=10):
    wanted = {}
    for name, text in items:
        w = words(text)
        size = min(window, len(w))
        for at in range(len(w) - size + 1 if w else 0):
            wanted.setdefault(tuple(w[at : at + size]), set()).add(name)
    sizes = {len(k) for k in wanted}
    out = []
    for text in texts:
        w, hit, names = words(text), set(), set()
        for size in sizes:
            for at in range(len(w) - size + 1):
                key = tuple(w[at : at + size])
                if key in wanted:
                    hit |= set(range(at, at + size))
                    names |= wanted[key]
        out.append((len(w), len(hit), sorted(str(n) for n in names if n is not None)))
    return out


def found(spark, texts, items, **settings):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    table = spark.createDataFrame(items, "item_id long, text string")
    rows = dec.find_hits(docs, table, **settings).select("doc_id", "hits", dec.n_hit().alias("n")).collect()
    return [(r.hits.n_words, r.n, r.hits["items"]) for r in sorted(rows)]


def made(seed):
    rng = random.Random(seed)
    vocabulary = ["a", "b", "Éa", "x1", "dd"]
    say = lambda n: "".join(rng.choice(vocabulary) + rng.choice([" ", ", ", "\n"]) for _ in range(n))
    items = [(n, say(rng.choice([1, 2, 4, 12, 15]))) for n in range(4, 14)] + [(3, say(12)), (3, say(14)), (None, say(11)), (1, None), (2, " .")]
    texts = [None, "", "...", *(say(rng.randrange(40)) for _ in range(60))]
    texts += [say(5) + items[rng.randrange(12)][1].upper() + say(5) for _ in range(20)]
    return texts, items


def test_against_brute_force(spark):
    for seed in (1, 2):
        texts, items = made(seed)
        assert found(spark, texts, items) == brute(texts, items)
        long_items = [i for i in items if len(words(i[1])) > 10]
        assert found(spark, texts, long_items, window=3) == brute(texts, long_items, 3)


def test_blocks_of_items_give_the_same(spark):
    texts, items = made(3)
    assert found(spark, texts, items, item_bytes=300) == brute(texts, items)


def test_no_items_no_documents(spark):
    assert found(spark, ["a b"], []) == [(2, 0, [])]
    assert found(spark, [], [(1, "a b")]) == []


def test_spans_are_cut_and_covered_documents_go(spark):
    passage = "one two three four five six seven eight nine ten eleven"
    docs = spark.createDataFrame(
        [(1, f"Before it, {passage.upper()}! And äfter it comes more text than that, much more, as all can see here.", "x"), (2, passage, "y"), (3, "clean", "z"), (4, None, "n")],
        "doc_id long, text string, hits string",
    )
    items = spark.createDataFrame([(7, passage)], "item_id long, text string")
    rows = {r.doc_id: (r.text, r.hits) for r in dec.remove_spans(docs, items).collect()}
    assert rows == {
        1: ("Before it, ! And äfter it comes more text than that, much more, as all can see here.", "x"),
        3: ("clean", "z"),
        4: (None, "n"),
    }


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").orderBy("doc_id").collect()
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    rows = dec.op3_benchmark_decontamination(spark, folder).orderBy("doc_id").collect()
    expected = brute([d.text for d in docs], items)
    assert sum(e[1] > 0 for e in expected) >= 3
    for row, (n, hit, names) in zip(rows, expected, strict=True):
        digest = hashlib.sha256(",".join(names).encode()).hexdigest()
        assert tuple(row)[1:] == (n, hit, len(names), digest, hit > 0)


def test_flat_automaton_knows_every_stretch_and_no_other():
    rng = random.Random(6)
    for letters in (2, 3, 40):
        items = [[rng.randrange(letters) for _ in range(rng.choice([1, 3, 12, 30]))] for _ in range(12)]
        one = dec.Automaton(4)
        for item in items:
            one.add(item)
        for n, item in enumerate(items):
            one.mark(item, n)
        one.finish()
        wanted = {}
        for n, item in enumerate(items):
            size = min(4, len(item))
            for at in range(len(item) - size + 1):
                wanted.setdefault(tuple(item[at : at + size]), set()).add(n)
        text = [rng.randrange(-1, letters) for _ in range(300)] + items[0] + items[1]
        got = {(a, b): set(found) for a, b, found in one.stream(text)}
        want = {}
        for key, names in wanted.items():
            for at in range(len(text) - len(key) + 1):
                if tuple(text[at : at + len(key)]) == key:
                    want[at, at + len(key) - 1] = names
        assert got == want
