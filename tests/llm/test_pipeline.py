import re

import corpus_pipeline
import public_tokenizers
import tiktoken

from qaspark.llm import bpe, toxicity
from qaspark.session import store

from . import test_decontaminate, test_lines, test_simhash

FOLDER = "/root/testdata/sf0.001"


def cut(text, items):
    """The text without its hit words, or None if it mostly consists of them."""
    spans = [m.span() for m in test_decontaminate.WORD.finditer(re.sub("[A-Z]", lambda m: m[0].lower(), text))]
    own = test_decontaminate.words(text)
    wanted = set()
    for _, item in items:
        words = test_decontaminate.words(item)
        size = min(10, len(words))
        wanted |= {tuple(words[n : n + size]) for n in range(len(words) - size + 1) if words}
    hit = set()
    for size in {len(w) for w in wanted}:
        for n in range(len(own) - size + 1):
            if tuple(own[n : n + size]) in wanted:
                hit |= set(range(n, n + size))
    if own and len(hit) > 0.5 * len(own):
        return None
    out, n, at = [], 0, 0
    while n < len(own):
        if n in hit:
            last = n
            while last + 1 in hit:
                last += 1
            out.append(text[at : spans[n][0]])
            at, n = spans[last][1], last
        n += 1
    return "".join([*out, text[at:]])


def test_against_plain_python(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    scored = toxicity.score(docs, toxicity.fit_on(docs, labels)).collect()
    rest = [(r.doc_id, r.text) for r in scored if r.score < 0.7]
    assert 0 < len(scored) - len(rest) < 0.3 * len(scored)
    kept = test_lines.brute(rest, 10, 1, "first")
    texts = [kept[doc][2] for doc, _ in rest]
    ids = [doc for doc, _ in rest]
    groups = test_simhash.brute([test_simhash.plain(t) for t in texts], ids)
    chosen = [(doc, text) for doc, text, group in zip(ids, texts, groups) if doc == group]
    expected = {doc: new for doc, text in chosen if (new := cut(text, items)) is not None}
    assert len(chosen) < len(rest)
    plain = tiktoken.Encoding(
        "plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(corpus_pipeline.RANKS), special_tokens={}
    )
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    assert {r.doc_id: r.text for r in rows} == expected and len(rows) == len(expected)
    for row in rows:
        assert row.ids == plain.encode_ordinary(row.text) and row.n_tokens == len(row.ids)
        assert row.n_chars == len(row.text)


def test_odd_rows_pass_through_every_stage(spark):
    docs = spark.createDataFrame(
        [
            (1, None, "en", None, None, 7, "x", 1),
            (1, None, "en", None, None, 7, "x", 1),
            (None, "", None, "s", 0, None, None, 2),
            (3, "a b c d e f g", "en", "s", 13, 3, "y", 3),
            (4, "word " * 200_000, "en", "s", 1_000_000, 3, "y", 4),
        ],
        "doc_id long, text string, lang string, source string, n_chars long, ids long, row string, k1 long",
    )
    for name, stage in corpus_pipeline.STAGES:
        for given in (docs, docs.limit(0), docs.drop("n_chars")):
            out = stage(spark, given, FOLDER)
            if name == "byte_bpe":
                assert set(out.columns) == {*given.columns, "ids", "n_tokens"} and len(out.columns) == len(set(out.columns))
            else:
                assert out.columns == given.columns
            found = store(out, "odd")  # can be written: no column stands twice
            assert found.count() <= given.count()
            assert name == "simhash_near_dedup" or found.count() == given.count()
            if name != "byte_bpe":
                assert {(r.doc_id, r.k1) for r in found.collect()} <= {(r.doc_id, r.k1) for r in given.collect()}


def test_a_text_with_many_copies_leaves_once(spark):
    text = "The first line of it.\nAnother one that follows here.\nAnd the last line."
    rows = [(n, text, "en", "s", len(text)) for n in (*range(9, 33), 100)]
    rows += [(200 + n, f"own words number {n} and {n * 7} stand here alone {n * n}", "en", "s", 1) for n in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES:
        docs = store(stage(spark, docs, FOLDER), name)
    left = {r.doc_id: r.text for r in docs.collect()}
    assert left[9] == text and list(left.values()).count(text) == 1
    assert {200 + n for n in range(5)} <= set(left)
