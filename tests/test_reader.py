import itertools
import os

import pytest
from pyspark.sql import functions as F

from qaspark.checks import reader as checks
from qaspark.operators import chunks as ch, decode, ensemble as vote, losses, metrics

FOLDER = "/root/testdata/sf0.001"
OFFSETS = "array<struct<s:int,e:int>>"


def qa_row(spark, n, question="", answer=None):
    context = " ".join(f"t{i}" for i in range(n))
    start, end = answer or (None, None)
    return spark.createDataFrame(
        [("x", question, context, start, end)],
        "id string, question string, context string, start_char int, end_char int",
    )


def windows(spark, n, width, overlap):
    rows = ch.chunk(qa_row(spark, n), width + 3, overlap).orderBy("chunk_no").collect()
    return [(int(r["tokens"][0][1:]), int(r["tokens"][-1][1:]) + 1) for r in rows]


def test_windows(spark):
    assert windows(spark, 10, 4, 2) == [(0, 4), (2, 6), (4, 8), (6, 10)]
    assert windows(spark, 3, 4, 2) == [(0, 3)] and windows(spark, 4, 4, 2) == [(0, 4)]
    assert windows(spark, 9, 4, 2)[-1] == (6, 9)


@pytest.mark.parametrize("words", [0, 5, 12, 14, 15, 16])
def test_no_feature_above_the_longest_and_no_token_lost(spark, words):
    rows = ch.chunk(qa_row(spark, 30, "q " * words), 20, 8).orderBy("chunk_no").collect()
    assert {t for r in rows for t in r["tokens"]} == {f"t{i}" for i in range(30)}
    assert all(len(r["tokens"]) + words + ch.SPECIALS <= 20 for r in rows)
    for one, two in zip(rows, rows[1:]):
        assert one["tokens"][len(one["tokens"]) - one["shared"] :] == two["tokens"][: one["shared"]]


def test_question_without_room_raises(spark):
    with pytest.raises(Exception, match="no room"):
        ch.chunk(qa_row(spark, 6, "q " * 17), 20, 2).collect()


def test_empty_context_gives_one_empty_chunk(spark):
    rows = ch.chunk(qa_row(spark, 0), 20, 2).collect()
    assert [(r["chunk_no"], r["tokens"], r["offsets"]) for r in rows] == [(0, [], [])]


def test_offsets_point_at_tokens(spark):
    context = " ".join(f"t{i}" for i in range(20))
    rows = ch.with_feature_offsets(ch.chunk(qa_row(spark, 20, "what is"), 12, 3)).collect()
    for r in rows:
        spans = r["offsets"]
        assert spans[:4] == [None] * 4 and spans[-1] is None
        assert [context[o["s"] : o["e"]] for o in spans[4:-1]] == r["tokens"]


@pytest.mark.parametrize(
    "answer, expected",
    [
        ((3, 5), [(4, 4), (0, 0)]),  # t1 is only in the first chunk
        ((9, 11), [(6, 6), (4, 4)]),  # t3 is shared by both
        ((6, 11), [(5, 6), (3, 4)]),  # t2 t3
        ((7, 8), [(5, 5), (3, 3)]),  # inside t2
        ((6, 17), [(0, 0), (3, 6)]),  # t2..t5 ends in the second chunk
        ((None, None), [(0, 0), (0, 0)]),
    ],
)
def test_labels(spark, answer, expected):
    rows = ch.align_labels(ch.chunk(qa_row(spark, 6, "q", answer), 8, 2)).orderBy("chunk_no").collect()
    assert [(r["start_pos"], r["end_pos"]) for r in rows] == expected


def test_padding(spark):
    vocabulary = spark.createDataFrame([("t0", 7), ("q", 9)], "token string, token_id int")
    ids = {ch.PAD: 0, ch.UNKNOWN: 1, ch.CLS: 2, ch.SEP: 3}
    cut = ch.chunk(qa_row(spark, 2, "q"), 20, 2)
    row = ch.encode_pad(cut, vocabulary, ids).first()
    assert row["input_ids"] == [2, 9, 3, 7, 1, 3, 0, 0]
    assert row["attention_mask"] == [1] * 6 + [0] * 2
    assert len(ch.encode_pad(cut, vocabulary, ids, length=20).first()["input_ids"]) == 20


def test_candidates(spark):
    docs = spark.createDataFrame([(i, f"t{i % 4}", f"body {i}") for i in range(12)], "doc_id long, title string, text string")
    asked = docs.filter("doc_id < 2").select(F.col("doc_id").alias("qid"), "doc_id", "title")
    rows = ch.build_candidates(asked, docs, 4).orderBy("qid", "cand_no").collect()
    assert [r["label"] for r in rows] == [1, 0, 0, 0, 0] * 2
    assert rows[0]["cand_text"] == "@t0:body 0"
    assert spark.range(1).select(ch.pair_text(F.lit("q"), F.lit("@t:b"))).first()[0] == "q[SEP]@t:b"


CONTEXT = "서울은 한국의 수도다"
SPANS = [(0, 3), (4, 7), (8, 11)]


def decoded(spark, starts, ends, spans=SPANS, **options):
    features = spark.createDataFrame(
        [("q", 0, spans, starts, ends)],
        f"id string, chunk_no int, offsets {OFFSETS}, start_logits array<double>, end_logits array<double>",
    )
    examples = spark.createDataFrame([("q", CONTEXT)], "id string, context string")
    return decode.decode_spans(features, examples, **options)


def test_decode(spark):
    got = decoded(spark, [1.0, 3.0, 0.0], [0.0, 1.0, 4.0], max_answer_len=2).first()
    listed = [(c["text"], c["score"]) for c in got["nbest"]]
    assert listed[:3] == [("한국의 수도다", 7.0), ("한국의", 4.0), ("수도다", 4.0)]
    assert got["prediction_text"] == "한국의 수도다"
    assert sum(c["probability"] for c in got["nbest"]) == pytest.approx(1.0)


def test_decode_matches_brute_force_over_many_chunks(spark):
    import random

    rng = random.Random(4)
    spans = [None, None] + [(3 * i, 3 * i + 2) for i in range(30)] + [None]
    context = "".join(f"{i:02d} " for i in range(30))
    rows, pairs = [], []
    for number in range(6):
        s = [rng.randint(-8, 8) / 4 for _ in spans]
        e = [rng.randint(-8, 8) / 4 for _ in spans]
        rows.append(("q", number, spans, s, e))
        best_s = sorted(range(len(s)), key=lambda i: (-s[i], i))[:5]
        best_e = sorted(range(len(e)), key=lambda i: (-e[i], i))[:5]
        for a, i in enumerate(best_s):
            for b, j in enumerate(best_e):
                if spans[i] and spans[j] and 0 <= j - i < 10:
                    pairs.append((-(s[i] + e[j]), number, a, b, context[spans[i][0] : spans[j][1]]))
    features = spark.createDataFrame(
        rows, f"id string, chunk_no int, offsets {OFFSETS}, start_logits array<double>, end_logits array<double>"
    ).repartition(3)
    examples = spark.createDataFrame([("q", context)], "id string, context string")
    got = decode.decode_spans(features, examples, n_best=5, max_answer_len=10).first()
    assert [c["text"] for c in got["nbest"]] == [p[4] for p in sorted(pairs)[:5]]


def test_max_context(spark):
    features = spark.createDataFrame(
        [("q", 0, SPANS, [1.0, 3.0, 0.0], [0.0, 1.0, 4.0], [True, False, True])],
        f"id string, chunk_no int, offsets {OFFSETS}, start_logits array<double>, end_logits array<double>, ok array<boolean>",
    )
    examples = spark.createDataFrame([("q", CONTEXT)], "id string, context string")
    got = decode.decode_spans(features, examples, max_context="ok").first()
    assert got["prediction_text"] == CONTEXT


def test_nothing_valid_answers_empty(spark):
    got = decoded(spark, [1.0, 1.0, 1.0], [1.0, 1.0, 1.0], spans=[None, None, None]).first()
    assert got["prediction_text"] == "empty" and got["nbest"][0]["probability"] == 1.0
    got = decoded(spark, [1.0] * 3, [1.0] * 3, spans=[None] * 3, allow_null=True).first()
    assert [c["text"] for c in got["nbest"]] == ["empty", ""]


def test_no_answer(spark):
    spans = [None, *SPANS]
    high = decoded(spark, [9.0, 1.0, 3.0, 0.0], [9.0, 0.0, 1.0, 4.0], spans, allow_null=True).first()
    assert high["prediction_text"] == "" and high["null_odds"] == 11.0
    low = decoded(spark, [-9.0, 1.0, 3.0, 0.0], [-9.0, 0.0, 1.0, 4.0], spans, allow_null=True, n_best=2).first()
    assert low["prediction_text"] == "한국의 수도다" and low["null_odds"] == -25.0
    assert [c["text"] for c in low["nbest"]][-1] == "" and len(low["nbest"]) == 3


def test_softmax(spark):
    rows = spark.createDataFrame([("q", 3.0), ("q", 2.0), ("q", 0.0)], "id string, score double")
    got = sorted((r["probability"] for r in decode.softmax_over(rows, "id", "score").collect()), reverse=True)
    assert got == pytest.approx([0.705385, 0.259496, 0.035119], abs=1e-6)


@pytest.mark.parametrize(
    "told, wanted, exact, f1",
    [
        ("The cat!", ["a cat"], 1.0, 1.0),
        ("the the dog dog cat", ["dog dog dog"], 0.0, 2 * (2 / 3) * (2 / 3) / (4 / 3)),
        ("x", ["y", "x y"], 0.0, 2 * 1 * 0.5 / 1.5),
        ("thé a-the", ["thé athe"], 1.0, 1.0),
        ("the", ["a"], 1.0, 0.0),
    ],
)
def test_metrics(spark, told, wanted, exact, f1):
    predictions = spark.createDataFrame([("q", told)], "id string, prediction_text string")
    references = spark.createDataFrame([("q", w) for w in wanted], "id string, text string")
    row = metrics.qa_scores(predictions, references).first()
    assert (row["exact_match"], row["f1"]) == (exact, pytest.approx(f1))


def test_metrics_average_and_missing_prediction(spark):
    predictions = spark.createDataFrame([("q", "x")], "id string, prediction_text string")
    references = spark.createDataFrame([("q", "x"), ("r", "y")], "id string, text string")
    assert tuple(metrics.qa_metrics(predictions, references).first()) == (50.0, 50.0)


def test_reader_loss(spark):
    row = spark.createDataFrame(
        [([0.0, 0.0], [0.0, 0.0, 0.0, 0.0], 1, 2)],
        "start_logits array<double>, end_logits array<double>, start_pos int, end_pos int",
    )
    got = losses.reader_loss(row).first()
    assert (got["start_loss"], got["end_loss"]) == (pytest.approx(0.693147), pytest.approx(1.386294))


NBEST = [("x", 0.6, 0.70), ("y", 0.3, 0.70), ("y", 0.5, 0.60), ("x", 0.1, 0.60), ("z", 0.9, 0.65)]


def test_ensemble(spark):
    rows = spark.createDataFrame([("q", *r) for r in NBEST], "id string, text string, probability double, weight double")
    got = [(r["text"], r["score"]) for r in vote.ensemble(rows, n=3).orderBy("rank").collect()]
    assert got == [("z", 0.585), ("y", 0.53), ("x", 0.5)]
    assert vote.ensemble(rows).count() == 1
    mean = {r["text"]: r["score"] for r in vote.ensemble(rows, "none", "half_mean", 0.03, 3).collect()}
    assert mean == {"z": 0.9, "y": 0.26, "x": 0.235}
    with pytest.raises(ValueError):
        vote.ensemble(rows, "other")


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not there")
def test_runs_hold_every_answer_of_up_to_thirty_tokens(spark):
    features = checks.with_logits(ch.with_feature_offsets(checks.labelled(spark, FOLDER)), "70")
    contexts = {r["id"]: r["context"] for r in checks._examples(spark, FOLDER).collect()}
    found = {key: [] for key in contexts}
    for r in features.collect():
        best = [sorted(range(len(r["offsets"])), key=lambda n: (-side[n], n))[:20] for side in (r["start_logits"], r["end_logits"])]
        for (a, p), (b, q) in itertools.product(enumerate(best[0]), enumerate(best[1])):
            if r["offsets"][p] and r["offsets"][q] and 0 <= q - p < 30:
                score = r["start_logits"][p] + r["end_logits"][q]
                found[r["id"]].append((-score, r["chunk_no"], a, b, contexts[r["id"]][r["offsets"][p]["s"] : r["offsets"][q]["e"]]))
    expected = {(key, n, one[4]) for key, spans in found.items() for n, one in enumerate(sorted(spans)[:20], 1)}
    got = checks.nbest_scan(spark, FOLDER).filter("model = '70' and text <> 'empty'").select("id", "rank", "text").collect()
    assert set(map(tuple, got)) == expected
    assert max(len(text.split()) for _, _, text in expected) > 4


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not there")
def test_narrow_limits_provoke_the_fallback(spark):
    empty = checks.empty_fallback(spark, FOLDER).filter("prediction_text = 'empty'").count()
    assert 0 < empty < len(checks._examples(spark, FOLDER).collect())


def test_ensemble_ranks_beyond_six_digits(spark):
    nbest = spark.createDataFrame([("q", "a", 0.5, 1.0), ("q", "b", 0.5 + 1e-8, 1.0)], "id string, text string, probability double, weight double")
    assert [(r["text"], r["score"]) for r in vote.ensemble(nbest).collect()] == [("b", 0.5)]


def test_pairs_and_logits_of_a_chunk_are_made_in_batches(spark):
    kinds = f"id string, chunk_no int, offsets {OFFSETS}"
    features = spark.createDataFrame([("q", 0, [(0, 1), None, (2, 3)])], kinds)
    size = F.size("offsets")
    logits = {f"{side}_logits": ch.hashed_logits(size, F.lit("m"), F.col("id"), F.col("chunk_no"), F.lit(side[0])) for side in ("start", "end")}
    features = features.withColumns(logits)
    import hashlib

    def logit(side, at):
        return (int(hashlib.md5(f"m|q|0|{side}|{at}".encode()).hexdigest()[:15], 16) % 2001 - 1000) / 64.0

    got = features.select("start_logits", "end_logits").first()
    assert [list(c) for c in got] == [[logit(side, at) for at in range(3)] for side in "se"]
    examples = spark.createDataFrame([("q", "a b")], "id string, context string")
    decoded = decode.decode_spans(features, examples)
    plan = decoded._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "Generate" not in plan
    assert spark.range(1).select(ch.hashed_logits(F.lit(None).cast("int"), F.lit("k"))).first()[0] is None


def test_chunks_without_logits_or_offsets_give_no_pairs(spark):
    kinds = f"id string, chunk_no int, offsets {OFFSETS}, start_logits array<double>, end_logits array<double>"
    rows = [("q", 0, None, [1.0], [1.0]), ("q", 1, [(0, 1)], None, [1.0]), ("q", 2, [], [], []), ("r", 0, [(0, 1)], [2.0, 9.0], [3.0])]
    examples = spark.createDataFrame([("q", "a"), ("r", "b")], "id string, context string")
    decoded = decode.decode_spans(spark.createDataFrame(rows, kinds), examples)
    assert sorted((r.id, r.prediction_text, len(r.nbest)) for r in decoded.collect()) == [("q", "empty", 1), ("r", "b", 1)]
