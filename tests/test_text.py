import pytest
from pyspark.sql import functions as F

from qaspark.functions import text as tx
from qaspark.functions.tokens import space_offsets, term_counts, tokenize, with_bigrams
from qaspark.operators import prepare


def one(spark, value, function):
    return spark.createDataFrame([(value,)], "t string").select(function(F.col("t"))).first()[0]


@pytest.mark.parametrize(
    "text, variant, legacy, expected",
    [
        ("abc. def.", "wiki", False, "abc. def."),
        ("abc. def.", "wiki", True, ""),
        ("abc. de. ", "wiki", False, "abc. de."),
        ("no stop here", "wiki", False, "no stop here"),
        ("a. b@c. d.", "byline", False, "a."),
        ("a. b@c. d.", "byline", True, ""),
        ("x@y. z", "byline", False, "."),
        ("본문이다. 같이 보기 목록.", "wiki", False, "본문이다."),
        ("본문[편집] 펼치기이다[12]. 각주 뒤.", "wiki", False, "본문 이다 ."),
        ("<TITLE>t</TITLE><table a>x<td>y</td></table>a&nbsp;b<ol><li>z</li></ol>.", "wiki", False, "a b."),
        ("a<li>one</li>b<link x>c</li>d ​e.", "wiki", False, "abd e."),
        ("a&lt;b.", "plain", False, "a&lt;b."),
        ("a&lt;b.", "wiki", False, "a b."),
        ("[원본 편집]a.", "plain", False, "[원본 편집]a."),
    ],
)
def test_clean_context(spark, text, variant, legacy, expected):
    assert one(spark, text, lambda c: tx.clean_context(c, variant, legacy)) == expected


def test_clean_answer_keeps_the_tail(spark):
    assert one(spark, "a. <b>b</b> c\\'d\n\n e", tx.clean_answer) == "a. b cd e"


@pytest.mark.parametrize(
    "text, expected",
    [("(a", "(a)"), ("a)", "(a)"), ("<a", "<a>"), ("a>", "<a>"), ("(a<", "(a<)"), ("(a)", "(a)"), ("a", "a")],
)
def test_balance_brackets(spark, text, expected):
    assert one(spark, text, tx.balance_brackets) == expected


def test_strip_particle(spark):
    assert one(spark, "은는이는", lambda c: tx.strip_particle(c, ["이는", "는"])) == "은는"
    assert one(spark, "은는이는", lambda c: tx.strip_particle(c, ["이는", "는"], charset=True)) == "은"
    assert one(spark, "서울", lambda c: tx.strip_particle(c, ["이는"])) == "서울"


def test_strip_takes_all_unicode_blanks(spark):
    blank = "\u3000\u00a0\x0b \n"
    assert one(spark, f"{blank}a{blank}b{blank}", tx.strip) == f"a{blank}b"
    assert one(spark, f"{blank}a ", lambda c: tx.strip(c, "left")) == "a "


def test_ids_and_tags(spark):
    assert one(spark, "x_12-3", tx.parse_doc_id) == 123
    assert one(spark, "t", lambda c: tx.title_tag(c, F.lit("body"))) == "@t:body"
    df = spark.createDataFrame([(3, n) for n in range(43)], "file_no int, n int")
    ids = {r["n"]: r["id"] for r in prepare.assign_ids(df, "files", ["file_no", "n"]).collect()}
    assert ids[42] == "files-03-000042" and len(set(ids.values())) == 43


def test_unknown_variant():
    with pytest.raises(ValueError):
        tx.clean_context(F.lit("a"), "other")


def test_qa_rows_keep_only_matching_offsets(spark):
    raw = spark.createDataFrame(
        [
            (1, "<p>Rome is old.</p> It lies in Italy.", "Italy", 31),
            (2, "<p>Rome is old.</p>", "", 3),
            (3, "<p>Rome is old.</p>", "Oslo", 3),
            (4, "<p>Rome</p> is the old " + "x" * 90 + ".", "x" * 90, 23),
        ],
        "n int, context string, answer_text string, answer_start int",
    )
    kept = prepare.filter_qa(prepare.clean_qa(raw)).collect()
    assert [(r["n"], r["answer_start"]) for r in kept] == [(1, 24)]
    assert kept[0]["context"][24:] == "Italy."


def test_tokens_and_offsets_agree(spark):
    text = " a\tbb \n\n𝒳c  é "
    tokens = one(spark, text, tokenize)
    spans = one(spark, text, space_offsets)
    assert [text[o["s"] : o["e"]] for o in spans] == tokens == ["a", "bb", "𝒳c", "é"]
    assert one(spark, "", space_offsets) == [] and one(spark, " ", space_offsets) == []


def test_term_counts_and_bigrams(spark):
    counts = one(spark, "b a b", lambda c: term_counts(tokenize(c)))
    assert [tuple(x) for x in counts] == [("a", 1), ("b", 2)]
    assert one(spark, "", lambda c: term_counts(tokenize(c))) == []
    assert one(spark, "a b c", lambda c: with_bigrams(tokenize(c))) == ["a", "b", "c", "a b", "b c"]
    assert one(spark, "a", lambda c: with_bigrams(tokenize(c))) == ["a"]


def test_tokenizer_can_be_a_pandas_udf(spark):
    import pandas as pd

    @F.pandas_udf("array<string>")
    def letters(texts: pd.Series) -> pd.Series:
        return texts.map(list)

    assert one(spark, "abc", lambda c: tokenize(c, letters)) == ["a", "b", "c"]
    with pytest.raises(ValueError):
        tokenize(F.lit("a"), "other")


def test_token_profile(spark, rows):
    df = spark.createDataFrame([(1, "a-b 12")], "id int, t string")
    got = rows(prepare.token_length_profile(df, "id", "t"), "scheme")
    assert got == [(1, "piece", 5), (1, "space", 5), (1, "word", 4)]


def test_offsets_are_made_in_batches(spark):
    rows = spark.createDataFrame([(0, " é　b\tc"), (1, None), (2, "a")], "id int, text string")
    spans = rows.select("id", space_offsets(F.col("text")).alias("spans"))
    assert [[tuple(s) for s in r.spans] for r in spans.orderBy("id").collect()] == [[(1, 4), (5, 6)], [], [(0, 1)]]
    plan = spans._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "lambda" not in plan
