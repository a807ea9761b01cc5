"""Views of the given tables in the roles the operators expect, for Spark and for the SQL checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from qaspark.functions.bind import let
from qaspark.functions.tokens import space_offsets
from qaspark.sources.readers import read_table


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def corpus(spark: SparkSession, folder: str) -> DataFrame:
    """Passages: the source is the title, the language the domain."""
    documents = read_table(spark, f"{folder}/documents.parquet", spread_by=["doc_id"])
    return documents.select(
        "doc_id", "text", F.col("source").alias("title"), F.col("lang").alias("domain")
    )


def pages_table(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, f"{folder}/pages.parquet", ["page_id"])


def questions(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "benchmark").select(
        F.col("item_id").alias("qid"), F.col("text").alias("question")
    )


def dialogue_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """A user turn is a question, the assistant turn that follows it is its context.

    The conversation's system turns stand before that context; a question without an answer has
    nothing else.
    """
    turns = read_table(spark, f"{folder}/conversations.parquet", ["conv_id", "turn"])
    asked = turns.filter("role = 'user'").select(
        "conv_id", "turn", F.col("text").alias("question")
    )
    told = turns.filter("role = 'assistant'").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("context")
    )
    rules = (
        turns.filter("role = 'system'")
        .groupBy("conv_id")  # the system turns of one conversation
        .agg(F.sort_array(F.collect_list(F.struct("turn", "text"))).getField("text").alias("rules"))
    )
    context = F.array_join(
        F.concat(F.coalesce("rules", F.array().cast("array<string>")), F.array(F.coalesce("context", F.lit("")))), "\n"
    )
    pairs = asked.join(told, ["conv_id", "turn"], "left").join(rules, "conv_id", "left")
    return pairs.withColumn("context", context).select(
        F.concat_ws("-", F.lit("conv"), "conv_id", "turn").alias("id"),
        "conv_id",
        "turn",
        "question",
        "context",
    )


def qa(spark: SparkSession, folder: str) -> DataFrame:
    """Dialogue pairs with an answer: the two tokens in the middle of the context."""

    def answer(offsets):
        middle = (F.size(offsets) / 2).cast("int")
        last = F.least(middle + 1, F.size(offsets) - 1)
        start = F.get(offsets, middle)["s"]
        end = F.get(offsets, last)["e"]
        return F.struct(
            F.array(F.substring(F.col("context"), start + 1, end - start)).alias("text"),
            F.array(start).alias("answer_start"),
        )

    return dialogue_pairs(spark, folder).withColumn(
        "answers", let(space_offsets(F.col("context")), answer)
    )


# --- SQL pieces -----------------------------------------------------------------------------

BLANK = r"[ \t\n\x0B\f\r]"


def sql_tokens(text: str) -> str:
    return f"list_filter(regexp_split_to_array({text}, '{BLANK}+'), lambda t: t <> '')"


def sql_hash(text: str) -> str:
    return f"cast('0x' || substr(md5({text}), 1, 15) as bigint)"


SQL_CORPUS = """corpus as (
  select doc_id, text, source as title, lang as domain from documents)"""

SQL_QUESTIONS = """questions as (select item_id as qid, text as question from benchmark)"""

SQL_PAIRS = """pairs as (
  select 'conv-' || u.conv_id || '-' || u.turn as id, u.conv_id, u.turn,
         u.text as question, coalesce(r.rules || chr(10), '') || coalesce(a.text, '') as context
  from conversations u
  left join conversations a on a.conv_id = u.conv_id and a.turn = u.turn + 1 and a.role = 'assistant'
  left join (select conv_id, string_agg(text, chr(10) order by turn) as rules
             from conversations where role = 'system' group by conv_id) r on r.conv_id = u.conv_id
  where u.role = 'user')"""

# token offsets by running sums: blanks before a token, and the tokens with their blanks before it
SQL_OFFSETS = f"""pieces as (
  select id, unnest({sql_tokens('context')}) as token,
         generate_subscripts({sql_tokens('context')}, 1) as pos,
         regexp_extract_all(' ' || context || ' ', '{BLANK}+') as gaps
  from pairs),
offsets as (
  select id, pos, token, s, s + length(token) as e from (
    select id, pos, token,
           sum(length(gaps[pos])) over w - 1
             + coalesce(sum(length(token)) over (w rows between unbounded preceding and 1 preceding), 0)
             as s
    from pieces window w as (partition by id order by pos)))"""

SQL_QA = (
    SQL_PAIRS
    + ",\n"
    + SQL_OFFSETS
    + """,
counted as (select id, max(pos) as n from offsets group by id),
qa as (
  select p.id, p.conv_id, p.turn, p.question, p.context, coalesce(c.n, 0) as n,
         cast(o.s as integer) as answer_start,
         substr(p.context, cast(o.s as integer) + 1, cast(l.e - o.s as integer)) as answer_text
  from pairs p left join counted c on c.id = p.id
  left join offsets o on o.id = p.id and o.pos = c.n // 2 + 1
  left join offsets l on l.id = p.id and l.pos = least(c.n // 2 + 2, c.n))"""
)
