"""Queries over cleaning, repair, tokenisation and lengths."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from qaspark.checks.tables import (
    BLANK,
    SQL_PAIRS,
    SQL_QA,
    corpus,
    dialogue_pairs,
    pages_table,
    qa,
    sql_tokens,
    table,
)
from qaspark.functions import text as tx
from qaspark.functions.tokens import tokenize
from qaspark.operators import prepare

PARTICLES = ["tion", "ing", "ed", "er", "e", "s"]


def raw_pages(spark, folder):
    """Pages as long-document questions; the answer is what the first heading holds."""
    html = F.col("html")
    start = F.instr(html, "<h1>") + 3
    return pages_table(spark, folder).select(
        "page_id",
        F.floor(F.col("page_id") / 50).alias("file_no"),
        F.col("url").alias("title"),
        F.col("url").alias("question"),
        html.alias("context"),
        F.substring_index(F.substring(html, start + 1, F.length(html)), "<", 1).alias("answer_text"),
        start.alias("answer_start"),
    )


def cleaned_pages(spark, folder):
    return prepare.clean_qa(raw_pages(spark, folder))


def html_clean_context(spark, folder):
    pages = pages_table(spark, folder)
    return pages.select("page_id", tx.clean_context(F.col("html")).alias("cleaned"))


def html_clean_answer(spark, folder):
    pages = pages_table(spark, folder)
    return pages.select("page_id", tx.clean_answer(F.col("html")).alias("cleaned"))


def html_clean_plain(spark, folder):
    pages = pages_table(spark, folder)
    return pages.select("page_id", tx.clean_context(F.col("html"), "plain").alias("cleaned"))


def byline_prune(spark, folder):
    docs = corpus(spark, folder)
    return docs.select("doc_id", tx.clean_context(F.col("text"), "byline").alias("cleaned"))


def answer_rebase(spark, folder):
    return cleaned_pages(spark, folder).select(
        "page_id", F.col("answer_start").cast("long").alias("answer_start"), "answer_text"
    )


def qa_filter(spark, folder):
    kept = prepare.filter_qa(cleaned_pages(spark, folder), max_context=20000)
    return kept.select("page_id", "context", "answer_text")


def padded_ids(spark, folder):
    kept = prepare.filter_qa(cleaned_pages(spark, folder), max_context=20000)
    narrow = kept.select("page_id", "file_no")
    return prepare.assign_ids(narrow, "page", ["file_no", "page_id"]).select("page_id", "id")


def doc_id_parse(spark, folder):
    turns = table(spark, folder, "conversations")
    identifier = F.concat(F.lit("conv_"), F.col("conv_id"), F.lit("-"), F.col("turn"))
    return turns.select(identifier.alias("id")).select(
        "id", tx.parse_doc_id(F.col("id")).alias("document_id")
    )


def title_tagged(spark, folder):
    docs = corpus(spark, folder)
    return docs.select("doc_id", tx.title_tag(F.col("title"), F.col("text")).alias("tagged"))


def text_lengths(spark, folder):
    rows = prepare.with_lengths(dialogue_pairs(spark, folder), ["context", "question"], "total_len")
    return rows.select("id", "context_len", "question_len", "total_len")


def answer_span(spark, folder):
    return prepare.with_span(qa(spark, folder)).select("id", "start_char", "end_char")


def tokenize_explode(spark, folder):
    docs = corpus(spark, folder)
    return prepare.tokenize_rows(docs, "doc_id", "text", lower=True)


def token_len_by_scheme(spark, folder):
    return prepare.token_length_profile(corpus(spark, folder), "doc_id", "text")


def max_encoded_len(spark, folder):
    return prepare.max_encoded_len(dialogue_pairs(spark, folder), ["context", "question"])


def bracket_repair(spark, folder):
    pages = pages_table(spark, folder)
    words = prepare.tokenize_rows(pages, "page_id", "html")
    return words.select("page_id", "pos", tx.balance_brackets(F.col("token")).alias("repaired"))


def particle_strip(spark, folder):
    words = prepare.tokenize_rows(corpus(spark, folder), "doc_id", "text")
    return words.groupBy("token").agg(F.count(F.lit(1)).alias("n")).select(
        "token",
        "n",
        tx.strip_particle(F.col("token"), PARTICLES).alias("stripped"),
        tx.strip_particle(F.col("token"), PARTICLES, charset=True).alias("stripped_chars"),
    )


def conform_schema(spark, folder):
    target = T.StructType(
        [
            T.StructField("id", T.StringType()),
            T.StructField("question", T.StringType()),
            T.StructField("document_id", T.IntegerType()),
            T.StructField("title", T.StringType()),
        ]
    )
    rows = dialogue_pairs(spark, folder)
    return prepare.conform(rows, target, {"conv_id": "document_id"})


QUERIES = {
    f.__name__: f
    for f in (
        html_clean_context, html_clean_answer, html_clean_plain, byline_prune, answer_rebase,
        qa_filter, padded_ids, doc_id_parse, title_tagged, text_lengths, answer_span,
        tokenize_explode, token_len_by_scheme, max_encoded_len, bracket_repair, particle_strip,
        conform_schema,
    )
}


def sql_markup(text, ui=tx.UI_WORDS, entities=tx.ENTITIES):
    for tag in tx.BLOCK_TAGS:
        text = f"regexp_replace({text}, '(?is)<{tag}.*?>.*?</{tag}>', '', 'g')"
    text = f"regexp_replace({text}, '(?is)<.+?>', '', 'g')"
    text = rf"regexp_replace({text}, '\[[0-9]+\]', ' ', 'g')"
    for word in ui:
        quoted = word.replace("'", "''")
        text = f"replace({text}, '{quoted}', '')"
    for heading in tx.TRAILING_SECTIONS:
        text = f"split_part({text}, '{heading}', 1)"
    marks = "|".join([*entities, r"\t|\r|\n|\x{00a0}|\x{200b}"])
    return f"regexp_replace(regexp_replace({text}, '{marks}', ' ', 'g'), ' +', ' ', 'g')"


def sql_cut(column):
    return rf"""trim(case when instr({column}, '.') = 0 then {column}
      else regexp_extract({column}, '(?s)^(.*\.)', 1) end)"""


_PAGE_QA = f"""raw as materialized (
  select page_id, page_id // 50 as file_no, url, html, instr(html, '<h1>') + 3 as st from pages),
answered as materialized (
  select *, split_part(substr(html, st + 1), '<', 1) as txt, substr(html, 1, st) as before from raw),
cleaned as materialized (
  select page_id, file_no, {sql_cut(sql_markup('html'))} as context,
         trim({sql_markup('txt')}) as answer_text,
         cast(length(ltrim({sql_markup('before')})) as bigint) as answer_start
  from answered),
kept as (
  select * from cleaned
  where length(answer_text) > 0 and length(answer_text) <= 80 and length(context) <= 20000
    and length(context) > answer_start
    and substr(context, answer_start + 1, 1) = substr(answer_text, 1, 1))"""


def _sql_particles(column, charset=False):
    arms = []
    for particle in sorted(PARTICLES, key=lambda p: (-len(p), p)):
        short = (
            f"rtrim({column}, '{particle}')"
            if charset
            else f"substr({column}, 1, length({column}) - {len(particle)})"
        )
        arms.append(
            f"when suffix({column}, '{particle}') and length({column}) > {len(particle)} then {short}"
        )
    return f"case {' '.join(arms)} else {column} end"


SQL = {
    "html_clean_context": f"""with body as (select page_id, {sql_markup('html')} as b from pages)
        select page_id, {sql_cut('b')} as cleaned from body""",
    "html_clean_answer": f"select page_id, {sql_markup('html')} as cleaned from pages",
    "html_clean_plain": f"""with body as (
          select page_id, {sql_markup('html', tx.UI_WORDS[1:], tx.ENTITIES[:1])} as b from pages)
        select page_id, {sql_cut('b')} as cleaned from body""",
    "byline_prune": f"""with body as (select doc_id, {sql_markup('text')} as b from documents),
        split as (select doc_id, b, string_split(b, '.') as parts from body),
        marked as (select *, list_max(list_transform(parts,
            lambda p, i: case when contains(p, '@') then i else 0 end)) as last from split),
        pruned as (select doc_id, case when last = 0 then b
            else array_to_string(parts[1:last - 1], '.') || '.' end as b from marked)
        select doc_id, {sql_cut('b')} as cleaned from pruned""",
    "answer_rebase": f"with {_PAGE_QA} select page_id, answer_start, answer_text from cleaned",
    "qa_filter": f"with {_PAGE_QA} select page_id, context, answer_text from kept",
    "padded_ids": f"""with {_PAGE_QA} select page_id, 'page-' || lpad(cast(file_no as varchar), 2, '0')
        || '-' || lpad(cast(row_number() over (order by file_no, page_id) - 1 as varchar), 6, '0') as id
        from kept""",
    "doc_id_parse": """select 'conv_' || conv_id || '-' || turn as id,
        cast(conv_id || '' || turn as bigint) as document_id from conversations""",
    "title_tagged": "select doc_id, '@' || source || ':' || text as tagged from documents",
    "text_lengths": f"""with {SQL_PAIRS} select id, length(context) as context_len,
        length(question) as question_len, length(context) + length(question) as total_len from pairs""",
    "answer_span": f"""with {SQL_QA} select id, answer_start as start_char,
        answer_start + length(answer_text) as end_char from qa""",
    "tokenize_explode": f"""with toks as (
          select doc_id, {sql_tokens('lower(text)')} as words from documents)
        select doc_id, generate_subscripts(words, 1) - 1 as pos, unnest(words) as token from toks""",
    "token_len_by_scheme": rf"""
        select doc_id, 'space' as scheme, length(regexp_replace(text, '{BLANK}', '', 'g')) as token_chars
        from documents union all
        select doc_id, 'word', length(regexp_replace(text, '[^\p{{L}}\p{{N}}]', '', 'g'))
        from documents union all
        select doc_id, 'piece', length(regexp_replace(text, '{BLANK}', '', 'g')) from documents""",
    "max_encoded_len": f"""with {SQL_PAIRS} select max(4 + len({sql_tokens('context')})
        + len({sql_tokens('question')})) as max_tokens from pairs""",
    "bracket_repair": f"""with toks as (select page_id, {sql_tokens('html')} as words from pages),
        one as (select page_id, generate_subscripts(words, 1) - 1 as pos, unnest(words) as t from toks)
        select page_id, pos, case
          when contains(t, '(') and not contains(t, ')') then t || ')'
          when not contains(t, '(') and contains(t, ')') then '(' || t
          when contains(t, '<') and not contains(t, '>') then t || '>'
          when not contains(t, '<') and contains(t, '>') then '<' || t
          else t end as repaired from one""",
    "particle_strip": f"""with toks as (
          select unnest({sql_tokens('text')}) as token from documents)
        select token, count(*) as n, {_sql_particles('token')} as stripped,
          {_sql_particles('token', True)} as stripped_chars
        from toks group by token""",
    "conform_schema": f"""with {SQL_PAIRS} select id, question,
        cast(conv_id as integer) as document_id, cast(null as varchar) as title from pairs""",
}
