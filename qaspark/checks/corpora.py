"""Queries over sources, sinks, deduplication, joins, splits, samples and statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from qaspark.checks.tables import (
    SQL_CORPUS,
    SQL_PAIRS,
    SQL_QA,
    corpus,
    dialogue_pairs,
    qa,
    sql_hash,
    table,
)
from qaspark.checks.texts import sql_cut, sql_markup
from qaspark.functions.text import ENTITIES, UI_WORDS, clean_context
from qaspark.operators import corpus as ops, stats
from qaspark.session import scratch_path
from qaspark.sources import readers, writers

FILE_ROWS = 50  # records per nested file: the groups below are this long at most


def _nested_files(df, number, name, spark):
    """One JSON text file per number, holding at most ``FILE_ROWS`` records."""
    path = scratch_path(spark, name)
    df.repartition(number).write.partitionBy(number).text(path)
    return path


def corpus_scan(spark, folder):
    docs = corpus(spark, folder)
    record = F.struct("text", "title", "domain")
    files = (
        docs.withColumn("file_no", F.floor(F.col("doc_id") / FILE_ROWS))
        .groupBy("file_no")
        .agg(F.map_from_entries(F.collect_list(F.struct(F.col("doc_id").cast("string"), record))).alias("m"))
        .select("file_no", F.to_json("m").alias("value"))
    )
    read = readers.read_corpus(spark, _nested_files(files, "file_no", "corpus", spark))
    return read.select(F.col("key").cast("long").alias("doc_id"), "text", "title", "domain")


def corpus_objects(spark, folder):
    """The corpus as JSON objects of whatever size tasks have, read back by byte ranges."""
    path = scratch_path(spark, "objects")
    record = F.struct("text", "title", "domain")
    writers.write_objects(corpus(spark, folder), path, "doc_id", record)
    read = readers.read_corpus(spark, path)
    return read.select(F.col("key").cast("long").alias("doc_id"), "text", "title", "domain")


def _flagged(spark, folder):
    labels = table(spark, folder, "labels").select("doc_id", "quality")
    split = F.when(F.col("quality") == 1, "train").when(F.col("quality") == 0, "validation")
    return (
        corpus(spark, folder)
        .join(labels, "doc_id", "left")
        .withColumn("split", F.coalesce(split, F.lit("test")))
        .drop("quality")
    )


def split_scan(spark, folder):
    path = scratch_path(spark, "splits")
    _flagged(spark, folder).write.partitionBy("split").parquet(path)
    return readers.read_split(spark, path, "validation").select("doc_id", "title", "text")


def qa_json_roundtrip(spark, folder):
    path = scratch_path(spark, "qa")
    writers.write_qa_json(qa(spark, folder), path)
    rows = readers.read_qa_json(spark, path)
    return rows.select(
        "id",
        "question",
        "context",
        F.get("answers.text", F.lit(0)).alias("answer_text"),
        F.get("answers.answer_start", F.lit(0)).cast("long").alias("answer_start"),
    )


def longdoc_scan(spark, folder):
    """Whole pages as long documents; the context comes back as a digest, so every character counts.

    The turns of the conversation that has the page's number are its further questions, all of them.
    """
    pages = table(spark, folder, "pages")
    answer = F.struct(F.col("url").alias("text"), F.lit(0).alias("answer_start"))
    one = F.struct(F.col("page_id").cast("string").alias("id"), F.col("url").alias("question"), answer.alias("answer"))
    spoken = (
        table(spark, folder, "conversations")
        .groupBy(F.col("conv_id").alias("page_id"))  # the turns of one conversation
        .agg(F.sort_array(F.collect_list(F.struct("turn", "text"))).getField("text").alias("turns"))
    )
    others = F.transform(
        F.coalesce("turns", F.array().cast("array<string>")),
        lambda text: F.struct(F.lit("-").alias("id"), text.alias("question"), answer.alias("answer")),
    )
    doc = F.struct(
        "page_id", F.col("url").alias("title"), F.col("html").alias("context"),
        F.concat(F.array(one), others).alias("qas"),
    )
    files = (
        pages.join(spoken, "page_id", "left")
        .withColumn("file_no", F.floor(F.col("page_id") / FILE_ROWS))
        .groupBy("file_no")
        .agg(F.sort_array(F.collect_list(doc)).alias("docs"))
        .withColumn("data", F.transform("docs", lambda d: d.dropFields("page_id")))
        .select("file_no", F.to_json(F.struct(F.lit("1").alias("version"), "data")).alias("value"))
    )
    path = _nested_files(files, "file_no", "longdoc", spark)
    rows = readers.read_longdoc_qa(spark, path, r"file_no=(\d+)/")
    return rows.select(
        F.col("file_no").cast("long").alias("file_no"),
        F.col("doc_no").cast("long").alias("doc_no"),
        "title", "question_id", "question", "answer_text", F.md5("context").alias("context_md5"),
        F.length("context").cast("long").alias("n"),
        F.size("others").cast("long").alias("n_asked"),
        F.array_join("others", "\n").alias("asked"),
    )


def squad_scan(spark, folder):
    rows = qa(spark, folder)
    answer = F.struct(
        F.get("answers.text", F.lit(0)).alias("text"),
        F.get("answers.answer_start", F.lit(0)).alias("answer_start"),
    )
    asked = F.struct(
        F.col("id"), "question", F.array(answer, answer).alias("answers")
    )
    second = F.struct(
        F.concat(F.lit("x"), "id").alias("id"), F.concat(F.lit("again: "), "question").alias("question"),
        F.array(answer).alias("answers"),
    )
    paragraph = F.struct("context", F.array(asked, second).alias("qas"))
    doc = F.struct(F.col("id").alias("title"), F.array(paragraph, paragraph).alias("paragraphs"))
    # conv_id and turn are unique together, and a slice takes the turns of few conversations
    files = (
        rows.withColumn("file_no", F.floor(F.col("conv_id") / FILE_ROWS) * 1000 + F.floor(F.col("turn") / FILE_ROWS))
        .groupBy("file_no")
        .agg(F.to_json(F.struct(F.collect_list(doc).alias("data"))).alias("value"))
    )
    read = readers.read_squad_qa(spark, _nested_files(files, "file_no", "squad", spark))
    return read.withColumn("answer_start", F.col("answer_start").cast("long"))


def shard_assign(spark, folder):
    docs = corpus(spark, folder).select("doc_id", "title")
    return writers.with_shards(docs, ["title", "doc_id"], 64)


def csv_texts(spark, folder):
    """Raw texts, written and read again."""
    path = scratch_path(spark, "csv")
    texts = corpus(spark, folder).select("doc_id", "text")
    writers.write_csv(texts, path)
    return readers.read_csv(spark, path, texts.schema)


def csv_roundtrip(spark, folder):
    """The texts go through the file as they are; they are cleaned after reading, as the SQL has it."""
    cleaned = csv_texts(spark, folder).select("doc_id", clean_context(F.col("text")).alias("text"))
    return cleaned.fillna("", ["text"])


def corpus_dedup(spark, folder):
    return ops.dedup_corpus(corpus(spark, folder), dense_id="passage_no")


def duplicate_rows(spark, folder):
    return ops.find_duplicates(corpus(spark, folder)).select(
        "doc_id", F.length("text").cast("long").alias("text_len")
    )


def dedup_before_after(spark, folder):
    return ops.dedup_effect(
        corpus(spark, folder), F.col("text"), clean_context(F.col("text"), "plain")
    )


def distinct_corpus(spark, folder):
    return corpus(spark, folder).select("text").distinct()


def augment_union(spark, folder):
    base = dialogue_pairs(spark, folder).select(
        "id", "question", "context", F.lit("train").alias("split")
    )
    more = table(spark, folder, "pages").select(
        F.concat(F.lit("page-"), F.col("page_id")).alias("id"),
        F.col("url").alias("question"), F.col("html").alias("context"), "page_id",
        F.lit("validation").alias("split"),
    )
    bare = table(spark, folder, "benchmark").select(
        F.concat(F.lit("item-"), F.col("item_id")).alias("id"), F.col("text").alias("question"),
        F.lit("train").alias("split"),
    )
    return ops.augment(base, [more, bare])


def _label_counts(spark, folder):
    labelled = table(spark, folder, "labels").select("doc_id")
    return stats.value_counts(corpus(spark, folder).join(labelled, "doc_id", "left_semi"), "title")


def title_count_join(spark, folder):
    return stats.join_counts(
        _label_counts(spark, folder), stats.value_counts(corpus(spark, folder), "title"), "title"
    )


def title_count_norm(spark, folder):
    return stats.normalize_counts(
        title_count_join(spark, folder), "title", ["count_train", "count_wiki"]
    )


def holdout_split(spark, folder):
    rows = dialogue_pairs(spark, folder).select("id", "question")
    return ops.split_holdout(rows, "id", seed="7").select("id", "held_out")


def prefix_split(spark, folder):
    rows = dialogue_pairs(spark, folder).select("id", "conv_id", "turn")
    flagged = ops.split_holdout(ops.split_prefix(rows, ["conv_id", "turn"], 100), "id", seed="7")
    return flagged.select("id", "in_prefix", "held_out")


def row_sample(spark, folder):
    docs = corpus(spark, folder).select("doc_id", "title")
    once = ops.sample_rows(docs, "doc_id", 20, "3").withColumn("draw", F.lit(-1).cast("long"))
    again = ops.sample_rows(docs, "doc_id", 20, "4", replace=True)
    return once.unionByName(again)


def negative_sampling(spark, folder):
    docs = corpus(spark, folder)
    asked = docs.select(F.col("doc_id").alias("qid"), "title")
    return ops.sample_negatives(asked, docs, 31, "5")


def _length_metrics():
    return {name: F.length(name) for name in ("context", "question")}


def describe_lengths(spark, folder):
    texts = stats.as_metrics(dialogue_pairs(spark, folder), _length_metrics())
    passages = stats.as_metrics(table(spark, folder, "documents"), {"passage": F.length("text")})
    prices = stats.as_metrics(
        table(spark, folder, "lineitem"),
        {"price": F.col("l_extendedprice"), "quantity": F.col("l_quantity")},
    )
    rows = stats.describe_metrics(texts.unionByName(passages).unionByName(prices))
    rounded = ("mean", "std", "min", "max", "p25", "p50", "p75")
    return rows.select("metric", "count", *[F.round(c, 4).alias(c) for c in rounded])


def describe_text(spark, folder):
    return stats.describe_str(corpus(spark, folder), "text", "doc_id")


def title_counts(spark, folder):
    return stats.value_counts(corpus(spark, folder), "title")


def title_counts_summary(spark, folder):
    counts = stats.value_counts(corpus(spark, folder), "title")
    rows = stats.describe_num(counts, {"count": F.col("count")})
    return rows.select("count", *[F.round(c, 4).alias(c) for c in ("mean", "std", "min", "max", "p50")])


def distinct_values(spark, folder):
    return stats.distinct_values(corpus(spark, folder), "title")


def len_histogram(spark, folder):
    texts = stats.histogram(dialogue_pairs(spark, folder), {"context": F.length("context")}, 10, 210)
    asked = stats.histogram(dialogue_pairs(spark, folder), {"question": F.length("question")}, 1, 80)
    passages = stats.histogram(corpus(spark, folder), {"passage": F.length("text")}, 10, 500)
    prices = stats.histogram(
        table(spark, folder, "lineitem"), {"price": F.col("l_extendedprice")}, 1000, 100
    )
    return texts.unionByName(asked).unionByName(passages).unionByName(prices)


def box_stats(spark, folder):
    texts = stats.as_metrics(dialogue_pairs(spark, folder), _length_metrics())
    prices = stats.as_metrics(table(spark, folder, "orders"), {"total": F.col("o_totalprice")})
    rows = stats.box_metrics(texts.unionByName(prices))
    numbers = ("p25", "p50", "p75", "low_whisker", "high_whisker")
    return rows.select("metric", *[F.round(c, 4).alias(c) for c in numbers], "outliers")


def long_text_ratio(spark, folder):
    rows = stats.ratio_above(corpus(spark, folder), F.length("text"), 2000)
    return rows.select("n_above", F.round("share_above", 6).alias("share_above"))


def max_lengths(spark, folder):
    return stats.max_lengths(_flagged(spark, folder), "split", ["text", "title"])


def top_values(spark, folder):
    return stats.top_values(
        table(spark, folder, "orders").select("o_orderkey", "o_totalprice"),
        "o_totalprice", "o_orderkey", 100,
    )


QUERIES = {
    f.__name__: f
    for f in (
        corpus_scan, corpus_objects, split_scan, qa_json_roundtrip, longdoc_scan, squad_scan, shard_assign,
        csv_roundtrip, corpus_dedup, duplicate_rows, dedup_before_after, distinct_corpus,
        augment_union, title_count_join, title_count_norm, holdout_split, prefix_split, row_sample,
        negative_sampling, describe_lengths, describe_text, title_counts, title_counts_summary,
        distinct_values, len_histogram, box_stats, long_text_ratio, max_lengths, top_values,
    )
}


def _sql_describe(metric, column, source):
    q = lambda f: f"round(quantile_cont(v, {f}), 4)"
    return f"""select '{metric}' as metric, count(*) as count, round(avg(v), 4) as mean,
      round(stddev_samp(v), 4) as std, round(min(v), 4) as min, round(max(v), 4) as max,
      {q(0.25)} as p25, {q(0.5)} as p50, {q(0.75)} as p75
      from (select cast({column} as double) as v from {source})"""


def _sql_box(metric, column, source):
    return f"""select '{metric}' as metric, round(any_value(q[1]), 4) as p25, round(any_value(q[2]), 4) as p50,
      round(any_value(q[3]), 4) as p75,
      round(min(v) filter (v between q[1] - 2.5 * (q[3] - q[1]) and q[3] + 2.5 * (q[3] - q[1])), 4) as low_whisker,
      round(max(v) filter (v between q[1] - 2.5 * (q[3] - q[1]) and q[3] + 2.5 * (q[3] - q[1])), 4) as high_whisker,
      count(*) filter (not (v between q[1] - 2.5 * (q[3] - q[1]) and q[3] + 2.5 * (q[3] - q[1]))) as outliers
      from (select cast({column} as double) as v from {source}),
           (select quantile_cont(cast({column} as double), [0.25, 0.5, 0.75]) as q from {source})"""


def _sql_histogram(metric, column, source, width, bins):
    return f"""select '{metric}' as metric, b.bin, count(v) as n
      from (select unnest(range(-1, {bins} + 1)) as bin) b
      left join (select cast({column} as double) as v from {source}) s
        on least(greatest(ceil(s.v / {width}) - 1, -1), {bins}) = b.bin
      group by b.bin"""


_FLAGGED = f"""{SQL_CORPUS}, flagged as (
  select c.*, case l.quality when 1 then 'train' when 0 then 'validation' else 'test' end as split
  from corpus c left join labels l on l.doc_id = c.doc_id)"""

_TITLE_JOIN = f"""{SQL_CORPUS},
wiki as (select title, count(*) as count_wiki from corpus group by title),
train as (select title, count(*) as count_train from corpus
          where doc_id in (select doc_id from labels) group by title),
joined as (select title, count_train, count_wiki from train join wiki using (title))"""

_HELD = f"""held as (
  select *, row_number() over (order by {sql_hash("'7:' || id")}, id) - 1 < (count(*) over ()) // 10
    as held_out from pairs)"""

def _sql_clean(column, variant="wiki"):
    if variant == "plain":
        return sql_markup(column, UI_WORDS[1:], ENTITIES[:1])
    return sql_markup(column)


SQL = {
    "corpus_scan": f"with {SQL_CORPUS} select doc_id, text, title, domain from corpus",
    "corpus_objects": f"with {SQL_CORPUS} select doc_id, text, title, domain from corpus",
    "split_scan": f"with {_FLAGGED} select doc_id, title, text from flagged where split = 'validation'",
    "qa_json_roundtrip": f"""with {SQL_QA} select id, question, context, answer_text,
        cast(answer_start as bigint) as answer_start from qa""",
    "longdoc_scan": f"""select p.page_id // {FILE_ROWS} as file_no,
        row_number() over (partition by p.page_id // {FILE_ROWS} order by p.page_id) - 1 as doc_no,
        p.url as title, cast(p.page_id as varchar) as question_id, p.url as question, p.url as answer_text,
        md5(p.html) as context_md5, length(p.html) as n, coalesce(c.n_asked, 0) as n_asked, coalesce(c.asked, '') as asked
        from pages p left join (select conv_id, count(*) as n_asked, string_agg(text, chr(10) order by turn, text) as asked
          from conversations group by conv_id) c on c.conv_id = p.page_id""",
    "squad_scan": f"""with {SQL_QA} select id, id as title, context, question, answer_text,
        cast(answer_start as bigint) as answer_start from qa
        union all select 'x' || id, id, context, 'again: ' || question, answer_text,
        cast(answer_start as bigint) from qa""",
    "shard_assign": f"""with {SQL_CORPUS} select doc_id, title,
        (row_number() over (order by title, doc_id) - 1) // 64 as shard from corpus""",
    "csv_roundtrip": f"""with body as (select doc_id, {_sql_clean('text')} as b from documents)
        select doc_id, {sql_cut('b')} as text from body""",
    "corpus_dedup": f"""with {SQL_CORPUS}, kept as (select *, row_number() over (
          partition by text order by doc_id) as n from corpus)
        select doc_id, text, title, domain, row_number() over (order by doc_id) - 1 as passage_no
        from kept where n = 1""",
    "duplicate_rows": """select doc_id, length(text) as text_len from (select *, row_number() over (
          partition by text order by doc_id) as n from documents) where n > 1""",
    "dedup_before_after": f"""with body as materialized (
          select text, {_sql_clean('text', 'plain')} as b from documents)
        select 'before' as stage, count(distinct text) as distinct_texts from body
        union all select 'after', count(distinct {sql_cut('b')}) from body""",
    "distinct_corpus": "select distinct text from documents",
    "augment_union": f"""with {SQL_PAIRS} select id, question, context, 'train' as split from pairs
        union all select 'page-' || page_id, url, html, 'validation' from pages
        union all select 'item-' || item_id, text, null, 'train' from benchmark""",
    "title_count_join": f"with {_TITLE_JOIN} select title, count_train, count_wiki from joined",
    "title_count_norm": f"""with {_TITLE_JOIN},
        head as (select * from joined order by count_train desc, title limit 100)
        select title, cast(floor(count_train / avg(count_train) over ()) as bigint) as count_train_norm,
          cast(floor(count_wiki / avg(count_wiki) over ()) as bigint) as count_wiki_norm from head""",
    "holdout_split": f"with {SQL_PAIRS}, {_HELD} select id, held_out from held",
    "prefix_split": f"""with {SQL_PAIRS}, {_HELD} select id,
        row_number() over (order by conv_id, turn) <= 100 as in_prefix, held_out from held""",
    "row_sample": f"""with {SQL_CORPUS}, numbered as (
          select *, row_number() over (order by doc_id) - 1 as r, count(*) over () as n from corpus),
        once as (select doc_id, title, -1 as draw from corpus
          order by {sql_hash("'3:' || doc_id")}, doc_id limit 20)
        select * from once union all
        select doc_id, title, d.draw from (select unnest(range(20)) as draw) d
        join numbered on r = {sql_hash("'4:' || d.draw")} % n""",
    "negative_sampling": f"""with {SQL_CORPUS}, numbered as materialized (
          select doc_id, title, row_number() over (order by title, doc_id) - 1 as slot from corpus),
        spans as (select title, min(slot) as beg, count(*) as own,
          (select count(*) from corpus) - count(*) as rest from numbered group by title),
        asked as (select c.doc_id as qid, s.*, least(31, rest) as strata
          from corpus c join spans s using (title)),
        drawn as (select *, unnest(range(1, strata + 1)) as cand_no from asked),
        strat as (select *, (cand_no - 1) * rest // strata as lo, cand_no * rest // strata as hi from drawn),
        placed as (select qid, cand_no, beg, own,
          lo + {sql_hash("'5:' || qid || ':' || cand_no")} % (hi - lo) as place from strat)
        select p.qid, p.cand_no, n.doc_id, n.title from placed p
        join numbered n on n.slot = case when place < beg then place else place + own end""",
    "describe_lengths": f"""with {SQL_PAIRS}
        {_sql_describe('context', 'length(context)', 'pairs')} union all
        {_sql_describe('question', 'length(question)', 'pairs')} union all
        {_sql_describe('passage', 'length(text)', 'documents')} union all
        {_sql_describe('price', 'l_extendedprice', 'lineitem')} union all
        {_sql_describe('quantity', 'l_quantity', 'lineitem')}""",
    "describe_text": """with groups as (
          select text, count(*) as n, min(doc_id) as first from documents group by text)
        select (select cast(sum(n) as bigint) from groups) as count,
          (select count(*) from groups) as unique,
          text as top, n as freq from groups order by n desc, first limit 1""",
    "title_counts": "select source as title, count(*) as count from documents group by source",
    "title_counts_summary": """with counts as (select count(*) as c from documents group by source)
        select count(*) as count, round(avg(c), 4) as mean, round(stddev_samp(c), 4) as std,
          cast(min(c) as double) as min, cast(max(c) as double) as max,
          round(quantile_cont(c, 0.5), 4) as p50 from counts""",
    "distinct_values": "select count(distinct source) as n_distinct from documents",
    "len_histogram": f"""with {SQL_PAIRS}
        {_sql_histogram('context', 'length(context)', 'pairs', 10, 210)} union all
        {_sql_histogram('question', 'length(question)', 'pairs', 1, 80)} union all
        {_sql_histogram('passage', 'length(text)', 'documents', 10, 500)} union all
        {_sql_histogram('price', 'l_extendedprice', 'lineitem', 1000, 100)}""",
    "box_stats": f"""with {SQL_PAIRS} {_sql_box('context', 'length(context)', 'pairs')} union all
        {_sql_box('question', 'length(question)', 'pairs')} union all
        {_sql_box('total', 'o_totalprice', 'orders')}""",
    "long_text_ratio": """select count(*) filter (length(text) > 2000) as n_above,
        round(avg(case when length(text) > 2000 then 1 else 0 end), 6) as share_above from documents""",
    "max_lengths": f"""with {_FLAGGED} select split, max(length(text)) as max_text,
        max(length(title)) as max_title from flagged group by split""",
    "top_values": """select o_orderkey, o_totalprice from orders
        order by o_totalprice desc, o_orderkey limit 100""",
}
