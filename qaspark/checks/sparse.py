"""Queries over the BM25 and TF-IDF retrievers."""

from __future__ import annotations

from pyspark.sql import functions as F

from qaspark.checks.tables import (
    SQL_CORPUS,
    SQL_PAIRS,
    SQL_QUESTIONS,
    corpus,
    dialogue_pairs,
    questions,
    sql_tokens,
    table,
)
from qaspark.operators import bm25, corpus as ops, inverted, sparse_cells, tfidf
from qaspark.operators.prepare import tokenize_rows
from qaspark.operators.quality import recall_at_k as recall
from qaspark.session import scratch_path, store
from qaspark.sources.index_store import IndexStore, fingerprint

K = 10
N_CELLS, CELL_TERMS, N_PROBE = 16, 64, 4
PROBE = "the whst onen of thention and erre"


def passages(spark, folder):
    return ops.dedup_corpus(corpus(spark, folder))


def bm25_term_stats(spark, folder):
    index = bm25.build_index(passages(spark, folder))
    size = F.size("terms").cast("long")
    per_doc = index.forward.select("doc_id", "length", size.alias("n_terms"))
    return per_doc.withColumns(
        {
            "documents": F.lit(index.documents).cast("long"),
            "mean_length": F.round(F.lit(index.mean_length), 6),
        }
    )


def bm25_idf(spark, folder):
    index = bm25.build_index(passages(spark, folder))
    rows = index.idf(index.frequencies)
    return rows.select("term", "df", F.round("idf", 6).alias("idf"))


def bm25_scores(spark, folder):
    index = bm25.build_index(passages(spark, folder))
    pairs = bm25.bm25_scores(questions(spark, folder), index)
    return pairs.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_questions"),
        F.max("score").alias("best_score"),
        F.min("score").alias("worst_score"),
    )


def bm25_topk(spark, folder):
    index = bm25.build_index(passages(spark, folder))
    return bm25.retrieve(questions(spark, folder), index, K)


def bm25_subset(spark, folder):
    index = bm25.build_index(passages(spark, folder))
    good = table(spark, folder, "labels").filter("quality = 1").select("doc_id")
    return bm25.retrieve(questions(spark, folder), index, K, doc_subset=good)


def bm25_single(spark, folder):
    docs = passages(spark, folder)
    return bm25.top_n(PROBE, bm25.build_index(docs), docs, K)


def bm25_lists(spark, folder):
    """As ``bm25_topk``, from stored inverted lists of which only what can matter is read."""
    index = bm25.build_index(passages(spark, folder))
    return inverted.retrieve(questions(spark, folder), index, inverted.build_lists(index), K)


def index_reuse(spark, folder):
    docs = passages(spark, folder)
    kept = IndexStore(spark, scratch_path(spark, "store"))
    mark = fingerprint(docs, "doc_id", "text", scheme="space", lower=False)
    kept.get_or_build(mark, lambda: bm25.index_tables(docs))

    def stale():
        raise AssertionError("the stored index was not found")

    index = bm25.open_index(kept.get_or_build(mark, stale))
    return bm25.retrieve(questions(spark, folder), index, K)


def attach_text(spark, folder):
    docs = corpus(spark, folder).select("doc_id", "text")
    return ops.attach_text(bm25_topk(spark, folder), docs).select("qid", "rank", "doc_id", "text")


def _answered(spark, folder):
    hits = ops.attach_text(bm25_topk(spark, folder), corpus(spark, folder))
    return ops.concat_context(hits, questions(spark, folder))


def context_concat(spark, folder):
    return _answered(spark, folder)


def attach_gold(spark, folder):
    """Users' questions with what the corpus gives for them, and the context they were asked in."""
    asked = dialogue_pairs(spark, folder).select(F.col("id").alias("qid"), "question", "context", "conv_id")
    docs = passages(spark, folder)
    hits = bm25.retrieve(asked.select("qid", "question"), bm25.build_index(docs), K)
    answers = ops.concat_context(ops.attach_text(hits, docs), asked.select("qid", "question"))
    names = {"context": "original_context", "conv_id": "original_title"}
    return ops.attach_gold(answers, asked, "qid", names)


def recall_at_k(spark, folder):
    hits = ops.attach_text(bm25_topk(spark, folder), corpus(spark, folder))
    gold = questions(spark, folder).withColumnRenamed("question", "gold")
    rows = recall(hits, gold, [1, 5, K])
    return rows.withColumn("rate", F.round("rate", 6))


def tfidf_vocab(spark, folder):
    model = tfidf.fit(passages(spark, folder))
    return model.vocabulary.select("term", "cf", "df", F.round("idf", 6).alias("idf"))


def tfidf_weights(spark, folder):
    model = tfidf.fit(passages(spark, folder))
    rows = tfidf.transform_corpus(model)
    return rows.select("doc_id", "term", F.round("weight", 6).alias("weight"))


def tfidf_topk(spark, folder):
    model = tfidf.fit(passages(spark, folder))
    return tfidf.retrieve(questions(spark, folder), model, K)


def _sparse_cells(spark, folder):
    model = tfidf.fit(passages(spark, folder))
    vocabulary = sparse_cells.numbered_terms(model)
    vectors = store(sparse_cells.corpus_vectors(model, vocabulary), "vectors")
    # one round over all rows, so that SQL can follow
    return model, vocabulary, vectors, sparse_cells.train(vectors, N_CELLS, CELL_TERMS, iterations=1, sample=None)


def sparse_assign(spark, folder):
    """Cell of every passage over sparse TF-IDF vectors, centroids cut to their heaviest terms."""
    _, _, vectors, centroids = _sparse_cells(spark, folder)
    placed = sparse_cells.assign(vectors, centroids)
    return placed.select("doc_id", "cell", F.round("similarity", 6).alias("similarity"))


def sparse_ivf(spark, folder):
    """TF-IDF search within the most similar cells, from the stored index."""
    model, vocabulary, vectors, centroids = _sparse_cells(spark, folder)
    asked = sparse_cells.question_vectors(questions(spark, folder), model, vocabulary)
    return sparse_cells.search(asked, sparse_cells.build(vectors, centroids), K, N_PROBE)


def oov_questions(spark, folder):
    model = tfidf.fit(passages(spark, folder), bigrams=False)
    words = tokenize_rows(dialogue_pairs(spark, folder), "id", "question")
    asked = words.select(F.concat_ws("-", "id", "pos").alias("qid"), F.col("token").alias("question"))
    return tfidf.oov_questions(asked, model)


QUERIES = {
    f.__name__: f
    for f in (
        bm25_term_stats, bm25_idf, bm25_scores, bm25_topk, bm25_lists, bm25_subset, bm25_single, index_reuse,
        attach_text, context_concat, attach_gold, recall_at_k, tfidf_vocab, tfidf_weights,
        tfidf_topk, sparse_assign, sparse_ivf, oov_questions,
    )
}

_DEDUP = f"""{SQL_CORPUS}, {SQL_QUESTIONS}, passages as materialized (
  select doc_id, text, title from (select *, row_number() over (partition by text order by doc_id) as n
                                   from corpus) where n = 1)"""

_INDEX = f"""{_DEDUP},
toks as materialized (select doc_id, unnest({sql_tokens('text')}) as term from passages),
tf as materialized (select doc_id, term, count(*) as tf from toks group by all),
lens as materialized (select p.doc_id, coalesce(t.length, 0) as length from passages p
  left join (select doc_id, count(*) as length from toks group by 1) t using (doc_id)),
facts as materialized (select count(*) as n, avg(length) as mean_length from lens),
dfs as materialized (select term, count(*) as df from tf group by 1),
raw as (select term, df, ln(n - df + 0.5) - ln(df + 0.5) as r from dfs, facts),
idfs as materialized (select term, df, case when r < 0 then 0.25 * (select avg(r) from raw) else r end as idf
  from raw)"""

_SCORED = """qterms as (select qid, term, count(*) as qtf from (
  select qid, unnest({tokens}) as term from {source}) group by all),
scored as materialized (select q.qid, t.doc_id, round(sum(q.qtf * i.idf * t.tf * 2.5 /
    (t.tf + 1.5 * (1 - 0.75 + 0.75 * l.length / mean_length))), 12) as score
  from qterms q join tf t using (term) join idfs i using (term) join lens l using (doc_id), facts
  {where} group by q.qid, t.doc_id),
ranked as materialized (select *, row_number() over (partition by qid order by score desc, doc_id) as rank from scored),
hits as materialized (select * from ranked where rank <= 10)"""


def _scored(where="", source="questions"):
    return _SCORED.format(tokens=sql_tokens("question"), where=where, source=source)


_BM25 = f"{_INDEX}, {_scored()}"

_JOINED = """joined as (select q.qid, q.question, coalesce(string_agg(p.text, ' ' order by h.rank), '') as context
  from questions q left join hits h using (qid) left join passages p using (doc_id) group by 1, 2)"""


SQL_JOINED = f"{_BM25}, {_JOINED}"


def _tfidf(bigrams=True):
    grams = "toks" if not bigrams else """(select * from toks union all
      select doc_id, term || ' ' || nxt from (select doc_id, term, lead(term) over (
        partition by doc_id order by pos) as nxt from placed) where nxt is not null)"""
    return f"""{_DEDUP},
    words as (select doc_id, {sql_tokens('lower(text)')} as w from passages),
    placed as materialized (select doc_id, unnest(w) as term, generate_subscripts(w, 1) as pos from words),
    toks as (select doc_id, term from placed),
    tf as materialized (select doc_id, term, count(*) as tf from {grams} group by all),
    vocab as materialized (select term, cast(sum(tf) as bigint) as cf, count(*) as df,
      ln((1 + (select count(*) from passages)) / (1 + count(*))) + 1 as idf
      from tf group by term order by cf desc, term limit 50000),
    rawdoc as (select doc_id, term, tf * idf as w from tf join vocab using (term)),
    docw as materialized (select doc_id, term, w / sqrt(sum(w * w) over (partition by doc_id)) as weight from rawdoc)"""


_TFIDF_HITS = f"""qwords as (select qid, {sql_tokens('lower(question)')} as w from questions),
  qplaced as (select qid, unnest(w) as term, generate_subscripts(w, 1) as pos from qwords),
  qgrams as (select qid, term from qplaced union all select qid, term || ' ' || nxt from (
    select qid, term, lead(term) over (partition by qid order by pos) as nxt from qplaced) where nxt is not null),
  qraw as (select qid, term, count(*) * any_value(idf) as w from qgrams join vocab using (term) group by qid, term),
  qw as (select qid, term, w / sqrt(sum(w * w) over (partition by qid)) as qweight from qraw),
  scored as (select qid, doc_id, round(sum(weight * qweight), 12) as score from qw join docw using (term) group by all),
  ranked as (select *, row_number() over (partition by qid order by score desc, doc_id) as rank from scored)"""


def _cell_terms(sums, name):
    """The heaviest terms of (cell, term, weight) sums, normalised."""
    return f"""{name}_top as (select cell, term, weight from (select *, row_number() over (
      partition by cell order by weight desc, term) as place from (
      select cell, term, round(sum(weight), 12) as weight from {sums} group by all)) where place <= {CELL_TERMS}),
    {name} as materialized (select cell, term, weight / sqrt(sum(weight * weight) over (partition by cell)) as weight
      from {name}_top)"""


def _nearest_cells(key, rows, vectors, weight, centroids, name):
    """(key, cell, similarity, place): every cell by similarity, then number."""
    return f"""{name} as materialized (select *, row_number() over (partition by {key} order by similarity desc, cell) as place
      from (select {key}, cell, coalesce(similarity, 0) as similarity
        from (select {key}, unnest(range({N_CELLS})) as cell from {rows}) e left join (
          select v.{key}, c.cell, round(sum(v.{weight} * c.weight), 12) as similarity
          from {vectors} v join {centroids} c using (term) group by all) s using ({key}, cell)))"""


_CELLS = f"""{_tfidf()},
  seeds as (select doc_id, row_number() over (order by md5(cast(doc_id as varchar)), doc_id) - 1 as cell
    from (select distinct doc_id from docw) order by cell limit {N_CELLS}),
  seeded as (select cell, term, weight from docw join seeds using (doc_id)),
  {_cell_terms("seeded", "first_cells")},
  {_nearest_cells("doc_id", "passages", "docw", "weight", "first_cells", "placed_once")},
  moved as (select cell, term, weight from docw join (select doc_id, cell from placed_once where place = 1) using (doc_id)),
  {_cell_terms("moved", "moved_cells")},
  centroids as materialized (select * from moved_cells union all
    select * from first_cells where cell not in (select cell from moved_cells)),
  {_nearest_cells("doc_id", "passages", "docw", "weight", "centroids", "placed_docs")}"""

SQL = {
    "sparse_assign": f"""with {_CELLS} select doc_id, cell, round(similarity, 6) as similarity
        from placed_docs where place = 1""",
    "sparse_ivf": f"""with {_CELLS}, {_TFIDF_HITS.split("ranked as")[0].rstrip().rstrip(",")},
        {_nearest_cells("qid", "questions", "qw", "qweight", "centroids", "placed_questions")},
        near as (select s.* from scored s join (select doc_id, cell from placed_docs where place = 1) d using (doc_id)
          join (select qid, cell from placed_questions where place <= {N_PROBE}) q using (qid, cell)),
        ranked as (select *, row_number() over (partition by qid order by score desc, doc_id) as rank from near)
        select qid, doc_id, round(score, 6) as score, rank from ranked where rank <= {K}""",
    "bm25_term_stats": f"""with {_INDEX} select l.doc_id, l.length, coalesce(t.n_terms, 0) as n_terms,
        n as documents, round(mean_length, 6) as mean_length
        from lens l left join (select doc_id, count(*) as n_terms from tf group by 1) t using (doc_id), facts""",
    "bm25_idf": f"with {_INDEX} select term, df, round(idf, 6) as idf from idfs",
    "bm25_scores": f"""with {_BM25} select doc_id, count(*) as n_questions, round(max(score), 6) as best_score,
        round(min(score), 6) as worst_score from scored group by doc_id""",
    "bm25_topk": f"with {_BM25} select qid, doc_id, round(score, 6) as score, rank from hits",
    "bm25_lists": f"with {_BM25} select qid, doc_id, round(score, 6) as score, rank from hits",
    "bm25_subset": f"""with {_INDEX}, {_scored('where t.doc_id in (select doc_id from labels where quality = 1)')}
        select qid, doc_id, round(score, 6) as score, rank from hits""",
    "bm25_single": f"""with {_INDEX}, probe as (select 0 as qid, '{PROBE}' as question), {_scored(source='probe')}
        select doc_id, round(score, 6) as score, text from hits join passages using (doc_id)""",
    "index_reuse": f"with {_BM25} select qid, doc_id, round(score, 6) as score, rank from hits",
    "attach_text": f"with {_BM25} select qid, rank, doc_id, text from hits join passages using (doc_id)",
    "context_concat": f"with {SQL_JOINED} select qid, question, context from joined",
    "attach_gold": f"""with {_INDEX}, {SQL_PAIRS}, asked as (select id as qid, question from pairs), {_scored(source='asked')},
        {_JOINED.replace('from questions q', 'from asked q')}
        select j.qid, j.question, j.context, p.context as original_context, p.conv_id as original_title
        from joined j left join pairs p on p.id = j.qid""",
    "recall_at_k": f"""with {_BM25}, ks as (select unnest([1, 5, 10]) as k),
        joined as (select q.qid, q.question, k, coalesce(string_agg(p.text, ' ' order by h.rank), '') as context
          from questions q cross join ks left join hits h on h.qid = q.qid and h.rank <= k
          left join passages p using (doc_id) group by all)
        select k, count(*) as n, count(*) filter (contains(context, question)) as n_hit,
          round(avg(case when contains(context, question) then 1 else 0 end), 6) as rate
        from joined group by k""",
    "tfidf_vocab": f"with {_tfidf()} select term, cf, df, round(idf, 6) as idf from vocab",
    "tfidf_weights": f"with {_tfidf()} select doc_id, term, round(weight, 6) as weight from docw",
    "tfidf_topk": f"with {_tfidf()}, {_TFIDF_HITS} select qid, doc_id, round(score, 6) as score, rank from ranked where rank <= 10",
    "oov_questions": f"""with {_tfidf(False)}, {SQL_PAIRS},
        spoken as (select id, {sql_tokens('question')} as w from pairs),
        turns as (select id || '-' || pos as qid, question from (
          select id, unnest(w) as question, generate_subscripts(w, 1) - 1 as pos from spoken)),
        terms as (select qid, unnest({sql_tokens('lower(question)')}) as term from turns)
        select qid, question from turns
        where qid not in (select qid from terms where term in (select term from vocab))""",
}
