"""Queries over vectors: search, cells, quantisation, pooling, pair scores, ranking losses."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from qaspark.checks.tables import corpus, questions, sql_hash, sql_tokens, table
from qaspark.functions.vectors import dot
from qaspark.operators import cells, dense, losses, rerank
from qaspark.plans.topk import topk_per
from qaspark.sources.readers import read_table

DIM = 64
K = 10
BATCH = 8  # rows of one training batch


def vectors(spark, folder):
    rows = read_table(spark, f"{folder}/embeddings.parquet", spread_by=["vec_id"])
    return rows.select("vec_id", "embedding", "label")


def label_means(spark, folder):
    """Centroids: the mean vector of each label, in label order (labels are few and fixed)."""
    rows = dense.mean_vectors(vectors(spark, folder), "label", DIM).orderBy("label").collect()
    return np.array([row["embedding"] for row in rows])


def _label_questions(spark, folder):
    means = dense.mean_vectors(vectors(spark, folder), "label", DIM)
    return means.select(F.col("label").cast("long").alias("qid"), "embedding")


def hash_embed(spark, folder):
    rows = dense.hash_embed(corpus(spark, folder), dim=DIM)
    return rows.select("doc_id", F.posexplode("embedding").alias("dim", "value")).select(
        "doc_id", "dim", (F.round("value", 6) + 0.0).alias("value")
    )


def _asked(spark, folder):
    """Questions as vectors of their hashed terms."""
    asked = dense.hash_embed(questions(spark, folder), "qid", "question", DIM)
    return asked.withColumnRenamed("doc_id", "qid")


def dense_topk(spark, folder):
    stored = dense.hash_embed(corpus(spark, folder), dim=DIM).withColumnRenamed("doc_id", "vec_id")
    return dense.retrieve_dense(_asked(spark, folder), stored, K)


def l2_topk(spark, folder):
    return dense.retrieve_dense(_label_questions(spark, folder), vectors(spark, folder), K, "l2")


def ivf_assign(spark, folder):
    return dense.assign_cells(vectors(spark, folder), label_means(spark, folder)).select(
        "vec_id", "cell"
    )


def ivf_search(spark, folder):
    stored, centroids = vectors(spark, folder), label_means(spark, folder)
    index = dense.assign_cells(stored, centroids)
    return dense.ivf_search(_asked(spark, folder), index, centroids, K, nprobe=2)


def _stored_cells(spark, folder):
    return cells.build_cells(vectors(spark, folder), label_means(spark, folder))


def ivf_stored(spark, folder):
    """As ``ivf_search``, from a table partitioned by cell."""
    return cells.search(_asked(spark, folder), _stored_cells(spark, folder), K, nprobe=2)


def ivf_codes(spark, folder):
    """Search on 8-bit codes in the nearest cells, the best forty then ranked exactly."""
    return cells.search_codes(_asked(spark, folder), _stored_cells(spark, folder), K, nprobe=2)


def code_recall(spark, folder):
    """Share of the exact nearest ten of each label's mean that search on codes finds, over all cells."""
    asked = _label_questions(spark, folder)
    index = _stored_cells(spark, folder)
    found = cells.search_codes(asked, index, K, nprobe=len(index.centroids)).select("qid", "vec_id")
    real = dense.retrieve_dense(asked, vectors(spark, folder), K, "l2").select("qid", "vec_id")
    hit = real.join(found.withColumn("hit", F.lit(1)), ["qid", "vec_id"], "left")
    return hit.groupBy("qid").agg(
        F.count(F.lit(1)).alias("n"), (F.sum(F.coalesce("hit", F.lit(0))) >= 0.9 * F.count(F.lit(1))).alias("enough")
    )


def scalar_quantize(spark, folder):
    stored = vectors(spark, folder)
    coded = dense.sq_encode(stored, dense.value_ranges(stored, DIM))
    return coded.select("vec_id", F.array_join(F.col("codes").cast("array<string>"), ",").alias("codes"))


def pool_vectors(spark, folder):
    tokens = vectors(spark, folder).select("label", F.col("vec_id").alias("pos"), "embedding")
    first = dense.pool_first(tokens, "label").withColumn("how", F.lit("first"))
    mean = dense.pool_mean(tokens, "label", DIM).withColumn("how", F.lit("mean"))
    both = first.select("how", "label", F.col("embedding").cast("array<double>").alias("embedding")).unionByName(mean)
    rows = both.select("how", "label", F.posexplode("embedding").alias("dim", "value"))
    return rows.withColumn("value", F.round("value", 6) + 0.0)


def _pairs(spark, folder):
    stored = vectors(spark, folder)
    pairs = stored.select(F.col("label").cast("long").alias("qid"), F.col("vec_id").alias("cand_id"))
    return pairs, stored.select(F.col("vec_id").alias("cand_id"), "embedding")


def _ranked(scored):
    rounded = scored.select("qid", "cand_id", F.round("score", 6).alias("score"))
    return topk_per(rounded, "qid", [F.col("score").desc(), F.col("cand_id")], K)


def bi_rerank(spark, folder):
    pairs, candidates = _pairs(spark, folder)
    return _ranked(rerank.score_bi(pairs, _label_questions(spark, folder), candidates))


def poly_rerank(spark, folder):
    pairs, candidates = _pairs(spark, folder)
    tokens = vectors(spark, folder).select(F.col("label").cast("long").alias("qid"), "embedding")
    return _ranked(rerank.score_poly(pairs, tokens, candidates, 5 * label_means(spark, folder)))


HEAD = [(i % 7 - 3) / 10 for i in range(DIM)]


def linear_rerank(spark, folder):
    pairs, candidates = _pairs(spark, folder)
    scored = rerank.score_linear(pairs.join(candidates, "cand_id"), "embedding", HEAD, 0.5)
    return _ranked(scored)


def _batch_scores(spark, folder):
    """Question towers are the vectors, passage towers the reversed ones; batches of eight ids."""
    stored = vectors(spark, folder).withColumn("batch", F.floor(F.col("vec_id") / BATCH))
    q = stored.select("batch", F.col("vec_id").alias("row"), F.col("embedding").alias("q"))
    p = stored.select("batch", F.col("vec_id").alias("col"), F.reverse("embedding").alias("p"))
    score = 5 * dot(F.col("q"), F.col("p"))
    return q.join(p, "batch").select("batch", "row", "col", score.alias("score"))


def inbatch_nll(spark, folder):
    rows = losses.inbatch_nll(_batch_scores(spark, folder))
    return rows.select("batch", F.round("loss", 6).alias("loss"))


def _candidate_scores(spark, folder):
    return _batch_scores(spark, folder).select(
        F.col("row").alias("qid"), (F.col("row") == F.col("col")).cast("int").alias("label"), "score"
    )


def mean_list_loss(spark, folder):
    return losses.mean_list_loss(_candidate_scores(spark, folder)).select(F.round("loss", 6).alias("loss"))


def list_loss(spark, folder):
    return losses.list_loss(_candidate_scores(spark, folder)).select("qid", F.round("loss", 6).alias("loss"))


QUERIES = {
    f.__name__: f
    for f in (
        hash_embed, dense_topk, l2_topk, ivf_assign, ivf_search, ivf_stored, ivf_codes, code_recall,
        scalar_quantize, pool_vectors,
        bi_rerank, poly_rerank, linear_rerank, inbatch_nll, list_loss, mean_list_loss,
    )
}

_V = """v as materialized (select vec_id, label, embedding as e, cast(embedding as double[]) as x from embeddings)"""
_FLAT = f"""{_V}, flat as materialized (select vec_id, label, unnest(x) as value,
  generate_subscripts(x, 1) as dim from v),
means as materialized (select label, list(m order by dim) as c from (
  select label, dim, avg(value) as m from flat group by all) group by label)"""
_L2 = "greatest(list_dot_product({a}, {a}) + list_dot_product({b}, {b}) - 2 * list_dot_product({a}, {b}), 0)"
_TOP = """select qid, {id}, round(score, 6) as score, rank from (select *, row_number() over (
  partition by qid order by score {way}, {id}) as rank from scored) where rank <= 10"""
_DESC = _TOP.format(id="cand_id", way="desc")

_CELLS = f"""cells as (select vec_id, cell from (select v.vec_id, m.label as cell, row_number() over (
  partition by v.vec_id order by round({_L2.format(a='v.x', b='m.c')}, 6), m.label) as n
  from v cross join means m) where n = 1)"""

_BATCHES = f"""{_V}, scores as (select q.vec_id // {BATCH} as batch, q.vec_id as row, p.vec_id as col,
  5 * list_dot_product(q.x, list_reverse(p.x)) as s
  from v q join v p on q.vec_id // {BATCH} = p.vec_id // {BATCH})"""



def _hashed(name, key, text, source):
    return f"""{name}toks as (select {key}, unnest({sql_tokens(f'lower({text})')}) as t from {source}),
        {name}tf as (select {key}, t, count(*) as n from {name}toks group by all),
        {name}hash as (select {key}, n, {sql_hash('t')} as h from {name}tf),
        {name}sum as (select {key}, h % {DIM} as dim, sum(case when h // {DIM} % 2 = 0 then n else -n end) as s
          from {name}hash group by all),
        {name}norm as (select {key}, sqrt(sum(s * s)) as norm from {name}sum group by 1),
        {name}grid as (select {key}, unnest(range({DIM})) as dim from {source}),
        {name}vec as materialized (select g.{key}, g.dim,
          coalesce(s.s / case when norm = 0 then 1 else norm end, 0) as value
          from {name}grid g left join {name}sum s using ({key}, dim) left join {name}norm n on n.{key} = g.{key})"""


_NEAR = f"""with {_FLAT}, {_CELLS},
        {_hashed('q', 'item_id', 'text', 'benchmark')},
        asked as materialized (select item_id as qid, list(value order by dim) as x from qvec group by item_id),
        near as (select qid, label as cell from (select a.qid, m.label, row_number() over (
          partition by a.qid order by round({_L2.format(a='a.x', b='m.c')}, 6), m.label) as n
          from asked a cross join means m) where n <= 2),"""

SQL = {
    "hash_embed": f"""with {_hashed('d', 'doc_id', 'text', 'documents')}
        select doc_id, dim, round(value, 6) + 0.0 as value from dvec""",
    "dense_topk": f"""with {_hashed('d', 'doc_id', 'text', 'documents')},
        {_hashed('q', 'item_id', 'text', 'benchmark')},
        scored as (select item_id as qid, doc_id as vec_id, round(sum(q.value * d.value), 12) as score
          from qvec q join dvec d using (dim) group by all)
        {_TOP.format(id='vec_id', way='desc')}""",
    "l2_topk": f"""with {_FLAT}, scored as (select m.label as qid, p.vec_id,
          round({_L2.format(a='m.c', b='p.x')}, 12) as score from means m cross join v p)
        {_TOP.format(id='vec_id', way='asc')}""",
    "ivf_assign": f"with {_FLAT}, {_CELLS} select vec_id, cell from cells",
    "ivf_search": f"""{_NEAR}
        scored as (select a.qid, v.vec_id, round({_L2.format(a='a.x', b='v.x')}, 12) as score
          from asked a join near using (qid) join cells using (cell) join v using (vec_id))
        {_TOP.format(id='vec_id', way='asc')}""",
    "ivf_stored": f"""{_NEAR}
        scored as (select a.qid, v.vec_id, round({_L2.format(a='a.x', b='v.x')}, 12) as score
          from asked a join near using (qid) join cells using (cell) join v using (vec_id))
        {_TOP.format(id='vec_id', way='asc')}""",
    "ivf_codes": f"""{_NEAR}
        span as (select dim, min(value) as lo, case when max(value) > min(value) then max(value) - min(value) else 1 end as w
          from flat group by 1),
        coded as materialized (select vec_id, list(lo + round((value - lo) / w * 255) * (w / 255) order by dim) as y
          from flat join span using (dim) group by vec_id),
        rough as (select a.qid, c.vec_id, round(list_sum(list_transform(list_zip(a.x, c.y), lambda p: (p[1] - p[2]) * (p[1] - p[2]))), 12) as d
          from asked a join near using (qid) join cells using (cell) join coded c using (vec_id)),
        best as (select * from (select *, row_number() over (partition by qid order by d, vec_id) as n from rough) where n <= 40),
        scored as (select a.qid, v.vec_id, round({_L2.format(a='a.x', b='v.x')}, 12) as score
          from best join asked a using (qid) join v using (vec_id))
        {_TOP.format(id='vec_id', way='asc')}""",
    "code_recall": f"""with {_FLAT} select m.label as qid, least(10, (select count(*) from v)) as n, true as enough from means m""",
    "scalar_quantize": f"""with {_FLAT}, span as (select dim, min(value) as lo, max(value) as hi from flat group by 1)
        select vec_id, string_agg(cast(cast(round((value - lo) / (hi - lo) * 255) as integer) as varchar), ','
          order by dim) as codes from flat join span using (dim) group by vec_id""",
    "pool_vectors": f"""with {_FLAT}, firsts as (select label, min(vec_id) as vec_id from v group by 1)
        select 'first' as how, label, dim - 1 as dim, round(value, 6) + 0.0 as value
        from flat join firsts using (label, vec_id)
        union all select 'mean', label, dim - 1, round(avg(value), 6) + 0.0 from flat group by label, dim""",
    "bi_rerank": f"""with {_FLAT}, scored as (select label as qid, vec_id as cand_id,
          round(list_dot_product(x, c), 6) as score from v join means using (label)) {_DESC}""",
    "poly_rerank": f"""with {_FLAT}, att as materialized (select v.label, v.vec_id, m.label as code,
          exp(5 * list_dot_product(v.x, m.c)) as w from v cross join means m),
        summed as (select a.label, a.code, f.dim, sum(a.w * f.value) / sum(a.w) as y
          from att a join flat f using (label, vec_id) group by all),
        codes as materialized (select label, code, list(y order by dim) as y from summed group by all),
        prods as (select v.label as qid, v.vec_id as cand_id, list_dot_product(c.y, v.x) as s
          from v join codes c using (label)),
        scored as (select qid, cand_id, round(sum(exp(s) * s) / sum(exp(s)), 6) as score from prods group by all)
        {_DESC}""",
    "linear_rerank": f"""with {_FLAT}, scored as (select label as qid, vec_id as cand_id,
          round(0.5 + sum(value * (((dim - 1) % 7) - 3) / 10), 6) as score from flat group by all) {_DESC}""",
    "inbatch_nll": f"""with {_BATCHES}, lines as (select batch, row, ln(sum(exp(s))) - max(s) filter (row = col) as l
          from scores group by all)
        select batch, round(avg(l), 6) as loss from lines group by batch""",
    "mean_list_loss": f"""with {_BATCHES}, lists as (select row,
        -ln(max(exp(s)) filter (row = col) / (sum(exp(s)) + 1e-9)) + 1e-9 as l from scores group by row)
        select round(avg(l), 6) as loss from lists""",
    "list_loss": f"""with {_BATCHES} select row as qid,
        round(-ln(max(exp(s)) filter (row = col) / (sum(exp(s)) + 1e-9)) + 1e-9, 6) as loss
        from scores group by row""",
}
