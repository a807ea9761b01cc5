"""Queries over chunks, labels, decoding, metrics and ensembles."""

from __future__ import annotations

from pyspark.sql import functions as F

from qaspark.checks.sparse import SQL_JOINED, bm25_topk, passages
from qaspark.checks.tables import (
    BLANK,
    SQL_CORPUS,
    SQL_QA,
    corpus,
    qa,
    questions,
    sql_hash,
    sql_tokens,
)
from qaspark.operators import answer, chunks as ch, decode, ensemble as vote, losses, metrics, prepare, stats
from qaspark.plans.broadcasts import union_all
from qaspark.plans.order import row_index
from qaspark.session import scratch_path, store
from qaspark.sources import readers, writers

MAX_LEN, OVERLAP = 96, 32
OPEN_LEN, OPEN_OVERLAP = 512, 256
MODELS = ["70", "65", "60"]  # stand for runs of that accuracy; weight = number / 100
TASK_CHUNKS = 1 << 15
NBEST_ROWS = 64  # questions of a named file
SPECIAL_IDS = {ch.PAD: 0, ch.UNKNOWN: 1, ch.CLS: 2, ch.SEP: 3}


def labelled(spark, folder):
    rows = prepare.with_span(qa(spark, folder)).drop("answers")
    return ch.chunk(rows, MAX_LEN, OVERLAP)


def chunk_windows(spark, folder):
    rows = labelled(spark, folder)
    return rows.select(
        "id", "chunk_no", F.size("tokens").alias("n_tokens"), F.array_join("tokens", " ").alias("part")
    )


def token_offsets(spark, folder):
    rows = ch.with_feature_offsets(labelled(spark, folder))
    placed = rows.select("id", "chunk_no", F.posexplode("offsets").alias("pos", "o"))
    return placed.select("id", "chunk_no", "pos", "o.s", "o.e")


def label_align(spark, folder):
    rows = ch.align_labels(labelled(spark, folder))
    return rows.select("id", "chunk_no", "start_pos", "end_pos")


def test_chunks(spark, folder):
    rows = qa(spark, folder).select("id", "question", "context")
    cut = ch.with_feature_offsets(ch.chunk(rows, 64, 16))
    return cut.select("id", "chunk_no", F.size("offsets").alias("n_positions"), F.size("tokens").alias("n_tokens"))


def pad_mask(spark, folder):
    rows = qa(spark, folder).select("id", "question", "context")
    words = prepare.tokenize_rows(rows, "id", "context").groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    ranked = row_index(words.withColumn("m", -F.col("n")), ["m", "token"])
    vocabulary = ranked.select("token", (F.col("row_no") + 4).cast("int").alias("token_id"))
    padded = ch.encode_pad(ch.chunk(rows, MAX_LEN, OVERLAP), vocabulary, SPECIAL_IDS)
    return padded.select(
        "id",
        "chunk_no",
        F.array_join(F.col("input_ids").cast("array<string>"), " ").alias("input_ids"),
        F.array_join(F.col("attention_mask").cast("array<string>"), "").alias("attention_mask"),
    )


def _asked(spark, folder):
    docs = corpus(spark, folder)
    return docs, docs.select(F.col("doc_id").alias("qid"), "doc_id", "title")


def candidate_sets(spark, folder):
    docs, asked = _asked(spark, folder)
    rows = ch.build_candidates(asked, docs, 31, "5")
    return rows.select("qid", "cand_no", "label", F.md5("cand_text").alias("cand_md5"))


def pair_text(spark, folder):
    docs, asked = _asked(spark, folder)
    rows = ch.build_candidates(asked, docs, 3, "6")
    opening = docs.select(F.col("doc_id").alias("qid"), F.col("text").alias("question"))
    joined = rows.join(opening, "qid")
    pair = ch.pair_text(F.col("question"), F.col("cand_text"))
    return joined.select("qid", "cand_no", F.md5(pair).alias("pair_md5"), F.length(pair).alias("n"))


def label_pos_hist(spark, folder):
    rows = ch.align_labels(labelled(spark, folder))
    tokens = stats.histogram(rows, {"token": F.col("start_pos")}, 10, 55)
    asked = prepare.with_span(qa(spark, folder))
    chars = stats.histogram(asked, {"char": F.col("start_char")}, 10, 150)
    return tokens.unionByName(chars)


def scored_chunks(spark, folder, model="70"):
    return with_logits(ch.with_feature_offsets(labelled(spark, folder)), model)


def with_logits(rows, model):
    """Chunks with stand-in logits of one model."""
    key = F.lit(model), F.col("id"), F.col("chunk_no")
    size = F.size("offsets")
    return rows.withColumns(
        {
            "start_logits": ch.hashed_logits(size, *key, F.lit("s")),
            "end_logits": ch.hashed_logits(size, *key, F.lit("e")),
        }
    )


def _examples(spark, folder):
    return qa(spark, folder).select("id", "context")


def _rounded(rows):
    return rows.select("id", "rank", "text", "start_logit", "end_logit", F.round("probability", 6).alias("probability"))


def span_decode(spark, folder):
    decoded = decode.decode_spans(scored_chunks(spark, folder), _examples(spark, folder))
    return _rounded(decode.nbest_rows(decoded))


def max_context_decode(spark, folder):
    rows = scored_chunks(spark, folder)
    fresh = F.transform(
        "offsets",
        lambda o, i: (F.col("chunk_no") == 0) | (i >= F.col("q_len") + 2 + F.col("shared")),
    )
    decoded = decode.decode_spans(
        rows.withColumn("fresh", fresh), _examples(spark, folder), max_context="fresh"
    )
    return _rounded(decode.nbest_rows(decoded))


def null_decode(spark, folder):
    decoded = decode.decode_spans(
        scored_chunks(spark, folder), _examples(spark, folder), n_best=10, allow_null=True, threshold=-24.0
    )
    return decoded.select("id", "prediction_text", "null_odds", F.size("nbest").alias("n_listed"))


def empty_fallback(spark, folder):
    """Answers under limits so narrow that many examples have no valid span: the fallback is the feature here."""
    decoded = decode.decode_spans(
        scored_chunks(spark, folder), _examples(spark, folder), n_best=2, max_answer_len=3
    )
    return decoded.select("id", "prediction_text")


def nbest_softmax(spark, folder):
    decoded = decode.decode_spans(scored_chunks(spark, folder), _examples(spark, folder))
    rows = decode.nbest_rows(decoded).drop("probability")
    return decode.softmax_over(rows, "id", "score").select("id", "rank", F.round("probability", 6).alias("probability"))


def _predictions(spark, folder):
    """The answer, moved some tokens to the left depending on the turn."""
    rows = qa(spark, folder)
    words = F.split(F.col("context"), "[ \t\n]+")
    middle = (F.size(words) / 2).cast("int") - F.col("turn").cast("int") % 3
    moved = F.array_join(F.slice(words, F.greatest(middle, F.lit(0)) + 1, F.lit(2)), " ")
    return rows.select("id", moved.alias("prediction_text"))


def _references(spark, folder):
    rows = qa(spark, folder)
    gold = rows.select("id", F.get("answers.text", F.lit(0)).alias("text"))
    return gold.unionByName(rows.select("id", F.col("question").alias("text")))


def squad_em(spark, folder):
    rows = metrics.qa_metrics(_predictions(spark, folder), _references(spark, folder))
    return rows.select(F.round("exact_match", 6).alias("exact_match"))


def squad_f1(spark, folder):
    rows = metrics.qa_scores(_predictions(spark, folder), _references(spark, folder))
    return rows.select("id", "exact_match", F.round("f1", 6).alias("f1"))


def reader_loss(spark, folder):
    rows = losses.reader_loss(ch.align_labels(scored_chunks_unmasked(spark, folder)))
    return rows.select(*[F.round(c, 6).alias(c) for c in rows.columns])


def scored_chunks_unmasked(spark, folder, model="70"):
    """As ``scored_chunks`` with the context's own offsets, which labels are aligned on."""
    rows = labelled(spark, folder)
    key = F.lit(model), F.col("id"), F.col("chunk_no")
    size = F.size("offsets") + F.col("q_len") + 3
    return rows.withColumns(
        {
            "start_logits": ch.hashed_logits(size, *key, F.lit("s")),
            "end_logits": ch.hashed_logits(size, *key, F.lit("e")),
        }
    )


def _open_answers(spark, folder):
    return answer.answer_questions(
        questions(spark, folder),
        passages(spark, folder),
        lambda asked: bm25_topk(spark, folder),
        lambda features: with_logits(features, "70"),
        OPEN_LEN,
        OPEN_OVERLAP,
    )


def open_answers(spark, folder):
    """Answers to all questions out of the whole corpus: retrieved, read, decoded."""
    rows = _open_answers(spark, folder)
    return rows.select("qid", "prediction_text", F.size("nbest").alias("n_listed"), F.md5("context").alias("context_md5"))


def open_scores(spark, folder):
    """The same answers against the question's own words."""
    gold = questions(spark, folder).select("qid", F.col("question").alias("text"))
    rows = answer.score_answers(_open_answers(spark, folder), gold)
    return rows.withColumn("f1", F.round("f1", 6))


def _decoded_runs(spark, folder):
    """Every model's answers; the features are made once and kept."""
    features = store(ch.with_feature_offsets(labelled(spark, folder)), "features")
    tasks = max(spark.sparkContext.defaultParallelism, -(-features.count() // TASK_CHUNKS))
    features = features.repartition(tasks, "id")  # a chunk gives up to 20 candidates, which are ordered in the task
    examples = store(_examples(spark, folder), "examples")
    for model in MODELS:
        yield model, decode.decode_spans(with_logits(features, model), examples)


def _runs(spark, folder):
    runs = [
        decode.nbest_rows(decoded).withColumn("model", F.lit(model))
        for model, decoded in _decoded_runs(spark, folder)
    ]
    return union_all(runs).withColumn("weight", F.col("model").cast("int") / 100)


def nbest_scan(spark, folder):
    path = scratch_path(spark, "nbest")
    for model, decoded in _decoded_runs(spark, folder):
        writers.write_predictions(decoded, path, model)
    rows = readers.read_nbest_lines(spark, f"{path}/nbest_predictions_*")
    return rows.select("model", "weight", "id", "rank", "text", F.round("probability", 6).alias("probability"))


def nbest_files(spark, folder):
    """As ``nbest_scan``, through files of the models' names, one JSON object each."""
    path = scratch_path(spark, "named")
    for model, decoded in _decoded_runs(spark, folder):
        writers.write_nbest_files(decoded, f"{path}/{model}", model, NBEST_ROWS)
    rows = readers.read_nbest(spark, f"{path}/*/*.json")
    return rows.select("model", "weight", "id", "rank", "text", F.round("probability", 6).alias("probability"))


def ensemble_vote(spark, folder):
    return vote.ensemble(_runs(spark, folder)).select("id", "text", "score")


def ensemble_nbest(spark, folder):
    return vote.ensemble(_runs(spark, folder), "add", "mean", 0.03, 20)


QUERIES = {
    f.__name__: f
    for f in (
        chunk_windows, token_offsets, label_align, test_chunks, pad_mask, candidate_sets, pair_text,
        label_pos_hist, span_decode, max_context_decode, null_decode, empty_fallback,
        nbest_softmax, squad_em, squad_f1, reader_loss, open_answers, open_scores, nbest_scan, nbest_files, ensemble_vote, ensemble_nbest,
    )
}


def _sql_chunks(max_len=MAX_LEN, overlap=OVERLAP, source=SQL_QA):
    return f"""{source},
    sized as (select id, question, n, answer_start, answer_start + length(answer_text) as answer_end,
      len({sql_tokens('question')}) as q, {max_len} - 3 - len({sql_tokens('question')}) as room,
      least({overlap}, ({max_len} - 3 - len({sql_tokens('question')})) // 2) as ov from qa),
    numbered as (select *, unnest(range(cast(1 + ceil(greatest(n - room, 0) / (room - ov)) as bigint))) as chunk_no
      from sized),
    chunks as materialized (select *, chunk_no * (room - ov) as beg,
      least(room, n - chunk_no * (room - ov)) as m from numbered),
    inside as materialized (select c.id, c.chunk_no, o.pos - 1 - c.beg + c.q + 2 as p, o.s, o.e, o.token
      from chunks c join offsets o on o.id = c.id and o.pos > c.beg and o.pos <= c.beg + c.m),
    positions as materialized (select c.id, c.chunk_no, c.q, c.ov, c.p, i.s, i.e
      from (select *, unnest(range(q + m + 3)) as p from chunks) c
      left join inside i on i.id = c.id and i.chunk_no = c.chunk_no and i.p = c.p)"""


_LABELS = """labels_at as materialized (select c.id, c.chunk_no,
    case when min(i.s) <= c.answer_start and max(i.e) >= c.answer_end
      then max(i.p) filter (i.s <= c.answer_start) else 0 end as start_pos,
    case when min(i.s) <= c.answer_start and max(i.e) >= c.answer_end
      then min(i.p) filter (i.e >= c.answer_end) else 0 end as end_pos
  from chunks c left join inside i on i.id = c.id and i.chunk_no = c.chunk_no
  group by c.id, c.chunk_no, c.answer_start, c.answer_end)"""


def _logit(side):
    return f"({sql_hash(f'''concat_ws('|', model, id, chunk_no, '{side}', p)''')} % 2001 - 1000) / 64.0"


def _sql_decode(models=("70",), n=20, longest=30, where="", null=False, chunks=None):
    listed = ", ".join(f"'{m}'" for m in models)
    extra = (
        """union all select model, id, 0, 0, 0, 1, sl, el, 0, 0, low from (select model, id, start_logit as sl,
          end_logit as el, start_logit + end_logit as low, row_number() over (partition by model, id
          order by start_logit + end_logit, chunk_no) as r from logits where p = 0) where r = 1"""
        if null
        else ""
    )
    return f"""{chunks or _sql_chunks()},
    logits as materialized (select *, cast({_logit('s')} as double) as start_logit,
      cast({_logit('e')} as double) as end_logit
      from positions cross join (select unnest([{listed}]) as model)),
    ranked as materialized (select *,
      row_number() over (partition by model, id, chunk_no order by start_logit desc, p) as sr,
      row_number() over (partition by model, id, chunk_no order by end_logit desc, p) as er from logits),
    pairs_at as (select a.model, a.id, a.chunk_no, a.sr, b.er, 0 as no_answer, a.start_logit as sl,
      b.end_logit as el, a.s, b.e, a.start_logit + b.end_logit as score
      from (select * from ranked where sr <= {n} and s is not null {where}) a
      join (select * from ranked where er <= {n} and s is not null) b
        on a.model = b.model and a.id = b.id and a.chunk_no = b.chunk_no
        and b.p >= a.p and b.p - a.p + 1 <= {longest}),
    real_top as materialized (select * from (select *, row_number() over (partition by model, id
      order by score desc, chunk_no, sr, er) as r from pairs_at) where r <= {n}),
    pooled as (select model, id, chunk_no, sr, er, no_answer, sl, el, s, e, score from real_top {extra}),
    placed as (select *, row_number() over (partition by model, id
      order by score desc, no_answer, chunk_no, sr, er) as r from pooled),
    spans as materialized (select * from placed where r <= {n} or no_answer = 1),
    texts as (select model, id, r, sl, el, score, no_answer, substr(context, cast(s + 1 as bigint), cast(e - s as bigint)) as text
      from spans join qa using (id)),
    bare as (select m.model, q.id from qa q cross join (select unnest([{listed}]) as model) m
      left join (select model, id, count(*) as c, max(length(text)) as l from texts group by 1, 2) t
        on t.model = m.model and t.id = q.id
      where coalesce(c, 0) = 0 or (c = 1 and l = 0)),
    entries as (select model, id, r, sl, el, score, text, no_answer from texts
      union all select model, id, 0, 0.0, 0.0, 0.0, 'empty', 0 from bare),
    nbest as materialized (select model, id, row_number() over (partition by model, id order by r) as rank,
      text, sl as start_logit, el as end_logit, score, no_answer,
      exp(score - max(score) over (partition by model, id)) as w from entries),
    final as materialized (select *, w / sum(w) over (partition by model, id) as probability from nbest)"""


_NBEST = "select id, rank, text, start_logit, end_logit, round(probability, 6) as probability from final"

_ARTICLES = r"(^|[^\p{L}\p{N}_])(?:a|an|the)($|[^\p{L}\p{N}_])"


def _norm(text):
    quoted = metrics.PUNCTUATION.replace("'", "''")
    bare = f"translate(lower({text}), '{quoted}', '')"
    for _ in range(2):  # neighbouring articles share the blank between them
        bare = rf"regexp_replace({bare}, '{_ARTICLES}', '\1 \2', 'g')"
    return sql_tokens(bare)


_MATCHES = """pc as (select id, t, count(*) as c from (select id, unnest(p) as t from told) group by all),
rc as (select id, ref, t, count(*) as c from (select id, ref, unnest(r) as t from refs) group by all),
same as (select rc.id, rc.ref, sum(least(pc.c, rc.c)) as n from rc join pc on pc.id = rc.id and pc.t = rc.t group by all),
scored as (select refs.id, case when array_to_string(p, ' ') = array_to_string(r, ' ') then 1.0 else 0.0 end as em,
  coalesce(2.0 * (n / len(p)) * (n / len(r)) / (n / len(p) + n / len(r)), 0) as f1
  from refs join told using (id) left join same on same.id = refs.id and same.ref = refs.ref),
best as (select id, max(em) as exact_match, max(f1) as f1 from scored group by id)"""

_METRICS = rf"""{SQL_QA},
words as (select id, question, answer_text, turn, regexp_split_to_array(context, '[ \t\n]+') as w from qa),
told as (select id, {_norm("array_to_string(w[greatest(len(w) // 2 - turn % 3, 0) + 1:greatest(len(w) // 2 - turn % 3, 0) + 2], ' ')")} as p
  from words),
refs as (select id, 1 as ref, {_norm('answer_text')} as r from qa union all
  select id, 2, {_norm('question')} from qa),
{_MATCHES}"""

# the questions with their retrieved contexts in place of the dialogues
_OPEN = f"""pairs as materialized (select qid as id, question, context from (
  with {SQL_JOINED} select qid, question, context from joined)),
cut as (select id, {sql_tokens('context')} as words, regexp_extract_all(' ' || context || ' ', '{BLANK}+') as gaps
  from pairs),
pieces as (select id, unnest(words) as token, unnest(gaps[:len(words)]) as gap, generate_subscripts(words, 1) as pos
  from cut),
offsets as materialized (select id, pos, token, s, s + length(token) as e from (
  select id, pos, token, sum(length(gap) + length(token)) over w - length(token) - 1 as s
  from pieces window w as (partition by id order by pos))),
counted as (select id, max(pos) as n from offsets group by id),
qa as (select p.id, p.question, p.context, coalesce(c.n, 0) as n, 0 as answer_start, '' as answer_text
  from pairs p left join counted c on c.id = p.id)"""

_OPEN_ANSWERS = _sql_decode(chunks=_sql_chunks(OPEN_LEN, OPEN_OVERLAP, _OPEN))


def _sql_vote(value, several, n):
    return f"""votes as (select id, text, count(*) as listed, sum({value}) as total from (
      select *, cast(model as integer) / 100 as weight from final) group by id, text),
    scored as (select id, text, round(case when listed = 1 then total else {several} end, 12) as score from votes),
    voted as (select *, row_number() over (partition by id order by score desc, text) as rank from scored)
    """, f"from voted where rank <= {n}"


_VOTE = _sql_vote("probability * weight", "total + listed * 0.01", 1)
_VOTE_N = _sql_vote("probability + weight", "total / listed + listed * 0.03", 20)


def _sql_negatives(n, seed):
    return f"""{SQL_CORPUS}, numbered_docs as materialized (
      select doc_id, title, row_number() over (order by title, doc_id) - 1 as slot from corpus),
    title_spans as (select title, min(slot) as beg, count(*) as own,
      (select count(*) from corpus) - count(*) as rest from numbered_docs group by title),
    asked as (select c.doc_id as qid, s.*, least({n}, rest) as strata from corpus c join title_spans s using (title)),
    drawn as (select *, unnest(range(1, strata + 1)) as cand_no from asked),
    strat as (select *, (cand_no - 1) * rest // strata as lo, cand_no * rest // strata as hi from drawn),
    put as (select qid, cand_no, beg, own,
      lo + {sql_hash(f"'{seed}:' || qid || ':' || cand_no")} % (hi - lo) as place from strat),
    cands as (select p.qid, p.cand_no, 0 as label, d.doc_id from put p
      join numbered_docs d on d.slot = case when place < beg then place else place + own end
      union all select doc_id, 0, 1, doc_id from corpus),
    tagged as (select qid, cand_no, label, '@' || title || ':' || text as cand_text from cands join corpus using (doc_id))"""


SQL = {
    "chunk_windows": f"""with {_sql_chunks()} select c.id, c.chunk_no, count(i.token) as n_tokens,
        coalesce(string_agg(i.token, ' ' order by i.p), '') as part
        from chunks c left join inside i on i.id = c.id and i.chunk_no = c.chunk_no group by all""",
    "token_offsets": f"with {_sql_chunks()} select id, chunk_no, p as pos, s, e from positions",
    "label_align": f"with {_sql_chunks()}, {_LABELS} select id, chunk_no, start_pos, end_pos from labels_at",
    "test_chunks": f"""with {_sql_chunks(64, 16)} select id, chunk_no, q + m + 3 as n_positions, m as n_tokens
        from chunks""",
    "pad_mask": f"""with {_sql_chunks()},
        common as (select token, count(*) as n from offsets group by token),
        vocabulary as (select token, row_number() over (order by n desc, token) + 3 as token_id from common),
        qtok as (select id, unnest({sql_tokens('question')}) as token,
          generate_subscripts({sql_tokens('question')}, 1) as p from qa),
        placed as (select id, chunk_no, p, coalesce(token_id, 1) as tid from inside left join vocabulary using (token)
          union all select c.id, c.chunk_no, t.p, coalesce(token_id, 1) from chunks c join qtok t using (id)
            left join vocabulary using (token)
          union all select id, chunk_no, unnest([0, q + 1, q + m + 2]), unnest([2, 3, 3]) from chunks
          union all select id, chunk_no, unnest(range(q + m + 3, cast(ceil((q + m + 3) / 8) * 8 as bigint))), 0 from chunks)
        select id, chunk_no, string_agg(cast(tid as varchar), ' ' order by p) as input_ids,
          string_agg(case when p < (q + m + 3) then '1' else '0' end, '' order by p) as attention_mask
        from placed join chunks using (id, chunk_no) group by id, chunk_no""",
    "candidate_sets": f"""with {_sql_negatives(31, '5')}
        select qid, cand_no, label, md5(cand_text) as cand_md5 from tagged""",
    "pair_text": f"""with {_sql_negatives(3, '6')}, pair as (
          select qid, cand_no, text || '[SEP]' || cand_text as t
          from tagged join documents on doc_id = qid)
        select qid, cand_no, md5(t) as pair_md5, length(t) as n from pair""",
    "label_pos_hist": f"""with {_sql_chunks()}, {_LABELS}
        select 'token' as metric, bin, count(start_pos) as n from (select unnest(range(-1, 56)) as bin)
          left join labels_at on least(greatest(ceil(start_pos / 10) - 1, -1), 55) = bin group by bin
        union all select 'char', bin, count(answer_start) from (select unnest(range(-1, 151)) as bin)
          left join qa on least(greatest(ceil(answer_start / 10) - 1, -1), 150) = bin group by bin""",
    "span_decode": f"with {_sql_decode()} {_NBEST}",
    "max_context_decode": f"with {_sql_decode(where='and (chunk_no = 0 or p >= q + 2 + ov)')} {_NBEST}",
    "null_decode": f"""with {_sql_decode(n=10, null=True)},
        lows as (select id, min(start_logit + end_logit) as low from logits where p = 0 group by id),
        firsts as (select *, row_number() over (partition by id order by rank) as k from final where text <> ''),
        counts as (select id, count(*) as n_listed from final group by id)
        select c.id, case when low - start_logit - end_logit > -24.0 then '' else coalesce(text, '') end as prediction_text,
          low - start_logit - end_logit as null_odds, n_listed
        from counts c left join lows using (id) left join firsts f on f.id = c.id and k = 1""",
    "empty_fallback": f"""with {_sql_decode(n=2, longest=3)}
        select id, text as prediction_text from final where rank = 1""",
    "nbest_softmax": f"with {_sql_decode()} select id, rank, round(probability, 6) as probability from final",
    "squad_em": f"with {_METRICS} select round(avg(exact_match) * 100, 6) as exact_match from best",
    "squad_f1": f"with {_METRICS} select id, exact_match, round(f1, 6) as f1 from best",
    "reader_loss": f"""with {_sql_decode()}, {_LABELS},
        ce as (select l.id, l.chunk_no,
          ln(sum(exp(start_logit))) - max(start_logit) filter (l.p = a.start_pos) as s,
          ln(sum(exp(end_logit))) - max(end_logit) filter (l.p = a.end_pos) as e
          from logits l join labels_at a using (id, chunk_no) group by 1, 2)
        select round(avg(s), 6) as start_loss, round(avg(e), 6) as end_loss,
          round((avg(s) + avg(e)) / 2, 6) as loss from ce""",
    "open_answers": f"""with {_OPEN_ANSWERS}, listed as (select id, count(*) as n_listed from final group by id)
        select f.id as qid, f.text as prediction_text, n_listed, md5(context) as context_md5
        from final f join listed using (id) join qa using (id) where rank = 1""",
    "open_scores": f"""with {_OPEN_ANSWERS},
        told as (select id, {_norm('text')} as p from final where rank = 1),
        refs as (select id, 1 as ref, {_norm('question')} as r from qa), {_MATCHES}
        select f.id as qid, f.text as prediction_text, exact_match, round(f1, 6) as f1
        from final f join best using (id) where rank = 1""",
    "nbest_scan": f"""with {_sql_decode(MODELS)} select model, cast(model as integer) / 100 as weight, id, rank,
        text, round(probability, 6) as probability from final""",
    "nbest_files": f"""with {_sql_decode(MODELS)} select model, cast(model as integer) / 100 as weight, id, rank,
        text, round(probability, 6) as probability from final""",
    "ensemble_vote": f"""with {_sql_decode(MODELS)}, {_VOTE[0]} select id, text, round(score, 6) as score {_VOTE[1]}""",
    "ensemble_nbest": f"""with {_sql_decode(MODELS)}, {_VOTE_N[0]} select id, rank, text, round(score, 6) as score {_VOTE_N[1]}""",
}
