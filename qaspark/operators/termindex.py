"""Term index of a corpus and the scoring that the sparse retrievers share.

Layout: one row per document with its distinct terms and counts. Counting happens inside the row,
so building the index needs no shuffle; only the term statistics are aggregated.

Ranking is document-sharded: a document's terms are one row, so a task scores its documents against
a broadcast block of questions, whose size was measured, and keeps the best k per question. What
crosses the network is k rows per question and task, never a posting or a question-document pair.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F

from qaspark.functions.tokens import Scheme, term_counts, tokenize, with_bigrams
from qaspark.plans.bestk import BestK
from qaspark.plans.broadcasts import BLOCK_BYTES, broadcast_if_small, measured_bytes, split_blocks, union_all
from qaspark.plans.order import row_index
from qaspark.plans.topk import topk_per
from qaspark.session import bound_batches, store

_HIT_NAMES = ["qid", "doc_id", "score"]
RANK_DIGITS = 12  # scores are compared to this precision, so ties do not depend on summation order
SCORE_DIGITS = 6  # of the output


def forward_index(
    corpus: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    scheme: Scheme = "space",
    lower: bool = True,
    bigrams: bool = False,
) -> DataFrame:
    """(doc_id, length, terms array<struct<term,tf>>), one row per document."""
    tokens = tokenize(F.col(text), scheme, lower)
    counted = term_counts(with_bigrams(tokens) if bigrams else tokens)
    length = F.aggregate("terms", F.lit(0).cast("long"), lambda total, t: total + t["tf"])
    return corpus.select(F.col(doc_id).alias("doc_id"), counted.alias("terms")).select(
        "doc_id", length.alias("length"), "terms"
    )


def postings(forward: DataFrame) -> DataFrame:
    """(doc_id, length, term, tf), one row per distinct term of a document."""
    return forward.select("doc_id", "length", F.explode("terms").alias("one")).select(
        "doc_id", "length", "one.*"
    )


def question_terms(
    questions: DataFrame,
    qid: str = "qid",
    text: str = "question",
    scheme: Scheme = "space",
    lower: bool = True,
    bigrams: bool = False,
) -> DataFrame:
    """(qid, term, qtf): terms of each question with their number of occurrences."""
    forward = forward_index(questions, qid, text, scheme, lower, bigrams)
    return postings(forward).select(
        F.col("doc_id").alias("qid"), "term", F.col("tf").alias("qtf")
    )


_PAIRS = 1 << 20


def score_pairs(weights: DataFrame, block: DataFrame) -> DataFrame:
    """Sum of products per (qid, doc_id). ``block`` is small enough to broadcast.

    ``weights`` (doc_id, term, weight) has to be spread by doc_id: the sum then needs no exchange.
    """
    product = F.col("weight") * F.col("qweight")
    return (
        weights.join(F.broadcast(block), "term")
        .groupBy("qid", "doc_id")
        .agg(F.round(F.sum(product), RANK_DIGITS).alias("score"))
    )


def score_blocks(
    weighted_questions: DataFrame,
    doc_weights: Callable[[DataFrame], DataFrame],
    documents: int,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """All (qid, doc_id, score) pairs that share a term, by blocks of questions.

    ``doc_weights`` gets the terms of a block, (term, idf) without repeats, broadcast-sized, and
    returns the (doc_id, term, weight) rows for them. A task sums up about ``_PAIRS`` pairs at most, whatever the
    number of ``documents`` and questions.
    """
    least = int(weighted_questions.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = []
    asked = store(weighted_questions, "asked")  # read again for measuring and by every block
    for block in split_blocks(asked, "qid", block_bytes):
        vocabulary = F.broadcast(block.select("term", "idf").distinct())
        pairs = documents * block.agg(F.count_distinct("qid")).first()[0]
        tasks = max(least, -(-pairs // _PAIRS))
        weights = doc_weights(vocabulary).select("doc_id", "term", "weight").repartition(tasks, "doc_id")
        parts.append(score_pairs(weights, block.select("qid", "term", "qweight")))
    return union_all(parts)


def _as_arrays(block: pa.Table) -> tuple[np.ndarray, ...]:
    """A block of questions: their places, where each one's terms begin, term numbers (rare ones first), weights."""
    terms, factors = (block.column(name).combine_chunks() for name in ("numbers", "factors"))
    bounds = np.concatenate(([0], np.cumsum(terms.value_lengths().to_numpy(zero_copy_only=False), dtype=np.int64)))
    places = np.arange(block.num_rows)
    return places, bounds, terms.flatten().to_numpy().astype(np.int64), factors.flatten().to_numpy().astype(np.float64)


_ENTRIES = 1 << 15  # question terms whose bounds are added up at a time
_POSTINGS = 1 << 20  # postings that are read at a time
_TOGETHER = 6 << 20  # postings that are scored together for many questions
_DENSE = 10  # a term in more than one of so many documents of a batch gets a row as long as the batch
_SLACK = 1e-9  # bounds added up in another order differ by less, relative to what is added up
_LOW = (1 << 32) - 1
_NONE = np.empty(0, np.int64)
_UNITS = (1 << 12) - 1  # what the best weight of a batch counts at most, in whole units
_REPEATS = 15  # a term that a question has more often is not counted in units
_FITS = 0.98  # the share of questions whose units, added up, have to fit into 16 bits
_OFTEN = 40  # as _DENSE, for rows of units, which are a quarter as long and cheaper to add up
_ROW_BYTES = 64 << 20  # of the rows of units of a batch


class _Postings:
    """The postings of one batch by term, with the best weight of each term."""

    def __init__(self, size: int, terms: int, of_doc: np.ndarray, term_ids: np.ndarray, weights: np.ndarray):
        keys = term_ids.astype(np.int64) << 32 | of_doc
        order = np.argsort(keys)
        self.size, self.keys, self.weights = size, keys[order], weights[order]
        self.counts = np.bincount(term_ids, minlength=terms)
        self.ends = np.cumsum(self.counts)
        self.tops = np.zeros(terms)
        there = np.flatnonzero(self.counts)
        begin = self.ends[there] - self.counts[there]
        self.tops[there] = np.maximum.reduceat(self.weights, begin)
        # a weight of zero is a match all the same, so such a term has to keep its list
        least = np.minimum.reduceat(self.weights, begin)
        often = (self.counts[there] * _DENSE > size) & (least > 0)
        self.often, self.rows = set(there[often].tolist()), {}
        self.positive, self.units = bool((least > 0).all()), None

    def row(self, term: int) -> np.ndarray | None:
        """Weight by document of a frequent term; None for others, which are cheaper as lists."""
        if term not in self.often:
            return None
        if term not in self.rows:
            docs, weights = self.of(term)
            self.rows[term] = np.zeros(self.size)
            self.rows[term][docs] = weights
        return self.rows[term]

    def of(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        span = slice(self.ends[term] - self.counts[term], self.ends[term])
        return self.keys[span] & _LOW, self.weights[span]

    def of_some(self, term: int, wanted: np.ndarray) -> np.ndarray:
        """The weights of the wanted documents, zero where they do not have the term."""
        if (row := self.row(term)) is not None:
            return row[wanted]
        docs, weights = self.of(term)
        if not len(docs):
            return np.zeros(len(wanted))
        at = np.minimum(np.searchsorted(docs, wanted), len(docs) - 1)
        return np.where(docs[at] == wanted, weights[at], 0.0)

    def look_up(self, terms: np.ndarray, docs: np.ndarray) -> np.ndarray:
        """The weights of pairs of a term and a document, zero where the document does not have it."""
        wanted = terms.astype(np.int64) << 32 | docs
        order = np.argsort(wanted)  # a search in order stays in the cache
        wanted = wanted[order]
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        found = np.empty(len(wanted))
        found[order] = np.where(self.keys[at] == wanted, self.weights[at], 0.0)
        return found


def _aligned(rows: int, size: int) -> np.ndarray:
    """Rows of zeros that begin where a cache line does."""
    width = -(-size // 32) * 32
    room = np.zeros(rows * width + 32, np.uint16)
    skip = -room.ctypes.data % 64 // 2
    return room[skip : skip + rows * width].reshape(rows, width)[:, :size]


class _Units:
    """The postings of a batch in whole units, rounded up, so that sums of 16 bits bound the scores from above."""

    def __init__(self, held: _Postings, asked: tuple[np.ndarray, ...]):
        _, bounds, terms, factors = asked
        whole = np.diff(np.concatenate(([0.0], np.cumsum(factors * held.tops[terms])))[bounds])
        usual = max(float(np.quantile(whole, _FITS)), _SLACK)
        self.per_weight = min(_UNITS / float(held.tops.max()), 0.95 * (1 << 16) / usual)
        units = np.minimum(np.ceil(held.weights * self.per_weight), _UNITS + 1).astype(np.int64)
        self.packed = (held.keys & _LOW) << 16 | units
        self.tops = np.minimum(np.ceil(held.tops * self.per_weight), _UNITS + 1).astype(np.int64)
        self.ends, self.begins = held.ends.tolist(), (held.ends - held.counts).tolist()
        often = np.flatnonzero(held.counts * _OFTEN > held.size)
        often = often[np.isin(often, terms)]
        room = max(_ROW_BYTES // (2 * held.size), 1)
        if len(often) > room:
            often = often[np.argsort(-held.counts[often], kind="stable")[:room]]
        rows = _aligned(len(often), held.size)
        self.rows = dict(zip(often.tolist(), rows))
        for term, row in self.rows.items():
            own = self.packed[self.begins[term] : self.ends[term]]
            row[own >> 16] = own.astype(np.uint16)  # the low bits
        (self.short, self.share), self.long = _aligned(2, held.size), np.empty(held.size, np.uint32)

    def sums(self, terms: list[int], repeats: list[int], most: int) -> np.ndarray:
        """By document, at least the score in units; ``most`` is what they can add up to."""
        sums = self.short if most < 1 << 16 else self.long
        sums.fill(0)
        lists = []
        for term, times in zip(terms, repeats):
            if (row := self.rows.get(term)) is None:
                lists += [self.packed[self.begins[term] : self.ends[term]]] * times
            elif times <= 2:
                for _ in range(times):
                    np.add(sums, row, sums)
            else:
                np.add(sums, np.multiply(row, np.uint16(times), self.share), sums)
        if lists:
            found = np.concatenate(lists)
            np.add.at(sums, found >> 16, (found & 0xFFFF).astype(sums.dtype))
        return sums

    def near(self, sums: np.ndarray, floor: float, slack: float, repeats: int, k: int) -> np.ndarray:
        """The documents that can be among the best ``k`` of a question, by what ``sums`` gave for it."""
        if floor > slack:
            least = max(int(self.per_weight * (floor - slack) * (1 - _SLACK)), 1)
            if sums.max() < least:
                return _NONE
            found = np.flatnonzero(sums >= least)
        else:
            least, found = 1, np.flatnonzero(sums)
        if 0 < k < len(found) // 2:
            # k documents have at least the k-th bound less what rounding added
            kth = int(np.partition(sums[found], len(found) - k)[len(found) - k])
            found = found[sums[found] >= kth - repeats - 1]
        return found


class _Near:
    """Documents that can still get in, put together until their scores are made."""

    def __init__(self, best: BestK, held: _Postings, docs: np.ndarray):
        self.best, self.held, self.docs, self.found, self.size = best, held, docs, [], 0

    def add(self, question: int, found: np.ndarray, terms: np.ndarray, factors: np.ndarray) -> None:
        self.found.append((question, found, terms, factors))
        self.size += len(found) * len(terms)
        if self.size >= _POSTINGS:
            self.settle()

    def settle(self) -> None:
        if not self.found:
            return
        questions, found, terms, factors = zip(*self.found)
        widths = np.array([len(t) for t in terms])
        heights = np.array([len(f) for f in found])
        of_pair = np.repeat(np.repeat(np.arange(len(widths)), heights), np.repeat(widths, heights))
        pair = np.repeat(np.arange(heights.sum()), np.repeat(widths, heights))
        starts = np.repeat(np.cumsum(widths * heights) - widths * heights, widths * heights)
        at = np.cumsum([0, *widths])[of_pair] + (np.arange(len(of_pair)) - starts) % widths[of_pair]
        every = np.concatenate(found)
        weights = self.held.look_up(np.concatenate(terms)[at], every[pair])
        scores = np.bincount(pair, np.concatenate(factors)[at] * weights, len(every))
        ends = np.cumsum(heights)
        for question, begin, end in zip(questions, (ends - heights).tolist(), ends.tolist()):
            cost = -np.round(scores[begin:end], RANK_DIGITS)
            near = cost <= self.best.worst[question]
            if near.any():
                self.best.offer(question, cost[near], self.docs[every[begin:end][near]])
        self.found, self.size = [], 0


def _score_question(
    held: _Postings, terms: list[int], factors: list[float], needed: int, floor: float, slack: float
) -> tuple[np.ndarray, np.ndarray]:
    """(documents, scores) of the batch that reach ``floor``; documents without one of the first ``needed``
    terms cannot. A floor that is not positive keeps every document with a common term."""
    sums, share = np.zeros(held.size), np.empty(held.size)
    met = None if floor > slack else np.zeros(held.size, bool)
    for term, factor in zip(terms[:needed], factors):
        if (row := held.row(term)) is not None:
            sums += np.multiply(row, factor, out=share)
            if met is not None:
                met |= row > 0
        else:
            docs, weights = held.of(term)
            sums[docs] += factor * weights
            if met is not None:
                met[docs] = True
    if met is not None:
        found = np.flatnonzero(met)
        found = found[sums[found] >= floor - slack]
        return found, sums[found]
    later = list(zip(terms[needed:], factors[needed:]))
    rest = sum(max(factor * held.tops[term], 0.0) for term, factor in later)
    found = np.flatnonzero(sums >= floor - rest - slack)
    scores = sums[found]
    for term, factor in later:
        if not len(found):
            break
        scores += factor * held.of_some(term, found)
        rest -= max(factor * held.tops[term], 0.0)
        near = scores >= floor - rest - slack
        found, scores = found[near], scores[near]
    return found, scores


def _score_batch(best: BestK, asked: tuple[np.ndarray, ...], docs, of_doc, term_ids, weights) -> None:
    """Offer the documents of the batch, ``of_doc`` ascending, to the questions they share a term with.

    The k-th best score so far is the floor of a question. With the best weight of each term in the batch, a
    question all of whose terms cannot reach it together costs nothing but its bounds. For whole factors, as term
    counts are, scores are first bounded from above in whole units, for all documents at once, and made for
    the documents whose bound reaches the floor. For others the best weights say which terms cannot reach the
    floor together, so only documents with an earlier, rarer term are scored. Ranking is exact.
    """
    qids, bounds, terms, factors = asked
    if not len(term_ids) or not len(terms):
        return
    held = _Postings(len(docs), max(int(terms.max()), int(term_ids.max())) + 1, of_doc, term_ids, weights)
    units, later = None, _Near(best, held, docs)
    at = 0
    while at < len(qids):
        # whole questions, at least one, up to about _ENTRIES terms
        stop = max(int(np.searchsorted(bounds, bounds[at] + _ENTRIES, "right")) - 1, at + 1)
        own = slice(bounds[at], bounds[stop])
        gains = np.maximum(factors[own] * held.tops[terms[own]], 0.0)
        there = held.counts[terms[own]] > 0
        before = np.concatenate(([0.0], np.cumsum(gains)))
        slack = _SLACK * (1.0 + before[-1])
        question = np.repeat(np.arange(at, stop), np.diff(bounds[at : stop + 1]))
        rest = before[bounds[question + 1] - bounds[at]] - before[:-1]  # of a term and those after it
        floors = -best.worst[at:stop]
        needed = rest >= floors[question - at] - slack
        counted = (factors[own] == np.floor(factors[own])) & (factors[own] >= 1) & (factors[own] <= _REPEATS)
        others = np.bincount((question - at)[there & ~counted], minlength=stop - at)
        some = at + np.flatnonzero(np.bincount((question - at)[needed & there], minlength=stop - at))
        if held.positive and units is None and (others[some - at] == 0).any():
            units = _Units(held, asked)
        kept = np.flatnonzero(there)
        ends = np.searchsorted(kept, bounds[at : stop + 1] - bounds[at])  # of the questions, among the terms of the batch
        numbers, shares = terms[own][kept], factors[own][kept]
        listed, repeats = numbers.tolist(), shares.astype(np.int64).tolist()
        most = None if units is None else np.diff(np.concatenate(([0.0], np.cumsum(shares * units.tops[numbers])))[ends]).tolist()
        cuts, lows = ends.tolist(), floors.tolist()
        for one in some.tolist():
            span = slice(cuts[one - at], cuts[one - at + 1])
            if units is not None and not others[one - at]:
                sums = units.sums(listed[span], repeats[span], most[one - at])
                found = units.near(sums, lows[one - at], slack, sum(repeats[span]), best.k)
                if len(found):
                    later.add(one, found, numbers[span], shares[span])
                continue
            first = int(np.count_nonzero(needed[bounds[one] - bounds[at] : bounds[one + 1] - bounds[at]]))
            first = int(np.searchsorted(kept[span], bounds[one] - bounds[at] + first))
            found, scores = _score_question(held, listed[span], shares[span].tolist(), first, lows[one - at], slack)
            if len(found):
                best.offer(one, -np.round(scores, RANK_DIGITS), docs[found])
        at = stop
    later.settle()


def pieces(batches: Iterator[pa.RecordBatch], column: str, limit: int = _POSTINGS) -> Iterator[pa.RecordBatch]:
    """The rows in order, in pieces with about ``limit`` list entries of ``column``; a longer row is one of its own."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(batch.column(column).value_lengths(), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            before = int(ends[at - 1]) if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(at, stop - at)
            at = stop


class _Gathered:
    """Postings of small batches, put together until they are worth a pass over the questions."""

    def __init__(self, score: Callable[..., None], limit: int = _POSTINGS):
        self.score, self.limit, self.parts, self.rows, self.size = score, limit, [], 0, 0

    def add(self, docs, of_doc, term_ids, weights) -> None:
        self.parts.append((docs, of_doc + self.rows, term_ids, weights))
        self.rows, self.size = self.rows + len(docs), self.size + len(term_ids)
        if self.size >= self.limit or self.rows >= self.limit // 64:
            self.settle()

    def settle(self) -> None:
        if self.parts:
            together = [np.concatenate(one) for one in zip(*self.parts)]
            self.parts, self.rows, self.size = [], 0, 0
            self.score(*together)


_FEW = 8  # questions that take less than this part of a block are few
_SAMPLE = 16  # one of so many documents
_TASK_DOCUMENTS = 1 << 15
Weigh = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], np.ndarray]


def _numbered(words: pa.Array, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The documents with numbers for their words, without those that are not among ``words``."""
    for batch in pieces(batches, "words"):
        lists = batch.column("words")
        number = pc.index_in(lists.flatten(), value_set=words)
        known = number.is_valid().to_numpy(zero_copy_only=False)
        of_doc = np.repeat(np.arange(batch.num_rows), lists.value_lengths().fill_null(0).to_numpy())[known]
        ends = pa.array(np.cumsum(np.concatenate(([0], np.bincount(of_doc, minlength=batch.num_rows)))), pa.int32())
        columns = [batch.column("doc_id"), batch.column("length")]
        columns.append(pa.ListArray.from_arrays(ends, number.drop_null()))
        columns.append(pa.ListArray.from_arrays(ends, batch.column("counts").flatten().filter(pa.array(known))))
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "length", "numbers", "counts"])


def _listed(asked: DataFrame, numbers: DataFrame) -> DataFrame:
    """(qid, numbers, factors): a row for each question, its rarest terms first."""
    rows = asked.join(broadcast_if_small(numbers), "term").select("qid", F.struct("number", "qweight").alias("one"))
    own = rows.groupBy("qid").agg(F.sort_array(F.collect_list("one")).alias("own"))  # the terms of one question
    return own.select("qid", F.col("own.number").alias("numbers"), F.col("own.qweight").alias("factors"))


def _found(
    documents: DataFrame, blocks: list[DataFrame], k: int, weigh: Weigh, words: Broadcast | None, kind: str
) -> DataFrame:
    """(qid, doc_id, score) of the best ``k`` documents of every task for every question.

    With ``words`` the documents come with words, else with numbers. A question's ``floor``, if it has one, is a
    score that its ``k``-th best document reaches: nothing below it is given.
    """
    context = documents.sparkSession.sparkContext
    parts = []
    for block in blocks:
        given = block.toArrow()  # at most a block
        floors = given.column("floor").to_numpy() if "floor" in given.column_names else np.full(given.num_rows, np.nan)
        shared = context.broadcast((given.column("qid").combine_chunks(), _as_arrays(given), np.nan_to_num(-floors, nan=np.inf)))

        def scan(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            qids, asked, worst = shared.value
            best = BestK(len(qids), k, worst)
            limit = _TOGETHER if words is None else _POSTINGS
            gathered = _Gathered(lambda *postings: _score_batch(best, asked, *postings), limit)
            for batch in batches if words is None else _numbered(words.value, batches):
                lists = batch.column("numbers")
                of_doc = np.repeat(np.arange(batch.num_rows, dtype=np.int32), lists.value_lengths().to_numpy())
                ids = lists.flatten().to_numpy()
                counts = batch.column("counts").flatten().to_numpy().astype(np.float64)
                lengths = batch.column("length").to_numpy().astype(np.float64)
                gathered.add(batch.column("doc_id").to_numpy(), of_doc, ids, weigh(ids, counts, of_doc, lengths))
            gathered.settle()
            if len(qids):
                places, *columns = best.columns(asked[0], -1.0)
                columns = [qids.take(pa.array(places)), *map(pa.array, columns)]
                yield pa.RecordBatch.from_arrays(columns, names=_HIT_NAMES)

        parts.append(documents.mapInArrow(scan, f"qid {kind}, doc_id long, score double"))
    return union_all(parts)


def rank_documents(
    forward: DataFrame,
    asked: DataFrame,
    k: int,
    weigh: Callable[[np.ndarray], Weigh],
    vocabulary: DataFrame | None = None,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Best ``k`` documents per question: (qid, doc_id, score, rank).

    ``asked`` is (qid, term, idf, qweight); ``doc_id`` is a whole number. ``vocabulary`` is (term, idf), by
    default the asked terms; the caller vouches for its size. ``weigh(idf)`` gives the
    function from (term numbers, counts, document rows, document lengths) to posting weights.
    """
    bound_batches(forward.sparkSession)
    asked = store(asked, "asked")
    groups = [asked]
    if vocabulary is None:
        terms = store(asked.select("term", "idf").distinct(), "asked-terms")
        if measured_bytes(terms) > block_bytes:  # then each block of questions has its own
            groups = split_blocks(asked, "qid", block_bytes)
    parts = []
    for group in groups:
        known = vocabulary.select("term", "idf") if vocabulary is not None else terms
        if len(groups) > 1:
            known = group.select("term", "idf").distinct()
        parts.append(_ranked(forward, group, k, weigh, known, block_bytes))
    return union_all(parts)


def _ranked(
    forward: DataFrame, asked: DataFrame, k: int, weigh: Callable[[np.ndarray], Weigh], known: DataFrame, block_bytes: int
) -> DataFrame:
    """As ``rank_documents``, with a vocabulary that can be broadcast.

    Few questions meet the documents in one scan. For many, words are looked up once for all blocks of questions,
    and a sample of the documents is searched first: the k-th best score there is a floor for the whole.
    """
    context = forward.sparkSession.sparkContext
    kind = asked.schema["qid"].dataType.simpleString()
    numbers = store(row_index(known, [F.col("idf").desc(), "term"], "number"), "numbers")
    numbers = numbers.select("term", "idf", F.col("number").cast("int").alias("number"))
    held = numbers.toArrow()
    held = held.take(np.argsort(held.column("number").to_numpy()))
    words = context.broadcast(held.column("term").combine_chunks())
    weights = weigh(held.column("idf").to_numpy())
    lists = forward.select(
        F.col("doc_id").cast("long").alias("doc_id"), "length", F.col("terms.term").alias("words"), F.col("terms.tf").alias("counts")
    )
    questions = store(_listed(asked, numbers.select("term", "number")), "questions")
    blocks = split_blocks(questions, "qid", block_bytes)
    if len(blocks) == 1 and measured_bytes(questions) * _FEW <= block_bytes:
        return rank_pairs(_found(lists, blocks, k, weights, words, kind), k)
    schema = f"doc_id long, length {forward.schema['length'].dataType.simpleString()}, numbers array<int>, counts array<int>"
    documents = store(lists.mapInArrow(lambda batches: _numbered(words.value, batches), schema), "documents")
    sample = store(documents.filter(F.pmod(F.xxhash64("doc_id"), F.lit(_SAMPLE)) == 0), "sample")
    # two tasks at least, as Spark puts blocks that have one task each together into one
    cores, tasks = context.defaultParallelism, max(sample.count() // _TASK_DOCUMENTS, 2)
    blocks = split_blocks(questions, "qid", block_bytes, -(-cores // tasks))
    first = topk_per(_found(sample.coalesce(tasks), blocks, k, weights, None, kind), "qid", best_first(), k)
    floors = first.filter(F.col("rank") == k).select("qid", F.col("score").alias("floor"))
    blocks = split_blocks(store(questions.join(floors, "qid", "left"), "questions"), "qid", block_bytes)
    # as many documents to a task as are worth a pass over a block of questions, if there are enough for all cores
    tasks = max(documents.count() // _TASK_DOCUMENTS, -(-cores // len(blocks)), 2)
    return rank_pairs(_found(documents.coalesce(tasks), blocks, k, weights, None, kind), k)


def best_first() -> list[Column]:
    return [F.col("score").desc(), F.col("doc_id")]


def rank_pairs(pairs: DataFrame, k: int) -> DataFrame:
    """(qid, doc_id, score, rank) of the best k documents per question."""
    return topk_per(pairs, "qid", best_first(), k).withColumn("score", F.round("score", SCORE_DIGITS))


def fill_up(hits: DataFrame, questions: DataFrame, corpus: DataFrame, k: int) -> DataFrame:
    """Append documents by id, with score 0, to questions that matched fewer than ``k``.

    The first ``k`` ids always hold enough documents that are not hits already.
    """
    found = hits.groupBy("qid").agg(
        F.count(F.lit(1)).alias("found"), F.collect_set("doc_id").alias("taken")
    )
    spare = corpus.select("doc_id").orderBy("doc_id").limit(k).agg(F.sort_array(F.collect_list("doc_id")).alias("spare"))
    ids = F.lit(list(spare.first()[0])).cast("array<bigint>")  # k ids
    short = (
        questions.select("qid")
        .join(found, "qid", "left")
        .withColumn("found", F.coalesce("found", F.lit(0)))
        .filter(F.col("found") < k)
    )
    taken = F.coalesce("taken", F.array().cast("array<bigint>"))
    extra = F.slice(F.array_except(ids, taken), F.lit(1), F.lit(k) - F.col("found"))
    filled = short.select("qid", "found", F.posexplode(extra).alias("at", "doc_id")).select(
        "qid",
        "doc_id",
        F.lit(0.0).alias("score"),
        (F.col("found") + F.col("at") + 1).cast("int").alias("rank"),
    )
    return hits.select("qid", "doc_id", "score", "rank").unionByName(filled)
