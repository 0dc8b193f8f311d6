"""Ranked lexical search: best-first document intervals under range maxima.

The documents of a task become segments: runs of whole documents, numbered by ascending
doc_id, with a posting list (document numbers, occurrences) for each term. To search a
segment, every posting list of the query gets its impacts and a sparse table over them,
which tells the largest impact between any two places in constant time. The sum of these
maxima, weighted, bounds the score of every document in an interval. The intervals with
the highest bounds go first: each is split at the document that holds its largest
weighted impact; this document is scored from all lists, and both rests get bounds of their
own. Intervals whose bound cannot enter the best k are dropped, so the result is exact.

Terms are compared by 64-bit hashes. Queries go to the segments in blocks of bounded
size; the best of each segment are merged in rounds of bounded groups.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from swishline.llm.tables import SLICE_BYTES, give_back, lookup_side, slices, text_parts
from swishline.llm.words import Words
from swishline.sources.scratch import written

# terms: ASCII digits and letters, and every character beyond ASCII; A-Z count as a-z
_TERM = np.full(256, 32, np.uint8)
_TERM[48:58] = np.arange(48, 58)
_TERM[65:91] = np.arange(97, 123)
_TERM[97:123] = np.arange(97, 123)
_TERM[128:] = np.arange(128, 256)

INDEX = "segment bigint, term bigint, numbers array<int>, counts array<int>, ids array<bigint>"
FOUND = "item_id bigint, doc_id bigint, score bigint, segment bigint"
TABLE_CELLS = 1 << 18  # interval x term cells that are looked at together
AT_ONCE = 64
MOST_TASKS = 1 << 14


@dataclass(frozen=True)
class Ranking:
    """``k`` best documents. ``segment_bytes``: a segment ends at so many bytes of text.
    ``vocabulary``: up to so many different query terms, only their lists are indexed;
    beyond, those of all terms. ``block_terms``: about so many query terms are searched
    for in one pass over the index. ``fan_in``: segments whose answers are merged at once."""

    k: int = 10
    segment_bytes: int = 32 << 20
    vocabulary: int = 1 << 20
    block_terms: int = 1 << 19
    fan_in: int = 1024


def impact(tf: np.ndarray, length: np.ndarray) -> np.ndarray:
    """What an occurrence count weighs in a document of that normalized length."""
    return (1_000_000_000 * tf) // (1000 * tf + 8 * length)


def normalized(n: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """100 for a document of mean length, at least 10; in 64-bit integers, of which the whole
    part of the quotient is taken out first, so that products stay small."""
    whole, rest = divmod(90 * documents, max(terms, 1))
    return 100 - 90 + n * whole + (n * rest) // max(terms, 1)


# ------------------------------------------------------------------------- terms


def _parts(text: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, Words]]:
    """The words of runs of documents, and the number of each run's first document. A
    longer text comes in parts, cut between terms."""
    data, ends = text_parts(text)
    first = 0
    while first < len(ends) - 1:
        last = int(np.searchsorted(ends, ends[first] + limit, "right")) - 1
        if last > first:
            own = ends[first : last + 1]
            yield first, Words(_TERM[data[own[0] : own[-1]]], own - own[0], fold=False)
            first = last
            continue
        low, end = int(ends[first]), int(ends[first + 1])
        while low < end:
            high = min(low + limit, end)
            while high < end and _TERM[data[high]] != 32:
                high += 1
            yield first, Words(_TERM[data[low:high]], np.array([0, high - low]), fold=False)
            low = high
        first += 1


def query_terms(items: DataFrame) -> DataFrame:
    """item_id and each of its distinct terms; rows that share an item_id are one item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, words in _parts(batch["text"]):
                own = batch["item_id"].take(pa.array(first + words.doc))
                yield pa.RecordBatch.from_arrays(
                    [own, pa.array(words.hashes.view(np.int64))], ["item_id", "term"]
                )

    rows = items.select(F.col("item_id").cast("bigint"), "text")
    return rows.mapInArrow(run, "item_id bigint, term bigint").distinct()


# ------------------------------------------------------------------------- index


class _Segment:
    """What is gathered of the documents of a segment until it is written."""

    def __init__(self) -> None:
        self.ids: list[pa.Array] = []
        self.lengths: list[np.ndarray] = []
        self.found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.documents = self.bytes = 0

    def add(self, batch: pa.RecordBatch, vocabulary: np.ndarray | None) -> None:
        lengths = np.zeros(batch.num_rows, np.int64)
        for first, words in _parts(batch["text"]):
            lengths[first : first + len(words.counts)] += words.counts
            hashes, doc = words.hashes, first + words.doc
            if vocabulary is not None:
                at = np.searchsorted(vocabulary, hashes)
                known = vocabulary[np.minimum(at, len(vocabulary) - 1)] == hashes
                hashes, doc = hashes[known], doc[known]
            terms, doc, tf = _summed(hashes, doc, np.ones(len(doc), np.int64), batch.num_rows)
            self.found.append((terms, doc + self.documents, tf))
            self.bytes += int(words.inside.size)
        self.ids.append(batch["doc_id"])
        self.lengths.append(lengths)
        self.documents += batch.num_rows

    def rows(self, number: int) -> Iterator[pa.RecordBatch]:
        """The documents' row, whose term is null, and a row per term, in INDEX's form."""
        ids = pa.concat_arrays(self.ids)
        order = pc.sort_indices(ids, null_placement="at_end").to_numpy()
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        lengths = np.concatenate(self.lengths)[order]
        yield _index_rows(
            number, pa.nulls(1, pa.int64()), pa.nulls(1, pa.list_(pa.int32())),
            _lists(lengths, [0, len(lengths)], pa.int32()),
            pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids.take(pa.array(order))),
        )
        terms, doc, tf = (np.concatenate(x) for x in zip(*self.found, strict=True))
        self.found.clear()
        terms, doc, tf = _summed(terms, place[doc], tf, self.documents)
        starts = np.flatnonzero(np.concatenate([[True], terms[1:] != terms[:-1]]))[: len(terms)]
        cuts = [*range(0, len(starts), 1 << 16), len(starts)]
        for low, high in zip(cuts, cuts[1:], strict=False):
            begin = starts[low]
            end = starts[high] if high < len(starts) else len(terms)
            offsets = np.append(starts[low:high], end) - begin
            yield _index_rows(
                number,
                pa.array(terms[starts[low:high]].view(np.int64)),
                _lists(doc[begin:end], offsets, pa.int32()),
                _lists(tf[begin:end], offsets, pa.int32()),
                pa.nulls(high - low, pa.list_(pa.int64())),
            )


def _summed(
    terms: np.ndarray, doc: np.ndarray, tf: np.ndarray, documents: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Occurrences by term and document, in this order."""
    distinct, number = np.unique(terms, return_inverse=True)
    key = number * documents + doc
    order = np.argsort(key, kind="stable")
    key = key[order]
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))[: len(key)]
    total = np.add.reduceat(tf[order], starts) if len(starts) else tf
    key = key[starts]
    return distinct[key // max(documents, 1)], key % max(documents, 1), total


def _lists(values: np.ndarray, offsets, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def _index_rows(number: int, term, numbers, counts, ids) -> pa.RecordBatch:
    segment = pa.array(np.full(len(term), number, np.int64))
    return pa.RecordBatch.from_arrays(
        [segment, term, numbers, counts, ids], ["segment", "term", "numbers", "counts", "ids"]
    )


def build_index(
    docs: DataFrame, vocabulary: np.ndarray | None = None, segment_bytes: int = 32 << 20
) -> DataFrame:
    """The stored segments of all documents; of every term, or of those in ``vocabulary``
    (sorted hashes) only. Nothing is shuffled: a task indexes the documents it reads."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, own = TaskContext.get().partitionId() << 32, _Segment()
        for batch in slices(batches, "text"):
            own.add(batch, vocabulary)
            if own.bytes >= segment_bytes or own.documents >= 1 << 30:
                yield from own.rows(number)
                number, own = number + 1, _Segment()
        if own.documents:
            yield from own.rows(number)
        give_back()

    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return written(rows.mapInArrow(run, INDEX), "lexical_index")


# ------------------------------------------------------------------------ search


class Lists:
    """Posting lists of one segment, with impacts and sparse tables of their maxima."""

    def __init__(self, terms: np.ndarray, starts: np.ndarray, docs: np.ndarray,
                 impacts: np.ndarray, documents: int):
        """``terms`` ascending; ``starts``: n + 1 offsets into ``docs`` and ``impacts``."""
        self.terms, self.documents, self.impacts = terms, documents, impacts
        self.number = np.repeat(np.arange(len(terms)), np.diff(starts))
        self.docs = docs
        self.keys = self.number * documents + docs
        longest = int(np.diff(starts).max(initial=1))
        levels = [np.arange(len(docs), dtype=np.int32)]
        while 2 << (len(levels) - 1) <= longest:
            half, below = 1 << (len(levels) - 1), levels[-1]
            top = below.copy()
            left, right = below[:-half], below[half:]
            top[:-half] = np.where(impacts[left] >= impacts[right], left, right)
            levels.append(top)
        self.table = np.stack(levels)

    def places(self, lists: np.ndarray, low: np.ndarray) -> np.ndarray:
        """By interval and list: the first posting at or after a document."""
        return np.searchsorted(self.keys, lists[None, :] * self.documents + low[:, None])

    def best(self, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of the largest impact in each range of postings, and that impact (0: none)."""
        size = end - begin
        some = size > 0
        level = np.frexp(np.maximum(size, 1))[1] - 1
        begin = np.where(some, begin, 0)
        left = self.table[level, begin]
        right = self.table[level, np.where(some, end - (1 << level), 0)]
        place = np.where(self.impacts[left] >= self.impacts[right], left, right)
        return place, np.where(some, self.impacts[place], 0)


def best_documents(
    lists: Lists, terms: np.ndarray, weights: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and scores of the k best documents above 0, best first, lower numbers first.

    An interval whose bound equals the k-th score may still hold a better document if it
    begins before the k-th.
    """
    at = np.searchsorted(lists.terms, terms)
    there = at < len(lists.terms)
    there[there] = lists.terms[at[there]] == terms[there]
    own, weights = at[there], weights[there].astype(np.int64)
    docs, scores = np.empty(0, np.int64), np.empty(0, np.int64)
    if not len(own):
        return docs, scores
    step = max(1, min(AT_ONCE, TABLE_CELLS // len(own)))
    low, high = np.zeros(1, np.int64), np.array([lists.documents], np.int64)
    bound = np.full(1, np.iinfo(np.int64).max)
    while len(low):
        if len(scores) == k:
            least, last = scores[-1], docs[-1]
            keep = (bound > least) | ((bound == least) & (low < last))
            low, high, bound = low[keep], high[keep], bound[keep]
            if not len(low):
                break
        if len(bound) > step:
            order = np.argpartition(-bound, step)
            now, later = order[:step], order[step:]
        else:
            now, later = np.arange(len(bound)), np.empty(0, np.int64)
        lo, hi = low[now], high[now]
        begin, end = lists.places(own, lo), lists.places(own, hi)
        place, most = lists.best(begin, end)
        value = most * weights
        total = value.sum(axis=1)
        some = total > 0
        lo, hi, begin, end = lo[some], hi[some], begin[some], end[some]
        place, value = place[some], value[some]
        top = value.argmax(axis=1)
        split = lists.docs[place[np.arange(len(top)), top]].astype(np.int64)
        # the split documents are scored from all lists of the query
        key = own[None, :] * lists.documents + split[:, None]
        cut = np.searchsorted(lists.keys, key)
        holds = lists.keys[np.minimum(cut, len(lists.keys) - 1)] == key
        exact = (lists.impacts[np.where(holds, cut, 0)] * holds * weights).sum(axis=1)
        docs, scores = np.concatenate([docs, split]), np.concatenate([scores, exact])
        first = np.lexsort((docs, -scores))[:k]
        docs, scores = docs[first], scores[first]
        # both rests of the intervals, bounded by the maxima of their postings
        left = (lists.best(begin, cut)[1] * weights).sum(axis=1)
        right = (lists.best(cut + holds, end)[1] * weights).sum(axis=1)
        low = np.concatenate([low[later], lo, split + 1])
        high = np.concatenate([high[later], split, hi])
        bound = np.concatenate([bound[later], left, right])
        full = bound > 0
        low, high, bound = low[full], high[full], bound[full]
    return docs, scores


def _answers(table: pa.Table, queries: list, documents: int, terms: int, k: int) -> pa.Table:
    """The best documents of a segment for every query of a block."""
    table = table.combine_chunks()
    of_documents = pc.is_null(table["term"])
    own = table.filter(of_documents)
    lists = table.filter(pc.invert(of_documents)).sort_by("term").combine_chunks()
    segment = own["segment"][0].as_py()
    ids = own["ids"].combine_chunks().flatten()
    length = normalized(
        own["counts"].combine_chunks().flatten().to_numpy().astype(np.int64), documents, terms
    )
    items, numbers, scores = [], [], []
    if lists.num_rows:
        # by the hashes' unsigned order, in which queries are looked up
        hashes = lists["term"].to_numpy().view(np.uint64)
        order = np.argsort(hashes)
        lists = lists.take(pa.array(order)).combine_chunks()
        docs = lists["numbers"].combine_chunks()
        sizes = pc.list_value_length(docs).to_numpy().astype(np.int64)
        docs = docs.flatten().to_numpy().astype(np.int64)
        tf = lists["counts"].combine_chunks().flatten().to_numpy().astype(np.int64)
        found = Lists(
            hashes[order], np.concatenate([[0], np.cumsum(sizes)]), docs,
            impact(tf, length[docs]), len(length),
        )
        for item, own_terms, weights in queries:
            best, value = best_documents(found, own_terms, weights, k)
            items += [item] * len(best)
            numbers.append(best)
            scores.append(value)
    numbers = np.concatenate([*numbers, np.empty(0, np.int64)]).astype(np.int64)
    scores = np.concatenate([*scores, np.empty(0, np.int64)]).astype(np.int64)
    give_back()
    return pa.table(
        {
            "item_id": pa.array(items, pa.int64()),
            "doc_id": ids.take(pa.array(numbers)),
            "score": pa.array(scores),
            "segment": pa.array(np.full(len(numbers), segment, np.int64)),
        }
    )


def _searcher(block: Broadcast, documents: int, terms: int, k: int) -> Callable:
    def run(table: pa.Table) -> pa.Table:
        return _answers(table, block.value, documents, terms, k)

    return run


def _blocks(weighted: DataFrame, size: int) -> Iterator[list]:
    """The queries, in blocks of about ``size`` terms: item_id, sorted terms, their weights."""
    count = max(1, -(-weighted.count() // size))
    block = F.pmod(F.xxhash64("item_id"), F.lit(count))
    for number in range(count):
        rows = weighted.where(block == number).toArrow()
        if not rows.num_rows:
            continue
        item = rows["item_id"].fill_null(np.iinfo(np.int64).min).to_numpy()
        term = rows["term"].to_numpy().view(np.uint64)
        order = np.lexsort((term, item))
        item, term, weight = item[order], term[order], rows["weight"].to_numpy()[order]
        cuts = np.flatnonzero(np.concatenate([[True], item[1:] != item[:-1], [True]]))
        names = rows["item_id"].take(pa.array(order)).to_pylist()
        yield [
            (names[low], term[low:high], weight[low:high])
            for low, high in zip(cuts, cuts[1:], strict=False)
        ]


def search(docs: DataFrame, items: DataFrame, r: Ranking = Ranking()) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the ``r.k`` best documents of every item.

    Rows of ``items`` that share an item_id (null is one too) are one item; an item
    without a term that any document holds has no rows. Every row of ``docs`` is a
    document, repeated ones too; null texts hold no terms. Equal scores go by ascending
    doc_id, null last. Other columns take no part.
    """
    spark = docs.sparkSession
    asked = written(query_terms(items), "lexical_queries")
    distinct = asked.select("term").distinct()
    vocabulary = None
    if distinct.count() <= r.vocabulary:
        vocabulary = np.sort(distinct.toArrow()["term"].to_numpy().view(np.uint64))
        if not len(vocabulary):
            return spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    index = build_index(docs, vocabulary, r.segment_bytes)
    of_documents = index.where("term IS NULL")
    size = F.aggregate("counts", F.lit(0).cast("bigint"), lambda a, x: a + x)
    totals = of_documents.agg(
        F.sum(F.size(F.filter("counts", lambda x: x > 0))).alias("documents"),
        F.sum(size).alias("terms"),
        F.count(F.lit(1)).alias("segments"),
        F.max("segment").alias("last"),
    ).first()
    documents, terms = totals["documents"] or 0, totals["terms"] or 0
    lists = index.where("term IS NOT NULL")
    if vocabulary is None:
        lists = lists.join(lookup_side(written(distinct, "lexical_terms")), "term", "left_semi")
    df = lists.groupBy("term").agg(F.sum(F.size("numbers")).alias("df"))
    weight = F.floor(1000 * F.log(F.lit(2.0 * documents + 2) / (2 * F.col("df") + 1)))
    weighted = written(asked.join(df, "term").select("item_id", "term", weight.alias("weight")),
                       "lexical_weights")
    rows = of_documents.unionByName(lists.select(*of_documents.columns))
    rows = rows.repartition(min(max(1, totals["segments"]), MOST_TASKS), "segment")
    found = []
    for block in _blocks(weighted, r.block_terms):
        answers = _searcher(spark.sparkContext.broadcast(block), documents, terms, r.k)
        found.append(written(rows.groupBy("segment").applyInArrow(answers, FOUND), "lexical_found"))
    if not found:
        return spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    best = found[0]
    for more in found[1:]:
        best = best.unionByName(more)
    return _merged(best, totals["segments"], r)


def _merged(found: DataFrame, segments: int, r: Ranking) -> DataFrame:
    """The best of all segments, in rounds that merge ``fan_in`` segments' answers a group."""
    rank = F.row_number()
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    groups = segments
    while groups > r.fan_in:
        groups = -(-groups // r.fan_in)
        found = found.withColumn("segment", F.pmod(F.xxhash64("segment"), F.lit(groups)))
        own = rank.over(Window.partitionBy("item_id", "segment").orderBy(*order))
        found = found.withColumn("rank", own).where(F.col("rank") <= r.k).drop("rank")
    own = rank.over(Window.partitionBy("item_id").orderBy(*order))
    found = found.withColumn("rank", own).where(F.col("rank") <= r.k)
    return found.select("item_id", "rank", "doc_id", "score")


#: The same ranking from the two tables alone, for DuckDB.
ORACLE = r"""
WITH said AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), lengths AS (
  SELECT row, doc_id, len(terms) AS n FROM said WHERE len(terms) > 0
), totals AS (
  SELECT count(*) AS documents, CAST(sum(n) AS BIGINT) AS terms FROM lengths
), postings AS (
  SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(terms) AS term FROM said) GROUP BY ALL
), asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * documents + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))
    AS BIGINT) AS w
  FROM postings, totals WHERE term IN (SELECT term FROM asked) GROUP BY term, documents
), scored AS (
  SELECT item_id, row, doc_id, CAST(sum(
    w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * documents) // terms))))
    AS BIGINT) AS score
  FROM asked JOIN weights USING (term) JOIN postings USING (term) JOIN lengths USING (row), totals
  GROUP BY ALL
), ranked AS (
  SELECT *, CAST(row_number() OVER (
    PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank
  FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
