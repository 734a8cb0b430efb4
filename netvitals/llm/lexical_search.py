"""Ranked lexical search by the Best Position Algorithm.

A query is a set of terms. A document's score is the sum, over the query's terms it holds, of an
impact that depends on the term and the document alone, so every term has one impact list (its
documents by falling impact) that all queries share.

1. One pass over the texts keeps, for each document, its length and its counts of query terms.
2. Document frequencies, the number of documents and of all their terms are grouped sums.
3. Documents are taken in blocks, whose impact lists fit in memory. For each query the lists of
   its terms are read side by side, a few positions deeper each round. A document met in one list
   is looked up in all others (direct access), which gives its whole score and marks its position
   as seen in each list. A list's best position is the last one before which all are seen; the sum
   of the impacts there bounds the score of every document not yet seen, and it falls faster than
   that of the last positions read. The query ends once this bound is strictly below the k-th
   score found so far in the task, over all its blocks; documents of equal score are never lost.
4. The k best of each task are ranked per query, first within parts, so that no task sorts more
   rows of a query than parts and tasks need.

A term is a maximal run of letters and digits of ASCII and any characters beyond it, only A-Z
lower-cased. Queries are sent to the executors in slices of bounded size; a larger query table
takes one pass over the texts for each slice.

Defined results: a null or empty text has no terms and is in no result; a query without terms, or
whose terms no document holds, gives no rows; repeated queries and repeated documents each count
as their own; documents without an id come last among equal scores; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import floor, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from netvitals.llm.words import TERM_BREAKS, pieces, spans, utf8, word_hashes
from netvitals.plans.shared import settle

BEST = 50
#: Bytes of query texts in a slice, about: their distinct terms are broadcast.
SLICE_BYTES = 1 << 18
#: Entries of a block's table of positions (documents times terms), 4 bytes each.
BLOCK_ENTRIES = 1 << 24
PARTS = 64
_LAST = np.iinfo(np.int64).max


def terms_of(column) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first): the terms of each text, in order."""
    data, offsets = utf8(column)
    start, end, first = spans(data, offsets, TERM_BREAKS)
    return word_hashes(data, start, end), first


def _slices(items: DataFrame, item: str, text: str) -> Iterator[tuple[list, pa.Array]]:
    """Ids and texts of the queries, some of them at a time; each slice's size is bounded, as long
    as single texts are."""
    given = items.select(F.col(item).alias("item"), F.col(text).cast("string").alias("text"))
    size = given.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-size // SLICE_BYTES)
    part = F.pmod(F.xxhash64("item", "text"), F.lit(max(n, 1)))
    for i in range(n):
        rows = given.filter(part == i).toArrow()
        yield rows.column("item").to_pylist(), rows.column("text").combine_chunks()


def _counted(batches: Iterator[pa.RecordBatch], vocabulary: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(doc_id, n, terms, counts) of every text with a term; terms are places in the sorted
    vocabulary."""
    for batch in batches:
        for low, high, data, offsets in pieces(batch.column("text")):
            start, end, first = spans(data, offsets, TERM_BREAKS)
            hashes = word_hashes(data, start, end)
            text = np.repeat(np.arange(high - low), np.diff(first))
            at = np.searchsorted(vocabulary, hashes)
            known = vocabulary[np.minimum(at, len(vocabulary) - 1)] == hashes
            key, count = np.unique(text[known] * len(vocabulary) + at[known], return_counts=True)
            owner = key // len(vocabulary)
            full = np.flatnonzero(np.diff(first))
            edges = np.searchsorted(owner, np.append(full, high - low)).astype(np.int32)

            def lists(values):
                return pa.ListArray.from_arrays(pa.array(edges), pa.array(values.astype(np.int32)))

            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(low, high - low).take(pa.array(full)),
                    pa.array(np.diff(first)[full]),
                    lists(key % len(vocabulary)),
                    lists(count),
                ],
                names=["doc_id", "n", "terms", "counts"],
            )


def impacts(weights: np.ndarray, terms: np.ndarray, counts: np.ndarray, n: np.ndarray, docs: int, total: int):
    """The impact of each posting: the term's weight times its saturated frequency, which a long
    document reaches later. Whole numbers."""
    m = 50 + (50 * n * docs) // total
    tf = counts.astype(np.int64)
    return weights[terms] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))


class ImpactLists:
    """The impact lists of a block of documents: by term, falling impact; and the position of
    every document in every list, for direct access."""

    def __init__(self, doc: np.ndarray, terms: np.ndarray, impact: np.ndarray, n_docs: int, n_terms: int):
        order = np.lexsort((doc, -impact, terms))
        self.doc, self.impact = doc[order], impact[order]
        self.first = np.searchsorted(terms[order], np.arange(n_terms + 1))
        self.length = np.diff(self.first)
        self.position = np.full((n_terms, n_docs), -1, np.int32)
        self.position[terms[order], self.doc] = np.arange(len(order)) - np.repeat(self.first[:-1], self.length)

    def best(self, terms: np.ndarray, k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores): all that can be among the ``k`` best of the query, scores of at
        least ``least`` and above 0, by the Best Position Algorithm."""
        terms = terms[self.length[terms] > 0]
        first, length = self.first[terms], self.length[terms]
        seen = [np.zeros(n + 1, bool) for n in length.tolist()]
        best = np.zeros(len(terms), np.int64)  # positions before this one are all seen
        scores = np.zeros(self.position.shape[1], np.int64)
        met = np.zeros(self.position.shape[1], bool)
        read, step = 0, 4
        kth = least
        while True:
            # sorted access: the next positions of every list
            fresh = [self.doc[a + read : a + min(read + step, n)] for a, n in zip(first, length) if read < n]
            docs = np.unique(np.concatenate(fresh)) if fresh else np.zeros(0, np.int64)
            docs = docs[~met[docs]]
            met[docs] = True
            read += step
            step *= 2
            # direct access: these documents' places and impacts in all lists
            bound = 0
            for i, term in enumerate(terms.tolist()):
                at = self.position[term, docs]
                has = at >= 0
                at = at[has]
                scores[docs[has]] += self.impact[first[i] + at]
                seen[i][at] = True
                best[i] += np.argmin(seen[i][best[i] :])
                if best[i] < length[i]:
                    bound += int(self.impact[first[i] + max(best[i] - 1, 0)])
            reached = scores[met]
            if len(reached) >= k:
                kth = max(kth, int(np.partition(reached, len(reached) - k)[len(reached) - k]))
            if bound < kth or bound == 0:
                found = np.flatnonzero(met & (scores >= max(kth, 1)))
                return found, scores[found]


def _ranked(
    batches: Iterator[pa.RecordBatch], queries: list[np.ndarray], weights: np.ndarray, docs: int, total: int, k: int
) -> Iterator[pa.RecordBatch]:
    """The k best documents of this task for each query: (query, doc_id, score)."""
    rows = max(64, BLOCK_ENTRIES // len(weights))
    nothing = np.zeros(0, np.int64)
    held = [(nothing, nothing) for _ in queries]  # scores and ids
    for batch in batches:
        ids = batch.column("doc_id")
        ids = np.where(ids.is_null(), _LAST, ids.fill_null(0).to_numpy(zero_copy_only=False))
        n = batch.column("n").to_numpy()
        terms, counts = batch.column("terms"), batch.column("counts")
        edges = np.asarray(terms.offsets)
        terms, counts = np.asarray(terms.values), np.asarray(counts.values)
        for low in range(0, len(ids), rows):
            high = min(low + rows, len(ids))
            own = slice(edges[low], edges[high])
            doc = np.repeat(np.arange(high - low), np.diff(edges[low : high + 1]))
            impact = impacts(weights, terms[own], counts[own], n[low:high][doc], docs, total)
            some = impact > 0
            lists = ImpactLists(doc[some], terms[own][some], impact[some], high - low, len(weights))
            for q, query in enumerate(queries):
                scores, best = held[q]
                least = int(scores[-1]) if len(scores) == k else 1
                found, score = lists.best(query, k, least)
                if len(found):
                    scores, best = np.concatenate([scores, score]), np.concatenate([best, ids[low:high][found]])
                    order = np.lexsort((best, -scores))[:k]
                    held[q] = scores[order], best[order]
    score = np.concatenate([s for s, _ in held])
    doc_id = np.concatenate([d for _, d in held])
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(np.repeat(np.arange(len(held)), [len(s) for s, _ in held])),
            pa.array(doc_id, pa.int64(), mask=doc_id == _LAST),
            pa.array(score),
        ],
        names=["query", "doc_id", "score"],
    )


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = BEST,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of each item with a score above
    0, equal scores by rising id. ``doc_id`` is a whole number."""
    spark = docs.sparkSession
    given = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    kind = items.schema[item_id].dataType
    out = None
    for ids, texts in _slices(items, item_id, item_text):
        hashes, first = terms_of(texts)
        vocabulary = np.unique(hashes)
        if not len(vocabulary):
            continue
        queries = [np.unique(np.searchsorted(vocabulary, hashes[a:b])) for a, b in zip(first, first[1:])]
        postings = settle(
            given.mapInArrow(
                lambda batches, vocabulary=vocabulary: _counted(batches, vocabulary),
                "doc_id bigint, n bigint, terms array<int>, counts array<int>",
            ),
            "postings",
        )
        # a row for each query term at most
        holding = postings.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
        holding = holding.toArrow()
        n_docs, total = postings.agg(F.count(F.lit(1)), F.sum("n")).first()
        weights = np.zeros(len(vocabulary), np.int64)
        for term, df in zip(holding.column("term").to_pylist(), holding.column("df").to_pylist()):
            weights[term] = floor(1000 * log((2 * n_docs + 2) / (2 * df + 1)))
        best = postings.mapInArrow(
            lambda batches, queries=queries, weights=weights, n_docs=n_docs, total=total: _ranked(
                batches, queries, weights, n_docs, total, k
            ),
            "query bigint, doc_id bigint, score bigint",
        )
        falling = [F.desc("score"), F.asc_nulls_last("doc_id")]
        part = F.pmod(F.xxhash64("doc_id", "score"), F.lit(PARTS))
        place = F.row_number().over(Window.partitionBy("query", part).orderBy(*falling))
        best = best.withColumn("_place", place).filter(F.col("_place") <= k)
        rank = F.row_number().over(Window.partitionBy("query").orderBy(*falling))
        best = best.withColumn("rank", rank).filter(F.col("rank") <= k)
        names = spark.createDataFrame(list(enumerate(ids)), f"query bigint, item_id {kind.simpleString()}")
        ranked = best.join(names, "query").select("item_id", "rank", "doc_id", "score")
        out = ranked if out is None else out.unionByName(ranked)
    if out is None:
        none = F.lit(None)
        return items.limit(0).select(
            F.col(item_id).alias("item_id"),
            none.cast("int").alias("rank"),
            none.cast("bigint").alias("doc_id"),
            none.cast("bigint").alias("score"),
        )
    return out
