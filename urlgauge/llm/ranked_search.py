"""Ranked lexical search by NRA: sorted reads only, score intervals, no random access.

Terms are runs of ASCII letters and digits and of all characters beyond ASCII, with only A-Z lower-cased. A term's impact on a
document is an integer of its weight (from its document frequency), its occurrences and the document's length,
as stated at `impacts`; a document's score is the sum of its impacts over the item's distinct terms.

1. Items are taken in blocks of about `ITEM_BYTES` of text, so that a block's terms fit in every task whatever the
   number of items. One pass over the documents counts terms, documents and document frequencies.
2. A second pass cuts every task's documents into bounded blocks and sorts each term's list of a block by
   impact, highest first. For each item, `nra` reads its terms' lists from the top, all to the same depth, which doubles every
   round. A document's lower bound is the sum of the impacts read, its upper bound adds, for each list it wasn't seen in,
   the last impact read there (0 once a list is at its end). Reading goes on until every document whose upper bound
   reaches the k-th lower bound has equal bounds: then membership, ties and scores are final. The k-th best score of
   earlier blocks is a floor for later ones, so most blocks end after a few rounds.
3. The tasks' best rows, at most k for each item, are ranked. No text, list or posting is shuffled.

Lost executors only repeat their tasks: both passes are narrow. Terms are compared by 64-bit hashes.

Defined cases: null and empty texts hold no term; such documents don't count in N and are never found. Items without terms give
no rows. Every row of `docs` is a document and every row of `items` an item, repeats too; equal scores go by
ascending doc_id, null last. Terms of weight 0 add nothing. Empty tables give no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import floor, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import LOWER, Hasher, chunks, ship, text_buffer, word_spans, written

ITEM_BYTES = 4 << 20    # text of the items searched in one pass
BLOCK_DOCS = 1 << 14    # a block of documents is closed beyond this many rows
BLOCK_POSTINGS = 1 << 21
DEPTH = 256             # entries read from each list in the first round

IS_TERM = np.zeros(256, bool)
IS_TERM[0x30:0x3A] = IS_TERM[0x41:0x5B] = IS_TERM[0x61:0x7B] = IS_TERM[0x80:] = True


def _hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of every term."""
    data, at = text_buffer(texts)
    data = LOWER[data]
    starts, ends, rows = word_spans(data, at, IS_TERM)
    return rows, Hasher(data)(starts, ends)


def _postings(texts: pa.Array, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Terms of every row, and (row, place in `terms`, occurrences) of those that `terms` (sorted hashes) has."""
    rows, hashes = _hashes(texts)
    lengths = np.bincount(rows, minlength=len(texts)).astype(np.int64)
    place = np.minimum(np.searchsorted(terms, hashes), len(terms) - 1)
    hit = terms[place] == hashes
    pairs, occurrences = np.unique(rows[hit] * len(terms) + place[hit], return_counts=True)
    return lengths, pairs // len(terms), pairs % len(terms), occurrences.astype(np.int64)


def impacts(weight, occurrences, length, documents: int, total: int):
    """weight * ((10^9 * tf) div (1000 * tf + 20 * m)), m = 50 + (50 * n * N) div L, in 64-bit integers."""
    m = 50 + 50 * length * documents // total
    return weight * (1_000_000_000 * occurrences // (1000 * occurrences + 20 * m))


def nra(lists: list[tuple[np.ndarray, np.ndarray]], documents: int, k: int, least: int = 1):
    """Documents (numbers below `documents`) that rank among the best k and reach `least`, ties included, with scores.

    `lists` are (documents, impacts), impacts positive and descending; a document is in a list once."""
    low, at, depth = np.zeros(documents, np.int64), [0] * len(lists), DEPTH
    while True:
        ahead = [0] * len(lists)
        for i, (docs, impact) in enumerate(lists):
            end = min(at[i] + depth, len(docs))
            low[docs[at[i]:end]] += impact[at[i]:end]
            at[i], ahead[i] = end, int(impact[end - 1]) if end < len(docs) else 0
        high = low + sum(ahead)
        for (docs, _), end, bound in zip(lists, at, ahead):
            if bound:
                high[docs[:end]] -= bound
        if documents >= k:
            least = max(least, int(np.partition(low, documents - k)[documents - k]))
        if not ((high >= least) & (high > low)).any():
            found = np.flatnonzero(low >= least)
            return found, low[found]
        depth *= 2


class _Block:
    """Postings of some documents."""

    def __init__(self):
        self.ids, self.null, self.parts, self.rows, self.postings = [], [], [], 0, 0

    def add(self, ids: pa.Array, lengths, rows, places, occurrences) -> None:
        self.ids.append(ids.fill_null(0).to_numpy(zero_copy_only=False))
        self.null.append(ids.is_null().to_numpy(zero_copy_only=False))
        self.parts.append((rows + self.rows, places, occurrences, lengths[rows]))
        self.rows, self.postings = self.rows + len(ids), self.postings + len(rows)

    def lists(self, weights: np.ndarray, documents: int, total: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        """Every term's (documents, impacts), highest impact first; terms of weight 0 are left out."""
        docs, places, occurrences, lengths = (np.concatenate(p) for p in zip(*self.parts))
        impact = impacts(weights[places], occurrences, lengths, documents, total)
        order = np.lexsort((docs, -impact, places))
        order = order[impact[order] > 0]
        docs, places, impact = docs[order], places[order], impact[order]
        starts = np.flatnonzero(np.r_[True, places[1:] != places[:-1]]) if len(places) else np.zeros(0, np.int64)
        ends = np.r_[starts[1:], len(places)]
        return {int(places[s]): (docs[s:e], impact[s:e]) for s, e in zip(starts, ends)}


class _Best:
    """The best k (score, id) of an item so far, in ranking order."""

    def __init__(self, k: int):
        self.k, self.rows = k, (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool))

    def least(self) -> int:
        return int(self.rows[0][-1]) if len(self.rows[0]) == self.k else 1

    def add(self, score, ids, null) -> None:
        score, ids, null = (np.concatenate(p) for p in zip(self.rows, (score, ids, null)))
        order = np.lexsort((ids, null, -score))[:self.k]
        self.rows = score[order], ids[order], null[order]


def _counter(terms: np.ndarray):
    """Per task: documents with each term; in row -1 the documents with any term, and all terms."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, documents, total = np.zeros(len(terms), np.int64), 0, 0
        for batch in batches:
            for texts in chunks(batch.column(0)):
                lengths, _, places, _ = _postings(texts, terms)
                found += np.bincount(places, minlength=len(terms))
                documents, total = documents + int((lengths > 0).sum()), total + int(lengths.sum())
        some = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.r_[-1, some]), pa.array(np.r_[documents, found[some]]), pa.array(np.r_[total, 0 * some])],
            ["term", "documents", "total"])

    return count


def _searcher(items: dict[int, np.ndarray], terms: np.ndarray, weights: np.ndarray, documents: int, total: int, k: int):
    """Per task: the best k documents of every item."""
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {item: _Best(k) for item in items}

        def close(block: _Block) -> None:
            lists = block.lists(weights, documents, total)
            ids, null = np.concatenate(block.ids), np.concatenate(block.null)
            for item, places in items.items():
                own = [lists[p] for p in places.tolist() if p in lists]
                if own:
                    found, score = nra(own, block.rows, k, best[item].least())
                    best[item].add(score, ids[found], null[found])

        block = _Block()
        for batch in batches:
            start = 0
            for texts in chunks(batch.column(1)):
                block.add(batch.column(0).slice(start, len(texts)), *_postings(texts, terms))
                start += len(texts)
                if block.rows >= BLOCK_DOCS or block.postings >= BLOCK_POSTINGS:
                    close(block)
                    block = _Block()
        if block.rows:
            close(block)
        for item, b in best.items():
            score, ids, null = b.rows
            if len(score):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(score), item, np.int64)), pa.array(ids, pa.int64(), mask=null), pa.array(score)],
                    ["item", "doc_id", "score"])

    return search


def _block_of_items(rows: list, numbers: str = "item") -> tuple[dict[int, np.ndarray], np.ndarray]:
    """Places of every item's distinct terms in the block's sorted hashes."""
    at, hashes = _hashes(pa.array([r["text"] for r in rows], pa.large_string()))
    terms, place = np.unique(hashes, return_inverse=True)
    own = {r[numbers]: np.unique(place[at == i]) for i, r in enumerate(rows)}
    return {item: places for item, places in own.items() if len(places)}, terms


def search(docs: DataFrame, items: DataFrame, k: int = 50) -> DataFrame:
    """The `k` highest-scoring documents above 0 of every item: item_id, rank, doc_id, score."""
    spark = docs.sparkSession
    ship(spark)
    items = written(items.select("item_id", "text").withColumn("item", F.monotonically_increasing_id()), "search-items")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks, ranked = max(1, -(-size // ITEM_BYTES)), None
    for number in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == number).select("item", "text").collect()
        own, terms = _block_of_items(rows)
        if not own:
            continue
        counts = {r["term"]: r for r in docs.select("text").mapInArrow(
            _counter(terms), "term long, documents long, total long").groupBy("term").agg(
            F.sum("documents").alias("documents"), F.sum("total").alias("total")).collect()}
        if not counts or not counts[-1]["total"]:
            break
        documents, total = counts[-1]["documents"], counts[-1]["total"]
        found = np.array([counts[t]["documents"] if t in counts else 0 for t in range(len(terms))], np.int64)
        weights = np.array([floor(1000 * log((2 * documents + 2) / (2 * df + 1))) for df in found.tolist()], np.int64)
        best = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
            _searcher(own, terms, weights, documents, total, k), "item long, doc_id long, score long")
        order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
        best = written(best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k), "search-best")
        ranked = best if ranked is None else ranked.unionByName(best)
    if ranked is None:
        return items.select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"),
                            F.lit(0).cast("long").alias("score")).limit(0)
    return ranked.join(items.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
