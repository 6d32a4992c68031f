"""Ranked lexical search of all documents for a set of items, by groups of documents with equal term masks.

1. *Postings.* Each text is cut into terms once; of a document its number of terms and the frequencies of the terms that
   some item asks for are written, so that texts are read once and never shuffled. Document frequencies, the number of
   documents and of their terms are aggregates of that narrow table, over all documents.
2. *Masks.* A task goes through the postings in stretches of documents. For an item it sets one bit per term in the
   bitmaps of the documents that hold it; documents with equal bitmaps are a group. A group's score is at most the sum
   of the largest contributions that its terms make anywhere in the stretch.
3. *Order.* Groups are scored by descending maximum, until as many documents are kept as are asked for and the next
   maximum is below the worst of them. What was kept in earlier stretches of the task counts, so most of a later
   stretch is settled by its maxima alone. An equal maximum is still scored, for its documents may win the tie.

A task returns at most ``top`` documents an item; the best of those are the result. Items are taken in blocks of about
:data:`BLOCK_TERMS` terms, which are sent to all tasks; each block reads the texts once more. Terms are compared by
64-bit hashes.

Defined results: null and empty texts and texts without terms are in no result and not among the documents counted; an
item without terms, or whose terms no document holds, has no rows; repeated rows are documents of their own; documents
with equal scores are ranked by ``doc_id``, null last, and rows equal in both in any order; items with equal ids, or
null ones, are ranked each for itself; other columns are neither read nor returned. A long text is cut whole, by one task.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from codesieve.llm import bytetext
from codesieve.llm.store import Store

#: Terms of items that are sent to the tasks at once.
BLOCK_TERMS = 50_000
#: Documents whose masks are grouped at once.
STRETCH = 16_384
#: Bits of a word of a mask.
BITS = 62
#: Groups of documents that are scored together.
AT_ONCE = 32

#: Bytes of terms: ASCII letters and digits, and all of other code points.
IS_TERM = np.ones(256, bool)
IS_TERM[:128] = [chr(c).isalnum() for c in range(128)]

POSTINGS = "doc_id long, n long, terms array<int>, tfs array<long>"


def _terms(part: bytetext.Slice) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the terms of a slice, and how many come before each document's first and after its last."""
    data = bytetext.LOWER[part.data]
    begin, stop = bytetext.word_bounds(part, IS_TERM[data])
    bounds = np.append(np.searchsorted(begin, part.starts), len(begin))
    return bytetext.to_long(bytetext.word_hashes(data, begin, stop)), bounds


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in bytetext.slices(batch.column("text")):
            hashes, bounds = _terms(part)
            for k in range(len(bounds) - 1):
                term, count = np.unique(hashes[bounds[k] : bounds[k + 1]], return_counts=True)
                item = np.full(len(term), batch.column("item")[part.first + k].as_py(), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(item), pa.array(term), pa.array(count)], ["item", "term", "count"])


def _poster(vocabulary: np.ndarray) -> Callable:
    """Frequencies of the terms in ``vocabulary`` (sorted hashes), by their place in it."""

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in bytetext.slices(batch.column("text")):
                hashes, bounds = _terms(part)
                sizes = np.diff(bounds)
                at = np.searchsorted(vocabulary, hashes)
                known = np.flatnonzero(vocabulary[np.minimum(at, len(vocabulary) - 1)] == hashes) if len(vocabulary) else at[:0]
                document = np.repeat(np.arange(len(sizes)), sizes)[known]
                pair, tf = np.unique(document * max(1, len(vocabulary)) + at[known], return_counts=True)
                document, term = pair // max(1, len(vocabulary)), pair % max(1, len(vocabulary))
                offsets = pa.array(np.searchsorted(document, np.arange(len(sizes) + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(part.first, len(sizes)),
                        pa.array(sizes.astype(np.int64)),
                        pa.ListArray.from_arrays(offsets, pa.array(term.astype(np.int32))),
                        pa.ListArray.from_arrays(offsets, pa.array(tf.astype(np.int64))),
                    ],
                    ["doc_id", "n", "terms", "tfs"],
                )

    return post


class Stretch:
    """The postings of some documents by term: which hold it, and what each occurrence contributes per unit of weight."""

    def __init__(self, table: pa.Table, vocabulary: int, documents: int, terms: int):
        ids = table.column("doc_id").combine_chunks()
        self.unnamed = ids.is_null().to_numpy(zero_copy_only=False)
        self.doc_id = ids.fill_null(0).to_numpy(zero_copy_only=False)
        lists = table.column("terms").combine_chunks()
        sizes = np.diff(lists.offsets.to_numpy())
        term = lists.flatten().to_numpy()
        tf = table.column("tfs").combine_chunks().flatten().to_numpy()
        length = 75 + (25 * table.column("n").to_numpy() * documents) // terms
        holder = np.repeat(np.arange(len(sizes)), sizes)
        order = np.argsort(term, kind="stable")
        self.holder, tf = holder[order], tf[order]
        self.impact = (1_000_000_000 * tf) // (1000 * tf + 12 * length[self.holder])
        self.cuts = np.searchsorted(term[order], np.arange(vocabulary + 1))

    def __len__(self) -> int:
        return len(self.doc_id)

    def postings(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        here = slice(self.cuts[term], self.cuts[term + 1])
        return self.holder[here], self.impact[here]


class Best:
    """The highest-scoring documents of one item so far."""

    def __init__(self, top: int):
        self.top = top
        self.score, self.doc_id, self.unnamed = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def settled(self, most: int) -> bool:
        """Documents with scores of ``most`` at most change nothing."""
        return most <= 0 or len(self.score) == self.top and most < self.score[-1]

    def add(self, score: np.ndarray, doc_id: np.ndarray, unnamed: np.ndarray) -> None:
        able = score > 0
        score = np.concatenate([self.score, score[able]])
        doc_id, unnamed = np.concatenate([self.doc_id, doc_id[able]]), np.concatenate([self.unnamed, unnamed[able]])
        first = np.lexsort((doc_id, unnamed, -score))[: self.top]
        self.score, self.doc_id, self.unnamed = score[first], doc_id[first], unnamed[first]


def _search(stretch: Stretch, terms: np.ndarray, weights: np.ndarray, best: Best) -> int:
    """Let the documents of a stretch into ``best``; returns how many groups were scored."""
    masks = np.zeros((-(-len(terms) // BITS), len(stretch)), np.int64)
    most = np.zeros(len(terms), np.int64)
    lists = [stretch.postings(t) for t in terms.tolist()]
    for bit, (holders, impact) in enumerate(lists):
        masks[bit // BITS, holders] |= 1 << bit % BITS
        most[bit] = impact.max(initial=0) * weights[bit]
    matched = np.flatnonzero(masks.any(axis=0))
    masks = masks[:, matched]
    # Documents with equal masks, one after the other.
    order = np.lexsort(masks)
    masks = masks[:, order]
    starts = np.flatnonzero(np.append(True, (masks[:, 1:] != masks[:, :-1]).any(axis=0)))[: len(matched)]
    ends = np.append(starts[1:], len(matched))
    bounds = np.zeros(len(starts), np.int64)
    for bit, share in enumerate(most.tolist()):
        bounds += share * (masks[bit // BITS, starts] >> bit % BITS & 1)
    scored, falling = 0, np.argsort(-bounds, kind="stable")
    while scored < len(falling) and not best.settled(int(bounds[falling[scored]])):
        # A few groups at once: the calls cost more than the documents.
        groups = falling[scored : scored + AT_ONCE]
        scored += len(groups)
        inside = np.concatenate([np.arange(starts[g], ends[g]) for g in groups.tolist()])
        documents = matched[order[inside]]
        score = np.zeros(len(documents), np.int64)
        for bit, (holders, impact) in enumerate(lists):
            holds = np.flatnonzero(masks[bit // BITS, inside] >> bit % BITS & 1)
            score[holds] += weights[bit] * impact[np.searchsorted(holders, documents[holds])]
        best.add(score, stretch.doc_id[documents], stretch.unnamed[documents])
    return scored


def _searcher(items: list[tuple[int, np.ndarray, np.ndarray]], vocabulary: int, documents: int, terms: int, top: int) -> Callable:
    def stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[Stretch]:
        held, rows = [], 0
        for batch in batches:
            held, rows = [*held, batch], rows + len(batch)
            if rows >= STRETCH:
                yield Stretch(pa.Table.from_batches(held), vocabulary, documents, terms)
                held, rows = [], 0
        if rows:
            yield Stretch(pa.Table.from_batches(held), vocabulary, documents, terms)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = {item: Best(top) for item, _, _ in items}
        for stretch in stretches(batches):
            for item, places, weights in items:
                _search(stretch, places, weights, found[item])
        for item, best in found.items():
            ids = pa.array(best.doc_id, mask=best.unnamed)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), item)), ids, pa.array(best.score)], ["item", "doc_id", "score"])

    return search


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def search(docs: DataFrame, items: DataFrame, top: int = 20, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``top`` rows of ``docs`` (``doc_id, text``) for each row of ``items`` (``item_id, text``).

    Runs jobs when it is called.
    """
    store = Store(docs.sparkSession, "search")
    items = items.select(F.monotonically_increasing_id().alias("item"), "item_id", "text")
    items = store.keep(items, "items")
    asked = items.where("text IS NOT NULL").select("item", "text").mapInArrow(_item_terms, "item long, term long, count long")
    asked = store.keep(asked, "asked")
    blocks = max(1, -(-asked.count() // block_terms))
    docs = docs.where("text IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found, documents, terms = [], None, None
    for block in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block).toArrow()
        item, term, count = (rows.column(c).to_numpy() for c in ("item", "term", "count"))
        vocabulary, place = np.unique(term, return_inverse=True)
        postings = store.keep(docs.mapInArrow(_poster(vocabulary), POSTINGS).where("n > 0"), f"postings{block}")
        if documents is None:
            documents, terms = postings.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        holding = postings.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).toArrow()
        df = np.zeros(len(vocabulary), np.int64)
        df[holding.column("term").to_numpy()] = holding.column("df").to_numpy()
        weights = np.array([weight(documents, d) for d in df.tolist()], np.int64)[place] * count
        order = np.argsort(item, kind="stable")
        own, starts = np.unique(item[order], return_index=True)
        parts = np.split(order, starts[1:])
        able = [(i, place[p], weights[p]) for i, p in zip(own.tolist(), parts)]
        best = postings.mapInArrow(_searcher(able, len(vocabulary), documents, max(1, terms), top), "item long, doc_id long, score long")
        found.append(store.keep(best, f"found{block}"))
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    first = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = every.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= top)
    return ranked.join(items.select("item", "item_id"), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
