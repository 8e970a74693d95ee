"""Ranked lexical search by presence masks.

Every item asks for the documents that score best on its terms. A document's postings hold only terms
that some item asks for. In a block of documents, an item's terms become the bits of a mask per
document; bitwise operations group the documents by their masks. All documents of a group hold the
same terms of the item, so the sum of these terms' weights times their greatest impact in the block
bounds their scores. Groups are evaluated by descending bound, and the block is finished when the
next bound is below the item's k-th score so far, which a task carries from block to block. A bound
equal to that score is still evaluated, as ties go to the smaller id. Scores are exact integers.

Documents never move: one pass turns texts into postings, one reads these and returns at most ``k``
documents an item and task, which are ranked at last. Items go in blocks of ``ITEM_CHARACTERS``, each
against all documents, and only a block's terms are sent to the executors.

A null or empty text has no terms; an item without a term, or whose terms weigh nothing, has no rows.
Rows are documents and items of their own, also if ids repeat: a repeated document is ranked as often
as it comes, a repeated item repeats its rows. Documents without an id come last among equal scores.
Ids of documents are integers. Other columns are not read.
"""

from __future__ import annotations

import math
import pickle
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gazetick.llm.common import small_batches
from gazetick.session import stage

K = 20
#: Characters of items that are asked at once; their terms are what every executor holds.
ITEM_CHARACTERS = 8_000_000
#: Documents and postings of a block, and bytes of a text that are split at once.
BLOCK, BLOCK_POSTINGS, SLICE = 8192, 2_000_000, 1 << 20
#: Documents whose groups are evaluated before the k-th score is looked at again; doubled each time.
TOGETHER = 64

# Bytes beyond ASCII belong to letters of terms; so on bytes as on characters, and A-Z alone are lowered.
_SPLIT = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or chr(b).isalnum() else 32 for b in range(256))


def term_slices(text: str | None) -> Iterator[list[bytes]]:
    """The terms of a text, in lists of bounded size."""
    data = (text or "").encode()
    low = 0
    while low < len(data):
        high = low + SLICE
        while high < len(data) and _SPLIT[data[high]] != 32:
            high += 1
        yield data[low:high].translate(_SPLIT).split()
        low = high


def count_terms(text: str | None) -> Counter:
    counts: Counter = Counter()
    for terms in term_slices(text):
        counts.update(terms)
    return counts


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def norms(n: np.ndarray, documents: int, total: int) -> np.ndarray:
    """Length norms; the product may pass 64 bits."""
    return np.array([75 + 25 * int(x) * documents // total for x in n], np.int64)


def impacts(tf: np.ndarray, norm: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + 12 * norm)


class Best:
    """The best documents of one item so far: scores, whether the id is null, ids."""

    def __init__(self, k: int):
        self.k = k
        self.rows = np.empty((3, 0), np.int64)

    def least(self) -> int:
        """Score below which nothing more can enter."""
        return int(self.rows[0, -1]) if self.rows.shape[1] == self.k else 1

    def add(self, scores: np.ndarray, nulls: np.ndarray, ids: np.ndarray) -> None:
        good = scores >= self.least()
        rows = np.concatenate([self.rows, np.stack([scores[good], nulls[good], ids[good]])], axis=1)
        self.rows = rows[:, np.lexsort((rows[2], rows[1], -rows[0]))[: self.k]]


class Block:
    """Postings of some documents, by document and by term."""

    def __init__(self, ids: np.ndarray, nulls: np.ndarray, sizes: np.ndarray, terms: np.ndarray, impact: np.ndarray):
        self.ids, self.nulls, self.terms, self.impact = ids, nulls, terms, impact
        self.offsets = np.concatenate([[0], np.cumsum(sizes)])
        order = np.argsort(terms, kind="stable")
        self.docs = np.repeat(np.arange(len(ids)), sizes)[order]
        self.present, starts = np.unique(terms[order], return_index=True)
        self.bounds = np.append(starts, len(terms))
        self.top = np.maximum.reduceat(impact[order], starts) if len(starts) else starts

    def groups(self, terms: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Documents by descending bound of their mask, the ends of the groups in them, and the bounds."""
        at = np.searchsorted(self.present, terms)
        inside = at < len(self.present)
        inside[inside] = self.present[at[inside]] == terms[inside]
        at, weights = at[inside], weights[inside]
        masks = np.zeros((len(at) + 63 >> 6, len(self.ids)), np.uint64)
        for bit, place in enumerate(at):
            masks[bit >> 6, self.docs[self.bounds[place] : self.bounds[place + 1]]] |= np.uint64(1 << (bit & 63))
        hit = np.flatnonzero(masks.any(axis=0))
        masks = masks[:, hit]
        group = np.zeros(len(hit), np.int64)
        for word in masks:
            kinds, kind = np.unique(word, return_inverse=True)
            group = np.unique(group * len(kinds) + kind, return_inverse=True)[1]
        some = np.unique(group, return_index=True)[1]
        bounds = np.zeros(len(some), np.int64)
        for bit, (place, w) in enumerate(zip(at, weights, strict=True)):
            bounds += w * self.top[place] * ((masks[bit >> 6, some] >> np.uint64(bit & 63)) & np.uint64(1)).astype(np.int64)
        order = np.argsort(-bounds, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        ends = np.cumsum(np.bincount(group, minlength=len(some))[order])
        return hit[np.argsort(rank[group], kind="stable")], ends, bounds[order]

    def scores(self, docs: np.ndarray, dense: np.ndarray) -> np.ndarray:
        lengths = self.offsets[docs + 1] - self.offsets[docs]
        ends = np.cumsum(lengths)
        at = np.arange(ends[-1]) + np.repeat(self.offsets[docs] - (ends - lengths), lengths)
        return np.add.reduceat(dense[self.terms[at]] * self.impact[at], ends - lengths)

    def search(self, terms: np.ndarray, weights: np.ndarray, dense: np.ndarray, best: Best) -> int:
        """Let this block's documents enter ``best``; returns how many were evaluated. ``dense``: weight by term."""
        docs, ends, bounds = self.groups(terms, weights)
        at, done, step = 0, 0, TOGETHER
        while at < len(bounds) and bounds[at] >= best.least():
            many = int(np.searchsorted(ends, done + step)) + 1  # whole groups, one at least
            at = min(many, int(np.searchsorted(-bounds, -best.least(), side="right")))
            some = docs[done : ends[at - 1]]
            best.add(self.scores(some, dense), self.nulls[some], self.ids[some])
            done, step = int(ends[at - 1]), step * 2
        return done


def _postings(docs: DataFrame, vocabulary: Broadcast) -> DataFrame:
    """``id, n, terms, counts`` of every document with a term; the terms are those of the vocabulary."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = pickle.loads(vocabulary.value)
        for batch in batches:
            n, terms, counts, ends = [], [], [], [0]
            for text in batch.column("text"):
                found = count_terms(text.as_py())
                n.append(found.total())
                held = sorted((number[t], found[t]) for t in number.keys() & found.keys())
                terms += [t for t, _ in held]
                counts += [c for _, c in held]
                ends.append(len(terms))
            arrays = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, kind)) for x, kind in ((terms, pa.int32()), (counts, pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(n, pa.int64()), *arrays], ["id", "n", "terms", "counts"])

    return docs.mapInArrow(read, "id long, n long, terms array<int>, counts array<long>").filter("n > 0")


def _blocks(batches: Iterable[pa.RecordBatch], documents: int, total: int, most: tuple[int, int]) -> Iterator[Block]:
    held, size, postings = [], 0, 0
    for batch in batches:
        held.append(batch)
        size, postings = size + batch.num_rows, postings + len(batch.column("terms").flatten())
        if size >= most[0] or postings >= most[1]:
            yield _block(held, documents, total)
            held, size, postings = [], 0, 0
    if size:
        yield _block(held, documents, total)


def _block(batches: list[pa.RecordBatch], documents: int, total: int) -> Block:
    rows = pa.Table.from_batches(batches).combine_chunks()
    column = lambda name: rows.column(name).combine_chunks()
    sizes = column("terms").value_lengths().to_numpy()
    tf = column("counts").flatten().to_numpy()
    norm = np.repeat(norms(column("n").to_numpy(), documents, total), sizes)
    nulls = column("id").is_null().to_numpy(zero_copy_only=False).astype(np.int64)
    return Block(column("id").fill_null(0).to_numpy(), nulls, sizes, column("terms").flatten().to_numpy(), impacts(tf, norm))


def _ask(docs: DataFrame, items: list[tuple[int, Counter]], k: int) -> DataFrame:
    """``item, id, score``: the best documents of these items, at most ``k`` an item and task."""
    spark = docs.sparkSession
    number = {t: i for i, t in enumerate(sorted(set().union(*(counts for _, counts in items))))}
    postings = stage(_postings(docs, spark.sparkContext.broadcast(pickle.dumps(number))))
    documents, total = postings.agg(F.count(F.lit(1)), F.sum("n")).first()
    holding = postings.select(F.explode("terms").alias("term")).groupBy("term").count().collect()  # a row per term of the items
    weights = {r["term"]: weight(documents, r["count"]) for r in holding}
    asked = []
    for item, counts in items:
        found = sorted((number[t], n * weights[number[t]]) for t, n in counts.items() if weights.get(number[t], 0) > 0)
        if found:
            asked.append((item, np.array(found, np.int64).T))
    shared = spark.sparkContext.broadcast(pickle.dumps(asked))
    terms, most = len(number), (BLOCK, BLOCK_POSTINGS)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = [(item, found, Best(k)) for item, found in pickle.loads(shared.value)]
        dense = np.zeros(terms, np.int64)
        for block in _blocks(batches, documents, total, most):
            for _, (at, w), best in wanted:
                dense[at] = w
                block.search(at, w, dense, best)
                dense[at] = 0
        for item, _, best in wanted:
            scores, nulls, ids = best.rows
            arrays = [pa.array(np.full(len(ids), item)), pa.array(ids, mask=nulls.astype(bool)), pa.array(scores)]
            yield pa.RecordBatch.from_arrays(arrays, ["item", "id", "score"])

    return postings.mapInArrow(search, "item long, id long, score long")


def search(docs: DataFrame, items: DataFrame, k: int = K, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text") -> DataFrame:
    """``item_id, rank, doc_id, score``: each item's ``k`` best documents with a score above 0, ties by id."""
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    asked = stage(items.select(F.col(item_id).alias("_id"), F.col(text).alias("_text"), F.monotonically_increasing_id().alias("_item")))
    characters = asked.agg(F.sum(F.length("_text"))).first()[0] or 0
    blocks = characters // ITEM_CHARACTERS + 1
    found = []
    for block in range(blocks):
        # A block's items come to the driver: a bounded number of characters, or one item.
        here = asked.filter(F.pmod(F.xxhash64("_item"), F.lit(blocks)) == block).select("_item", "_text").collect()
        counted = [(r["_item"], c) for r in here if (c := count_terms(r["_text"]))]
        if counted:
            found.append(_ask(rows, counted, k))
    schema = T.StructType([T.StructField(item_id, asked.schema["_id"].dataType), T.StructField("rank", T.IntegerType()),
                           T.StructField(doc_id, T.LongType()), T.StructField("score", T.LongType())])
    if not found:
        return spark.createDataFrame([], schema)
    every = found[0]
    for more in found[1:]:
        every = every.union(more)
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    ranked = every.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    # The items are joined by their row, a few rows each.
    return ranked.join(asked.select("_item", "_id"), F.col("item") == F.col("_item")).select(
        F.col("_id").alias(item_id), "rank", F.col("id").alias(doc_id), "score"
    )
