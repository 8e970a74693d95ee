"""Counts of word n-grams of which only the most frequent are wanted.

Texts stay where they are. A task turns a batch's words into codes and counts with arrays; a row leaves
it for each n-gram and batch, never for each n-gram and document. n-grams of the smallest size are counted
in full, and their ``max_features``-th count is a bound: a longer n-gram below it cannot be kept. Longer
ones are hashed into ``BUCKETS`` totals first. A bucket's total is at least the count of each n-gram in
it, so only n-grams of buckets that reach the bound are counted, and nothing that could be kept is lost.
Bound and totals grow alike with the table, so the share that passes does not.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Totals of n-grams, those of a row of the exchange, and rows of a returned batch.
BUCKETS, SLAB, OUT_ROWS = 1 << 22, 1 << 16, 1 << 18
STATS = "term string, df long, corpus_tf long"
_MIX = np.uint64(0x9E3779B97F4A7C15)


class _Words:
    """The words of a batch of rows as codes of its different words."""

    def __init__(self, column: pa.Array, used: np.ndarray | None = None):
        sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        flat = column.flatten().dictionary_encode()
        self.words, self.code = flat.dictionary, flat.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.row = np.repeat(np.arange(len(sizes)), sizes)
        self.used = None if used is None else used[self.row]

    def starts(self, n: int, every: bool = True) -> np.ndarray:
        """Places at which ``n`` words of one row begin; without ``every`` of the used rows alone."""
        most = max(len(self.code) - n + 1, 0)
        inside = self.row[:most] == self.row[n - 1 : n - 1 + most]
        return np.flatnonzero(inside if every or self.used is None else inside & self.used[:most])

    def buckets(self, at: np.ndarray, n: int) -> np.ndarray:
        hashes = pd.util.hash_array(self.words.to_numpy(zero_copy_only=False)) if len(self.words) else np.zeros(0, np.uint64)
        found = hashes[self.code[at]]
        for k in range(1, n):
            found = (found ^ (found >> np.uint64(29))) * _MIX + hashes[self.code[at + k]]
        found = (found ^ (found >> np.uint64(32))) * _MIX
        return (found >> np.uint64(64 - (BUCKETS - 1).bit_length())).astype(np.int64)

    def counted(self, at: np.ndarray, n: int) -> pa.RecordBatch:
        """``term, df, corpus_tf`` of the n-grams that begin at ``at``."""
        gram, first = self.code[at], at
        for k in range(1, n):
            gram = np.unique(gram * max(len(self.words), 1) + self.code[at + k], return_inverse=True)[1]
        _, first, gram = np.unique(gram, return_index=True, return_inverse=True)
        pair, tf = np.unique(self.row[at] * max(len(first), 1) + gram, return_counts=True)
        pair %= max(len(first), 1)
        parts = [self.words.take(pa.array(self.code[at[first] + k])) for k in range(n)]
        term = pc.binary_join_element_wise(*parts, " ") if n > 1 else parts[0]
        df, corpus_tf = np.bincount(pair, minlength=len(first)), np.bincount(pair, tf, len(first)).astype(np.int64)
        return pa.RecordBatch.from_arrays([term.cast(pa.string()), pa.array(df, pa.int64()), pa.array(corpus_tf, pa.int64())], ["term", "df", "corpus_tf"])


def gram_totals(tokens: DataFrame, words: str, used: str, low: int, high: int) -> DataFrame:
    """One scan: ``term, df, corpus_tf`` of the n-grams of ``low`` words in the used rows, and ``slab, m``: totals of all longer ones."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            found = _Words(batch.column(words), batch.column(used).to_numpy(zero_copy_only=False).astype(bool))
            stats = found.counted(found.starts(low, every=False), low)
            nothing = [pa.nulls(stats.num_rows, pa.int64()), pa.nulls(stats.num_rows, pa.binary())]
            yield pa.RecordBatch.from_arrays([*stats.columns, *nothing], [*stats.schema.names, "slab", "m"])
            hashed = [found.buckets(found.starts(n), n) for n in range(low + 1, high + 1)]
            if hashed:
                totals += np.bincount(np.concatenate(hashed), minlength=BUCKETS)
        for slab in range(-(-BUCKETS // SLAB)):
            part = totals[slab * SLAB : (slab + 1) * SLAB]
            if part.any():
                nothing = [pa.nulls(1, t) for t in (pa.string(), pa.int64(), pa.int64())]
                yield pa.RecordBatch.from_arrays([*nothing, pa.array([slab], pa.int64()), pa.array([part.tobytes()], pa.binary())], ["term", "df", "corpus_tf", "slab", "m"])

    # A task returns up to BUCKETS numbers: one for each core scans many input partitions.
    few = tokens.select(words, used).coalesce(tokens.sparkSession.sparkContext.defaultParallelism)
    return few.mapInArrow(scan, f"{STATS}, slab long, m binary")


def reached(totals: DataFrame, bound: int) -> np.ndarray:
    """Which buckets have a total of ``bound``; the driver gets one bit for each."""

    def add(parts: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(m, np.int64) for m in parts["m"])
        return pd.DataFrame({"slab": parts["slab"].iloc[:1], "m": [np.packbits(total >= bound).tobytes()]})

    out = np.zeros(BUCKETS, bool)
    for r in totals.filter("slab is not null").select("slab", "m").groupBy("slab").applyInPandas(add, "slab long, m binary").collect():
        part = out[r["slab"] * SLAB : (r["slab"] + 1) * SLAB]
        part[:] = np.unpackbits(np.frombuffer(r["m"], np.uint8))[: len(part)]
    return out


def gram_stats(tokens: DataFrame, words: str, low: int, high: int, passed: np.ndarray) -> DataFrame:
    """``term, df, corpus_tf`` of the n-grams of ``low`` to ``high`` words in buckets that passed; a term has several rows."""
    shared = tokens.sparkSession.sparkContext.broadcast(np.packbits(passed))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = np.unpackbits(shared.value).astype(bool)
        for batch in batches:
            found = _Words(batch.column(words))
            for n in range(low, high + 1):
                at = found.starts(n)
                yield found.counted(at[open_[found.buckets(at, n)]], n)

    return tokens.select(words).mapInArrow(count, STATS)


class _Tree:
    """Kept terms as a tree of words: a node is a run of words that begins a term."""

    def __init__(self, terms: Sequence[str], idf: Sequence[float]):
        split = [t.split(" ") for t in terms]
        self.terms, self.idf = pa.array(terms, pa.string()), np.array(idf, np.float64)
        self.words = sorted({w for s in split for w in s})
        place = {w: i for i, w in enumerate(self.words)}
        codes = [[place[w] for w in s] for s in split]
        nodes = [c[0] for c in codes]
        #: By length: the keys (parent, last word) of its nodes, and the term of each node or -1.
        self.keys, self.term_of = [np.arange(len(self.words))], []
        for n in range(1, max(map(len, split), default=0) + 1):
            if n > 1:
                keys = {i: nodes[i] * len(self.words) + c[n - 1] for i, c in enumerate(codes) if len(c) >= n}
                self.keys.append(np.unique(np.fromiter(keys.values(), np.int64)))
                for i, at in zip(keys, np.searchsorted(self.keys[-1], np.fromiter(keys.values(), np.int64)).tolist(), strict=True):
                    nodes[i] = at
            term_of = np.full(len(self.keys[-1]), -1)
            for i, c in enumerate(codes):
                if len(c) == n:
                    term_of[nodes[i]] = i
            self.term_of.append(term_of)

    def found_in(self, batch: _Words) -> tuple[np.ndarray, np.ndarray]:
        """Row and term of every occurrence."""
        known = pc.index_in(batch.words.cast(pa.string()), value_set=pa.array(self.words, pa.string())).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        word = known[batch.code]
        node, rows, found = word, [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for n, (keys, term_of) in enumerate(zip(self.keys, self.term_of), 1):
            if n > 1:
                at = batch.starts(n)
                at = at[(node[at] >= 0) & (word[at + n - 1] >= 0)]
                key = node[at] * len(self.words) + word[at + n - 1]
                place = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                node = np.full(len(word), -1)
                node[at] = np.where(keys[place] == key, place, -1)
            at = np.flatnonzero(node >= 0)
            term = term_of[node[at]]
            rows.append(batch.row[at[term >= 0]])
            found.append(term[term >= 0])
        return np.concatenate(rows), np.concatenate(found)


def gram_weights(tokens: DataFrame, row_id: str, words: str, vocab: DataFrame, sublinear: bool) -> DataFrame:
    """``row_id, term, weight`` of rows with an id of their own, scaled to length 1; ``vocab`` (``term, idf``) goes to every task."""
    kept = vocab.select("term", "idf").collect()
    shared = tokens.sparkSession.sparkContext.broadcast(_Tree([r["term"] for r in kept], [r["idf"] for r in kept]))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = shared.value
        for batch in batches:
            row, term = tree.found_in(_Words(batch.column(words)))
            pair, tf = np.unique(row * max(len(tree.terms), 1) + term, return_counts=True)
            row, term = np.divmod(pair, max(len(tree.terms), 1))
            raw = (np.log(tf) + 1.0 if sublinear else tf.astype(np.float64)) * tree.idf[term]
            weight = raw / np.sqrt(np.bincount(row, raw * raw, batch.num_rows))[row]
            for at in range(0, len(row), OUT_ROWS):
                some = slice(at, at + OUT_ROWS)
                columns = [batch.column(row_id).take(pa.array(row[some])), tree.terms.take(pa.array(term[some])), pa.array(weight[some])]
                yield pa.RecordBatch.from_arrays(columns, [row_id, "term", "weight"])

    schema = T.StructType([tokens.schema[row_id], T.StructField("term", T.StringType()), T.StructField("weight", T.DoubleType())])
    return tokens.select(row_id, words).mapInArrow(weigh, schema)


def bound_of(stats: DataFrame, max_features: int) -> int:
    """The ``max_features``-th highest count, or 1 if there are fewer terms."""
    top = stats.select("corpus_tf").orderBy(F.desc("corpus_tf")).limit(max_features)
    found = top.agg(F.count(F.lit(1)).alias("n"), F.min("corpus_tf").alias("least")).first()
    return found["least"] if found["n"] == max_features > 0 else 1
