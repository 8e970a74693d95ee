"""Vocabulary, sequences, TF-IDF, label encoding and stratified splits as relations."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gazetick.functions.text import WORD, clean_and_tokenize, pad_truncate, remove_stopwords
from gazetick.plans.grams import bound_of, gram_stats, gram_totals, gram_weights, reached
from gazetick.plans.lookup import BROADCAST_TERMS, lookup_join
from gazetick.plans.position import ranked, with_position
from gazetick.session import stage

PAD, UNK = 0, 1
#: More than any position in an array, and the lead of a document without an id: below every long.
POSITIONS, NO_DOC = 1 << 31, -(1 << 63) - 1


def build_vocab(docs: DataFrame, doc_id: str, tokens: Column, min_count: int = 2) -> DataFrame:
    """``token, id``: id is 2 + the rank of a word's first appearance among all words.

    Words below ``min_count`` take a rank but no row, so ids have gaps. A word's place is one decimal
    number, document before position: its minimum is kept in place by a hash aggregate, so that a task
    sends one row per word and sorts none. A missing document id comes first, as nulls do.
    """
    lead = F.coalesce(F.col(doc_id).cast("decimal(20,0)"), F.lit(str(NO_DOC)).cast("decimal(20,0)"))
    start = (lead * F.lit(POSITIONS).cast("decimal(10,0)")).cast("decimal(31,0)")
    words = docs.select(start.alias("_start"), F.posexplode(tokens).alias("_pos", "token"))
    place = (F.col("_start") + F.col("_pos").cast("decimal(10,0)")).cast("decimal(31,0)")
    per_word = words.groupBy("token").agg(F.count(F.lit(1)).alias("count"), F.min(place).alias("_place"))
    lead = F.floor(F.col("_place") / F.lit(POSITIONS).cast("decimal(10,0)")).cast("decimal(20,0)")
    lead = F.when(lead != F.lit(str(NO_DOC)).cast("decimal(20,0)"), lead).cast("long")
    flat = stage(per_word.select("token", "count", lead.alias("_doc"), "_place"))  # read for the counts and for the rows
    ranked = with_position(flat, ["_doc", "_place"], shifts=(8, 24), out="_rank")
    return ranked.filter(F.col("count") >= min_count).select("token", (F.col("_rank") + 1).alias("id"))


def vocab_size(vocab: DataFrame) -> DataFrame:
    return vocab.agg((F.coalesce(F.max("id"), F.lit(1)) + 1).alias("size"))


def vocab_lookup(docs: DataFrame, doc_id: str, tokens: Column, vocab: DataFrame, length: int | None = None) -> DataFrame:
    """``doc_id, ids``: token ids in order, unknown words as 1.

    With ``length`` only the tokens that survive truncation are looked up.
    """
    kept = tokens if length is None else F.slice(tokens, 1, length)
    words = docs.select(doc_id, F.posexplode_outer(kept).alias("_pos", "token"))
    found = lookup_join(words, vocab, ["token"], F.col(doc_id), "left")
    pair = F.when(F.col("_pos").isNotNull(), F.struct("_pos", F.coalesce("id", F.lit(UNK)).cast("int").alias("id")))
    grouped = found.groupBy(doc_id).agg(F.array_sort(F.collect_list(pair)).alias("_pairs"))
    return grouped.select(doc_id, F.transform("_pairs", lambda p: p["id"]).alias("ids"))


def text_to_sequence(docs: DataFrame, doc_id: str, text: str, vocab: DataFrame, length: int = 40) -> DataFrame:
    """``doc_id, sequence`` of ``length`` ids."""
    ids = vocab_lookup(docs, doc_id, clean_and_tokenize(F.col(text)), vocab, length)
    return ids.select(doc_id, pad_truncate(F.col("ids"), length, PAD).alias("sequence"))


def label_table(df: DataFrame, label: str) -> DataFrame:
    """``label, idx``: sorted classes to 0..k-1. The window runs over classes, not rows."""
    classes = df.select(label).filter(F.col(label).isNotNull()).distinct()
    return classes.select(label, (F.row_number().over(Window.orderBy(label)) - 1).alias("idx"))


def label_encode(df: DataFrame, label: str, out: str = "label_idx") -> DataFrame:
    return lookup_join(df, label_table(df, label).withColumnRenamed("idx", out), [label], F.monotonically_increasing_id())


def terms(text: Column, stopwords: Sequence[str] | None = None) -> Column:
    """Lower-case runs of two or more word characters."""
    words = F.regexp_extract_all(F.lower(text), F.lit(f"[{WORD}]{{2,}}"), F.lit(0))
    return remove_stopwords(words, list(stopwords)) if stopwords else words


def ngrams(tokens: Column, low: int = 1, high: int = 1) -> Column:
    """Word n-grams of ``low``..``high`` words, joined by a blank."""

    def of_size(n: int) -> Column:
        if n == 1:
            return tokens
        starts = F.when(F.size(tokens) >= n, F.sequence(F.lit(1), F.size(tokens) - (n - 1)))
        grams = F.transform(starts, lambda i: F.array_join(F.slice(tokens, i, n), " "))
        return F.coalesce(grams, F.array().cast("array<string>"))

    sizes = [of_size(n) for n in range(low, high + 1)]
    return F.concat(*sizes) if len(sizes) > 1 else sizes[0]


def term_counts(
    docs: DataFrame, doc_id: str, text: str, ngram: tuple[int, int] = (1, 1), stopwords: Sequence[str] | None = None
) -> DataFrame:
    """``doc_id, term, tf``.

    Texts stay where they are: each task counts the n-grams of its documents, and only those counts
    are shuffled.
    """
    return gram_counts(docs.select(doc_id, terms(F.col(text), stopwords).alias("_t")), doc_id, ngram)


def gram_counts(tokens: DataFrame, doc_id: str, ngram: tuple[int, int]) -> DataFrame:
    """``doc_id, term, tf`` of the words ``_t``."""
    grams = tokens.select(doc_id, F.explode(ngrams(F.col("_t"), *ngram)).alias("term"))
    return grams.groupBy(doc_id, "term").agg(F.count(F.lit(1)).alias("tf"))


def term_stats(counts: DataFrame) -> DataFrame:
    return counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("corpus_tf"))


def tfidf_vocabulary(
    stats: DataFrame, n_docs: DataFrame, max_features: int | None = None, min_df: int = 1, max_df: float = 1.0
) -> DataFrame:
    """``term, df, idf`` after document-frequency limits and, by corpus frequency, ``max_features``.

    ``stats``: ``term, df, corpus_tf``; ``n_docs`` is one row with ``n``.
    """
    stats = stats.crossJoin(F.broadcast(n_docs))
    kept = stats.filter((F.col("df") >= min_df) & (F.col("df") <= F.col("n") * F.lit(max_df)))
    if max_features is not None:
        kept = kept.orderBy(F.desc("corpus_tf"), F.asc("term")).limit(max_features)
    idf = F.ln((1.0 + F.col("n")) / (1.0 + F.col("df"))) + 1.0
    return kept.select("term", "df", "corpus_tf", idf.alias("idf"))


def tfidf(
    docs: DataFrame,
    doc_id: str,
    text: str,
    ngram: tuple[int, int] = (1, 1),
    max_features: int | None = None,
    min_df: int = 1,
    max_df: float = 1.0,
    sublinear: bool = False,
    stopwords: Sequence[str] | None = None,
) -> DataFrame:
    """``doc_id, term, weight``: smoothed idf, rows of length 1.

    With a bound on the features, documents with an id of their own are counted and weighed where they
    are (``plans.grams``). Rows without an id or with one that comes again are one document together:
    their counts are shuffled by document and term, as all are without a bound.
    """
    n_docs = docs.agg(F.count(F.lit(1)).alias("n"))
    if max_features is None or max_features > BROADCAST_TERMS:
        counts = stage(term_counts(docs, doc_id, text, ngram, stopwords))  # read for the vocabulary and for the weights
        return weigh(counts, tfidf_vocabulary(term_stats(counts), n_docs, max_features, min_df, max_df), doc_id, sublinear)
    again = stage(docs.groupBy(doc_id).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(doc_id, F.lit(True).alias("_again")))
    marked = lookup_join(docs.select(doc_id, text), again, [doc_id], F.monotonically_increasing_id(), "left")
    own = (F.col(doc_id).isNotNull() & F.col("_again").isNull()).alias("_own")
    tokens = stage(marked.select(doc_id, terms(F.col(text), stopwords).alias("_t"), own))  # read by three scans
    single, shared = tokens.filter("_own"), stage(gram_counts(tokens.filter("not _own"), doc_id, ngram))
    vocab = stage(tfidf_vocabulary(_frequent_terms(tokens, shared, n_docs, ngram, max_features, min_df, max_df), n_docs, max_features, min_df, max_df))
    return gram_weights(single, doc_id, "_t", vocab, sublinear).unionByName(weigh(shared, vocab, doc_id, sublinear, bounded=True))


def _frequent_terms(
    tokens: DataFrame, shared: DataFrame, n_docs: DataFrame, ngram: tuple[int, int], max_features: int, min_df: int, max_df: float
) -> DataFrame:
    """``term, df, corpus_tf`` of all terms that can be among the first ``max_features``; others may be missing or counted in part."""
    low, high = ngram
    totals = stage(gram_totals(tokens, "_t", "_own", low, high))
    blanks = F.length("term") - F.length(F.translate("term", " ", ""))

    def summed(found: DataFrame, more: DataFrame) -> DataFrame:
        both = found.select("term", "df", "corpus_tf").unionByName(term_stats(more))
        return both.groupBy("term").agg(F.sum("df").alias("df"), F.sum("corpus_tf").alias("corpus_tf"))

    short = summed(totals.filter("term is not null"), shared.filter(blanks == low - 1))
    if high == low:
        return short
    short = stage(short)
    bound = bound_of(tfidf_vocabulary(short, n_docs, None, min_df, max_df), max_features)
    longer = gram_stats(tokens.filter("_own"), "_t", low + 1, high, reached(totals, bound))
    longer = summed(longer, shared.filter(blanks >= low)).filter(F.col("corpus_tf") >= bound)
    return short.unionByName(longer)


def weigh(counts: DataFrame, vocab: DataFrame, doc_id: str, sublinear: bool = False, bounded: bool = False) -> DataFrame:
    """Weights of the counts whose term is in the vocabulary, scaled to length 1 per document."""
    table = vocab.select("term", "idf")
    joined = counts.join(F.broadcast(table) if bounded else table, "term")
    tf = F.ln("tf") + 1.0 if sublinear else F.col("tf").cast("double")
    raw = joined.select(doc_id, "term", (tf * F.col("idf")).alias("_w"))
    norm = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy(doc_id)))
    return raw.withColumn("_norm", norm).select(doc_id, "term", (F.col("_w") / F.col("_norm")).alias("weight"))


def term_index(weights: DataFrame) -> DataFrame:
    """``term, idx``: columns of the matrix in alphabetical order."""
    return ranked(weights.select("term").distinct(), ["term"], "_at").select("term", F.col("_at").cast("int").alias("idx"))


def sparse_rows(weights: DataFrame, index: DataFrame, doc_id: str, docs: DataFrame) -> DataFrame:
    """``doc_id, idx, val``: one sparse row for each of ``docs``, indices ascending.

    A document without a kept term is a row of zeros, with empty arrays. Weights that lie side by side are
    packed where they are, so that a row for a document is shuffled and none for its terms.
    """
    joined = lookup_join(weights.filter(F.col(doc_id).isNotNull()), index, ["term"], F.col(doc_id))
    parts = packed_runs(joined.select(doc_id, F.col("idx").cast("int").alias("idx"), F.col("weight").cast("double").alias("val")), doc_id)
    found = parts.groupBy(doc_id).agg(F.collect_list(F.struct("idx", "val")).alias("_r"))
    pairs = F.flatten(F.transform("_r", lambda r: F.arrays_zip(r["idx"], r["val"])))
    one = F.size("_r") == 1  # a run is in order
    whole = F.when(one, F.col("_r")[0]).otherwise(_unzipped(F.array_sort(pairs)))
    rows = docs.select(doc_id).join(found.select(doc_id, whole.alias("_p")), doc_id, "left")
    return rows.select(
        doc_id,
        F.coalesce("_p.idx", F.array().cast("array<int>")).alias("idx"),
        F.coalesce("_p.val", F.array().cast("array<double>")).alias("val"),
    )


def _unzipped(pairs: Column) -> Column:
    return F.struct(F.transform(pairs, lambda p: p["idx"]).alias("idx"), F.transform(pairs, lambda p: p["val"]).alias("val"))


def packed_runs(entries: DataFrame, doc_id: str) -> DataFrame:
    """``doc_id, idx, val``: rows that follow each other with one id as one row of arrays, indices ascending."""

    def runs(batch: pa.RecordBatch) -> np.ndarray:
        code = batch.column(doc_id).dictionary_encode().indices.to_numpy(zero_copy_only=False)
        return np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))

    def packed(batch: pa.RecordBatch) -> pa.RecordBatch:
        starts = runs(batch)
        run = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, batch.num_rows)))
        order = pa.array(np.lexsort((batch.column("idx").to_numpy(), run)))
        ends = pa.array(np.append(starts, batch.num_rows), pa.int32())
        arrays = [pa.ListArray.from_arrays(ends, batch.column(c).take(order)) for c in ("idx", "val")]
        return pa.RecordBatch.from_arrays([batch.column(doc_id).take(pa.array(starts)), *arrays], [doc_id, "idx", "val"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last run may go on in the next batch
        for batch in batches:
            if not batch.num_rows:
                continue
            batch = batch if held is None else pa.concat_batches([held, batch])
            last = int(runs(batch)[-1])
            held = batch.slice(last)
            if last:
                yield packed(batch.slice(0, last))
        if held is not None:
            yield packed(held)

    schema = T.StructType([entries.schema[doc_id], *(T.StructField(c, T.ArrayType(kind)) for c, kind in (("idx", T.IntegerType()), ("val", T.DoubleType())))])
    return entries.mapInArrow(pack, schema)


def split_sizes(df: DataFrame, label: str, test_sizes: Sequence[float]) -> DataFrame:
    """Rows of every class for each part: the kept part first, then one per entry of ``test_sizes``.

    Each step splits what is left: n_test = ceil(size x n); class shares of the kept part by largest
    remainder, ties by class. ``[0.30, 0.50]`` gives 70/15/15. One row per class.
    """
    left = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("_left"))
    whole = Window.partitionBy()
    for i, size in enumerate(test_sizes):
        total = F.sum("_left").over(whole)
        # 1e-9 keeps a product such as 0.1 * 30 from being rounded up past its exact value.
        keep = total - F.ceil(total * F.lit(size) - 1e-9)
        left = left.withColumns({"_keep": keep, "_total": total})
        exact = F.col("_keep") * F.col("_left")
        left = left.withColumns({"_floor": F.floor(exact / F.col("_total")), "_rest": exact % F.col("_total")})
        place = F.row_number().over(Window.orderBy(F.desc("_rest"), F.asc(label)))
        missing = F.col("_keep") - F.sum("_floor").over(whole)
        left = left.withColumn(f"_part{i}", F.col("_floor") + (place <= missing).cast("int"))
        left = left.withColumn("_left", F.col("_left") - F.col(f"_part{i}")).drop("_keep", "_total", "_floor", "_rest")
    return left.withColumnRenamed("_left", f"_part{len(test_sizes)}")


def shuffle_key(col_id: Column, seed: int) -> Column:
    """60 bits of md5(seed|id): a fixed pseudo-random order any engine can repeat."""
    digest = F.md5(F.concat(F.lit(f"{seed}|"), col_id.cast("string")))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def stratified_split(
    df: DataFrame,
    label: str,
    row_id: str,
    test_sizes: Sequence[float] = (0.30, 0.50),
    parts: Sequence[str] = ("train", "validation", "test"),
    seed: int = 42,
) -> DataFrame:
    """Adds ``split``; every class is cut at its exact sizes in a seeded order.

    Rows are numbered through buckets of the shuffle key, so a class with a third of all rows is
    not sorted in one task, and class sizes arrive with the bucket offsets.
    """
    keyed = df.filter(F.col(label).isNotNull()).withColumn("_key", shuffle_key(F.col(row_id), seed))
    sizes = split_sizes(df, label, test_sizes)
    placed = with_position(keyed, ["_key", row_id], [label], shifts=(40, 50), out="_pos", per_key=sizes)
    split, end = None, F.lit(0)
    for i, name in enumerate(parts[:-1]):
        end = end + F.col(f"_part{i}")
        split = F.when(F.col("_pos") <= end, name) if split is None else split.when(F.col("_pos") <= end, name)
    drops = ["_key", "_pos", *[f"_part{i}" for i in range(len(test_sizes) + 1)]]
    return placed.withColumn("split", split.otherwise(parts[-1])).drop(*drops)
