"""Entity annotation and text embedding. Models come from the user; the defaults need no download."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gazetick.functions.text import WORD
from gazetick.operators.reduce import truncated_svd
from gazetick.operators.textfeatures import sparse_rows, term_index, tfidf
from gazetick.session import fresh, stage

ENTITIES = "array<struct<word:string,label:string>>"


def words_of(text: Column) -> Column:
    """Runs of word characters in their own case."""
    return F.regexp_extract_all(text, F.lit(f"[{WORD}]+"), F.lit(0))


def annotate_with(df: DataFrame, col: str, load: Callable[[], Callable], out: str = "entities") -> DataFrame:
    """Entities from a user's tagger.

    ``load()`` runs once per worker and returns ``tag(texts) -> list of [(word, label), ...]``.
    Null text has no entities.
    """

    @F.pandas_udf(ENTITIES)
    def tag(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tagger = load()
        for texts in batches:
            found = tagger([t if t is not None else "" for t in texts])
            yield pd.Series([[{"word": w, "label": n} for w, n in spans] if t else [] for t, spans in zip(texts, found)])

    return df.withColumn(out, F.when(F.col(col).isNotNull(), tag(F.col(col))))


#: Bytes of phrases that one pass over the texts looks for.
GAZETTEER_BYTES = 32 << 20
HITS = "array<struct<pos:int,len:int,label:string>>"


def phrase_tree(phrases: list[tuple[str, str]]) -> dict:
    """Phrases by their words: a state's arcs by word, and a phrase's label under the key None."""
    root: dict = {}
    for phrase, label in phrases:
        state = root
        for word in phrase.split(" "):
            state = state.setdefault(word, {})
        state[None] = label
    return root


def longest_hits(words: list[str], tree: dict) -> list[tuple[int, int, str]]:
    """``pos, len, label`` of the longest phrase at every word that begins one."""
    out = []
    for pos, word in enumerate(words):
        state = tree.get(word)
        end, best = pos, None
        while state is not None:
            end += 1
            if None in state:
                best = (pos, end - pos, state[None])
            state = state.get(words[end]) if end < len(words) else None
        if best is not None:
            out.append(best)
    return out


def without_overlaps(hits: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Hits from the left, each beginning behind the one before."""
    out, free = [], 0
    for hit in hits:
        if hit[0] >= free:
            out.append(hit)
            free = hit[0] + hit[1]
    return out


def _hit_array(rows: list[list[tuple[int, int, str]]]) -> pa.Array:
    ends = np.cumsum([0] + [len(r) for r in rows])
    flat = [h for r in rows for h in r]
    kinds = (pa.int32(), pa.int32(), pa.string())
    structs = pa.StructArray.from_arrays([pa.array([h[i] for h in flat], kind) for i, kind in enumerate(kinds)], names=["pos", "len", "label"])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), structs)


def _entity_array(texts: list[str | None], hits: list[list[tuple[int, int, str]]]) -> pa.Array:
    """Words of the hits, as they stand in the texts, with their labels."""
    words, labels, ends = [], [], [0]
    for text, row in zip(texts, hits, strict=True):
        own = text.split(" ") if row else []
        words += [" ".join(own[pos : pos + n]) for pos, n, _ in row]
        labels += [label for _, _, label in row]
        ends.append(len(words))
    structs = pa.StructArray.from_arrays([pa.array(words, pa.string()), pa.array(labels, pa.string())], names=["word", "label"])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), structs)


def annotate_entities(
    df: DataFrame, row_id: str, col: str, gazetteer: DataFrame, out: str = "entities"
) -> DataFrame:
    """Leftmost-longest matches of ``gazetteer`` phrases (``phrase`` in lower case, ``label``).

    A tree over the phrases' words is broadcast and walked over each text's words in one Arrow pass;
    neither texts nor their n-grams are shuffled. Phrases beyond ``GAZETTEER_BYTES`` are dealt by their
    first word over several passes, whose hits are settled together. A phrase with several labels has the
    smallest; a null text has null entities.
    """
    table = stage(gazetteer.filter(F.col("phrase").isNotNull()).groupBy("phrase").agg(F.min("label").alias("label")))
    size = table.agg(F.sum(F.octet_length("phrase") + 32)).first()[0] or 0
    parts = size // GAZETTEER_BYTES + 1
    joined = F.array_join(words_of(F.col(col)), " ")

    def tree_of(part: int):
        mine = table.filter(F.pmod(F.xxhash64(F.substring_index("phrase", " ", 1)), F.lit(parts)) == part)
        return df.sparkSession.sparkContext.broadcast([(r["phrase"], r["label"]) for r in mine.collect()])

    def hits_of(part: int) -> Callable:
        sent = tree_of(part)

        @F.arrow_udf(HITS)
        def hits(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            tree = phrase_tree(sent.value)
            for texts in batches:
                yield _hit_array([longest_hits(t.split(" ") if t else [], tree) for t in texts.to_pylist()])

        return hits

    if parts == 1:
        sent = tree_of(0)

        @F.arrow_udf(ENTITIES)
        def tagged(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
            tree = phrase_tree(sent.value)
            for own, lowered in batches:
                found = [without_overlaps(longest_hits(t.split(" ") if t else [], tree)) for t in lowered.to_pylist()]
                yield _entity_array(own.to_pylist(), found)

        return df.withColumn(out, F.when(F.col(col).isNotNull(), tagged(joined, F.lower(joined))))

    @F.arrow_udf(ENTITIES)
    def settled(own: pa.Array, hits: pa.Array) -> pa.Array:
        rows = [[(h["pos"], h["len"], h["label"]) for h in r] for r in hits.to_pylist()]
        return _entity_array(own.to_pylist(), [without_overlaps(sorted(r)) for r in rows])

    hits = fresh(df, "_hits")
    found = df.withColumn(hits, hits_of(0)(F.lower(joined)))
    for part in range(1, parts):
        found = stage(found).withColumn(hits, F.concat(hits, hits_of(part)(F.lower(joined))))
    return found.withColumn(out, F.when(F.col(col).isNotNull(), settled(joined, F.col(hits)))).drop(hits)


def entity_count(entities: Column) -> Column:
    return F.coalesce(F.size(entities), F.lit(0))


def embed_with(df: DataFrame, col: str, load: Callable[[], Callable], out: str = "embedding") -> DataFrame:
    """Vectors from a user's encoder: ``load()`` once per worker, then ``encode(texts) -> n x d``."""

    @F.pandas_udf("array<float>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = load()
        for texts in batches:
            yield pd.Series([[float(v) for v in row] for row in encoder(list(texts))])

    return df.withColumn(out, encode(F.coalesce(F.col(col), F.lit(""))))


def zip_embeddings(records: DataFrame, vectors: DataFrame, key: str, vector_key: str, vector: str = "embedding", out: str = "embedding") -> DataFrame:
    """Every record with its vector by key; null where there is none. A key's first vector counts, by its numbers."""
    one = vectors.groupBy(F.col(vector_key).alias(key)).agg(F.min(vector).alias(out))
    return records.drop(out).join(one, key, "left")


def embed_text(
    df: DataFrame,
    row_id: str,
    col: str,
    size: int = 384,
    max_features: int = 5000,
    stopwords: Sequence[str] | None = None,
    out: str = "embedding",
) -> DataFrame:
    """Vectors without a pretrained model: TF-IDF reduced to ``size`` dimensions.

    A text without known terms gets the zero vector.
    """
    weights = stage(tfidf(df, row_id, col, (1, 1), max_features, 1, 1.0, True, stopwords))
    index = stage(term_index(weights))
    rows = stage(sparse_rows(weights, index, row_id, df))
    n_terms = index.count()
    width = min(size, n_terms)
    vectors = truncated_svd(rows, row_id, n_terms, width, out=out)
    padded = F.slice(F.concat(F.col(out).cast("array<float>"), F.array_repeat(F.lit(0.0).cast("float"), size)), 1, size)
    zeros = F.array_repeat(F.lit(0.0).cast("float"), size)
    return df.join(vectors.select(row_id, padded.alias(out)), row_id, "left").withColumn(out, F.coalesce(out, zeros))
