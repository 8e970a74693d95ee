"""Values of the operators that have no statement, against plain versions."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from gazetick.operators import annotate as A
from gazetick.operators import bars as B
from gazetick.operators import cluster as C
from gazetick.operators import models as M
from gazetick.operators import profile as P
from gazetick.operators.cooccur import token_embedding as embed_tokens

SF = "/root/testdata/sf0.001"


def plain_entities(text, phrases):
    if text is None:
        return None
    words, out, at = re.findall(r"\w+", text), [], 0
    while at < len(words):
        fits = [(n, label) for p, label in phrases.items() if (n := len(p.split(" "))) and " ".join(words[at : at + n]).lower() == p and at + n <= len(words)]
        if fits:
            n, label = max(fits)
            out.append((" ".join(words[at : at + n]), label))
            at += n
        else:
            at += 1
    return out


@pytest.mark.parametrize("size", [32 << 20, 1000])
def test_annotate_entities(spark, monkeypatch, size):
    monkeypatch.setattr(A, "GAZETTEER_BYTES", size)
    rng = random.Random(1)
    words = ["a", "b", "Ab", "c", "É", "x_1", "new", "York", "日本", "ÉB"]
    phrases = {" ".join(rng.choice(words).lower() for _ in range(rng.choice([1, 2, 2, 3, 5]))): rng.choice("XYZ") for _ in range(40)}
    phrases |= {"new york": "GPE", "new york a b": "ORG", "a  b": "never", "Upper": "never", "a.b": "never", "": "never"}
    texts = [None, "", "...", "new york a", "New York, A b!"] + [rng.choice([" ", ", ", "-"]).join(rng.choice(words) for _ in range(rng.randint(1, 60))) for _ in range(80)]
    docs = spark.createDataFrame([(i, t, "old", 1, 2) for i, t in enumerate(texts)], "id long, text string, entities string, _hits int, _words int")
    table = spark.createDataFrame([*phrases.items(), ("new york", "ZZZ"), (None, "X")], "phrase string, label string")
    found = A.annotate_entities(docs, "id", "text", table)
    assert sorted(found.columns) == sorted(docs.columns)
    for r in found.collect():
        assert (None if r.entities is None else [tuple(e) for e in r.entities]) == plain_entities(texts[r.id], phrases)
        assert (r["_hits"], r["_words"]) == (1, 2)
    assert A.annotate_entities(docs.limit(0), "id", "text", table).count() == 0
    none = A.annotate_entities(docs, "id", "text", table.limit(0)).collect()
    assert all((r.entities is None) if r.id == 0 else r.entities == [] for r in none)


def test_annotate_shuffles_no_text(spark):
    docs = spark.createDataFrame([(1, "a b")], "id long, text string")
    plan = A.annotate_entities(docs, "id", "text", spark.createDataFrame([("a", "X")], "phrase string, label string"))
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("length,block", [(1, 4), (7, 8), (60, 64), (60, 1024), (64, 100)])
def test_pooled_sequences(spark, length, block):
    rng = np.random.default_rng(length)
    rows = []
    for symbol, n in (("A", 300), ("B", 70), ("C", 5), (None, 130)):
        cut = n * 2 // 3
        for pos in range(1, n + 1):
            split, at = ("train", pos) if pos <= cut else ("test", pos - cut)
            rows.append((symbol, split, pos * 60, pos, at, [float(v) for v in rng.normal(size=5) * 100 + 1000], pos % 2))
    df = spark.createDataFrame(rows, "symbol string, split string, timestamp long, pos long, split_pos long, v array<double>, target int").repartition(3)
    got = {(r.symbol, r.timestamp): (r.split, r.y, r.features.toArray()) for r in M.pooled_sequences(df, "v", length, block=block).collect()}
    plain = B.make_sequences(df.filter("symbol is not null"), "v", length, block=max(block, length)).collect()
    assert {k for k in got if k[0] is not None} == {(r.symbol, r.timestamp) for r in plain}
    for r in plain:
        x = np.array(r.x)
        split, y, features = got[r.symbol, r.timestamp]
        assert (split, y) == (r.split, r.y)
        assert np.allclose(features, np.concatenate([x[-1], x.mean(0), x.max(0)]), rtol=1e-12, atol=1e-9)


def test_distinct_sketches(spark):
    df = spark.range(60_000).select("id", (F.col("id") % 500).alias("few"), F.concat(F.lit("x"), F.col("id") % 20_000).alias("text"), F.lit(None).cast("double").alias("none"))
    whole = {r["column"]: r["distinct"] for r in P.approx_distinct_counts(P.distinct_sketches(df)).collect()}
    for name, exact in {"id": 60_000, "few": 500, "text": 20_000, "none": 0}.items():
        assert abs(whole[name] - exact) <= 0.03 * exact
    parts = [P.distinct_sketches(df.filter(F.col("id") % 3 == i)) for i in range(3)]
    merged = P.approx_distinct_counts(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    assert {r["column"]: r["distinct"] for r in merged.collect()} == whole


def test_zip_embeddings(spark):
    records = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "k long, t string")
    vectors = spark.createDataFrame([(1, [2.0]), (1, [1.0]), (3, [5.0]), (None, [9.0])], "v long, embedding array<double>")
    assert sorted((r.t, r.embedding) for r in A.zip_embeddings(records, vectors, "k", "v").collect()) == [("a", [1.0]), ("b", [1.0]), ("c", None), ("d", None)]


def test_logistic_regression_is_optimal(spark):
    """At the solution the gradient of the penalised, weighted loss is zero."""
    rng = np.random.default_rng(4)
    y = rng.choice(3, 300, p=[0.6, 0.3, 0.1])
    x = rng.normal(size=(300, 6)) + np.eye(3, 6)[y] * 1.5
    rows = spark.createDataFrame([(i, list(range(6)), [float(v) for v in row], int(c)) for i, (row, c) in enumerate(zip(x, y, strict=True))], "doc_id long, idx array<int>, val array<double>, label_idx int")
    vectors = M.to_vectors(rows, 6)
    model = M.logistic_regression(vectors)
    w, b = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
    weight = (300 / (3 * np.bincount(y)))[y]
    z = x @ w.T + b
    p = np.exp(z - z.max(1)[:, None])
    p /= p.sum(1)[:, None]
    off = (p - np.eye(3)[y]) * weight[:, None]
    assert np.abs(off.T @ x + w).max() < 0.05 and np.abs(off.sum(0)).max() < 0.05
    got = {r.doc_id: r.prediction for r in M.predict(model, vectors).collect()}
    assert [got[i] for i in range(300)] == z.argmax(1).tolist()


def test_embed_text(spark):
    docs = spark.createDataFrame([(1, "red green blue"), (2, "red green blue"), (3, "one two three"), (4, None), (5, "")], "id long, text string")
    found = {r.id: np.array(r.embedding) for r in A.embed_text(docs, "id", "text", size=6).collect()}
    assert all(len(v) == 6 for v in found.values())
    assert np.allclose(found[1], found[2]) and abs(np.linalg.norm(found[1]) - 1) < 1e-5 and abs(found[1] @ found[3]) < 1e-5
    assert not found[4].any() and not found[5].any()


def test_model_comparison(spark):
    """Silhouettes recomputed in NumPy; best first, models with one cluster left out."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(60, 3)) + 4 * np.eye(3)[rng.integers(0, 3, 60)]
    near, far = np.abs(x).argmax(1), rng.integers(0, 2, 60)

    def table(labels):
        return spark.createDataFrame([(i, [float(v) for v in row], int(c)) for i, (row, c) in enumerate(zip(x, labels, strict=True))], "id long, x array<double>, c int")

    def score(labels):
        d, out = np.linalg.norm(x[:, None] - x[None], axis=2), []
        for i, c in enumerate(labels):
            own = (labels == c) & (np.arange(60) != i)
            a, b = d[i, own].mean(), min(d[i, labels == o].mean() for o in set(labels) - {c})
            out.append((b - a) / max(a, b))
        return np.mean(out)

    scores = {n: C.silhouette(table(v), "id", "x", "c") for n, v in (("far", far), ("near", near), ("one", np.zeros(60)))}
    rows = C.model_comparison(scores).collect()
    assert [r["Model"] for r in rows] == ["near", "far"]
    assert np.allclose([r["Silhouette Score"] for r in rows], [score(near), score(far)])


def test_token_vectors_tell_contexts_apart(spark):
    """Words of one topic are closer to each other than to words of another, and pooling is mean and maximum."""
    rng = random.Random(3)
    topics = [["red", "green", "blue", "grey"], ["one", "two", "six", "ten"]]
    docs = spark.createDataFrame([(i, [rng.choice(topics[i % 2]) for _ in range(30)]) for i in range(400)], "doc_id long, tokens array<string>")
    vectors = embed_tokens(docs, "tokens", 16)
    v = {r.word: r.vector.toArray() / np.linalg.norm(r.vector.toArray()) for r in vectors.collect()}
    inside = np.mean([v[a] @ v[b] for t in topics for a in t for b in t if a != b])
    assert inside > np.mean([v[a] @ v[b] for a in topics[0] for b in topics[1]]) + 0.1
    raw = {r.word: r.vector.toArray() for r in vectors.collect()}
    pooled = {r.doc_id: r.features.toArray() for r in M.token_features(docs, "doc_id", "tokens", vectors, 16).collect()}
    for r in docs.limit(20).collect():
        x = np.array([raw[t] for t in r.tokens])
        assert np.allclose(pooled[r.doc_id], np.concatenate([x.mean(0), x.max(0)]))
