"""TF-IDF of bounded vocabularies against plain counting, and what it counts on the way."""

import math
import random
from collections import Counter, defaultdict

import pytest

from gazetick.operators import textfeatures as T
from gazetick.plans import grams


def plain(rows, ngram, max_features, min_df, max_df, sublinear):
    docs = defaultdict(Counter)
    for i, text in rows:
        words = [w for w in (text or "").lower().split() if len(w) > 1]
        docs[i].update(" ".join(words[a : a + n]) for n in range(ngram[0], ngram[1] + 1) for a in range(len(words) - n + 1))
    df, total = Counter(), Counter()
    for c in docs.values():
        df.update(c.keys())
        total.update(c)
    kept = sorted((t for t in df if min_df <= df[t] <= len(rows) * max_df), key=lambda t: (-total[t], t.encode()))[:max_features]
    idf = {t: math.log((1 + len(rows)) / (1 + df[t])) + 1 for t in kept}
    out = {}
    for i, c in docs.items():
        raw = {t: (math.log(n) + 1 if sublinear else n) * idf[t] for t, n in c.items() if t in idf}
        norm = math.sqrt(sum(w * w for w in raw.values()))
        out |= {(i, t): w / norm for t, w in raw.items()}
    return out


def texts(n, seed=3):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(60)] + ["Élan", "ünder_9", "x"]
    return [" ".join(rng.choices(words, [1 / (1 + k) for k in range(len(words))], k=rng.randint(0, 30))) for _ in range(n)]


@pytest.mark.parametrize("ngram,most", [((1, 1), 20), ((1, 2), 45), ((1, 3), 60), ((2, 3), 30), ((1, 3), 100_000)])
@pytest.mark.parametrize("ids", ["own", "again"])
def test_weights_are_those_of_plain_counting(spark, ngram, most, ids):
    rows = [(i if ids == "own" else i // 3 if i % 4 else None, t) for i, t in enumerate([*texts(90), None, ""])]
    docs = spark.createDataFrame(rows, "id long, text string").repartition(5)
    options = dict(ngram=ngram, max_features=most, min_df=2, max_df=0.9, sublinear=True)
    found = {(r.id, r.term): r.weight for r in T.tfidf(docs, "id", "text", **options).collect()}
    assert found == pytest.approx(plain(rows, ngram, most, 2, 0.9, True))


def test_no_table_of_documents_and_terms(spark, monkeypatch):
    """Only rows that share an id are counted by document and term."""
    made = []
    monkeypatch.setattr(T, "stage", lambda df: made.append(df) or df.localCheckpoint())
    docs = spark.createDataFrame([*enumerate(texts(50)), (7, "aa bb"), (None, "bb cc")], "id long, text string")
    T.tfidf(docs, "id", "text", (1, 2), 20).count()
    assert {r.id for df in made if "tf" in df.columns for r in df.collect()} == {7, None}


def test_rare_pairs_are_not_counted(spark, monkeypatch):
    """Pairs below the bound take no row unless they share a bucket with others."""
    counted = []
    stats = grams.gram_stats
    monkeypatch.setattr(T, "gram_stats", lambda *a: counted.append(stats(*a)) or counted[-1])
    docs = spark.createDataFrame([(i, f"aa bb cc aa bb r{2 * i}x r{2 * i + 1}x") for i in range(40)], "id long, text string")
    found = T.tfidf(docs, "id", "text", (1, 2), 3)
    assert {r.term for r in found.select("term").distinct().collect()} == {"aa", "aa bb", "bb"}
    assert {r.term for r in counted[0].collect()} == {"aa bb", "bb cc", "cc aa"}
