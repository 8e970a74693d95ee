import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from gazetick.llm import mask_search as M

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def by_hand(docs, items, k=20):
    counted = [(d, Counter(terms(t))) for d, t in docs]
    counted = [(d, c) for d, c in counted if c]
    n, total = len(counted), sum(c.total() for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        scores = []
        for d, c in counted:
            m = 100 - 25 + (25 * c.total() * n) // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m)) for t in terms(text) if c[t])
            if s > 0:
                scores.append((-s, d is None, d if d is not None else 0))
        out += [(item, r + 1, None if null else d, -s) for r, (s, null, d) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=repr)


def corpus(rng, n):
    words = [f"w{int(rng.paretovariate(0.6)) % 4000}" for _ in range(2000)]
    text = lambda size: " ".join(rng.choice(words) for _ in range(size))
    docs = [(i, text(rng.choice([1, 5, 40, 200]))) for i in range(n)]
    docs += [(n, None), (n + 1, ""), (n + 2, ".,;"), (None, text(40)), (None, text(40)), (n + 3, docs[0][1]), (n + 4, docs[0][1]), (7, docs[7][1]),
             (n + 5, "Ünï-ÜNÏ w1\x00w2|W3 ſ K"), (n + 6, text(6000)), (n + 7, "x" * 3000)]
    rng.shuffle(docs)
    items = [(i, text(rng.choice([1, 3, 30]))) for i in range(25)] + [(90, text(150)), (91, None), (92, ""), (93, "nowhere"), (94, "w1 w1 W1 w1"), (95, docs[1][1]), (95, text(3)), (96, "ünï ſ k"), (None, "w2 w3")]
    return docs, items


@pytest.mark.parametrize("block,postings", [(8192, 2_000_000), (64, 2_000_000), (8192, 500)])
def test_against_all_scores(spark, monkeypatch, block, postings):
    monkeypatch.setattr(M, "BLOCK", block)
    monkeypatch.setattr(M, "BLOCK_POSTINGS", postings)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    rng = random.Random(block + postings)
    docs, items = corpus(rng, 600)
    d = spark.createDataFrame([(i, t, 1, 2) for i, t in docs], "doc_id long, text string, score int, _item int").repartition(3)
    q = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int")
    found = M.search(d, q)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted([tuple(r) for r in found.collect()], key=repr) == by_hand(docs, items)


def test_items_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(M, "ITEM_CHARACTERS", 700)
    docs, items = corpus(random.Random(8), 80)
    d, q = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert sorted([tuple(r) for r in M.search(d, q, k=3).collect()], key=repr) == by_hand(docs, items, 3)


def test_empty(spark):
    docs, items = corpus(random.Random(1), 12)
    d, q = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert M.search(d.limit(0), q).count() == 0
    assert M.search(d, q.limit(0)).count() == 0
    assert M.search(d.filter("text is null"), q).count() == 0


def test_slices():
    rng = random.Random(4)
    text = "".join(rng.choice(["a", "B", " ", "é", "日", "-", "9", "x" * 50]) for _ in range(5000))
    for size in (1, 2, 3, 50, 10_000):
        M.SLICE, kept = size, M.SLICE
        try:
            assert [t.decode() for part in M.term_slices(text) for t in part] == terms(text)
        finally:
            M.SLICE = kept


def test_stops_before_all(spark):
    """Few documents are evaluated where masks tell them apart."""
    rng = np.random.default_rng(3)
    n = 5000
    rare = rng.random(n) < 0.02
    sizes = 1 + rare.astype(int)
    terms = np.concatenate([[0, 1] if r else [0] for r in rare])
    block = M.Block(np.arange(n), np.zeros(n, np.int64), sizes, terms, np.full(len(terms), 400_000))
    best = M.Best(20)
    evaluated = block.search(np.array([0, 1]), np.array([100, 5000]), np.array([100, 5000]), best)
    assert evaluated == rare.sum() and best.rows[2].tolist() == np.flatnonzero(rare)[:20].tolist()


def test_statement(spark):
    import duckdb

    from gazetick.llm.queries.mask_search import SQL, op11_mask_search

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    want = con.sql(f"SELECT item_id, rank, doc_id, score FROM ({SQL})").fetchall()
    assert sorted(want) == sorted(tuple(r) for r in op11_mask_search(spark, sf).collect())
