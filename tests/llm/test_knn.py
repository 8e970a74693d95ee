import math
import random

import numpy as np
from pyspark.sql import functions as F

from gazetick.llm import knn as K

SCHEMA = "vec_id long, embedding array<float>, score int, cell string"


def by_hand(rows, k, every, scale=64.0):
    good = {i: [math.floor(scale * x) for x in np.float32(v).astype(float).tolist()] for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for q, a in good.items():
        if q % every == 0:
            scores = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in good.items() if i != q)
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return sorted(out)


def vectors(seed, n=260, width=6):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        v = [rng.gauss(0, 1) for _ in range(width)]
        rows.append((i, v))
        if i % 9 == 0:
            rows.append((1000 + i, v))
    rows += [(2000, None), (2001, []), (2002, [1.0, None] + v[2:]), (2003, [float("nan")] + v[1:]), (2004, [float("inf")] + v[1:]), (2005, [0.0] * width), (2010, v[:3]), (2020, [0.25] * width)]
    return rows


def run(spark, rows, k, every):
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    return sorted(tuple(r) for r in K.top_k(frame, F.col("vec_id") % every == 0, k).collect())


def test_exact(spark, monkeypatch):
    rows = vectors(1)
    want = by_hand(rows, 7, 5)
    assert run(spark, rows, 7, 5) == want
    monkeypatch.setattr(K, "ROWS_PER_PIVOT", 20)
    assert run(spark, rows, 7, 5) == want
    monkeypatch.setattr(K, "BLOCK", 16)
    assert run(spark, rows, 7, 5) == want
    monkeypatch.setattr(K, "BLOCK", 2)
    monkeypatch.setattr(K, "PARTS", 3)
    assert run(spark, rows, 7, 2) == by_hand(rows, 7, 2)


def test_clustered_data_skips_groups(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(i, [(50.0 if i % 4 == axis else 0.0) + rng.random() for axis in range(4)]) for i in range(200)]
    monkeypatch.setattr(K, "ROWS_PER_PIVOT", 10)
    assert run(spark, rows, 5, 10) == by_hand(rows, 5, 10)
    groups = K.Groups(np.array([[100.0, 0], [0, 100.0]]))
    groups.radius, groups.blocks = np.array([2.0, 2.0]), np.array([1, 1])
    cells, need = groups.needed(np.array([100, 0]), 9000)
    assert cells.tolist() == [0] and np.allclose(need, -10)


def test_data_goes_only_where_queries_need_it(spark, monkeypatch):
    monkeypatch.setattr(K, "BLOCK", 8)
    groups = K.Groups(np.array([[10.0, 0], [0, 10.0], [-10.0, 0]]))
    groups.radius, groups.blocks = np.array([4.0, 4.0, 4.0]), np.array([2, 2, 2])
    rows = [(cell * 100 + i, [0, 0], cell, i / 4) for cell in range(3) for i in range(16)]
    placed = spark.createDataFrame(rows, "id long, v array<long>, cell int, apart double")

    def sent(asked):
        asked = spark.createDataFrame(asked, "id long, v array<long>, least long, cell int, need double")
        found = K.units(placed, asked, groups).collect()
        return sorted((r.id, r.part) for r in found if not r.is_query), sum(r.is_query for r in found)

    # Eight queries of one cell fill one part; rows nearer to the pivot than any of them needs stay.
    few = [(1000 + i, [1, 0], 5, 0, 2.0 + i) for i in range(8)]
    assert sent(few) == ([(i, 0) for i in range(8, 16)], 16)
    # Five times as many in that cell split that cell alone; the cell that none needs sends nothing.
    many = [(1000 + i, [1, 0], 5, 0, -1.0) for i in range(40)] + [(1, [0, 1], 5, 1, 3.75)]
    data, asked = sent(many)
    assert data == sorted([(i, part) for i in range(16) for part in range(5)] + [(115, 0)]) and asked == 82
    monkeypatch.setattr(K, "PARTS", 2)
    assert len(sent(many)[0]) == 2 * 16 + 1


def test_few_rows(spark):
    assert run(spark, [], 5, 1) == []
    assert run(spark, [(0, None)], 5, 1) == []
    assert run(spark, [(0, [1.0])], 5, 1) == []
    assert run(spark, [(0, [1.0]), (1, [1.0]), (3, [1.0])], 5, 3) == [(0, 1, 1, 4096), (0, 2, 3, 4096), (3, 1, 0, 4096), (3, 2, 1, 4096)]


def test_large_components_stay_exact():
    big = np.array([[2**40 + 1, 3]])
    assert K.products(big, np.array([[2**20 + 1, 5]])).tolist() == [[(2**40 + 1) * (2**20 + 1) + 15]]


def test_rows_without_an_id(spark):
    rows = vectors(2, n=40)
    want = by_hand(rows, 5, 5)
    assert run(spark, rows + [(None, rows[0][1]), (None, rows[3][1]), (None, None)], 5, 5) == want
