"""What a step sends, holds or writes, on rows small enough to look at."""

import numpy as np
import pyspark.sql.functions as F
import pytest

from gazetick.operators import cluster as C
from gazetick.operators import textfeatures as T
from gazetick.plans import lookup
from gazetick.session import stage


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_large_lookup_tables_are_not_broadcast(spark, monkeypatch):
    table = stage(spark.createDataFrame([(f"k{i}", i) for i in range(50)], "k string, v int"))
    rows = stage(spark.createDataFrame([(f"k{i % 60}", i) for i in range(300)], "k string, id int"))
    for bound, broadcast in ((100, True), (10, False)):
        monkeypatch.setattr(lookup, "BROADCAST_TERMS", bound)
        joined = lookup.lookup_join(rows, table, ["k"], F.col("id"), "left")
        assert ("BroadcastExchange" in plan(joined)) == broadcast
        assert sorted((r.id, r.v) for r in joined.collect() if r.v is not None) == [(i, i % 60) for i in range(300) if i % 60 < 50]


def test_vocabulary_sorts_no_occurrence(spark):
    rows = [(7, "b a b"), (-3, "c a"), (7, "d b"), (2**62, "e e"), (5, None), (6, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    made = T.build_vocab(docs, "doc_id", F.split("text", " "), 1)
    # First by id, then by place; the two rows of id 7 are one document, "b" before "d" is a tie that either may win.
    found = {r.token: r.id for r in made.collect()}
    assert found["c"] == 2 and found["a"] == 3 and found[""] == 4 and {found["b"], found["d"]} == {5, 6} and found["e"] == 7
    assert "SortAggregate" not in plan(made)


def test_rounds_skip_the_inertia(spark):
    points = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(20)], "id long, x array<double>")
    centers = [np.array([[0.0, 1.0], [19.0, 1.0]]), np.array([[5.0, 1.0]])]
    with_cost, without = C.kmeans_scan(points, centers, cost=True), C.kmeans_scan(points, centers)
    assert (without[2] == 0).all() and (with_cost[2] > 0).all()
    assert all((a == b).all() for k in (0, 1) for a, b in zip(with_cost[k], without[k], strict=True))


def test_silhouette_sends_rows_to_a_fixed_number_of_tiles(spark, monkeypatch):
    assert [-(-n // C.silhouette_tile(n, 64, 10)) for n in (2_000, 50_000, 600_000)] == [1, 16, 16]
    assert C.silhouette_tile(10**7, 64, 10) == 65_536 and C.silhouette_tile(10**7, 64, 1000) == 2_097
    rng = np.random.default_rng(1)
    x, label = rng.normal(size=(70, 3)), rng.integers(0, 4, 70)
    rows = spark.createDataFrame([(i, [float(v) for v in x[i]], int(label[i])) for i in range(70)], "id long, x array<double>, label int")
    monkeypatch.setattr(C, "TILE_ROWS", 6)
    monkeypatch.setattr(C, "SIDE", 3)
    found = {r.id: r.silhouette for r in C.silhouette_rows(rows, "id", "x", "label").collect()}
    gap = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    for i in range(70):
        mean = [gap[i, label == k].sum() / ((label == k).sum() - (k == label[i])) for k in range(4)]
        a, b = mean[label[i]], min(m for k, m in enumerate(mean) if k != label[i])
        assert abs(found[i] - (b - a) / max(a, b)) < 1e-9
