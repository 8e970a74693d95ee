"""Sparse rows, naive Bayes and the products of the SVD: what is counted where it is."""

import math

import numpy as np
import pyarrow as pa
import pytest

from gazetick.operators import models as M
from gazetick.operators import reduce as R
from gazetick.operators import textfeatures as T


def test_one_row_a_document_is_shuffled(spark):
    """Weights side by side leave their task as one row; those apart are put together."""
    entries = [(d, t, float(d + t)) for d in range(20) for t in (4, 0, 9)]
    side = spark.createDataFrame(entries, "id long, idx int, val double").coalesce(1)
    found = T.packed_runs(side, "id").collect()
    assert sorted((r.id, r.idx, r.val) for r in found) == [(d, [0, 4, 9], [d + 0.0, d + 4.0, d + 9.0]) for d in range(20)]
    weights = spark.createDataFrame([*[(d, f"t{t}", v) for d, t, v in entries[::2] + entries[1::2]], (None, "t4", 1.0)], "id long, term string, weight double")
    index = spark.createDataFrame([(f"t{t}", t) for t in (0, 4, 9)], "term string, idx int")
    docs = spark.createDataFrame([(d,) for d in [*range(21), 3, None]], "id long")
    rows = sorted(((r.id, r.idx, r.val) for r in T.sparse_rows(weights.coalesce(1), index, "id", docs).collect()), key=str)
    whole = [(d, [0, 4, 9], [d + 0.0, d + 4.0, d + 9.0]) for d in [*range(20), 3]]
    assert rows == sorted([*whole, (20, [], []), (None, [], [])], key=str)


def bayes_rows():
    rng = np.random.default_rng(4)
    rows = []
    for i in range(60):
        at = np.flatnonzero(rng.random(12) < 0.3)
        rows.append((i, [int(a) for a in at], [float(v) for v in rng.random(len(at))], None if i % 5 == 4 else int(rng.integers(0, 3)) * 2))
    return [*rows, rows[3], (None, [1, 2], [0.5, 0.25], None), (99, [], [], None)]


SPARSE = "doc_id long, idx array<int>, val array<double>, label_idx int"


@pytest.mark.parametrize("labels", [(0, 2, 4), (4,), ()])
def test_naive_bayes_both_ways(spark, monkeypatch, labels):
    """Gains added up where a row is are those of a join by term, also for ids that repeat or are missing."""
    rows = [r if r[3] in labels else (*r[:3], None) for r in bayes_rows()]
    df = spark.createDataFrame(rows, SPARSE)
    train = df.filter("label_idx is not null")
    asked, join = [], M.lookup_join
    monkeypatch.setattr(M, "lookup_join", lambda *a: asked.append(1) or join(*a))
    found = {r.doc_id: (r.prediction, r.score) for r in M.multinomial_nb(train, df, "doc_id", "label_idx", 12).collect()}
    if labels:
        assert not asked
    monkeypatch.setattr(M, "GAIN_CELLS", 0)
    joined = {r.doc_id: (r.prediction, r.score) for r in M.multinomial_nb(train, df, "doc_id", "label_idx", 12).collect()}
    assert asked and set(found) == set(joined) and len(found) == (62 if labels else 0)
    assert all(found[i][0] == joined[i][0] and found[i][1] == pytest.approx(joined[i][1]) for i in found)
    if labels == (0, 2, 4):
        known = [r for r in rows if r[3] is not None]
        sums = {c: np.zeros(12) for c in labels}
        for r in known:
            sums[r[3]][r[1]] += r[2]
        score = {c: math.log(sum(r[3] == c for r in known) / len(known)) + float(np.log((s + 1) / (s.sum() + 12))[rows[7][1]] @ rows[7][2]) for c, s in sums.items()}
        assert found[7] == (max(score, key=score.get), pytest.approx(max(score.values())))


def test_vectors_are_written_once(spark, monkeypatch):
    """A classifier's rows are written as vectors alone, and not again with their weights."""
    made, stage = [], M.stage
    monkeypatch.setattr(M, "stage", lambda df, *a: made.append(df.columns) or stage(df, *a))
    df = spark.createDataFrame([r for r in bayes_rows() if r[0] is not None], SPARSE)
    M.logistic_regression(M.to_vectors(df, 12).filter("label_idx is not null"))
    assert made == [["doc_id", "label_idx", "features"]]


def test_dense_blocks_are_bounded(monkeypatch):
    rng = np.random.default_rng(8)
    x = np.where(rng.random((50, 30)) < 0.2, rng.normal(size=(50, 30)), 0.0)
    x[[0, 20, 49]] = 0
    at = [np.flatnonzero(r) for r in x]
    batch = pa.RecordBatch.from_arrays([pa.array([a.tolist() for a in at], pa.list_(pa.int32())), pa.array([r[a].tolist() for r, a in zip(x, at)], pa.list_(pa.float64()))], ["idx", "val"])
    for most in (5, 100, 1 << 22):
        monkeypatch.setattr(R, "DENSE_CELLS", most)
        blocks = list(R._dense(batch))
        assert all(b.size <= most or len(b) == 1 for _, b in blocks)
        whole = np.zeros((50, 30))
        ends = np.cumsum([0, *(len(b) for _, b in blocks)])
        for a, (terms, b) in zip(ends, blocks):
            whole[a : a + len(b), terms] = b
        assert (whole == x).all() and len(blocks) <= {5: 50, 100: 25, 1 << 22: 1}[most]


def test_a_run_goes_on_in_the_next_batch(spark):
    """A document whose weights are cut by the end of a batch is still one row."""
    entries = [(d, t, float(d + t)) for d in range(6) for t in (4, 0, 9)]
    side = spark.createDataFrame(entries, "id long, idx int, val double").coalesce(1)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    try:
        for rows in ("1", "4"):
            spark.conf.set(name, rows)
            found = T.packed_runs(side, "id").collect()
            assert sorted((r.id, r.idx, r.val) for r in found) == [(d, [0, 4, 9], [d + 0.0, d + 4.0, d + 9.0]) for d in range(6)]
    finally:
        spark.conf.set(name, before)
