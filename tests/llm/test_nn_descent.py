import random

import numpy as np
import pytest

from gazetick.llm import nn_descent as N

SCHEMA = "vec_id long, embedding array<float>, n_links string, root int"


def by_hand(rows, threshold=0.95):
    good = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    width = max((len(v) for _, v in good), default=1)
    units = np.array([np.pad(v, (0, width - len(v))) / np.linalg.norm(v) for _, v in good]).reshape(len(good), width)
    near = units @ units.T >= threshold
    ids = [i for i, _ in good]
    root = {i: i for i, _ in rows}
    links = {i: 0 for i, _ in rows}
    changed = True
    for a, i in enumerate(ids):
        links[i] = int(near[a].sum()) - 1
    while changed:
        changed = False
        for a, i in enumerate(ids):
            least = min(root[ids[b]] for b in np.flatnonzero(near[a]))
            if least < root[i]:
                root[i], changed = least, True
    return {i: (links[i], root[i]) for i, _ in rows}


def around(rng, centre, angle):
    noise = rng.normal(size=len(centre))
    noise -= noise @ centre * centre
    return (np.cos(angle) * centre + np.sin(angle) * noise / np.linalg.norm(noise)) * rng.uniform(0.5, 3)


def corpus(seed, width=24):
    rng = np.random.default_rng(seed)
    rows, pick = [], random.Random(seed)
    for size in (1, 1, 2, 3, 40, 130, *[1] * 120, *[2] * 30):
        centre = rng.normal(size=width)
        centre /= np.linalg.norm(centre)
        for _ in range(size):
            rows.append(around(rng, centre, rng.uniform(0, 0.22)).tolist())
    rows += [rows[5], rows[5], rows[100], rows[100]]
    ids = pick.sample(range(10**6), len(rows))
    rows = [(i, v) for i, v in zip(ids, rows)]
    odd = [(-1, None), (-2, []), (-3, [0.0] * width), (-4, [float("nan")] * width), (-5, [1.0] * (width - 1) + [float("inf")]), (-6, [None] * width), (-7, [1.0, 2.0]), (-8, [2.0, 4.0] + [0.0] * (width - 2)), (-9, [3e30] * width)]
    return rows + odd


@pytest.mark.parametrize("block", [1024, 32])
def test_links_and_classes(spark, monkeypatch, block):
    monkeypatch.setattr(N, "BLOCK", block)
    monkeypatch.setattr(N, "STREAM", 2 * block)
    rows = corpus(block)
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    got = {r.id: (r.n_links, r.root) for r in N.near_duplicates(frame).collect()}
    assert got == by_hand(rows)


def test_few_rows(spark):
    assert N.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    one = spark.createDataFrame([(4, None, "x", 1), (7, [1.0], "x", 1)], SCHEMA)
    assert sorted(map(tuple, N.near_duplicates(one).collect())) == [(4, 0, 4), (7, 0, 7)]
    copies = spark.createDataFrame([(i, [1.0, 2.0], "x", 1) for i in (9, 4, 7)], SCHEMA)
    assert sorted(map(tuple, N.near_duplicates(copies).collect())) == [(4, 2, 4), (7, 2, 4), (9, 2, 4)]


def test_audit_sees_what_is_missing(spark):
    rows = corpus(5)
    frame = spark.createDataFrame([(i, v, 1) for i, v in rows if i >= 0], "id long, v array<float>, copies long")
    classes = frame.selectExpr("id", "id as root", "false as full")
    none = spark.createDataFrame([], "a long, b long")
    recall, judged = N.audit(frame, classes, none, 24, 0.95)
    assert recall == 0.0 and judged > 100
    assert N.audit(frame.limit(1), classes, none, 24, 0.95) == (1.0, 0)


def nothing(points, n, width, threshold, k, seed, rounds):
    spark = points.sparkSession
    return spark.createDataFrame([], "a long, b long, cosine double, fresh boolean"), spark.createDataFrame([], "a long, b long")


def test_the_audit_is_no_part_of_the_result(spark, monkeypatch):
    frame = spark.createDataFrame([(*r, "x", 1) for r in corpus(8)], SCHEMA)
    monkeypatch.setattr(N, "search", nothing)
    monkeypatch.setattr(N, "ATTEMPTS", 1)
    with pytest.raises(RuntimeError, match="recall 0.0000"):
        N.near_duplicates(frame)


def planted(n, pairs, width=64):
    """Random vectors, and ``pairs`` more at cosines of 0.951 to 0.96 from one of them each."""
    rng = np.random.default_rng(11)
    vectors = rng.normal(size=(n, width))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    extra = [around(rng, vectors[i], np.arccos(rng.uniform(0.951, 0.96))) for i in range(pairs)]
    return np.concatenate([vectors, extra]).astype(np.float32), {(i, n + i) for i in range(pairs)}


def test_search_alone_finds_few_links_among_many_vectors(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    vectors, want = planted(40_000, 400)
    column = pa.ListArray.from_arrays(pa.array(np.arange(len(vectors) + 1, dtype=np.int32) * 64), pa.array(vectors.ravel()))
    pq.write_table(pa.table({"id": pa.array(np.arange(len(vectors))), "v": column}), tmp_path / "points.parquet")
    points = spark.read.parquet(str(tmp_path / "points.parquet")).repartition(8)
    _, links = N.search(points, len(vectors), 64, 0.95, N.NEIGHBOURS, 1, N.ROUNDS)
    got = {(min(r), max(r)) for r in map(tuple, links.distinct().collect())}
    assert got <= want and len(got) >= 0.99 * len(want)


def test_a_saturated_vector_meets_its_component(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK", 4)
    monkeypatch.setattr(N, "STREAM", 6)
    rng = np.random.default_rng(2)
    rows = [(i, [*map(float, v)], 1 + i % 3, 7, i % 5 == 0, 6, 30) for i, v in enumerate(rng.normal(size=(30, 2)))]
    frame = spark.createDataFrame(rows, "id long, v array<double>, copies long, root long, full boolean, saturated long, members long")
    units = np.array([r[1] for r in rows]) / np.linalg.norm([r[1] for r in rows], axis=1, keepdims=True)
    near = (units @ units.T >= 0.9) & ~np.eye(30, dtype=bool)
    copies, full = np.array([r[2] for r in rows]), np.array([r[4] for r in rows])
    want = np.where(full, near @ copies, (near & full[None, :]) @ copies)
    assert {r.id: r.n for r in N.enlarged_counts(frame, 2, 0.9).collect()} == dict(enumerate(want.tolist()))


def test_orders_grow_with_the_logarithm():
    counts = [N.orders_needed(10**p, 0.95) for p in range(0, 10)]
    assert counts == sorted(counts) and counts[0] == N.ORDERS and counts[-1] < 100


def test_rows_without_an_id(spark):
    rows = [(7, [1.0, 2.0]), (None, [1.0, 2.0]), (4, [1.0, 2.1]), (None, [5.0, -1.0]), (None, None)]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    got = sorted(map(tuple, N.near_duplicates(frame).collect()), key=str)
    assert got == sorted([(7, 1, 4), (4, 1, 4), (None, 0, None), (None, 0, None), (None, 0, None)], key=str)
