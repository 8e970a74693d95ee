"""Many k-means models in shared scans equal a plain Lloyd from the same starts."""

import numpy as np

from gazetick.operators import cluster as C

SF = "/root/testdata/sf0.001"


def frame(spark, x):
    return spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "id long, v array<double>").repartition(4)


def plain_lloyd(x, centers, tol=1e-4, max_iter=300):
    centers, rounds = centers.copy(), 0
    for _ in range(max_iter):
        rounds += 1
        near = ((x[:, None] - centers[None]) ** 2).sum(2).argmin(1)
        new = np.array([x[near == j].mean(0) if (near == j).any() else centers[j] for j in range(len(centers))])
        moved = ((new - centers) ** 2).sum(1).max()
        centers = new
        if moved <= tol * tol:
            break
    return centers, ((x[:, None] - centers[None]) ** 2).sum(2).min(1).sum(), rounds


def test_equals_plain_lloyd(spark, monkeypatch):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 6)) + 3 * rng.normal(size=(5, 6))[rng.integers(0, 5, 400)]
    df = frame(spark, x)
    points, models = C._usable_points(df, "id", "v"), [(k, start) for k in range(2, 6) for start in range(3)]
    starts = C.seed_centers(points, models, 42)
    for (k, _), c in zip(models, starts, strict=True):
        assert len({tuple(row) for row in c}) == k and all((np.abs(x - row).max(1) < 1e-12).any() for row in c)
    scans, plain_scan = [], C.kmeans_scan
    monkeypatch.setattr(C, "kmeans_scan", lambda *a: scans.append(1) or plain_scan(*a))
    fits = C.kmeans_many(df, "id", "v", range(2, 6), n_init=3)
    want = [plain_lloyd(x, c) for c in starts]
    assert len(scans) == max(r for _, _, r in want) + 1
    for fit in fits:
        mine = [w for (k, _), w in zip(models, want, strict=True) if k == fit.k]
        assert abs(fit.cost - min(c for _, c, _ in mine)) < 1e-8 * fit.cost
        assert np.allclose(fit.centers, mine[fit.start][0])


def test_seeds_follow_squared_distance(spark):
    """Two far groups of 50 and one row between them: the second centre is nearly always in the other group."""
    x = np.concatenate([np.zeros((50, 2)), np.full((50, 2), 10.0), [[0.1, 0.0]]])
    seeds = C.seed_centers(C._usable_points(frame(spark, x), "id", "v"), [(2, i) for i in range(40)], 1)
    assert sum(abs(c[0, 1] - c[1, 1]) == 10 for c in seeds) >= 38
    assert 8 < sum(c[0, 1] == 10 for c in seeds) < 32


def test_odd_rows(spark):
    df = spark.createDataFrame([(1, [1.0]), (2, [1.0]), (3, None), (4, [float("nan")])], "id long, v array<double>")
    fit = C.kmeans_many(df, "id", "v", [3], n_init=2)[0]
    assert fit.cost == 0 and fit.centers.tolist() == [[1.0]] * 3
    assert C.kmeans_many(df.limit(0), "id", "v", [2]) == []
    assert C.kmeans_elbow(df.limit(0), "id", "v").count() == 0


def test_registered_queries(spark):
    from gazetick.queries import cluster_queries as Q

    x = np.array([r.x for r in Q.vectors(spark, SF).orderBy("vec_id").collect()])
    elbow = {r.k: r.inertia for r in Q.kmeans_elbow(spark, SF).collect()}
    assert sorted(elbow) == list(range(2, 11)) and all(elbow[k] > elbow[k + 1] for k in range(2, 10))
    labels = np.array([r.cluster for r in Q.kmeans(spark, SF).orderBy("vec_id").collect()])
    centers = np.array([x[labels == c].mean(0) for c in range(4)])
    gaps = ((x[:, None] - centers[None]) ** 2).sum(2)
    assert (gaps.argmin(1) == labels).mean() > 0.99 and abs(gaps.min(1).sum() / elbow[4] - 1) < 1e-3
