"""Truncated SVD, k-means, Ward, DBSCAN, silhouettes and their comparison over the embeddings."""

from __future__ import annotations

from pyspark.sql import functions as F

from gazetick.operators import cluster as C
from gazetick.operators.profile import cluster_summary
from gazetick.operators.reduce import truncated_svd
from gazetick.operators.scaling import scale_vector
from gazetick.queries.feature_queries import TFIDF, sparse
from gazetick.queries.registry import query, r6, sql_r6, table
from gazetick.session import stage

EPS, WIDER = 1.15, 1.18


def vectors(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("x"), "label")


POINTS = "points AS MATERIALIZED (SELECT vec_id, embedding::DOUBLE[] AS x, label FROM embeddings)"


@query("truncated_svd")
def svd(spark, sf):
    """Every document in 100 dimensions; SQL has no SVD, tests compare with NumPy's."""
    rows, width = sparse(spark, sf, TFIDF["tfidf_topics"])
    return truncated_svd(rows, "doc_id", width, 100)


@query(
    "scale_vector",
    f"""WITH places AS (SELECT vec_id, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS i FROM embeddings),
    scaled AS (SELECT vec_id, i, (v - avg(v) OVER (PARTITION BY i)) / stddev_pop(v) OVER (PARTITION BY i) AS v FROM places)
    SELECT vec_id, {sql_r6("sum(v * i)")} AS total FROM scaled GROUP BY vec_id""",
)
def scale_query(spark, sf):
    """All 64 columns scaled; a sum weighted by the column's place."""
    scaled = scale_vector(vectors(spark, sf), "x", 64)
    total = F.aggregate(F.transform("scaled", lambda v, i: v * (i + 1)), F.lit(0.0), lambda s, v: s + v)
    return scaled.select("vec_id", r6(total).alias("total"))


@query(
    "nearest_center",
    f"""WITH {POINTS}, places AS (SELECT vec_id, label, unnest(x) AS v, generate_subscripts(x, 1) AS i FROM points),
    means AS (SELECT label, i, avg(v) AS m FROM places GROUP BY label, i),
    gaps AS (SELECT vec_id, m.label AS cluster, sum((v - m) * (v - m)) AS d FROM places p JOIN means m USING (i) GROUP BY vec_id, m.label)
    SELECT vec_id, arg_min(cluster, d)::INTEGER AS cluster FROM gaps GROUP BY vec_id""",
)
def nearest_center(spark, sf):
    """Label means as centres."""
    points = vectors(spark, sf)
    places = points.select("label", F.posexplode("x").alias("i", "v")).groupBy("label", "i").agg(F.avg("v").alias("m"))
    centers = places.groupBy("label").agg(F.array_sort(F.collect_list(F.struct("i", "m"))).alias("p"))
    centers = centers.select(F.col("label").alias("cluster"), F.transform("p", lambda p: p["m"]).alias("center"))
    return C.nearest_center(points, "x", centers).select("vec_id", "cluster")


def sql_dbscan(eps: float, name: str = "dbscan") -> str:
    return f"""{POINTS},
    near AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM points a JOIN points b ON list_distance(a.x, b.x) <= {eps}::DOUBLE),
    core AS MATERIALIZED (SELECT a AS id FROM near GROUP BY a HAVING count(*) >= 5),
    linked AS MATERIALIZED (SELECT a, b FROM near WHERE a IN (SELECT id FROM core) AND b IN (SELECT id FROM core)),
    reach AS (SELECT id AS a, id AS b FROM core UNION SELECT reach.a, linked.b FROM reach JOIN linked ON linked.a = reach.b),
    roots AS (SELECT a AS id, min(b) AS root FROM reach GROUP BY a),
    numbers AS (SELECT root, row_number() OVER (ORDER BY root) - 1 AS cluster FROM (SELECT DISTINCT root FROM roots)),
    border AS (SELECT a AS id, min(root) AS root FROM near JOIN roots ON roots.id = near.b WHERE a NOT IN (SELECT id FROM core) GROUP BY a),
    {name} AS (SELECT vec_id, coalesce(cluster, -1)::INTEGER AS cluster FROM points
      LEFT JOIN (SELECT * FROM roots UNION ALL SELECT * FROM border) r ON r.id = vec_id LEFT JOIN numbers USING (root))"""


def dbscan(spark, sf, eps=EPS):
    return C.dbscan(vectors(spark, sf), "vec_id", "x", eps=eps, min_samples=5)


@query("dbscan", f"WITH RECURSIVE {sql_dbscan(EPS)} SELECT * FROM dbscan")
def dbscan_query(spark, sf):
    return dbscan(spark, sf).select("vec_id", "cluster")


@query("dbscan_wider", f"WITH RECURSIVE {sql_dbscan(WIDER)} SELECT * FROM dbscan")
def dbscan_wider(spark, sf):
    return dbscan(spark, sf, WIDER).select("vec_id", "cluster")


@query(
    "cluster_summary",
    f"""WITH RECURSIVE {sql_dbscan(EPS)} SELECT cluster, count(*) AS size, (SELECT count(DISTINCT cluster) FROM dbscan WHERE cluster <> -1) AS n_clusters,
      (SELECT count(*) FROM dbscan WHERE cluster = -1) AS n_noise FROM dbscan GROUP BY cluster""",
)
def cluster_summary_query(spark, sf):
    return cluster_summary(stage(dbscan(spark, sf)))


SILHOUETTE = f"""{POINTS}, d AS (SELECT a.vec_id, a.label, b.label AS other, sum({{gap}}) AS s, count(*) AS n
      FROM points a JOIN points b ON true GROUP BY a.vec_id, a.label, b.label),
    ab AS (SELECT vec_id, max(CASE WHEN label = other THEN s / nullif(n - 1, 0) END) AS a, min(CASE WHEN label <> other THEN s / n END) AS b FROM d GROUP BY vec_id),
    s AS (SELECT vec_id, coalesce((b - a) / nullif(greatest(a, b), 0), 0) AS silhouette FROM ab)"""


@query("silhouette", f"WITH {SILHOUETTE.format(gap='CASE WHEN a.vec_id = b.vec_id THEN 0 ELSE list_distance(a.x, b.x) END')} SELECT {sql_r6('avg(silhouette)')} AS silhouette FROM s")
def silhouette(spark, sf):
    return C.silhouette(vectors(spark, sf), "vec_id", "x", "label").select(r6("silhouette").alias("silhouette"))


@query("silhouette_squared", f"WITH {SILHOUETTE.format(gap='list_distance(a.x, b.x) ** 2')} SELECT {sql_r6('avg(silhouette)')} AS silhouette_squared FROM s")
def silhouette_squared(spark, sf):
    return C.silhouette_squared(vectors(spark, sf), "x", "label").select(r6("silhouette_squared").alias("silhouette_squared"))


@query("cluster_members", f"WITH RECURSIVE {sql_dbscan(EPS)} SELECT cluster, vec_id FROM dbscan WHERE cluster <> -1 QUALIFY row_number() OVER (PARTITION BY cluster ORDER BY vec_id) <= 15")
def cluster_members(spark, sf):
    """The first fifteen rows of each cluster, as the reference lists them."""
    from gazetick.operators.ordering import top_n_per_group

    found = stage(dbscan(spark, sf).select("cluster", "vec_id")).filter("cluster <> -1")
    return top_n_per_group(found, ["cluster"], ["vec_id"], 15)


@query("kmeans")
def kmeans(spark, sf):
    return C.kmeans(vectors(spark, sf), "vec_id", "x", k=4).select("vec_id", "cluster")


@query("kmeans_elbow")
def kmeans_elbow(spark, sf):
    return C.kmeans_elbow(vectors(spark, sf), "vec_id", "x", ks=range(2, 11), n_init=10)


@query("ward")
def ward(spark, sf):
    """Exact Ward over all rows, cut at two clusters as the reference does; tests compare with one merge at a time."""
    return C.ward_cluster(vectors(spark, sf), "vec_id", "x", k=2).select("vec_id", "cluster")


@query("ward_of_groups")
def ward_of_groups(spark, sf):
    """Ward over 1,000 k-means groups of all rows."""
    return C.ward_of_groups(vectors(spark, sf), "vec_id", "x", k=4).select("vec_id", "cluster")


@query("model_comparison")
def model_comparison(spark, sf):
    """Silhouettes of three models; one with a single cluster would be left out."""
    points = vectors(spark, sf)
    labelled = {
        "K-Means": C.kmeans(points, "vec_id", "x", k=4),
        "Ward": C.ward_cluster(points, "vec_id", "x", k=2),
        "DBSCAN": C.dbscan(points, "vec_id", "x", eps=EPS, min_samples=5),
    }
    return C.model_comparison({name: C.silhouette(stage(df), "vec_id", "x", "cluster", noise=-1) for name, df in labelled.items()})
