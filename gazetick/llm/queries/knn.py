"""Exact top-k search: query and statement."""

from pyspark.sql import functions as F

from gazetick.llm.knn import top_k
from gazetick.llm.queries.registry import query, table

SQL = """WITH whole AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
  scores AS (SELECT q.vec_id AS query_id, d.vec_id, list_dot_product(q.v::DOUBLE[], d.v::DOUBLE[])::BIGINT AS score
    FROM whole q JOIN whole d ON q.vec_id % 20 = 0 AND q.vec_id <> d.vec_id),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scores)
  SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20"""


@query("op6_voronoi_knn", SQL)
def op6_voronoi_knn(spark, sf):
    vectors = table(spark, sf, "embeddings").select("vec_id", "embedding")
    found = top_k(vectors, F.col("vec_id") % 20 == 0, k=20)
    return found.withColumnRenamed("id", "vec_id")
