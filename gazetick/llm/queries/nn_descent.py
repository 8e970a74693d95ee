"""Embedding near-dedup: query and statement."""

from pyspark.sql import functions as F

from gazetick.llm.nn_descent import near_duplicates
from gazetick.llm.queries.registry import query, table

SQL = """WITH RECURSIVE good AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
  links AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.95),
  reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
  roots AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
  counts AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
  SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept FROM roots LEFT JOIN counts USING (vec_id)"""


@query("op1_nn_descent", SQL)
def op1_nn_descent(spark, sf):
    found = near_duplicates(table(spark, sf, "embeddings").select("vec_id", "embedding"))
    return found.select(F.col("id").alias("vec_id"), "n_links", F.col("root").alias("component_id"), (F.col("id") == F.col("root")).alias("kept"))
