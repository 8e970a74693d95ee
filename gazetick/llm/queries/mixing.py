"""Mixing sources to target weights: query and statement."""

from pyspark.sql import functions as F

from gazetick.llm.mixing import mix_plan
from gazetick.llm.queries.registry import query, table

# The limits bind in the order of size over weight, so the number of bound sources follows from running sums.
SQL = r"""WITH sized AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
  sources AS (SELECT source, sum(size)::BIGINT AS s FROM sized GROUP BY source),
  weighted AS (SELECT *, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INTEGER AS w FROM sources),
  ordered AS (SELECT *, row_number() OVER (ORDER BY s::DOUBLE / w, source) AS k FROM weighted),
  sums AS (SELECT *, sum(s) OVER () AS total, sum(w) OVER () AS all_w, coalesce(sum(s) OVER before, 0) AS s0, coalesce(sum(w) OVER before, 0) AS w0
    FROM ordered WINDOW before AS (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
  units AS (SELECT *, (total::DOUBLE - 3.0::DOUBLE * s0::DOUBLE) / (all_w - w0)::DOUBLE AS unit FROM sums),
  unit AS (SELECT arg_min(unit, k) AS unit FROM units WHERE w * unit <= 3.0::DOUBLE * s),
  rates AS (SELECT source, s, least(w::DOUBLE * (SELECT unit FROM unit), 3.0::DOUBLE * s) AS target FROM weighted),
  joined AS (SELECT doc_id, size, s, target, coalesce(target / nullif(s, 0), 0.0::DOUBLE) AS rate,
      ('0x' || left(sha256('20:' || coalesce(doc_id::VARCHAR, '')), 13))::BIGINT / 4503599627370496.0::DOUBLE AS u
    FROM sized JOIN rates ON sized.source IS NOT DISTINCT FROM rates.source)
  SELECT doc_id, size, s AS source_size, target, (size * (floor(rate) + (u < rate - floor(rate))::INTEGER))::BIGINT AS taken FROM joined"""


@query("op10_mixing", SQL)
def op10_mixing(spark, sf):
    """What the mix takes of every document; words are the tokens."""
    docs = table(spark, sf, "documents").select("doc_id", "text", "source")
    return mix_plan(docs).select(
        "doc_id", F.col("_mix_size").alias("size"), F.col("_mix_source_size").alias("source_size"),
        F.col("_mix_target").alias("target"), (F.col("_mix_size") * F.col("_mix_copies")).alias("taken"),
    )
