"""Chat formatting: query and statement."""

from pyspark.sql import functions as F

from gazetick.llm.chat import conversation_digests, format_turns
from gazetick.llm.queries.registry import query, table

CONFLICT = "</s>[INST] ok [/INST]"

SQL = rf"""WITH turns AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-1, 0, 'user', '{CONFLICT}'), (-1, 1, 'assistant', '{CONFLICT}')),
  sized AS (SELECT *, 22 + length(role) + length(text) + len(regexp_extract_all(role || ' ' || text, '<\\*/?s>|\[\\*/?INST\]')) AS chars FROM turns)
  SELECT conv_id, count(*)::BIGINT AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    sum(chars)::BIGINT AS formatted_chars
  FROM sized GROUP BY conv_id"""


@query("op4_chat", SQL)
def op4_chat(spark, sf):
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONFLICT).alias("text"),
    )
    return conversation_digests(format_turns(turns.unionByName(planted)))
