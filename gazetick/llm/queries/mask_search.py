"""Ranked lexical search: query and statement."""

from gazetick.llm.mask_search import search
from gazetick.llm.queries.registry import query, table

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERMS = f"unnest(regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term"
SQL = f"""WITH words AS (SELECT doc_id, {_TERMS} FROM documents),
  held AS MATERIALIZED (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
  sizes AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM held GROUP BY doc_id),
  whole AS (SELECT count(*) AS docs, sum(n)::BIGINT AS l FROM sizes),
  norms AS (SELECT doc_id, 100 - 25 + (25 * n * docs) // l AS m FROM sizes, whole),
  weights AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
    FROM (SELECT term, count(*) AS df FROM held GROUP BY term), whole),
  asked AS (SELECT item_id, {_TERMS} FROM benchmark),
  scores AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
    FROM asked JOIN weights USING (term) JOIN held USING (term) JOIN norms USING (doc_id) GROUP BY ALL),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank FROM scores WHERE score > 0)
  SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20"""


@query("op11_mask_search", SQL)
def op11_mask_search(spark, sf):
    return search(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
