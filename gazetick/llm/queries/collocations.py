"""Phrase collocation mining: query and statement."""

from gazetick.llm.collocations import collocations
from gazetick.llm.queries.registry import query, table

# The statement numbers words, so that phrases of up to four words are rows of their own; sums are HUGEINT.
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_GRAMS = " UNION ALL ".join(f"SELECT lang, list_slice(w, i, i + {m - 1}) AS g FROM places WHERE i + {m - 1} <= len(w)" for m in (1, 2, 3, 4))
_CUTS = " UNION ALL ".join(f"SELECT lang, g, a, {k} AS k FROM candidates WHERE len(g) > {k}" for k in (1, 2, 3))
_INSIDE = " UNION ALL ".join(
    f"SELECT lang, list_slice(g, {i}, {i + m - 1}) AS g, a FROM candidates WHERE len(g) > {m} AND len(g) >= {i + m - 1}" for m in (2, 3) for i in (1, 2, 3) if i + m <= 5
)
SQL = f"""WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
  words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
  places AS (SELECT lang, w, unnest(generate_series(1, len(w))) AS i FROM words),
  counts AS MATERIALIZED (SELECT lang, g, count(*) AS a FROM ({_GRAMS}) GROUP BY lang, g HAVING count(*) >= 30),
  totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang),
  candidates AS (SELECT lang, g, a FROM counts WHERE len(g) > 1),
  covered AS (SELECT i.lang, i.g FROM ({_INSIDE}) i JOIN counts c ON c.lang = i.lang AND c.g = i.g GROUP BY i.lang, i.g, c.a HAVING 100 * max(i.a)::HUGEINT >= 80 * c.a::HUGEINT),
  cuts AS (SELECT t.lang, t.g, t.a, t.k, x.a AS l, y.a AS r, (2000000::HUGEINT * t.a) // (x.a + y.a) AS score FROM ({_CUTS}) t
    JOIN counts x ON x.lang = t.lang AND x.g = list_slice(t.g, 1, t.k) JOIN counts y ON y.lang = t.lang AND y.g = list_slice(t.g, t.k + 1, len(t.g))),
  lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
  phrases AS (SELECT lang, array_to_string(g, ' ') AS phrase, a, l, r, score::BIGINT AS score FROM lowest ANTI JOIN covered USING (lang, g)),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM phrases)
  SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000"""


@query("op12_collocations", SQL)
def op12_collocations(spark, sf):
    return collocations(table(spark, sf, "documents"))
