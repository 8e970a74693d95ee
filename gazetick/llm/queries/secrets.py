"""Secret scans: query and statement. Tests also compare it with patterns and entropies in plain Python."""

from pyspark.sql import functions as F

from gazetick.llm.queries.registry import query, table
from gazetick.llm.secrets import ALLOWED, ASSIGN, ASSIGN_VALUE, HEX_BITS, KINDS, LETTERS, OTHER_BITS, WINDOW, span_list, with_secret_spans

# The statement marks matches by a character, cuts there, and takes places from running lengths; its
# patterns spell the least length as a filter, and its entropies count each window anew.
_QUOTED = {k: p.replace("'", "''") for k, p in enumerate((ASSIGN, "AKIA[A-Z0-9]+", "[0-9a-f]+", f"[{LETTERS.replace('-', '')}-]+"))}
_LEAST = {1: 16, 2: 32, 3: WINDOW}
_PIECES = " UNION ALL ".join(
    f"""SELECT doc_id, {k} AS kind, unnest(p) AS piece, generate_subscripts(p, 1) AS i
      FROM (SELECT doc_id, string_split(regexp_replace(t, '{p}', chr(1) || '\\0' || chr(1), 'g'), chr(1)) AS p FROM texts)"""
    for k, p in _QUOTED.items()
)
_LONG = " OR ".join(f"kind = {k} AND length(piece) >= {n}" for k, n in _LEAST.items())
_NAMES = "CASE kind " + " ".join(f"WHEN {k} THEN '{name}'" for k, name in enumerate(KINDS)) + " END"
_SHOWN = f"{_NAMES} || ':' || first || ':' || last, ',' ORDER BY first, kind"
SQL = f"""WITH texts AS (SELECT doc_id, replace(coalesce(text, ''), chr(1), chr(2)) AS t FROM documents),
  pieces AS ({_PIECES}),
  placed AS (SELECT *, coalesce(sum(length(piece)) OVER (PARTITION BY doc_id, kind ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS first FROM pieces),
  found AS (SELECT doc_id, kind, piece, first, first + length(piece) AS last FROM placed
    WHERE i % 2 = 0 AND (kind = 0 AND length(regexp_extract(piece, '{_QUOTED[0]}', 2)) >= {ASSIGN_VALUE} OR {_LONG})),
  base AS (SELECT doc_id, kind, first, last FROM found WHERE kind < 3),
  candidates AS (SELECT doc_id, first, piece, CASE WHEN regexp_full_match(piece, '[0-9A-Fa-f]+') THEN {HEX_BITS} ELSE {OTHER_BITS} END AS need
    FROM found WHERE kind = 3 AND NOT regexp_full_match(piece, '{"|".join(ALLOWED)}')),
  windows AS (SELECT *, unnest(generate_series(1, length(piece) - {WINDOW - 1})) AS s FROM candidates),
  letters AS (SELECT doc_id, first, need, s, substr(piece, s + j, 1) AS c, count(*) AS n FROM windows, generate_series(0, {WINDOW - 1}) g(j) GROUP BY ALL),
  entropies AS (SELECT doc_id, first, need, s, -sum(n / {WINDOW}.0::DOUBLE * log2(n / {WINDOW}.0::DOUBLE)) AS h FROM letters GROUP BY doc_id, first, need, s),
  hot AS (SELECT doc_id, first + min(s) - 1 AS first, first + max(s) + {WINDOW - 1} AS last FROM entropies e WHERE h >= need GROUP BY doc_id, e.first),
  added AS (SELECT doc_id, 3 AS kind, first, last FROM hot WHERE NOT EXISTS
    (SELECT 1 FROM base WHERE base.doc_id = hot.doc_id AND base.first <= hot.first AND base.last >= hot.last)),
  spans AS (SELECT * FROM base UNION ALL SELECT * FROM added)
  SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
    sha256(coalesce(string_agg({_SHOWN}) FILTER (kind < 3), '')) AS base_sha256, coalesce(string_agg({_SHOWN}), '') AS spans
  FROM documents LEFT JOIN spans USING (doc_id) GROUP BY doc_id"""


@query("op7_secrets", SQL)
def op7_secrets(spark, sf):
    found = with_secret_spans(table(spark, sf, "documents").select("doc_id", "text")).select("doc_id", "secret_spans")

    def count(kind):
        return F.size(F.filter("secret_spans", lambda s: s.kind == kind)).cast("bigint").alias(f"n_{KINDS[kind]}")

    counts = [count(0), count(1), count(2)]
    base = F.filter("secret_spans", lambda s: s.kind < 3)
    return found.select("doc_id", *counts, F.sha2(span_list(base), 256).alias("base_sha256"), span_list("secret_spans").alias("spans"))
