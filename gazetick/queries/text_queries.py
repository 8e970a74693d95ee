"""Text clean-up, tokens, stems and article preprocessing over whole documents and pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from gazetick.functions import text as X
from gazetick.functions.dates import to_newyork
from gazetick.functions.stem import stem_tokens
from gazetick.operators.annotate import annotate_entities, entity_count
from gazetick.operators.articles import preprocess_articles
from gazetick.operators.profile import token_counts
from gazetick.operators.textfeatures import ngrams
from gazetick.queries import sqltext as S
from gazetick.queries.registry import query, r6, sql_r6, table
from gazetick.session import use_utc


def marked_up(spark, sf):
    """Addresses, markup, entities and digits in one text: a page behind its own URL."""
    return table(spark, sf, "pages").select("page_id", F.concat_ws(" ", "url", "html").alias("text"))


MARKED_UP = "(SELECT page_id, url || ' ' || html AS text FROM pages)"


def articles(spark, sf):
    """Documents as articles: the first line is the title, the text the paragraph."""
    docs = table(spark, sf, "documents")
    return docs.select(
        "doc_id",
        "source",
        F.concat(F.lit("doc/"), F.col("doc_id").cast("string")).alias("url"),
        F.lit("").alias("published_date_new_york"),
        F.split("text", "\n")[0].alias("title"),
        F.col("text").alias("first_paragraph"),
    )


def _page_text(name, expr, sql):
    @query(name, f"SELECT page_id, {sql('text')} AS text FROM {MARKED_UP}")
    def run(spark, sf):
        return marked_up(spark, sf).select("page_id", expr(F.col("text")).alias("text"))


_page_text("remove_urls", X.remove_urls, S.urls)
_page_text("remove_html_entities", X.remove_html_entities, S.entities)
_page_text("remove_punctuation", X.remove_punctuation, S.punctuation)
_page_text("remove_numbers", X.remove_numbers, S.numbers)
_page_text("collapse_whitespace", X.collapse_whitespace, S.collapse)
_page_text(
    "clean_text_basic",
    X.clean_text_basic,
    lambda x: S.letters(S.drop(f"lower({x})", f"http[^{S.WS}]+")),
)
_page_text(
    "clean_text_www",
    X.clean_text_www,
    lambda x: S.letters(S.drop(f"lower({x})", f"http[^{S.WS}]+|www[^{S.WS}]+")),
)
_page_text(
    "clean_and_tokenize",
    lambda c: F.array_join(X.clean_and_tokenize(c), "|"),
    lambda x: f"array_to_string({S.sequence_tokens(x)}, '|')",
)


@query("tokenize_ws", f"SELECT doc_id, array_to_string({S.split('text')}, '|') AS tokens FROM documents")
def tokenize_ws(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.array_join(X.tokenize(F.col("text")), "|").alias("tokens"))


@query(
    "remove_stopwords",
    f"SELECT doc_id, array_to_string({S.without_stopwords(S.split('lower(text)'))}, '|') AS tokens FROM documents",
)
def remove_stopwords(spark, sf):
    words = X.remove_stopwords(X.tokenize(F.lower("text")))
    return table(spark, sf, "documents").select("doc_id", F.array_join(words, "|").alias("tokens"))


@query(
    "stem_tokens",
    f"""WITH words AS (SELECT unnest({S.cleaned_words('text')}) AS token FROM documents),
    {S.stem_steps('words')}
    SELECT token, stem FROM stems""",
)
def stem_words(spark, sf):
    words = table(spark, sf, "documents").select(F.explode(X.cleaned_words(F.col("text"))).alias("token")).distinct()
    return words.select("token", stem_tokens(F.array("token"))[0].alias("stem"))


PREPROCESSED = f"""words AS (SELECT doc_id, unnest(w) AS token, generate_subscripts(w, 1) AS pos
      FROM (SELECT doc_id, {S.cleaned_words('text')} AS w FROM documents)),
    {S.stem_steps('words')},
    joined AS (SELECT doc_id, string_agg(stem, ' ' ORDER BY pos) AS clean_text, count(*) AS n_tokens
      FROM words JOIN stems USING (token) GROUP BY doc_id)"""


@query(
    "preprocess_text",
    f"""WITH {PREPROCESSED}
    SELECT d.doc_id, coalesce(clean_text, '') AS clean_text, coalesce(n_tokens, 0)::INTEGER AS n_tokens
    FROM documents d LEFT JOIN joined USING (doc_id)""",
)
def preprocess_text(spark, sf):
    done = table(spark, sf, "documents").withColumn("p", X.preprocess_text(F.col("text")))
    return done.select("doc_id", "p.clean_text", F.size("p.tokens").alias("n_tokens"))


ARTICLE_SQL = f"""art AS (SELECT doc_id, source, 'doc/' || doc_id AS url, split_part(text, chr(10), 1) AS title,
      text AS first_paragraph FROM documents),
    words AS (SELECT doc_id, 't' AS part, unnest(w) AS token, generate_subscripts(w, 1) AS pos
      FROM (SELECT doc_id, {S.cleaned_words('title')} AS w FROM art)
      UNION ALL SELECT doc_id, 'p', unnest(w), generate_subscripts(w, 1)
      FROM (SELECT doc_id, {S.cleaned_words('first_paragraph')} AS w FROM art)),
    {S.stem_steps('words')},
    joined AS (SELECT doc_id, part, string_agg(stem, ' ' ORDER BY pos) AS clean,
      string_agg(stem, '|' ORDER BY pos) AS tokens FROM words JOIN stems USING (token) GROUP BY doc_id, part)"""
ARTICLE_ROWS = """FROM art LEFT JOIN joined t ON t.doc_id = art.doc_id AND t.part = 't'
    LEFT JOIN joined p ON p.doc_id = art.doc_id AND p.part = 'p'"""


@query(
    "preprocess_articles",
    f"""WITH {ARTICLE_SQL}
    SELECT source, url, '' AS published_date_new_york, title AS original_title,
      coalesce(t.clean, '') AS clean_title, coalesce(t.tokens, '') AS title_tokens,
      first_paragraph AS original_first_paragraph, coalesce(p.clean, '') AS clean_first_paragraph,
      coalesce(p.tokens, '') AS first_paragraph_tokens {ARTICLE_ROWS}""",
)
def preprocess_articles_query(spark, sf):
    done = preprocess_articles(articles(spark, sf))
    return done.withColumns(
        {c: F.array_join(c, "|") for c in ("title_tokens", "first_paragraph_tokens")}
    )


@query(
    "embedding_text",
    f"""WITH {ARTICLE_SQL}
    SELECT url, trim(coalesce(t.clean, '') || ' ' || coalesce(p.clean, '')) AS text {ARTICLE_ROWS}""",
)
def embedding_text(spark, sf):
    done = preprocess_articles(articles(spark, sf))
    return done.select("url", X.embedding_text(F.col("clean_title"), F.col("clean_first_paragraph")).alias("text"))


@query(
    "concat_title_body",
    f"""SELECT doc_id, {S.letters(S.drop("lower(title || '. ' || body)", f"http[^{S.WS}]+"))} AS clean_text
    FROM (SELECT d.doc_id, CASE WHEN quality = 1 THEN source END AS title, text AS body
          FROM documents d LEFT JOIN labels l USING (doc_id))""",
)
def concat_title_body(spark, sf):
    labels = table(spark, sf, "labels").select("doc_id", "quality")
    docs = table(spark, sf, "documents").join(labels, "doc_id", "left")
    title = F.when(F.col("quality") == 1, F.col("source"))
    return docs.select("doc_id", X.clean_text_basic(X.concat_title_body(title, F.col("text"))).alias("clean_text"))


@query(
    "title_features",
    f"""SELECT doc_id, length(text)::INTEGER AS char_count, len(w)::INTEGER AS word_count,
      {sql_r6("length(array_to_string(w, ''))::DOUBLE / nullif(len(w), 0)")} AS avg_word_length,
      len(list_filter(w, lambda t: regexp_matches(t, '\\p{{Lu}}') AND NOT regexp_matches(t, '[\\p{{Ll}}\\p{{Lt}}]')))::INTEGER
        AS uppercase_words
    FROM (SELECT doc_id, text, {S.split('text')} AS w FROM documents)""",
)
def title_features(spark, sf):
    text = F.col("text")
    return table(spark, sf, "documents").select(
        "doc_id",
        X.char_count(text).alias("char_count"),
        X.word_count(text).alias("word_count"),
        r6(X.avg_word_length(text)).alias("avg_word_length"),
        X.uppercase_words(text).alias("uppercase_words"),
    )


@query(
    "token_counts",
    f"""SELECT token, count(*) AS count FROM (SELECT unnest({S.sequence_tokens('text')}) AS token FROM documents)
    GROUP BY token""",
)
def token_counts_query(spark, sf):
    return token_counts(table(spark, sf, "documents"), X.clean_and_tokenize(F.col("text")))


@query(
    "top_stems",
    f"""WITH words AS (SELECT unnest({S.cleaned_words('text')}) AS token FROM documents),
    {S.stem_steps('words')}
    SELECT stem, count(*) AS count FROM words JOIN stems USING (token) GROUP BY stem""",
)
def top_stems(spark, sf):
    """Counts of all stems; words are counted before they are stemmed, so the stemmer sees each
    distinct word once."""
    words = token_counts(table(spark, sf, "documents"), X.cleaned_words(F.col("text")))
    return words.groupBy(stem_tokens(F.array("token"))[0].alias("stem")).agg(F.sum("count").alias("count"))


# One date layout per event type, one of them unreadable.
DATES = {
    "click": ("yyyy-MM-dd'T'HH:mm:ss'Z'", "%Y-%m-%dT%H:%M:%SZ"),
    "view": ("dd MMM yyyy HH:mm:ss 'GMT'", "%d %b %Y %H:%M:%S GMT"),
    "signup": ("MMMM d, yyyy HH:mm:ss", "%B %-d, %Y %H:%M:%S"),
    "purchase": ("yyyy-MM-dd HH:mm:ss", "%Y-%m-%d %H:%M:%S"),
}


@query(
    "to_newyork",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN '' ELSE
      strftime((date_trunc('second', ts) AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York', '%Y-%m-%d %H:%M:%S') END
      AS published_date_new_york FROM events""",
)
def to_newyork_query(spark, sf):
    use_utc(spark)
    events = table(spark, sf, "events")
    written = F.lit("no date")
    for kind, (layout, _) in DATES.items():
        shown = F.date_format("ts", layout)
        if kind == "view":
            shown = F.concat(F.date_format("ts", "E"), F.lit(", "), shown)
        written = F.when(F.col("event_type") == kind, shown).otherwise(written)
    return events.select("event_id", to_newyork(written).alias("published_date_new_york"))


def gazetteer(spark, sf):
    """All runs of two, three and seven words of every benchmark item, which documents quote."""
    words = table(spark, sf, "benchmark").select(F.regexp_extract_all(F.lower("text"), F.lit(f"[{X.WORD}]+"), F.lit(0)).alias("w"))
    sizes = [words.select(F.explode(ngrams(F.col("w"), n, n)).alias("phrase"), F.lit(f"W{n}").alias("label")) for n in (2, 3, 7)]
    return sizes[0].union(sizes[1]).union(sizes[2]).distinct()


ENTITY_SQL = f"""RECURSIVE bw AS (SELECT regexp_extract_all(lower(text), '[{S.WORD}]+') AS w FROM benchmark),
    gaz AS (SELECT phrase, min(label) AS label FROM (
      SELECT array_to_string(w[i:i + n - 1], ' ') AS phrase, 'W' || n AS label
      FROM (SELECT w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM bw, (VALUES (2), (3), (7)) v(n) WHERE len(w) >= n))
      GROUP BY phrase),
    docw AS (SELECT doc_id, regexp_extract_all(text, '[{S.WORD}]+') AS w FROM documents),
    starts AS (SELECT doc_id, w, unnest(generate_series(1, len(w))) AS pos FROM docw),
    grams AS (SELECT doc_id, pos, n, array_to_string(w[pos:pos + n - 1], ' ') AS word
      FROM starts, (VALUES (2), (3), (7)) v(n) WHERE pos + n - 1 <= len(w)),
    hits AS (SELECT doc_id, pos, max(n) AS n FROM grams JOIN gaz ON lower(word) = phrase GROUP BY doc_id, pos),
    best AS (SELECT h.doc_id, h.pos, h.n, g.word, z.label FROM hits h JOIN grams g USING (doc_id, pos, n)
      JOIN gaz z ON lower(g.word) = z.phrase),
    nxt AS (SELECT a.doc_id, a.pos, a.n, a.word, a.label, b.pos AS next_pos
      FROM best a ASOF LEFT JOIN best b ON a.doc_id = b.doc_id AND b.pos >= a.pos + a.n),
    chain AS (SELECT n.* FROM nxt n JOIN (SELECT doc_id, min(pos) AS pos FROM best GROUP BY doc_id) f USING (doc_id, pos)
      UNION ALL SELECT n.* FROM chain c JOIN nxt n ON n.doc_id = c.doc_id AND n.pos = c.next_pos),
    shown AS (SELECT doc_id, string_agg(word || ' (' || label || ')', ', ' ORDER BY pos) AS ner, count(*) AS n
      FROM chain GROUP BY doc_id)"""


@query(
    "annotate_entities",
    f"""WITH {ENTITY_SQL}
    SELECT d.doc_id, coalesce(ner, '') AS ner, coalesce(n, 0)::INTEGER AS entity_count
    FROM documents d LEFT JOIN shown USING (doc_id)""",
)
def annotate_entities_query(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    done = annotate_entities(docs, "doc_id", "text", gazetteer(spark, sf))
    return done.select(
        "doc_id", X.format_entities(F.col("entities")).alias("ner"), entity_count(F.col("entities")).alias("entity_count")
    )
