"""Sources, sinks, column handling, profiles, ordering, duplicates and upserts."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from gazetick.functions.dates import epoch_ms_to_ts
from gazetick.functions.numeric import clip, sigmoid_threshold
from gazetick.operators import columns as C
from gazetick.operators import ordering as O
from gazetick.operators import profile as P
from gazetick.operators.articles import claim_urls, extract_articles, land_articles, preprocess_articles
from gazetick.operators.upsert import upsert_by_key
from gazetick.plans.position import with_position
from gazetick.queries.registry import query, r6, sql_r6, table
from gazetick.queries.text_queries import ARTICLE_ROWS, ARTICLE_SQL, articles
from gazetick.session import shared_dir, use_utc
from gazetick.sources import readers, sinks
from gazetick.sources.catalog import source_catalog
from gazetick.sources.ticks import HOUR_MS, bars_from_ticks


def scratch(spark) -> str:
    return f"{shared_dir(spark)}/io-{uuid.uuid4().hex}"


def news(spark, sf):
    """Labelled news: whole documents as titles, languages as categories, quality as group leader."""
    labels = table(spark, sf, "labels").select("doc_id", "quality")
    docs = table(spark, sf, "documents").join(labels, "doc_id", "left")
    return docs.select(
        "doc_id",
        F.col("text").alias("Title"),
        F.col("lang").alias("Category"),
        F.col("source").alias("URL"),
        F.col("quality").cast("string").alias("Group Leader"),
    )


NEWS = """(SELECT doc_id, text AS "Title", lang AS "Category", source AS "URL", quality::VARCHAR AS "Group Leader"
    FROM documents LEFT JOIN labels USING (doc_id))"""
NEWS_FIELDS = ["Title", "Category", "URL", "Group Leader"]


# --- sources and sinks -------------------------------------------------------------------------


@query("read_news_csv", f"SELECT * EXCLUDE (doc_id) FROM {NEWS}")
def read_news_csv(spark, sf):
    path = scratch(spark)
    sinks.write_csv(news(spark, sf).select(*NEWS_FIELDS), path)
    return readers.read_news_csv(spark, path)


@query("read_news_csv_required", f'SELECT * EXCLUDE (doc_id) FROM {NEWS} WHERE "Group Leader" IS NOT NULL')
def read_news_csv_required(spark, sf):
    path = scratch(spark)
    sinks.write_csv(news(spark, sf).select(*NEWS_FIELDS), path)
    return readers.read_news_csv(spark, path, require=["Title", "Group Leader"])


ARTICLES_SQL = """SELECT source, split_part(text, chr(10), 1) AS title, 'doc/' || doc_id AS url,
    '' AS published_date_new_york, text AS first_paragraph FROM documents"""


@query("write_json_records", ARTICLES_SQL)
def write_json_records(spark, sf):
    path = scratch(spark)
    sinks.write_json_records(articles(spark, sf).drop("doc_id"), path)
    return readers.read_article_lines(spark, path)


@query("read_articles_json", ARTICLES_SQL)
def read_articles_json(spark, sf):
    """JSON arrays of up to 100 articles, each in a file of its own."""
    path = scratch(spark)
    record = F.struct(*readers.ARTICLE_COLUMNS)
    landed = articles(spark, sf).groupBy(F.floor(F.col("doc_id") / 100)).agg(F.to_json(F.collect_list(record)).alias("value"))
    landed.select("value").write.option("maxRecordsPerFile", 1).text(path)
    return readers.read_articles_json(spark, path).select(*readers.ARTICLE_COLUMNS)


@query(
    "write_flat_csv",
    f"""WITH {ARTICLE_SQL}
    SELECT source, url, NULL::VARCHAR AS published_date_new_york, nullif(title, '') AS original_title,
      t.clean AS clean_title, nullif(first_paragraph, '') AS original_first_paragraph,
      p.clean AS clean_first_paragraph {ARTICLE_ROWS}""",
)
def write_flat_csv(spark, sf):
    path = scratch(spark)
    sinks.write_flat_csv(preprocess_articles(articles(spark, sf)), path)
    return readers.read_news_csv(spark, path, sinks.FLAT_COLUMNS)


@query(
    "write_embeddings",
    """SELECT 'vec/' || vec_id AS url, array_to_string(list_transform(embedding, lambda v: (v * 1000000)::INTEGER), ',') AS v
    FROM embeddings""",
)
def write_embeddings(spark, sf):
    path = scratch(spark)
    url = F.concat(F.lit("vec/"), F.col("vec_id").cast("string"))
    sinks.write_embeddings(table(spark, sf, "embeddings").withColumn("url", url), path)
    back = spark.read.parquet(path)
    shown = F.transform("embedding", lambda v: F.rint(v * F.lit(1e6).cast("float")).cast("int").cast("string"))
    return back.select("url", F.array_join(shown, ",").alias("v"))


FEED_ITEMS = 50


def landed_feeds(spark, sf):
    """The pages as items of the catalogue's 17 feeds, read back from RSS files of up to 50 items.

    A feed is landed in batches; its pages are dealt to it by their id.
    """
    path = scratch(spark)
    number = Window.orderBy("source_rank", "feed_rank")  # of 17 rows
    feeds = source_catalog(spark).select("source", "feed_rank", (F.row_number().over(number) - 1).alias("feed"))
    pages = table(spark, sf, "pages").withColumns(
        {"feed": F.pmod("page_id", F.lit(17)).cast("int"), "batch": F.floor(F.col("page_id") / (17 * FEED_ITEMS))}
    )
    escaped = lambda c: F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    raw = F.regexp_extract("html", "(?s)<title>(.*?)</title>", 1)
    item = F.concat(
        F.lit("<item><title>"), escaped(raw), F.lit("</title><link>"), escaped(F.col("url")),
        F.lit("</link><pubDate>"), F.col("page_id").cast("string"), F.lit("</pubDate></item>"),
    )
    items = F.array_sort(F.collect_list(F.struct("page_id", item.alias("item"))))
    files = pages.join(F.broadcast(feeds), "feed").groupBy("source", "feed_rank", "batch").agg(items.alias("items"))
    text = F.concat(F.lit("<rss><channel>"), F.array_join("items.item", ""), F.lit("</channel></rss>"))
    landed = files.select("source", "feed_rank", "batch", text.alias("value"))
    landed.write.option("maxRecordsPerFile", 1).partitionBy("source", "feed_rank", "batch").text(path)
    return readers.read_feed(spark, path, source_catalog(spark))


FEEDS_SQL = """(VALUES ('BBC', 0, 0), ('BBC', 0, 1), ('BBC', 0, 2), ('BBC', 0, 3), ('BBC', 0, 4), ('NPR', 1, 0), ('NPR', 1, 1),
    ('NPR', 1, 2), ('Guardian', 2, 0), ('Guardian', 2, 1), ('Guardian', 2, 2), ('CBS', 3, 0), ('NBC', 4, 0), ('FOX', 5, 0),
    ('CNN', 6, 0), ('CNN', 6, 1), ('CNN', 6, 2)) f(source, source_rank, feed_rank)"""
LANDED_SQL = f"""feeds AS (SELECT *, row_number() OVER (ORDER BY source_rank, feed_rank) - 1 AS feed FROM {FEEDS_SQL}),
    landed AS (SELECT page_id, html, url, source, source_rank, feed_rank, page_id // {17 * FEED_ITEMS} AS batch,
        row_number() OVER (PARTITION BY feed, page_id // {17 * FEED_ITEMS} ORDER BY page_id) - 1 AS pos
      FROM pages JOIN feeds ON feed = page_id % 17)"""


@query(
    "read_feed",
    f"""WITH {LANDED_SQL} SELECT source, source_rank::INTEGER AS source_rank, feed_rank::INTEGER AS feed_rank, pos::INTEGER AS pos,
      url, trim(regexp_extract(html, '<title>(.*?)</title>', 1)) AS raw_title, page_id AS rank FROM landed""",
)
def read_feed(spark, sf):
    """Landed RSS with source, ranks and the item's place in its file."""
    return landed_feeds(spark, sf).select(
        "source", "source_rank", "feed_rank", "pos", "url", F.trim("title").alias("raw_title"), F.col("rss_date").cast("long").alias("rank")
    )


# Sources in catalogue order with their number of feeds.
CATALOG_VALUES = """(VALUES ('BBC', 0, 5), ('NPR', 1, 3), ('Guardian', 2, 3), ('CBS', 3, 1), ('NBC', 4, 1), ('FOX', 5, 1),
    ('CNN', 6, 3)) c(source, source_rank, feeds)"""


@query(
    "source_catalog",
    f"""SELECT event_type, source, source_rank::INTEGER AS source_rank, feeds::BIGINT AS feeds, count(*) AS events
    FROM events JOIN {CATALOG_VALUES} ON source_rank = (user_id % 7) GROUP BY ALL""",
)
def source_catalog_query(spark, sf):
    """Events by the catalogue source their user falls to; the catalogue itself is a 17-row table."""
    feeds = source_catalog(spark).groupBy("source", "source_rank").agg(F.count(F.lit(1)).alias("feeds"))
    events = table(spark, sf, "events").withColumn("source_rank", (F.col("user_id") % 7).cast("int"))
    return events.join(F.broadcast(feeds), "source_rank").groupBy("event_type", "source", "source_rank", "feeds").agg(
        F.count(F.lit(1)).alias("events")
    )


HOURLY = """(SELECT event_type AS symbol, epoch_ms(date_trunc('hour', ts)) AS timestamp,
    date_trunc('hour', ts) AS date, min_by(value, (ts, event_id)) AS open, max(value) AS high, min(value) AS low,
    max_by(value, (ts, event_id)) AS close, sum(value) AS volume, sum(value * value) / sum(value) AS vwap,
    count(*) AS transactions FROM events GROUP BY event_type, date_trunc('hour', ts))"""


def hourly_bars(spark, sf):
    use_utc(spark)
    events = table(spark, sf, "events")
    return bars_from_ticks(
        events, F.col("event_type"), F.col("ts"), F.col("value"), F.col("event_id"), every_ms=HOUR_MS
    )


BAR_ROW = f"""symbol, timestamp, strftime(date, '%Y-%m-%d %H:%M:%S') AS date, {sql_r6('open')} AS open,
    {sql_r6('high')} AS high, {sql_r6('low')} AS low, {sql_r6('close')} AS close, {sql_r6('volume')} AS volume,
    {sql_r6('vwap')} AS vwap, transactions"""


def bar_rows(df):
    prices = [r6(c).alias(c) for c in ("open", "high", "low", "close", "volume", "vwap")]
    date = F.date_format("date", "yyyy-MM-dd HH:mm:ss").alias("date")
    return df.select("symbol", "timestamp", date, *prices, "transactions")


@query("bars_from_ticks", f"SELECT {BAR_ROW} FROM {HOURLY}")
def bars_from_ticks_query(spark, sf):
    return bar_rows(hourly_bars(spark, sf))


@query("read_bars", f"SELECT {BAR_ROW} FROM {HOURLY}")
def read_bars(spark, sf):
    """Bars landed as range responses (one per symbol and day, some without results) and read back."""
    path = scratch(spark)
    names = {v: k for k, v in C.BAR_NAMES.items()}
    bars = hourly_bars(spark, sf)
    result = F.struct(*[F.col(long).alias(short) for long, short in names.items()])
    days = bars.groupBy("symbol", F.to_date("date").alias("day")).agg(F.collect_list(result).alias("results"))
    days.select("symbol", "results").union(days.select("symbol", F.lit(None))).write.partitionBy("symbol").json(path)
    return bar_rows(C.rename_bars(readers.read_bars(spark, path, lines=True)))


# --- columns and predicates --------------------------------------------------------------------


@query("normalise_columns", f'SELECT doc_id, "Title" AS title, "Group Leader" AS "group leader" FROM {NEWS}')
def normalise_columns(spark, sf):
    untidy = news(spark, sf).select("doc_id", F.col("Title").alias("  Title "), F.col("Group Leader").alias("Group Leader "))
    return C.require_columns(C.normalise_columns(untidy), "title")


@query("drop_column", f'SELECT * EXCLUDE ("Group Leader") FROM {NEWS}')
def drop_column(spark, sf):
    return news(spark, sf).drop("Group Leader")


@query("select_columns", f'SELECT doc_id, "Category" FROM {NEWS}')
def select_columns(spark, sf):
    return news(spark, sf).select("doc_id", "Category")


@query("rename_bars", f"SELECT symbol, timestamp, {sql_r6('open')} AS open, {sql_r6('vwap')} AS vwap, transactions FROM {HOURLY}")
def rename_bars(spark, sf):
    short = hourly_bars(spark, sf).drop("date").withColumnsRenamed({v: k for k, v in C.BAR_NAMES.items()})
    return C.rename_bars(short).select("symbol", "timestamp", r6("open").alias("open"), r6("vwap").alias("vwap"), "transactions")


@query(
    "epoch_ms_to_ts",
    "SELECT event_id, strftime(make_timestamp(epoch_us(ts) // 1000 * 1000), '%Y-%m-%d %H:%M:%S.%g') AS date FROM events",
)
def epoch_ms(spark, sf):
    use_utc(spark)
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    return table(spark, sf, "events").select("event_id", F.date_format(epoch_ms_to_ts(ms), "yyyy-MM-dd HH:mm:ss.SSS").alias("date"))


@query("fill_blank", f"""SELECT doc_id, coalesce("Group Leader", '') AS "Group Leader" FROM {NEWS}""")
def fill_blank(spark, sf):
    return C.fill_blank(news(spark, sf), "Group Leader", "URL").select("doc_id", "Group Leader")


@query("drop_missing", f'SELECT doc_id, "Group Leader" FROM {NEWS} WHERE "Group Leader" IS NOT NULL')
def drop_missing(spark, sf):
    return C.drop_missing(news(spark, sf), "Group Leader").select("doc_id", "Group Leader")


NONFINITE = """(SELECT event_id, value, CASE WHEN event_type = 'error' THEN 'inf'::DOUBLE
    WHEN event_type = 'view' AND value > 10 THEN 'nan'::DOUBLE WHEN value < 2 THEN NULL ELSE ln(value) END AS x FROM events)"""


@query("drop_nonfinite", f"SELECT event_id, {sql_r6('x')} AS x FROM {NONFINITE} WHERE x IS NOT NULL AND isfinite(x)")
def drop_nonfinite(spark, sf):
    x = (
        F.when(F.col("event_type") == "error", float("inf"))
        .when((F.col("event_type") == "view") & (F.col("value") > 10), float("nan"))
        .when(F.col("value") >= 2, F.ln("value"))
    )
    return C.drop_nonfinite(table(spark, sf, "events").select("event_id", x.alias("x"))).select("event_id", r6("x").alias("x"))


@query(
    "filter_complete_articles",
    """SELECT doc_id FROM documents LEFT JOIN labels USING (doc_id) WHERE quality = 1 AND text <> ''""",
)
def filter_complete(spark, sf):
    marked = news(spark, sf).select(
        "doc_id", F.when(F.col("Group Leader") == "1", F.col("URL")).otherwise("").alias("title"), F.col("Title").alias("first_paragraph")
    )
    return C.filter_complete_articles(marked).select("doc_id")


@query("filter_has_url", "SELECT doc_id FROM documents JOIN labels USING (doc_id)")
def filter_has_url(spark, sf):
    marked = news(spark, sf).select("doc_id", F.when(F.col("Group Leader").isNotNull(), F.col("URL")).alias("url"))
    return C.filter_has_url(marked).select("doc_id")


@query(
    "sigmoid_threshold",
    """SELECT vec_id, (1 / (1 + exp(-(embedding[1]::DOUBLE))) >= 0.5)::INTEGER AS up,
      greatest(embedding[2]::DOUBLE, 0) + 0.0::DOUBLE AS gain, least(embedding[2]::DOUBLE, 0) + 0.0::DOUBLE AS loss FROM embeddings""",
)
def sigmoid_query(spark, sf):
    first, second = (F.col("embedding")[i].cast("double") for i in (0, 1))
    return table(spark, sf, "embeddings").select(
        "vec_id",
        sigmoid_threshold(first).alias("up"),
        (clip(second, lower=0.0) + F.lit(0.0)).alias("gain"),
        (clip(second, upper=0.0) + F.lit(0.0)).alias("loss"),
    )


# --- profiles ----------------------------------------------------------------------------------


@query("value_counts", f'SELECT "Category", count(*) AS count FROM {NEWS} GROUP BY 1')
def value_counts(spark, sf):
    return P.value_counts(news(spark, sf), "Category")


@query(
    "value_counts_pct",
    f"""SELECT quality, count(*) AS count, {sql_r6('count(*) * 100.0::DOUBLE / sum(count(*)) OVER ()')} AS pct
    FROM labels GROUP BY quality""",
)
def value_counts_pct(spark, sf):
    return P.value_counts_pct(table(spark, sf, "labels"), "quality").withColumn("pct", r6("pct"))


@query(
    "null_counts",
    f"""SELECT * FROM (SELECT count(*) - count(doc_id) AS doc_id, count(*) - count("Title") AS "Title",
      count(*) - count("Category") AS "Category", count(*) - count("URL") AS "URL",
      count(*) - count("Group Leader") AS "Group Leader" FROM {NEWS}) UNPIVOT (nulls FOR "column" IN (*))""",
)
def null_counts(spark, sf):
    return P.null_counts(news(spark, sf))


@query("total_nulls", f'SELECT (count(*) - count("Group Leader"))::BIGINT AS nulls FROM {NEWS}')
def total_nulls(spark, sf):
    return P.total_nulls(news(spark, sf))


@query(
    "duplicate_row_count",
    """SELECT sum(n - 1)::BIGINT AS duplicates FROM (SELECT count(*) AS n FROM
      (SELECT text, lang, quality FROM documents LEFT JOIN labels USING (doc_id)) GROUP BY text, lang, quality)""",
)
def duplicate_rows(spark, sf):
    return P.duplicate_row_count(news(spark, sf).select("Title", "Category", "Group Leader"))


@query("duplicate_key_count", "SELECT count(*) - count(DISTINCT ts) AS duplicates FROM events")
def duplicate_keys(spark, sf):
    return P.duplicate_key_count(table(spark, sf, "events"), "ts")


@query(
    "distinct_counts",
    f"""SELECT * FROM (SELECT count(DISTINCT doc_id) AS doc_id, count(DISTINCT "Title") AS "Title",
      count(DISTINCT "Category") AS "Category", count(DISTINCT "URL") AS "URL",
      count(DISTINCT "Group Leader") AS "Group Leader" FROM {NEWS}) UNPIVOT ("distinct" FOR "column" IN (*))""",
)
def distinct_counts(spark, sf):
    return P.distinct_counts(news(spark, sf))


@query("approx_distinct_counts")
def approx_distinct_counts(spark, sf):
    """Sketches of two batches that together are all records, merged; tests hold them against exact counts."""
    rows = news(spark, sf)
    batches = [P.distinct_sketches(rows.filter(F.pmod(F.col("doc_id"), F.lit(2)) == half)) for half in (0, 1)]
    return P.approx_distinct_counts(batches[0].unionByName(batches[1]))


@query(
    "shape_dtypes",
    """SELECT * FROM (SELECT count(doc_id) AS non_null, count(*) AS rows, 'doc_id' AS "column", 'bigint' AS dtype,
        0 AS position FROM labels
      UNION ALL SELECT count(quality), count(*), 'quality', 'int', 1 FROM labels
      UNION ALL SELECT count(toxic), count(*), 'toxic', 'int', 2 FROM labels)""",
)
def shape_dtypes(spark, sf):
    return P.shape_dtypes(table(spark, sf, "labels"))


@query(
    "class_weights_balanced",
    f"""SELECT lang, {sql_r6('sum(n) OVER () / (count(*) OVER () * n)')} AS weight
    FROM (SELECT lang, count(*)::DOUBLE AS n FROM documents GROUP BY lang)""",
)
def class_weights(spark, sf):
    weights = P.class_weights_balanced(table(spark, sf, "documents"), "lang")
    return weights.select("lang", r6("weight").alias("weight"))


# --- order, limits, duplicates -----------------------------------------------------------------


@query("sort_limit", "SELECT event_id, value FROM events ORDER BY value DESC, event_id LIMIT 100")
def sort_limit(spark, sf):
    return O.first_n(table(spark, sf, "events").select("event_id", "value"), 100, F.desc("value"), "event_id")


@query("head_tail", """(SELECT event_id FROM events ORDER BY event_id LIMIT 5)
    UNION ALL (SELECT event_id FROM events ORDER BY event_id DESC LIMIT 5)""")
def head_tail(spark, sf):
    ids = table(spark, sf, "events").select("event_id")
    return O.union_batches(O.first_n(ids, 5, "event_id"), O.last_n(ids, 5, "event_id"))


@query(
    "top_n_per_group",
    """SELECT label, vec_id FROM (SELECT label, vec_id, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS rn
      FROM embeddings) WHERE rn <= 15""",
)
def top_n_per_group(spark, sf):
    return O.top_n_per_group(table(spark, sf, "embeddings").select("label", "vec_id"), ["label"], ["vec_id"], 15)


@query(
    "dedupe_keep_first",
    "SELECT doc_id, text FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1",
)
def dedupe_keep_first(spark, sf):
    return O.dedupe_keep_first(table(spark, sf, "documents").select("doc_id", "text"), ["text"], ["doc_id"])


@query("dedupe_rows", f'SELECT DISTINCT "Title", "Category" FROM {NEWS}')
def dedupe_rows(spark, sf):
    return O.dedupe_rows(news(spark, sf).select("Title", "Category"))


@query(
    "limit_per_source",
    """SELECT source, doc_id FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn FROM documents)
    WHERE rn <= 20""",
)
def limit_per_source(spark, sf):
    return O.limit_per_source(table(spark, sf, "documents").select("source", "doc_id"), 20, ["doc_id"])


@query(
    "first_n_per_key",
    """SELECT event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS rn
      FROM events) WHERE rn <= 1500""",
)
def first_n_per_key(spark, sf):
    return O.first_n_per_key(table(spark, sf, "events").select("event_type", "event_id"), ["event_type"], "event_id", 1500)


@query(
    "global_row_index",
    """SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1)::BIGINT AS row_index
    FROM (SELECT min(doc_id) AS doc_id FROM documents GROUP BY text)""",
)
def global_row_index(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    first = O.dedupe_keep_first(docs, ["text"], ["doc_id"]).select("doc_id")
    return with_position(first, ["doc_id"], out="row_index").withColumn("row_index", F.col("row_index") - 1)


@query(
    "union_batches",
    """SELECT event_id, value FROM events""",
)
def union_batches(spark, sf):
    """Two ranges that share a boundary day, appended and deduplicated."""
    use_utc(spark)
    events = table(spark, sf, "events").select("event_id", "ts", "value")
    early, late = events.filter("ts < '2024-01-16'"), events.filter("ts >= '2024-01-15'")
    return O.dedupe_keep_first(O.union_batches(early, late), ["event_id"], ["ts"]).select("event_id", "value")


# --- landing -----------------------------------------------------------------------------------

TITLE_SQL = """trim(replace(replace(regexp_extract(html, '<h1>(.*?)</h1>', 1), '&quot;', '\"'), '&amp;', '&'))"""


def feed_entries(spark, sf):
    """Feed entries from the pages: the page's language is its source; every page is also listed by
    a last source, and twice in its own first feed. Entries without a link come along."""
    pages = table(spark, sf, "pages")
    lang = F.regexp_extract("html", '<html lang="([a-z]+)">', 1)
    ranks = F.when(lang == "de", 0).when(lang == "en", 1).when(lang == "es", 2).otherwise(3)
    base = pages.select(lang.alias("source"), ranks.alias("source_rank"), F.col("page_id").alias("pos"), "url")
    first = base.withColumns({"feed_rank": F.lit(0), "title": F.lit("first")})
    again = base.withColumns({"feed_rank": F.lit(1), "title": F.lit("again")})
    world = base.withColumns({"source": F.lit("world"), "source_rank": F.lit(4), "feed_rank": F.lit(0), "title": F.lit("world")})
    blank = base.withColumns({"url": F.lit(""), "feed_rank": F.lit(2), "title": F.lit("blank")})
    return O.union_batches(first, again, world, blank)


CLAIMS = """base AS (SELECT regexp_extract(html, '<html lang="([a-z]+)">', 1) AS source, page_id AS pos, url, html FROM pages),
    ranked AS (SELECT *, CASE source WHEN 'de' THEN 0 WHEN 'en' THEN 1 WHEN 'es' THEN 2 ELSE 3 END AS source_rank FROM base),
    entries AS (SELECT source, source_rank, 0 AS feed_rank, pos, url, 'first' AS title FROM ranked
      UNION ALL SELECT source, source_rank, 1, pos, url, 'again' FROM ranked
      UNION ALL SELECT 'world', 4, 0, pos, url, 'world' FROM ranked),
    own AS (SELECT *, row_number() OVER (PARTITION BY source, url ORDER BY feed_rank, pos) AS r1 FROM entries),
    capped AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY feed_rank, pos) AS r2 FROM own WHERE r1 = 1),
    claimed AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY source_rank) AS r3 FROM capped WHERE r2 <= 150),
    wanted AS (SELECT source, source_rank, feed_rank, pos, url, title FROM claimed WHERE r3 = 1)"""


@query("claim_urls", f"WITH {CLAIMS} SELECT source, url, pos, title FROM wanted")
def claim_urls_query(spark, sf):
    return claim_urls(feed_entries(spark, sf)).select("source", "url", "pos", "title")


def paragraph_sql(longer: int) -> str:
    """First long paragraph of the pages' markup: ``<p>`` pieces in order; a piece that starts with an
    unclosed ``<b>`` reaches to the end of the article."""
    def text(x):
        spaced = f"regexp_replace({x}, '<[^>]*>', chr(1), 'g')"
        decoded = f"""replace(replace({spaced}, '&quot;', '"'), '&amp;', '&')"""
        return f"""array_to_string(list_filter(list_transform(string_split({decoded}, chr(1)), lambda s: trim(s)), lambda s: s <> ''), ' ')"""

    return f"""body AS (SELECT page_id, string_split(regexp_extract(html, '(?s)<article>(.*)</article>', 1), '<p>') AS parts FROM pages),
    pieces AS (SELECT page_id, i, CASE WHEN parts[i] LIKE '<b>%' THEN array_to_string(parts[i:], '<p>')
        ELSE split_part(parts[i], '</p>', 1) END AS piece
      FROM (SELECT page_id, parts, unnest(generate_series(2, len(parts))) AS i FROM body)),
    texts AS (SELECT page_id, i, {text('piece')} AS t FROM pieces),
    paragraph AS (SELECT page_id, min_by(t, i) AS first_paragraph FROM texts WHERE length(t) > {longer} GROUP BY page_id)"""


def _extract(name, rule, longer):
    @query(
        name,
        f"""WITH {paragraph_sql(longer)}
        SELECT page_id, {TITLE_SQL} AS title, '' AS published_date_new_york,
          coalesce(first_paragraph, '') AS first_paragraph FROM pages LEFT JOIN paragraph USING (page_id)""",
    )
    def run(spark, sf):
        use_utc(spark)
        return extract_articles(table(spark, sf, "pages").select("page_id", "html"), rule).drop("error")


_extract("extract_articles_feed", "feed", 60)
_extract("extract_articles_standalone", "standalone", 50)


@query(
    "land_articles",
    f"""WITH {CLAIMS}, {paragraph_sql(60)}
    SELECT w.source, {TITLE_SQL} AS title, w.url, '' AS published_date_new_york, first_paragraph
    FROM wanted w JOIN pages p USING (url) JOIN paragraph g ON g.page_id = p.page_id WHERE {TITLE_SQL} <> ''""",
)
def land_articles_query(spark, sf):
    use_utc(spark)
    return land_articles(feed_entries(spark, sf), table(spark, sf, "pages"))


@query(
    "land_feeds",
    f"""WITH {LANDED_SQL}, {paragraph_sql(60)},
    own AS (SELECT *, row_number() OVER (PARTITION BY source, url ORDER BY feed_rank, batch, pos) AS r1 FROM landed),
    capped AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY feed_rank, batch, pos) AS r2 FROM own WHERE r1 = 1),
    claimed AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY source_rank) AS r3 FROM capped WHERE r2 <= 150)
    SELECT c.source, {TITLE_SQL.replace('html', 'p.html')} AS title, c.url, '' AS published_date_new_york, first_paragraph
    FROM claimed c JOIN pages p USING (url) JOIN paragraph g ON g.page_id = p.page_id WHERE r3 = 1 AND {TITLE_SQL.replace('html', 'p.html')} <> ''""",
)
def land_feeds(spark, sf):
    """From landed feed files and fetched pages to article records."""
    use_utc(spark)
    return land_articles(landed_feeds(spark, sf), table(spark, sf, "pages"), place=("feed_rank", "batch", "pos"))


# --- upsert ------------------------------------------------------------------------------------


@query(
    "upsert_by_key",
    """WITH t AS (SELECT 'doc/' || doc_id AS url, source, text AS first_paragraph, lang AS title, n_chars AS embedding,
        'old' AS created FROM documents WHERE lang <> 'de'),
      i AS (SELECT 'doc/' || doc_id AS url, upper(source) AS source, 'new ' || text AS first_paragraph, 'new ' || lang AS title,
        -n_chars AS embedding FROM documents WHERE lang <> 'en')
    SELECT url, coalesce(t.source, i.source) AS source, coalesce(t.created, 'now') AS created,
      CASE WHEN i.url IS NULL THEN t.title ELSE i.title END AS title,
      CASE WHEN i.url IS NULL THEN t.first_paragraph ELSE i.first_paragraph END AS first_paragraph,
      CASE WHEN i.url IS NULL THEN t.embedding ELSE i.embedding END AS embedding
    FROM t FULL JOIN i USING (url)""",
)
def upsert_query(spark, sf):
    """A batch of three languages into a table that already holds two of them and one more."""
    docs = table(spark, sf, "documents").withColumn("url", F.concat(F.lit("doc/"), F.col("doc_id").cast("string")))
    target = docs.filter(F.col("lang") != "de").select(
        "url", "source", F.lit("old").alias("created"), F.col("lang").alias("title"),
        F.col("text").alias("first_paragraph"), F.col("n_chars").alias("embedding"),
    )
    incoming = docs.filter(F.col("lang") != "en").select(
        "url", F.upper("source").alias("source"), F.concat(F.lit("new "), F.col("lang")).alias("title"),
        F.concat(F.lit("new "), F.col("text")).alias("first_paragraph"), (-F.col("n_chars")).alias("embedding"),
    )
    return upsert_by_key(target, incoming, defaults={"created": F.lit("now")})
