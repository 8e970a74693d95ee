"""Landing articles: feed entries and fetched pages in, article records out."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gazetick.functions import markup
from gazetick.functions.dates import to_newyork
from gazetick.functions.text import preprocess_tokens
from gazetick.operators.columns import filter_complete_articles, filter_has_url
from gazetick.operators.ordering import dedupe_keep_first, top_n_per_group
from gazetick.sources.catalog import ARTICLES_PER_SITE

RULES = {"feed": markup.feed_fields, "standalone": markup.standalone_fields}
FIELDS = "title string, date_text string, first_paragraph string, error string"


def page_fields(html: Column, rule: str = "feed") -> Column:
    """struct(title, date_text, first_paragraph, error) of an HTML column.

    Only the page crosses to Python, in Arrow batches. A page that cannot be read gives blanks and
    says why in ``error``, which is null otherwise.
    """
    read = RULES[rule]

    def safe(page):
        try:
            return *read(page or ""), None
        except Exception as fault:  # of one page; it is reported and the others go on
            return None, "", "", f"{type(fault).__name__}: {fault}"

    @F.pandas_udf(FIELDS)
    def fields(pages: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([safe(p) for p in pages], columns=["title", "date_text", "first_paragraph", "error"])

    return fields(html)


def extract_articles(pages: DataFrame, rule: str = "feed", html: str = "html") -> DataFrame:
    """Replace the page by ``title, published_date_new_york, first_paragraph, error``.

    A feed title already on the row is kept when the page has no heading.
    """
    df = pages.withColumn("_f", page_fields(F.col(html), rule))
    known = F.col("title") if "title" in pages.columns else F.lit(None)
    title = F.coalesce(F.col("_f.title"), known, F.lit(""))
    date = F.col("_f.date_text")
    return df.withColumns(
        {
            "title": title,
            "published_date_new_york": to_newyork(date),
            "first_paragraph": F.col("_f.first_paragraph"),
            "error": F.col("_f.error"),
        }
    ).drop("_f", html)


def extraction_errors(extracted: DataFrame) -> DataFrame:
    """``error, pages``: how many pages could not be read, and why."""
    return extracted.filter("error is not null").groupBy("error").agg(F.count(F.lit(1)).alias("pages"))


#: Order of a source's entries; a feed that is landed in several files needs their order between.
PLACE = ("feed_rank", "pos")


def claim_urls(entries: DataFrame, limit: int = ARTICLES_PER_SITE, place: tuple[str, ...] = PLACE) -> DataFrame:
    """Entries to fetch: first sighting per source, first ``limit`` of a source, one source per URL.

    A claim stands whether or not its page can be read later.
    """
    own = dedupe_keep_first(filter_has_url(entries), ["source", "url"], place)
    capped = top_n_per_group(own, ["source"], place, limit)
    return dedupe_keep_first(capped, ["url"], ["source_rank"])


def land_articles(entries: DataFrame, pages: DataFrame, limit: int = ARTICLES_PER_SITE, place: tuple[str, ...] = PLACE) -> DataFrame:
    """Article records of landed feeds and pages.

    Claims are settled before the join, so Python only sees pages that are wanted. ``entries``:
    ``source, source_rank, feed_rank, pos, url, title``; ``pages``: ``url, html``.
    """
    wanted = claim_urls(entries, limit, place).select("source", "source_rank", *place, "url", "title")
    read = extract_articles(wanted.join(pages.select("url", "html"), "url"), "feed")
    complete = filter_complete_articles(read)
    kept = top_n_per_group(complete, ["source"], place, limit)
    return kept.select("source", "title", "url", "published_date_new_york", "first_paragraph")


def preprocess_articles(articles: DataFrame) -> DataFrame:
    """Nine columns: originals, cleaned texts and stemmed tokens of title and paragraph."""
    tokens = articles.withColumns(
        {
            "title_tokens": preprocess_tokens(F.col("title")),
            "first_paragraph_tokens": preprocess_tokens(F.col("first_paragraph")),
        }
    )
    blank = F.lit("")
    return tokens.select(
        F.coalesce("source", blank).alias("source"),
        F.coalesce("url", blank).alias("url"),
        F.coalesce("published_date_new_york", blank).alias("published_date_new_york"),
        F.coalesce("title", blank).alias("original_title"),
        F.array_join("title_tokens", " ").alias("clean_title"),
        "title_tokens",
        F.coalesce("first_paragraph", blank).alias("original_first_paragraph"),
        F.array_join("first_paragraph_tokens", " ").alias("clean_first_paragraph"),
        "first_paragraph_tokens",
    )
