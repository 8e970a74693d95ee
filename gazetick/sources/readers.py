"""Readers for labelled news CSV, article JSON, feed XML and market-bar JSON."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

NEWS_COLUMNS = ("Title", "Category", "URL", "Group Leader")
ARTICLE_COLUMNS = ("source", "title", "url", "published_date_new_york", "first_paragraph")


def _strings(names: Iterable[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


BAR_RESULT = T.StructType(
    [T.StructField(n, T.DoubleType()) for n in ("v", "vw", "o", "c", "h", "l")]
    + [T.StructField(n, T.LongType()) for n in ("t", "n")]
)


def read_news_csv(
    spark: SparkSession,
    path: str | list[str],
    columns: Sequence[str] = NEWS_COLUMNS,
    require: Sequence[str] = (),
) -> DataFrame:
    """Labelled headlines; quoted fields may hold newlines and doubled quotes.

    ``columns`` are the header's names in file order: a fixed schema saves the inference pass.
    """
    df = spark.read.csv(
        path, schema=_strings(columns), header=True, multiLine=True, escape='"', enforceSchema=False
    )
    return df.na.drop(subset=list(require)) if require else df


def read_articles_json(spark: SparkSession, path: str | list[str], schema: T.StructType | None = None) -> DataFrame:
    """Article records, as one JSON array per file or one record per line of a landed folder."""
    return spark.read.json(path, schema=schema or _strings(ARTICLE_COLUMNS), multiLine=True)


def read_article_lines(spark: SparkSession, path: str | list[str], schema: T.StructType | None = None) -> DataFrame:
    """JSON-lines form of :func:`read_articles_json`; splittable, so the one to land large data in."""
    return spark.read.json(path, schema=schema or _strings(ARTICLE_COLUMNS))


def read_feed(spark: SparkSession, path: str | list[str], catalog: DataFrame | None = None) -> DataFrame:
    """RSS items of landed feed files: ``pos, url, title, rss_date`` and the columns of the folder.

    Feeds are landed under ``source=.../feed_rank=.../``, and those names become columns. With the
    catalog (one row a feed) its ``source_rank`` is added. ``pos`` is the item's 0-based place in its
    own file; a feed is one small document, read as one row. Blank fields are ``""``. A file that is
    not well formed fails the job rather than losing its items.
    """
    item = T.ArrayType(_strings(("link", "title", "pubDate")))
    schema = T.StructType([T.StructField("item", item)])
    feeds = spark.read.format("xml").option("rowTag", "channel").option("mode", "FAILFAST").schema(schema).load(path)
    folder = [c for c in feeds.columns if c != "item"]
    blank = F.lit("")
    items = feeds.select(*folder, F.posexplode("item").alias("pos", "_i")).select(
        *folder,
        "pos",
        F.coalesce(F.trim("_i.link"), blank).alias("url"),
        F.coalesce("_i.title", blank).alias("title"),
        F.coalesce("_i.pubDate", blank).alias("rss_date"),
    )
    if catalog is None:
        return items
    ranks = catalog.select("source", "source_rank").distinct()  # one row a source of the user's own list
    return items.join(F.broadcast(ranks), "source")


def read_bars(spark: SparkSession, path: str | list[str], symbol: str | None = None, lines: bool = False) -> DataFrame:
    """Range responses with a ``results`` array each; a response without one adds no rows.

    A file holds one response, or with ``lines`` one response per line. Without ``symbol`` the files
    of all symbols are read at once, landed under ``symbol=.../``.
    """
    body = T.StructType([T.StructField("results", T.ArrayType(BAR_RESULT))])
    raw = spark.read.json(path, schema=body, multiLine=not lines)
    name = F.col("symbol") if symbol is None else F.lit(symbol).alias("symbol")
    return raw.select(name, F.explode("results").alias("r")).select("symbol", "r.*")
