"""The feeds that are landed, in the order that decides which source owns a URL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Source -> feed addresses, and the per-source limit.
FEEDS = {
    "BBC": [
        "https://feeds.bbci.co.uk/news/rss.xml",
        "https://feeds.bbci.co.uk/news/world/rss.xml",
        "https://feeds.bbci.co.uk/news/business/rss.xml",
        "https://feeds.bbci.co.uk/news/technology/rss.xml",
        "https://feeds.bbci.co.uk/news/health/rss.xml",
    ],
    "NPR": [
        "https://feeds.npr.org/1001/rss.xml",
        "https://feeds.npr.org/1004/rss.xml",
        "https://feeds.npr.org/1007/rss.xml",
    ],
    "Guardian": [
        "https://www.theguardian.com/international/rss",
        "https://www.theguardian.com/world/rss",
        "https://www.theguardian.com/us-news/rss",
    ],
    "CBS": ["https://www.cbsnews.com/latest/rss/main"],
    "NBC": ["https://feeds.nbcnews.com/nbcnews/public/news"],
    "FOX": ["https://moxie.foxnews.com/google-publisher/latest.xml"],
    "CNN": [
        "http://rss.cnn.com/rss/edition.rss",
        "http://rss.cnn.com/rss/edition_world.rss",
        "http://rss.cnn.com/rss/edition_technology.rss",
    ],
}
ARTICLES_PER_SITE = 150


def source_catalog(spark: SparkSession, feeds: dict[str, list[str]] = FEEDS) -> DataFrame:
    """``source, source_rank, feed_rank, url``; ranks follow the catalog order."""
    rows = [
        (source, rank, feed_rank, url)
        for rank, (source, urls) in enumerate(feeds.items())
        for feed_rank, url in enumerate(urls)
    ]
    return spark.createDataFrame(rows, "source string, source_rank int, feed_rank int, url string")
