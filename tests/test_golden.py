"""Hand-written rows for rules that no table covers, and error paths."""

import datetime as dt
import math

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from gazetick.functions import dates, text
from gazetick.functions.markup import feed_fields, standalone_fields
from gazetick.functions.stem import stem_tokens
from gazetick.operators import articles, bars, columns, textfeatures
from gazetick.operators.annotate import annotate_entities
from gazetick.operators.profile import cluster_summary
from gazetick.operators.upsert import upsert_by_key
from gazetick.plans import lookup
from gazetick.plans.position import ranked
from gazetick.sources import readers


def one(spark, value, make, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(make(F.col("x")).alias("y")).first().y


STEMS = """caresses caress ponies poni caress caress cats cat feed feed agreed agree plastered plaster bled bled motoring motor
    sing sing conflated conflate troubled trouble sized size hopping hop falling fall freeing fre filing fil happy happi sky sky""".split()


def test_stems(spark):
    words = STEMS[::2]
    got = one(spark, words, stem_tokens, "array<string>")
    assert dict(zip(words, got)) == dict(zip(words, STEMS[1::2]))


def test_urls_entities_and_punctuation(spark):
    assert one(spark, "See HTTP://X.com and https://a.b/c www.d.e wwwfoo", text.remove_urls) == "See HTTP://X.com and   wwwfoo"
    assert one(spark, "AT&T &amp; co &#39;s", text.remove_html_entities) == "AT&T  co &#39;s"
    assert one(spark, "Don't — “quoted”, it's", text.remove_punctuation) == "Dont — “quoted” its"
    assert one(spark, "dont it's the cat", lambda c: text.remove_stopwords(text.tokenize(c))) == ["dont", "cat"]


MOMENT = dt.datetime(2024, 7, 1, 16, 5, 0)
LAYOUTS = {
    "2024-07-01T16:05:00Z": "2024-07-01 12:05:00", "2024-07-01 16:05:00": "2024-07-01 12:05:00", "2024-07-01T18:05:00+02:00": "2024-07-01 12:05:00",
    "2024-07-01T16:05:00.250Z": "2024-07-01 12:05:00", "2024-07-01": "2024-06-30 20:00:00",
    "Mon, 01 Jul 2024 16:05:00 GMT": "2024-07-01 12:05:00", "Mon, 1 Jul 2024 18:05:00 +0200": "2024-07-01 12:05:00",
    "1 Jul 2024 18:05 +0200": "2024-07-01 12:05:00", "1 July 2024 18:05:00 +0200": "2024-07-01 12:05:00",
    "Jul 1, 2024 18:05:00 +0200": "2024-07-01 12:05:00", "July 1, 2024 18:05:00 +0200": "2024-07-01 12:05:00",
    "1 Jul 2024 16:05:00": "2024-07-01 12:05:00", "1 Jul 2024 16:05": "2024-07-01 12:05:00", "1 Jul 2024": "2024-06-30 20:00:00",
    "1 July 2024 16:05:00": "2024-07-01 12:05:00", "1 July 2024 16:05": "2024-07-01 12:05:00", "1 July 2024": "2024-06-30 20:00:00",
    "Jul 1, 2024 4:05 PM": "2024-07-01 12:05:00", "July 1, 2024 4:05 PM": "2024-07-01 12:05:00",
    "Jul 1, 2024 16:05:00": "2024-07-01 12:05:00", "July 1, 2024 16:05:00": "2024-07-01 12:05:00",
    "Jul 1, 2024": "2024-06-30 20:00:00", "July 1, 2024": "2024-06-30 20:00:00",
    "7/1/2024 16:05:00": "2024-07-01 12:05:00", "7/1/2024 4:05 PM": "2024-07-01 12:05:00", "7/1/2024 16:05": "2024-07-01 12:05:00",
    "7/1/2024": "2024-06-30 20:00:00", "2024-01-01 12:00:00": "2024-01-01 07:00:00", "garbage": "", "": "", None: "",
}


def test_every_date_layout(spark):
    rows = spark.createDataFrame([(k,) for k in LAYOUTS], "x string").select("x", dates.to_newyork(F.col("x")).alias("y")).collect()
    assert {r.x: r.y for r in rows} == LAYOUTS


def test_page_dates_and_titles():
    long = "<p>" + "word " * 20 + "</p>"
    assert feed_fields(f'<h1>T</h1><time datetime="2024-07-01">x</time>{long}')[:2] == ("T", "2024-07-01")
    both = f'<meta property="article:published_time" content="2024-07-02"><time></time>{long}'
    assert feed_fields(both)[1] == "2024-07-02" and standalone_fields(both)[1] == ""
    assert standalone_fields(f'<meta property="og:title" content="O">{long}')[0] == "O"
    assert feed_fields(f'<meta property="og:title" content="O">{long}')[0] is None


def test_unreadable_pages_are_reported(spark, monkeypatch):
    monkeypatch.setitem(articles.RULES, "feed", lambda html: 1 / 0 if "bad" in html else ("T", "", "p"))
    pages = spark.createDataFrame([(1, "ok"), (2, "bad"), (3, "bad too")], "page_id int, html string")
    assert [(r.error, r.pages) for r in articles.extraction_errors(articles.extract_articles(pages)).collect()] == [("ZeroDivisionError: division by zero", 2)]


def test_upsert(spark):
    schema = "url string, title string, first_paragraph string, embedding int, created string"
    target = spark.createDataFrame([("a", "A", "pa", 1, "old"), ("b", "B", "pb", 2, "old")], schema)
    batch = spark.createDataFrame([("b", "B2", "pb2", 3), ("c", "C", "pc", 4)], "url string, title string, first_paragraph string, embedding int")
    once = upsert_by_key(target, batch, defaults={"created": F.lit("now")})
    want = [("a", "A", "pa", 1, "old"), ("b", "B2", "pb2", 3, "old"), ("c", "C", "pc", 4, "now")]
    assert sorted(map(tuple, once.collect())) == want
    assert sorted(map(tuple, upsert_by_key(once, batch, defaults={"created": F.lit("now")}).collect())) == want
    with pytest.raises(PySparkException, match="occurs twice"):
        upsert_by_key(target, batch.union(batch.limit(1))).collect()


def test_columns(spark):
    frame = spark.createDataFrame([(1, 2)], "` A ` int, b int")
    assert columns.normalise_columns(frame).columns == ["a", "b"]
    with pytest.raises(ValueError, match="missing columns"):
        columns.require_columns(frame, "title")
    with pytest.raises(ValueError, match="collide"):
        columns.normalise_columns(spark.createDataFrame([(1, 2)], "` a` int, `A` int"))


def bar_frame(spark, closes, volumes=None):
    volumes = volumes or [100.0] * len(closes)
    rows = [("s", i * 60_000, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=i), c, c, c, c, v, c, 1) for i, (c, v) in enumerate(zip(closes, volumes))]
    return spark.createDataFrame(rows, "symbol string, timestamp long, date timestamp, open double, high double, low double, close double, volume double, vwap double, transactions long")


def test_flat_prices_and_zero_volume(spark):
    closes = [100 + math.sin(i) * 3.7 for i in range(150)] + [97.123] * 60
    volumes = [100.0] * 120 + [0.0, 5.0] + [100.0] * 88
    rows = bars.bar_features(bar_frame(spark, closes, volumes)).orderBy("timestamp").collect()
    for r in rows[175:]:
        assert abs(r.BB_position) < 5e-7 and abs(r.BB_width) < 1e-12 and r.MA_20 == pytest.approx(97.123, abs=1e-12)
    assert rows[121].volume_change is None and rows[120].volume_change == -1
    assert len(bars.feature_names()) == 63


def test_seventy_feature_columns(spark):
    frame = bars.label_and_split(columns.drop_nonfinite(bars.bar_features(bar_frame(spark, [50 + i % 7 + i / 10 for i in range(180)], [1.0 + i % 3 for i in range(180)]))))
    names = columns.feature_columns(frame)
    assert len(names) == 70 and not {"pos", "split_pos", "target", "split"} & set(names)


def test_documents_without_terms_stay(spark):
    docs = spark.createDataFrame([(1, "alpha beta"), (2, ""), (3, None)], "id long, text string")
    weights = textfeatures.tfidf(docs, "id", "text", max_features=10)
    rows = {r.id: list(r.idx) for r in textfeatures.sparse_rows(weights, textfeatures.term_index(weights), "id", docs).collect()}
    assert rows == {1: [0, 1], 2: [], 3: []}


def test_long_phrases_match(spark):
    docs = spark.createDataFrame([(1, "We saw One two three four five six, today"), (2, None)], "id long, text string")
    gazetteer = spark.createDataFrame([("one two", "S"), ("one two three four five six", "L")], "phrase string, label string")
    rows = {r.id: r.entities for r in annotate_entities(docs, "id", "text", gazetteer).collect()}
    assert [tuple(e) for e in rows[1]] == [("One two three four five six", "L")] and rows[2] is None
    assert annotate_entities(docs, "id", "text", gazetteer.limit(0)).filter("id = 1").first().entities == []


def test_ranks_and_lookups(spark, monkeypatch):
    frame = spark.createDataFrame([(f"k{i:03}", i) for i in range(200)], "k string, v int").repartition(7)
    assert all(r.at == r.v for r in ranked(frame, ["k"], "at").collect())
    rows = spark.createDataFrame([("k001", i) for i in range(50)] + [("none", 50)], "k string, id int")
    monkeypatch.setattr(lookup, "BROADCAST_TERMS", 10)
    joined = lookup.lookup_join(rows, frame, ["k"], F.col("id"), "left")
    assert joined.count() == 51 and joined.filter("v = 1").count() == 50


def test_broken_feeds_fail(spark, tmp_path):
    good, bad = tmp_path / "good" / "source=A" / "feed_rank=0", tmp_path / "bad" / "source=A" / "feed_rank=0"
    for folder, content in ((good, "<rss><channel><item><title>a</title><link> u </link></item><item><title>b</title></item></channel></rss>"), (bad, "<rss><channel><item><title>a</item></channel></rss>")):
        folder.mkdir(parents=True)
        (folder / "f.xml").write_text(content)
    rows = readers.read_feed(spark, str(tmp_path / "good")).collect()
    assert [(r.source, r.feed_rank, r.pos, r.url, r.title, r.rss_date) for r in rows] == [("A", 0, 0, "u", "a", ""), ("A", 0, 1, "", "b", "")]
    with pytest.raises(Exception, match="FAILED_READ_FILE|MALFORMED"):
        readers.read_feed(spark, str(tmp_path / "bad")).collect()


def test_cluster_summary(spark):
    rows = cluster_summary(spark.createDataFrame([(c,) for c in (-1, -1, 0, 0, 0, 4)], "cluster int")).collect()
    assert sorted(map(tuple, rows)) == [(-1, 2, 2, 2), (0, 3, 2, 2), (4, 1, 2, 2)]
