import random

from gazetick.llm import revisits as R
from pyspark.sql import functions as F

SCHEMA = "record_id long, url string, captured long, status int, headers map<string,string>, state string, _part int"


def test_canonical_url(spark):
    cases = {
        "HTTP://WWW.Example.com:80/a/b/?b=2&utm_source=x&a=1#top": "example.com/a/b?a=1&b=2",
        "https://example.com/": "example.com",
        "https://m.example.com/A": "m.example.com/A",
        "example.com?x=1": "example.com?x=1",
        "https://example.com/p?utm_x=1": "example.com/p",
        "https://example.com:8080/p": "example.com:8080/p",
        "": None,
        None: None,
    }
    rows = spark.createDataFrame([(k,) for k in cases], "url string").select("url", R.canonical_url(F.col("url")).alias("key")).collect()
    assert {r.url: r.key for r in rows} == cases


def by_hand(records, key):
    out = []
    for id, url, at, status, headers, *_ in records:
        if status != 304:
            continue
        mine, before = headers or {}, []
        if key(url) is not None and at is not None:
            before = [r for r in records if r[3] == 200 and r[2] is not None and key(r[1]) == key(url) and (r[2], r[0]) < (at, id)]
        if not before:
            out.append((id, "no_response", None, None))
            continue
        response = max(before, key=lambda r: (r[2], r[0]))
        stored = response[4] or {}
        tag = lambda h: h.get("etag")[2:] if (h.get("etag") or "").startswith("W/") else h.get("etag")
        good = tag(mine) == tag(stored) if tag(mine) is not None else mine.get("last-modified") is not None and mine.get("last-modified") == stored.get("last-modified")
        if good:
            headers = stored | {k: v for k, v in mine.items() if k in R.PERMITTED and v is not None}
            out.append((id, "resolved", response[0], headers))
        else:
            out.append((id, "validator_mismatch", None, None))
    return sorted(out, key=lambda r: r[0])


def test_against_brute_force(spark):
    rng = random.Random(8)
    records = []
    for i in range(900):
        url = "http://hot.example/" if i % 3 == 0 else rng.choice(["http://a.example/x", "https://www.a.example/x/", "http://b.example/?q=1", "", None])
        headers = rng.choice([None, {}, {"etag": rng.choice(["1", "2", 'W/1', None])}, {"last-modified": rng.choice(["m", "n"]), "server": "s", "date": str(i)}, {"etag": "1", "content-length": "9", "vary": "v"}])
        records.append((i, url, rng.choice([None] + list(range(300))), rng.choice([200, 304, 304, 404, None]), headers, "x", 1))
    records.append((9999, "http://a.example/" + "y" * 50_000, 1, 304, {}, "x", 1))
    frame = spark.createDataFrame(records, SCHEMA)
    key = {r.url: r.key for r in frame.select("url", R.canonical_url(F.col("url")).alias("key")).distinct().collect()}
    got = sorted(((r.record_id, r.state, r.response_id, r.headers) for r in R.resolve_revisits(frame).collect()), key=lambda r: r[0])
    assert got == by_hand(records, key.get)
    assert {r[1] for r in got} == {"resolved", "no_response", "validator_mismatch"}
    assert R.resolve_revisits(frame.limit(0)).count() == 0


def test_last_responses_are_carried_over_partitions(spark):
    rows = [(0, "http://hot/", 0, 200, {"etag": "t"}, "x", 1)] + [(i, "http://hot/", i, 304, {"etag": "t"}, "x", 1) for i in range(1, 2000)]
    frame = spark.createDataFrame(rows, SCHEMA)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = R.resolve_revisits(frame).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(found) == 1999 and {(r.state, r.response_id) for r in found} == {("resolved", 0)}
