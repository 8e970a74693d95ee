"""Not-modified revisit resolution of web-archive records.

A revisit (status 304) is resolved by an as-of join: the latest full response (status 200) of the
same canonical URL that was captured before it. The response is taken if a validator of the revisit
agrees with its own (entity tag, else modification date; weak tags compare without their prefix); its
headers are then updated with the headers a 304 may update, all others stay as stored.

The join is no window over a URL. Records are sorted by URL and time over all partitions, so a URL
with a third of all rows is spread over many tasks; each partition looks back by itself, and the last
response of every partition, one row each, is carried on to the partitions after it. Spark broadcasts
these rows where their written size is within the session's threshold, and else shuffles them to the
revisits of their partition.

Records without a canonical URL, or a time, resolve to nothing. Ties in time are ordered by record id, and
a response with the revisit's own time counts as earlier if its id is smaller. A null header map is
empty, a null validator agrees with nothing. Repeated rows are records of their own. Without
records there are no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gazetick.session import stage

FULL, NOT_MODIFIED = 200, 304
#: Headers that a 304 response carries and that replace the stored ones.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
RESOLVED, CHANGED, MISSING = "resolved", "validator_mismatch", "no_response"


def canonical_url(url: Column) -> Column:
    """Host in lower case without ``www.``, path without a closing slash, query with sorted parts and
    without ``utm_`` ones; no scheme, default port or fragment."""
    whole = F.regexp_replace(F.trim(url), "#.*$", "")
    bare = F.regexp_replace(whole, "^(?i:https?)://", "")
    address, asked = F.regexp_extract(bare, r"^([^?]*)", 1), F.regexp_extract(bare, r"\?(.*)$", 1)
    host = F.regexp_replace(F.lower(F.regexp_extract(address, "^([^/]*)", 1)), r"^www\.|:(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(address, "^[^/]*(.*)$", 1), "/+$", "")
    parts = F.array_sort(F.filter(F.split(asked, "&"), lambda p: (p != "") & ~p.startswith("utm_")))
    query = F.when(F.size(parts) > 0, F.concat(F.lit("?"), F.array_join(parts, "&"))).otherwise("")
    return F.nullif(F.concat(host, path, query), F.lit(""))


def header(headers: Column, name: str) -> Column:
    return F.element_at(headers, F.lit(name))


def validated(revisit: Column, response: Column) -> Column:
    """Whether a validator of the 304 agrees with the stored response's."""
    tag = lambda h: F.regexp_replace(header(h, "etag"), "^W/", "")
    dated = lambda h: header(h, "last-modified")
    agrees = F.when(tag(revisit).isNotNull(), tag(revisit) == tag(response)).otherwise(dated(revisit) == dated(response))
    return F.coalesce(agrees, F.lit(False))


def merged(response: Column, revisit: Column) -> Column:
    """Stored headers, with the permitted ones of the 304 in place of theirs."""
    fresh = F.map_filter(revisit, lambda k, v: k.isin(*PERMITTED) & v.isNotNull())
    kept = F.map_filter(response, lambda k, v: ~F.map_contains_key(fresh, k))
    return F.map_concat(kept, fresh)


def resolve_revisits(records: DataFrame) -> DataFrame:
    """One row per revisit: ``record_id, url_key, state, response_id, headers``.

    ``records``: ``record_id long, url string, captured timestamp or long, status int, headers
    map<string,string>`` with lower-case names; further columns are not read. Bodies stay where they
    are: join ``response_id`` with the records to fetch them.
    """
    kind = records.select("record_id").dtypes[0][1]
    empty = F.create_map().cast("map<string,string>")
    narrow = records.filter(F.col("status").isin(FULL, NOT_MODIFIED)).select(
        "record_id", canonical_url(F.col("url")).alias("url_key"), "captured", "status", F.coalesce("headers", empty).alias("headers")
    )
    usable = narrow.filter("url_key is not null and captured is not null")
    response = F.when(F.col("status") == FULL, F.struct("record_id", "headers"))
    ordered = usable.withColumn("_r", response).repartitionByRange("url_key", "captured", "record_id")
    # The partition is read off once and written down, so that later reads agree on it.
    ordered = stage(ordered.sortWithinPartitions("url_key", "captured", "record_id").withColumn("_part", F.spark_partition_id()))
    order = [F.col("captured"), F.col("record_id")]
    so_far = Window.partitionBy("_part", "url_key").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = ordered.withColumn("_seen", F.last("_r", ignorenulls=True).over(so_far)).filter(F.col("status") == NOT_MODIFIED)

    place = F.struct("url_key", "captured", "record_id")
    lasts = ordered.filter("_r is not null").groupBy("_part").agg(F.max_by(F.struct("url_key", "_r"), place).alias("_last"))
    firsts = ordered.groupBy("_part").agg(F.min("url_key").alias("_first"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each partition: what the partitions before it left of its first URL.
    carried = firsts.join(lasts, "_part", "left").withColumn("_last", F.last("_last", ignorenulls=True).over(before))
    carried = carried.filter(F.col("_last.url_key") == F.col("_first")).select("_part", F.col("_first").alias("url_key"), F.col("_last._r").alias("_carried"))
    # Headers have any length: written first, the table has a size by which Spark chooses how to join it.
    found = inside.join(stage(carried), ["_part", "url_key"], "left").withColumn("_r", F.coalesce("_seen", "_carried"))

    good = validated(F.col("headers"), F.col("_r.headers"))
    state = F.when(F.col("_r").isNull(), MISSING).when(good, RESOLVED).otherwise(CHANGED)
    resolved = found.select(
        "record_id", "url_key", state.alias("state"), F.when(good, F.col("_r.record_id")).alias("response_id"),
        F.when(good, merged(F.col("_r.headers"), F.col("headers"))).alias("headers"),
    )
    lost = narrow.filter(F.col("status") == NOT_MODIFIED).filter("url_key is null or captured is null").select(
        "record_id", "url_key", F.lit(MISSING).alias("state"), F.lit(None).cast(kind).alias("response_id"), F.lit(None).cast("map<string,string>").alias("headers")
    )
    return resolved.unionByName(lost)
