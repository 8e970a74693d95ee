"""Not-modified revisit resolution: query and statement.

Each page is a full response, captured at its id, and is asked for again later by a revisit whose
entity tag is the page's own, another one (ids divisible by 5), or missing with only a date (by 7).
"""

from pyspark.sql import functions as F

from gazetick.llm.queries.registry import query, table
from gazetick.llm.revisits import resolve_revisits

LATER = 50  # how much later, in ids, a page is asked for again

_HOST = r"regexp_replace(lower(regexp_extract(address, '^([^/]*)', 1)), '^www\.|:(80|443)$', '', 'g')"
SQL = rf"""WITH bare AS (SELECT page_id, html, regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^(?i:https?)://', '') AS bare FROM pages),
  cut AS (SELECT *, regexp_extract(bare, '^([^?]*)', 1) AS address, regexp_extract(bare, '\?(.*)$', 1) AS asked FROM bare),
  keyed AS (SELECT page_id, md5(html) AS tag, length(html) AS size, {_HOST} || regexp_replace(regexp_extract(address, '^[^/]*(.*)$', 1), '/+$', '')
      || CASE WHEN asked <> '' AND len(list_filter(string_split(asked, '&'), lambda p: p <> '' AND NOT starts_with(p, 'utm_'))) > 0
         THEN '?' || array_to_string(list_sort(list_filter(string_split(asked, '&'), lambda p: p <> '' AND NOT starts_with(p, 'utm_'))), '&') ELSE '' END AS url_key
    FROM cut),
  asks AS (SELECT page_id, url_key, page_id + {LATER} AS captured, CASE WHEN page_id % 7 = 0 THEN NULL WHEN page_id % 5 = 0 THEN 'other' ELSE tag END AS tag,
      'day ' || page_id % 30 AS dated FROM keyed),
  latest AS (SELECT a.page_id, a.url_key, a.tag AS asked_tag, a.dated AS asked_date, max(k.page_id) AS response
    FROM asks a LEFT JOIN keyed k ON k.url_key = a.url_key AND k.page_id < a.captured GROUP BY ALL),
  checked AS (SELECT l.*, r.tag, r.size, coalesce(CASE WHEN asked_tag IS NOT NULL THEN asked_tag = r.tag ELSE asked_date = 'day ' || response % 30 END, false) AS good
    FROM latest l LEFT JOIN keyed r ON r.page_id = l.response)
  SELECT page_id, url_key, CASE WHEN response IS NULL THEN 'no_response' WHEN good THEN 'resolved' ELSE 'validator_mismatch' END AS state,
    CASE WHEN good THEN response END AS response_page,
    CASE WHEN good THEN 'content-length=' || size || ';date=' || (page_id + {LATER}) || ';etag=' || coalesce(asked_tag, tag) || ';last-modified=' || asked_date || ';server=a' END AS headers
  FROM checked"""


def captures(pages):
    """Records of the pages: responses have even record ids, revisits the odd one that follows."""
    text = lambda c: c.cast("string")
    id, dated = F.col("page_id"), F.concat(F.lit("day "), text(F.col("page_id") % 30))
    tag = F.md5("html")
    full = pages.select(
        (id * 2).alias("record_id"), "url", id.alias("captured"), F.lit(200).alias("status"),
        F.create_map(F.lit("etag"), tag, F.lit("last-modified"), dated, F.lit("content-length"), text(F.length("html")), F.lit("server"), F.lit("a"), F.lit("date"), text(id)).alias("headers"),
    )
    asked = F.when(id % 7 == 0, F.lit(None)).when(id % 5 == 0, F.lit("other")).otherwise(tag)
    again = pages.select(
        (id * 2 + 1).alias("record_id"), "url", (id + LATER).alias("captured"), F.lit(304).alias("status"),
        F.create_map(F.lit("etag"), asked, F.lit("last-modified"), dated, F.lit("content-length"), F.lit("0"), F.lit("server"), F.lit("b"), F.lit("date"), text(id + LATER)).alias("headers"),
    )
    return full.unionByName(again)


@query("op8_revisits", SQL)
def op8_revisits(spark, sf):
    found = resolve_revisits(captures(table(spark, sf, "pages").select("page_id", "url", "html")))
    lines = F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat_ws("=", e.key, e.value))
    return found.select(
        F.shiftright("record_id", 1).alias("page_id"), "url_key", "state", F.shiftright("response_id", 1).alias("response_page"),
        F.when(F.col("headers").isNotNull(), F.array_join(lines, ";")).alias("headers"),
    )
