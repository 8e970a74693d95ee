"""Free-form dates to New York wall time, and calendar features. Sessions run in UTC."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

NEW_YORK = "America/New_York"
OUT_FORMAT = "yyyy-MM-dd HH:mm:ss"

WEEKDAY_PREFIX = r"^(?i:mon|tue|tues|wed|wednes|thu|thur|thurs|fri|sat|satur|sun)(?i:day)?\.?,?\s+"
# Accepted layouts beyond ISO 8601, tried in this order.
ZONED_FORMATS = [
    "d MMM yyyy HH:mm:ss xx",
    "d MMM yyyy HH:mm xx",
    "d MMMM yyyy HH:mm:ss xx",
    "MMM d, yyyy HH:mm:ss xx",
    "MMMM d, yyyy HH:mm:ss xx",
]
NAIVE_FORMATS = [
    "d MMM yyyy HH:mm:ss",
    "d MMM yyyy HH:mm",
    "d MMM yyyy",
    "d MMMM yyyy HH:mm:ss",
    "d MMMM yyyy HH:mm",
    "d MMMM yyyy",
    "MMM d, yyyy h:mm a",
    "MMMM d, yyyy h:mm a",
    "MMM d, yyyy HH:mm:ss",
    "MMMM d, yyyy HH:mm:ss",
    "MMM d, yyyy",
    "MMMM d, yyyy",
    "M/d/yyyy HH:mm:ss",
    "M/d/yyyy h:mm a",
    "M/d/yyyy HH:mm",
    "M/d/yyyy",
]


def parse_date(text: Column) -> Column:
    """Timestamp of a date text, null when no layout fits. No zone means UTC."""
    bare = F.regexp_replace(F.trim(text), WEEKDAY_PREFIX, "")
    bare = F.regexp_replace(bare, r"\s+(?:GMT|UTC|Z)$", " +0000")
    # Other zone abbreviations are ignored, as if the time were naive.
    bare = F.regexp_replace(bare, r"\s+[A-Z]{3,5}$", "")
    bare = F.regexp_replace(bare, r"\s*([+-]\d{2}):?(\d{2})$", " $1$2")
    iso = r"^(\d{4}-\d{2}-\d{2})[T ](\d{2}:\d{2}(?::\d{2}(?:\.\d+)?)?)\s*(?:([+-]\d{2})(\d{2})|Z)?$"
    iso_text = F.regexp_replace(bare, iso, "$1T$2$3:$4")
    iso_ts = F.when(
        bare.rlike(iso),
        F.try_to_timestamp(F.regexp_replace(iso_text, r":$", "")),
    ).when(bare.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_timestamp(bare))
    layouts = [F.try_to_timestamp(bare, F.lit(fmt)) for fmt in ZONED_FORMATS + NAIVE_FORMATS]
    return F.coalesce(iso_ts, *layouts)


def to_newyork(text: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` in New York; ``""`` when the text is no date."""
    local = F.from_utc_timestamp(parse_date(text), NEW_YORK)
    return F.coalesce(F.date_format(local, OUT_FORMAT), F.lit(""))


def epoch_ms_to_ts(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def time_parts(ts: Column) -> dict[str, Column]:
    """Hour, minute and weekday with Monday = 0."""
    return {"hour": F.hour(ts), "minute": F.minute(ts), "day_of_week": F.weekday(ts)}


def cyclic_encode(value: Column, period: int) -> tuple[Column, Column]:
    """(sin, cos) of the value's place on a circle of ``period`` steps."""
    angle = value * F.lit(2 * math.pi) / F.lit(float(period))
    return F.sin(angle), F.cos(angle)
