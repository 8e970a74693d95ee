"""Bars from raw ticks: what a market-data service delivers ready-made."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MINUTE_MS = 60_000
HOUR_MS = 60 * MINUTE_MS


def bars_from_ticks(
    ticks: DataFrame,
    symbol: Column,
    ts: Column,
    price: Column,
    tie: Column,
    every_ms: int = MINUTE_MS,
    size: Column | None = None,
) -> DataFrame:
    """One OHLCV bar per symbol and interval; ticks of one instant are ordered by ``tie``.

    A single aggregate with map-side combine: a symbol holding most ticks still reaches the
    shuffle as one partial row per bar and input task.
    """
    ms = F.unix_millis(ts.cast("timestamp"))
    rows = ticks.select(
        symbol.alias("symbol"),
        (ms - F.pmod(ms, F.lit(every_ms))).alias("timestamp"),
        F.struct(ts.alias("ts"), tie.alias("tie")).alias("at"),
        price.cast("double").alias("price"),
        (price if size is None else size).cast("double").alias("size"),
    )
    bars = rows.groupBy("symbol", "timestamp").agg(
        F.min_by("price", "at").alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max_by("price", "at").alias("close"),
        F.sum("size").alias("volume"),
        F.try_divide(F.sum(F.col("price") * F.col("size")), F.sum("size")).alias("vwap"),
        F.count(F.lit(1)).alias("transactions"),
    )
    return bars.select(
        "symbol",
        "timestamp",
        F.timestamp_millis("timestamp").alias("date"),
        "open",
        "high",
        "low",
        "close",
        "volume",
        "vwap",
        "transactions",
    )
