"""Registered queries with the DuckDB statement each is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
TIE_SHIFT = 1.7e-9


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def r6(x: Column | str) -> Column:
    """Six decimals, and no negative zero.

    Sums differ in their last bits between engines; the shift keeps values that sit exactly on half a
    unit from being rounded to different sides.
    """
    return F.round((F.col(x) if isinstance(x, str) else x) + F.lit(TIE_SHIFT), 6) + F.lit(0.0)


def sql_r6(x: str) -> str:
    return f"(round(({x}) + {TIE_SHIFT}::DOUBLE, 6) + 0.0::DOUBLE)"
