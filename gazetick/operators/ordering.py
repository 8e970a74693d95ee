"""Ordering, limits, duplicates and unions. Order is always explicit; a table has none of its own."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gazetick.plans.position import with_position


def dedupe_keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """First row of every key in ``order``.

    ``rank <= 1`` is pushed below the shuffle, so every task sends one row per key: a key that
    holds a third of the table does not overload the task that receives it.
    """
    return top_n_per_group(df, keys, order, 1)


def top_n_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], n: int, rank: str | None = None
) -> DataFrame:
    """First ``n`` rows of every key; small ``n`` only, see :func:`first_n_per_key`."""
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    kept = ranked.filter(F.col("_rank") <= n)
    return kept.withColumnRenamed("_rank", rank) if rank else kept.drop("_rank")


def dedupe_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def first_n(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    return df.orderBy(*order).limit(n)


def last_n(df: DataFrame, n: int, order: str) -> DataFrame:
    return df.orderBy(F.desc(order)).limit(n).orderBy(order)


def first_n_per_key(df: DataFrame, keys: Sequence[str], order: str, n: int) -> DataFrame:
    """First ``n`` rows of every key for large ``n``, by position instead of by one sort per key.

    ``order`` is integral and unique within a key.
    """
    return with_position(df, [order], keys, out="_pos").filter(F.col("_pos") <= n).drop("_pos")


def limit_per_source(df: DataFrame, n: int, order: Sequence[Column | str], source: str = "source") -> DataFrame:
    return top_n_per_group(df, [source], order, n)


def union_batches(*batches: DataFrame) -> DataFrame:
    """Batches one after the other. Neighbouring date ranges share a day, so dedupe afterwards."""
    out = batches[0]
    for batch in batches[1:]:
        out = out.unionByName(batch)
    return out
