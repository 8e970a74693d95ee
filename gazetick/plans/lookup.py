"""Joins of a row table with a table of one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows up to which a per-key table is sent to every executor; a row is a key and a few values.
BROADCAST_TERMS = 100_000
SALTS = 32


def lookup_join(rows: DataFrame, table: DataFrame, keys: Sequence[str], spread: Column, how: str = "inner") -> DataFrame:
    """``rows`` with the columns of ``table`` (unique ``keys``).

    The table is counted: up to ``BROADCAST_TERMS`` rows it is broadcast, and no row of the large side
    moves. Beyond that each of its rows goes to ``SALTS`` places and the large side is dealt over them
    by ``spread``, so that a key with a third of all rows is many tasks. That join is asked for as a
    sort-merge join: Spark sizes the copies by the table's own files and would broadcast them all.
    """
    keys = list(keys)
    if table.limit(BROADCAST_TERMS + 1).count() <= BROADCAST_TERMS:
        return rows.join(F.broadcast(table), keys, how)
    copies = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = rows.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("int"))
    return dealt.join(copies.hint("merge"), [*keys, "_salt"], how).drop("_salt")
