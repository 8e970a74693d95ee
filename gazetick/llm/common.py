"""Helpers shared by the operators: staged tables and joins against per-key tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
#: Rows up to which a per-key table is broadcast; a row is a short key and some numbers.
BROADCAST_ROWS = 50_000
SALTS = 64


#: Rows that a Python worker gets at once. Whole documents are large rows; Spark's default is 10,000.
BATCH_ROWS = 1000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batches to ``BATCH_ROWS``, so that workers hold a few MB of text each.

    This bounds memory and changes no result; a smaller setting of the session's own stays.
    """
    if not 0 < int(spark.conf.get(_BATCH)) <= BATCH_ROWS:
        spark.conf.set(_BATCH, str(BATCH_ROWS))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def hash_unit(column: Column, seed: int) -> Column:
    """Number in [0, 1) that depends on the value and the seed alone: 52 bits of a SHA-256."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(column.cast("string"), F.lit("")))
    return F.conv(F.left(F.sha2(text, 256), F.lit(13)), 16, 10).cast("bigint") / F.lit(float(2**52))


def join_per_key(rows: DataFrame, per_key: DataFrame, key: str, spread: Column) -> DataFrame:
    """Left join of ``rows`` with a table of one row per key; a null key meets a null key.

    A per-key table within ``BROADCAST_ROWS`` is broadcast after its rows are counted. A larger one
    is shuffled, each of its rows to ``SALTS`` places, so that a hot key's rows are spread by ``spread``.
    Both sides must not hold columns that start with ``_j_``.
    """
    keyed = per_key.withColumns({"_j_k": F.coalesce(key, F.lit("")), "_j_n": F.col(key).isNull()}).drop(key)
    left = rows.withColumns({"_j_k": F.coalesce(key, F.lit("")), "_j_n": F.col(key).isNull()})
    if per_key.count() <= BROADCAST_ROWS:
        return left.join(F.broadcast(keyed), ["_j_k", "_j_n"], "left").drop("_j_k", "_j_n")
    keyed = keyed.withColumn("_j_s", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    left = left.withColumn("_j_s", F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("int"))
    return left.join(keyed, ["_j_k", "_j_n", "_j_s"], "left").drop("_j_k", "_j_n", "_j_s")
