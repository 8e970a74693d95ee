"""Insert-or-update by key as one join; the caller writes the result as a new version."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPDATED = ("embedding", "title", "first_paragraph")


def reject_duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Fail the job when a key comes twice; otherwise the same rows.

    Grouping by the key is the partitioning the upsert join needs, so it adds no shuffle there.
    """
    others = [c for c in df.columns if c != key]
    grouped = df.groupBy(key).agg(F.any_value(F.struct(*others)).alias("_row"), F.count(F.lit(1)).alias("_n"))
    message = F.concat(F.lit(f"{key} occurs twice in one batch: "), F.col(key))
    checked = grouped.withColumn("_row", F.when(F.col("_n") == 1, F.col("_row")).otherwise(F.raise_error(message)))
    return checked.select(key, "_row.*").select(*df.columns)


def upsert_by_key(
    target: DataFrame,
    incoming: DataFrame,
    key: str = "url",
    update: Sequence[str] = UPDATED,
    defaults: dict[str, Column] | None = None,
) -> DataFrame:
    """Target after the batch: new keys are inserted, known keys change only in ``update``.

    ``defaults`` fill columns the batch does not have on inserted rows. Keys must not be null.
    """
    defaults = defaults or {}
    batch = reject_duplicate_keys(incoming, key)
    old = target.select(key, F.struct(*[c for c in target.columns if c != key]).alias("_old"))
    new = batch.select(key, F.struct(*[c for c in batch.columns if c != key]).alias("_new"))
    both = old.join(new, key, "full")

    def value(name: str) -> Column:
        if name == key:
            return F.col(key)
        inserted = F.col("_new")[name] if name in incoming.columns else defaults.get(name, F.lit(None))
        if name in update:
            kept = F.when(F.col("_new").isNotNull(), inserted).otherwise(F.col("_old")[name])
        else:
            kept = F.when(F.col("_old").isNotNull(), F.col("_old")[name]).otherwise(inserted)
        return kept.cast(target.schema[name].dataType).alias(name)

    return both.select(*[value(c) for c in target.columns])
