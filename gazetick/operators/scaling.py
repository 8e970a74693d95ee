"""Standard scaling fitted on one part of a table and applied to all of it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gazetick.plans.lookup import lookup_join


def scaler_fit(
    df: DataFrame, cols: Sequence[str], keys: Sequence[str] = (), where: Column | None = None
) -> DataFrame:
    """One row per key: arrays ``mean`` and ``std`` (population; a constant column gets 1)."""
    rows = df if where is None else df.filter(where)
    wide = rows.groupBy(*keys).agg(
        *[F.avg(c).alias(f"_m{i}") for i, c in enumerate(cols)],
        *[F.stddev_pop(c).alias(f"_s{i}") for i, c in enumerate(cols)],
    )
    safe = [F.when(F.col(f"_s{i}") == 0, 1.0).otherwise(F.col(f"_s{i}")) for i in range(len(cols))]
    return wide.select(
        *keys, F.array(*[f"_m{i}" for i in range(len(cols))]).alias("mean"), F.array(*safe).alias("std")
    )


def standard_scale(
    df: DataFrame, stats: DataFrame, cols: Sequence[str], keys: Sequence[str] = (), out: str = "scaled"
) -> DataFrame:
    """Adds the array ``out`` of (x - mean) / std; ``stats`` is one row per key."""
    # Without keys the statistics are a single row, the one size that is always safe to send around.
    joined = lookup_join(df, stats, keys, F.monotonically_increasing_id()) if keys else df.crossJoin(F.broadcast(stats))
    scaled = [(F.col(c).cast("double") - F.col("mean")[i]) / F.col("std")[i] for i, c in enumerate(cols)]
    return joined.withColumn(out, F.array(*scaled)).drop("mean", "std")


def scale_vector(df: DataFrame, vector: str, size: int, out: str = "scaled") -> DataFrame:
    """Standard scaling of an array column of fixed size, fitted on all rows."""
    names = [f"_x{i}" for i in range(size)]
    wide = df.withColumns({n: F.col(vector)[i].cast("double") for i, n in enumerate(names)})
    return standard_scale(wide, scaler_fit(wide, names), names, out=out).drop(*names)
