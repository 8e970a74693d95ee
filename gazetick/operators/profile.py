"""Counts, shares and data-quality reports. Each is one aggregate with map-side combine."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def value_counts(df: DataFrame, col: str, count: str = "count") -> DataFrame:
    """Non-null values by falling count, ties by value."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias(count))
    return counts.orderBy(F.desc(count), F.asc(col))


def value_counts_pct(df: DataFrame, col: str, by: Sequence[str] = ()) -> DataFrame:
    """Counts and shares (x100) of the non-null values, per ``by`` group when given."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(*by, col).agg(F.count(F.lit(1)).alias("count"))
    # Only classes reach this join, never rows.
    if by:
        totals = counts.groupBy(*by).agg(F.sum("count").alias("_total"))
        joined = counts.join(totals, list(by))
    else:
        joined = counts.crossJoin(F.broadcast(counts.agg(F.sum("count").alias("_total"))))
    return joined.withColumn("pct", F.col("count") / F.col("_total") * 100).drop("_total")


def target_distribution(df: DataFrame, split: str = "split", target: str = "target") -> DataFrame:
    return value_counts_pct(df, target, by=[split])


def null_counts(df: DataFrame) -> DataFrame:
    """``column, nulls`` for every column, from one pass."""
    one = df.agg(*[F.count(F.when(F.col(f"`{c}`").isNull(), 1)).alias(c) for c in df.columns])
    return one.unpivot([], list(df.columns), "column", "nulls")


def total_nulls(df: DataFrame) -> DataFrame:
    return null_counts(df).agg(F.sum("nulls").alias("nulls"))


def _short(df: DataFrame, name: str) -> Column:
    """The value, or its digest when it is a long text: grouping keys stay small in the shuffle."""
    col = F.col(f"`{name}`")
    if isinstance(df.schema[name].dataType, T.StringType):
        return F.when(F.length(col) > 64, F.sha2(col, 256)).otherwise(col)
    return col


def duplicate_row_count(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier whole row; nulls are equal."""
    groups = df.groupBy(*[_short(df, c).alias(c) for c in df.columns]).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates"))


def duplicate_key_count(df: DataFrame, *keys: str) -> DataFrame:
    return duplicate_row_count(df.select(*keys))


def distinct_counts(df: DataFrame) -> DataFrame:
    """``column, distinct`` for every column; nulls are not a value."""
    one = df.agg(*[F.count_distinct(_short(df, c)).alias(c) for c in df.columns])
    return one.unpivot([], list(df.columns), "column", "distinct")


def distinct_sketches(df: DataFrame, bits: int = 14) -> DataFrame:
    """``column, sketch``: a mergeable sketch of every column's values; one row a column, one pass, no row expanded.

    Store them per batch: the sketches of a growing table are the old ones and those of the new batch.
    The standard error of an estimate is about 0.83 / sqrt(2 ** ``bits``), 0.7 % by default.
    """
    one = df.agg(*[F.hll_sketch_agg(_short(df, c).cast("string"), bits).alias(c) for c in df.columns])
    return one.unpivot([], list(df.columns), "column", "sketch")


def approx_distinct_counts(sketches: DataFrame) -> DataFrame:
    """``column, distinct``: estimates from the sketches of any number of batches; nulls are not a value."""
    return sketches.groupBy("column").agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct"))


def shape_dtypes(df: DataFrame) -> DataFrame:
    """``column, dtype, position, non_null, rows`` for every column."""
    types = df.sparkSession.createDataFrame(
        [(name, dtype, i) for i, (name, dtype) in enumerate(df.dtypes)], "column string, dtype string, position int"
    )
    rows = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns], F.count(F.lit(1)).alias("_rows"))
    filled = rows.unpivot(["_rows"], list(df.columns), "column", "non_null")
    return types.join(filled.withColumnRenamed("_rows", "rows"), "column")


def range_by(df: DataFrame, by: Sequence[str], col: str) -> DataFrame:
    """Row count with first and last value per group."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), F.min(col).alias("start"), F.max(col).alias("end"))


def token_counts(df: DataFrame, tokens: Column) -> DataFrame:
    """Corpus frequency of every token; counted per task before the shuffle."""
    return df.select(F.explode(tokens).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("count"))


def class_weights_balanced(df: DataFrame, label: str) -> DataFrame:
    """``label, weight`` with weight = rows / (classes x rows of the class)."""
    counts = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy()
    weight = F.sum("_n").over(whole) / (F.count(F.lit(1)).over(whole) * F.col("_n"))
    return counts.select(label, weight.alias("weight"))


def cluster_summary(df: DataFrame, label: str = "cluster") -> DataFrame:
    """Size of every cluster with the number of clusters and of noise rows (label -1)."""
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("size"))
    whole = sizes.agg(
        F.count(F.when(F.col(label) != -1, 1)).alias("n_clusters"),
        F.coalesce(F.sum(F.when(F.col(label) == -1, F.col("size"))), F.lit(0)).alias("n_noise"),
    )
    return sizes.crossJoin(F.broadcast(whole))  # one row
