"""Column handling and row predicates."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gazetick.functions.numeric import finite_or_null

# The one-letter keys of a bar response and the names they stand for.
BAR_NAMES = {
    "o": "open",
    "h": "high",
    "l": "low",
    "c": "close",
    "v": "volume",
    "vw": "vwap",
    "t": "timestamp",
    "n": "transactions",
}
# Identity, label and the row's place in time: none of them may reach a model.
NOT_FEATURES = ("symbol", "date", "timestamp", "target", "future_return_5", "split", "pos", "split_pos")


def normalise_columns(df: DataFrame, lower: bool = True) -> DataFrame:
    """Strip (and lower-case) column names; two names that become one are an error."""
    names = [c.strip().lower() if lower else c.strip() for c in df.columns]
    clashes = [n for n, k in Counter(names).items() if k > 1]
    if clashes:
        raise ValueError(f"column names collide after clean-up: {clashes}")
    return df.toDF(*names)


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; available: {df.columns}")
    return df


def rename_bars(df: DataFrame) -> DataFrame:
    """One-letter keys to long names, plus ``date`` from epoch milliseconds."""
    return df.withColumnsRenamed(BAR_NAMES).withColumn("date", F.timestamp_millis("timestamp"))


def fill_blank(df: DataFrame, *names: str) -> DataFrame:
    return df.na.fill("", subset=list(names))


def drop_missing(df: DataFrame, *names: str) -> DataFrame:
    return df.na.drop(subset=list(names))


def drop_nonfinite(df: DataFrame) -> DataFrame:
    """Infinities and NaN become null, then rows with any null go."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: finite_or_null(F.col(c)) for c in floats}).na.drop("any")


def feature_columns(df: DataFrame, exclude: Sequence[str] = NOT_FEATURES) -> list[str]:
    return [c for c in df.columns if c not in exclude]


def filter_complete_articles(df: DataFrame) -> DataFrame:
    return df.filter((F.col("title") != "") & (F.col("first_paragraph") != ""))


def filter_has_url(df: DataFrame) -> DataFrame:
    return df.filter(F.coalesce("url", F.lit("")) != "")
