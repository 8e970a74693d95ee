"""CSV, JSON and Parquet writers. Each writes a folder, one file per task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FLAT_COLUMNS = (
    "source",
    "url",
    "published_date_new_york",
    "original_title",
    "clean_title",
    "original_first_paragraph",
    "clean_first_paragraph",
)


def _blank_nulls(df: DataFrame) -> DataFrame:
    return df.na.fill("", subset=[f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)])


def write_csv(df: DataFrame, path: str, mode: str = "error") -> None:
    """Header, doubled quotes, no index column; empty strings and nulls are both written empty."""
    df.write.mode(mode).option("header", True).option("escape", '"').option("emptyValue", "").csv(path)


def write_json_records(df: DataFrame, path: str, mode: str = "error") -> None:
    """One UTF-8 record per line with every field present; missing text is ``""``."""
    _blank_nulls(df).write.mode(mode).option("ignoreNullFields", False).json(path)


def write_flat_csv(preprocessed: DataFrame, path: str, mode: str = "error") -> None:
    """The seven flat columns of preprocessed articles; token arrays are left out."""
    write_csv(preprocessed.select(*FLAT_COLUMNS), path, mode)


def write_embeddings(df: DataFrame, path: str, key: str = "url", vector: str = "embedding", mode: str = "error") -> None:
    """Backup of the vectors by key."""
    df.select(F.col(key), F.col(vector)).write.mode(mode).parquet(path)
