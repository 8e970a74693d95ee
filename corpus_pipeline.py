"""A training corpus from the documents: five stages, each one operator of ``gazetick.llm``.

Every stage reads what its predecessor kept and writes Parquet to the shared folder; all but the
last return the columns of documents, and columns beyond these are dropped at the start.

1. ``language``: documents without a determinable language go (null texts, texts without a letter);
   the model is learned from the labelled rows that are not held out. A missing label is filled in.
   Where no row is labelled nothing is learned: only texts that are null or have no letter go.
2. ``near_duplicates``: of each group of near copies the document with the smallest id stays;
   documents without an id stay, each for itself.
3. ``secrets``: secrets are masked inside the texts; documents stay.
4. ``mixing``: sources are repeated or thinned towards their target weights.
5. ``tokens``: per row of the mix the number of its tokens and digests of tokens and decoded bytes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gazetick.llm.langid import UNKNOWN, identify
from gazetick.llm.mixing import mix_documents
from gazetick.llm.queries.byte_bpe import encoded_digests
from gazetick.llm.queries.langid import learned
from gazetick.llm.secrets import mask_secrets
from gazetick.llm.simhash import keep_one
from gazetick.session import stage

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = learned(docs)
    if not model.languages:
        return docs.select(*COLUMNS).filter(F.col("text").rlike(r"\p{L}"))
    found = identify(docs.select(*COLUMNS), model).filter(F.col("lang_pred") != UNKNOWN)
    return found.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one(docs.select(*COLUMNS))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mask_secrets(docs.select(*COLUMNS)).withColumn("n_chars", F.length("text").cast("bigint"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix_documents(docs.select(*COLUMNS))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encoded_digests(spark, docs)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("secrets", secrets),
    ("mixing", mixing),
    ("tokens", tokens),
]

#: SQL expresses neither the language model, nor seeded XXH64, nor byte-pair merges; the tests
#: compare the stages with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written and read again, the last one returned."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
