"""Language identification: query. SQL cannot sum over segmentations; tests do, and measure held-out accuracy."""

import public_tokenizers
from pyspark.sql import functions as F

from gazetick.llm.langid import identify, train
from gazetick.llm.queries.registry import query, table

VOCABULARY = "piece_bpe_32k.model"


def held_out(id="doc_id"):
    """False for a null id, which has no remainder."""
    return F.coalesce(F.pmod(F.crc32(F.col(id).cast("string")), F.lit(4)) == 2, F.lit(False))


def learned(docs):
    """The model of the documents that are not held out."""
    labelled = docs.select("doc_id", "text", "lang").filter(~held_out())
    return train(labelled, public_tokenizers.path(VOCABULARY))


@query("op2_langid")
def op2_langid(spark, sf):
    docs = table(spark, sf, "documents")
    found = identify(docs.select("doc_id", "text"), learned(docs))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
