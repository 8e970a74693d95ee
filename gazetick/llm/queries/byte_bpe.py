"""Byte-level BPE: query. SQL cannot express it; tests compare it with the library's own encoder."""

import public_tokenizers
from pyspark.sql import functions as F

from gazetick.llm.byte_bpe import Tokenizer, decode_documents, encode_documents, ids_digest
from gazetick.llm.queries.registry import query, table


def encoded_digests(spark, docs):
    """Digests of the tokens and of what they decode to."""
    tokenizer = Tokenizer(spark, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    encoded = encode_documents(docs.select("doc_id", "text"), tokenizer).select("doc_id", "ids")
    return decode_documents(encoded, tokenizer).select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"), ids_digest("ids").alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )


@query("op5_byte_bpe")
def op5_byte_bpe(spark, sf):
    return encoded_digests(spark, table(spark, sf, "documents"))
