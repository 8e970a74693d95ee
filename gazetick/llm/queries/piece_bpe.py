"""SentencePiece BPE: query. SQL cannot express it; tests compare it with the library's own encoder."""

import public_tokenizers
from pyspark.sql import functions as F

from gazetick.llm.byte_bpe import ids_digest
from gazetick.llm.piece_bpe import PieceTokenizer, decode_pieces, encode_pieces
from gazetick.llm.queries.registry import query, table


@query("op13_piece_bpe")
def op13_piece_bpe(spark, sf):
    tokenizer = PieceTokenizer(spark, public_tokenizers.path("piece_bpe_32k.model"))
    encoded = encode_pieces(table(spark, sf, "documents").select("doc_id", "text"), tokenizer).select("doc_id", "ids")
    return decode_pieces(encoded, tokenizer).select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"), ids_digest("ids").alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
