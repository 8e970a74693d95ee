"""Byte-level BPE encoding and decoding as a tree reduction.

Texts under concatenation and token sequences under ``join`` are monoids, and encoding maps the one
to the other: a text is cut in halves down to leaves of ``LEAF`` characters, leaves are encoded, and
neighbours are joined by encoding anew a window around their border. The window grows until both of its
ends are cuts that no context can move, which proves that the tokens outside stay as they are. Leaves and
windows are encoded by the public library with the given ranks; no call sees more of a text than those.
Decoding concatenates the bytes of the leaves up the same kind of tree.

A cut that no context can move: a blank or newline behind a character that is no white space. No alternative
of the pattern holds a white-space character behind another character, so a match ends there; the only
look-ahead is taken by matches of white space, and the match that ends there holds none at its end.

Nulls and empty texts encode to no tokens; empty sequences decode to no bytes; an empty table stays empty. A lone surrogate
cannot come out of Spark's UTF-8 strings. Rows are independent: ties and repeated rows change
nothing, and other columns pass through.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gazetick.llm.common import small_batches

#: Characters of a leaf, tokens of a leaf in decoding, and the first window's reach on either side.
LEAF = 64
REACH = 32

Encode = Callable[[str], Sequence[int]]


def left_cut(text: str, low: int, middle: int) -> int:
    """Largest fixed cut in the window left of ``middle``; the window doubles until it holds one or all."""
    reach = REACH
    while True:
        start = max(low, middle - reach)
        for i in range(middle - 1, start, -1):
            if text[i] in " \n" and not text[i - 1].isspace():
                return i
        if start == low:
            return low
        reach *= 2


def right_cut(text: str, middle: int, high: int) -> int:
    """Smallest fixed cut in the window right of ``middle``."""
    reach = REACH
    while True:
        end = min(high, middle + reach)
        for i in range(middle + 1, end):
            if text[i] in " \n" and not text[i - 1].isspace():
                return i
        if end == high:
            return high
        reach *= 2


def encode_tree(text: str, encode: Encode, low: int = 0, high: int | None = None, leaf: int = LEAF) -> array:
    """Tokens of ``text[low:high]``."""
    high = len(text) if high is None else high
    if high - low <= leaf:
        return array("I", encode(text[low:high]))
    middle = (low + high) // 2
    left = encode_tree(text, encode, low, middle, leaf)
    right = encode_tree(text, encode, middle, high, leaf)
    a, b = left_cut(text, low, middle), right_cut(text, middle, high)
    # What the window's two sides took on their own ends at the border, so it is counted off there.
    keep = len(left) - len(encode(text[a:middle]))
    skip = len(encode(text[middle:b]))
    return left[:keep] + array("I", encode(text[a:b])) + right[skip:]


def decode_tree(ids: Sequence[int], table: Sequence[bytes], low: int = 0, high: int | None = None) -> bytes:
    """Bytes of ``ids[low:high]``."""
    high = len(ids) if high is None else high
    if high - low <= LEAF:
        return b"".join([table[i] for i in ids[low:high]])
    middle = (low + high) // 2
    return decode_tree(ids, table, low, middle) + decode_tree(ids, table, middle, high)


def parse_ranks(content: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in content.splitlines() if line)}


class Tokenizer:
    """Column functions for one rank file, which the driver reads and broadcasts (about 1 MB, fixed)."""

    def __init__(self, spark: SparkSession, path: str, pattern: str, leaf: int = LEAF):
        small_batches(spark)
        with open(path, "rb") as file:
            self.content: Broadcast = spark.sparkContext.broadcast(file.read())
        self.pattern, self.leaf = pattern, leaf

    def encode(self, text: Column | str) -> Column:
        """``array<int>``: the tokens of the whole text."""
        content, pattern, leaf = self.content, self.pattern, self.leaf

        @F.arrow_udf("array<int>")
        def bpe_encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            import tiktoken

            encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=parse_ranks(content.value), special_tokens={})
            for texts in batches:
                rows = [encode_tree(t.as_py() or "", encoding.encode_ordinary, leaf=leaf) for t in texts]
                ends = np.cumsum([0] + [len(r) for r in rows])
                tokens = np.frombuffer(b"".join(rows), np.int32)
                yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(tokens))

        return bpe_encode(text)

    def decode(self, ids: Column | str) -> Column:
        """``binary``: the bytes of the tokens."""
        content = self.content

        @F.arrow_udf("binary")
        def bpe_decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            ranks = parse_ranks(content.value)
            table = [b""] * (max(ranks.values(), default=-1) + 1)
            for token, rank in ranks.items():
                table[rank] = token
            for rows in batches:
                tokens, ends = rows.values.to_numpy(zero_copy_only=False), rows.offsets.to_numpy()
                spans = zip(ends[:-1], ends[1:], rows.is_valid().to_pylist(), strict=True)
                yield pa.array([decode_tree(tokens[a:b].tolist(), table) if valid else b"" for a, b, valid in spans], pa.binary())

        return bpe_decode(ids)


def encode_documents(docs: DataFrame, tokenizer: Tokenizer, text: str = "text", out: str = "ids") -> DataFrame:
    """``docs`` with the tokens of its texts; a column of that name is replaced."""
    return docs.withColumn(out, tokenizer.encode(text))


def decode_documents(docs: DataFrame, tokenizer: Tokenizer, ids: str = "ids", out: str = "bytes") -> DataFrame:
    return docs.withColumn(out, tokenizer.decode(ids))


def ids_digest(ids: Column | str) -> Column:
    """SHA-256 of the decimal ids joined by commas."""
    return F.sha2(F.concat_ws(",", F.col(ids).cast("array<string>") if isinstance(ids, str) else ids.cast("array<string>")), 256)
