import hashlib
import random

import public_tokenizers as P
import pytest
import tiktoken

from gazetick.llm.byte_bpe import Tokenizer, decode_documents, decode_tree, encode_documents, encode_tree, parse_ranks
from gazetick.llm.queries.byte_bpe import encoded_digests

PATH = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def plain():
    return tiktoken.Encoding("x", pat_str=P.PATTERN, mergeable_ranks=parse_ranks(open(PATH, "rb").read()), special_tokens={})


def messy(rng):
    pieces = ["  ", " ", "\n", "\n\n ", "\t", "'re", "'", "'ll", "don't", "a", "abc", "ÄÖ", "日本語", "123", "!!", "...", " ", " ", "é", "\x1c", "😀", "\r\n", "x" * 70]
    return "".join(rng.choice(pieces) for _ in range(rng.randint(0, 120)))


@pytest.mark.parametrize("leaf", [1, 2, 5, 33])
def test_tree_equals_one_pass(plain, leaf):
    rng = random.Random(leaf)
    for _ in range(150):
        text = messy(rng)
        assert encode_tree(text, plain.encode_to_numpy, leaf=leaf).tolist() == plain.encode_ordinary(text), repr(text)


def test_border_shapes(plain):
    for text in ("", " ", "a", " " * 500, "x" * 500, "a " * 500, "' re" * 200, "we're " * 300, "\n" * 300 + "a", "日" * 400, "1 " * 333):
        for leaf in (1, 3, 8, 64):
            assert encode_tree(text, plain.encode_to_numpy, leaf=leaf).tolist() == plain.encode_ordinary(text)


def test_joins_decide_tokens(plain):
    text = "The quick brown fox jumped over extraordinarily lazy hounds, didn't it?! " * 60
    seen = []

    def encode(part):
        seen.append(len(part))
        return plain.encode_ordinary(part)

    whole = plain.encode_ordinary(text)
    assert encode_tree(text, encode).tolist() == whole
    assert max(seen) <= 100 and len(seen) > 4 * len(text) // 128
    leaves = [t for i in range(0, len(text), 64) for t in plain.encode_ordinary(text[i : i + 64])]
    assert leaves != whole


def test_white_space_of_any_kind_before_a_cut(plain):
    kinds = [" ", "\n", "\t", "\x0b", "\x1c", "\x85", "\xa0", "\u2028", "\u3000", "!", "a", "'s", "1", "\u200b", "\u180e"]
    rng = random.Random(4)
    for _ in range(400):
        text = "".join(rng.choice(kinds) for _ in range(rng.randint(2, 90)))
        assert encode_tree(text, plain.encode_ordinary, leaf=2).tolist() == plain.encode_ordinary(text), repr(text)


def test_decode_tree():
    table = [bytes([i]) * (i % 3 + 1) for i in range(256)]
    ids = [i * 7 % 256 for i in range(20_000)]
    assert decode_tree(ids, table) == b"".join(table[i] for i in ids)


def test_documents(spark, plain):
    rng = random.Random(9)
    texts = [None, "", "a", "a", " ".join(messy(rng) for _ in range(400)), "y" * 30_000, "<|endoftext|> x"]
    docs = spark.createDataFrame([(i, t, "old") for i, t in enumerate(texts)], "doc_id long, text string, ids string")
    tokenizer = Tokenizer(spark, PATH, P.PATTERN)
    rows = {r.doc_id: r for r in decode_documents(encode_documents(docs, tokenizer), tokenizer).collect()}
    for i, text in enumerate(texts):
        assert list(rows[i].ids) == plain.encode_ordinary(text or "")
        assert bytes(rows[i].bytes) == (text or "").encode()
    for r in encoded_digests(spark, docs).collect():
        ids = plain.encode_ordinary(texts[r.doc_id] or "")
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()
    assert encoded_digests(spark, docs.limit(0)).count() == 0
