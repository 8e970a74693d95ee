import hashlib
import random
import time

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece

from gazetick.llm.piece_bpe import PieceTokenizer, Pieces, decode_pieces, distinct_spans, encode_pieces
from gazetick.llm.queries.piece_bpe import op13_piece_bpe

PATH = P.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def pieces():
    return Pieces(open(PATH, "rb").read())


def rows(flat, offsets):
    return [flat[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]


def messy(rng, library):
    parts = ["  ", " ", "\n", "\t", "don't", "a", "abc", "ÄÖ", "日本語", "123", "!!", "▁", "é", "\x1c", "\x00", "😀", "\r\n", "x" * 70, "<s>", "<0x0A>", " " * 9, "sample", "town", "tokenization"]
    some = [rng.choice(parts) for _ in range(rng.randint(0, 60))]
    some += [library.id_to_piece(rng.randrange(300, 32000)).replace("▁", rng.choice(["", " "])) for _ in range(rng.randint(0, 60))]
    rng.shuffle(some)
    return "".join(some)


@pytest.mark.parametrize("chunk", [1, 7, 64, 1 << 20])
def test_equals_the_library(library, pieces, chunk):
    rng = random.Random(chunk)
    texts = [messy(rng, library) for _ in range(20 if chunk < 9 else 300)] + ["", " ", "a", "▁", " ▁ "]
    assert rows(*pieces.encode(texts, chunk)) == library.encode(texts)


def test_unbroken_words(library, pieces):
    rng = random.Random(3)
    texts = ["a" * 3001, " " * 777, "ab" * 900, "townbody" * 300, "日本" * 500, "=" * 999, "-" * 64 + "=" * 63]
    # Random words of pieces that another piece of a better rank begins or ends with.
    known = {library.id_to_piece(i): -library.get_score(i) for i in range(259, 32000)}
    risky = [p[:i] for p in known for i in range(2, len(p)) if p[:i] in known and known[p[:i]] >= known[p]]
    texts += ["".join(rng.choice(risky).replace("▁", "") for _ in range(30)) for _ in range(300)]
    texts += [rng.choice(risky) * 20 for _ in range(300)]
    texts += ["".join(rng.choice("abcdeinst") for _ in range(2000)) for _ in range(5)]
    assert rows(*pieces.encode(texts)) == library.encode(texts)


def test_long_text(library, pieces):
    rng = random.Random(4)
    text = " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 9))) for _ in range(200_000))
    started = time.time()
    assert rows(*pieces.encode([text, None, "b"], 1 << 16)) == [library.encode(text), [], library.encode("b")]
    assert time.time() - started < 60


def test_decode(library, pieces):
    rng = random.Random(5)
    lists = [[rng.choice([0, 1, 2, 28705, rng.randrange(3, 259), rng.randrange(259, 32000)]) for _ in range(rng.randint(0, 12))] for _ in range(3000)]
    lists += [library.encode(messy(rng, library)) for _ in range(200)] + [[], [1], [1, 2], [28705], [1, 28705, 28705], [3 + 0xE6, 3 + 0x97], [3 + 0xF0, 3 + 0x9F, 3 + 0x98, 3 + 0x80]]
    flat = np.array([i for x in lists for i in x])
    assert pieces.decode(flat, np.cumsum([0] + [len(x) for x in lists])) == [library.decode(x) for x in lists]
    with pytest.raises(ValueError):
        pieces.decode(np.array([32000]), np.array([0, 1]))


def test_distinct_spans():
    values, lengths = np.array([1, 2, 1, 2, 2, 1, 0, 0, 0]), np.array([2, 2, 2, 1, 2])
    kinds = distinct_spans(values, np.cumsum(lengths) - lengths, lengths)
    assert kinds[0] == kinds[1] and len(set(kinds.tolist())) == 4


def test_documents(spark, library, tmp_path):
    rng = random.Random(9)
    texts = [None, "", "a", "a", " ".join(messy(rng, library) for _ in range(400)), "y" * 30_000, " lead and trail ", "日本 😀 \x00"]
    docs = spark.createDataFrame([(i, t, "old", "mine") for i, t in enumerate(texts)], "doc_id long, text string, ids string, decoded string")
    tokenizer = PieceTokenizer(spark, PATH)
    found = decode_pieces(encode_pieces(docs, tokenizer), tokenizer)
    assert found.columns == docs.columns
    for r in found.collect():
        ids = library.encode(texts[r.doc_id] or "")
        assert list(r.ids) == ids and r.decoded == library.decode(ids)
    for name, part in (("some", docs), ("none", docs.limit(0))):
        part.write.parquet(str(tmp_path / name / "documents.parquet"))
    result = op13_piece_bpe(spark, str(tmp_path / "some")).collect()
    assert len(result) == len(texts)
    for r in result:
        ids = library.encode(texts[r.doc_id] or "")
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
    assert op13_piece_bpe(spark, str(tmp_path / "none")).count() == 0
