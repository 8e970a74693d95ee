import hashlib
import random

import corpus_pipeline as C
import public_tokenizers as P
import tiktoken
from test_langid import WORDS
from test_secrets import spans_by_hand
from test_simhash import classes_by_hand, fingerprint_by_hand

from gazetick.llm.byte_bpe import parse_ranks
from gazetick.llm.mixing import mix_plan
from gazetick.llm.secrets import MASK


def masked_by_hand(text):
    out, at = "", 0
    for start, _, end in spans_by_hand(text, whole=True):
        if start >= at:
            out += text[at:start] + MASK
        at = max(at, end)
    return out + text[at:]


def test_stages_against_brute_force(spark, tmp_path):
    rng = random.Random(5)
    rows = []
    for i in range(150):
        lang = rng.choice(list(WORDS))
        words = [rng.choice(WORDS[lang]) for _ in range(rng.choice([5, 200]))]
        if i % 10 == 0:
            words.insert(3, "password=hunter2hunter2")
        rows.append((i, " ".join(words), lang if i % 7 else None, "hot" if i % 3 else f"s{i % 5}", 1, "extra"))
        if i % 6 == 0:
            rows.append((1000 + i, " ".join(words), lang, None, 1, "extra"))
    rows += [(2000, None, "en", "hot", 1, None), (2001, "", "en", "hot", 1, None), (2002, "12 34", None, "s1", 1, None)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, lang_pred string"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "documents.parquet"))
    docs, kept = spark.read.parquet(str(tmp_path / "documents.parquet")), {}
    for name, step in C.STAGES:
        out = str(tmp_path / name)
        step(spark, docs, str(tmp_path)).write.parquet(out)
        docs = spark.read.parquet(out)
        kept[name] = docs.collect()
        if name != "tokens":
            assert tuple(docs.columns) == C.COLUMNS

    by_id = {r[0]: r for r in rows}
    assert sorted(r.doc_id for r in kept["language"]) == sorted(i for i in by_id if i < 2000)
    assert all(r.lang for r in kept["language"])
    classes = classes_by_hand({r.doc_id: fingerprint_by_hand(r.text) for r in kept["language"]})
    assert sorted(r.doc_id for r in kept["near_duplicates"]) == sorted(i for i, root in classes.items() if i == root)
    assert {r.doc_id: (r.text, r.n_chars) for r in kept["secrets"]} == {
        r.doc_id: (masked_by_hand(r.text), len(masked_by_hand(r.text))) for r in kept["near_duplicates"]
    }
    assert any(MASK in r.text for r in kept["secrets"])
    plan = mix_plan(spark.createDataFrame(kept["secrets"], "doc_id long, text string, lang string, source string, n_chars long"))
    assert sorted(r.doc_id for r in kept["mixing"]) == sorted(r.doc_id for r in plan.collect() for _ in range(r._mix_copies))
    plain = tiktoken.Encoding("x", pat_str=P.PATTERN, mergeable_ranks=parse_ranks(open(P.path("byte_bpe_multi_50k.tiktoken"), "rb").read()), special_tokens={})
    texts = {r.doc_id: r.text for r in kept["mixing"]}
    assert len(kept["tokens"]) == len(kept["mixing"])
    for r in kept["tokens"]:
        ids = plain.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
    assert sorted(map(str, C.run(spark, str(tmp_path)).collect())) == sorted(map(str, kept["tokens"]))


def test_empty(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    assert C.run(spark, str(tmp_path)).count() == 0


def test_near_duplicates_keep_documents_without_an_id(spark, tmp_path):
    rows = [(None, "one clean text", "en", "a", 1), (None, "another clean text", "en", "a", 1), (3, "one clean text", "en", "a", 1), (4, "one clean text", "en", "a", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = C.near_duplicates(spark, docs, str(tmp_path)).collect()
    assert sorted(map(tuple, kept), key=str) == sorted(rows[:3], key=str)


def test_near_duplicates_keep_texts_that_share_an_id(spark, tmp_path):
    rows = [(5, "one two three four five six", "en", "b", 1), (5, "quite another text that is not alike", "en", "a", 1), (5, "one two three four five six", "en", "a", 1),
            (9, "one two three four five six", "en", "a", 1), (6, "something else stands here for once", None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = C.near_duplicates(spark, docs, str(tmp_path)).collect()
    assert sorted(map(tuple, kept), key=str) == sorted(rows[1:3] + rows[4:], key=str)


def test_language_keeps_a_corpus_without_labels(spark, tmp_path):
    rows = [(1, "some words", None, "a", 1), (2, None, None, "a", 1), (3, "12 34", None, "a", 1), (4, "ёлка", None, None, None), (None, "words", None, "a", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = C.language(spark, docs, str(tmp_path)).collect()
    assert sorted(map(tuple, kept), key=str) == sorted([rows[0], *rows[3:]], key=str)
