import itertools
import math
import random

import numpy as np
import public_tokenizers
import pytest

from gazetick.llm import langid as L

VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")


def small_model():
    pieces = ["▁", "a", "b", "ab", "▁a", "▁ab", "ba", "bab"] + [f"<0x{b:02X}>" for b in range(256)]
    rng = np.random.default_rng(1)
    p = rng.random((3, len(pieces)))
    return L.Model(["x", "y", "z"], p / p.sum(axis=1, keepdims=True), pieces)


def by_all_segmentations(word, known, languages):
    word = L.MARK + word
    total = [0.0] * languages
    for cuts in itertools.product([False, True], repeat=len(word) - 1):
        ends = [i + 1 for i, c in enumerate(cuts) if c] + [len(word)]
        parts = [word[a:b] for a, b in zip([0] + ends, ends)]
        for lang in range(languages):
            product = 1.0
            for part in parts:
                if part in known:
                    product *= known[part][lang]
                elif len(part) == 1:
                    product *= math.prod(known[f"<0x{b:02X}>"][lang] for b in part.encode())
                else:
                    product = 0.0
            total[lang] += product
    return [math.log(t) for t in total]


def test_forward_sums_all_segmentations():
    model = small_model()
    known = model.table()
    for word in ("a", "ab", "babab", "bbaé", "c", "日ab", "abababab"):
        assert L.word_scores(word, known, model.longest, 3) == pytest.approx(by_all_segmentations(word, known, 3), rel=1e-12)


def test_prefix_table():
    model = small_model()
    scorer = L.Scorer(model)
    words = ["a", "b", "c", "é", "babab", "bab", "aaaaa", "日abxb", "日", "ab" * 24, "cé" * 20, "cé" * 19 + "b"]
    for some in (words[:4], words[2:9], words):
        scorer.learn(set(some))
    want = [L.word_scores(w, model.table(), model.longest, 3) for w in words]
    assert np.allclose(scorer.word_logs([scorer.place[w] for w in words]), want, rtol=1e-12)


def test_long_words_do_not_underflow():
    model = small_model()
    known = model.table()
    one, two = (L.word_scores("ab" * n, known, model.longest, 3) for n in (2000, 4000))
    assert all(math.isfinite(s) for s in two)
    assert two == pytest.approx([2 * s for s in one], rel=1e-2)


def test_expected_counts():
    model = small_model()
    known = {p: (x,) for p, x in zip(model.pieces, model.probabilities[0].tolist())}
    counts = L.expected_counts("bab", known, model.longest)
    word, total, want = "▁bab", 0.0, {}
    for cuts in itertools.product([False, True], repeat=3):
        ends = [i + 1 for i, c in enumerate(cuts) if c] + [4]
        parts = [word[a:b] for a, b in zip([0] + ends, ends)]
        p = math.prod(known.get(x, (0.0,))[0] for x in parts)
        total += p
        for x in parts:
            want[x] = want.get(x, 0.0) + p
    want = {k: v / total for k, v in want.items() if v}
    assert counts == pytest.approx(want)


WORDS = {"en": "the and with house of water thing to you".split(), "de": "der die und haus wasser über nicht schön".split(), "fr": "le la être avec maison où très eau".split()}


def test_predictions(spark, monkeypatch):
    rng = random.Random(3)
    text = lambda lang, n: " ".join(rng.choice(WORDS[lang]) for _ in range(n))
    rows = [(i, text(lang, rng.choice([3, 30])), lang, "old") for i, lang in enumerate(list(WORDS) * 60)]
    odd = [(1000, None, "en", "x"), (1001, "", None, "x"), (1002, "123 -- !", "de", "x"), (None, text("fr", 20), None, "x"), (1004, text("en", 20_000), "en", "x"), (1004, "é" * 40_000, None, "x")]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string, score string")
    model = L.train(docs.filter("doc_id % 4 <> 2"), VOCABULARY)
    assert model.languages == ["de", "en", "fr"]
    assert np.allclose(model.probabilities.sum(axis=1), 1)
    found = {(r.doc_id, r.text): r for r in L.identify(docs, model).collect()}
    for i, t, lang, _ in rows:
        assert found[i, t].lang_pred == lang and 1 / 3 <= found[i, t].score <= 1
    assert {found[i, t].lang_pred for i, t, *_ in odd[:3]} == {"und"} and found[1000, None].score == 0
    assert found[odd[3][:2]].lang_pred == "fr" and found[odd[4][:2]].lang_pred == "en"
    monkeypatch.setattr(L, "KEPT_PREFIXES", 2)
    one = L.Scorer(model)
    assert [one(t)[0] for _, t, *_ in rows] == [r[2] for r in rows]


def test_nothing_to_learn(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    model = L.train(empty, VOCABULARY)
    assert model.languages == []
    docs = spark.createDataFrame([(1, "a b", None)], "doc_id long, text string, lang string")
    assert L.train(docs, VOCABULARY).languages == []
    row = L.identify(docs, model).first()
    assert (row.lang_pred, row.score) == ("und", 0.0)
    assert L.identify(empty, model).count() == 0


def test_held_out_accuracy(spark):
    from gazetick.llm.queries.langid import op2_langid

    sf = "/root/testdata/sf0.01"
    truth = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    rows = op2_langid(spark, sf).join(truth, "doc_id").filter("held_out").collect()
    assert len(rows) > 150 and sum(r.lang_pred == r.lang for r in rows) / len(rows) > 0.97


def test_column_of_the_helper_name_and_null_ids(spark, tmp_path):
    import numpy as np

    from gazetick.llm.langid import Model, identify
    from gazetick.llm.queries.langid import op2_langid

    docs = spark.createDataFrame([(1, "words", "mine"), (None, "more", "too")], "doc_id long, text string, _lang string")
    found = identify(docs, Model([], np.empty((0, 0)), []))
    assert found.columns == ["doc_id", "text", "_lang", "lang_pred", "score"]
    assert sorted(r["_lang"] for r in found.collect()) == ["mine", "too"]
    docs.withColumnRenamed("_lang", "lang").write.parquet(str(tmp_path / "documents.parquet"))
    assert {r.doc_id: r.held_out for r in op2_langid(spark, str(tmp_path)).collect()}[None] is False
