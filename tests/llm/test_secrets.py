import hashlib
import math
import random
import re

from pyspark.sql import functions as F

from gazetick.llm import secrets as S
from gazetick.llm.queries import secrets as Q

ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS, HEX = re.compile(r"AKIA[A-Z0-9]+"), re.compile(r"[0-9a-f]+")
RUN = re.compile(r"[A-Za-z0-9+/=_-]+")


def entropy(window):
    return -sum(window.count(c) / len(window) * math.log2(window.count(c) / len(window)) for c in set(window))


def spans_by_hand(text, whole=False):
    """``whole``: entropy spans as long as their candidates, as masks are."""
    text = text or ""
    base = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    base += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    base += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if len(m[0]) >= 32]
    added = []
    for m in RUN.finditer(text):
        run = m[0]
        if len(run) < 20 or any(re.fullmatch(p, run) for p in S.ALLOWED):
            continue
        need = S.HEX_BITS if re.fullmatch("[0-9A-Fa-f]+", run) else S.OTHER_BITS
        hot = [i for i in range(len(run) - 19) if entropy(run[i : i + 20]) >= need]
        if hot:
            span = (m.start() + hot[0], 3, m.start() + hot[-1] + 20)
            if not any(b[0] <= span[0] and b[2] >= span[2] for b in base):
                added.append((m.start(), 3, m.end()) if whole else span)
    return sorted(base + added)


def texts():
    rng = random.Random(2)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    token = lambda n, a=alphabet: "".join(rng.choice(a) for _ in range(n))
    out = [None, "", " ", "password=12345678", "PassWord: 'abcdefgh'", "token=api_key: abcdefgh123", "secret==abcdefg", "apikey = \"short\"", "api_keyX=abcdefghij",
           "token=secret=abcdefghij", "ſecret=abcdefghij", "toKen=abcdefghijk", "AKIA" + "B" * 12, "AKIA" + "B" * 11, "xAKIAAKIAAKIA0000", "AKIAb AKIA" + "9" * 30,
           "f" * 32, "f" * 31, "F" * 40, "z" + "0a" * 20 + "G", "\x01password=abcdefgh\x01\x02" + "ab" * 20, "日本😀 token: " + token(20) + " é " + token(40),
           "3f2504e0-4f89-11d3-9a0c-0305e82c3301", "x" * 5000, "the-quick-brown-fox-jumps-over", token(3000), "a b " * 20_000 + "passwd:abcdefgh1"]
    for _ in range(150):
        parts = [rng.choice(["word ", "\n", "key: ", "token=", token(rng.choice([5, 19, 20, 21, 64])), token(33, "0123456789abcdef"), token(25, "0123456789ABCDEF"),
                             " ", "'", "=", "é", "AKIA", token(14, "ABCDEF0123"), "secret ", ": "]) for _ in range(rng.randint(1, 14))]
        out.append("".join(parts))
    return out


def test_spans(spark):
    rows = [(i, t, 7) for i, t in enumerate(texts())]
    docs = spark.createDataFrame(rows + rows[:3], "doc_id long, text string, secret_spans int")
    found = S.with_secret_spans(docs).collect()
    assert len(found) == len(rows) + 3
    for r in found:
        assert [tuple(s) for s in r.secret_spans] == spans_by_hand(r.text), repr(r.text)
    assert S.with_secret_spans(docs.limit(0)).count() == 0
    assert any(s[1] == 3 for r in found for s in r.secret_spans)


def test_masked(spark):
    rows = [(i, t, 1) for i, t in enumerate(texts())]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    masked = S.mask_secrets(docs)
    assert masked.columns == docs.columns
    for r in masked.collect():
        text, out, at = rows[r.doc_id][1], "", 0
        for start, _, end in spans_by_hand(text, whole=True):
            if start >= at:
                out += text[at:start] + S.MASK
            at = max(at, end)
        assert r.text == (None if text is None else out + text[at:])


def test_query_is_native_and_right(spark, tmp_path):
    rows = [(i, t) for i, t in enumerate(texts())]
    spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_assign", F.lit("x")).write.parquet(str(tmp_path / "documents.parquet"))
    result = Q.op7_secrets(spark, str(tmp_path))
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
    for r in result.collect():
        spans = spans_by_hand(rows[r.doc_id][1])
        shown = [f"{S.KINDS[k]}:{a}:{b}" for a, k, b in spans]
        assert r.spans == ",".join(shown)
        base = ",".join(x for x in shown if not x.startswith("entropy"))
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(s[1] == k for s in spans) for k in range(3))


def test_lower_case_keys(spark):
    keys = ["3ax6xnjp29jd6fds4gc373sgvjxteol0", "9f86d081884c7d659a2feaa0c55ad0", "key-3ax6xnjp29jd6fds4gc373sgvjxteol0"]
    slugs = ["the-quick-brown-fox-jumps-over-2024", "2024/05/31/a-long-title-of-a-post", "pneumonoultramicroscopicsilicosis", "12345678901234567890123", "z" * 40 + "1" * 20]
    docs = spark.createDataFrame([(i, f"say {t} twice") for i, t in enumerate(keys + slugs)], "doc_id long, text string")
    found = {r.doc_id: [tuple(s) for s in r.secret_spans] for r in S.with_secret_spans(docs).collect()}
    for i, key in enumerate(keys):
        assert len(found[i]) == 1 and found[i][0][1] == 3, (key, found[i])
    assert all(found[len(keys) + i] == [] for i in range(len(slugs)))
    assert S.mask_secrets(docs).filter("doc_id = 0").first().text == f"say {S.MASK} twice"


def test_no_part_of_a_key_survives(spark):
    rng = random.Random(12)
    alphabets = ["abcdefghijklmnopqrstuvwxyz0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", "0123456789abcdef"]
    keys = ["".join(rng.choice(a) for _ in range(n)) for a in alphabets for n in (32, 40, 64) for _ in range(40)]
    docs = spark.createDataFrame([(i, f"before {k} after {k}, end") for i, k in enumerate(keys)], "doc_id long, text string")
    caught = 0
    for r in S.mask_secrets(docs).collect():
        key = keys[r.doc_id]
        if S.MASK in r.text:
            caught += 1
            assert r.text == f"before {S.MASK} after {S.MASK}, end"
        else:  # no window of the key reaches the limit
            assert not spans_by_hand(f"before {key} after")
    assert caught > 0.9 * len(keys)


def test_columns_of_helper_names(spark):
    rows = [(i, t, 1, 2, "a", 3) for i, t in enumerate(texts()[:40])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _base int, _entropy int, _Spans string, _masks int")
    spans, masked = S.with_secret_spans(docs), S.mask_secrets(docs)
    assert spans.columns == [*docs.columns, "secret_spans"] and masked.columns == docs.columns
    plain = {r.doc_id: r.text for r in S.mask_secrets(docs.select("doc_id", "text")).collect()}
    assert all(tuple(r)[2:] == (1, 2, "a", 3) and r.text == plain[r.doc_id] for r in masked.collect())
    assert all(tuple(r)[2:6] == (1, 2, "a", 3) and [tuple(s) for s in r.secret_spans] == spans_by_hand(r.text) for r in spans.collect())
