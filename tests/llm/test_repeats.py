import hashlib
import random

import numpy as np
import pytest

from gazetick.llm import repeats as R


def by_hand(rows, length=R.LENGTH):
    """id -> (bytes, removed ranges, kept)."""
    first = {}
    for id, text in rows:
        data = (text or "").encode()
        if id is not None:
            for i in range(len(data) - length + 1):
                window = data[i : i + length]
                first[window] = min(first.get(window, id), id)
    out = {}
    for id, text in rows:
        data = (text or "").encode()
        gone = np.zeros(len(data) + 1, bool)
        for i in range(len(data) - length + 1) if id is not None else ():
            if first[data[i : i + length]] < id:
                gone[i : i + length] = True
        gone[len(data)] = False
        edges = np.flatnonzero(np.diff(np.append(False, gone).astype(int)))
        out[id] = (len(data), list(zip(edges[::2].tolist(), edges[1::2].tolist())), bytes(b for b, g in zip(data, gone) if not g))
    return out


def corpus(seed, n=150):
    rng = random.Random(seed)
    word = lambda: rng.choice(["the", "ofé", "and", "x", "\x00", "日本", "tion", "er", "ing", "a" * 9])
    fresh = lambda k: " ".join(word() + str(rng.randrange(1000)) for _ in range(k))
    passages = [fresh(rng.choice([8, 20, 80])) for _ in range(12)]
    rows = []
    for i in range(n):
        parts = [rng.choice([fresh(rng.randint(0, 30)), rng.choice(passages), rng.choice(passages)[rng.randrange(20) :], rng.choice(passages)[:60], "ab" * rng.randint(0, 90), " " * rng.randint(0, 70)])
                 for _ in range(rng.randint(0, 6))]
        rows.append((rng.randrange(10**6) * (-1 if i % 9 == 0 else 1), "".join(parts)))
        if i % 10 == 0:
            rows.append((rng.randrange(10**6), rows[-1][1]))
    rows = list({id: (id, text) for id, text in rows}.values())
    same = rows[3]
    return rows + [same, (10**12, None), (10**12 + 1, ""), (10**12 + 2, "a" * 49), (10**12 + 3, "a" * 50), (10**12 + 4, "a" * 400), (10**12 + 5, "a" * 51 + "b")]


def check(spark, rows):
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, kept string")
    got = R.remove_repeats(docs).collect()
    want = by_hand(rows)
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_bytes, [tuple(x) for x in r.removed], bytes(r.kept)) == want[r.id], r.id
    return got


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_windows(spark, seed):
    got = check(spark, corpus(seed))
    assert sum(len(r.removed) for r in got) > 50


def test_crowded_names_are_spread(spark, monkeypatch):
    monkeypatch.setattr(R, "CROWDED", 3)
    monkeypatch.setattr(R, "BUCKET_BYTES", 4000)
    monkeypatch.setattr(R, "INDEXED", 3)
    monkeypatch.setattr(R, "SENT_BYTES", 700)
    check(spark, corpus(3))


def test_long_texts_and_pieces(spark, monkeypatch):
    rng = random.Random(6)
    passage = "".join(rng.choice("abcdef ") for _ in range(5000))
    rows = [(1, passage * 4), (0, "z" + passage[100:]), (2, passage[::-1] + passage), (3, "q" * 60_000), (4, "q" * 30_000 + passage[:49])]
    monkeypatch.setattr(R, "PIECE", 1000)
    check(spark, rows)


def test_no_id_and_nothing(spark):
    rows = [(None, "w" * 80), (5, "w" * 80), (6, "w" * 60)]
    check(spark, rows)
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert R.remove_repeats(docs).count() == 0


def test_runs_cover_all_windows_and_names_are_local():
    rng = random.Random(2)
    shared = bytes(rng.randrange(200) for _ in range(400))
    names = []
    for before in (b"", b"12345", b"x" * 77):
        text = before + shared + b"end"
        start, end, name = R.string_runs(text)
        assert start[0] == 0 and end[-1] == len(text) - 49 and (start[1:] == end[:-1]).all() and (end - start).max() <= R.STRING_WINDOWS
        each = np.repeat(name, end - start)
        names.append(each[len(before) : len(before) + 351])
    assert (names[0] == names[1]).all() and (names[0] == names[2]).all()


def test_index_rows_and_matches():
    rng = random.Random(4)
    base = bytes(rng.randrange(60, 64) for _ in range(300))
    strings = list({base[i : i + rng.randint(50, 80)] for i in rng.sample(range(200), 60)})
    documents = np.array([rng.randrange(40) for _ in strings])
    index = R.RunIndex(strings, documents)
    others = [base[i : i + 70] for i in range(0, 230, 9)] + [b"\xf0" + base[5:70], base[:40] + b"!" + base[41:95], b"@" * 60]
    streamed = [(strings, documents), (others, np.array([rng.randrange(40) for _ in others]))]
    for some, own in streamed:
        marked = index.smaller_matches(some, own)
        for i, string in enumerate(some):
            for j in range(len(string) - 49):
                want = any(documents[k] < own[i] and string[j : j + 50] in other for k, other in enumerate(strings))
                assert marked[i, j] == want
    # The samples decide: with wrong ones the same strings match elsewhere or not at all.
    right = index.smaller_matches(*streamed[1])
    index.heads, index.tails = np.roll(index.heads, 7), np.roll(index.tails, 7)
    assert (index.smaller_matches(*streamed[1]) != right).any()
    assert len(index.starts) < sum(map(len, strings)) / 3


def test_query_digest(spark):
    from gazetick.llm.queries.repeats import op9_repeats

    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    want = by_hand(rows)
    for r in op9_repeats(spark, sf).collect():
        size, ranges, kept = want[r.doc_id]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (size, size - len(kept), len(ranges), hashlib.sha256(kept).hexdigest())


def test_a_crowded_name_spreads_no_other_bucket(spark, monkeypatch):
    # Short names of 3 bits: crowded names collide with names of other buckets that few documents have.
    monkeypatch.setattr(R, "CROWDED", 3)
    monkeypatch.setattr(R, "BUCKET_BYTES", 400)
    monkeypatch.setattr(R, "short", lambda name: (name & np.uint64(7)).astype(np.int32))
    rng = random.Random(9)
    fresh = lambda k: "".join(rng.choice("abcdefgh ") for _ in range(k))
    hot, pairs = fresh(60), [fresh(70) for _ in range(30)]
    rows = [(i, fresh(100) + hot) for i in range(12)]
    rows += [(100 + i, fresh(30) + p + (hot if i % 2 else "")) for i, p in enumerate(pairs)] + [(200 + i, p + fresh(30)) for i, p in enumerate(pairs)]
    check(spark, rows)


def test_batch_runs_equal_single_texts(monkeypatch):
    rng = random.Random(3)
    for piece in (200, 1 << 17):
        monkeypatch.setattr(R, "PIECE", piece)
        texts = [bytes(rng.randrange(4) for _ in range(rng.choice([0, 0, 10, 49, 50, 51, 90, 150, 400]))) for _ in range(60)]
        text, start, end, name = R.batch_runs(texts)
        assert ((end - start > 0) & (end - start <= R.STRING_WINDOWS)).all()
        each = {(t, w): n for t, a, b, n in zip(text, start, end, name, strict=True) for w in range(a, b)}
        assert len(each) == (end - start).sum()
        want = {}
        for i, t in enumerate(texts):
            for a, b, n in zip(*R.string_runs(t), strict=True):
                want |= {(i, w): n for w in range(a, b)}
        assert each == want
    assert [len(x) for x in R.batch_runs([])] == [0, 0, 0, 0] == [len(x) for x in R.batch_runs([b"", b"x" * 49])]


def test_strings_of_one_hash(spark, monkeypatch):
    monkeypatch.setattr(R, "content_hashes", lambda data, starts, sizes: np.zeros(len(starts), np.uint64))
    monkeypatch.setattr(R, "CROWDED", 3)
    rows = corpus(5, 60)
    told = R._Told(np.array([1, 1, 2]), np.array([5, 5, 7]), np.array([0, 3, 0]))
    found, spread = told.look_up(np.array([1, 1, 2, 3]), np.array([5, 6, 7, 5]), np.array([2, 2, 2, 2]))
    assert found.tolist() == [True, False, True, False] and spread.tolist() == [True, False, False, False]
    check(spark, rows)
