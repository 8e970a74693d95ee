import random

import numpy as np
import xxhash

from gazetick.llm import simhash as S

SCHEMA = "doc_id long, text string, fp string, root long"


def fingerprint_by_hand(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ")
             .replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def classes_by_hand(prints):
    """prints: id -> fingerprint."""
    root = {i: i for i in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(prints)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= 3:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in ids}


def test_fingerprint():
    for text in (None, "", " \t\n", "one", "One two", "a b c", "A b\x0bC\x0cd\re  f", "É é \x1c x\xa0y z", "w " * 500, "İ K ſ"):
        assert S.fingerprint(text) == fingerprint_by_hand(text), text
    text = " ".join(str(i) for i in range(S.SLICE + 10))
    assert S.fingerprint(text) == fingerprint_by_hand(text)


def test_bound_and_forest():
    rng = np.random.default_rng(0)
    a = rng.integers(0, 2**63, 4000).astype(np.uint64)
    b = a ^ (np.uint64(1) << rng.integers(0, 64, 4000).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 4000).astype(np.uint64))

    def points(x):
        low = np.uint64(S.LOW_BITS)
        return x - ((x >> np.uint64(1)) & low)

    apart = S.manhattan(points(a), points(b))
    by_hand = [sum(abs((int(x) >> i & 3).bit_count() - (int(y) >> i & 3).bit_count()) for i in range(0, 64, 2)) for x, y in zip(a, b)]
    assert apart.tolist() == by_hand
    assert (apart <= np.bitwise_count(a ^ b)).all()
    chain = np.array([0, 7, 63, 127 << 40, (127 << 40) + 1], np.uint64)
    assert sorted(map(tuple, S.forest(chain, points(chain)))) == [(0, 1), (1, 2), (3, 4)]


def near_prints(rng):
    prints = {}
    for group in range(40):
        centre = rng.getrandbits(64)
        for _ in range(rng.choice([1, 2, 5, 60])):
            value = centre
            for _ in range(rng.randint(0, 4)):
                value ^= 1 << rng.randrange(64)
            prints[rng.randrange(10**9)] = value
    return prints | {-5: 0, 10**10: 2**64 - 1, 10**10 + 1: 2**64 - 5, 10**10 + 2: 1 << 63, 10**10 + 3: 0}


def test_links_join_the_same_classes(spark, monkeypatch):
    rng = random.Random(4)
    prints = near_prints(rng)
    want = classes_by_hand(prints)
    frame = spark.createDataFrame([(i, v - (1 << 64) if v >> 63 else v) for i, v in prints.items()], "id long, fp long")
    monkeypatch.setattr(S, "fingerprints", lambda docs, id, text: docs.select("id", "fp"))
    assert {r.id: r.root for r in S.near_duplicates(frame).collect()} == want
    points = frame.groupBy("fp").agg({"id": "min"}).withColumnRenamed("min(id)", "rep")
    whole = {(min(r), max(r)) for r in map(tuple, S.near_links(points).collect())}
    cut = {(min(r), max(r)) for r in map(tuple, S.near_links(points, block=7).collect())}
    for links in (whole, cut):
        assert classes_of(links, [r.rep for r in points.collect()]) == {i: want[i] for i in [r.rep for r in points.collect()]}


def classes_of(links, nodes):
    root = {i: i for i in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(root[a], root[b])
            if root[a] != low or root[b] != low:
                root[a] = root[b] = low
                changed = True
    return root


def test_documents(spark):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(3000)]
    rows = []
    for i in range(120):
        base = [rng.choice(words) for _ in range(rng.choice([1, 4, 300, 600]))]
        rows.append((i, " ".join(base), "x", 1))
        if i % 4 == 0:
            near = list(base)
            near[rng.randrange(len(near))] = "changed"
            rows += [(1000 + i, " ".join(near), None, 1), (2000 + i, " ".join(base), None, 2)]
    rows += [(5000, None, None, None), (5001, "", None, None), (5002, " \n", None, None), (5002, " \n", None, None), (5003, "v " * 20_000, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    want = classes_by_hand({i: fingerprint_by_hand(t) for i, t, _, _ in rows})
    got = S.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    assert {r.id: r.root for r in got} == want
    kept = S.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, root in want.items() if i == root)
    assert S.near_duplicates(docs.limit(0)).count() == 0 and S.keep_one(docs.limit(0)).count() == 0


def test_rows_without_an_id(spark):
    text = " ".join(f"w{i}" for i in range(400))
    rows = [(5, text), (None, text), (None, text + " changed"), (None, "quite another text"), (9, text + " changed"), (None, None)]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    want = classes_by_hand({i: fingerprint_by_hand(t) for i, t in rows if i is not None})
    got = S.near_duplicates(docs).collect()
    prints = sorted(fingerprint_by_hand(t) for _, t in rows)
    assert sorted(r.fp % 2**64 for r in got) == prints
    assert {r.id: r.root for r in got if r.id is not None} == want
    assert [r.root for r in got if r.id is None] == [None] * 4
    kept = S.keep_one(docs).collect()
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == sorted({r for r in want.values()})
    assert sorted(str(r.text) for r in kept if r.doc_id is None) == sorted(str(t) for i, t in rows if i is None)
