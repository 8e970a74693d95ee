import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from gazetick.llm import collocations as C

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def by_hand(docs, longest=4, least=30, first=2000, scale=2_000_000):
    counts, total = defaultdict(Counter), Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = tuple(re.findall(r"[^\x20\x09]+", piece))
            total[lang] += len(words)
            for m in range(1, longest + 1):
                counts[lang].update(words[i : i + m] for i in range(len(words) - m + 1))
    out = []
    for lang, f in counts.items():
        some = {g: a for g, a in f.items() if len(g) > 1 and a >= least}
        covered = set()
        for g, b in some.items():
            for m in range(2, len(g)):
                covered |= {p for i in range(len(g) - m + 1) if 100 * b >= 80 * f[p := g[i : i + m]]}
        rows = []
        for g, a in some.items():
            if g not in covered:
                score, k = min((scale * a // (f[g[:k]] + f[g[k:]]), k) for k in range(1, len(g)))
                rows.append((-score, -a, " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        out += [(lang, r, p.decode(), -a, l, x, total[lang], -s) for r, (s, a, p, l, x) in enumerate(sorted(rows)[:first], 1)]
    return sorted(out)


def corpus(rng, n=150):
    words = [f"w{int(rng.paretovariate(0.7)) % 300}" for _ in range(900)] + ["é", "Ünï", "日本", "a\x01", "a", "A", "a\x1cb", "x" * 90, "ſ"]
    phrases = ["of the", "New York City", "in the end of", "to be or not to be", "a\x01 b", "x" * 90 + " y"]
    docs = []
    for i in range(n):
        parts = []
        for _ in range(rng.choice([3, 80, 150])):
            parts += [rng.choice(words) if rng.random() < 0.7 else rng.choice(phrases), rng.choice([" ", " ", "  ", "\t", ", ", ".", "\n", "\x0b", " ; "])]
        docs.append(("".join(parts), rng.choice(["en", "en", "en", "de", None, "und", ""])))
    return docs + [(None, "en"), ("", "en"), (None, None), ("...", "xx"), ("same line here again", "en")] + [docs[0]] * 40 + [("hot pair " * 500, "en"), ("b " * 3000, "de")]


@pytest.mark.parametrize("sizes", [
    {}, {"SHARD": 3000, "RANGE": 4000, "SLICE": 50}, {"SHARD": 900, "RANGE": 2500, "RANGES": 3, "HELD": 100}, {"SHARD": 5, "RANGE": 60_000, "SLICE": 7},
])
def test_against_all_sequences(spark, monkeypatch, sizes):
    rng = random.Random(len(sizes))
    rows = corpus(rng, 150 if sizes.get("SHARD") != 5 else 12)
    for name, value in sizes.items():
        monkeypatch.setattr(C, name, value)
    docs = spark.createDataFrame([(i, t, c, 0, 0) for i, (t, c) in enumerate(rows)], "doc_id long, text string, lang string, rank int, place int").repartition(3)
    found = C.collocations(docs)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in found.collect()) == by_hand(rows)
    few = C.collocations(docs, longest=3, least=12, first=9)
    assert sorted(tuple(r) for r in few.collect()) == by_hand(rows, 3, 12, 9)


def test_empty(spark):
    docs = spark.createDataFrame([(None, None), ("", "en"), ("one two", "en")], "text string, lang string")
    assert C.collocations(docs).count() == 0
    assert C.collocations(docs.limit(0)).count() == 0


def sequences(automaton):
    return {tuple(automaton.names[i] for i in row): int(w) for d in range(len(automaton.levels)) for row, w in zip(automaton.rows(d), automaton.levels[d][2], strict=True)}


def some_automaton(rng, size):
    shard = C.Shard(4)
    for _ in range(size):
        shard.add(rng.choice([b"de", b"en"]), [rng.choice([b"a", b"b", b"ab", b"c\x01", b"."]) for _ in range(rng.randint(0, 9))] + [b"."])
    return shard.automaton()


def test_dealt_and_united():
    rng = random.Random(6)
    for parts in (1, 3):
        for _ in range(60):
            whole = some_automaton(rng, rng.randint(1, 12))
            keys = sorted({tuple(rng.choice([b"a", b"b", b"bb", b"de", b"en", b"", b"z", b"c"]) for _ in range(rng.randint(1, 5))) for _ in range(rng.randint(0, 8))})
            shares = [(place, C.Automaton.unpack(share.pack())) for place, share in whole.dealt(keys, parts)]
            assert sequences(C.Automaton.united([s for _, s in shares])) == sequences(whole)
            owned = [(q, place) for place, s in shares for q, w in sequences(s).items() if w]
            assert len(owned) == len({q for q, _ in owned})
            for q, place in owned:
                assert place // parts == sum(k <= q for k in keys)


def test_big_numbers():
    a, l, r = 9 * 10**15, 3 * 10**16, 4 * 10**16
    names = [b"en", b"x", b"y"]
    levels = [(np.zeros(1, int), np.array([0]), np.array([0])), (np.zeros(2, int), np.array([1, 2]), np.array([l, r])), (np.array([0]), np.array([2]), np.array([a]))]
    whole = C.Automaton(names, levels)
    rows = list(C.scored(whole, [np.zeros(len(x[1]), int) for x in levels], whole, 2_000_000, (80, 100)))
    assert rows == [("en", "x y", a, l, r, 2_000_000 * a // (l + r))]


def test_long_text_in_parts(spark, monkeypatch):
    monkeypatch.setattr(C, "SHARD", 10_000)
    rng = random.Random(2)
    rows = [(" ".join(rng.choice(["a", "b", "c", "d,", "e"]) for _ in range(60_000)), "en")]
    found = C.collocations(spark.createDataFrame(rows, "text string, lang string"))
    assert sorted(tuple(r) for r in found.collect()) == by_hand(rows)


def test_shards_of_slices(monkeypatch):
    rows = [(c, t) for t, c in corpus(random.Random(3), 20)]
    whole = sequences(C.Automaton.united(list(C.shards(iter(rows), 4, 1 << 30))))
    for size, most in ((1, 50), (9, 1), (64, 333), (1 << 20, 2000)):
        monkeypatch.setattr(C, "SLICE", size)
        assert sequences(C.Automaton.united(list(C.shards(iter(rows), 4, most)))) == whole
