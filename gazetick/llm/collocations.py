"""Phrase collocations by weighted acyclic automata.

Every shard of documents becomes an automaton that maps word sequences of one to four words to their
counts. It is built level by level from the shard's sorted n-grams: a state per distinct sequence, an
arc per next word, the count on the state. A state is reached by one sequence only, since weights of
states differ and no two could be shared; so the automaton is a tree below its languages.

Sequences are sorted by language and words, and boundaries from a sample of the documents cut that
order into prefix ranges of bounded size. Shards send each range its part of their automaton; a part
keeps the states that lead into it, without weight. The parts of a range are united as they come,
weights added, and states below ``LEAST`` are dropped: what is left has every frequent sequence's exact
count in one range, whichever sequence is hot.

Candidates need the counts of their parts, most of them in other ranges. A range unites all parts it
asks for into one automaton, so that a common part is asked once, and sends its ranges' parts there;
the owner walks it together with its own (their composition), and answers with the counts. The same
automaton carries, as weights, the greatest count of a longer candidate that holds a part.

Beyond ``RANGES`` boundaries (their number bounds what is broadcast) the sequences of a range are dealt
over several places by a hash of the whole sequence. Places and sample change the work, not the result.

Null texts are empty, null languages are ``und``. Rows count as often as they come; ids and other
columns are not read. Texts of any length are taken in parts. An empty table has no phrases.
"""

from __future__ import annotations

import pickle
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gazetick.llm.common import small_batches
from gazetick.session import stage

LONGEST = 4
LEAST = 30
FIRST = 2000
SCALE = 2_000_000
#: A phrase goes if a longer one that holds it has at least this share of its count.
WITHIN = (80, 100)
NO_LANGUAGE = "und"

#: Bytes of text of a shard, of text per range, and of text read for boundaries.
SHARD, RANGE, SAMPLE = 16 << 20, 6 << 20, 32 << 20
#: Boundaries at most, sampled sequences per boundary, and bytes of a word in a boundary.
RANGES, PER_RANGE, BOUNDARY_WORD = 20_000, 20, 64
#: Bytes of a text that are split at once; states that are held before they are united.
SLICE, HELD = 1 << 20, 4_000_000

_END = b"."  # no word is a separator
_SPLIT = bytes(ord(".") if chr(b) in ".,;:!?\n\x0b\x0c\r" else 32 if b in (9, 32) else b + 32 if 65 <= b <= 90 else b for b in range(256))
Key = tuple[bytes, ...]


def word_slices(text: str | None) -> Iterator[list[bytes]]:
    """The words of a text, with ``_END`` between its pieces, in lists of bounded size."""
    data = (text or "").encode()
    low = 0
    while low < len(data):
        high = low + SLICE
        while high < len(data) and _SPLIT[data[high]] not in b" .":
            high += 1
        yield data[low:high].translate(_SPLIT).replace(b".", b" . ").split()
        low = high


def _grouped(keys: np.ndarray, weights: np.ndarray, reduce: np.ufunc) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, each key's place among them, and their weights reduced."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.append(True, keys[1:] != keys[:-1])[: len(keys)]
    starts = np.flatnonzero(first)
    place = np.empty(len(keys), np.int64)
    place[order] = np.cumsum(first) - 1
    return keys[starts], place, reduce.reduceat(weights[order], starts) if len(starts) else weights


class Automaton:
    """Weights of word sequences: ``levels[d]`` holds the states of depth ``d`` by parent and label.

    Labels are places in the sorted ``names``; level 0 are the languages, whose parent is 0.
    """

    def __init__(self, names: list[bytes], levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
        self.names, self.levels = names, levels

    def __len__(self) -> int:
        return sum(len(label) for _, label, _ in self.levels)

    @staticmethod
    def of_rows(names: list[bytes], rows: np.ndarray, weights: np.ndarray, reduce: np.ufunc) -> Automaton:
        """From sequences of labels, a row each and -1 after their ends; the weight is that of the whole row."""
        levels, parent = [], np.zeros(len(rows), np.int64)
        width = len(names)
        for depth in range(rows.shape[1]):
            inside = rows[:, depth] >= 0
            rows, weights, parent = rows[inside], weights[inside], parent[inside]
            if not len(rows):
                break
            ends = rows[:, depth + 1] < 0 if depth + 1 < rows.shape[1] else np.ones(len(rows), bool)
            keys, parent, found = _grouped(parent * width + rows[:, depth], np.where(ends, weights, 0), reduce)
            levels.append((keys // width, keys % width, found))
        return Automaton(names, levels)

    @staticmethod
    def united(parts: list[Automaton], reduce: np.ufunc = np.add) -> Automaton:
        names = sorted(set().union(*(p.names for p in parts)))
        number = {w: i for i, w in enumerate(names)}
        labels = [np.array([number[w] for w in p.names], np.int64) for p in parts]
        above: list[np.ndarray] = [np.zeros(1, np.int64)] * len(parts)
        levels = []
        for depth in range(max((len(p.levels) for p in parts), default=0)):
            deep = [(i, p.levels[depth]) for i, p in enumerate(parts) if depth < len(p.levels)]
            keys = np.concatenate([above[i][parent] * len(names) + labels[i][label] for i, (parent, label, _) in deep])
            keys, place, weights = _grouped(keys, np.concatenate([w for _, (_, _, w) in deep]), reduce)
            levels.append((keys // len(names), keys % len(names), weights))
            cuts = np.cumsum([len(label) for _, (_, label, _) in deep])[:-1]
            for (i, _), own in zip(deep, np.split(place, cuts), strict=True):
                above[i] = own
        return Automaton(names, levels)

    def kept(self, keep: list[np.ndarray]) -> Automaton:
        """The marked states, and those that lead to them without weight."""
        needed = [k.copy() for k in keep]
        for depth in range(len(keep) - 1, 0, -1):
            needed[depth - 1][self.levels[depth][0][needed[depth]]] = True
        levels, place = [], np.zeros(1, np.int64)
        for (parent, label, weight), k, n in zip(self.levels, keep, needed, strict=True):
            if not n.any():
                break
            levels.append((place[parent[n]], label[n], np.where(k, weight, 0)[n]))
            place = np.cumsum(n) - 1
        used = np.unique(np.concatenate([label for _, label, _ in levels])) if levels else np.empty(0, np.int64)
        names = [self.names[i] for i in used.tolist()]
        return Automaton(names, [(p, np.searchsorted(used, label), w) for p, label, w in levels])

    def starts(self, key: Key) -> list[int]:
        """Of each level the first state whose sequence isn't before ``key``."""
        out, low, high, on_path = [], 0, len(self.levels[0][1]) if self.levels else 0, True
        for depth, (parent, label, _) in enumerate(self.levels):
            if depth:
                low, high = (int(x) for x in np.searchsorted(parent, [at, at + 1] if on_path else [out[-1], out[-1]]))
            if not on_path:
                out.append(low)
                continue
            name = bisect_left(self.names, key[depth])
            at = low + int(np.searchsorted(label[low:high], name))
            on_path = at < high and name < len(self.names) and self.names[name] == key[depth] and int(label[at]) == name
            # A state on the way to the key is before it, as a prefix is.
            if on_path and depth + 1 < len(key):
                out.append(at + 1)
            else:
                out.append(at)
                on_path = False
        return out

    def dealt(self, boundaries: list[Key], parts: int) -> Iterator[tuple[int, Automaton]]:
        """The places that own states of this automaton, and their share of it."""
        sizes = [len(label) for _, label, _ in self.levels]
        cuts = [[0] * len(sizes), *(self.starts(b) for b in boundaries), sizes]
        hashes = self._hashes() if parts > 1 else None
        for number, (low, high) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            if low == high:
                continue
            begin = list(low)
            for depth in range(len(sizes) - 1, 0, -1):  # the state that leads into the range is just before it
                if begin[depth] < high[depth]:
                    begin[depth - 1] = min(begin[depth - 1], int(self.levels[depth][0][begin[depth]]))
            levels, keep = [], []
            for depth, (parent, label, weight) in enumerate(self.levels):
                span = slice(begin[depth], high[depth])
                levels.append((parent[span] - (begin[depth - 1] if depth else 0), label[span], weight[span]))
                keep.append(np.arange(begin[depth], high[depth]) >= low[depth])
            share = Automaton(self.names, levels)
            for part in range(parts):
                mine = keep if hashes is None else [k & (h[b:e] % parts == part) for k, h, b, e in zip(keep, hashes, begin, high, strict=True)]
                if any(k.any() for k in mine):
                    yield number * parts + part, share.kept(mine)

    def _hashes(self) -> list[np.ndarray]:
        of_names = np.array([zlib.crc32(w) for w in self.names], np.int64)
        out = []
        for depth, (parent, label, _) in enumerate(self.levels):
            out.append(((out[-1][parent] if depth else 0) * 1_000_003 + of_names[label]) % 2_147_483_647)
        return out

    def rows(self, depth: int) -> np.ndarray:
        """Labels of the states of a level, from the language on."""
        at = np.arange(len(self.levels[depth][1]))
        out = []
        for d in range(depth, -1, -1):
            parent, label, _ = self.levels[d]
            out.append(label[at])
            at = parent[at]
        return np.stack(out[::-1], axis=1)

    def walk(self, other: Automaton) -> list[np.ndarray]:
        """Of each state of ``other`` the state of the same sequence here, or -1."""
        number = {w: i for i, w in enumerate(self.names)}
        labels = np.array([number.get(w, -1) for w in other.names], np.int64)
        out, above = [], np.zeros(1, np.int64)
        width = len(self.names) + 1
        for depth, (parent, label, _) in enumerate(other.levels):
            if depth >= len(self.levels):
                out.append(np.full(len(label), -1))
                above = out[-1]
                continue
            keys = self.levels[depth][0] * width + self.levels[depth][1]
            mother, name = above[parent], labels[label]
            wanted = np.where((mother >= 0) & (name >= 0), mother * width + name, -1)
            at = np.searchsorted(keys, wanted)
            hit = at < len(keys)
            hit[hit] = keys[at[hit]] == wanted[hit]
            above = np.where(hit, at, -1)
            out.append(above)
        return out

    def answer(self, asked: Automaton, marks: list[np.ndarray]) -> Automaton:
        """``asked`` with the weights from here; the weights it came with raise the ``marks`` of our states."""
        levels = []
        for depth, (found, (parent, label, weight)) in enumerate(zip(self.walk(asked), asked.levels, strict=True)):
            hit, counts = found >= 0, np.zeros(len(found), np.int64)
            if hit.any():
                np.maximum.at(marks[depth], found[hit], weight[hit])
                counts[hit] = self.levels[depth][2][found[hit]]
            levels.append((parent, label, counts))
        return Automaton(asked.names, levels)

    def pack(self) -> bytes:
        small = lambda a: a.astype(np.min_scalar_type(int(a.max(initial=0))))
        levels = [(small(np.diff(parent, prepend=0)), small(label), small(weight)) for parent, label, weight in self.levels]
        lengths = small(np.array([len(w) for w in self.names], np.int64))
        data = pickle.dumps((b"".join(self.names), lengths, levels), protocol=5)
        return len(data).to_bytes(8, "little") + pa.Codec("zstd", compression_level=1).compress(data, asbytes=True)

    @staticmethod
    def unpack(data: bytes) -> Automaton:
        text, lengths, levels = pickle.loads(pa.Codec("zstd").decompress(data[8:], int.from_bytes(data[:8], "little"), asbytes=True))
        ends = np.cumsum(lengths, dtype=np.int64)
        names = [text[a:b] for a, b in zip((ends - lengths).tolist(), ends.tolist(), strict=True)]
        return Automaton(names, [(np.cumsum(p, dtype=np.int64), label.astype(np.int64), w.astype(np.int64)) for p, label, w in levels])


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


class Shard:
    """Words of some documents by language; a separator has number 0."""

    def __init__(self, longest: int):
        self.longest = longest
        self.numbers, self.streams, self.size = _Numbers({_END: 0}), {}, 0

    def add(self, language: bytes, words: list[bytes]) -> None:
        self.streams.setdefault(language, []).append(np.fromiter(map(self.numbers.__getitem__, words), np.int32, len(words)))

    def tail(self, language: bytes) -> list[bytes]:
        """The last words, whose sequences a document that goes on will finish."""
        names = list(self.numbers)
        last = np.concatenate(self.streams[language])[1 - self.longest :] if self.longest > 1 else []
        return [names[i] for i in last]

    def automaton(self, going_on: bytes | None = None) -> Automaton:
        languages = sorted(self.streams)
        words = list(self.numbers)
        names = sorted({*words[1:], *languages})
        number = {w: i for i, w in enumerate(names)}
        label = np.array([-1, *(number[w] for w in words[1:])], np.int64)
        flat, depth0, open_ = [], [], []
        for place, language in enumerate(languages):
            stream = np.concatenate([*self.streams[language], np.zeros(self.longest, np.int32)])
            last = len(stream) - self.longest - (self.longest - 1 if language == going_on else 0)
            flat.append(stream)
            depth0.append(np.full(len(stream), place))
            open_.append(np.arange(len(stream)) < last)
        labels = label[np.concatenate(flat)] if flat else np.empty(0, np.int64)
        at = np.flatnonzero((labels >= 0) & np.concatenate(open_)) if flat else labels
        state = np.concatenate(depth0)[at] if flat else labels
        levels = [(np.zeros(len(languages), np.int64), np.array([number[w] for w in languages], np.int64), np.bincount(state, minlength=len(languages)))]
        for depth in range(self.longest):
            inside = labels[at + depth] >= 0
            at, state = at[inside], state[inside]
            if not len(at):
                break
            keys, state, counts = np.unique(state * len(names) + labels[at + depth], return_inverse=True, return_counts=True)
            levels.append((keys // len(names), keys % len(names), counts))
        return Automaton(names, levels)


def shards(rows: Iterator[tuple[str | None, str | None]], longest: int, most: int) -> Iterator[Automaton]:
    """Automata of bounded size over ``language, text``."""
    shard, size = Shard(longest), 0
    for language, text in rows:
        name = (NO_LANGUAGE if language is None else language).encode()
        for words in word_slices(text):
            shard.add(name, words)
            size += sum(map(len, words)) + len(words)
            if size >= most:  # the text may go on
                tail = shard.tail(name)
                yield shard.automaton(name)
                shard, size = Shard(longest), 0
                shard.add(name, tail)
        if text:
            shard.add(name, [_END])
    if shard.streams:
        yield shard.automaton()


PLACED = "place int, kind int, source int, payload binary"


def _placed(rows: Iterator[tuple[int, int, int, bytes]], most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Record batches of rows to be sent, of about ``most`` bytes."""
    held, size = [], 0

    def batch() -> pa.RecordBatch:
        columns = list(zip(*held, strict=True))
        arrays = [pa.array(c, pa.int32()) for c in columns[:3]] + [pa.array(columns[3], pa.binary())]
        return pa.RecordBatch.from_arrays(arrays, ["place", "kind", "source", "payload"])

    for row in rows:
        held.append(row)
        size += len(row[3])
        if size >= most:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


def _arrived(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Iterator[tuple[int, int, bytes]]]]:
    """Rows by place; a place's rows follow each other."""
    from itertools import groupby

    flat = (row for b in batches for row in zip(*(b.column(c).to_pylist() for c in ("place", "kind", "source", "payload")), strict=True))
    for place, rows in groupby(flat, key=lambda row: row[0]):
        yield place, (row[1:] for row in rows)


def united_stream(parts: Iterator[Automaton], reduce: np.ufunc, most: int) -> Automaton:
    """The union of all parts, of which about ``most`` states are held beside it."""
    whole, held, size = [], [], 0
    for part in parts:
        held.append(part)
        size += len(part)
        if size >= max(most, 2 * sum(map(len, whole))):
            whole, held, size = [Automaton.united(whole + held, reduce)], [], 0
    return Automaton.united(whole + held, reduce)


class Plan:
    """Boundaries and places, which every task knows, and how rows meet."""

    def __init__(self, docs: DataFrame, longest: int, least: int):
        self.longest, self.least = longest, least
        self.shard, self.held = SHARD, HELD
        size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        ranges = size // RANGE + 1
        self.parts = -(-ranges // RANGES)
        self.places = min(ranges, RANGES) * self.parts
        self.boundaries: Broadcast = docs.sparkSession.sparkContext.broadcast(_boundaries(docs, size, min(ranges, RANGES), longest))

    def sent(self, rows: DataFrame) -> DataFrame:
        """Rows at their places, in order; two places a task on average."""
        return rows.repartition(max(1, -(-self.places // 2)), "place").sortWithinPartitions("place", "kind", "source")


def _boundaries(docs: DataFrame, size: int, ranges: int, longest: int) -> list[Key]:
    """Quantiles of the sequences of some documents; at most ``RANGES`` x ``PER_RANGE`` come to the driver."""
    if ranges < 2:
        return []
    some = docs.filter(F.rand(42) < min(1.0, SAMPLE / size))
    step = max(1, min(size, SAMPLE) // (6 * ranges * PER_RANGE))  # about six bytes a word

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = 0
        for batch in batches:
            keys = []
            for language, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                name = (NO_LANGUAGE if language is None else language).encode()[:BOUNDARY_WORD]
                for words in word_slices(text):
                    for i in range(at, len(words), step):
                        key = words[i : i + longest]
                        key = key[: key.index(_END)] if _END in key else key
                        keys.append(pickle.dumps((name, *(w[:BOUNDARY_WORD] for w in key))))
                    at = (at - len(words)) % step
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary())], ["key"])

    keys = sorted(pickle.loads(r["key"]) for r in some.mapInArrow(pick, "key binary").collect())
    picked = {keys[i * len(keys) // ranges] for i in range(1, ranges)} if keys else set()
    return sorted(picked)


def frequent_sequences(docs: DataFrame, plan: Plan) -> DataFrame:
    """Per place the automaton of the sequences that come at least ``plan.least`` times."""
    boundaries, parts, longest, least, shard, held = plan.boundaries, plan.parts, plan.longest, plan.least, plan.shard, plan.held

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for b in batches for row in zip(b.column("lang").to_pylist(), b.column("text").to_pylist(), strict=True))
        shares = (share for a in shards(rows, longest, shard) for share in a.dealt(boundaries.value, parts))
        yield from _placed((place, 0, 0, share.pack()) for place, share in shares)

    def unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple[int, int, int, bytes]]:
            for place, rows in _arrived(batches):
                whole = united_stream((Automaton.unpack(data) for _, _, data in rows), np.add, held)
                keep = [whole.levels[0][2] > 0, *(weight >= least for _, _, weight in whole.levels[1:])]
                yield place, 0, place, whole.kept(keep).pack()

        yield from _placed(found())

    return stage(plan.sent(docs.mapInArrow(count, PLACED)).mapInArrow(unite, PLACED))


def questions(whole: Automaton) -> Automaton | None:
    """The parts of all candidates; weights are the greatest counts of longer candidates that hold them."""
    rows, weights = [], []
    width = len(whole.levels)
    for depth in range(2, width):
        chosen = np.flatnonzero(whole.levels[depth][2])
        if not len(chosen):
            continue
        labels, counts = whole.rows(depth)[chosen], whole.levels[depth][2][chosen]
        for low in range(1, depth + 1):
            for high in range(low + 1, depth + 2):
                size = high - low
                if size == depth or (size == 1 and 1 < low < depth):
                    continue
                row = np.full((len(chosen), width), -1, np.int64)
                row[:, 0], row[:, 1 : size + 1] = labels[:, 0], labels[:, low:high]
                rows.append(row)
                weights.append(counts if size > 1 else np.zeros(len(counts), np.int64))
    return Automaton.of_rows(whole.names, np.concatenate(rows), np.concatenate(weights), np.maximum) if rows else None


def scored(whole: Automaton, marks: list[np.ndarray], answers: Automaton, scale: int, within: tuple[int, int]) -> Iterator[tuple]:
    """``language, phrase, a, l, r, score`` of the candidates that no longer one covers."""
    for depth in range(2, len(whole.levels)):
        a = whole.levels[depth][2]
        covered = marks[depth].astype(object) * within[1] >= a.astype(object) * within[0]
        chosen = np.flatnonzero((a > 0) & ~covered.astype(bool))
        if not len(chosen):
            continue
        labels, a = whole.rows(depth)[chosen], a[chosen].astype(object)
        best = None
        for cut in range(1, depth):
            left = _weights_of(answers, whole.names, labels[:, : cut + 1])
            right = _weights_of(answers, whole.names, np.concatenate([labels[:, :1], labels[:, cut + 1 :]], axis=1))
            score = scale * a // (left + right)
            if best is None:
                best = [score, left, right]
            else:
                lower = (score < best[0]).astype(bool)
                best = [np.where(lower, new, old) for new, old in zip((score, left, right), best, strict=True)]
        for row, count, score, left, right in zip(labels.tolist(), a, *best, strict=True):
            language, *words = (whole.names[i] for i in row)
            yield language.decode(), b" ".join(words).decode(), int(count), int(left), int(right), int(score)


def _weights_of(answers: Automaton, names: list[bytes], labels: np.ndarray) -> np.ndarray:
    """Exact weights of sequences of labels in ``names``; all of them have been asked for."""
    asked = Automaton.of_rows(names, labels, np.zeros(len(labels), np.int64), np.maximum)
    # The states of the asked sequences, one a row, found by walking the rows once more.
    places, parent = None, np.zeros(len(labels), np.int64)
    for depth, (mother, label, _) in enumerate(asked.levels):
        keys = mother * len(names) + label
        places = parent = np.searchsorted(keys, parent * len(names) + labels[:, depth])
    found = answers.walk(asked)[-1][places]
    return answers.levels[labels.shape[1] - 1][2][found].astype(object)


def collocations(
    docs: DataFrame, longest: int = LONGEST, least: int = LEAST, first: int = FIRST, scale: int = SCALE, within: tuple[int, int] = WITHIN,
    text: str = "text", lang: str = "lang",
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's ``first`` phrases of 2 to ``longest`` words.

    ``a`` is the phrase's count, ``l`` and ``r`` those of its parts at the cut that scores lowest, ``n``
    the language's words. Order: score, then count, both descending, then phrase in byte order.
    """
    small_batches(docs.sparkSession)
    docs = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    plan = Plan(docs, longest, least)
    boundaries, parts, held = plan.boundaries, plan.parts, plan.held
    frequent = frequent_sequences(docs, plan)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def asked() -> Iterator[tuple[int, int, int, bytes]]:
            for place, rows in _arrived(batches):
                for _, _, data in rows:
                    if (parts_of := questions(Automaton.unpack(data))) is not None:
                        for owner, share in parts_of.dealt(boundaries.value, parts):
                            yield owner, 1, place, share.pack()

        yield from _placed(asked())

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def answered() -> Iterator[tuple[int, int, int, bytes]]:
            for place, rows in _arrived(batches):
                whole, marks = Automaton([], []), []
                for kind, asker, data in rows:
                    part = Automaton.unpack(data)
                    if kind == 0:
                        whole, marks = part, [np.zeros(len(w), np.int64) for _, _, w in part.levels]
                        continue
                    yield asker, 1, place, whole.answer(part, marks).pack()
                yield place, 0, place, pickle.dumps((whole.pack(), marks))

        yield from _placed(answered())

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _arrived(batches):
            _, _, data = next(rows)
            packed, marks = pickle.loads(data)
            whole = Automaton.unpack(packed)
            answers = united_stream((Automaton.unpack(d) for _, _, d in rows), np.maximum, held)
            best: dict[str, list] = {}
            for language, *row in scored(whole, marks, answers, scale, within):
                best.setdefault(language, []).append(row)
            out = []
            for language, found in best.items():
                found.sort(key=lambda r: (-r[4], -r[1], r[0].encode()))
                out += [(language, *r) for r in found[:first]]  # no more of a place can be among the first
            columns = list(zip(*out, strict=True)) or [()] * 6
            kinds = [pa.string(), pa.string(), *[pa.int64()] * 4]
            arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, ["lang", "phrase", "a", "l", "r", "score"])

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _arrived(batches):
            for _, _, data in rows:
                whole = Automaton.unpack(data)
                if whole.levels:
                    _, label, weight = whole.levels[0]
                    arrays = [pa.array([whole.names[i].decode() for i in label.tolist()], pa.string()), pa.array(weight)]
                    yield pa.RecordBatch.from_arrays(arrays, ["lang", "n"])

    met = plan.sent(frequent.unionByName(frequent.mapInArrow(ask, PLACED)))
    back = plan.sent(met.mapInArrow(answer, PLACED))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = back.mapInArrow(score, "lang string, phrase string, a long, l long, r long, score long")
    ranked = ranked.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= first)
    sizes = frequent.mapInArrow(words, "lang string, n long").groupBy("lang").agg(F.sum("n").alias("n"))
    return ranked.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
