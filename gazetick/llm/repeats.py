"""Removal of long repeats with a run-length index.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts in a document with a smaller
id. No index over the whole corpus is built. Each window of ``LENGTH`` bytes is named by its smallest
seed hash, so equal windows have equal names wherever they stand, and neighbouring windows mostly
share one and travel together as a short string:

1. Names are counted by bucket; a name in one document only is finished. Documents learn which of
   their names are repeated.
2. Documents send the strings of repeated names to the names' buckets, equal strings once a batch.
3. In a bucket, equal strings are one: all but its first document lose it. Strings of a name that a
   later document holds in another form are indexed: the run-compressed Burrows-Wheeler transform,
   sampled at both ends of every run, and the smallest document of every interval of rows that agree in
   ``LENGTH`` bytes. Strings of a name that an earlier document holds in another form stream through the
   index, which yields their matching statistics: while a string goes on in a run it steps from last to
   first, else it jumps to the nearer end of a run of its symbol, as the samples' common bytes tell.
   Where a statistic reaches ``LENGTH`` and the interval's document is smaller, the window is marked.
4. Marked bytes go back to the documents.

The windows of a name in more than ``CROWDED`` documents are spread by their own hash, one window a
string, so no bucket holds a hot name's contexts alone. Buckets and groups of documents are sized by
the corpus. Hash collisions only cost work: every match is one of equal bytes.

Null texts and texts under ``LENGTH`` bytes lose nothing; neither does a row without an id, and it
marks nothing. Rows that repeat an id must repeat its text; they are one document. Ties need no rule.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LENGTH = 50
SEED_BYTES = 24
#: Windows of a string at most, and bytes looked at together.
STRING_WINDOWS = 32
PIECE = 1 << 17
#: Text that a bucket, and a group of documents, stands for.
BUCKET_BYTES = 1 << 24
#: Text whose strings a task gathers before it sends them.
SENT_BYTES = 1 << 22
#: Documents of a name beyond which its windows are spread.
CROWDED = 20_000
ASKED, KNOWN = 0, 1
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_HALF = np.uint64(32)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _HALF)) * _A
    return x ^ (x >> np.uint64(29))


def _names(data: np.ndarray, windows: int, length: int) -> np.ndarray:
    """Name of each window: the smallest hash of the seeds in it, mixed once more."""
    seeds = windows + length - SEED_BYTES
    words = np.lib.stride_tricks.as_strided(data[:8].view(np.uint64), shape=(seeds + SEED_BYTES - 8,), strides=(1,))
    least = np.zeros(seeds, np.uint64)
    for at in range(0, SEED_BYTES, 8):
        least = _mix((least + words[at : at + seeds]) * _B)
    wide, span = length - SEED_BYTES + 1, 1
    while span * 2 <= wide:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    rest = wide - span
    if rest:
        least = np.minimum(least[:-rest], least[rest:])
    return _mix(least)


def string_runs(text: bytes, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``start, end, name`` of runs of windows with one name, by piece and of at most ``STRING_WINDOWS``."""
    total = len(text) - length + 1
    if total <= 0:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    starts, names = [], []
    for low in range(0, total, PIECE):
        windows = min(PIECE, total - low)
        data = np.frombuffer(text[low : low + windows + length - 1] + b"\0" * 8, np.uint8)
        name = _names(data, windows, length)
        fresh = np.flatnonzero(np.append(True, name[1:] != name[:-1]))
        sizes = np.diff(np.append(fresh, windows))
        if sizes.max() > STRING_WINDOWS:
            pieces = -(-sizes // STRING_WINDOWS)
            number = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            fresh = np.repeat(fresh, pieces) + number * STRING_WINDOWS
        starts.append(fresh + low)
        names.append(name[fresh])
    start = np.concatenate(starts)
    return start, np.append(start[1:], total), np.concatenate(names)


def batch_runs(texts: list[bytes], length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``text, start, end, name`` of the runs of all texts; short texts are looked at together."""
    out: list[tuple[np.ndarray, ...]] = []
    held: list[int] = []
    size = 0

    def flush() -> None:
        sizes = np.array([len(texts[i]) for i in held])
        offsets = np.cumsum(sizes) - sizes
        total = int(sizes.sum()) - length + 1
        if total <= 0:
            return
        name = _names(np.frombuffer(b"".join([*(texts[i] for i in held), b"\0" * 8]), np.uint8), total, length)
        windows = np.maximum(sizes - length + 1, 0)
        fresh = np.append(True, name[1:] != name[:-1])
        fresh[offsets[windows > 0]] = True
        start = np.flatnonzero(fresh)
        text = np.searchsorted(offsets, start, "right") - 1
        end = np.minimum(np.append(start[1:], total), (offsets + windows)[text])
        inside = start < end
        start, end, text = start[inside], end[inside], text[inside]
        pieces = -(-(end - start) // STRING_WINDOWS)
        number = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        low = np.repeat(start, pieces) + number * STRING_WINDOWS
        high = np.minimum(low + STRING_WINDOWS, np.repeat(end, pieces))
        text = np.repeat(text, pieces)
        out.append((np.array(held)[text], low - offsets[text], high - offsets[text], name[low]))

    for i, text in enumerate(texts):
        if len(text) >= PIECE:
            start, end, name = string_runs(text, length)
            out.append((np.full(len(start), i), start, end, name))
            continue
        held.append(i)
        size += len(text)
        if size >= PIECE:
            flush()
            held, size = [], 0
    if held:
        flush()
    kinds = (np.int64, np.int64, np.int64, np.uint64)
    return tuple(np.concatenate([np.empty(0, kind), *parts]) for kind, parts in zip(kinds, list(zip(*out, strict=True)) or [()] * 4, strict=True))


def short(name: np.ndarray) -> np.ndarray:
    """The part of a name that tells it from others of its bucket, as a signed number of 32 bits."""
    return (name & np.uint64(0xFFFFFFFF)).astype(np.uint32).view(np.int32)


def _unsigned(short_name: np.ndarray) -> np.ndarray:
    return short_name.astype(np.int64) & 0xFFFFFFFF


def bucket_of(name: np.ndarray, buckets: int) -> np.ndarray:
    return ((name >> _HALF) % np.uint64(buckets)).astype(np.int64)


def group_of(ids: np.ndarray, groups: int) -> np.ndarray:
    """The group of documents an id belongs to."""
    return np.mod(ids ^ (ids >> 15), groups)


def _lists(keys: np.ndarray, ids: np.ndarray, *columns: np.ndarray) -> list[pa.Array]:
    """The distinct keys, and each column cut into one list per key, by id: such lists shrink best."""
    order = np.lexsort((ids, keys))
    keys = keys[order]
    cuts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.empty(0, np.int64)
    ends = pa.array(np.append(cuts, len(keys)), pa.int32())
    return [pa.array(keys[cuts].astype(np.int64)), *(pa.ListArray.from_arrays(ends, pa.array(c[order])) for c in (ids, *columns))]


def _values(batch: pa.RecordBatch, column: str, row: int) -> np.ndarray:
    """One row's list."""
    return batch.column(column)[row].values.to_numpy(zero_copy_only=False).astype(np.int64)


def _joined(parts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([np.empty(0, np.int64), *parts])


# --- 1. repeated names -------------------------------------------------------------------------

NAMES = "key long, kind int, ids array<long>, names array<int>, docs array<int>"


def _ask(buckets: int, length: int):
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place, _, _, name = batch_runs([(t or "").encode() for t in batch.column("text").to_pylist()], length)
            if not len(name):
                continue
            id = batch.column("id").to_numpy()[place]
            order = np.lexsort((id, name))
            id, name = id[order], name[order]
            fresh = np.append(True, (name[1:] != name[:-1]) | (id[1:] != id[:-1]))
            id, name = id[fresh], name[fresh]
            first = np.append(True, name[1:] != name[:-1])
            last = np.append(first[1:], True)
            starts = np.flatnonzero(first)
            docs = np.repeat(np.diff(np.append(starts, len(name))), np.diff(np.append(starts, len(name))))
            # The first and last document of a name stand for the batch; those between are known to repeat it.
            for kind, chosen in ((ASKED, first | last), (KNOWN, ~(first | last))):
                if chosen.any():
                    columns = _lists(bucket_of(name[chosen], buckets), id[chosen], short(name[chosen]), np.where(first, docs, 0)[chosen].astype(np.int32))
                    kinds = pa.array(np.full(len(columns[0]), kind, np.int32))
                    yield pa.record_batch([columns[0], kinds, *columns[1:]], names=["key", "kind", "ids", "names", "docs"])

    return ask


TOLD = "key long, kind int, ids array<long>, xs array<long>, ys array<long>"


def _told(key, ids, xs, ys) -> pa.RecordBatch:
    columns = _lists(key, *(x.astype(np.int64) for x in (ids, xs, ys)))
    kinds = pa.array(np.full(len(columns[0]), ASKED, np.int32))
    return pa.record_batch([columns[0], kinds, *columns[1:]], names=["key", "kind", "ids", "xs", "ys"])


def _answer(groups: int):
    """Rows sorted by bucket, asked names first: tells groups of documents their repeated names, and of the crowded ones their bucket plus one."""

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, asked, crowded = None, [], np.empty(0, np.int64)

        def close():
            ids, names, docs = (_joined(x) for x in zip(*asked, strict=True))
            order = np.lexsort((ids, names))
            ids, names, docs = ids[order], names[order], docs[order]
            starts = np.flatnonzero(np.append(True, names[1:] != names[:-1]))
            sizes = np.diff(np.append(starts, len(names)))
            repeated = np.repeat(np.minimum.reduceat(ids, starts) < np.maximum.reduceat(ids, starts), sizes)
            many = np.add.reduceat(docs, starts) > CROWDED
            tell = np.repeat(many, sizes) * (at + 1)
            return names[starts][many], _told(group_of(ids[repeated], groups), ids[repeated], names[repeated], tell[repeated])

        for batch in batches:
            for row in range(batch.num_rows):
                key, kind = batch.column("key")[row].as_py(), batch.column("kind")[row].as_py()
                ids, names, docs = (_values(batch, c, row) for c in ("ids", "names", "docs"))
                if key != at:
                    if asked:
                        yield close()[1]
                    at, asked, crowded = key, [], np.empty(0, np.int64)
                if kind == ASKED:
                    asked.append((ids, names, docs))
                    continue
                if asked:
                    crowded, told = close()
                    yield told
                    asked = []
                yield _told(group_of(ids, groups), ids, names, np.isin(names, crowded) * (at + 1))
        if asked:
            yield close()[1]

    return answer


# --- 2. strings of repeated names --------------------------------------------------------------

STRINGS = "key long, kind int, ids array<long>, xs array<long>, ys array<long>, names array<long>, sizes array<long>, bytes binary"
PACKED = "key long, kind int, ids array<long>, sizes array<long>, bytes binary"
_LONGS = pa.list_(pa.int64())


def _packed(pieces: list[bytes]) -> bytes:
    """Pieces one after the other, compressed; the shuffle's own codec sees them one by one."""
    return pa.Codec("zstd").compress(b"".join(pieces), asbytes=True)


def _unpacked(content: pa.BinaryScalar, sizes: np.ndarray) -> bytes:
    return pa.Codec("zstd").decompress(content.as_buffer(), decompressed_size=int(sizes.sum()), asbytes=True) if len(sizes) else b""


def _pieces(content: bytes, sizes: np.ndarray) -> list[bytes]:
    ends = np.cumsum(sizes)
    return [content[a:b] for a, b in zip((ends - sizes).tolist(), ends.tolist(), strict=True)]


def _pack(groups: int):
    """The documents of a batch by group, one row a group and about ``BUCKET_BYTES`` of text."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("id").to_numpy()
            group = group_of(ids, groups)
            order = np.argsort(group, kind="stable")
            out, texts, size = [], [], 0
            for n, row in enumerate(order.tolist()):
                texts.append((batch.column("text")[row].as_py() or "").encode())
                size += len(texts[-1])
                last = n + 1 == len(order) or group[order[n + 1]] != group[row]
                if last or size > BUCKET_BYTES:
                    own = ids[order[n + 1 - len(texts) : n + 1]]
                    out.append((int(group[row]), KNOWN, own, list(map(len, texts)), _packed(texts)))
                    texts, size = [], 0
            if out:
                kinds = (pa.int64(), pa.int32(), _LONGS, _LONGS, pa.binary())
                columns = [pa.array(list(c), kind) for c, kind in zip(zip(*out, strict=True), kinds, strict=True)]
                yield pa.record_batch(columns, names=["key", "kind", "ids", "sizes", "bytes"])

    return pack


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """``(ids, xs, ys)`` of the group sorted by id, and documents ``(id, bytes)`` of it, a packed row at a time; the lists of a group come first."""
    at, parts, told = None, [], None
    for batch in batches:
        keys, kinds = batch.column("key").to_numpy(), batch.column("kind").to_numpy()
        for row, (key, kind) in enumerate(zip(keys.tolist(), kinds.tolist(), strict=True)):
            if key != at:
                at, parts, told = key, [], None
            if kind == ASKED:
                parts.append([_values(batch, c, row) for c in ("ids", "xs", "ys")])
                continue
            if told is None:
                told = [_joined(x) for x in zip(*parts, strict=True)] if parts else [np.empty(0, np.int64)] * 3
                order = np.argsort(told[0], kind="stable")
                told, parts = [x[order] for x in told], []
            sizes = _values(batch, "sizes", row)
            texts = _pieces(_unpacked(batch.column("bytes")[row], sizes), sizes)
            yield told, list(zip(_values(batch, "ids", row).tolist(), texts, strict=True))


def _of(told, id: int):
    low, high = np.searchsorted(told[0], [id, id + 1])
    return told[1][low:high], told[2][low:high]


class _Told:
    """What a group of documents knows of its repeated names."""

    def __init__(self, ids: np.ndarray, names: np.ndarray, crowded: np.ndarray):
        self.ids, at = np.unique(ids, return_inverse=True)
        keys = at << 32 | _unsigned(names)
        order = np.argsort(keys, kind="stable")
        self.keys, self.crowded = keys[order], crowded[order]

    def look_up(self, ids: np.ndarray, names: np.ndarray, buckets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which names are repeated, and which of these are crowded in their own bucket.

        A short name is told from others of its bucket only; another bucket's equal one must not be spread.
        A document may hold several of a short name, a few rows that follow each other.
        """
        at = np.minimum(np.searchsorted(self.ids, ids), max(len(self.ids) - 1, 0))
        known = self.ids[at] == ids if len(self.ids) else np.zeros(len(ids), bool)
        keys = np.where(known, at, 0) << 32 | _unsigned(names)
        low, high = np.searchsorted(self.keys, keys, "left"), np.searchsorted(self.keys, keys, "right")
        found = known & (low < high)
        spread = np.zeros(len(ids), bool)
        for more in range(int((high - low)[found].max(initial=0))):
            row = np.minimum(low + more, len(self.keys) - 1)
            spread |= found & (low + more < high) & (self.crowded[row] == buckets + 1)
        return found, spread


def content_hashes(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """64-bit hashes of slices: the same for equal bytes, wherever they stand."""
    with np.errstate(over="ignore"):
        width = int(sizes.max(initial=0))
        powers = np.multiply.accumulate(np.full(max(width, 1), _A | np.uint64(1)))
        out = np.empty(len(starts), np.uint64)
        for low in range(0, len(starts), 1 << 14):
            some = slice(low, low + (1 << 14))
            ends = np.cumsum(sizes[some])
            place = np.arange(ends[-1]) - np.repeat(ends - sizes[some], sizes[some])
            byte = data[place + np.repeat(starts[some], sizes[some])].astype(np.uint64)
            mixed = (byte + np.uint64(1)) * _B
            out[some] = np.add.reduceat((mixed ^ (mixed >> _HALF)) * powers[place], ends - sizes[some])
        return _mix(out)


def _same(data: np.ndarray, a: np.ndarray, b: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether the slices at ``a`` and ``b`` hold the same bytes."""
    out = np.ones(len(a), bool)
    for low in range(0, len(a), 1 << 14):
        some = slice(low, low + (1 << 14))
        ends = np.cumsum(sizes[some])
        place = np.arange(ends[-1]) - np.repeat(ends - sizes[some], sizes[some])
        equal = data[place + np.repeat(a[some], sizes[some])] == data[place + np.repeat(b[some], sizes[some])]
        out[some] = np.logical_and.reduceat(equal, ends - sizes[some])
    return out


def _send(buckets: int, groups: int, length: int):
    """Strings of repeated names to their buckets. Equal strings of about ``SENT_BYTES`` of text go once,
    for the smallest document among them; the others are known to lose theirs."""
    most = SENT_BYTES

    def sent(told: _Told, rows: list[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
        texts = [text for _, text in rows]
        text, start, end, name = batch_runs(texts, length)
        ids = np.array([id for id, _ in rows], np.int64)[text]
        called, bucket = short(name), bucket_of(name, buckets)
        found, spread = told.look_up(ids, called, bucket)
        text, start, end, ids, spread = (x[found] for x in (text, start, end, ids, spread))
        if not len(text):
            return
        key, called = bucket[found], called[found].astype(np.int64)
        if spread.any():  # every window on its own
            times = np.where(spread, end - start, 1)
            number = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            text, ids, spread, key, called, end = (np.repeat(x, times) for x in (text, ids, spread, key, called, end))
            start = np.repeat(start, times) + number
            end = np.where(spread, start + 1, end)
        sizes = end - start + length - 1
        data = np.frombuffer(b"".join(texts) + b"\0" * 16, np.uint8)
        offsets = np.cumsum([0] + [len(t) for t in texts])[:-1]
        at = offsets[text] + start
        hashes = content_hashes(data, at, sizes)
        if spread.any():
            key = np.where(spread, bucket_of(hashes, buckets), key)
            called = np.where(spread, short(hashes).astype(np.int64), called)
        order = np.lexsort((start, ids, sizes, hashes, called, key))
        ids, start, sizes, at, key, called, hashes = (x[order] for x in (ids, start, sizes, at, key, called, hashes))
        fresh = np.ones(len(ids), bool)
        for x in (key, called, hashes, sizes):
            fresh[1:] &= x[1:] == x[:-1]
        fresh[1:] = ~fresh[1:]
        first = np.repeat(np.flatnonzero(fresh), np.diff(np.append(np.flatnonzero(fresh), len(ids))))
        # Two strings of one hash that differ both go as they are.
        equal = _same(data, at, at[first], sizes)
        lost = equal & (ids > ids[first])
        held = ~lost
        if lost.any():
            gone = pa.record_batch(_columns([(int(ids[lost][0] % buckets), KNOWN, ids[lost], start[lost], (start + sizes)[lost], [], [], b"")]), names=_NAMED)
            yield gone
        ids, start, sizes, at, key, called = (x[held] for x in (ids, start, sizes, at, key, called))
        # Strings of one name overlap, and shrink best side by side.
        words = np.lib.stride_tricks.as_strided(data[:8].view(">u8"), shape=(len(data) - 8,), strides=(1,))
        order = np.lexsort((words[at + 8].astype(np.uint64), words[at].astype(np.uint64), called, key))
        ids, start, sizes, at, key, called = (x[order] for x in (ids, start, sizes, at, key, called))
        cuts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        out = []
        for low, high in zip(cuts, np.append(cuts[1:], len(key)), strict=True):
            some = slice(low, high)
            strings = [data[a : a + n].tobytes() for a, n in zip(at[some].tolist(), sizes[some].tolist(), strict=True)]
            out.append((int(key[low]), ASKED, ids[some], start[some], [], called[some], sizes[some], _packed(strings)))
        yield pa.record_batch(_columns(out), names=_NAMED)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, known, held, size = None, None, [], 0
        for told, rows in _grouped(batches):
            if told is not group:
                if held:
                    yield from sent(known, held)
                group, known, held, size = told, _Told(*told), [], 0
            for row in rows:
                held.append(row)
                size += len(row[1])
                if size > most:
                    yield from sent(known, held)
                    held, size = [], 0
        if held:
            yield from sent(known, held)

    return send


_NAMED = ["key", "kind", "ids", "xs", "ys", "names", "sizes", "bytes"]


def _columns(rows: list[tuple]) -> list[pa.Array]:
    kinds = (pa.int64(), pa.int32(), _LONGS, _LONGS, _LONGS, _LONGS, _LONGS, pa.binary())
    return [pa.array(list(c), kind) for c, kind in zip(zip(*rows, strict=True), kinds, strict=True)]


# --- 3. the run-length index of a bucket -------------------------------------------------------


def _ranks(values: np.ndarray) -> np.ndarray:
    return np.unique(values, return_inverse=True)[1].reshape(values.shape).astype(np.uint64)


class RunIndex:
    """Run-compressed Burrows-Wheeler transform of short strings, each with its document.

    Strings end in ends of their own, which sort first and by place. ``starts`` and ``symbols`` are the
    runs; ``before`` is how often a run's symbol comes in earlier runs and ``less`` how many symbols are
    smaller. ``heads`` and ``tails`` are the places of the suffixes at the first and last row of each run.
    Rows of suffixes that agree in ``length`` bytes form an interval, sampled by its first row and its
    smallest document. The suffix order itself is not kept.
    """

    def __init__(self, strings: list[bytes], documents: np.ndarray, length: int = LENGTH):
        self.length = length
        self.text, self.sizes = _padded(strings, length)
        width = int(self.sizes.max()) + 1
        row, column = np.nonzero(np.arange(width) <= self.sizes[:, None])
        words = np.lib.stride_tricks.as_strided(self.text.reshape(-1)[:8].view(">u8"), shape=(len(strings), width), strides=(self.text.shape[1], 1))
        ranks, known = _ranks(words.astype(np.uint64)), 8
        while known < width:
            ranks, known = self._longer(ranks, known), known * 2

        order = np.lexsort((row, ranks[row, column]))
        row, column = row[order], column[order]
        last = np.where(column > 0, self.text[row, column - 1], 0)
        fresh = np.append(True, last[1:] != last[:-1])
        self.starts, self.symbols = np.flatnonzero(fresh), last[fresh].astype(np.int64)
        lengths = np.diff(np.append(self.starts, len(last)))
        self.by_symbol = np.argsort(self.symbols, kind="stable")
        before = np.empty(len(lengths), np.int64)
        sums = np.cumsum(lengths[self.by_symbol]) - lengths[self.by_symbol]
        totals = np.bincount(self.symbols, lengths, 257).astype(np.int64)
        self.less = np.cumsum(totals) - totals
        before[self.by_symbol] = sums - self.less[self.symbols[self.by_symbol]]
        self.before = before
        self.ends = self.starts + lengths - 1
        place = row * self.text.shape[1] + column
        self.heads, self.tails = place[self.starts], place[self.ends]
        self.keys = self.symbols[self.by_symbol] * len(self.symbols) + self.by_symbol

        rows = np.flatnonzero(column + length <= self.sizes[row])
        apart = np.ones(len(rows), bool)
        if len(rows) > 1:
            apart[1:] = (np.diff(rows) > 1) | (self._common(place[rows[:-1]], place[rows[1:]], np.full(len(rows) - 1, length)) < length)
        self.intervals = rows[apart]
        self.least = np.minimum.reduceat(documents[row[rows]], np.flatnonzero(apart)) if len(rows) else documents[:0]

    @staticmethod
    def _longer(ranks: np.ndarray, by: int) -> np.ndarray:
        """Ranks of pieces of twice the length from those of pieces of ``by`` bytes."""
        moved = np.zeros_like(ranks)  # behind the end every piece is the same, and sorts first with rank 0
        if by < ranks.shape[1]:
            moved[:, : ranks.shape[1] - by] = ranks[:, by:]
        return _ranks(ranks * np.uint64(int(ranks.max()) + 1) + moved)

    def _common(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many bytes, up to ``most``, the suffixes at two places have in common."""
        flat, out = self.text.reshape(-1), np.empty(len(a), np.int64)
        span = np.arange(self.length)
        for low in range(0, len(a), 1 << 14):
            some = slice(low, low + (1 << 14))
            left, right = flat[a[some, None] + span], flat[b[some, None] + span]
            differ = (left != right) | (left == 0)
            out[some] = np.where(differ.any(axis=1), differ.argmax(axis=1), self.length)
        return np.minimum(out, most)

    def smaller_matches(self, strings: list[bytes], documents: np.ndarray) -> np.ndarray:
        """For each string and window, whether an indexed string of a smaller document holds it.

        The strings stream through the index from their ends, all at once, one byte a step. A string's
        state is a row, the place of the row's suffix, and how many bytes, up to ``length``, it matches.
        """
        text, sizes = _padded(strings, self.length)
        marked = np.zeros(text.shape, bool)
        runs = len(self.symbols)
        active, left = np.flatnonzero(sizes > 0), sizes.copy()
        row, match = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
        place = np.full(len(sizes), self.heads[0])
        while len(active):
            left[active] -= 1
            symbol = text[active, left[active]].astype(np.int64)
            run = np.searchsorted(self.starts, row[active], "right") - 1
            off = np.flatnonzero(self.symbols[run] != symbol)
            if len(off):
                who, wanted = active[off], symbol[off]
                after = np.searchsorted(self.keys, wanted * runs + run[off])
                has_before, has_after = after > 0, after < runs
                earlier, later = self.by_symbol[np.maximum(after - 1, 0)], self.by_symbol[np.minimum(after, runs - 1)]
                has_before &= self.symbols[earlier] == wanted
                has_after &= self.symbols[later] == wanted
                common_before = np.where(has_before, self._common(place[who], self.tails[earlier], match[who]), -1)
                common_after = np.where(has_after, self._common(place[who], self.heads[later], match[who]), -1)
                up = common_before >= common_after
                run[off] = np.where(up, earlier, later)
                row[who] = np.where(up, self.ends[earlier], self.starts[later])
                place[who] = np.where(up, self.tails[earlier], self.heads[later])
                match[who] = np.maximum(common_before, common_after)
            here = match[active] >= 0  # else the index doesn't hold the symbol
            lost, going, run, symbol = active[~here], active[here], run[here], symbol[here]
            row[lost], match[lost], place[lost] = 0, 0, self.heads[0]
            row[going] = self.less[symbol] + self.before[run] + row[going] - self.starts[run]
            place[going] -= 1
            match[going] = np.minimum(match[going] + 1, self.length)
            full = going[match[going] == self.length]
            interval = np.searchsorted(self.intervals, row[full], "right") - 1
            marked[full, left[full]] = self.least[interval] < documents[full]
            active = active[left[active] > 0]
        return marked


def _padded(strings: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """Bytes plus one, as no UTF-8 holds 255, with zeros behind the ends; and the strings' sizes."""
    sizes = np.array(list(map(len, strings)), np.int64)
    width = int(sizes.max(initial=0)) + 1
    text = np.zeros((len(strings), width + max(length, 8)), np.uint8)
    text[:, :width][np.arange(width) < sizes[:, None]] = np.frombuffer(b"".join(strings), np.uint8) + 1
    return text, sizes


#: Strings of one index, but for a name with more of its own.
INDEXED = 4096


def bucket_losses(ids: np.ndarray, places: np.ndarray, names: np.ndarray, strings: list[bytes], length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``ids, start, end`` of the bytes lost: of each string all in all but its smallest document, and
    there the windows that a smaller document holds in another string of the name."""
    place_of = {string: i for i, string in enumerate(dict.fromkeys(strings))}
    string_of = np.array([place_of[s] for s in strings])
    distinct = list(place_of)
    name = np.empty(len(distinct), np.int64)
    name[string_of] = names
    owner = np.full(len(distinct), np.iinfo(np.int64).max)
    np.minimum.at(owner, string_of, ids)
    sizes = np.array(list(map(len, distinct)))
    whole = ids > owner[string_of]
    out = [[ids[whole]], [places[whole]], [places[whole] + sizes[string_of[whole]]]]
    # Equal windows have one name: strings of different names need no common index. Of a name only strings
    # with a later document can be matched, and only those with an earlier one can match.
    _, name_of = np.unique(name, return_inverse=True)
    by_name = np.argsort(name_of, kind="stable")
    opened = np.flatnonzero(np.append(True, np.diff(name_of[by_name]) > 0))
    least = np.minimum.reduceat(owner[by_name], opened)[name_of]
    most = np.maximum.reduceat(owner[by_name], opened)[name_of]
    by_name = by_name[(least < most)[by_name]]
    keeps = np.flatnonzero(~whole)
    keeps = keeps[np.argsort(string_of[keeps], kind="stable")]
    low = 0
    while low < len(by_name):
        high = np.searchsorted(name_of[by_name], name_of[by_name[min(low + INDEXED, len(by_name)) - 1]], "right")
        together, low = by_name[low:high], high
        earlier, later = together[owner[together] < most[together]], together[owner[together] > least[together]]
        index = RunIndex([distinct[i] for i in earlier], owner[earlier], length)
        string, window = np.nonzero(index.smaller_matches([distinct[i] for i in later], owner[later]))
        first, last = (np.searchsorted(string_of[keeps], later[string], side) for side in ("left", "right"))
        times = last - first
        entry = keeps[np.repeat(first - (np.cumsum(times) - times), times) + np.arange(times.sum())]
        out[0].append(ids[entry])
        out[1].append(places[entry] + np.repeat(window, times))
        out[2].append(places[entry] + np.repeat(window, times) + length)
    return tuple(_joined(x) for x in out)


def _merged(ids: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges of each id joined where they touch or overlap."""
    order = np.lexsort((low, ids))
    ids, low, high = ids[order], low[order], high[order]
    if not len(ids):
        return ids, low, high
    # Shift each id's ranges behind all earlier ones, so that one running maximum serves them all.
    span = int(high.max()) + 2
    number = np.cumsum(np.append(False, ids[1:] != ids[:-1])) * span
    reach = np.maximum.accumulate(high + number)
    fresh = np.append(True, low[1:] + number[1:] > reach[:-1])
    starts = np.flatnonzero(fresh)
    return ids[starts], low[starts], np.append(reach[starts[1:] - 1], reach[-1]) - number[starts]


def _solve(groups: int, length: int):
    """Rows sorted by bucket: byte ranges that documents lose, to their groups."""

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, parts = None, []

        def close():
            ids, places, names, sizes, contents = zip(*parts, strict=True)
            strings = [string for one, content in zip(sizes, contents, strict=True) for string in _pieces(content, one)]
            some, low, high = _merged(*bucket_losses(_joined(ids), _joined(places), _joined(names), strings, length))
            return _told(group_of(some, groups), some, low, high)

        for batch in batches:
            for row in range(batch.num_rows):
                key = batch.column("key")[row].as_py()
                ids, xs, ys, sizes, names = (_values(batch, c, row) for c in ("ids", "xs", "ys", "sizes", "names"))
                if key != at:
                    if parts:
                        yield close()
                    at, parts = key, []
                if batch.column("kind")[row].as_py() == ASKED:
                    parts.append((ids, xs, names, sizes, _unpacked(batch.column("bytes")[row], sizes)))
                else:
                    ids, xs, ys = _merged(ids, xs, ys)
                    yield _told(group_of(ids, groups), ids, xs, ys)
        if parts:
            yield close()

    return solve


# --- 4. back to the documents ------------------------------------------------------------------

KEPT = "id long, n_bytes long, removed array<struct<start:long,end:long>>, kept binary"
_RANGES = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for told, rows in _grouped(batches):
        out = []
        for id, text in rows:
            low, high = _of(told, id)
            _, low, high = _merged(np.zeros(len(low), np.int64), low, high)
            edges = [0, *np.stack([low, high], axis=1).reshape(-1).tolist(), len(text)]
            kept = b"".join([text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)])
            out.append((id, len(text), [{"start": a, "end": b} for a, b in zip(low.tolist(), high.tolist(), strict=True)], kept))
        kinds = (pa.int64(), pa.int64(), _RANGES, pa.binary())
        columns = [pa.array(list(c), kind) for c, kind in zip(zip(*out, strict=True), kinds, strict=True)]
        yield pa.record_batch(columns, names=["id", "n_bytes", "removed", "kept"])


def remove_repeats(docs: DataFrame, id: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """``id, n_bytes, removed, kept``: the byte ranges each document loses, and the bytes it keeps."""
    if length < SEED_BYTES + 1:
        raise ValueError(f"matches under {SEED_BYTES + 1} bytes aren't supported")
    every = docs.select(F.col(id).cast("bigint").alias("id"), F.col(text).alias("text"))
    named = every.filter("id is not null")
    size = named.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    buckets = groups = max(7, size // BUCKET_BYTES) | 1

    sent = named.mapInArrow(_ask(buckets, length), NAMES)
    told = _by_key(sent).mapInArrow(_answer(groups), TOLD)
    rows = named.mapInArrow(_pack(groups), PACKED)
    strings = _by_key(told.unionByName(rows, allowMissingColumns=True)).mapInArrow(_send(buckets, groups, length), STRINGS)
    losses = _by_key(strings).mapInArrow(_solve(groups, length), TOLD)
    cut = _by_key(losses.unionByName(rows, allowMissingColumns=True)).mapInArrow(_cut, KEPT)
    nameless = every.filter("id is null").select(
        "id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"),
        F.array().cast("array<struct<start:long,end:long>>").alias("removed"), F.coalesce(F.encode("text", "UTF-8"), F.lit(b"")).alias("kept"),
    )
    return cut.unionByName(nameless)


def _by_key(rows: DataFrame) -> DataFrame:
    return rows.repartition("key").sortWithinPartitions("key", "kind")
