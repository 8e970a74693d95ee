"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

The texts of a batch become one flat array of symbols. It is cut into words wherever no piece of the
vocabulary holds the two characters on either side of the cut: no merge can cross such a place, so
words are independent, and equal words are encoded once. Each round takes every word's least pair
rank, by a segmented minimum, and merges the leftmost pairs of that rank in all words at once; merged
symbols are compacted away, and words without a pair leave.

Merging one pair at a time would go back to a word's start whenever a merge makes a new pair of the
same or a better rank. So each merge's new pairs are looked up beforehand, and a word's merges of a
round end with the first that makes such a pair. Pieces come out as in the public library.

A word of n symbols takes at most n rounds over what is left of it; a word is as long as the texts
make it, texts beyond ``CHUNK`` characters are encoded in parts that end at a cut.

Nulls and empty texts have no ids; no ids decode to the empty text. Characters without a piece are
spelled by byte pieces, or are the unknown piece where the model has none. A null in a list of ids is
refused, as is an id outside of the model. Rows are independent: ties, repeated rows and empty tables
need no rule, and other columns pass through.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gazetick.llm.common import small_batches

#: Characters that are encoded together; what a worker holds grows with it and with the longest word.
CHUNK = 1 << 20
BLANK = "▁"
#: Kinds of pieces and of models in a model file.
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
BPE = 2
NEVER = np.iinfo(np.int32).max


def fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Numbers and values of a protocol buffer's fields; nested messages stay bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(message):
        number, wire = divmod(varint(), 8)
        if wire == 0:
            yield number, varint()
            continue
        size = varint() if wire == 2 else {1: 8, 5: 4}[wire]
        yield number, message[at : at + size]
        at += size


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions of all slices ``starts[i] : starts[i] + lengths[i]``, one after another."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


class Pieces:
    """A model's tables: symbols of characters, pairs that merge, characters that pieces hold side by side."""

    def __init__(self, content: bytes):
        pieces, kinds, scores = [], [], []
        trainer, normalizer = {}, {}
        for number, value in fields(content):
            if number == 1:
                piece = dict(fields(value))
                pieces.append(piece.get(1, b"").decode())
                scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
                kinds.append(piece.get(3, NORMAL))
            elif number == 2:
                trainer = dict(fields(value))
            elif number == 3:
                normalizer = dict(fields(value))
        if trainer.get(3, 1) != BPE or trainer.get(24, 0) or not set(kinds) <= {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("only BPE models of plain, byte and control pieces with blanks in front are supported")
        if normalizer.get(2) or normalizer.get(4, 1) or not normalizer.get(5, 1):
            raise ValueError("only models that leave texts as they are, but for blanks, are supported")
        self.prefix = BLANK if normalizer.get(3, 1) else ""
        self.kinds = np.array(kinds)
        self.unknown = kinds.index(UNKNOWN)
        surface = trainer.get(44, " ⁇ ".encode()).decode()
        of_byte = {p: i for i, p in enumerate(pieces) if kinds[i] == BYTE}
        self.byte_ids = [of_byte[f"<0x{b:02X}>"] for b in range(256)] if trainer.get(35) else None
        self._decoding(pieces, surface)

        known = {p: i for i, p in enumerate(pieces) if kinds[i] == NORMAL}
        letters = sorted({c for p in known for c in p})
        symbols = dict(known)
        for c in letters:
            symbols.setdefault(c, len(pieces) + len(symbols) - len(known))
        self.plain, self.size = len(pieces), len(pieces) + len(symbols) - len(known)
        codes = [ord(c) for c in letters]
        #: Every other character is a symbol of its own that merges with nothing.
        self.symbol = np.arange(self.size, self.size + 0x110000, dtype=np.int32)
        self.symbol[codes] = [symbols[c] for c in letters]
        self.letter_of = np.zeros(self.size, np.int64)
        self.letter_of[[symbols[c] for c in letters]] = codes
        self.letter = np.zeros(0x110000, np.int32)
        self.letter[codes] = np.arange(1, len(letters) + 1)
        self.beside = np.zeros((len(letters) + 1, len(letters) + 1), bool)

        order = -np.unique([-scores[i] for i in known.values()], return_inverse=True)[1]
        rank = dict(zip(known, (-order).tolist(), strict=True))
        pairs = []
        for p, i in known.items():
            row = self.letter[[ord(c) for c in p]]
            self.beside[row[:-1], row[1:]] = True
            for cut in range(1, len(p)):
                left, right = symbols.get(p[:cut]), symbols.get(p[cut:])
                if left is not None and right is not None:
                    pairs.append((left * self.size + right, i, rank[p]))
        self._hash(np.array(pairs, np.int64).reshape(-1, 3))

    def _hash(self, pairs: np.ndarray) -> None:
        """A table with four to eight slots a pair; a pair whose slot is taken goes to the next free one."""
        self.bits = max(4, int(4 * len(pairs)).bit_length())
        slots = 1 << self.bits
        self.pairs, self.merged, self.ranks = np.full(slots, -1), np.zeros(slots, np.int32), np.full(slots, NEVER, np.int32)
        keys, slot = pairs[:, 0], self._slot(pairs[:, 0])
        while len(keys):
            free = np.flatnonzero(self.pairs[slot] == -1)
            take = free[np.unique(slot[free], return_index=True)[1]]
            self.pairs[slot[take]], self.merged[slot[take]], self.ranks[slot[take]] = pairs[take].T
            left = np.ones(len(keys), bool)
            left[take] = False
            pairs, keys, slot = pairs[left], keys[left], (slot[left] + 1) % slots

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _decoding(self, pieces: list[str], surface: str) -> None:
        shown = []
        for i, p in enumerate(pieces):
            kind = self.kinds[i]
            as_bytes = bytes([int(p[3:5], 16)]) if kind == BYTE else p.replace(BLANK, " ").encode()
            shown.append(b"" if kind == CONTROL else surface.encode() if kind == UNKNOWN else as_bytes)
        self.lengths = np.array([len(s) for s in shown])
        self.offsets = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(shown), np.uint8)
        self.opens = np.array([k == NORMAL and p.startswith(BLANK) for p, k in zip(pieces, self.kinds, strict=True)])

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranks of pairs, ``NEVER`` if they don't merge, and what they merge into."""
        keys = np.where((left < self.size) & (right < self.size), left.astype(np.int64) * self.size + right, -2)
        at = self._slot(keys)
        open_ = np.flatnonzero((self.pairs[at] != keys) & (self.pairs[at] != -1))
        while len(open_):
            at[open_] = (at[open_] + 1) % len(self.pairs)
            open_ = open_[(self.pairs[at[open_]] != keys[open_]) & (self.pairs[at[open_]] != -1)]
        return self.ranks[at], self.merged[at]

    def cuts(self, codes: np.ndarray) -> np.ndarray:
        """Whether no piece holds a character next to the one before it; true for the first."""
        row = self.letter[codes]
        return np.concatenate([[True], ~self.beside[row[:-1], row[1:]]])

    def merge(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of all words, flat, when no pair is left, and the words' lengths then."""
        word = np.repeat(np.arange(len(lengths)), lengths)
        last = np.append(word[1:] != word[:-1], True)[: len(word)]
        rank = np.full(len(word), NEVER, np.int32)
        into = np.zeros(len(word), np.int32)
        inner = np.flatnonzero(~last)
        rank[inner], into[inner] = self.look_up(symbols[inner], symbols[inner + 1])
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(word):
            starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            sizes = np.diff(np.append(starts, len(word)))
            least = np.repeat(np.minimum.reduceat(rank, starts), sizes)
            settled = least == NEVER
            if settled.any():
                done.append((word[settled], symbols[settled]))
                stay = ~settled
                word, symbols, rank, into, least = word[stay], symbols[stay], rank[stay], into[stay], least[stay]
                if not len(word):
                    break
            # Of a run of overlapping pairs every second one is merged, from the left.
            at = np.flatnonzero(rank == least)
            first = np.append(True, at[1:] != at[:-1] + 1)
            run = np.repeat(np.flatnonzero(first), np.diff(np.append(np.flatnonzero(first), len(at))))
            at = at[(np.arange(len(at)) - run) % 2 == 0]
            at = self._until_better(at, word, symbols, into, least)
            symbols[at] = into[at]
            stay = np.ones(len(word), bool)
            stay[at + 1] = False
            word, symbols, rank, into = word[stay], symbols[stay], rank[stay], into[stay]
            at = at - np.arange(len(at))
            touched = np.zeros(len(word), bool)
            touched[at], touched[at[at > 0] - 1] = True, True
            self._renew(np.flatnonzero(touched), word, symbols, rank, into)
        if not done:
            return symbols, lengths
        words, flat = (np.concatenate(parts) for parts in zip(*done, strict=True))
        return flat[np.argsort(words, kind="stable")], np.bincount(words, minlength=len(lengths))

    def _until_better(self, at, word, symbols, into, least):
        """``at`` without the merges that stand behind one whose new pairs rank no worse."""
        end = len(word)
        # The symbol to the left may be the round's previous merge; those to the right aren't merged yet.
        joined = np.append(False, at[1:] == at[:-1] + 2)
        before = np.where(joined, into[np.roll(at, 1)], symbols[np.maximum(at - 1, 0)])
        has_before = (at > 0) & (word[np.maximum(at - 1, 0)] == word[at])
        after = np.minimum(at + 2, end - 1)
        has_after = (at + 2 < end) & (word[after] == word[at])
        left, _ = self.look_up(before, into[at])
        right, _ = self.look_up(into[at], symbols[after])
        better = (has_before & (left <= least[at])) | (has_after & (right <= least[at]))
        if not better.any():
            return at
        starts = np.flatnonzero(np.append(True, word[at[1:]] != word[at[:-1]]))
        limit = np.minimum.reduceat(np.where(better, at, end), starts)
        return at[at <= np.repeat(limit, np.diff(np.append(starts, len(at))))]

    def _renew(self, at, word, symbols, rank, into):
        """Look up the pairs that begin at ``at`` anew."""
        after = np.minimum(at + 1, len(word) - 1)
        found, merged = self.look_up(symbols[at], symbols[after])
        inside = (at + 1 < len(word)) & (word[after] == word[at])
        rank[at], into[at] = np.where(inside, found, NEVER), merged

    def encode_codes(self, codes: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts that lie one after another in ``codes``, and each text's number of ids."""
        if not len(codes):
            return np.empty(0, np.int32), np.zeros(len(begins), np.int64)
        cut = self.cuts(codes)
        cut[begins[begins < len(codes)]] = True
        starts = np.flatnonzero(cut)
        lengths = np.diff(np.append(starts, len(codes)))
        symbols = self.symbol[codes]
        kind = distinct_spans(symbols, starts, lengths)
        some = np.unique(kind, return_index=True)[1]
        merged, sizes = self.merge(symbols[ragged(starts[some], lengths[some])], lengths[some])
        ids, sizes = self._spell(merged, sizes)
        offsets = np.cumsum(sizes) - sizes
        flat = ids[ragged(offsets[kind], sizes[kind])]
        ends = np.concatenate([[0], np.cumsum(sizes[kind])])
        bounds = ends[np.searchsorted(starts, np.append(begins, len(codes)))]
        return flat, np.diff(bounds)

    def _spell(self, symbols: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of symbols; those that are no piece by the bytes of their character."""
        odd = symbols >= self.plain
        if not odd.any():
            return symbols.astype(np.int32), sizes
        others, which = np.unique(symbols[odd], return_inverse=True)
        if self.byte_ids is None:
            spelled = [[self.unknown]] * len(others)
        else:
            codes = [int(s) - self.size if s >= self.size else int(self.letter_of[s]) for s in others]
            spelled = [[self.byte_ids[b] for b in chr(c).encode()] for c in codes]
        counts = np.ones(len(symbols), np.int64)
        counts[odd] = np.array([len(s) for s in spelled])[which]
        table = np.concatenate([np.concatenate(spelled), symbols[~odd]])
        of_others = np.cumsum([0] + [len(s) for s in spelled])
        begin = np.empty(len(symbols), np.int64)
        begin[odd] = of_others[which]
        begin[~odd] = of_others[-1] + np.arange(len(symbols) - len(which))
        word_ends = np.concatenate([[0], np.cumsum(counts)])[np.cumsum(sizes)]
        return table[ragged(begin, counts)].astype(np.int32), np.diff(word_ends, prepend=0)

    def parts(self, text: str, chunk: int = CHUNK) -> Iterator[str]:
        """The text with its blanks marked, in parts of about ``chunk`` characters that end at a cut."""
        text = (self.prefix + text).replace(" ", BLANK) if text else ""
        low = 0
        while len(text) - low > chunk:
            high, reach = low + chunk, 64
            while True:
                found = np.flatnonzero(self.cuts(code_points(text[high - 1 : high + reach]))[1:])
                if len(found) or high + reach >= len(text):
                    break
                reach *= 2
            if not len(found):
                break
            yield text[low : high + int(found[0])]
            low = high + int(found[0])
        yield text[low:]

    def encode(self, texts: Sequence[str | None], chunk: int = CHUNK) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, flat, and the offsets of the texts."""
        flat, counts = [], np.zeros(len(texts), np.int64)
        held, owners, size = [], [], 0

        def flush() -> None:
            begins = np.cumsum([0] + [len(p) for p in held])[:-1]
            ids, found = self.encode_codes(code_points("".join(held)), begins)
            flat.append(ids)
            np.add.at(counts, owners, found)

        for row, text in enumerate(texts):
            for part in self.parts(text or "", chunk):
                held.append(part)
                owners.append(row)
                size += len(part)
                if size >= chunk:
                    flush()
                    held, owners, size = [], [], 0
        if held:
            flush()
        return np.concatenate(flat) if flat else np.empty(0, np.int32), np.concatenate([[0], np.cumsum(counts)])

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        """Texts of rows of ids; bytes that are no character become U+FFFD, one each."""
        ids = ids.astype(np.int64)
        if len(ids) and not (0 <= ids.min() and ids.max() < len(self.kinds)):
            raise ValueError("an id is not in the model")
        begin, lengths = self.offsets[ids], self.lengths[ids]
        if self.prefix:
            # The first piece that shows at all gives up the blank in front of the text.
            shown = np.flatnonzero(self.kinds[ids] != CONTROL)
            first = np.searchsorted(shown, offsets[:-1])
            lead = shown[np.minimum(first, len(shown) - 1)] if len(shown) else np.zeros(len(first), np.int64)
            lead = lead[(first < len(shown)) & (lead < offsets[1:]) & (lead >= offsets[:-1])]
            lead = lead[self.opens[ids[lead]]]
            begin[lead] += 1
            lengths[lead] -= 1
        data = self.bytes[ragged(begin, lengths)].tobytes()
        ends = np.concatenate([[0], np.cumsum(lengths)])[offsets]
        texts = []
        # A control piece shows nothing, but bytes on either side of it aren't one character.
        broken = np.diff(np.concatenate([[0], np.cumsum(self.kinds[ids] == CONTROL)])[offsets]) > 0
        for row, (a, b) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)):
            try:
                texts.append(data[a:b].decode("utf-8" if not broken[row] else "ascii"))
            except UnicodeDecodeError:
                span = slice(offsets[row], offsets[row + 1])
                texts.append(self._decode_runs(ids[span], begin[span], lengths[span]))
        return texts

    def _decode_runs(self, ids, begin, lengths) -> str:
        out, run = [], bytearray()

        def flush() -> None:
            while run:
                for size in (4, 3, 2, 1):
                    try:
                        out.append(bytes(run[:size]).decode() if len(run) >= size and len(bytes(run[:size]).decode()) == 1 else "")
                    except UnicodeDecodeError:
                        continue
                    if out[-1]:
                        del run[:size]
                        break
                else:
                    out.append("�")
                    del run[:1]

        for i, a, n in zip(ids.tolist(), begin.tolist(), lengths.tolist(), strict=True):
            shown = self.bytes[a : a + n].tobytes()
            if self.kinds[i] == BYTE:
                run += shown
            else:
                flush()
                out.append(shown.decode())
        flush()
        return "".join(out)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def distinct_spans(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A number for each slice of ``values``, equal where the slices are.

    Slices are told apart by a polynomial hash; slices of one hash are compared with each other, and if
    two differ, every slice gets a number of its own.
    """
    with np.errstate(over="ignore"):
        base = np.uint64(0x9E3779B97F4A7C15)
        place = np.arange(len(values)) - np.repeat(starts, lengths)
        powers = np.multiply.accumulate(np.full(int(lengths.max(initial=1)), base, np.uint64))
        mixed = (values.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
        mixed ^= mixed >> np.uint64(29)
        hashes = np.add.reduceat(mixed * powers[place], starts) if len(starts) else np.empty(0, np.uint64)
    _, some, kind = np.unique(hashes, return_index=True, return_inverse=True)
    like = some[kind]
    if (lengths[like] != lengths).any() or (values[ragged(starts[like], lengths)] != values[ragged(starts, lengths)]).any():
        return np.arange(len(starts))
    return kind


class PieceTokenizer:
    """Column functions for one model file, which the driver reads and broadcasts (about 1 MB, fixed)."""

    def __init__(self, spark: SparkSession, path: str):
        small_batches(spark)
        with open(path, "rb") as file:
            self.content: Broadcast = spark.sparkContext.broadcast(file.read())

    def encode(self, text: Column | str) -> Column:
        """``array<int>``: the ids of the whole text, without begin and end."""
        content = self.content

        @F.arrow_udf("array<int>")
        def piece_encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            pieces = Pieces(content.value)
            for texts in batches:
                ids, offsets = pieces.encode(texts.to_pylist())
                yield pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))

        return piece_encode(text)

    def decode(self, ids: Column | str) -> Column:
        """``string``: the text of the ids; a null list is empty."""
        content = self.content

        @F.arrow_udf("string")
        def piece_decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            pieces = Pieces(content.value)
            for rows in batches:
                flat = rows.flatten()
                if flat.null_count:
                    raise ValueError("a list of ids holds a null")
                lengths = rows.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                yield pa.array(pieces.decode(flat.to_numpy(), np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)), pa.string())

        return piece_decode(ids)


def encode_pieces(docs: DataFrame, tokenizer: PieceTokenizer, text: str = "text", out: str = "ids") -> DataFrame:
    """``docs`` with the ids of its texts; a column of that name is replaced."""
    return docs.withColumn(out, tokenizer.encode(text))


def decode_pieces(docs: DataFrame, tokenizer: PieceTokenizer, ids: str = "ids", out: str = "decoded") -> DataFrame:
    return docs.withColumn(out, tokenizer.decode(ids))
