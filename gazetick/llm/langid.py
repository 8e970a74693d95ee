"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary. A word's probability
in a language is the sum over all its segmentations into pieces, by a forward algorithm; a text's is
the product over its words. Piece probabilities are learned by expectation maximisation: expected
piece counts over all segmentations of the training words, from forward and backward sums.

Training reads a bounded, documented sample: per language the ``PER_LANGUAGE`` labelled documents
with the smallest hash of the id. All the rest covers all rows and whole texts.

A null text, one without a letter, and any text if nothing was learned are ``und`` with score 0.
The score is the posterior under equal priors. Ties go to the language that is first by code point.
Labels that are null are not learned from. Repeated rows count as often as they come.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gazetick.llm.common import fresh, small_batches
from gazetick.session import stage

UNKNOWN = "und"
PER_LANGUAGE = 500
ROUNDS = 3
#: Added to every expected count, so that no piece is impossible.
SMOOTHING = 0.05
MARK = "▁"  # the vocabulary's sign for the start of a word
SMALL = 1e-150
#: Prefixes whose sums a task keeps, and the longest word it keeps.
KEPT_PREFIXES, KEPT_LENGTH = 1_200_000, 48
#: Words of a text looked up together, and characters of texts whose words are learned together.
PART_WORDS, PREPARED = 100_000, 2_000_000


LETTERS = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    """Runs of letters in lower case: what tells languages apart."""
    return LETTERS.findall(text.lower())


def read_pieces(path: str) -> tuple[list[str], list[str]]:
    """The vocabulary's pieces, and its 256 byte pieces in the order of the bytes."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    of_bytes = {model.id_to_piece(i) for i in ids if model.is_byte(i)}
    plain = [model.id_to_piece(i) for i in ids if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
    return plain, [f"<0x{b:02X}>" for b in range(256) if f"<0x{b:02X}>" in of_bytes]


def steps(word: str, known: dict, longest: int) -> list[list[tuple[int, tuple]]]:
    """For each end in ``word`` the starts of its pieces with the pieces' entries.

    A character that is no piece is spelled by byte pieces, as one step.
    """
    out: list[list] = [[]]
    for end in range(1, len(word) + 1):
        here = []
        for start in range(max(0, end - longest), end):
            if (entry := known.get(word[start:end])) is not None:
                here.append((start, entry))
        if not here or here[-1][0] != end - 1:
            here.append((end - 1, tuple(f"<0x{b:02X}>" for b in word[end - 1].encode("utf-8", "replace"))))
        out.append(here)
    return out


class Model:
    """Piece probabilities of the learned languages; plain data, bounded by pieces x languages."""

    def __init__(self, languages: list[str], probabilities: np.ndarray, pieces: list[str]):
        self.languages, self.pieces = languages, pieces
        self.probabilities = probabilities  # languages x pieces
        self.longest = max(map(len, pieces), default=1)

    def share(self, spark: SparkSession) -> Broadcast:
        """Broadcast as plain data, which a worker reads without this package; a few MB a language at most."""
        return spark.sparkContext.broadcast((self.languages, self.probabilities, self.pieces))

    def table(self) -> dict[str, tuple[float, ...]]:
        return dict(zip(self.pieces, map(tuple, self.probabilities.T.tolist()), strict=True))


def spelled(entry: tuple, known: dict) -> tuple[float, ...]:
    """Probability of a step: of one piece, or of a character's byte pieces together."""
    if isinstance(entry[0], str):
        return tuple(math.prod(p) for p in zip(*(known[b] for b in entry), strict=True))
    return entry


def word_scores(word: str, known: dict, longest: int, languages: int) -> list[float]:
    """Log probability of the word in each language, summed over all segmentations."""
    sums = [(1.0,) * languages]
    shift = 0.0
    for end, here in enumerate(steps(MARK + word, known, longest)):
        if not end:
            continue
        total = [0.0] * languages
        for start, entry in here:
            total = [t + s * p for t, s, p in zip(total, sums[start], spelled(entry, known), strict=True)]
        if max(total) < SMALL:  # scale all sums that later steps can reach
            total = [t / SMALL for t in total]
            reach = max(0, len(sums) - longest)
            sums[reach:] = [tuple(s / SMALL for s in x) for x in sums[reach:]]
            shift += math.log(SMALL)
        sums.append(tuple(total))
    return [math.log(s) + shift if s > 0 else -1e6 * len(word) for s in sums[-1]]


class Scorer:
    """Scores texts by a table of word prefixes.

    The forward sum of a prefix needs the sums of shorter prefixes only, so words that begin alike
    share them. New prefixes of one length are summed over together, one row a prefix.
    """

    def __init__(self, model: Model):
        self.languages, self.longest = model.languages, model.longest
        self.known = model.table()
        # A row for each piece, and a last one of zeros for what is no piece.
        self.piece = {piece: i for i, piece in enumerate(model.pieces)}
        self.rows_of = np.vstack([model.probabilities.T, np.zeros((1, len(model.languages)))])
        self.clear()

    def clear(self):
        # The empty prefix stands behind the word's mark. A sum is its row times SMALL ** steps.
        self.place: dict[str, int] = {"": 0}
        self.sums = np.empty((4096, len(self.languages)))
        self.sums[0] = self.known.get(MARK, (0.0,) * len(self.languages))
        self.parent, self.steps = np.zeros(4096, np.int64), np.zeros(4096)

    def _room(self, more: int) -> None:
        while len(self.place) + more > len(self.sums):
            self.sums = np.concatenate([self.sums, np.empty_like(self.sums)])
            self.parent = np.concatenate([self.parent, np.zeros_like(self.parent)])
            self.steps = np.concatenate([self.steps, np.zeros_like(self.steps)])

    def learn(self, words: set[str]) -> None:
        place, by_size, fresh = self.place, {}, set()
        for word in words:
            for size in range(len(word), 0, -1):
                prefix = word[:size]
                if prefix in place or prefix in fresh:
                    break
                fresh.add(prefix)
        for prefix in fresh:
            by_size.setdefault(len(prefix), []).append(prefix)
        self._room(len(fresh))
        for size in sorted(by_size):
            self._sum(size, by_size[size])

    def _sum(self, size: int, prefixes: list[str]) -> None:
        none, get = len(self.rows_of) - 1, self.piece.get
        parents = np.array([self.place[p[:-1]] for p in prefixes])
        base = self.steps[parents]
        total, before = np.zeros((len(prefixes), len(self.languages))), parents
        for length in range(1, min(size, self.longest) + 1):
            ids = np.array([get(p[-length:], none) for p in prefixes])
            hit = np.flatnonzero(ids != none)
            step = self.rows_of[ids[hit]]
            if length == 1 and len(hit) < len(prefixes):
                spelt = {p[-1] for p in prefixes if p[-1] not in self.piece}
                spelt = {c: spelled(tuple(f"<0x{b:02X}>" for b in c.encode("utf-8", "replace")), self.known) for c in spelt}
                hit, step = slice(None), np.array([spelt.get(p[-1]) or self.rows_of[i] for p, i in zip(prefixes, ids, strict=True)])
            shift = SMALL ** (self.steps[before[hit]] - base[hit])
            total[hit] += self.sums[before[hit]] * step * shift[:, None]
            before = self.parent[before]
        if size < self.longest:  # pieces that hold the mark, from before it
            ids = np.array([get(MARK + p, none) for p in prefixes])
            total += self.rows_of[ids] * (SMALL**-base)[:, None]
        small = (total.max(axis=1) < SMALL) & (total.max(axis=1) > 0)
        total[small] /= SMALL
        at = len(self.place)
        self.sums[at : at + len(prefixes)], self.parent[at : at + len(prefixes)] = total, parents
        self.steps[at : at + len(prefixes)] = base + small
        self.place.update(zip(prefixes, range(at, at + len(prefixes)), strict=True))

    def word_logs(self, places: list[int]) -> np.ndarray:
        """Log probabilities of words that were learned (words x languages)."""
        with np.errstate(divide="ignore"):
            logs = np.log(self.sums[places]) + (self.steps[places] * math.log(SMALL))[:, None]
        return np.maximum(logs, -1e6)

    def score(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """Language and posterior of each text."""
        split = [words_of(t) if t is not None and self.languages and any(map(str.isalpha, t)) else None for t in texts]
        found = []
        for words in split:
            if words is None:
                found.append((UNKNOWN, 0.0))
                continue
            total = np.zeros(len(self.languages))
            for low in range(0, len(words), PART_WORDS):
                part = words[low : low + PART_WORDS]
                fresh = set(part).difference(self.place)
                long = [w for w in fresh if len(w) > KEPT_LENGTH]
                if long:
                    fresh.difference_update(long)
                    for word in part:
                        if len(word) > KEPT_LENGTH:
                            total += word_scores(word, self.known, self.longest, len(total))
                    part = [w for w in part if len(w) <= KEPT_LENGTH]
                if fresh:
                    if len(self.place) > KEPT_PREFIXES:
                        self.clear()
                        fresh = set(part)
                    self.learn(fresh)
                total += self.word_logs([self.place[w] for w in part]).sum(axis=0)
            best = int(total.argmax())
            found.append((self.languages[best], float(1 / np.exp(total - total[best]).sum())))
        return found

    def __call__(self, text: str | None) -> tuple[str, float]:
        return self.score([text])[0]

    def prepare(self, texts: list[str | None]) -> None:
        """Learn the new words of several texts at once, which is quicker than text by text."""
        if len(self.place) > KEPT_PREFIXES:
            self.clear()
        fresh = {w for t in texts if t is not None and self.languages for w in words_of(t)}.difference(self.place)
        self.learn({w for w in fresh if len(w) <= KEPT_LENGTH})


def expected_counts(word: str, known: dict, longest: int) -> dict:
    """Expected number of each piece over all segmentations; ``known``: piece -> (probability,)."""
    word = MARK + word
    ways = steps(word, known, longest)
    n = len(word)
    costs = [[(start, entry, spelled(entry, known)[0]) for start, entry in here] for here in ways]
    forward = [1.0] + [0.0] * n
    for end in range(1, n + 1):
        forward[end] = sum(forward[start] * p for start, _, p in costs[end])
    backward = [0.0] * n + [1.0]
    for end in range(n, 0, -1):
        for start, _, p in costs[end]:
            backward[start] += p * backward[end]
    counts: dict = {}
    if not forward[n] > 0:
        return counts
    for end in range(1, n + 1):
        for start, entry, p in costs[end]:
            share = forward[start] * p * backward[end] / forward[n]
            for piece in entry if isinstance(entry[0], str) else (word[start:end],):
                counts[piece] = counts.get(piece, 0.0) + share
    return counts


#: Characters of a training word that are learned from together; longer ones are learned in parts,
#: which keeps the sums within a double's range. Scoring has no such cut.
LEARNED_TOGETHER = 40


def training_words(labelled: DataFrame, id: str, text: str, lang: str, per_language: int) -> DataFrame:
    """``lang, word, n`` over the sample. At most ``per_language`` ids a language are broadcast."""
    ids = labelled.select(id, F.col(lang).alias("_lang"), F.xxhash64(id).alias("_hash")).filter("_lang is not null")
    # First the best of each of 64 parts of a language, then of these: no task sees a whole language.
    for scope in (["_lang", F.pmod("_hash", F.lit(64))], ["_lang"]):
        picked = Window.partitionBy(*scope).orderBy("_hash", id)
        ids = ids.withColumn("_rank", F.row_number().over(picked)).filter(F.col("_rank") <= per_language)
    ids = ids.select(id).distinct()
    sample = labelled.join(F.broadcast(ids), id).filter(F.col(lang).isNotNull())
    words = sample.select(F.col(lang).alias("lang"), F.explode(F.regexp_extract_all(F.lower(text), F.lit(r"\p{L}+"), F.lit(0))).alias("word"))
    return words.groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n"))


def train(
    labelled: DataFrame, vocabulary: str, id: str = "doc_id", text: str = "text", lang: str = "lang",
    per_language: int = PER_LANGUAGE, rounds: int = ROUNDS,
) -> Model:
    """Fit the piece probabilities. Counts per language and piece come back to the driver: a table bounded by the vocabulary."""
    spark = labelled.sparkSession
    plain, of_bytes = read_pieces(vocabulary)
    pieces = plain + of_bytes
    words = stage(training_words(labelled, id, text, lang, per_language))
    languages = sorted((r.lang for r in words.select("lang").distinct().collect()), key=lambda x: x.encode())
    model = Model(languages, np.full((len(languages), len(pieces)), 1 / len(pieces)), pieces)
    if not languages:
        return model
    column = {piece: i for i, piece in enumerate(pieces)}
    for _ in range(rounds):
        sent = model.share(spark)

        def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            model = Model(*sent.value)
            known = {lang: {p: (x,) for p, x in zip(model.pieces, row.tolist(), strict=True)} for lang, row in zip(model.languages, model.probabilities, strict=True)}
            total: dict = {}
            for batch in batches:
                for lang, word, n in zip(*(batch.column(c).to_pylist() for c in ("lang", "word", "n")), strict=True):
                    for at in range(0, len(word), LEARNED_TOGETHER):
                        for piece, share in expected_counts(word[at : at + LEARNED_TOGETHER], known[lang], model.longest).items():
                            total[lang, piece] = total.get((lang, piece), 0.0) + n * share
            keys = list(total)
            yield pa.record_batch([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()), pa.array([total[k] for k in keys], pa.float64())], names=["lang", "piece", "n"])

        counts = np.full(model.probabilities.shape, SMOOTHING)
        summed = words.mapInArrow(expect, "lang string, piece string, n double").groupBy("lang", "piece").agg(F.sum("n").alias("n"))
        place = {lang: i for i, lang in enumerate(languages)}
        for row in summed.collect():
            counts[place[row.lang], column[row.piece]] += row.n
        model = Model(languages, counts / counts.sum(axis=1, keepdims=True), pieces)
    return model


def predict(spark: SparkSession, model: Model, text: Column | str) -> Column:
    """``struct<lang string, score double>`` of the whole text."""
    sent = model.share(spark)
    small_batches(spark)

    @F.arrow_udf("struct<lang: string, score: double>")
    def language(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = Scorer(Model(*sent.value))
        for texts in batches:
            found, part, size = [], [], 0
            for i, text in enumerate(texts):
                part.append(text.as_py())
                size += len(part[-1] or "")
                if size > PREPARED or i == len(texts) - 1:
                    if size <= 2 * PREPARED:  # a longer text learns its own words part by part
                        scorer.prepare(part)
                    found += scorer.score(part)
                    part, size = [], 0
            yield pa.StructArray.from_arrays([pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())], names=["lang", "score"])

    return language(text)


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``; columns of these names are replaced."""
    plain = docs.drop("lang_pred", "score")
    made = fresh(plain, "_lang")
    found = plain.withColumn(made, predict(docs.sparkSession, model, F.col(text)))
    return found.withColumns({"lang_pred": F.col(made)["lang"], "score": F.col(made)["score"]}).drop(made)
