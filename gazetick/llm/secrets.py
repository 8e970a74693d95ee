"""Secret scans with DataFrame functions alone.

Base kinds are found by pattern; ``entropy`` adds candidate strings in which a sliding window of
``WINDOW`` characters reaches the Shannon entropy of its character class. The window's counts are
kept incrementally, one character in and one out, and so is the sum of c log2(c). Candidates on the
allow-list (words, slugs of parts that are all letters or all digits, numbers, UUIDs and further
patterns a caller names) are suppressed, and so are spans inside a base span.

A base span is the whole match in code points, end exclusive; an entropy span reaches from the first
hot window to the end of the last. Masks cover the candidate of such a span whole, since the ends of a
key may lie in windows just below the limit. A null text counts as empty. Rows are independent, so ties,
repeated rows and empty tables need no rule; other columns pass through, whatever their names, and a
column named ``secret_spans`` is replaced by ``with_secret_spans``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gazetick.llm.common import fresh

# Fixed patterns of the contract; the groups of ASSIGN are its keyword and its value.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_VALUE = 8
# A run's first character starts its leftmost match, so the least length can be part of the pattern.
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "entropy")

WINDOW = 20
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/=_-"
CANDIDATE = r"(?<![A-Za-z0-9+/=_-])[A-Za-z0-9+/=_-]{20,}"
#: Least entropy of a window, in bits a character: of hexadecimal candidates, and of all others.
HEX_BITS, OTHER_BITS = 3.03, 3.83
#: Candidates that are no secrets, by full match.
ALLOWED = (
    r"[A-Za-z]+",
    r"([a-z]+|[0-9]+)([-_/=]([a-z]+|[0-9]+)?)*",
    r"[A-Z]+([-_/=][A-Z]*)*",
    r"[0-9+/=_-]+",
    r"[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}",
    r"(/?[A-Za-z]+)+/?",
)
SPAN = "array<struct<start:int,kind:int,end:int>>"
MASK = "[SECRET]"
_CUT, _OTHER = "\x01", "\x02"


def _matches(text: Column, pattern: str, kind: int, keep) -> Column:
    """Spans of the matches for which ``keep`` holds; ``text`` has no ``_CUT`` in it."""
    pieces = F.split(F.regexp_replace(text, F.lit(pattern), F.lit(_CUT + "$0" + _CUT)), _CUT)
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("at"), F.array().cast(SPAN).alias("spans"))

    def step(state: Column, piece: Column) -> Column:
        end = state.at + F.length(piece)
        span = F.struct(state.at.alias("start"), F.lit(kind).alias("kind"), end.alias("end"))
        found = (state.n % 2 == 1) & keep(piece)  # pieces are in turn outside and inside
        return F.struct((state.n + 1).alias("n"), end.alias("at"), F.when(found, F.array_append(state.spans, span)).otherwise(state.spans).alias("spans"))

    spans = F.aggregate(pieces, start, step, lambda state: state.spans)
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast(SPAN))


def hot_range(candidate: Column, window: int = WINDOW, hex_bits: float = HEX_BITS, other_bits: float = OTHER_BITS) -> Column:
    """``first, last``: ends of the first and last window at or above the entropy of the class, 0 if none."""
    terms = F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(window + 1)])
    codes = F.transform(F.split(candidate, ""), lambda c: F.instr(F.lit(LETTERS), c))
    need = F.when(candidate.rlike("^[0-9A-Fa-f]+$"), F.lit(hex_bits)).otherwise(F.lit(other_bits))
    start = F.struct(
        F.lit(0).alias("n"), F.array_repeat(F.lit(0), len(LETTERS)).alias("counts"), F.lit(0.0).alias("sum"),
        F.array().cast("array<int>").alias("inside"), F.lit(0).alias("first"), F.lit(0).alias("last"),
    )

    def step(state: Column, code: Column) -> Column:
        n = state.n + 1
        full = state.n >= window
        gone = F.when(full, F.element_at(state.inside, 1)).otherwise(F.lit(0))
        stays = F.when(full, F.slice(state.inside, 2, window - 1)).otherwise(state.inside)
        same = gone == code
        held = F.element_at(state.counts, code)
        left = F.element_at(state.counts, F.greatest(gone, F.lit(1)))
        term = lambda c: F.element_at(terms, c + 1)
        drop = F.when(full & ~same, term(left - 1) - term(left)).otherwise(F.lit(0.0))
        gain = F.when(full & same, F.lit(0.0)).otherwise(term(F.least(held + 1, F.lit(window))) - term(held))
        total = state.sum + drop + gain
        counts = F.transform(state.counts, lambda c, i: c + (i + 1 == code).cast("int") - (full & (i + 1 == gone)).cast("int"))
        hot = (n >= window) & (F.lit(math.log2(window)) - total / F.lit(float(window)) >= need)
        return F.struct(
            n.alias("n"), counts.alias("counts"), total.alias("sum"), F.array_append(stays, code).alias("inside"),
            F.when(hot & (state.first == 0), n).otherwise(state.first).alias("first"), F.when(hot, n).otherwise(state.last).alias("last"),
        )

    return F.aggregate(codes, start, step, lambda s: F.struct(s.first.alias("first"), s.last.alias("last")))


def secret_spans(text: Column, allowed: Sequence[str] = ALLOWED) -> tuple[Column, Column]:
    """Base spans and entropy spans of the text; kind is a place in ``KINDS``. An entropy span has the ``low`` and ``high`` of its candidate."""
    clean = F.translate(F.coalesce(text, F.lit("")), _CUT, _OTHER)
    every = lambda piece: F.lit(True)
    value = lambda piece: F.length(F.regexp_extract(piece, ASSIGN, 2)) >= ASSIGN_VALUE
    base = F.concat(_matches(clean, ASSIGN, 0, value), _matches(clean, ACCESS, 1, every), _matches(clean, HEX, 2, every))
    suspect = lambda piece: ~piece.rlike("^(" + "|".join(allowed) + ")$")
    candidates = F.transform(
        _matches(clean, CANDIDATE, 3, suspect),
        lambda s: F.struct(s.start.alias("low"), s.end.alias("high"), hot_range(F.substring(clean, s.start + 1, s.end - s.start)).alias("hot")),
    )
    entropy = F.transform(
        F.filter(candidates, lambda c: c.hot.last > 0),
        lambda c: F.struct((c.low + c.hot.first - WINDOW).alias("start"), F.lit(3).alias("kind"), (c.low + c.hot.last).alias("end"), c.low.alias("low"), c.high.alias("high")),
    )
    return base, entropy


def _spans_and_masks(docs: DataFrame, text: str, allowed: Sequence[str], spans: str, masks: str | None = None) -> DataFrame:
    """``docs`` with all ``spans`` by start, then kind, and the ``masks`` in the same form if wanted."""
    base, entropy = secret_spans(F.col(text), allowed)
    names = fresh(docs, "_base"), fresh(docs, "_entropy")
    found = docs.withColumns(dict(zip(names, (base, entropy), strict=True)))
    added = F.filter(names[1], lambda e: ~F.exists(names[0], lambda b: (b.start <= e.start) & (b.end >= e.end)))

    def merged(start: str, end: str) -> Column:
        plain = F.transform(added, lambda e: F.struct(e[start].alias("start"), e.kind.alias("kind"), e[end].alias("end")))
        return F.array_sort(F.concat(names[0], plain))

    new = {spans: merged("start", "end")} | ({masks: merged("low", "high")} if masks else {})
    return found.withColumns(new).drop(*names)


def with_secret_spans(docs: DataFrame, text: str = "text", allowed: Sequence[str] = ALLOWED) -> DataFrame:
    """``docs`` with ``secret_spans``, all spans by start, then kind (a place in ``KINDS``)."""
    return _spans_and_masks(docs.drop("secret_spans"), text, allowed, "secret_spans")


def span_list(spans: Column | str) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    shown = lambda s: F.concat_ws(":", F.element_at(names, s.kind + 1), s.start.cast("string"), s.end.cast("string"))
    return F.array_join(F.transform(spans, shown), ",")


def mask_secrets(docs: DataFrame, text: str = "text", mask: str = MASK, allowed: Sequence[str] = ALLOWED) -> DataFrame:
    """``docs`` with every base span and every candidate of an entropy span, or run of overlapping ones, replaced by ``mask``; columns unchanged."""
    spans, masks = fresh(docs, "_spans"), fresh(docs, "_masks")
    found = _spans_and_masks(docs, text, allowed, spans, masks)
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(state: Column, span: Column) -> Column:
        before = F.concat(state.out, F.substring(F.col(text), state.at + 1, span.start - state.at), F.lit(mask))
        return F.struct(F.greatest(state.at, span.end).alias("at"), F.when(span.start >= state.at, before).otherwise(state.out).alias("out"))

    rest = lambda s: F.concat(s.out, F.substring(F.col(text), s.at + 1, F.length(F.col(text))))
    masked = F.when(F.size(masks) > 0, F.aggregate(masks, start, step, rest)).otherwise(F.col(text))
    return found.withColumn(text, masked).select(*docs.columns)
