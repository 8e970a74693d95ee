"""Suffix stripping (plural, past tense, -ing, final y) over token arrays, without Python UDFs.

Each step is its own ``transform`` so that a step's input is one lambda variable and is evaluated
once. A token whose -ed/-ing was stripped carries a marker into the repair step.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# y counts as a vowel after a consonant, so "has a vowel" and "measure > 0" are plain patterns.
HAS_VOWEL = "[aeiou]|.y"
MEASURED = "[aeiou][^aeiou]|(^y|[^aeiouy])y[^aeiou]"
MARK = "\u0001"


def _cut(word: Column, n: int) -> Column:
    return F.substring(word, F.lit(1), F.length(word) - n)


def _plural(w: Column) -> Column:
    return (
        F.when(w.endswith("sses") | w.endswith("ies"), _cut(w, 2))
        .when(w.endswith("s") & ~w.endswith("ss"), _cut(w, 1))
        .otherwise(w)
    )


def _past_or_ing(w: Column) -> Column:
    return (
        F.when(w.endswith("eed"), F.when(_cut(w, 3).rlike(MEASURED), _cut(w, 1)).otherwise(w))
        .when(w.endswith("ed") & _cut(w, 2).rlike(HAS_VOWEL), F.concat(_cut(w, 2), F.lit(MARK)))
        .when(w.endswith("ing") & _cut(w, 3).rlike(HAS_VOWEL), F.concat(_cut(w, 3), F.lit(MARK)))
        .otherwise(w)
    )


def _repair(w: Column) -> Column:
    bare = _cut(w, 1)
    return (
        F.when(~w.endswith(MARK), w)
        .when(w.rlike(f"(at|bl|iz){MARK}$"), F.concat(bare, F.lit("e")))
        .when(w.rlike(rf"([^lsz])\1{MARK}$"), _cut(w, 2))
        .otherwise(bare)
    )


def _final_y(w: Column) -> Column:
    return F.when(w.endswith("y") & _cut(w, 1).rlike(HAS_VOWEL), F.concat(_cut(w, 1), F.lit("i"))).otherwise(w)


def stem_tokens(tokens: Column) -> Column:
    """Stem every token of a lower-case array; words of one or two characters stay."""
    # Later steps also see words that an earlier step shortened to two characters or fewer, so the
    # length rule applies to the original word only: short originals leave through a marker-free path.
    out = F.transform(tokens, lambda w: F.when(F.length(w) > 2, _plural(w)).otherwise(F.concat(F.lit(MARK), w)))
    for step in (_past_or_ing, _repair, _final_y):
        out = F.transform(out, _skip_short(step))
    return F.transform(out, lambda w: F.when(w.startswith(MARK), F.substring(w, F.lit(2), F.length(w))).otherwise(w))


def _skip_short(step):
    return lambda w: F.when(w.startswith(MARK), w).otherwise(step(w))
