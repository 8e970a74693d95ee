"""Mixing sources to target weights.

Tokens are summed per source; each source gets a target; a document is then emitted floor(rate)
times, and once more with the probability of the rate's fraction, drawn from a hash of its id.

Nulls: a null text has size 0, a null source is a source of its own and comes last, a null id draws
like the empty id. Sources without words get target and rate 0. Rows that repeat an id draw alike.
Empty input gives empty output. Other columns pass through ``mix_documents`` untouched; names that
start with ``_mix_`` are reserved.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gazetick.llm.common import WORD, hash_unit, join_per_key
from gazetick.session import stage

WEIGHTS = (1, 2, 3)
MOST = 3.0
SEED = 20


def word_count(text: Column | str) -> Column:
    """Words of the whole text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def ranked_sources(sizes: DataFrame, source: str) -> DataFrame:
    """``_mix_rank``: 0-based place of every source by code point, null last.

    The sort is by range over all partitions; only one count per partition meets in a window.
    """
    ordered = sizes.orderBy(F.col(source).isNull(), source).withColumn("_mix_row", F.monotonically_increasing_id())
    ordered = stage(ordered).withColumn("_mix_part", F.shiftright("_mix_row", 33))
    before = Window.orderBy("_mix_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = ordered.groupBy("_mix_part").agg(F.count(F.lit(1)).alias("_mix_n"))
    offset = F.coalesce(F.sum("_mix_n").over(before), F.lit(0)) - F.shiftleft("_mix_part", 33)
    parts = parts.select("_mix_part", offset.alias("_mix_off"))
    placed = ordered.join(F.broadcast(parts), "_mix_part")  # one row for each task of the sort
    return placed.withColumn("_mix_rank", F.col("_mix_row") + F.col("_mix_off")).drop("_mix_row", "_mix_part", "_mix_off")


def source_targets(
    sizes: DataFrame, source: str = "source", size: str = "source_size", weights: Sequence[int] = WEIGHTS, most: float = MOST
) -> DataFrame:
    """``source, source_size, target``: weights share the sum of all sizes, none above ``most`` times its size.

    One number describes a round: the target of weight 1. Each round is a one-row aggregate; sources
    that lie above their limit keep it, and the rest shares what is left, until no further one does.
    """
    ranked = ranked_sources(sizes, source)
    choices = F.array(*[F.lit(int(w)) for w in weights])
    weight = F.element_at(choices, (F.pmod("_mix_rank", F.lit(len(weights))) + 1).cast("int"))
    ranked = stage(ranked.select(source, size, weight.alias("_mix_w")))
    unit, held = -1.0, -1
    while True:
        above = F.col("_mix_w") * F.lit(unit) > F.lit(most) * F.col(size)
        total, kept, open_weight, above_n = ranked.agg(
            F.coalesce(F.sum(size), F.lit(0)),
            F.coalesce(F.sum(F.when(above, F.col(size))), F.lit(0)),
            F.coalesce(F.sum(F.when(~above, F.col("_mix_w"))), F.lit(0)),
            F.count(F.when(above, 1)),
        ).first()
        if above_n == held or not open_weight:
            break
        held = above_n
        unit = (total - most * kept) / open_weight
    target = F.least(F.col("_mix_w") * F.lit(unit), F.lit(most) * F.col(size))
    return ranked.select(source, size, target.alias("target"))


def mix_plan(
    docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", seed: int = SEED,
    weights: Sequence[int] = WEIGHTS, most: float = MOST, size: Column | None = None,
) -> DataFrame:
    """``docs`` with ``_mix_size``, ``_mix_source_size``, ``_mix_target`` and ``_mix_copies`` of each row."""
    sized = docs.drop(*[c for c in docs.columns if c.startswith("_mix_")])
    sized = sized.withColumn("_mix_size", word_count(text) if size is None else size)
    totals = sized.groupBy(source).agg(F.sum("_mix_size").alias("_mix_source_size"))
    targets = stage(source_targets(totals, source, "_mix_source_size", weights, most).withColumnRenamed("target", "_mix_target"))
    mixed = join_per_key(sized, targets, source, F.col(id))
    rate = F.coalesce(F.col("_mix_target") / F.nullif(F.col("_mix_source_size"), F.lit(0)), F.lit(0.0))
    copies = F.floor(rate) + (hash_unit(F.col(id), seed) < rate - F.floor(rate)).cast("bigint")
    return mixed.withColumn("_mix_copies", copies)


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as its plan says, with the columns of ``docs``."""
    plan = mix_plan(docs, **options).filter("_mix_copies > 0")
    repeated = plan.withColumn("_mix_copy", F.explode(F.sequence(F.lit(1), F.col("_mix_copies").cast("int"))))
    return repeated.select(*[c for c in docs.columns if not c.startswith("_mix_")])
