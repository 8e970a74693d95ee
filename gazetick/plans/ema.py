"""Exponential averages (first value as start, no bias correction) over blocks of positions.

One step is y <- a*x + (1-a)*y, an affine map, so a block can be averaged with a zero start and
corrected afterwards by the value carried in from the blocks before it.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gazetick.plans.position import BLOCK, block_window


def alpha(span: int) -> float:
    return 2.0 / (span + 1.0)


def check_spans(spans: Sequence[int], block: int) -> None:
    for span in spans:
        if span < 1 or (span > 1 and -block * math.log10(1 - alpha(span)) > 250):
            raise ValueError(f"span {span} overflows in a block of {block} rows; use a smaller block")


def _index(pos: str, block: int) -> Column:
    return F.pmod(F.col(pos) - 1, F.lit(block)).cast("double")


def _seeded(x: Column, pos: str, a: float) -> Column:
    """The series' first value weighs fully, as if it had always been there."""
    x = F.coalesce(x, F.raise_error(F.lit("exponential averages need a series without nulls")))
    return F.when(F.col(pos) == 1, x).otherwise(x * a)


def local_sum(x: Column, span: int, keys: Sequence[str], pos: str = "pos", block: int = BLOCK) -> Column:
    """Running sum of a block's own rows, scaled so that row i only needs a factor (1-a)**i."""
    a = alpha(span)
    if span == 1:
        return x
    own = F.when(F.col("_own"), _seeded(x, pos, a) * F.pow(F.lit(1 - a), -_index(pos, block)))
    return F.sum(own).over(block_window(keys, pos).rowsBetween(Window.unboundedPreceding, 0))


def carries(positioned: DataFrame, col: str, spans: Sequence[int], keys: Sequence[str], pos: str = "pos", block: int = BLOCK) -> DataFrame:
    """``keys, _block, carry_<span>``: the average at the end of the block before.

    Blocks are averaged by a partial aggregate. The average at a block's end is the sum of the ends
    of earlier blocks, each faded by (1-a)**block per block in between; terms below double
    precision are not sent. That makes a plain aggregate of it: no window runs over a key's blocks.
    """
    check_spans(spans, block)
    index = _index(pos, block)
    last = float(block - 1)
    ends = positioned.groupBy(*keys, F.floor((F.col(pos) - 1) / block).alias("_block")).agg(
        *[
            F.sum(_seeded(F.col(col), pos, alpha(s)) * F.pow(F.lit(1 - alpha(s)), F.lit(last) - index)).alias(f"_end_{s}")
            for s in spans
        ]
    )
    reach = max(reach_in_blocks(s, block) for s in spans)
    sent = ends.withColumn("_step", F.explode(F.sequence(F.lit(1), F.lit(reach))))
    return sent.groupBy(*keys, (F.col("_block") + F.col("_step")).alias("_block")).agg(
        *[
            F.sum(F.col(f"_end_{s}") * F.pow(F.lit((1 - alpha(s)) ** block), F.col("_step") - 1)).alias(f"carry_{s}")
            for s in spans
        ]
    )


def reach_in_blocks(span: int, block: int) -> int:
    """Blocks until (1-a)**rows falls below 1e-20."""
    if span == 1:
        return 1
    rows = 20 * math.log(10) / -math.log(1 - alpha(span))
    return max(1, math.ceil(rows / block))


def finish(local: Column, carry: Column, span: int, pos: str = "pos", block: int = BLOCK) -> Column:
    """Exact average of a row from its block's running sum and the carried value."""
    if span == 1:
        return local
    fade = F.lit(1 - alpha(span))
    index = _index(pos, block)
    return local * F.pow(fade, index) + F.coalesce(carry, F.lit(0.0)) * F.pow(fade, index + 1)


def cascade(outer: int, inner: int, ema_outer: Column, ema_inner: Column) -> Column:
    """EMA(outer) of EMA(inner) from the two plain averages of the series (spans must differ).

    Both start from the series' first value, so the cascade is the partial-fraction split of the
    product of two first-order filters; no second pass over the rows is needed.
    """
    p, q = alpha(outer), alpha(inner)
    gap = q - p
    return ema_outer * (q * (1 - p) / gap) - ema_inner * (p * (1 - q) / gap)
