"""Positions and blocks: row order without one task per key.

A window partitioned by a key alone puts the whole key into one task. Here every key is cut along
its order column, so that a key with a third of all rows is spread like the rest.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gazetick.session import stage

BLOCK = 1024


def with_position(
    df: DataFrame,
    order: Sequence[str],
    keys: Sequence[str] = (),
    shifts: Sequence[int] = (16, 32),
    out: str = "pos",
    total: str | None = None,
    per_key: DataFrame | None = None,
) -> DataFrame:
    """1-based position of every row within its key, in ``order``.

    ``order[0]`` is integral and leads the order. Rows are cut into buckets ``order[0] >> shifts[0]``
    and numbered inside their bucket; the bucket offsets come from a prefix sum over bucket counts,
    itself nested by the further shifts. The cut depends on values only, so a recomputed task yields
    the same buckets (sampled range bounds would not). With unique order values a bucket holds at
    most ``2**shifts[0]`` rows and a window over counts at most ``2**(step between shifts)`` rows.

    ``total`` names an extra column with the key's row count. ``per_key`` is a table with one row per
    key whose columns are added: they travel with the bucket offsets, where a hot key is no burden.
    """
    keys = list(keys)
    lead = F.col(order[0]).cast("long")
    names = [f"_b{i}" for i in range(len(shifts))]
    keyed = df.withColumn(names[0], F.shiftright(lead, shifts[0]))

    counts = [keyed.groupBy(*keys, names[0]).agg(F.count(F.lit(1)).alias("_n"))]
    for i in range(1, len(shifts)):
        parent = counts[-1].withColumn(names[i], F.shiftright(F.col(names[i - 1]), shifts[i] - shifts[i - 1]))
        counts[-1] = parent
        counts.append(parent.groupBy(*keys, names[i]).agg(F.sum("_n").alias("_n")))

    def before(level: int, scope: Sequence[str]) -> Column:
        spec = Window.partitionBy(*keys, *scope).orderBy(names[level]).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("_n").over(spec), F.lit(0))

    top = len(shifts) - 1
    cols = [before(top, ()).alias("_off")]
    if total:
        cols.append(F.sum("_n").over(Window.partitionBy(*keys)).alias(total))
    offsets = counts[top].select(*keys, names[top], *cols)
    extra = [total] if total else []
    if per_key is not None:
        offsets = offsets.join(per_key, keys)
        extra += [c for c in per_key.columns if c not in keys]
    for level in range(top - 1, -1, -1):
        inner = counts[level].select(*keys, names[level], names[level + 1], before(level, [names[level + 1]]).alias("_in"))
        offsets = inner.join(offsets, [*keys, names[level + 1]]).select(
            *keys, names[level], (F.col("_in") + F.col("_off")).alias("_off"), *extra
        )

    in_bucket = F.row_number().over(Window.partitionBy(*keys, names[0]).orderBy(*order))
    numbered = keyed.withColumn("_rn", in_bucket).join(offsets, [*keys, names[0]])
    return numbered.select(*df.columns, (F.col("_rn") + F.col("_off")).alias(out), *extra)


def ranked(df: DataFrame, order: Sequence[Column | str], out: str) -> DataFrame:
    """0-based rank of every row in ``order``, whatever the types; ties in any order.

    Rows are sorted by range over all partitions, so no task holds them all. What meets in one window
    is one count for each partition.
    """
    rows = stage(df.orderBy(*order).withColumn("_row", F.monotonically_increasing_id())).withColumn("_part", F.shiftright("_row", 33))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    offset = F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.shiftleft("_part", 33)
    placed = rows.join(F.broadcast(counts.select("_part", offset.alias("_off"))), "_part")
    return placed.select(*df.columns, (F.col("_row") + F.col("_off")).alias(out))


def with_blocks(
    df: DataFrame, pos: str = "pos", block: int = BLOCK, before: int = 0, after: int = 0
) -> DataFrame:
    """Cut positions into blocks and copy the rows a neighbour's frames reach into.

    Adds ``_block`` and ``_own``. Window over ``(keys, _block)`` ordered by ``pos``, then keep
    ``_own`` rows. ``before``/``after`` rows are visible on each side (at most one block).
    """
    if max(before, after) > block:
        raise ValueError("a frame may not be longer than a block")
    index = F.col(pos) - 1
    home = F.floor(index / block)
    inside = index - home * block
    homes = [home]
    if before:
        homes.append(F.when(inside >= block - before, home + 1))
    if after:
        homes.append(F.when((inside < after) & (home > 0), home - 1))
    copies = df.withColumn("_block", F.explode(F.array_compact(F.array(*homes))))
    return copies.withColumn("_own", F.col("_block") == home)


def block_window(keys: Sequence[str], pos: str = "pos"):
    return Window.partitionBy(*keys, "_block").orderBy(pos)
