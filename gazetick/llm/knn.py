"""Exact top-k search by inner product as a Voronoi kNN join.

Pivots are vectors picked by hash. Data and queries are grouped by their nearest pivot; a group's
summary is its rows, largest distance to the pivot and pivot. The first pass solves each query in
its own group, whose k-th score no final score can be below. In the second pass a query goes to a
group only if the group's bound ``<q, pivot> + |q| radius`` reaches that score, and is solved there;
the best of all groups are ranked. Ties at the bound are kept, so results are exact.

A group's data are cut into blocks of about ``BLOCK`` rows by a hash of the id, and the queries that
need the group into as many parts as their own number asks for, at most ``PARTS``; a task holds one
block and streams a part's queries past it. A row goes to a part only if its distance to the pivot
reaches the least distance at which it could score enough for one of the part's queries, so a group
that no query needs sends nothing. What is broadcast are pivots and summaries, at most ``PIVOTS``
rows, and those least distances, at most ``PIVOTS * PARTS`` numbers.

Vectors that are null, empty, or hold null or non-finite components, and rows without an id, take no
part. Shorter vectors count as padded with zeros. Ids must be unique; ties in score go to the smaller id. No candidates:
no rows. Copies are candidates like any other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gazetick.session import stage

PIVOTS = 1024
ROWS_PER_PIVOT = 2048
BLOCK = 4096
PARTS = 64
LOWEST = -(2**62)


def usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & ~bad


def scaled(vector: Column, scale: float) -> Column:
    """Components as whole numbers: the floor of ``scale`` times each, in double precision."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column, padded with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    ends = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False)
    sizes = np.diff(ends)
    if len(sizes) and (sizes == width).all():
        return flat[ends[0] : ends[-1]].reshape(-1, width)
    out = np.zeros((len(sizes), width), flat.dtype)
    for i, (a, b) in enumerate(zip(ends[:-1], ends[1:], strict=True)):
        out[i, : b - a] = flat[a:b]
    return out


def products(queries: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers; by floating point only where that is exact."""
    largest = float(np.abs(queries).max(initial=0)) * float(np.abs(data).max(initial=0)) * queries.shape[1]
    if largest < 2**53:
        return (queries.astype(np.float64) @ data.T.astype(np.float64)).astype(np.int64)
    return queries @ data.T


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best by score, then id."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        places = np.flatnonzero(scores >= least)
    else:
        places = np.arange(len(scores))
    return places[np.lexsort((ids[places], -scores[places]))][:k]


class Groups:
    """Pivots with the radius and blocks of their groups."""

    def __init__(self, pivots: np.ndarray):
        self.pivots = pivots.astype(np.float64)
        self.radius = np.zeros(len(pivots))
        self.blocks = np.zeros(len(pivots), np.int64)

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        vectors = vectors.astype(np.float64)
        apart = (self.pivots**2).sum(axis=1) - 2 * vectors @ self.pivots.T
        cell = apart.argmin(axis=1)
        return cell, np.sqrt(((vectors - self.pivots[cell]) ** 2).sum(axis=1))

    def needed(self, query: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Groups that may hold a score of at least ``least``, and the distance from their pivots that it takes.

        Rounding errors only add groups and shorten distances.
        """
        query = query.astype(np.float64)
        length = np.sqrt((query**2).sum())
        middle = self.pivots @ query
        slack = 1e-9 * (length * (self.radius + np.sqrt((self.pivots**2).sum(axis=1))) + 1)
        cells = np.flatnonzero((self.blocks > 0) & (middle + length * self.radius + slack >= least))
        if not length:
            return cells, np.full(len(cells), -np.inf)
        return cells, (least - slack[cells] - middle[cells]) / length


def units(placed: DataFrame, asked: DataFrame, groups: Groups) -> DataFrame:
    """``cell, block, part, is_query, id, v, least``: queries, and the rows that they need.

    ``placed``: ``id, v, cell, apart``; ``asked``: ``id, v, least, cell, need``, once for each cell that a query needs.
    """
    parts = np.zeros(len(groups.pivots), np.int64)
    for row in asked.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect():  # one row a pivot
        parts[row.cell] = min(PARTS, -(-row.n // BLOCK))
    of_cell = lambda numbers: F.element_at(F.lit(numbers.astype(int).tolist()), F.col("cell") + 1)
    asked = asked.withColumn("part", F.pmod(F.xxhash64("id", F.lit(1)), of_cell(parts)).cast("int"))
    need = np.full((len(parts), int(parts.max(initial=0))), np.inf)
    for row in asked.groupBy("cell", "part").agg(F.min("need").alias("need")).collect():  # PIVOTS * PARTS rows at most
        need[row.cell, row.part] = row.need

    @F.arrow_udf("array<int>")
    def reached(cell: pa.Array, apart: pa.Array) -> pa.Array:
        row, part = np.nonzero(need[cell.to_numpy()] <= apart.to_numpy()[:, None])
        ends = np.searchsorted(row, np.arange(len(cell) + 1))
        return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(part.astype(np.int32)))

    blocks = of_cell(groups.blocks)
    data = placed.withColumn("block", F.pmod(F.xxhash64("id"), blocks)).withColumn("part", F.explode(reached("cell", "apart")))
    data = data.select("cell", "block", "part", F.lit(False).alias("is_query"), "id", "v", F.lit(LOWEST).cast("bigint").alias("least"))
    everywhere = asked.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), blocks - 1)))
    return data.unionByName(everywhere.select("cell", "block", "part", F.lit(True).alias("is_query"), "id", "v", "least"))


def _solve(k: int, width: int, final: bool):
    """Top k of each query in its unit, or before the final pass its k-th score alone.

    Rows come sorted by unit, and in a unit the data before the queries.
    """

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, ids, data = None, None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            units = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("cell", "block", "part")], axis=1)
            is_query = batch.column("is_query").to_numpy(zero_copy_only=False).astype(bool)
            names, least = batch.column("id").to_numpy(), batch.column("least").to_numpy()
            vectors = matrix(batch.column("v"), width)
            starts = np.flatnonzero(np.append(True, (units[1:] != units[:-1]).any(axis=1)))
            out: list[list] = [[], [], []]
            for low, high in zip(starts, np.append(starts[1:], len(units)), strict=True):
                if unit is None or tuple(units[low]) != unit:
                    unit, ids, data = tuple(units[low]), names[:0], vectors[:0]
                rows = np.arange(low, high)
                ids = np.concatenate([ids, names[rows[~is_query[rows]]]])
                data = np.concatenate([data, vectors[rows[~is_query[rows]]]])
                asking = rows[is_query[rows]]
                if not len(asking) or not len(ids):
                    continue
                scores = products(vectors[asking], data)
                for row, score in zip(asking, scores, strict=True):
                    places = np.flatnonzero((ids != names[row]) & (score >= least[row]))
                    places = places[best(score[places], ids[places], k)]
                    if not final:
                        places = places[k - 1 :]
                    out[0].append(np.full(len(places), names[row]))
                    out[1].append(ids[places])
                    out[2].append(score[places])
            if out[0]:
                yield pa.record_batch([pa.array(np.concatenate(x).astype(np.int64)) for x in out], names=["query_id", "id", "score"])

    return solve


def top_k(vectors: DataFrame, is_query: Column, k: int, id: str = "vec_id", vector: str = "embedding", scale: float = 64.0) -> DataFrame:
    """``query_id, rank, id, score``: for every row where ``is_query`` holds, its k best other rows."""
    spark = vectors.sparkSession
    whole = stage(vectors.filter(F.col(id).isNotNull() & usable(F.col(vector))).select(F.col(id).cast("bigint").alias("id"), scaled(F.col(vector), scale).alias("v"), is_query.alias("asks")))
    rows, width = whole.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("v")), F.lit(1))).first()
    result = "query_id long, id long, score long"
    if not rows:
        return spark.createDataFrame([], "query_id long, rank int, id long, score long")
    wanted = min(PIVOTS, max(1, rows // ROWS_PER_PIVOT))
    picked = whole.select("v", "id").orderBy(F.xxhash64("id"), "id").limit(wanted).toArrow()  # at most PIVOTS rows
    groups = Groups(matrix(picked.column("v"), width))

    @F.arrow_udf("struct<cell:int,apart:double>")
    def place(column: pa.Array) -> pa.Array:
        cell, apart = groups.nearest(matrix(column, width)) if len(column) else (np.empty(0), np.empty(0))
        return pa.StructArray.from_arrays([pa.array(cell.astype(np.int32)), pa.array(apart.astype(np.float64))], names=["cell", "apart"])

    placed = stage(whole.withColumn("_p", place("v")).select("id", "v", "asks", "_p.*"))
    for row in placed.groupBy("cell").agg(F.max("apart").alias("radius"), F.count(F.lit(1)).alias("n")).collect():  # one row a pivot
        groups.radius[row.cell], groups.blocks[row.cell] = row.radius, -(-row.n // BLOCK)

    def solved(asked: DataFrame, final: bool) -> DataFrame:
        dealt = units(placed.select("id", "v", "cell", "apart"), asked, groups).repartition("cell", "block", "part")
        return dealt.sortWithinPartitions("cell", "block", "part", "is_query").mapInArrow(_solve(k, width, final), result)

    queries = placed.filter("asks")
    at_home = queries.select("id", "v", F.lit(LOWEST).cast("bigint").alias("least"), "cell", F.lit(float("-inf")).alias("need"))
    # The k-th score of any block of the own group bounds the final k-th score from below.
    home = solved(at_home, False).groupBy(F.col("query_id").alias("id")).agg(F.max("score").alias("least"))
    known = queries.select("id", "v").join(home, "id", "left").select("id", "v", F.coalesce("least", F.lit(LOWEST)).alias("least"))

    @F.arrow_udf("array<struct<cell:int,need:double>>")
    def cells(column: pa.Array, least: pa.Array) -> pa.Array:
        each = [groups.needed(q, m) for q, m in zip(matrix(column, width), least.to_numpy(), strict=True)] if len(column) else []
        flat = [np.concatenate([np.empty(0), *x]) for x in zip(*each, strict=True)] or [np.empty(0)] * 2
        routes = pa.StructArray.from_arrays([pa.array(flat[0].astype(np.int32)), pa.array(flat[1])], names=["cell", "need"])
        return pa.ListArray.from_arrays(pa.array(np.cumsum([0] + [len(c) for c, _ in each]), pa.int32()), routes)

    routed = stage(known.withColumn("routes", cells("v", "least")))
    found = stage(solved(routed.select("id", "v", "least", F.inline("routes")), True))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "id", "score")
