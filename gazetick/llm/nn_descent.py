"""Embedding near-dedup by NN-descent.

Every distinct vector keeps its K nearest neighbours found so far. First lists come from sort orders
along random hyperplanes, where close vectors stand side by side. A round joins neighbours with
neighbours-of-neighbours: each vector is a pivot at which the members of its list, and the vectors
that list it, are compared with each other, where at least one of the two is new there. A pair goes
on if it improves a list; a pair at or above the threshold is a link, whether or not a list has room.

A list filled with links is saturated: more links may exist than it holds. It is enlarged until it holds
all: the vector is compared with its whole component, block by block, and only the numbers of links leave
the tasks. The work grows with a component's saturated vectors, not with the square of its size.

Close vectors without close neighbours only meet along a hyperplane, so the number of sort orders grows
with the logarithm of the table: as many as leave a pair at the threshold unmet with probability ``UNMET``.

Recall is audited and never part of the result: ``AUDITED`` vectors picked by hash are compared with all
rows in one scan, and their true links counted. Below the wanted recall the search goes on from fresh
orders and keeps all it found before; after ``ATTEMPTS`` searches below it, an error is raised.

Equal vectors are one point with a multiplicity; they link to each other and share all other links.
Vectors that are null, empty, zero, or hold null or non-finite components link with nothing. Shorter
vectors count as padded with zeros. Ids must be unique. Rows without an id take no part: each is kept with no
links and no root. Cosines are computed in double precision.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gazetick.llm.knn import matrix, usable
from gazetick.plans.components import connected_components
from gazetick.session import stage

NEIGHBOURS = 8
#: Sort orders that fill lists; rows that follow a row and are compared with it for its list, and for links.
ORDERS, FOLLOWING, LINKING = 8, 8, 32
#: Probability that a pair at the threshold stands side by side in no order of a search.
UNMET = 0.004
ROUNDS = 3
#: A search ends when fewer than this part of the list entries is new.
SETTLED = 0.01
#: The recall the audit wants, the vectors it asks for, and the searches it allows.
RECALL, AUDITED, ATTEMPTS = 0.99, 4096, 6
#: A true link counts from this far above the threshold, as two ways to sum may differ in the last bits.
ROUNDING = 1e-9
#: Saturated points that a task holds of a component, and members that pass by them.
BLOCK, STREAM = 1024, 65_536
PAIRS = "a long, b long, cosine double"
CLOSED = 2.0  # a bound no cosine can beat


def unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors.astype(np.float64)
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True, initial=np.finfo(np.float64).tiny)
    return vectors / np.sqrt((vectors**2).sum(axis=1, keepdims=True))


def _pairs(a, b, cosine) -> pa.RecordBatch:
    join = lambda parts, kind: np.concatenate([np.empty(0, kind), *parts]).astype(kind)
    return pa.record_batch([pa.array(join(a, np.int64)), pa.array(join(b, np.int64)), pa.array(join(cosine, np.float64))], names=["a", "b", "cosine"])


def orders_needed(n: int, threshold: float) -> int:
    """Sort orders after which a pair at the threshold has met but for a probability of ``UNMET``.

    Two vectors stand within ``LINKING`` rows where their first log2(n / LINKING) signs agree, each with
    the probability 1 - angle / pi.
    """
    agree = 1 - math.acos(max(-1.0, min(1.0, threshold))) / math.pi
    meet = agree ** max(1.0, math.log2(max(n, 1) / LINKING))
    return max(ORDERS, math.ceil(math.log(UNMET) / math.log1p(-meet)) if 0 < meet < 1 else ORDERS)


def _side_by_side(width: int, k: int, threshold: float):
    """Rows sorted by ``order, code``: of each row its ``k`` best among the rows around, and all links there.

    Lists are filled from the ``FOLLOWING`` next rows in the first ``ORDERS`` orders, links from the
    ``LINKING`` next rows in all. A row that already has ``k`` links here will be enlarged, so a further link
    of its goes on only if no chain of nearer ones connects the same two rows.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: tuple | None = None
        for batch in batches:
            new = [batch.column("o").to_numpy(), batch.column("id").to_numpy(), unit(matrix(batch.column("v"), width))]
            order, ids, units = new if kept is None else (np.concatenate(x) for x in zip(kept, new, strict=True))
            n = len(ids)
            near = np.full((n, 2 * FOLLOWING), -CLOSED)
            other = np.zeros((n, 2 * FOLLOWING), np.int64)
            linked = np.zeros((LINKING + 1, n), bool)
            values = np.zeros((LINKING + 1, n))
            for step in range(1, min(LINKING, n - 1) + 1):
                cosine = np.where(order[:-step] == order[step:], np.einsum("ij,ij->i", units[:-step], units[step:]), -CLOSED)
                if step <= FOLLOWING:
                    near[:-step, step - 1], other[:-step, step - 1] = cosine, ids[step:]
                    near[step:, FOLLOWING + step - 1], other[step:, FOLLOWING + step - 1] = cosine, ids[:-step]
                linked[step, :-step], values[step, :-step] = cosine >= threshold, cosine
            step, row = np.nonzero(linked)
            nearest = linked.argmax(axis=0)[row]
            chained = (nearest < step) & linked[step - nearest, row + nearest]
            goes = (step <= FOLLOWING) | ((near >= threshold).sum(axis=1)[row] < k) | ~chained
            step, row = step[goes], row[goes]
            out = [[ids[row], ids[row + step]], [ids[row + step], ids[row]], [values[step, row]] * 2]
            fill = (near > -CLOSED) & (near < threshold) & (order < ORDERS)[:, None]
            row, place = np.nonzero(fill & (near >= np.partition(near, -k, axis=1)[:, -k][:, None]))
            yield _pairs([*out[0], ids[row]], [*out[1], other[row, place]], [*out[2], near[row, place]])
            kept = order[-LINKING:], ids[-LINKING:], units[-LINKING:]

    return compare


def first_lists(points: DataFrame, n: int, width: int, seed: int, k: int, threshold: float) -> DataFrame:
    """Pairs of vectors that stand side by side along random hyperplanes' sign codes."""
    # 63 signs an order are one sortable number; the planes are drawn anew for each order and search.
    planes = np.random.default_rng(seed).normal(size=(orders_needed(n, threshold), width, 63))
    weights = 1 << np.arange(62, -1, -1, dtype=np.int64)

    @F.arrow_udf("array<long>")
    def codes(column: pa.Array) -> pa.Array:
        vectors = matrix(column, width)
        each = [((vectors @ p) > 0) @ weights for p in planes] if len(vectors) else []
        return pa.array(list(np.stack(each, axis=1)) if len(vectors) else [], pa.list_(pa.int64()))

    placed = points.select("id", "v", F.posexplode(codes("v")).alias("o", "code"))
    ordered = placed.repartitionByRange("o", "code", "id").sortWithinPartitions("o", "code", "id")
    return ordered.mapInArrow(_side_by_side(width, k, threshold), PAIRS)


def _meet(width: int, threshold: float):
    """Rows sorted by pivot: pairs of its members that beat a bound, or are links."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None
        batches = iter(batches)
        ended = False
        while not ended:
            batch = next(batches, None)
            ended = batch is None
            new = None if ended else [*(batch.column(c).to_numpy(zero_copy_only=False) for c in ("pivot", "member", "fresh", "least")), unit(matrix(batch.column("v"), width))]
            rows = [x for x in (kept, new) if x is not None]
            if not rows:
                continue
            pivot, member, fresh, least, units = (np.concatenate(x) for x in zip(*rows, strict=True))
            starts = np.append(np.flatnonzero(np.append(True, pivot[1:] != pivot[:-1])), len(pivot))
            out: list[list] = [[], [], []]
            for low, high in zip(starts[: None if ended else -1], starts[1 : None if ended else -1], strict=False):
                cosine = units[low:high] @ units[low:high].T
                may = fresh[low:high, None] | fresh[None, low:high]
                may &= (cosine > least[low:high, None]) | (cosine >= threshold)
                may &= member[low:high, None] != member[None, low:high]
                a, b = np.nonzero(may)
                for part, values in zip(out, (member[low + a], member[low + b], cosine[a, b]), strict=True):
                    part.append(values)
            yield _pairs(*out)
            cut = starts[-2]
            kept = (pivot[cut:], member[cut:], fresh[cut:], least[cut:], units[cut:])

    return compare


def best_lists(pairs: DataFrame, k: int) -> DataFrame:
    """``a, b, cosine, fresh`` of the k best of each ``a``; a pair that was there before is not fresh."""
    once = pairs.groupBy("a", "b").agg(F.max("cosine").alias("cosine"), F.min("fresh").alias("fresh"))
    order = Window.partitionBy("a").orderBy(F.desc("cosine"), "b")
    return once.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= k).drop("_n")


def refine(points: DataFrame, lists: DataFrame, width: int, k: int, threshold: float) -> DataFrame:
    """Pairs that a round of neighbours-of-neighbours finds."""
    full = lists.groupBy("a").agg(F.count(F.lit(1)).alias("n"), F.min("cosine").alias("least"))
    bound = F.when(F.col("least") >= threshold, CLOSED).otherwise(F.col("least"))
    state = points.join(full.select(F.col("a").alias("id"), F.when(F.col("n") >= k, bound).otherwise(-CLOSED).alias("least")), "id", "left")
    forward = lists.select(F.col("a").alias("pivot"), F.col("b").alias("member"), "fresh")
    # The usual sample of those that list a pivot; where a list can't hold all links, it is enlarged later.
    listed = Window.partitionBy("b").orderBy(F.desc("fresh"), F.xxhash64("a"), "a")
    reverse = lists.withColumn("_n", F.row_number().over(listed)).filter(F.col("_n") <= k).select(F.col("b").alias("pivot"), F.col("a").alias("member"), "fresh")
    members = forward.unionByName(reverse).groupBy("pivot", "member").agg(F.max("fresh").alias("fresh"))
    placed = members.join(state.withColumnRenamed("id", "member"), "member")
    placed = placed.select("pivot", "member", "fresh", F.coalesce("least", F.lit(-CLOSED)).alias("least"), "v")
    ordered = placed.repartition("pivot").sortWithinPartitions("pivot")
    return ordered.mapInArrow(_meet(width, threshold), PAIRS)


def search(points: DataFrame, n: int, width: int, threshold: float, k: int, seed: int, rounds: int) -> tuple[DataFrame, DataFrame]:
    """``lists, links`` after first lists and up to ``rounds`` rounds."""
    is_link = F.col("cosine") >= threshold
    pairs = stage(first_lists(points, n, width, seed, k, threshold)).withColumn("fresh", F.lit(True))
    links = pairs.filter(is_link).select("a", "b")
    lists = stage(best_lists(pairs, k))
    for _ in range(rounds):
        found = stage(refine(points, lists, width, k, threshold)).withColumn("fresh", F.lit(True))
        links = links.union(found.filter(is_link).select("a", "b"))
        lists = stage(best_lists(lists.withColumn("fresh", F.lit(False)).unionByName(found), k))
        if lists.filter("fresh").count() < SETTLED * n * k:
            break
    return lists, links


def _count_block(width: int, threshold: float):
    """Rows sorted by unit, the saturated before the members: the links between them, counted on both sides.

    A saturated member is counted where it stands on the first side.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit_at, first = None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("root", "i", "j")], axis=1)
            side, ids, copies = (batch.column(c).to_numpy().astype(np.int64) for c in ("side", "id", "copies"))
            full = batch.column("full").to_numpy(zero_copy_only=False).astype(bool)
            units = unit(matrix(batch.column("v"), width))
            starts = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(axis=1)))
            out: list[list] = [[], []]
            for low, high in zip(starts, np.append(starts[1:], len(ids)), strict=True):
                if unit_at != tuple(keys[low]):
                    unit_at, first = tuple(keys[low]), []
                middle = low + int(np.searchsorted(side[low:high], 1))
                if middle > low:
                    first.append((ids[low:middle], copies[low:middle], units[low:middle]))
                for at in range(middle, high, BLOCK):
                    second = slice(at, min(at + BLOCK, high))
                    for names, many, vectors in first:
                        near = (vectors @ units[second].T >= threshold) & (names[:, None] != ids[second][None, :])
                        out[0] += [names, ids[second][~full[second]]]
                        out[1] += [near @ copies[second], (many @ near)[~full[second]]]
            if out[0]:
                yield pa.record_batch([pa.array(np.concatenate(x).astype(np.int64)) for x in out], names=["id", "n"])

    return count


def enlarged_counts(points: DataFrame, width: int, threshold: float) -> DataFrame:
    """``id, n``: links, to all copies, of pairs in one component of which at least one side is saturated.

    ``points`` carry ``root``, whether they are saturated (``full``), and the numbers of their component's
    saturated points and of all its ``members``. Both are cut by a hash: saturated ones into blocks that a task
    holds, members into longer ones that stream past them.
    """
    blocks = (F.ceil(F.col("saturated") / F.lit(BLOCK)) - 1).cast("int")
    streams = (F.ceil(F.col("members") / F.lit(STREAM)) - 1).cast("int")
    every = lambda last: F.explode(F.sequence(F.lit(0), last))
    one = lambda last, seed: F.pmod(F.xxhash64("id", F.lit(seed)), last + 1).cast("int")
    held = points.filter("full").withColumn("i", one(blocks, 0)).withColumn("j", every(streams)).withColumn("side", F.lit(0))
    passing = points.withColumn("j", one(streams, 1)).withColumn("i", every(blocks)).withColumn("side", F.lit(1))
    units = held.unionByName(passing).select("root", "i", "j", "side", "id", "copies", "full", "v")
    ordered = units.repartition("root", "i", "j").sortWithinPartitions("root", "i", "j", "side")
    return ordered.mapInArrow(_count_block(width, threshold), "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def _brute_force(asked: pa.Table, width: int, threshold: float):
    """``a, b, n``: links of the asked vectors, where ``n`` is 1; those with a saturated side, inside a component, are only counted."""
    names, units = asked.column("id").to_numpy(), unit(matrix(asked.column("v"), width))
    roots, full = asked.column("root").to_numpy(), asked.column("full").to_numpy(zero_copy_only=False).astype(bool)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, BLOCK):
                rows = batch.slice(low, BLOCK)
                ids, root = rows.column("id").to_numpy(), rows.column("root").to_numpy()
                cosine = units @ unit(matrix(rows.column("v"), width)).T
                a, b = np.nonzero((cosine >= threshold) & (names[:, None] != ids[None, :]))
                there = rows.column("full").to_numpy(zero_copy_only=False).astype(bool)
                inside = (full[a] | there[b]) & (roots[a] == root[b])
                a, b, counted = a[~inside], b[~inside], int(inside.sum())
                columns = [pa.array([*x.tolist(), None], pa.int64()) for x in (names[a], ids[b])]
                yield pa.record_batch([*columns, pa.array([1] * len(a) + [counted], pa.int64())], names=["a", "b", "n"])

    return scan


def audit(points: DataFrame, classes: DataFrame, links: DataFrame, width: int, threshold: float, asked: int = AUDITED) -> tuple[float, int]:
    """The part of the true links of ``asked`` vectors picked by hash that was found, and how many links that judges.

    One scan compares them with all rows. A pair of one component with a saturated side counts as found. Without any true
    link the recall is 1, judged by 0 links.
    """
    placed = stage(points.select("id", "v").join(classes.select("id", "root", "full"), "id"))
    sample = placed.orderBy(F.xxhash64("id", F.lit(5)), "id").limit(asked).toArrow()  # at most ``asked`` rows
    if not sample.num_rows:
        return 1.0, 0
    true = stage(placed.select("id", "v", "root", "full").mapInArrow(_brute_force(sample, width, threshold + ROUNDING), "a long, b long, n long"))
    total = true.agg(F.sum("n")).first()[0]
    lost = true.filter("a is not null").select("a", "b").join(links, ["a", "b"], "left_anti").count()
    return (total - lost) / total if total else 1.0, total


def _classes(points: DataFrame, links: DataFrame, lists: DataFrame, threshold: float, k: int) -> DataFrame:
    """``id, root, full``: components, and whether the list is saturated, filled with links."""
    roots = connected_components(links.filter("a < b"), points.select("id"))
    held = lists.filter(F.col("cosine") >= threshold).groupBy(F.col("a").alias("id")).agg(F.count(F.lit(1)).alias("held"))
    return stage(roots.join(held, "id", "left").select("id", "root", (F.coalesce("held", F.lit(0)) >= k).alias("full")))


def near_duplicates(
    vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", threshold: float = 0.95, k: int = NEIGHBOURS, rounds: int = ROUNDS, seed: int = 1
) -> DataFrame:
    """``id, n_links, root`` of every row: linked other rows, and the smallest id reachable over links."""
    spark = vectors.sparkSession
    every = vectors.select(F.col(id).cast("bigint").alias("id"), F.col(vector).alias("v"))
    fit = F.col("id").isNotNull() & usable(F.col("v")) & F.coalesce(F.exists("v", lambda x: x != 0), F.lit(False))
    good = every.filter(fit)
    points = stage(good.groupBy("v").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies")))
    n, width = points.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("v")), F.lit(1))).first()
    links = spark.createDataFrame([], "a long, b long")
    for attempt in range(ATTEMPTS):
        lists, found = search(points, n, width, threshold, k, seed + attempt, rounds)
        links = stage(links.union(found).union(found.select("b", "a")).distinct())
        classes = _classes(points, links, lists, threshold, k)
        recall, judged = audit(points, classes, links, width, threshold)
        if recall >= RECALL:
            break
    else:
        raise RuntimeError(f"recall {recall:.4f} of {judged} audited links after {ATTEMPTS} searches, {RECALL} wanted")
    sizes = classes.groupBy("root").agg(F.count_if("full").alias("saturated"), F.count(F.lit(1)).alias("members")).filter("saturated > 0")
    inside = classes.join(sizes, "root").join(points, "id")
    roomy = classes.filter(~F.col("full")).select("id")
    pairs = links.join(roomy.withColumnRenamed("id", "a"), "a").join(roomy.withColumnRenamed("id", "b"), "b")
    sparse = pairs.join(points.select(F.col("id").alias("b"), "copies"), "b").groupBy(F.col("a").alias("id")).agg(F.sum("copies").alias("n"))
    counts = enlarged_counts(inside, width, threshold).unionByName(sparse).groupBy("id").agg(F.sum("n").alias("n"))
    solved = points.join(counts, "id", "left").join(classes, "id")
    solved = solved.select("v", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "root")
    rows = good.join(solved, "v").select("id", "n_links", "root")
    alone = every.filter(~fit)
    return rows.unionByName(alone.select("id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("root")))
