"""SimHash near-dedup by a segment-popcount embedding.

Texts become 64-bit fingerprints of their word shingles. A fingerprint is mapped to the bit counts
of its 32 two-bit segments, a point of a grid with 32 axes. The Manhattan distance of two points is
a lower bound of the number of bits in which the fingerprints differ. Points within Manhattan
distance 3 agree exactly on at least 3 of 6 groups of axes, as each unit of distance can spoil one
group; so a range join over the 20 choices of 3 groups meets every such pair in a grid cell. In a
cell the bound is tested first, then the fingerprints themselves.

Only distinct fingerprints take part, so copies cost nothing. A cell gives a spanning forest of its
links, never all pairs; a crowded cell is cut into blocks, and every two blocks meet in a task of
their own. All of it is exact: no cell, bucket or partner is capped.

Nulls and texts without words have fingerprint 0 and are linked like any other. Repeated ids and
texts, ties and empty tables need no special rule. A row without an id takes no part in the search: it
has its fingerprint and no root, and is kept. Columns other than id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gazetick.llm.common import fresh, small_batches
from gazetick.plans.components import connected_components
from gazetick.session import stage

WORDS_PER_SHINGLE = 3
BITS_APART = 3
HASH_SEED = 42
#: Bits of the six groups of axes; an axis is a segment of two neighbouring bits.
GROUPS = ((0, 12), (12, 24), (24, 34), (34, 44), (44, 54), (54, 64))
#: Distinct fingerprints of a cell that one task takes at once.
BLOCK = 2048
#: Shingles whose bits are counted at once.
SLICE = 1 << 16
LOW_BITS = 0x5555555555555555


def fingerprint(text: str | None, words_per_shingle: int = WORDS_PER_SHINGLE) -> int:
    """64-bit SimHash; a bit is set if it is set in over half the shingles' hashes."""
    import xxhash

    words = (text or "").encode().lower().split()  # on bytes: A-Z only, and the six ASCII blanks
    if not words:
        return 0
    n = max(1, len(words) - words_per_shingle + 1)
    counts = np.zeros(64, np.int64)
    for start in range(0, n, SLICE):
        hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + words_per_shingle]), HASH_SEED) for i in range(start, min(n, start + SLICE))]
        bits = np.unpackbits(np.array(hashes, ">u8").view(np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big")


@F.arrow_udf(T.LongType())
def fingerprint_column(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for texts in batches:
        prints = np.array([fingerprint(t.as_py()) for t in texts], np.uint64)
        yield pa.array(prints.view(np.int64))


def segment_counts(fp: Column) -> Column:
    """Bit counts of the two-bit segments, each in the place of its segment."""
    low, high = fp, F.shiftrightunsigned(fp, 1)
    ones = low.bitwiseXOR(high).bitwiseAND(F.lit(LOW_BITS))
    twos = low.bitwiseAND(high).bitwiseAND(F.lit(LOW_BITS))
    return ones.bitwiseOR(F.shiftleft(twos, 1))


def grid_cells() -> Column:
    """The cells of a point ``_e``: its coordinates on three of the six groups of axes."""
    cells = []
    for number, chosen in enumerate(combinations(GROUPS, 3)):
        mask = sum((1 << high) - (1 << low) for low, high in chosen)
        signed = mask - (1 << 64) if mask >> 63 else mask
        cells.append(F.struct(F.lit(number).alias("_c"), F.col("_e").bitwiseAND(F.lit(signed)).alias("_k")))
    return F.explode(F.array(*cells))


def manhattan(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Manhattan distance of packed segment counts (0, 1 or 2 in every two bits)."""
    low = np.uint64(LOW_BITS)
    one = np.uint64(1)
    # A two-bit difference is 1 where exactly one side is 1, and 2 where the sides are 0 and 2.
    odd = (a ^ b) & low
    two = ((a ^ b) >> one) & low & ~odd
    return np.bitwise_count(odd) + 2 * np.bitwise_count(two).astype(np.int64)


def forest(prints: np.ndarray, points: np.ndarray, near: int = BITS_APART) -> list[tuple[int, int]]:
    """Links (as places) that join exactly what the links of all pairs would join."""
    links = []
    rest = np.arange(len(prints))
    while rest.size:
        front, rest = [rest[0]], rest[1:]
        while front and rest.size:
            at = front.pop()
            possible = manhattan(points[at], points[rest]) <= near
            hit = np.zeros(rest.size, bool)
            hit[possible] = np.bitwise_count(prints[at] ^ prints[rest[possible]]) <= near
            links += [(at, other) for other in rest[hit]]
            front += list(rest[hit])
            rest = rest[~hit]
    return links


def _links_of_runs(starts: np.ndarray, end: int, prints: np.ndarray, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the links of all runs; a run goes from its start to the next one's."""
    sizes = np.diff(np.append(starts, end))
    first = starts[sizes == 2]
    first = first[manhattan(points[first], points[first + 1]) <= BITS_APART]
    first = first[np.bitwise_count(prints[first] ^ prints[first + 1]) <= BITS_APART]
    left, right = [first], [first + 1]
    for low, size in zip(starts[sizes > 2], sizes[sizes > 2], strict=True):
        if links := forest(prints[low : low + size], points[low : low + size]):
            a, b = np.array(links).T
            left.append(a + low)
            right.append(b + low)
    return np.concatenate(left), np.concatenate(right)


def _cell_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of runs of equal ``_c, _k, _i, _j``; the rows come sorted by these."""
    names = ("_c", "_k", "_i", "_j", "fp", "_e", "rep")
    data = [np.empty(0, np.int64)] * len(names)
    ended = False
    batches = iter(batches)
    while not ended:
        batch = next(batches, None)
        ended = batch is None
        if not ended:
            data = [np.concatenate([kept, batch.column(c).to_numpy().astype(np.int64)]) for kept, c in zip(data, names, strict=True)]
        rows = len(data[0])
        if not rows:
            continue
        fresh = np.zeros(rows - 1, bool)
        for key in data[:4]:
            fresh |= key[1:] != key[:-1]
        starts = np.concatenate([[0], np.flatnonzero(fresh) + 1])
        end = rows if ended else starts[-1]  # the last run may go on in the next batch
        starts = starts if ended else starts[:-1]
        a, b = _links_of_runs(starts, end, data[4].view(np.uint64), data[5].view(np.uint64))
        yield pa.record_batch([pa.array(data[6][a]), pa.array(data[6][b])], names=["a", "b"])
        data = [d[end:] for d in data]


def near_links(points: DataFrame, block: int = BLOCK) -> DataFrame:
    """``a, b``: links between representatives; ``points``: distinct ``fp`` with its ``rep``."""
    placed = points.withColumn("_e", segment_counts(F.col("fp")))
    cells = placed.select("fp", "_e", "rep", grid_cells().alias("_g")).select("fp", "_e", "rep", "_g.*")
    shared = placed.select(grid_cells().alias("_g")).select("_g.*").groupBy("_c", "_k").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    met = cells.join(shared, ["_c", "_k"])
    last = (F.ceil(F.col("_n") / F.lit(block)) - 1).cast("int")
    own = F.pmod(F.xxhash64("fp"), last + 1).cast("int")
    met = met.withColumn("_own", own).withColumn("_other", F.explode(F.sequence(F.lit(0), last)))
    met = met.select("_c", "_k", F.least("_own", "_other").alias("_i"), F.greatest("_own", "_other").alias("_j"), "fp", "_e", "rep")
    units = met.repartition("_c", "_k", "_i", "_j").sortWithinPartitions("_c", "_k", "_i", "_j")
    return units.mapInArrow(_cell_links, "a long, b long").distinct()


def fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, fp``, one row per row of ``docs``."""
    small_batches(docs.sparkSession)
    return docs.select(F.col(id).alias("id"), fingerprint_column(F.col(text)).alias("fp"))


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, fp, root``: root is the smallest id reachable over links, itself included; null without an id."""
    prints = stage(fingerprints(docs, id, text))
    named, nameless = prints.filter("id is not null"), prints.filter("id is null")
    points = stage(named.groupBy("fp").agg(F.min("id").alias("rep")))
    links = stage(near_links(points))
    roots = connected_components(links, points.select(F.col("rep").alias("id")))
    classes = points.join(roots, points.rep == roots.id).select("fp", "root")
    alone = nameless.select("id", "fp", F.lit(None).cast(prints.schema["id"].dataType).alias("root"))
    return named.join(classes, "fp").select("id", "fp", "root").unionByName(alone)


def keep_one(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The document with the smallest id of every group, columns unchanged, and all documents without an id.

    Rows that share that id stay if their texts differ; of rows with one id and text the first by their
    other columns stays.
    """
    kept = near_duplicates(docs, id, text).filter("id = root").select(F.col("id").alias(id)).distinct()
    named = docs.join(kept, id, "left_semi")
    digest, row = fresh(docs, "_digest"), fresh(docs, "_row")
    others = F.to_json(F.struct(F.lit(0).alias("_"), *[c for c in docs.columns if c not in (id, text)]))
    alike = named.withColumn(digest, F.sha2(text, 256)).groupBy(id, digest).agg(F.min_by(F.struct(*docs.columns), others).alias(row))
    return alike.select(*[F.col(row)[c].alias(c) for c in docs.columns]).unionByName(docs.filter(F.col(id).isNull()))
