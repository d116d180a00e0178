"""Centroid clustering in exact integers, over blocks of vectors that lie along a Hilbert curve.

1. Vectors become integers, floor(1024 x). Their place on a Hilbert curve through all dimensions (``hilbert_keys``) orders them, so that
   consecutive vectors are close; runs of ``BLOCK`` of them are stored as blocks with the smallest and largest value of every component.
2. ``candidates`` bounds the distance of every centroid from a block's box. A centroid whose least distance is beyond the greatest one of
   another, or that is farther than the best one from every corner of the box, can be nearest to no vector of the block. The others are
   candidates; one candidate takes the block unseen, among several every vector is compared with each, all at once.
3. A round sums its blocks' vectors by cluster within tasks, then across them; only clusters x components numbers reach the driver, which divides
   them exactly. If a round changes no centroid, neither would any later one, and the rounds end.

All numbers are whole. While |value| <= 2^22 the sums fit the 53 bits of a double and matrix products are exact; blocks and centroids beyond
that are reckoned in Python integers. Results are the same on any partitioning.

Defined cases: a null vector, one of another length, or one with a null, NaN or infinite component takes no part; values beyond +-2^62
are cut to that, and a distance or sum of distances beyond 2^63 - 1 is returned as that; rows are vectors, so repeated rows count each; a
row without vec_id is clustered but starts no centroid unless there are too few others; of rows that share a vec_id the lesser vector comes first among starts;
with fewer vectors than clusters there is a centroid for each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.frames import arrays
from tidemark.llm.scratch import parts, written
from tidemark.llm.text import column, pack

SCALE, DIM, CLUSTERS, ROUNDS, SEED = 1024, 64, 8, 10, 3
BLOCK = 64  # vectors of a block
CURVE_BITS = 4  # bits of a component in the place on the curve
WIDEST = 1 << 62
EXACT = 1 << 22  # 64 products of differences of such values stay below 2**53
LARGEST = (1 << 63) - 1


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places of grid cells (rows of small integers) on a Hilbert curve, as rows of bytes that sort like them.

    After J. Skilling, "Programming the Hilbert curve" (2004): rotations and reflections of the subcubes are undone from the coarsest bit
    to the finest, then the coordinates' Gray code is resolved; the bits, coarsest first, taken in turn from all coordinates, are the place.
    """
    x = cells.astype(np.uint32).T.copy()
    for level in range(bits - 1, 0, -1):
        low = np.uint32((1 << level) - 1)
        for i in range(len(x)):
            inside = (x[i] >> np.uint32(level)) & np.uint32(1) == 1
            swapped = np.where(inside, 0, (x[0] ^ x[i]) & low).astype(np.uint32)
            x[0] ^= np.where(inside, low, swapped).astype(np.uint32)
            x[i] ^= swapped
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], np.uint32)
    for level in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] >> np.uint32(level)) & np.uint32(1) == 1, np.uint32((1 << level) - 1), np.uint32(0))
    x ^= turn
    planes = [(x >> np.uint32(b)) & np.uint32(1) for b in range(bits - 1, -1, -1)]
    return np.packbits(np.concatenate(planes).T.astype(np.uint8), axis=1)


def whole(values: np.ndarray) -> np.ndarray:
    """The largest integers not above 1024 x; a power of two times a double is exact."""
    return np.floor(np.clip(values * float(SCALE), -float(WIDEST), float(WIDEST))).astype(np.int64)


def to_integers(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[pa.RecordBatch]:
    """(vec_id, least, most, whole): integers of the vectors that take part, as bytes, with the least and the largest of them."""
    for batch in batches:
        cells = column(batch, "vector")
        flat = cells.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        rows = whole(flat.reshape(-1, dim))
        yield pa.RecordBatch.from_arrays([
            column(batch, "vec_id"), pa.array(rows.min(1)), pa.array(rows.max(1)), pack(rows.ravel(), np.arange(len(rows) + 1) * dim)], names=["vec_id", "least", "most", "whole"])


def matrix(cells: pa.Array, dim: int, dtype=np.int64) -> np.ndarray:
    return np.frombuffer(b"".join(cells.to_pylist()), dtype).reshape(-1, dim)


def place_on_curve(batches: Iterator[pa.RecordBatch], dim: int, least: int, most: int, bits: int) -> Iterator[pa.RecordBatch]:
    """Adds ``place``: the grid spans all values, from the least to the largest."""
    width = (most - least + 1) / (1 << bits)
    for batch in batches:
        rows = matrix(column(batch, "whole"), dim)
        cells = np.clip((rows.astype(np.float64) - least) / width, 0, (1 << bits) - 1).astype(np.uint32)
        keys = hilbert_keys(cells, bits)
        place = pack(keys.ravel(), np.arange(len(rows) + 1) * keys.shape[1])
        yield pa.RecordBatch.from_arrays([column(batch, "vec_id"), place, column(batch, "whole")], names=["vec_id", "place", "whole"])


BLOCKS_DDL = "ids array<long>, low binary, high binary, vectors binary"


def make_blocks(batches: Iterator[pa.RecordBatch], dim: int, size: int) -> Iterator[pa.RecordBatch]:
    """Runs of rows as blocks with their boxes."""
    for batch in batches:
        rows = matrix(column(batch, "whole"), dim)
        edge = np.append(np.arange(0, len(rows), size), len(rows))
        low, high = (f.reduceat(rows, edge[:-1], axis=0) for f in (np.minimum, np.maximum))
        each = np.arange(len(edge)) * dim
        ids = column(batch, "vec_id")
        yield pa.RecordBatch.from_arrays([
            pa.ListArray.from_arrays(pa.array(edge.astype(np.int32)), ids), pack(low.ravel(), each), pack(high.ravel(), each), pack(rows.ravel(), edge * dim),
        ], names=["ids", "low", "high", "vectors"])


def numbers(*values: np.ndarray) -> list[np.ndarray]:
    """As doubles if all that is reckoned from them is exact, else as Python integers."""
    kind = np.float64 if all(np.abs(v).max(initial=0) <= EXACT for v in values) else object
    return [v.astype(kind) for v in values]


def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """The centroids that can be nearest to a vector in the box; of equally near ones all."""
    low, high, c = numbers(low, high, centroids)
    near = np.minimum(np.maximum(c, low), high)
    far = np.where(np.abs(c - low) > np.abs(c - high), low, high)
    least, most = ((c - near) ** 2).sum(1), ((c - far) ** 2).sum(1)
    found = np.flatnonzero(least <= most.min())
    # |x - b|^2 - |x - c|^2 is linear in x: its largest value over the box is at a corner.
    best = c[np.argmin(most)]
    apart = c[found] - best
    corner = np.where(apart > 0, high, low)
    lead = (best ** 2).sum() - (c[found] ** 2).sum(1) + 2 * (corner * apart).sum(1)
    return found[lead >= 0]


def nearest(rows: np.ndarray, centroids: np.ndarray, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each row the nearest of some centroids, the smallest number of equally near ones, and the squared distance."""
    v, c = numbers(rows, centroids[among])
    if v.dtype == object:
        away = np.stack([((v - x) ** 2).sum(1) for x in c], 1)
    else:
        away = (v ** 2).sum(1)[:, None] - 2 * (v @ c.T) + (c ** 2).sum(1)
    chosen = np.argmin(away, 1)
    found = away[np.arange(len(rows)), chosen]
    return among[chosen], np.array([min(int(d), LARGEST) for d in found], np.int64) if v.dtype == object else found.astype(np.int64)


def blocks_of(batches: Iterator[pa.RecordBatch], dim: int, centroids: np.ndarray) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]]:
    """Of every block: ids, vectors, candidates' choice for each vector, squared distance."""
    for batch in batches:
        low, high = matrix(column(batch, "low"), dim), matrix(column(batch, "high"), dim)
        ids, vectors = column(batch, "ids"), column(batch, "vectors")
        for k in range(batch.num_rows):
            rows = np.frombuffer(vectors[k].as_buffer(), np.int64).reshape(-1, dim)
            yield ids[k].values, rows, *nearest(rows, centroids, candidates(low[k], high[k], centroids))


SUMS_DDL = "cluster int, place int, total decimal(38,0)"


def sum_blocks(batches: Iterator[pa.RecordBatch], dim: int, centroids: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One row for each cluster and component of a task, and one with the number of vectors in place ``dim``."""
    totals = np.zeros((len(centroids), dim + 1), object)
    for _, rows, cluster, _ in blocks_of(batches, dim, centroids):
        rows = numbers(rows)[0]
        for c in np.unique(cluster):
            own = rows[cluster == c]
            totals[c, :dim] += np.array([int(x) for x in own.sum(0)], object)
            totals[c, dim] += len(own)
    full = [(c, d, int(totals[c, d])) for c in range(len(centroids)) if totals[c, dim] for d in range(dim + 1)]
    cluster, place, total = zip(*full) if full else ((), (), ())
    yield pa.RecordBatch.from_arrays(
        [pa.array(cluster, pa.int32()), pa.array(place, pa.int32()), pa.array([*map(int, total)], pa.decimal128(38))], names=["cluster", "place", "total"])


def assign_blocks(batches: Iterator[pa.RecordBatch], dim: int, centroids: np.ndarray) -> Iterator[pa.RecordBatch]:
    for ids, _, cluster, distance in blocks_of(batches, dim, centroids):
        yield pa.RecordBatch.from_arrays([ids, pa.array(cluster.astype(np.int32)), pa.array(distance)], names=["vec_id", "cluster", "distance"])


def hilbert_blocks(vectors: DataFrame, dim: int = DIM, size: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """Integers of the vectors (vec_id, vector) that take part, and the blocks of them along the curve."""
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    ready = vectors.select(F.col("vec_id").cast("long"), F.col("vector").cast("array<double>")).filter(F.coalesce((F.size("vector") == dim) & finite, F.lit(False)))
    rows = written(arrays(ready, "vec_id long, least long, most long, whole binary", partial(to_integers, dim=dim)), "cluster-vectors")
    least, most = rows.agg(F.min("least"), F.max("most")).first()
    placed = rows.select("vec_id", "whole")
    if least is None:
        return placed, arrays(placed, BLOCKS_DDL, partial(make_blocks, dim=dim, size=size))
    placed = written(arrays(placed, "vec_id long, place binary, whole binary", partial(place_on_curve, dim=dim, least=least, most=most, bits=CURVE_BITS)), "cluster-places")
    # Repeated vectors share a place, repeated rows an id as well: the last key deals these out too.
    keyed = placed.withColumn("row", F.monotonically_increasing_id())
    ordered = keyed.repartitionByRange(parts(vectors.sparkSession), "place", "vec_id", "row").sortWithinPartitions("place", "vec_id", "row")
    return placed, written(arrays(ordered.select("vec_id", "whole"), BLOCKS_DDL, partial(make_blocks, dim=dim, size=size)), "cluster-blocks")


def first_centroids(rows: DataFrame, clusters: int, dim: int, seed: int) -> np.ndarray:
    """The vectors whose ids have the smallest hashes, in the order of the hashes."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    start = rows.select(order.alias("hash"), "vec_id", "whole").orderBy(F.asc_nulls_last("hash"), "vec_id", "whole").limit(clusters).collect()
    return np.frombuffer(b"".join(r["whole"] for r in start), np.int64).reshape(-1, dim)


def fit(rows: DataFrame, blocks: DataFrame, clusters: int, rounds: int, dim: int, seed: int) -> np.ndarray:
    """The centroids after the rounds."""
    centroids = first_centroids(rows, clusters, dim, seed)
    for _ in range(rounds if len(centroids) else 0):
        sums = arrays(blocks.select("low", "high", "ids", "vectors"), SUMS_DDL, partial(sum_blocks, dim=dim, centroids=centroids))
        total = {(r["cluster"], r["place"]): int(r["total"]) for r in sums.groupBy("cluster", "place").agg(F.sum("total").alias("total")).collect()}
        moved = centroids.copy()
        for c in range(len(centroids)):
            if count := total.get((c, dim)):
                moved[c] = [total[c, d] // count for d in range(dim)]
        if (moved == centroids).all():
            break
        centroids = moved
    return centroids


def cluster_vectors(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, dim: int = DIM, seed: int = SEED, block: int = BLOCK) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 for the vectors (vec_id, vector) that take part."""
    rows, blocks = hilbert_blocks(vectors, dim, block)
    centroids = fit(rows, blocks, clusters, rounds, dim, seed)
    assigned = written(arrays(blocks, "vec_id long, cluster int, distance long", partial(assign_blocks, dim=dim, centroids=centroids)), "cluster-rows")
    sums = {r["cluster"]: int(r["s"]) for r in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).cast("decimal(38,0)").alias("s")).collect()}
    known = [
        (c, min(s, LARGEST), min(sum(sums.values()), LARGEST), hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest())
        for c, s in sums.items()]
    of = vectors.sparkSession.createDataFrame(known, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(of), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
