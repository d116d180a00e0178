"""Nearest neighbours by inner product with a forest of hash prefixes.

Vectors are dealt to shards of about ``SHARD`` rows, queries to blocks. A task holds one shard's forest: in each tree, the vectors'
hash strings (signs of random projections) in sorted order. A query descends to the longest prefix of its own string
found in each tree, then all trees ascend together, one bit at a time, until the ranges below the prefixes hold enough
candidates. Candidates are compared by their original vectors, and the best of each shard meet by query.

Lengths of vectors are evened out for hashing with one more component (the inner product order of the originals is then the
angle order), by the longest vector of the shard.

The share of a shard to gather is what recall costs on the data at hand: the given vectors are close to uniform over the sphere, where no
prefix tells near from far well, and 0.9 of the true neighbours need most of a shard. Clustered vectors need far less.

Defined cases: vectors that are null, empty, zero or hold a null or non-finite component, and rows without vec_id, take no part; vectors
of different lengths are never compared; rows equal in vec_id and vector are one; rows with the query's vec_id are not its neighbours;
equal scores go to the smaller vec_id; fewer candidates than asked for are all returned; further columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.frames import arrays
from tidemark.llm.scratch import parts
from tidemark.llm.text import column

NEAREST = 20
TREES = 32
BITS = 32
SHARE = 1.0  # entries to gather before the ascent ends, over all trees, as a share of the shard's rows
SHARD = 8192
BLOCK = 4096
SEED = 17


class Forest:
    """Sorted arrays of hash strings, one per tree, over the rows of a matrix."""

    def __init__(self, vectors: np.ndarray, trees: int = TREES, bits: int = BITS):
        self.vectors, self.bits = vectors, bits
        norms = (vectors * vectors).sum(1)
        rest = np.sqrt(np.maximum(0, norms.max(initial=0) - norms))
        self.planes = np.random.default_rng(SEED).standard_normal((trees, bits, vectors.shape[1] + 1))
        strings = self.strings(np.concatenate([vectors, rest[:, None]], 1))
        self.order = np.argsort(strings, axis=1, kind="stable")
        self.sorted = np.take_along_axis(strings, self.order, 1)

    def strings(self, extended: np.ndarray) -> np.ndarray:
        """By tree and row, the signs as an integer, first plane highest."""
        out = np.zeros((len(self.planes), len(extended)), np.uint64)
        for k, planes in enumerate(self.planes):
            for plane in planes:
                out[k] = out[k] << np.uint64(1) | (extended @ plane > 0)
        return out

    def ranges(self, strings: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """By tree and query, the places of the entries that share the first ``depth`` bits."""
        free = np.uint64(self.bits - depth)
        low = strings >> free << free
        high = low | ((np.uint64(1) << free) - np.uint64(1))
        return (np.stack([np.searchsorted(s, x, "left") for s, x in zip(self.sorted, low)]),
                np.stack([np.searchsorted(s, x, "right") for s, x in zip(self.sorted, high)]))

    def deepest(self, strings: np.ndarray) -> int:
        """The longest prefix that any query shares with a neighbour in sorted order."""
        best = 0
        for s, x in zip(self.sorted, strings):
            at = np.searchsorted(s, x)
            for near in (np.maximum(at - 1, 0), np.minimum(at, len(s) - 1)):
                differ = int((s[near] ^ x).min(initial=(1 << self.bits) - 1))
                best = max(best, self.bits - differ.bit_length())
        return best

    def candidates(self, queries: np.ndarray, enough: int) -> Iterator[np.ndarray]:
        """Rows gathered for each query."""
        strings = self.strings(np.concatenate([queries, np.zeros((len(queries), 1))], 1))
        first = np.zeros(strings.shape, np.int64)
        end, open_queries = first.copy(), np.arange(strings.shape[1])
        for depth in range(self.deepest(strings), -1, -1):
            low, high = self.ranges(strings[:, open_queries], depth)
            first[:, open_queries], end[:, open_queries] = low, high
            open_queries = open_queries[(high - low).sum(0) < enough]
            if not len(open_queries):
                break
        for q in range(strings.shape[1]):
            mark = np.zeros(len(self.vectors), bool)
            for order, a, z in zip(self.order, first[:, q], end[:, q]):
                mark[order[a:z]] = True
            yield np.flatnonzero(mark)


def first_of_each(ids: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Places of the distinct (id, vector); ids are compared as the 64-bit integers they are."""
    by = np.lexsort([*vectors.T, ids])
    same = (ids[by][1:] == ids[by][:-1]) & (vectors[by][1:] == vectors[by][:-1]).all(1)
    return by[np.concatenate([np.ones(min(1, len(by)), bool), ~same])]


def search(batches: Iterator[pa.RecordBatch], nearest: int, trees: int, bits: int, share: float) -> Iterator[pa.RecordBatch]:
    """Rows by (dim, shard, block), the indexed vectors before the queries: the best of the shard for each query."""
    where, ids, rows, forest = None, [], [], None
    for batch in batches:
        keys = list(zip(*(column(batch, c).to_pylist() for c in ("dim", "shard", "block", "asks"))))
        cells = column(batch, "vector")
        flat = cells.flatten().to_numpy().astype(np.float64)
        ends = np.cumsum([k[0] for k in keys])
        own = column(batch, "vec_id").to_numpy()
        edge = [0, *(k for k in range(1, len(keys)) if keys[k] != keys[k - 1]), len(keys)]
        for a, z in zip(edge[:-1], edge[1:]):
            dim, shard, block, asks = keys[a]
            part = flat[ends[a] - dim:ends[z - 1]].reshape(-1, dim)
            if where != (dim, shard, block):
                where, ids, rows, forest = (dim, shard, block), [], [], None
            if not asks:
                ids.append(own[a:z])
                rows.append(part)
                continue
            if not rows:
                continue
            if forest is None:
                both = np.concatenate(ids)
                vectors = np.concatenate(rows)
                new = first_of_each(both, vectors)
                ids, rows = [both[new]], [vectors[new]]
                forest = Forest(rows[0], trees, bits)
            enough = max(int(share * len(rows[0])), (nearest + 1) * trees)
            for at in range(a, z, 256):
                some = part[at - a:min(at + 256, z) - a]
                out = []
                for query_id, query, found in zip(own[at:z].tolist(), some, forest.candidates(some, enough)):
                    found = found[ids[0][found] != query_id]
                    score = (rows[0][found] * query).sum(1)  # row by row: equal vectors have equal scores
                    best = np.lexsort((ids[0][found], -score))[:nearest]
                    out.append((np.full(len(best), query_id), np.full(len(best), zlib.crc32(query.tobytes())), ids[0][found][best], score[best]))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out)], names=["query_id", "query_key", "vec_id", "score"])


def usable(vector: str) -> Column:
    parts_ok = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce((F.size(vector) > 0) & parts_ok & F.exists(vector, lambda x: x != 0), F.lit(False))


def nearest_neighbours(
    vectors: DataFrame, queries: DataFrame, nearest: int = NEAREST, trees: int = TREES, bits: int = BITS, share: float = SHARE, shard: int = SHARD, block: int = BLOCK,
) -> DataFrame:
    """query_id, rank, vec_id and score of the neighbours found among ``vectors`` (vec_id, vector) for each of ``queries``."""
    def ready(df: DataFrame) -> DataFrame:
        return df.select("vec_id", F.col("vector").cast("array<double>")).filter(F.col("vec_id").isNotNull() & usable("vector")).withColumn("dim", F.size("vector"))

    indexed, asking = ready(vectors), ready(queries)
    pieces = lambda df, size: max(1, -(-df.count() // size))
    shards, blocks = pieces(indexed, shard), pieces(asking, block)
    spread = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    work = indexed.select("dim", spread(shards).alias("shard"), every(blocks).alias("block"), F.lit(0).alias("asks"), "vec_id", "vector").unionByName(
        asking.select("dim", every(shards).alias("shard"), spread(blocks).alias("block"), F.lit(1).alias("asks"), "vec_id", "vector"))
    n = max(parts(vectors.sparkSession), shards)
    found = arrays(
        work.repartition(n, "dim", "shard", "block").sortWithinPartitions("dim", "shard", "block", "asks"), "query_id long, query_key long, vec_id long, score double",
        partial(search, nearest=nearest, trees=trees, bits=bits, share=share))
    order = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id")
    return found.distinct().withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= nearest).select("query_id", "rank", "vec_id", "score")
