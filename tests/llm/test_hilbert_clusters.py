import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import hilbert_clusters as H
from tidemark.llm.queries import QUERIES

SCHEMA = "vec_id long, vector array<double>"


def brute(rows, clusters=8, rounds=10, dim=64, seed=3):
    """rows: (vec_id, vector). Plain integers throughout."""
    kept = [(i, [min(max(math.floor(1024 * x), -(1 << 62)), 1 << 62) for x in v]) for i, v in rows
            if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    rank = lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[0] or 0, np.array(r[1]).tobytes())
    centroids = [v for _, v in sorted(kept, key=rank)[:clusters]]
    away = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c))

    def assign():
        return [min((away(v, c), k) for k, c in enumerate(centroids)) for _, v in kept]

    for _ in range(rounds):
        of = assign()
        for k in range(len(centroids)):
            own = [v for (_, v), (_, c) in zip(kept, of) if c == k]
            if own:
                centroids[k] = [sum(x) // len(own) for x in zip(*own)]
    of, cut = assign(), lambda x: min(x, H.LARGEST)
    inertia = [sum(cut(d) for d, c in of if c == k) for k in range(len(centroids))]
    prints = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return [(i, c, cut(d), cut(inertia[c]), cut(sum(inertia)), prints[c]) for (i, _), (d, c) in zip(kept, of)]


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_given_table(spark, given):
    want = brute([(i, list(v)) for i, v in given("embeddings", "vec_id", "embedding")])
    assert rows_of(QUERIES["op12_hilbert_clusters"](spark, "/root/testdata/sf0.001")) == sorted(want, key=str)


def mixed(rng):
    rows = []
    for i in range(120):
        middle = rng.choice([-2.0, 0.0, 1.5])
        rows.append((i * 3, [rng.gauss(middle, 0.3) for _ in range(6)]))
    rows += [(1, None), (2, []), (4, [1.0] * 5), (5, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (7, [float("nan")] + [0.0] * 5), (8, [float("inf")] + [0.0] * 5), (10, [0.0] * 6)]
    return rows + [rows[3], rows[3]] + [(11, rows[5][1])] * 40 + [(None, rows[6][1]), (9, rows[8][1])]


@pytest.mark.parametrize("block, parts", [(1, 1), (7, 3), (500, 5)])
def test_odd_rows_and_any_dealing(spark, block, parts):
    rows = mixed(random.Random(4))
    table = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("z") for c in ("cluster", "place", "whole", "row", "hash")}).repartition(parts)
    got = H.cluster_vectors(table, clusters=5, rounds=4, dim=6, block=block)
    assert rows_of(got) == sorted(brute(rows, 5, 4, 6), key=str)


@pytest.mark.parametrize("scale", [1e4, 1e9, 1e14, 1e300])
def test_wide_values(spark, scale):
    rng = random.Random(6)
    rows = [(i, [rng.uniform(-1, 1) * (scale if rng.random() < 0.3 else 1) for _ in range(4)]) for i in range(40)]
    got = H.cluster_vectors(spark.createDataFrame(rows, SCHEMA), clusters=3, rounds=3, dim=4, block=8)
    assert rows_of(got) == sorted(brute(rows, 3, 3, 4), key=str)


def test_few_vectors_and_none(spark):
    rows = [(5, [1.0, 2.0]), (6, [1.0, 2.0]), (7, [9.0, -2.0])]
    assert rows_of(H.cluster_vectors(spark.createDataFrame(rows, SCHEMA), dim=2)) == sorted(brute(rows, dim=2), key=str)
    for none in ([], [(1, None)], [(1, [1.0])]):
        assert H.cluster_vectors(spark.createDataFrame(none, SCHEMA), dim=2).collect() == []


@pytest.mark.parametrize("dim, bits", [(2, 1), (2, 4), (3, 3), (4, 2)])
def test_the_curve_visits_every_cell_by_single_steps(dim, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dim, indexing="ij"), -1).reshape(-1, dim)
    keys = H.hilbert_keys(cells, bits)
    order = sorted(range(len(cells)), key=lambda k: keys[k].tobytes())
    assert len({k.tobytes() for k in keys}) == len(cells)
    assert (np.abs(np.diff(cells[order], axis=0)).sum(1) == 1).all()


def test_bounds_never_lose_the_nearest():
    rng = np.random.default_rng(1)
    fewer = 0
    for k in range(300):
        wide = 1 << 40 if k % 3 == 0 else 1
        centroids = rng.integers(-50, 50, (6, 5)) * wide
        rows = rng.integers(-60, 60, (9, 5)) // rng.integers(1, 30) * wide
        away = ((rows[:, None].astype(object) - centroids) ** 2).sum(2)
        found = H.candidates(rows.min(0), rows.max(0), centroids)
        assert {int(c) for row in away for c in np.flatnonzero(row == row.min())} <= set(found.tolist())
        chosen, distance = H.nearest(rows, centroids, found)
        assert [(int(np.argmin(r)), int(min(r.min(), H.LARGEST))) for r in away] == list(zip(chosen.tolist(), distance.tolist()))
        fewer += len(found) < 6
    assert fewer > 100
