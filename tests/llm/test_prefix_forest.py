import os

import numpy as np
import pytest

from tidemark.llm import prefix_forest as P
from tidemark.llm.queries import QUERIES


def brute(rows, query_ids, nearest=20):
    ids, vectors = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], np.float64)
    for q in query_ids:
        score = (vectors * vectors[ids == q][0]).sum(1)
        by = [k for k in np.lexsort((ids, -score)) if ids[k] != q][:nearest]
        yield q, [(int(ids[k]), float(score[k])) for k in by]


def found(df):
    out = {}
    for r in sorted(map(tuple, df.select("query_id", "rank", "vec_id", "score").collect())):
        out.setdefault(r[0], []).append((r[2], r[3]))
        assert r[1] == len(out[r[0]])
    return out


def test_recall_on_given_vectors(spark):
    where = "/root/testdata/sf0.1"
    if not os.path.isdir(where):
        pytest.skip("benchmark tables not present")
    rows = [tuple(r) for r in spark.read.parquet(f"{where}/embeddings.parquet").select("vec_id", "embedding").collect()]
    got = found(QUERIES["op6_prefix_forest"](spark, where))
    want = dict(brute(rows, [r[0] for r in rows if r[0] % 20 == 0]))
    assert got.keys() == want.keys()
    scores = {q: dict(w) for q, w in brute(rows, list(want), len(rows))}
    hit = sum(len({v for v, _ in got[q]} & {v for v, _ in want[q]}) for q in want) / sum(map(len, want.values()))
    assert hit >= 0.9
    for q, row in got.items():
        assert len(row) == 20 and row == sorted(row, key=lambda x: (-x[1], x[0]))
        assert all(abs(scores[q][v] - s) < 1e-12 for v, s in row)


def test_several_shards_and_blocks_with_all_candidates(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.standard_normal(6) * rng.uniform(0.1, 4)]) for i in range(300)]
    rows += [(300 + i, rows[5][1]) for i in range(30)]  # ties
    df = spark.createDataFrame(rows, "vec_id long, vector array<double>")
    got = found(P.nearest_neighbours(df, df.filter("vec_id % 3 = 0"), share=100.0, shard=40, block=17))
    want = dict(brute(rows, [r[0] for r in rows if r[0] % 3 == 0]))
    assert {q: [v for v, _ in x] for q, x in got.items()} == {q: [v for v, _ in x] for q, x in want.items()}


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 1.0]), (1, [1.0, 1.0]), (2, None), (3, []), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]),
            (None, [1.0, 1.0]), (20, [1.0, 2.0, 3.0]), (40, [1.0, 0.0]), (60, None)]
    df = spark.createDataFrame(rows, "vec_id long, vector array<float>")
    got = found(P.nearest_neighbours(df, df.filter("vec_id % 20 = 0")))
    assert got == {0: [(1, 1.0), (40, 1.0)], 40: [(0, 1.0), (1, 1.0)]}
    assert P.nearest_neighbours(df.limit(0), df).count() == 0 and P.nearest_neighbours(df, df.limit(0)).count() == 0


def test_ascent_is_synchronous():
    rng = np.random.default_rng(2)
    vectors = rng.standard_normal((500, 8))
    forest = P.Forest(vectors, 4, 16)
    strings = forest.strings(np.concatenate([vectors[:20], np.zeros((20, 1))], 1))
    for q, rows in enumerate(forest.candidates(vectors[:20], 60)):
        for depth in range(16, -1, -1):
            low, high = forest.ranges(strings[:, q:q + 1], depth)
            if (high - low).sum() >= 60:
                break
        want = {int(r) for o, a, z in zip(forest.order, low[:, 0], high[:, 0]) for r in o[a:z]}
        assert set(rows.tolist()) == want


def test_ids_beyond_the_integers_of_a_double_stay_apart(spark):
    ids = [20, *((1 << 53) + k for k in range(1, 5)), (1 << 62) + 1, (1 << 62) + 2]
    vectors = spark.createDataFrame([(i, [1.0, 2.0]) for i in ids + ids[:2]], "vec_id long, vector array<double>")
    got = found(P.nearest_neighbours(vectors, vectors.filter("vec_id = 20")))
    assert got == {20: [(i, 5.0) for i in sorted(ids[1:])]}
