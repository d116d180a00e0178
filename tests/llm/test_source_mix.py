"""Taken words against targets: by exhaustive choice on small tables, and against the smallest document left on skewed ones."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from tidemark.llm import source_mix as M


def mixed(spark, sizes, share=1.5, copies=2, seed=7):
    """sizes: {source: sizes of its documents}. For each source: target, and (size, copies) of its documents."""
    rows = [(i, s, n) for i, (s, n) in enumerate((s, n) for s, group in sizes.items() for n in group)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, n long")
    out = M.mix_sources(docs, F.array("source"), F.col("n"), (3, 1, 2), share, copies, seed, F.col("doc_id"))
    found = {}
    for r in out.collect():
        target, own = found.setdefault(r.source, (r.mix_target, []))
        own.append((r.n, r.mix_copies))
    return found


def distance(target, own):
    return abs(sum(n * c for n, c in own) - target)


@pytest.mark.parametrize("seed", [1, 2])
def test_one_very_long_document_among_short_ones(spark, seed):
    """Reachable exactly, whether the long document is met early or late."""
    found = mixed(spark, {"a": [10_000] + [10] * 1000}, seed=seed)
    assert distance(*found["a"]) < 10
    assert {c for _, c in found["a"][1]} == {1, 2}


def test_what_is_left_open_is_smaller_than_any_document_left(spark):
    rng = random.Random(4)
    sizes = {f"s{k}": [max(1, int(rng.paretovariate(0.8) * 5)) for _ in range(rng.choice([40, 300]))] for k in range(9)}
    sizes["twins"] = [64] * 31 + [7]
    sizes["empty"] = [0, 0, 3]
    for source, (target, own) in mixed(spark, sizes).items():
        taken, base = sum(n * c for n, c in own), min(c for _, c in own)
        left = [n for n, c in own if c == base and n]
        assert taken - target < max(n for n, _ in own)
        assert not left or taken >= target or target - taken < min(left) + 1, source
        assert max(c for _, c in own) <= 2


def test_small_tables_against_every_choice(spark):
    """Within half of the smallest document left of the target (and rounded quotas), or the best there is if none is left."""
    rng = random.Random(11)
    sizes = {f"s{k}": [rng.randrange(1, 12) for _ in range(rng.randrange(1, 7))] for k in range(12)}
    for source, (target, own) in mixed(spark, sizes).items():
        best = min(abs(sum(n * c for (n, _), c in zip(own, copies)) - target) for copies in itertools.product((0, 1, 2), repeat=len(own)))
        base = min(c for _, c in own)
        left = [n for n, c in own if c == base and c < 2]
        assert best <= distance(target, own) + 1e-9
        assert distance(target, own) <= (max(best, min(left) / 2) if left else best) + 1, source


def test_equal_rows_go_together_and_reruns_agree(spark):
    docs = spark.createDataFrame([(i // 2, "w " * 6, "a") for i in range(40)] + [(99, None, None), (98, "", "b")], "doc_id long, text string, source string")
    runs = [sorted(map(tuple, M.mix_documents(docs.repartition(n)).collect()), key=str) for n in (1, 3)]
    assert runs[0] == runs[1]
    taken = sum(r[-1] for r in runs[0] if r[2] == "a")
    assert abs(taken - 360) <= 12
