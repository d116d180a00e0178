import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import jaccard_join as J
from tidemark.llm.components import components
from tidemark.llm.queries import QUERIES


def test_given_table(spark, given):
    got = sorted(map(tuple, QUERIES["op7_jaccard_join"](spark, "/root/testdata/sf0.001").collect()))
    assert [r[:3] for r in got] == sorted(brute.linked(given("documents", "doc_id", "text")))


def near_copies(rng):
    rows, n = [], 0
    boiler = " ".join(rng.choice("abcdefgh") for _ in range(40))
    for _ in range(12):
        base = [rng.choice("abcdefgh") + rng.choice("xyz") for _ in range(rng.randrange(1, 60))]
        for _ in range(rng.randrange(1, 9)):
            text = list(base)
            for _ in range(rng.randrange(3)):
                text[rng.randrange(len(text))] = rng.choice("pqrs")
            if rng.random() < 0.3:
                text.insert(0, boiler)
            rows.append((n * 7 % 997, " ".join(text).upper() if rng.random() < 0.2 else "  ".join(text)))
            n += 1
    return rows


@pytest.mark.parametrize("limit", [1 << 20, 60])
def test_random(spark, documents, limit):
    rows = near_copies(random.Random(limit)) + [(998, None), (999, ""), (1000, " \n"), (1001, "one"), (1002, "ONE"), (1003, "a b " * 4000)]
    got = J.near_duplicates(documents(rows + rows[:3] + [(None, "one")]), block_shingles=limit)
    want = [*brute.linked(rows), *list(brute.linked(rows))[:3], (None, 1, None)]
    assert sorted(map(tuple, got.drop("tkey").collect()), key=str) == sorted(want, key=str)


def test_split_chains(spark, documents, monkeypatch):
    monkeypatch.setattr(J, "HOT", 2)
    monkeypatch.setattr(J, "SALTS", 3)
    rows = near_copies(random.Random(8))
    got = J.near_duplicates(documents(rows)).drop("tkey")
    assert sorted(map(tuple, got.collect())) == sorted(brute.linked(rows))


def test_one_of_each_group_stays(spark, documents):
    text = " ".join(f"w{i}" for i in range(40))
    docs = documents([(3, text), (1, text), (1, text), (2, text + " x"), (7, "other words"), (8, None), (None, text)]) \
        .withColumns({c: F.lit("z") for c in ("tkey", "_id", "_key", "gone_id", "gone_key", "component_id")})
    kept = J.one_per_group(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 7, 8]
    assert J.one_per_group(docs.limit(0)).count() == 0


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(1000 + i, 1001 + i) for i in range(60)]
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        p, q = sorted((find(a), find(b)))
        up[q] = p
    linked = {x for e in edges if e[0] != e[1] for x in e}
    got = {tuple(r) for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {(x, find(x)) for x in linked}


def test_divide_skip_finds_all():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 50)).astype(np.uint64)) for _ in range(150)]
    index = J.Index(sets)
    for s in sets:
        want = [k for k, t in enumerate(sets) if len(t) >= len(s) and 100 * len(np.intersect1d(s, t)) >= 75 * len(np.union1d(s, t))]
        assert index.search(s, 75, lambda x: np.zeros(len(x), bool)).tolist() == want


@pytest.mark.parametrize("parts", [1, 2, 3, 4])
def test_texts_under_one_id_are_judged_alike_on_any_partitioning(spark, documents, parts):
    x, y, z = (" ".join(f"{c}{i}" for i in range(30)) for c in "xyz")
    rows = [(5, f"{x} {z}"), (5, f"{x} {y}"), (2, f"{x} {y}"), (9, "q")]
    found = J.counted_documents(documents(rows).repartition(parts))
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in found.collect()) == [(2, 56, 2), (5, 56, 2), (5, 56, 5), (9, 1, 9)]


@pytest.mark.parametrize("limit", [1 << 20, 60])
def test_links_are_counted_without_being_written(spark, documents, limit):
    rows = near_copies(random.Random(33)) + [(999, ""), (1000, None)]
    rows += [(2000 + d, t) for d, t in rows[:30]]  # classes of several documents
    sets = {d: brute.shingles(t) for d, t in rows}
    links = {d: sum(e != d and bool(sets[d]) and 100 * len(sets[d] & sets[e]) >= 75 * len(sets[d] | sets[e]) for e in sets) for d in sets}
    found = J.counted_documents(documents(rows), block_shingles=limit)
    assert {r.doc_id: r.n_links for r in found.collect()} == links
    assert sorted(map(tuple, found.drop("tkey", "n_links").collect())) == sorted(brute.linked(rows))
    members, said = J.joined(documents(rows), 5, 75, limit, J.COUNTS)[1:]
    kinds = {r[0]: r[1] for r in said.groupBy(F.col("others").isNull()).count().collect()}
    classes = members.select("rep").distinct().count()
    assert kinds[True] <= classes * (1 if limit > 100 else 40) and kinds[False] <= 2 * classes * (1 if limit > 100 else 40)


@pytest.mark.parametrize("limit", [1 << 20, 60])
def test_all_links_are_found(spark, documents, limit):
    rows = near_copies(random.Random(21)) + [(999, ""), (1000, None)]
    sets = {d: brute.shingles(t) for d, t in rows}
    pairs = {(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])}
    least = {d: min(e for e in sets if sets[e] == sets[d]) for d in sets}
    found, links = J.linked_documents(documents(rows), block_shingles=limit)
    want = {(*sorted((least[a], least[b])), len(sets[a] & sets[b])) for a, b in pairs if sets[a] != sets[b]}
    got = [tuple(r) for r in links.collect()]
    assert len(got) == len(want) and set(got) == want
    assert {r.doc_id: r.n_links for r in found.collect()} == {d: sum(d in p for p in pairs) for d in sets}
    assert sorted(map(tuple, found.drop("tkey", "n_links").collect())) == sorted(brute.linked(rows))
    groups = len({r.component_id for r in found.collect()})
    assert len(want) > len(set(least.values())) - groups  # more links than a spanning forest has
