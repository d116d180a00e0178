import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import super_minhash as S
from tidemark.llm.queries import QUERIES
from tidemark.llm.text import mix


def linked(rows):
    """(doc_id, set size, component, kept), by comparing everything with everything."""
    sets = [(d, brute.shingles(t, 3)) for d, t in rows]
    return [(d, n, c, d == c) for d, n, c in brute.linked_sets(sets, 85)]


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_given_table(spark, given):
    got = QUERIES["op11_super_minhash"](spark, "/root/testdata/sf0.001")
    assert rows_of(got) == sorted(linked(given("documents", "doc_id", "text")), key=str)


def near_copies(rng):
    rows, n = [], 0
    boiler = " ".join(rng.choice("abcdefgh") + str(k) for k in range(40))
    for _ in range(14):
        base = [rng.choice("abcdefgh") + rng.choice("uvwxyz") for _ in range(rng.randrange(1, 90))]
        for _ in range(rng.randrange(1, 12)):
            text = list(base)
            for _ in range(rng.randrange(4)):
                text[rng.randrange(len(text))] = rng.choice("pqrs")
            if rng.random() < 0.2:
                text.insert(0, boiler)
            rows.append((n * 7 % 997, " ".join(text).upper() if rng.random() < 0.2 else " \t".join(text)))
            n += 1
    return rows


@pytest.mark.parametrize("limit", [1 << 19, 100])
def test_random(spark, documents, limit):
    rows = near_copies(random.Random(limit)) + [(998, None), (999, ""), (1000, " \n"), (1001, "one"), (1002, "ONE"), (1003, "a b " * 9000), (1004, "two words"), (1005, "Two Words")]
    table = documents(rows + rows[:3] + [(None, "one"), (None, None)]).withColumns({c: F.lit("z") for c in ("rep", "tkey", "band", "prints", "part", "lead")})
    want = linked(rows) + linked(rows)[:3] + [(None, 1, None, True), (None, 0, None, True)]
    got = S.near_duplicates(table, unit_shingles=limit).drop("tkey")
    assert rows_of(got) == sorted(want, key=str)


@pytest.mark.parametrize("parts", [1, 2, 5])
def test_texts_of_one_document_belong_together(spark, documents, parts):
    x, y, z = (" ".join(f"{c}{i}" for i in range(40)) for c in "xyz")
    rows = [(5, x + " " + z), (5, x), (2, x), (9, y), (8, y + " y"), (9, z), (7, z), (7, ""), (4, "")]
    got = S.near_duplicates(documents(rows).repartition(parts)).drop("tkey")
    component = {5: 2, 2: 2, 9: 7, 8: 7, 7: 7, 4: 4}
    assert rows_of(got) == sorted(((d, len(brute.shingles(t, 3)), component[d], component[d] == d) for d, t in rows), key=str)


def test_one_of_each_group_stays(spark, documents):
    text = " ".join(f"w{i}" for i in range(60))
    docs = documents([(3, text), (1, text), (2, text + " x"), (7, "other words"), (8, None), (None, text)]).withColumns({c: F.lit("z") for c in ("tkey", "group_id", "kept")})
    kept = S.kept_documents(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 7, 8]
    assert S.kept_documents(docs.limit(0)).count() == 0 and S.near_duplicates(docs.limit(0)).count() == 0


def plain_signature(tokens, positions):
    """Permutations drawn in full, no early stop."""
    least = [(1 << 64) - 1] * positions
    for token in tokens.tolist():
        order = list(range(positions))
        for rank in range(positions):
            drawn = int(mix(np.array([token ^ ((rank + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)], np.uint64))[0])
            swap = rank + ((drawn >> 32) * (positions - rank) >> 32)
            order[rank], order[swap] = order[swap], order[rank]
            least[order[rank]] = min(least[order[rank]], rank << 32 | drawn & 0xFFFFFFFF)
    return least


def test_early_stop_changes_nothing(monkeypatch):
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64)) for n in (0, 1, 2, 40, 0, 300, 7)]
    edge = np.cumsum([0, *map(len, sets)])
    for drawn in (1 << 16, 50):
        monkeypatch.setattr(S, "DRAWN", drawn)
        got = S.signatures(np.concatenate(sets), edge, 16)
        assert got.tolist() == [plain_signature(s, 16) for s in sets]


def test_estimates_are_closer_than_independent_hashes():
    """Agreements of signatures of sets with a known similarity: unbiased, and with less variance than the binomial."""
    rng = np.random.default_rng(8)
    agreed = []
    for _ in range(400):
        tokens = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
        both = np.concatenate([np.sort(tokens[:50]), np.sort(tokens[10:])])
        a, b = S.signatures(both, np.array([0, 50, 100]))
        agreed.append((a == b).mean())
    assert abs(np.mean(agreed) - 40 / 60) < 0.01
    assert np.var(agreed) < 0.8 * (2 / 3) * (1 / 3) / S.POSITIONS


def test_rows_of_a_large_group_stay_linear(spark, documents):
    """300 different near copies of one text: joins, not pairs."""
    rng = random.Random(1)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for k in range(300):
        text = list(base)
        text[rng.randrange(200)] = f"own{k}"
        rows.append((k, " ".join(text)))
    assert {r.component_id for r in S.near_duplicates(documents(rows)).collect()} == {0}
    unit = S.Unit(85)
    tokens, edge = S.shingle_sets(*(np.frombuffer("".join(t for _, t in rows).encode(), np.uint8), np.cumsum([0, *(len(t.encode()) for _, t in rows)])), 3)
    prints = S.prints_of(S.signatures(tokens, edge))
    for k in range(300):
        unit.add(k, tokens[edge[k]:edge[k + 1]], prints[k])
    unit.close()
    joins = sum(len(unit.links(unit.sets[k], unit.table[k], k, int(unit.root[k]))) for k in range(1, 300))
    assert joins == 299
