import random
import re
from collections import Counter
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import filter_audit as A
from tidemark.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ORDERS = ["".join(p) for p in permutations("ABCDE")]


def failed(doc_id, text, every):
    words = WORD.findall(text)
    return {
        "A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
        "D": bool(re.search(r"[#$%&*|]", text)), "E": doc_id is not None and any(d is not None and d < doc_id and t == text for d, t in every)}


def brute(rows, labels):
    """Every order run document by document."""
    every = {(d, t or "") for d, t, _ in rows}
    good = {d for d, q, _ in labels if q == 1}
    toxic = {d for d, _, x in labels if x == 1}
    docs = [(s or "", d, failed(d, t or "", every)) for d, t, s in rows]
    out, removals = [], Counter()
    for part in sorted({p for p, _, _ in docs}):
        own = [(d, f) for p, d, f in docs if p == part]
        for order in ORDERS:
            left = own
            for step, name in enumerate(order, 1):
                gone = [(d, f) for d, f in left if f[name]]
                left = [(d, f) for d, f in left if not f[name]]
                removals[part, name] += len(gone)
                out.append([
                    part, order, step, len(left), len(gone), sum(f[name] for _, f in own) - len(gone), sum(f[name] and sum(f.values()) == 1 for _, f in own),
                    sum(d in good for d, _ in gone), sum(d in toxic for d, _ in gone)])
    return sorted((*row, removals[row[0], row[1][row[2] - 1]]) for row in out)


def rows_of(df):
    return sorted(map(tuple, df.collect()))


def corpus(rng):
    texts = [None, "", " \t\n", "UP CASE", "a # b", "Été " * 60]
    for _ in range(25):
        words = [rng.choice("abcdefghijklmnopqrstuvwxyz") + str(rng.randrange(rng.choice([5, 500]))) for _ in range(rng.choice([3, 49, 50, 51, 90]))]
        if rng.random() < 0.4:
            words[0] = rng.choice(["A" * 30, "x|y", "100%", "B"])
        texts.append(rng.choice([" ", "\n", " \t"]).join(words))
    return texts


def test_against_every_order_by_hand(spark):
    rng = random.Random(3)
    texts = corpus(rng)
    rows = [(d, rng.choice(texts), rng.choice([None, "", "a", "b", "a b"])) for d in range(90)] + [(None, texts[9], "a"), (None, texts[9], "a"), (5, texts[8], "b"), (5, texts[8], "b")]
    labels = [(d, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for d in rng.sample(range(120), 70)] + [(3, 1, 1), (3, 0, 0), (None, 1, 1)]
    # 30 shuffled parts; further columns with the names of helpers
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns({c: F.lit("z") for c in ("part", "mask", "print", "words", "good", "original")})
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("good", F.lit(True))
    assert rows_of(A.audit_filters(docs.repartition(7), known)) == brute(rows, labels)


def test_given_tables(spark, given):
    got = rows_of(QUERIES["op13_filter_audit"](spark, "/root/testdata/sf0.001"))
    assert got == brute(given("documents", "doc_id", "text", "source"), given("labels", "doc_id", "quality", "toxic"))


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert rows_of(A.audit_filters(docs, labels)) == []
    one = spark.createDataFrame([(1, "x", None)], docs.schema)
    got = rows_of(A.audit_filters(one, labels))
    assert len(got) == 600 and got == brute([(1, "x", None)], [])


@pytest.mark.parametrize("k", [1, 2, 3, 5, 6])
def test_walk_counts_every_subset(k):
    rng = np.random.default_rng(k)
    cells = rng.integers(0, 50, (1 << k, 4, 3))
    states = A.walk(cells)
    for s in range(1 << k):
        assert (states[s] == sum(cells[m] for m in range(1 << k) if not m & s)).all()


def test_shares_sum_to_what_goes():
    cells = np.random.default_rng(9).integers(0, 1000, (32, 3, 3))
    kept = A.walk(cells)[..., 0]
    assert (A.shares(kept, 5).sum(0) == 120 * (kept[0] - kept[31])).all()


def test_given_orders_and_long_text(spark):
    cells = spark.createDataFrame([("p", 1, 4, 1, 0), ("p", 3, 2, 0, 2), ("p", 0, 7, 0, 0)], "part string, mask int, n long, good long, toxic long")
    assert rows_of(A.audit_cells(cells, "XY", ["YX"])) == [("p", "YX", 1, 11, 2, 0, 0, 0, 2, 2), ("p", "YX", 2, 7, 4, 2, 4, 1, 0, 10)]
    with pytest.raises(ValueError):
        A.audit_cells(cells, "XY", ["XX"])
    text = "word " * 200_000 + "end"
    docs = spark.createDataFrame([(1, text, "s"), (2, text, "s")], "doc_id long, text string, source string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert rows_of(A.audit_filters(docs, labels)) == brute([(1, text, "s"), (2, text, "s")], [])


def test_a_hot_text_spreads(spark):
    """Copies of one text meet their first document by (text, doc_id): no partition of the join holds them all."""
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("same").alias("text"), F.lit("s").alias("source"))
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    cells = {r["mask"]: r["n"] for r in A.count_cells(A.judge_documents(docs, labels)).collect()}
    assert cells == {0b00001: 1, 0b10001: 1999}
