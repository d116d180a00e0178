import random

import brute
from pyspark.sql import functions as F

from tidemark.llm import decontaminate as D
from tidemark.llm.queries import QUERIES

COLUMNS = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


def result(docs, items, **options):
    found = D.find_contamination(docs, items, "found", **options)
    return found.select("doc_id", "found.n_words", "found.n_hit", F.size("found.item_ids"), D.items_digest("found"), D.contaminated("found"))


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_given_tables(spark, given):
    got = QUERIES["op8_decontaminate"](spark, "/root/testdata/sf0.001").select(COLUMNS)
    want = brute.hits(given("documents", "doc_id", "text"), given("benchmark", "item_id", "text"))
    assert rows(got) == sorted(want, key=str)


def test_random_texts_and_blocks(spark, documents):
    rng = random.Random(3)
    text = lambda n: " ".join(rng.choice(["a", "B", "c-d", "é", "x.y", "Ω"]) for _ in range(n))
    items = [(i, text(rng.randrange(0, 20))) for i in range(12)] + [(3, text(14)), (None, "a B"), (99, None), (98, "...")]
    docs = [(i, text(rng.randrange(60))) for i in range(60)] + [(1, "a b"), (1, "a b"), (None, text(30)), (70, None), (71, ""), (72, text(20_000))]
    docs += [(80 + i, "q " * i + t + " z") for i, (_, t) in enumerate(items) if t]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = sorted(brute.hits(docs, items), key=str)
    assert rows(result(documents(docs), bench)) == want
    assert rows(result(documents(docs), bench, block_bytes=100)) == want


def test_longest_matches_and_places(spark, documents):
    item = " ".join(f"w{i}" for i in range(30))
    bench = spark.createDataFrame([(5, item)], "item_id long, text string")
    docs = documents([(1, "x y " + item + " z"), (2, " ".join(f"w{i}" for i in range(3, 20)))])
    found = {r[0]: r[1] for r in D.find_contamination(docs, bench, "found").select("doc_id", "found.matches").collect()}
    assert [tuple(m) for m in found[1]] == [(5, 0, 2, 30)]
    assert [tuple(m) for m in found[2]] == [(5, 3, 0, 17)]


def test_columns_kept_and_empty_tables(spark, documents):
    docs = documents([(1, "a b c"), (2, "d e f")]).withColumn("contamination", F.lit(1)).withColumn("n_hit", F.lit(2))
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.clean_documents(docs, none).columns == docs.columns and D.clean_documents(docs, none).count() == 2
    one = spark.createDataFrame([(1, "b")], "item_id long, text string")
    assert [r.doc_id for r in D.clean_documents(docs, one).collect()] == [2]
    assert D.clean_documents(docs.limit(0), one).count() == 0
