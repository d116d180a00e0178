import itertools
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import weak_quality as W
from tidemark.llm.queries import QUERIES


def test_held_out_labels(spark):
    where = "/root/testdata/sf0.01"
    if not os.path.isdir(where):
        pytest.skip("benchmark tables not present")
    judged = QUERIES["op1_weak_quality"](spark, where)
    labels = spark.read.parquet(f"{where}/labels.parquet")  # never seen in training
    rows = judged.join(labels, "doc_id").select("rejected", "quality").collect()
    right = sum(r.rejected == (r.quality == 0) for r in rows) / len(rows)
    lost = sum(r.rejected and r.quality == 1 for r in rows) / sum(r.quality == 1 for r in rows)
    assert right > 0.97 and lost < 0.02
    assert judged.count() == 1000


def test_same_on_every_run(spark, documents):
    rows = [(i, " ".join(f"w{(i * j) % 13}" for j in range(30))) for i in range(40)] + [(99, "a$$$ b### c%%% " * 9)]
    runs = [sorted(tuple(r) for r in W.judge_quality(documents(rows).repartition(n), "q").select("doc_id", "q.score").collect()) for n in (1, 3)]
    assert runs[0] == runs[1]


def test_labellers_and_posteriors_recover_the_truth():
    rng = np.random.default_rng(3)
    truth = rng.random(4000) < 0.8
    right = [0.95, 0.9, 0.85, 0.7]
    cast = np.stack([np.where(rng.random(4000) < 0.2, W.NONE, np.where(rng.random(4000) < a, truth, ~truth)) for a in right], 1)
    patterns, counts = np.unique(cast @ (3 ** np.arange(3, -1, -1)), return_counts=True)
    model = W.fit_labels(patterns, counts.astype(float), 4)
    assert abs(model.prior[W.GOOD] - 0.8) < 0.05
    assert np.all(np.abs(model.votes[W.GOOD, :, W.GOOD] - right) < 0.05)
    guess = model.posterior(cast @ (3 ** np.arange(3, -1, -1))) > 0.5
    assert (guess == truth).mean() > 0.93


def test_patterns_unfold():
    votes = list(itertools.product(range(3), repeat=3))
    assert W.unfold(np.arange(27), 3).tolist() == [list(v) for v in votes]


def test_odd_rows(spark, documents):
    docs = documents([(1, None), (2, ""), (3, "  \n "), (4, "the cat sat on the mat. it was on the mat.")] * 2 + [(None, "x " * 50_000)]).withColumn("quality", F.lit("q"))
    rows = W.judge_quality(docs, "quality_").select("doc_id", "quality_.*").collect()
    assert len(rows) == 9 and all(r.score == 0 and r.rejected for r in rows if r.doc_id in (1, 2, 3))
    kept = W.good_documents(docs)
    assert kept.columns == docs.columns
    assert W.good_documents(docs.limit(0)).count() == 0
    assert W.judge_quality(docs.filter("doc_id < 3"), "q").filter("q.rejected").count() == 4
