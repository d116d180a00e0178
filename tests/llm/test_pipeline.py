import os
import zlib
from collections import Counter, defaultdict

import brute
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import source_mix, weak_quality

WHERE = "/root/testdata/sf0.001"
public_tokenizers = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The documents before each stage and after the last, each written and read again."""
    if not os.path.isdir(WHERE):
        pytest.skip("benchmark tables not present")
    docs = spark.read.parquet(f"{WHERE}/documents.parquet")
    out = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(k))
        stage(spark, out[-1], WHERE).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_names_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "n-gram Jaccard join", "benchmark decontamination", "mixing sources to target weights", "token-ID / binary output"]
    assert all(s.dtypes == stages[0].dtypes for s in stages[:-1])


def test_quality(stages):
    judged = weak_quality.judge_quality(stages[0], "q")
    assert sorted(pairs(stages[1])) == sorted(pairs(judged.filter("not q.rejected")))


def test_one_near_copy_stays(stages):
    before = pairs(stages[1])
    keep = {d for d, _, root in brute.linked(before) if d == root}
    assert sorted(pairs(stages[2])) == sorted(r for r in before if r[0] in keep)


def test_clean_of_benchmark(spark, stages):
    before = pairs(stages[2])
    items = [tuple(r) for r in spark.read.parquet(f"{WHERE}/benchmark.parquet").select("item_id", "text").collect()]
    bad = {r[0] for r in brute.hits(before, items) if r[-1]}
    assert sorted(pairs(stages[3])) == sorted(r for r in before if r[0] not in bad)


def test_mix_reaches_targets(stages):
    sizes, sources = {}, defaultdict(int)
    for r in stages[3].collect():
        sizes[r.doc_id] = (r.source, len(brute.words(r.text)))
        sources[r.source] += sizes[r.doc_id][1]
    names = sorted(sources)
    targets = source_mix.capped_targets(sources, {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}, 1.5 * sum(sources.values()), 2)
    times = Counter(d for d, _ in pairs(stages[4]))
    assert max(times.values()) <= 2 and set(times) <= set(sizes)
    taken = defaultdict(int)
    for d, n in times.items():
        taken[sizes[d][0]] += n * sizes[d][1]
    for s in names:
        largest = max(n for source, n in sizes.values() if source == s)
        assert abs(taken[s] - targets[s]) <= max(1, largest / 2)


def test_token_files_hold_the_mix(stages):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want, start = [], 0
    for doc_id, text in sorted(pairs(stages[4])):
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 2]
        want.append((doc_id, start, len(ids), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))))
        start += len(ids)
    assert sorted(map(tuple, stages[5].collect())) == want


def test_run_is_the_stages(spark, stages):
    got = corpus_pipeline.run(spark, WHERE)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, stages[5].collect()))


def test_odd_rows(spark, tmp_path):
    text = "the cat is on the mat and it was there. " * 3
    rows = [(1, text), (1, text), (2, None), (3, ""), (None, text + "more of the same here."), (4, "x " * 30_000), (5, text + "end")]
    docs = spark.createDataFrame([(d, t, None, None, 1, "k") for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long, tkey string")
    spark.createDataFrame([(1, None), (None, "a b")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for given in (docs, docs.limit(0)):
        now = given
        for _, stage in corpus_pipeline.STAGES:
            last = stage(spark, now, str(tmp_path))
            if last.columns == docs.columns:
                now = last
        assert last.select(F.count("*")).first()[0] >= 0


def test_mix_of_overlapping_sources_is_the_cheapest_flow():
    # Two patterns, one in both sources: quotas of 30 and 10 words with copies of 10 and 10 words each.
    words = source_mix.route([10, 10], [[0, 1], [0]], [20, 10], [0, 1, 4])
    assert sum(words) == 30 and max(words) - min(words) <= 10
    assert source_mix.route([10, 10, 5], [[0], [1], [0, 1]], [10, 10], [0, 1]) in ([10, 5, 5], [5, 10, 5], [10, 10, 0], [7, 8, 5], [8, 7, 5])
    assert source_mix.route([4], [[0]], [100], [0, 1]) == [8]


def test_mix_rows(spark, documents):
    rows = [(i, "w " * (i % 7), f"s{i % 3}" if i % 4 else None) for i in range(200)] + [(9, None, "s1"), (None, "a b", "s2"), (5, "w " * 5, "s2")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("size", F.lit("x"))
    runs = [sorted(map(tuple, source_mix.mix_documents(docs.repartition(n)).collect()), key=str) for n in (1, 4)]
    assert runs[0] == runs[1] and len(runs[0]) == len(rows)
    table = source_mix.mix_documents(docs).toPandas()
    assert (table["mix_taken"] <= 2 * table["mix_size"]).all()
    sums = table.groupby(table["source"].fillna("~")).agg(size=("mix_size", "sum"), own=("mix_source_size", "first"), target=("mix_target", "first"), taken=("mix_taken", "sum"))
    assert (sums["size"] == sums["own"]).all() and ((sums["taken"] - sums["target"]).abs() <= 4).all()
    assert abs(sums["target"].sum() - 1.5 * sums["size"].sum()) < 1e-6
    assert source_mix.mix_documents(docs.limit(0)).count() == 0


def test_the_mix_keeps_columns_of_any_name(spark):
    names = ("target", "source_size", "mix_size", "mix_target", "mix_copies", "mix_copy", "size")
    docs = spark.createDataFrame([(i, "w " * i, f"s{i % 2}") for i in range(1, 9)], "doc_id long, text string, source string").withColumns({c: F.lit(c) for c in names})
    got = source_mix.repeated(docs)
    assert got.columns == docs.columns and {tuple(r)[3:] for r in got.collect()} == {names}
    assert got.count() >= 8
