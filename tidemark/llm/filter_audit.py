"""How document filters overlap: what each one removes in every order, what it alone catches, and its fair share.

1. ``judge_documents`` gives every document the set of filters it fails, as a bit mask, and its labels.
2. ``count_cells`` counts documents by part and mask: at most 2^k rows a part, summed on the map side first, so a part with a third of
   all rows is as cheap as any other.
3. ``audit_cells`` walks all subsets of the filters in Gray-code order, one filter switched at a time. Each mask cell carries the number of
   switched-on filters it fails; a cell leaves the survivors when that number rises from 0 and returns when it falls to 0. The survivors of
   the 2^k subsets are kept, and every step of every order is a difference of two of them. All parts of a batch walk together.

Copies: a document fails ``E`` if a smaller doc_id has the same text (by SHA-256). The smallest doc_id of a text is met again by (text, doc_id),
which no text can overload, however often it occurs.

Defined cases: a null text is an empty one, a null source the part ''; a row without doc_id never fails E, makes no other row fail
it, and has no labels; rows that share a doc_id and a text are no copies of each other; of several label rows of a document, one that says
good (or toxic) suffices; labels of unknown documents and null labels count for nothing; an empty table gives an empty result; columns other
than those named are ignored. A text is split into words as one value: it has to fit into a task's memory about thirty times.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import partial
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.frames import arrays
from tidemark.llm.scratch import written

FILTERS = "ABCDE"
LEAST_WORDS, DISTINCT_PERCENT, UPPER_PERCENT = 50, 65, 5
PARTS = 64  # parts written to one batch


def text_failures(text: str, words: str) -> list[Column]:
    """Whether a text, with its words, fails A, B, C and D."""
    n, upper = F.size(words), F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return [
        n < LEAST_WORDS,
        100 * F.size(F.array_distinct(words)) < DISTINCT_PERCENT * n,
        100 * upper > UPPER_PERCENT * F.length(text),
        F.col(text).rlike("[#$%&*|]"),
    ]


def mask_of(failures: Sequence[Column]) -> Column:
    """Bit k is set where condition k holds."""
    mask = F.lit(0)
    for k, failed in enumerate(failures):
        mask = mask + F.when(failed, F.lit(1 << k)).otherwise(F.lit(0))
    return mask


def judge_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, good, toxic), one row per row of documents (doc_id, text, source)."""
    texts = docs.select(F.col("doc_id").cast("long"), F.coalesce("source", F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text"))
    split = texts.withColumn("words", F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), ""))
    judged = written(split.select("doc_id", "part", mask_of(text_failures("text", "words")).alias("mask"), F.unhex(F.sha2("text", 256)).alias("print")), "audit-documents")
    named = judged.filter("doc_id is not null")
    first = named.groupBy("print").agg(F.min("doc_id").alias("doc_id")).withColumn("original", F.lit(True))
    marked = labels.select(F.col("doc_id").cast("long"), F.col("quality") == 1, F.col("toxic") == 1).toDF("doc_id", "good", "toxic") \
        .groupBy("doc_id").agg(F.max("good").alias("good"), F.max("toxic").alias("toxic"))
    copied = F.when(F.col("original"), 0).otherwise(1 << FILTERS.index("E"))
    said = lambda c: F.coalesce(c, F.lit(False)).cast("long").alias(c)
    known = named.join(first, ["print", "doc_id"], "left").select("doc_id", "part", (F.col("mask") + copied).alias("mask")) \
        .join(marked, "doc_id", "left").select("part", "mask", said("good"), said("toxic"))
    nameless = judged.filter("doc_id is null").select("part", "mask", F.lit(0).cast("long").alias("good"), F.lit(0).cast("long").alias("toxic"))
    return known.unionByName(nameless)


def count_cells(judged: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents of each part by the set of filters they fail."""
    return judged.groupBy("part", "mask").agg(F.count("*").alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic"))


def walk(cells: np.ndarray) -> np.ndarray:
    """Survivors of every subset of the filters; cells: counts by (mask, ...), the result by (subset, ...)."""
    size = len(cells)
    failing = np.zeros(size, np.int64)  # switched-on filters that the cell fails
    running = cells.sum(0)
    states = np.zeros_like(cells)
    states[0] = running
    masks = np.arange(size)
    for i in range(1, size):
        subset, bit = i ^ (i >> 1), i & -i
        has = (masks & bit) != 0
        if subset & bit:
            running = running - cells[has & (failing == 0)].sum(0)
            failing[has] += 1
        else:
            failing[has] -= 1
            running = running + cells[has & (failing == 0)].sum(0)
        states[subset] = running
    return states


def shares(kept: np.ndarray, k: int) -> np.ndarray:
    """What each filter removes, summed over all k! orders: a subset before it stands for |s|! (k - |s| - 1)! of them."""
    total = np.zeros((k, *kept.shape[1:]), np.int64)
    for f in range(k):
        for s in range(1 << k):
            if not s >> f & 1:
                m = s.bit_count()
                total[f] += factorial(m) * factorial(k - m - 1) * (kept[s] - kept[s | 1 << f])
    return total


AUDIT_DDL = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"


def audit_parts(batches: Iterator[pa.RecordBatch], names: str, orders: Sequence[str]) -> Iterator[pa.RecordBatch]:
    k = len(names)
    bit = np.array([[names.index(c) for c in order] for order in orders])  # (orders, steps)
    after = np.cumsum(1 << bit, axis=1)
    before = after - (1 << bit)
    full = (1 << k) - 1
    fields = [f.split()[0] for f in AUDIT_DDL.split(", ")]
    for batch in batches:
        rows = batch.to_pylist()
        for a in range(0, len(rows), PARTS):
            some = rows[a:a + PARTS]
            cells = np.zeros((1 << k, len(some), 3), np.int64)
            for p, row in enumerate(some):
                for cell in row["cells"]:
                    cells[cell["mask"], p] = cell["n"], cell["good"], cell["toxic"]
            states = walk(cells)  # (subset, part, measure)
            lost = states[before] - states[after]  # (orders, steps, parts, measures)
            kept = states[..., 0]
            fails = np.stack([kept[0] - kept[1 << f] for f in range(k)])
            alone = np.stack([kept[full ^ 1 << f] - kept[full] for f in range(k)])
            columns = [kept[after], lost[..., 0], fails[bit] - lost[..., 0], alone[bit], lost[..., 1], lost[..., 2], shares(kept, k)[bit]]
            each = len(orders) * k
            yield pa.RecordBatch.from_arrays([
                pa.array(np.repeat(np.array([r["part"] for r in some], object), each), pa.string()),
                pa.array(np.tile(np.repeat(np.array(orders, object), k), len(some)), pa.string()),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(orders) * len(some))),
                *(pa.array(np.moveaxis(c, -1, 0).ravel()) for c in columns)], names=fields)


def audit_cells(cells: DataFrame, names: str = FILTERS, orders: Sequence[str] | None = None) -> DataFrame:
    """For each part, order and step: what is kept and removed, what an earlier filter had removed, what only this filter catches, and
    the labelled documents lost. names: a letter per filter, the first of bit 0; orders: all permutations unless given."""
    orders = ["".join(p) for p in permutations(names)] if orders is None else list(orders)
    if any(sorted(order) != sorted(names) for order in orders):
        raise ValueError(f"every order needs each of {names} once")
    whole = cells.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    return arrays(whole, AUDIT_DDL, partial(audit_parts, names=names, orders=orders))


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of the five text filters over documents (doc_id, text, source) and labels (doc_id, quality, toxic)."""
    return audit_cells(count_cells(judge_documents(docs, labels)))
