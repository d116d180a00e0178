"""Mixing overlapping sources to target weights by a minimum-cost flow.

Documents are counted by membership pattern (the set of sources a document belongs to). A flow routes words from
patterns to source quotas; every further copy of a pattern costs more than the one before, so repetition is spread
as evenly as the quotas allow. The flow says how many words each pattern gives; whole documents are then chosen in the
order of a seeded hash.

Only totals of patterns and of (pattern, hash bucket) are ever brought together; the window that finds the last chosen
documents covers one bucket of a pattern, a 4096th of it, so a source with a third of all rows is no hot group. No text goes through a window or a shuffle.

Defined cases: a null text has size 0; a null source is a source of its own and comes last; an empty table gives an
empty result; repeated rows are separate documents, of which any may be chosen; a document of size 0 takes 0 words;
columns of the input are kept, and the helper columns have names that start with ``_mix``.
"""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.frames import spare
from tidemark.llm.scratch import written

WORD = r"[^\x20\x09-\x0D]+"
BUCKETS = 4096
MAX_PATTERNS = 100_000


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def capped_targets(sizes: dict, weights: dict, budget: float, cap: float) -> dict:
    """Shares of the budget by weight; none above ``cap`` times its source's size, the excess shared again by weight."""
    targets, open_keys, left = {}, list(sizes), budget
    while open_keys:
        total = sum(weights[k] for k in open_keys)
        full = [k for k in open_keys if left * weights[k] / total > cap * sizes[k]]
        if not full:
            return targets | {k: left * weights[k] / total for k in open_keys}
        for k in full:
            targets[k] = float(cap * sizes[k])
        left -= sum(targets[k] for k in full)
        open_keys = [k for k in open_keys if k not in targets]
    return targets


def route(sizes: Sequence[int], members: Sequence[Sequence[int]], quotas: Sequence[int], copy_costs: Sequence[int]) -> list[int]:
    """Words to take from each pattern: the cheapest flow that fills as much of the quotas as can be filled.

    Successive shortest paths. Pattern p can give sizes[p] words at each of the copy costs, which must not fall.
    """
    n, m = len(sizes), len(quotas)
    source, sink = n + m, n + m + 1
    edges: list[list[int]] = []  # to, capacity left, cost; the reverse edge is the neighbour by the lowest bit
    out: list[list[int]] = [[] for _ in range(n + m + 2)]

    def add(a: int, b: int, room: int, cost: int) -> None:
        for to, frm, r, c in ((b, a, room, cost), (a, b, 0, -cost)):
            out[frm].append(len(edges))
            edges.append([to, r, c])

    total = sum(quotas)
    for p in range(n):
        for cost in copy_costs:
            add(source, p, sizes[p], cost)
        for s in members[p]:
            add(p, n + s, total, 0)
    for s in range(m):
        add(n + s, sink, quotas[s], 0)
    while True:
        far, by, queued = {source: 0}, {}, deque([source])
        waiting = {source}
        while queued:
            a = queued.popleft()
            waiting.discard(a)
            for e in out[a]:
                b, r, c = edges[e]
                if r > 0 and far[a] + c < far.get(b, 1 << 60):
                    far[b], by[b] = far[a] + c, e
                    if b not in waiting:
                        waiting.add(b)
                        queued.append(b)
        if sink not in far:
            break
        path, at = [], sink
        while at != source:
            path.append(by[at])
            at = edges[by[at] ^ 1][0]
        step = min(edges[e][1] for e in path)
        for e in path:
            edges[e][1] -= step
            edges[e ^ 1][1] += step
    # The reverse of an edge from the source holds what flowed through it.
    return [sum(edges[e][1] for e in out[p] if edges[e][0] == source) for p in range(n)]


def mix_sources(
    docs: DataFrame, members: Column, size: Column, weights: Sequence[float], share: float = 1.5, max_copies: int = 2,
    seed: int = 7, salt: Column | None = None,
) -> DataFrame:
    """``docs`` with mix_size, mix_source_size and mix_target (of a document's pattern: of all its sources), mix_copies and mix_taken;
    with underscores behind where ``docs`` has such a column already. Names that begin with ``_mix`` are for the operator's own use.

    members: array of source names; weights: given to the sources in code point order, null last, and repeated.
    The targets share ``share`` times all words; no document is taken more than ``max_copies`` times.
    salt: what tells documents apart beside the seed; all columns if not given.
    """
    salt = salt if salt is not None else F.struct(*[F.col(c) for c in docs.columns])
    keyed = docs.select(
        "*", size.alias("_mix_size"),
        F.to_json(F.struct(F.array_sort(F.array_distinct(members)).alias("m"))).alias("_mix_key"),
        F.xxhash64(F.lit(seed), salt).alias("_mix_hash"),
    ).withColumn("_mix_bucket", F.pmod("_mix_hash", F.lit(BUCKETS)).cast("int"))
    light = written(keyed.select("_mix_size", "_mix_key", "_mix_hash", "_mix_bucket"), "mix")
    spark = docs.sparkSession

    buckets = light.groupBy("_mix_key", "_mix_bucket").agg(F.sum("_mix_size").alias("words"))
    found = buckets.groupBy("_mix_key").agg(F.sum("words").alias("words")).limit(MAX_PATTERNS + 1).collect()
    if len(found) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} membership patterns")
    keys, sizes = [r[0] for r in found], [r[1] for r in found]
    sets = [json.loads(k)["m"] for k in keys]
    names = sorted({s for group in sets for s in group}, key=lambda s: (s is None, s or ""))
    place = {s: i for i, s in enumerate(names)}
    source_size = {s: sum(n for n, group in zip(sizes, sets) if s in group) for s in names}
    targets = capped_targets(source_size, {s: weights[i % len(weights)] for i, s in enumerate(names)}, share * sum(sizes), max_copies)
    words = route(sizes, [[place[s] for s in group] for group in sets], [round(targets[s]) for s in names], [c * c for c in range(max_copies)])

    quota = spark.createDataFrame(
        [(k, int(sum(source_size[s] for s in group)), float(sum(targets[s] for s in group)), w // n if n else 0, w % n if n else 0)
         for k, group, n, w in zip(keys, sets, sizes, words)],
        "_mix_key string, _mix_source_size long, _mix_target double, _mix_whole long, _mix_gap long",
    )
    plan = written(choose(light, quota), "mix-plan")
    copies = (F.col("_mix_whole") + F.coalesce(chosen(), F.lit(False)).cast("long")).cast("int")
    return keyed.join(F.broadcast(plan), "_mix_key").select(
        *[F.col(f"`{c}`") for c in docs.columns], F.col("_mix_size").alias(spare(docs, "mix_size")), F.col("_mix_source_size").alias(spare(docs, "mix_source_size")),
        F.col("_mix_target").alias(spare(docs, "mix_target")), copies.alias(spare(docs, "mix_copies")), (copies * F.col("_mix_size")).alias(spare(docs, "mix_taken")))


RULE = "array<struct<low: bigint, high: bigint, bucket: int, hash: bigint>>"


def chosen() -> Column:
    """Whether any rule of the pattern takes a document once more: one of its sizes, up to its place in the seeded order."""
    return F.exists("_mix_rules", lambda r: F.col("_mix_size").between(r["low"], r["high"]) & (
        (F.col("_mix_bucket") < r["bucket"]) | ((F.col("_mix_bucket") == r["bucket"]) & (F.col("_mix_hash") <= r["hash"]))))


def fitting(rows: DataFrame) -> DataFrame:
    """How far documents (with ``_mix_gap``, the words still open) fit in seeded order: last bucket and hash, and their words, by pattern.

    Sums of buckets find the bucket where the words run out; only its documents are looked at one by one. Equal rows go together.
    """
    sums = rows.groupBy("_mix_key", "_mix_bucket").agg(F.sum("_mix_size").alias("words"), F.first("_mix_gap").alias("gap"))
    sums = sums.withColumn("upto", F.sum("words").over(Window.partitionBy("_mix_key").orderBy("_mix_bucket")))
    over = F.col("upto") > F.col("gap")
    edge = sums.groupBy("_mix_key").agg(
        F.min(F.when(over, F.col("_mix_bucket"))).alias("bucket"), F.coalesce(F.max(F.when(~over, F.col("upto"))), F.lit(0)).alias("before"))
    edge = edge.withColumn("bucket", F.coalesce("bucket", F.lit(BUCKETS)))
    order = Window.partitionBy("_mix_key").orderBy("_mix_hash").rangeBetween(Window.unboundedPreceding, 0)
    inside = rows.join(F.broadcast(edge), "_mix_key").filter("_mix_bucket = bucket") \
        .withColumn("upto", F.col("before") + F.sum("_mix_size").over(order)).filter("upto <= _mix_gap") \
        .groupBy("_mix_key").agg(F.max("_mix_hash").alias("hash"), F.max("upto").alias("upto"))
    return edge.join(F.broadcast(inside), "_mix_key", "left").select("_mix_key", "bucket", "hash", F.coalesce("upto", "before").alias("words"))


def choose(light: DataFrame, quota: DataFrame) -> DataFrame:
    """The quota with ``_mix_rules``, by which documents are taken once more until the gap of their pattern is closed.

    First the documents in seeded order up to the one that does not fit. Then, as long as a pattern has an untaken document that fits, those of the size class
    (between two powers of two) of the largest such, in seeded order: at most two rounds a class, however many documents. What is still open is smaller than any
    untaken document; one is taken yet if that brings the pattern nearer.
    """
    most = 1 << 62

    def after(plan: DataFrame, found: DataFrame) -> DataFrame:
        """Adds a rule (low, high, bucket, hash) that takes ``words``."""
        more = F.when(F.col("words") > 0, F.array(F.struct("low", "high", "bucket", "hash"))).otherwise(F.array().cast(RULE))
        return plan.join(F.broadcast(found), "_mix_key", "left").select(
            *[c for c in plan.columns if c not in ("_mix_rules", "_mix_gap", "_mix_ceiling")],
            F.concat("_mix_rules", F.coalesce(more, F.array().cast(RULE))).alias("_mix_rules"),
            (F.col("_mix_gap") - F.coalesce("words", F.lit(0))).alias("_mix_gap"),
            F.when(F.col("words") == 0, F.col("low") - 1).otherwise(F.col("_mix_ceiling")).alias("_mix_ceiling"))

    plan = quota.withColumn("_mix_rules", F.array().cast(RULE)).withColumn("_mix_ceiling", F.lit(most))
    first = fitting(light.join(F.broadcast(plan.select("_mix_key", "_mix_gap")), "_mix_key"))
    plan = written(after(plan, first.withColumns({"low": F.lit(0).cast("long"), "high": F.lit(most)})).withColumn("_mix_ceiling", F.lit(most)), "mix-plan")
    while True:
        fits = light.join(F.broadcast(plan.select("_mix_key", "_mix_rules", "_mix_gap", "_mix_ceiling")), "_mix_key") \
            .filter("_mix_size > 0 AND _mix_size <= least(_mix_gap, _mix_ceiling)").filter(~F.coalesce(chosen(), F.lit(False)))
        largest = fits.groupBy("_mix_key").agg(F.max("_mix_size").alias("high"))
        bounds = written(largest.select("_mix_key", F.expr("shiftleft(1L, length(bin(high)) - 1)").alias("low"), "high"), "mix-round")
        if bounds.isEmpty():
            break
        some = fits.join(F.broadcast(bounds), "_mix_key").filter("_mix_size >= low")
        plan = written(after(plan, fitting(some).join(F.broadcast(bounds), "_mix_key")), "mix-plan")
    last = light.join(F.broadcast(plan.select("_mix_key", "_mix_rules", "_mix_gap")), "_mix_key").filter(~F.coalesce(chosen(), F.lit(False))) \
        .groupBy("_mix_key", "_mix_size", "_mix_bucket", "_mix_hash").agg(F.first("_mix_gap").alias("gap"), F.sum("_mix_size").alias("words")) \
        .filter("abs(gap - words) < gap").groupBy("_mix_key").agg(
            F.min(F.struct(F.abs(F.col("gap") - F.col("words")).alias("off"), F.col("_mix_size"), F.col("_mix_bucket"), F.col("_mix_hash"), F.col("words"))).alias("best")) \
        .select("_mix_key", F.col("best._mix_size").alias("low"), F.col("best._mix_size").alias("high"), F.col("best._mix_bucket").alias("bucket"),
                F.col("best._mix_hash").alias("hash"), F.col("best.words").alias("words"))
    return after(plan, last)


def mix_documents(docs: DataFrame) -> DataFrame:
    """Documents with one source each, mixed by word count: weights 3, 1, 2 in turn, half as many words again."""
    return mix_sources(docs, F.array("source"), word_count("text"), (3, 1, 2), salt=F.struct("doc_id", "text"))


def repeated(docs: DataFrame) -> DataFrame:
    """The mix itself: each document as often as it is taken, with the columns it came with, whatever their names."""
    mixed = mix_documents(docs)
    copies, copy = spare(docs, "mix_copies"), spare(mixed, "mix_copy")
    return mixed.filter(F.col(copies) > 0).withColumn(copy, F.explode(F.array_repeat(F.lit(1), F.col(copies)))) \
        .select(*[F.col(f"`{c}`") for c in docs.columns])
