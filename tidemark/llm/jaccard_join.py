"""Near-duplicate groups: an exact Jaccard join of shingle sets, by T-occurrence search with DivideSkip.

1. Two sets that link share at least three quarters of either. ``count_shared`` therefore counts, for every document, the
   shingles that any other document has, by 32-bit keys dealt to buckets (a false match only keeps a document longer), and
   sets below three quarters are done: they link with nothing. A task sends a shingle once for all its documents.
2. The sets of the rest are put together; equal ones are one class from here on.
3. Prefix filter: in the order from the rarest shingle on, linked sets share one of their first n - ceil(0.75 n) + 1. Those who
   share one are chained, by size, so a shingle with k holders makes k - 1 edges and never all pairs. The components of the chains
   are blocks: links never leave one.
4. In a block, each set searches the larger ones: it needs T = ceil(6 n / 7) occurrences in its inverted lists. The longest lists are
   set aside, the short ones merged by counting, and only sets that reach T less the number of lists set aside are looked up in these by
   binary search. Large blocks are split into index shards that all sets of the block search.
5. Of the links, those that connect something new are written, as pairs of classes (smallest doc_id of each); all others are only counted, with
   the number of documents of both classes, so the rows written grow with the sets, not with the links. Components of these pairs are
   the groups. Who needs only groups may leave out the counting, and who wants all links may have them written.

Shingles are told apart by 64-bit hashes of their words.

Defined cases: a null or empty text, or one without words, has an empty set and links with nothing; fewer words than a shingle are
one shingle; a row without doc_id links with nothing and gets no component; rows that share a doc_id but not the text are
compared each by its own text and get the component of that, the same on any partitioning; numbers of links are exact only if no doc_id has two
different texts; an empty table gives an empty result; further columns are ignored, or kept by ``one_per_group``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.components import components
from tidemark.llm.frames import arrays, spare
from tidemark.llm.repeats import bounds, by_key
from tidemark.llm.scratch import parts, written
from tidemark.llm.text import SPACED, Runs, Words, column, mix, pack, slices, unpack

SHINGLE = 5
PERCENT = 75
SENT = 1 << 19  # shingles a task holds before it sends them
BLOCK_SHINGLES = 1 << 20  # shingles of a block that one task indexes
HOT = 10_000  # holders of a shingle from which its chain is split
SALTS = 64
LINKS = 1 << 16  # links a task holds before it sends them
SKIP_COST = 0.01  # DivideSkip: cost of a lookup against a merge step


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each text, ascending, and where each text's begin."""
    words = Words(data, offsets, SPACED, lower=True)
    runs = Runs(words.hashes())
    sets = []
    for a, z in zip(words.offsets[:-1].tolist(), words.offsets[1:].tolist()):
        first = np.arange(a, max(z - size, a) + 1) if z > a else np.zeros(0, np.int64)
        sets.append(np.unique(runs.between(first, np.minimum(first + size, z))))
    return np.concatenate(sets) if sets else np.zeros(0, np.uint64), np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int64)


_SENT = pa.schema([("bucket", pa.int32()), ("task", pa.int64()), *((c, pa.binary()) for c in ("keys", "common", "docs", "counts", "ids", "tkeys", "sizes", "shared"))])
SENT_DDL = "bucket int, task long, keys binary, common binary, docs binary, counts binary, ids binary, tkeys binary, sizes binary, shared binary"


def send_shingles(batches: Iterator[pa.RecordBatch], size: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """For each bucket the shingles that one document of the task has, by document, and those that several have; and the documents."""
    from pyspark import TaskContext

    held: list[tuple[np.ndarray, ...]] = []
    n = sent = 0

    def send() -> Iterator[pa.RecordBatch]:
        nonlocal sent
        task, sent = (TaskContext.get().partitionId() << 32) + sent, sent + 1
        ids, tkeys, sizes = (np.concatenate([h[k] for h in held]) for k in range(3))
        tokens = np.concatenate([h[3] for h in held])
        held.clear()
        docs = np.repeat(np.arange(len(sizes), dtype=np.uint32), sizes)
        by = np.argsort(tokens, kind="stable")
        tokens, docs = tokens[by], docs[by]
        edge = bounds(tokens)
        count = np.diff(edge)
        # One document is what all holders are if they have the same id.
        own = ids[docs]
        several = np.minimum.reduceat(own, edge[:-1]) < np.maximum.reduceat(own, edge[:-1]) if len(tokens) else np.zeros(0, bool)
        common = np.repeat(several, count)
        shared = np.bincount(docs[common], minlength=len(sizes)).astype(np.uint32)

        def dealt(chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            keys = mix(chosen ^ np.uint64(0x2545F4914F6CDD1D))
            return (keys % np.uint64(buckets)).astype(np.int32), (keys >> np.uint64(32)).astype(np.uint32)

        # What several documents share goes once; what one id holds goes for each of its rows, which may differ in their texts.
        bucket, key = dealt(tokens[edge[:-1]][several])
        by = np.argsort(bucket, kind="stable")
        bucket, key = bucket[by], key[by]
        own_bucket, own_key = dealt(tokens[~common])
        by = np.lexsort((docs[~common], own_bucket))
        own_bucket, own_key, own_doc = own_bucket[by], own_key[by], docs[~common][by]
        cells = np.unique(np.concatenate([bucket, own_bucket]))
        runs = bounds(own_bucket, own_doc)
        edges = lambda held: np.append(np.searchsorted(held, cells), len(held))
        inner = np.searchsorted(runs[:-1], edges(own_bucket))
        none = pa.nulls(len(cells), pa.binary())
        yield pa.RecordBatch.from_arrays([
            pa.array(cells), pa.array(np.full(len(cells), task)), pack(own_key, edges(own_bucket)), pack(key, edges(bucket)),
            pack(own_doc[runs[:-1]], inner), pack(np.diff(runs).astype(np.uint32), inner), none, none, none, none], schema=_SENT)
        empty = pa.array([None], pa.binary())
        yield pa.RecordBatch.from_arrays([
            pa.array([task % buckets], pa.int32()), pa.array([task]), empty, empty, empty, empty,
            *(pa.array([x.tobytes()], pa.binary()) for x in (ids, tkeys, sizes, shared))], schema=_SENT)

    for batch in batches:
        for rows, data, offsets in slices(batch, "text"):
            tokens, edge = shingle_sets(data, offsets, size)
            held.append((column(rows, "doc_id").to_numpy(), column(rows, "tkey").to_numpy(), np.diff(edge), tokens))
            n += len(tokens)
            if n >= SENT:
                yield from send()
                n = 0
    if held:
        yield from send()


COUNTED_DDL = "task long, docs binary, counts binary, ids binary, tkeys binary, sizes binary, shared binary"


def count_shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """By task, how many of each document's shingles in the bucket some other task has too; rows about documents pass."""
    names = ["task", "docs", "counts", "ids", "tkeys", "sizes", "shared"]
    for cell in by_key(batches, "bucket", lambda held: True):
        heads = cell.filter(cell["ids"].is_valid())
        if heads.num_rows:
            yield from heads.select(names).to_batches()
        rows = cell.filter(cell["ids"].is_null())
        if not rows.num_rows:
            continue
        cells = lambda c: rows[c].to_pylist()
        keys, common = unpack(cells("keys"), np.uint32), unpack(cells("common"), np.uint32)
        docs, counts = unpack(cells("docs"), np.uint32), unpack(cells("counts"), np.uint32)
        every, times = np.unique(np.concatenate([keys, common, common]), return_counts=True)
        found = times[np.searchsorted(every, keys)] > 1
        ends = np.cumsum(counts, dtype=np.int64)
        upto = np.concatenate([[0], np.cumsum(found)])
        per_run = (upto[ends] - upto[ends - counts]).astype(np.uint32)
        runs = np.concatenate([[0], np.cumsum([len(x) // 4 for x in cells("docs")])])
        some = per_run > 0
        inner = np.concatenate([[0], np.cumsum(some)])[runs]
        none = pa.nulls(rows.num_rows, pa.binary())
        yield pa.RecordBatch.from_arrays([
            rows["task"].combine_chunks(), pack(docs[some], inner), pack(per_run[some], inner), none, none, none, none], names=names)


def judge_documents(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """By document: set size, and whether so many shingles are shared that it may link."""
    for batch in batches:
        for row in batch.to_pylist():
            ids, tkeys, sizes = (np.frombuffer(row[c], np.int64) for c in ("ids", "tkeys", "sizes"))
            docs = unpack([p["docs"] for p in row["parts"]], np.uint32)
            counts = unpack([p["counts"] for p in row["parts"]], np.uint32)
            shared = np.frombuffer(row["shared"], np.uint32) + np.bincount(docs, counts, minlength=len(ids))
            near = (sizes > 0) & (100 * shared >= percent * sizes)
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(tkeys), pa.array(sizes), pa.array(near)], names=["doc_id", "tkey", "n", "near"])


SET_DDL = "doc_id long, tkey long, n long, print_a long, print_b long, tokens array<long>"


def sets_of(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, data, offsets in slices(batch, "text"):
            tokens, edge = shingle_sets(data, offsets, size)
            full = np.flatnonzero(np.diff(edge))
            prints = []
            for salt in (0x9E6C63D0876A9A99, 0xC2B2AE3D27D4EB4F):
                sums = np.zeros(len(edge) - 1, np.uint64)
                if len(full):
                    sums[full] = np.add.reduceat(mix(tokens ^ np.uint64(salt)), edge[full])
                prints.append(pa.array(sums.view(np.int64)))
            yield pa.RecordBatch.from_arrays([
                column(rows, "doc_id"), column(rows, "tkey"), pa.array(np.diff(edge)), *prints,
                pa.ListArray.from_arrays(pa.array(edge.astype(np.int32)), pa.array(tokens.view(np.int64)))], names=["doc_id", "tkey", "n", "print_a", "print_b", "tokens"])


def chains(sets: DataFrame, percent: int) -> DataFrame:
    """Edges (a, b) whose components hold every link between the sets (rep, n, tokens)."""
    each = sets.select("rep", "n", F.explode("tokens").alias("token"))
    often = each.groupBy("token").agg(F.count("*").alias("holders")).filter("holders > 1")
    held = each.join(often, "token")
    by_doc = Window.partitionBy("rep")
    # Shingles of one set only come first in the order and take up part of the prefix.
    lone = F.col("n") - F.count("*").over(by_doc)
    need = F.ceil(F.lit(percent) * F.col("n") / F.lit(100))
    prefix = held.select("*", F.row_number().over(by_doc.orderBy("holders", "token")).alias("place"), (F.col("n") - need + 1 - lone).alias("room")) \
        .filter("place <= room").withColumn("salt", F.when(F.col("holders") > HOT, F.pmod(F.xxhash64("rep"), F.lit(SALTS))).otherwise(0))
    order = Window.partitionBy("token", "salt").orderBy("n", "rep")
    linked = prefix.select("token", "salt", "holders", "n", "rep", F.lag("rep").over(order).alias("before"), F.lag("n").over(order).alias("smaller"))
    edges = linked.filter(F.lit(100) * F.col("smaller") >= F.lit(percent) * F.col("n")).select(F.col("before").alias("a"), F.col("rep").alias("b"))
    # The parts of a split chain: every size step of one part could go on in another, so their breaks are bridged.
    breaks = linked.filter(f"holders > {HOT} and (before is null or 100 * smaller < {percent} * n)")
    bridge = Window.partitionBy("token").orderBy("n", "rep")
    bridges = breaks.select("rep", F.lag("rep").over(bridge).alias("before")).filter("before is not null").select(F.col("before").alias("a"), F.col("rep").alias("b"))
    return edges.unionByName(bridges).distinct()


class Groups:
    """Union-find over small numbers; the smallest is the root."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def join(self, x: int, y: int) -> None:
        x, y = sorted((self.find(x), self.find(y)))
        self.up[y] = x


class Index:
    """Inverted lists of some sets."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.fromiter(map(len, sets), np.int64, len(sets))
        tokens = np.concatenate([np.zeros(0, np.uint64), *sets])
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        by = np.argsort(tokens, kind="stable")
        self.owner, edge = owner[by], bounds(tokens[by])
        self.tokens, self.first, self.end = tokens[by][edge[:-1]], edge[:-1], edge[1:]

    def search(self, tokens: np.ndarray, percent: int, skip) -> np.ndarray:
        return self.overlaps(tokens, percent, skip)[0]

    def overlaps(self, tokens: np.ndarray, percent: int, skip) -> tuple[np.ndarray, np.ndarray]:
        """Sets at least as large that reach the percentage, and what they share; skip(candidates): which of them need no lookup."""
        none = np.zeros(0, np.int64)
        n = len(tokens)
        need = -(-2 * percent * n // (100 + percent))  # overlap with an equally large set, and more with larger ones
        if not len(self.tokens):
            return none, none
        at = np.minimum(np.searchsorted(self.tokens, tokens), len(self.tokens) - 1)
        at = at[self.tokens[at] == tokens]
        if len(at) < need:
            return none, none
        first, end = self.first[at], self.end[at]
        by = np.argsort(end - first)
        first, end = first[by], end[by]
        aside = min(need - 1, int(need / (SKIP_COST * np.log2(max(2, end[-1] - first[-1])) + 1)))
        short = len(first) - aside
        size = end[:short] - first[:short]
        merged = self.owner[np.repeat(first[:short] - (np.cumsum(size) - size), size) + np.arange(size.sum())]
        found, count = np.unique(merged, return_counts=True)
        some = (count >= need - aside) & (self.sizes[found] >= n)
        some[some] = ~skip(found[some])
        found, count = found[some], count[some]
        for a, z in zip(first[short:].tolist(), end[short:].tolist()):
            if not len(found):
                break
            many = self.owner[a:z]
            place = np.searchsorted(many, found)
            count = count + (many[np.minimum(place, len(many) - 1)] == found)
        enough = 100 * count >= percent * (n + self.sizes[found] - count)
        return found[enough], count[enough]


LINK_DDL = "rep_a long, rep_b long, overlap long, others long"
FOREST, COUNTS, PAIRS = "forest", "counts", "pairs"


def search_blocks(batches: Iterator[pa.RecordBatch], percent: int, mode: str) -> Iterator[pa.RecordBatch]:
    """What links in each shard of a block: rows (rep_a, rep_b, overlap) that connect it, a row less than there are sets at most (FOREST); these, and for
    each set one row (rep_a, others) with the documents of the sets it links with, so that all links count and none is written (COUNTS); or
    all links themselves, once each (PAIRS). Indexed sets come first in a shard.
    """
    every = mode != FOREST
    state: tuple | None = None  # shard, ids, index, groups, numbers of ids
    waiting: list[tuple[int, np.ndarray, int]] = []
    links: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    counts: list[tuple[int, int]] = []
    held = others = np.zeros(0, np.int64)  # of the indexed sets: documents, and documents they link with
    n = 0

    def build() -> None:
        nonlocal state, held, others
        ids = [i for i, _, _ in waiting]
        state = (state[0], ids, Index([t for _, t, _ in waiting]), Groups(len(ids)), {i: k for k, i in enumerate(ids)}, np.array(ids, np.int64))
        held = np.array([w for _, _, w in waiting], np.int64)
        others = np.zeros(len(ids), np.int64)

    def ask(own: int, rep: int, tokens: np.ndarray, documents: int) -> None:
        nonlocal n
        _, _, index, groups, _, reps = state

        def skip(found: np.ndarray) -> np.ndarray:
            if every:  # of two equally large sets the one with the smaller id finds the other
                return (reps[found] == rep) | ((index.sizes[found] == len(tokens)) & (reps[found] < rep))
            root = groups.find(own)
            return np.fromiter((groups.find(x) == root for x in found.tolist()), bool, len(found))

        found, overlap = index.overlaps(tokens, percent, skip)
        if mode == COUNTS and len(found):
            counts.append((rep, int(held[found].sum())))
            others[found] += documents
            n += 1
        if mode != PAIRS:
            new = np.zeros(len(found), bool)
            for k, x in enumerate(found.tolist()):
                new[k] = groups.find(own) != groups.find(x)
                groups.join(own, x)
            found, overlap = found[new], overlap[new]
        if len(found):
            links.append((np.full(len(found), rep, np.int64), reps[found], overlap))
            n += len(found)

    def send(least: int = 1) -> Iterator[pa.RecordBatch]:
        nonlocal n
        if n >= least:
            names = ["rep_a", "rep_b", "overlap", "others"]
            if links:
                a, b, overlap = (np.concatenate(x) for x in zip(*links))
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), pa.array(overlap), pa.nulls(len(a), pa.int64())], names=names)
            if counts:
                reps, sums = (pa.array(x, pa.int64()) for x in zip(*counts))
                none = pa.nulls(len(reps), pa.int64())
                yield pa.RecordBatch.from_arrays([reps, none, none, sums], names=names)
            links.clear()
            counts.clear()
            n = 0

    def close() -> Iterator[pa.RecordBatch]:
        nonlocal n
        if state is None:
            return
        if state[1] is None:  # no further rows came: the sets search themselves
            build()
            for k, (rep, tokens, documents) in enumerate(waiting):
                ask(k, rep, tokens, documents)
                yield from send(LINKS)
        if mode == COUNTS:
            some = np.flatnonzero(others)
            counts.extend(zip(state[5][some].tolist(), others[some].tolist()))
            n += len(some)
        yield from send()

    for batch in batches:
        shard = list(zip(column(batch, "block").to_pylist(), column(batch, "shard").to_pylist()))
        tokens = column(batch, "tokens")
        values = tokens.flatten().to_numpy().view(np.uint64)
        edge = np.concatenate([[0], np.cumsum(tokens.value_lengths().to_numpy())])
        for k, (rep, asks, documents) in enumerate(zip(*(column(batch, c).to_pylist() for c in ("rep", "asks", "documents")))):
            if state is None or state[0] != shard[k]:
                yield from close()
                waiting, state = [], (shard[k], None, None, None, None, None)
            own = values[edge[k]:edge[k + 1]]
            if not asks:
                waiting.append((rep, own.copy(), documents))  # a view would keep its whole batch
                continue
            if state[1] is None:
                build()
                waiting = []
            _, ids, _, groups, numbers, _ = state
            if rep not in numbers:
                numbers[rep] = len(ids)
                ids.append(rep)
                groups.up.append(numbers[rep])
            ask(numbers[rep], rep, own, documents)
            yield from send(LINKS)
    yield from close()


def near_duplicates(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """doc_id, tkey (hash of the text), n_shingles and component_id for documents (doc_id, text), by a forest of links."""
    return joined(docs, size, percent, block_shingles, FOREST)[0]


def counted_documents(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """As ``near_duplicates``, with n_links, the number of documents that link with each: all links are found and counted, none is written."""
    found, members, links = joined(docs, size, percent, block_shingles, COUNTS)
    counts = links.filter("others is not null").groupBy(F.col("rep_a").alias("rep")).agg(F.sum("others").alias("others"))
    return _with_links(found, members, counts)


def linked_documents(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, block_shingles: int = BLOCK_SHINGLES) -> tuple[DataFrame, DataFrame]:
    """As ``counted_documents``, and the links (rep_a, rep_b, overlap) themselves, whose number may be the square of that of similar texts.

    A link stands for all pairs of documents whose sets equal those of rep_a and rep_b; equal sets link as well.
    """
    found, members, links = joined(docs, size, percent, block_shingles, PAIRS)
    sizes = members.select("rep", "members").distinct()
    ends = links.select("rep_a", "rep_b").distinct()
    ends = ends.unionByName(ends.select(F.col("rep_b").alias("rep_a"), F.col("rep_a").alias("rep_b")))
    others = ends.join(sizes.withColumnRenamed("rep", "rep_b"), "rep_b").groupBy(F.col("rep_a").alias("rep")).agg(F.sum("members").alias("others"))
    return _with_links(found, members, others), links.drop("others")


def _with_links(found: DataFrame, members: DataFrame, others: DataFrame) -> DataFrame:
    """Adds n_links, from the documents of each class and those that its class links with."""
    counts = members.join(others, "rep", "left") \
        .groupBy("doc_id", "tkey").agg(F.max(F.col("members") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))
    return found.join(counts, ["doc_id", "tkey"], "left").withColumn("n_links", F.coalesce("n_links", F.lit(0).cast("long")))


def joined(docs: DataFrame, size: int, percent: int, block_shingles: int, mode: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Documents with components; the members (rep, doc_id, tkey) of classes of equal sets, with the number of documents of the class; and what
    ``search_blocks`` says of the classes."""
    buckets = parts(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("tkey"))
    known = texts.filter("doc_id is not null")
    sent = arrays(known, SENT_DDL, partial(send_shingles, size=size, buckets=buckets))
    counted = arrays(sent.repartition(buckets, "bucket").sortWithinPartitions("bucket"), COUNTED_DDL, count_shared)
    by_task = counted.groupBy("task").agg(
        F.collect_list(F.when(F.col("docs").isNotNull(), F.struct("docs", "counts"))).alias("parts"),
        *(F.max(c).alias(c) for c in ("ids", "tkeys", "sizes", "shared")))
    judged = written(arrays(by_task, "doc_id long, tkey long, n long, near boolean", partial(judge_documents, percent=percent)), "jaccard-documents")

    near = judged.filter("near").select("doc_id", "tkey").distinct()
    met = known.join(near.hint("shuffle_hash"), ["doc_id", "tkey"], "left_semi")
    sets = written(arrays(met, SET_DDL, partial(sets_of, size=size)), "jaccard-sets")
    same = ["n", "print_a", "print_b"]
    ids = sets.select(*same, "doc_id").distinct().groupBy(*same).agg(F.count("*").alias("documents"))
    classes = sets.groupBy(*same).agg(F.min("doc_id").alias("rep"), F.min_by("tokens", "doc_id").alias("tokens"))
    classes = written(classes.join(ids, same), "jaccard-classes")
    blocks = components(written(chains(classes, percent), "jaccard-chains"))

    placed = classes.select("rep", "n", "documents", "tokens").join(blocks.select(F.col("node").alias("rep"), F.col("component").alias("block")), "rep")
    shards = blocks.join(classes.select(F.col("rep").alias("node"), "n"), "node").groupBy(F.col("component").alias("block")) \
        .agg(F.ceil(F.sum("n") / F.lit(block_shingles)).cast("int").alias("shards"))
    placed = written(placed.join(shards, "block").withColumn("own", F.pmod(F.xxhash64("rep"), F.col("shards")).cast("int")), "jaccard-blocks")
    indexed = placed.select("block", F.col("own").alias("shard"), F.lit(0).alias("asks"), "n", "rep", "documents", "tokens")
    asking = placed.filter("shards > 1").select("block", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"), F.lit(1).alias("asks"), "n", "rep", "documents", "tokens")
    work = indexed.unionByName(asking).repartition(buckets, "block", "shard").sortWithinPartitions("block", "shard", "asks", "n", "rep")
    links = written(arrays(work, LINK_DDL, partial(search_blocks, percent=percent, mode=mode)), "jaccard-links")
    groups = components(links.filter("rep_b is not null").select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b")))

    members = sets.join(classes.select(*same, "rep", F.col("documents").alias("members")), same).select("rep", "members", "doc_id", "tkey").distinct()
    grouped = members.join(groups.withColumnRenamed("node", "rep"), "rep", "left") \
        .select("doc_id", "tkey", F.coalesce("component", "rep").alias("component_id")).distinct()
    found = judged.join(grouped, ["doc_id", "tkey"], "left").select("doc_id", "tkey", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))
    lost = arrays(texts.filter("doc_id is null"), SET_DDL, partial(sets_of, size=size)).select("doc_id", "tkey", F.col("n").alias("n_shingles"), F.lit(None).cast("long").alias("component_id"))
    return found.unionByName(lost), members, links


def one_per_group(docs: DataFrame) -> DataFrame:
    """Of each group the document with the smallest id, once, with the columns it came with, whatever their names; rows without an id stay."""
    key, gone_id, gone_key = (spare(docs, c) for c in ("tkey", "gone_id", "gone_key"))
    found = written(near_duplicates(docs.select("doc_id", "text")), "jaccard-groups").filter("doc_id is not null")
    keyed = docs.withColumn(key, F.xxhash64("text"))
    gone = found.filter("component_id <> doc_id").select(F.col("doc_id").alias(gone_id), F.col("tkey").alias(gone_key)).distinct()
    kept = keyed.join(gone.hint("shuffle_hash"), (F.col("doc_id") == F.col(gone_id)) & (F.col(key) == F.col(gone_key)), "left_anti")
    if found.groupBy("doc_id").count().filter("count > 1").limit(1).count():
        named = kept.filter("doc_id is not null").dropDuplicates(["doc_id", key])
        kept = named.unionByName(kept.filter("doc_id is null"))
    return kept.drop(key)
