"""Benchmark decontamination by suffix arrays over the training documents.

Each task orders the suffixes of its documents (a shard) and finds every benchmark suffix in that order by two binary
searches: the range between them holds all places of the window. Windows that follow one another in both texts are
joined to the longest verbatim matches, with their places. A document never leaves its task, so nothing is shuffled.

A suffix that cannot start a match is left out of the array: its first words must be the first words of some window.
Words are compared by 64-bit hashes; one wrong match would need a window of equal hashes.

The benchmark is broadcast in blocks of at most ``BLOCK_BYTES`` of text. A larger one takes one pass over the documents
for each block, with the hits so far written between passes.

Defined cases: a null or empty text has no words and is clean; an item without words, or with a null item_id, has no
windows; rows with the same item_id are one item; an empty benchmark leaves all documents clean; repeated documents are judged one by
one; all columns of the input are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.frames import spare, with_struct
from tidemark.llm.scratch import written
from tidemark.llm.text import ALNUM, Runs, Words, column, slices, text_bytes

WINDOW = 13
BLOCK_BYTES = 16 << 20
SHARD_SUFFIXES = 1 << 18
FIELDS = "n_words long, n_hit long, item_ids array<long>, spans array<struct<first:long,end:long>>, " \
    "matches array<struct<item_id:long,item_word:long,word:long,length:long>>"
_SPAN = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))
_MATCH = pa.list_(pa.struct([("item_id", pa.int64()), ("item_word", pa.int64()), ("word", pa.int64()), ("length", pa.int64())]))


def suffix_keys(hashes: np.ndarray, first: np.ndarray, end: np.ndarray, window: int, fill: int = 0) -> np.ndarray:
    """The first words of the suffixes as byte strings that order like the suffixes; ``fill`` after a text's end."""
    at = first[:, None] + np.arange(window)
    keys = hashes[np.minimum(at, max(0, len(hashes) - 1))]
    keys[at >= end[:, None]] = np.uint64(fill)
    return keys.astype(">u8").view(f"S{8 * window}").ravel()


@dataclass
class Benchmark:
    """All windows of a block of items, with the search keys below and above every suffix that starts with one."""

    ids: np.ndarray
    item: np.ndarray
    place: np.ndarray
    length: np.ndarray
    low: np.ndarray
    high: np.ndarray
    lead: int
    leads: np.ndarray

    @staticmethod
    def of(ids: list[int], texts: list[str], window: int) -> Benchmark:
        words = Words(*text_bytes(pa.array(texts, pa.large_string())), ALNUM, lower=True)
        hashes, counts = words.hashes(), np.diff(words.offsets)
        windows = np.where(counts >= window, counts - window + 1, np.minimum(counts, 1))
        item = np.repeat(np.arange(len(ids)), windows)
        place = np.arange(len(item)) - np.repeat(np.cumsum(windows) - windows, windows)
        first, length = words.offsets[item] + place, np.minimum(counts[item], window)
        lead = int(min(3, length.min(initial=3)))
        return Benchmark(
            np.array(ids, np.int64), item, place, length, suffix_keys(hashes, first, first + length, window),
            suffix_keys(hashes, first, first + length, window, 2**64 - 1), lead, np.unique(Runs(hashes).between(first, first + lead)),
        )


class Shard:
    """Suffixes of consecutive documents, to be searched once enough have come together."""

    def __init__(self, benchmark: Benchmark, window: int):
        self.benchmark, self.window = benchmark, window
        self.keys, self.docs, self.words, self.counts, self.size, self.n = [], [], [], [], 0, 0

    def add(self, data: np.ndarray, offsets: np.ndarray) -> None:
        words = Words(data, offsets, ALNUM, lower=True)
        hashes, b = words.hashes(), self.benchmark
        if len(hashes) >= b.lead and len(b.leads):
            leads = Runs(hashes).every(b.lead)
            near = np.minimum(np.searchsorted(b.leads, leads), len(b.leads) - 1)
            first = np.flatnonzero(b.leads[near] == leads)
            doc = np.searchsorted(words.offsets, first, "right") - 1
            self.keys.append(suffix_keys(hashes, first, words.offsets[doc + 1], self.window))
            self.docs.append(doc + self.n)
            self.words.append(first - words.offsets[doc])
            self.size += len(first)
        self.counts.append(np.diff(words.offsets))
        self.n += len(offsets) - 1

    def search(self) -> tuple[np.ndarray, ...]:
        """Document, word, window number of every hit, ordered by document and word."""
        if not self.size:
            return (np.zeros(0, np.int64),) * 3
        keys, docs, words = (np.concatenate(x) for x in (self.keys, self.docs, self.words))
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        low, high = np.searchsorted(keys, self.benchmark.low, "left"), np.searchsorted(keys, self.benchmark.high, "right")
        found = np.flatnonzero(high > low)
        n = (high - low)[found]
        rows = order[np.arange(n.sum()) + np.repeat(low[found] - (np.cumsum(n) - n), n)]
        window = np.repeat(found, n)
        by = np.lexsort((words[rows], docs[rows]))
        return docs[rows][by], words[rows][by], window[by]


def union(first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs covered by intervals that are ordered by their first place."""
    reach = np.maximum.accumulate(end)
    new = np.flatnonzero(np.concatenate([[True], first[1:] > reach[:-1]]))
    return first[new], reach[np.append(new[1:], len(first)) - 1]


def longest(b: Benchmark, words: np.ndarray, window: np.ndarray) -> list[tuple[int, int, int, int]]:
    """One document's hits joined along both texts: (item id, word in the item, word in the document, words)."""
    ids, place, length = b.ids[b.item[window]], b.place[window], b.length[window]
    by = np.lexsort((words, words - place, b.item[window], ids))
    words, window, ids, place, length = words[by], window[by], ids[by], place[by], length[by]
    item = b.item[window]
    new = np.concatenate([[True], (item[1:] != item[:-1]) | (np.diff(words - place) != 0) | (np.diff(words) != 1)])
    starts = np.flatnonzero(new)
    stops = np.append(starts[1:], len(words)) - 1
    return list(zip(ids[starts].tolist(), place[starts].tolist(), words[starts].tolist(), (words[stops] - words[starts] + length[stops]).tolist()))


def scan(batches: Iterator[pa.RecordBatch], benchmark: Benchmark, text: str, so_far: str | None, window: int) -> Iterator[pa.Array]:
    for batch in batches:
        n = batch.num_rows
        counts = np.zeros(n, np.int64)
        items: list[list[int]] = [[] for _ in range(n)]
        spans: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        matches: list[list[tuple]] = [[] for _ in range(n)]
        base, shard = 0, Shard(benchmark, window)

        def close() -> None:
            nonlocal base, shard
            docs, words, found = shard.search()
            counts[base:base + shard.n] = np.concatenate(shard.counts)
            edges = np.flatnonzero(np.diff(docs, prepend=-1, append=-1))
            for a, z in zip(edges[:-1], edges[1:]):
                k = base + int(docs[a])
                items[k] = np.unique(benchmark.ids[benchmark.item[found[a:z]]]).tolist()
                spans[k] = list(zip(*(x.tolist() for x in union(words[a:z], words[a:z] + benchmark.length[found[a:z]]))))
                matches[k] = longest(benchmark, words[a:z], found[a:z])
            base, shard = base + shard.n, Shard(benchmark, window)

        for _, data, offsets in slices(batch, text):
            shard.add(data, offsets)
            if shard.size >= SHARD_SUFFIXES:
                close()
        if shard.n:
            close()
        if so_far:
            for k, old in enumerate(column(batch, so_far).to_pylist()):
                if old["spans"]:
                    items[k] = sorted({*items[k], *old["item_ids"]})
                    both = np.array(sorted([*spans[k], *((x["first"], x["end"]) for x in old["spans"])]))
                    spans[k] = list(zip(*(x.tolist() for x in union(both[:, 0], both[:, 1]))))
                    matches[k] = [(x["item_id"], x["item_word"], x["word"], x["length"]) for x in old["matches"]] + matches[k]
        hit = [sum(e - f for f, e in x) for x in spans]
        name = lambda rows, keys: [[dict(zip(keys, x)) for x in row] for row in rows]
        yield pa.StructArray.from_arrays([
            pa.array(counts), pa.array(hit, pa.int64()), pa.array(items, pa.list_(pa.int64())), pa.array(name(spans, ("first", "end")), _SPAN),
            pa.array(name(matches, ("item_id", "item_word", "word", "length")), _MATCH),
        ], names=["n_words", "n_hit", "item_ids", "spans", "matches"])


def find_contamination(docs: DataFrame, benchmark: DataFrame, out: str, text: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with a struct ``out``: n_words, n_hit, item_ids (ascending), spans of hit words, and the longest matches."""
    spark = docs.sparkSession
    items = benchmark.select("item_id", "text").filter("item_id is not null and text is not null")
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-total // block_bytes))
    before = None
    for k in range(blocks):
        block = items.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == k).collect()  # about block_bytes of text
        sent = spark.sparkContext.broadcast(Benchmark.of([r[0] for r in block], [r[1] for r in block], window))
        last = k == blocks - 1
        name = out if last else spare(docs, f"{out}_before_{k}")
        found = with_struct(docs, name, FIELDS, lambda batches, sent=sent, before=before: scan(batches, sent.value, text, before, window))
        if before:
            found = found.drop(before)
        docs, before = (found if last else written(found, "decontaminate")), name
    return docs


def contaminated(out: str) -> Column:
    """At least a twentieth of the words hit."""
    return (F.col(f"`{out}`.n_hit") > 0) & (20 * F.col(f"`{out}`.n_hit") >= F.col(f"`{out}`.n_words"))


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with the columns they came with."""
    out = spare(docs, "contamination")
    return find_contamination(docs, benchmark, out).filter(~contaminated(out)).drop(out)


def items_digest(out: str) -> Column:
    return F.sha2(F.array_join(F.array_sort(F.transform(F.col(f"`{out}`.item_ids"), lambda x: x.cast("string"))), ",").cast("binary"), 256)
