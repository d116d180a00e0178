"""Runs of a given length that also start in a document with a smaller id, found without shuffling texts to each other.

A text is a sequence of units (bytes, or words). A window is a run of ``length`` units. Every window has one anchor: the place of
the smallest hash among the ``anchor``-unit runs in it. The windows of an anchor stand in one stretch, its region. Equal
windows have equal anchors, and about two in length - anchor + 2 places are anchors, so anchors stand for all windows.

1. ``probe``: each task sends (anchor hash, region hash, document) to buckets by anchor hash, one row per bucket and task, and one
   entry for all documents of the task that share a region: the smallest id. The others are known to be repeats.
2. ``judge``: in a bucket, a region that a smaller id has as well is a repeat as a whole. An anchor with several different regions
   is undecided: the first holder of each region is asked for its units.
3. ``ask``: documents meet their verdicts, and those asked send the regions, keyed by anchor, with nothing else of the text.
4. ``compare``: ``solve``, given by the operator, compares the asked regions unit by unit, key by key. The regions of an anchor with
   very many of them are split into windows instead:
   ``sift`` sends the hashes of their windows to buckets, as ``probe`` does those of regions, and ``judge_windows`` tells each region
   which of its windows other documents may have. All others are no repeats, and go no further.
   ``single`` sends what is left window by window, keyed by window hash. Of those that hold a window a task sends the smallest id and its
   units; the others are known to be repeats. As every task may have sent it, the smallest id of each of ``SALTS`` parts is
   found next, and only these are solved.
5. ``finish``: documents meet the repeated regions and the windows found, and what is covered goes.

Equal regions are told by 64-bit hashes within an anchor of equal 32-bit hash; what differs there is compared in full.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.frames import arrays
from tidemark.llm.scratch import parts, written
from tidemark.llm.text import SPACED, Runs, Words, byte_values, column, mix, pack, room, slices, unpack

PROBES = 1 << 19  # anchors a task holds before it sends them
WINDOWS = 1 << 17  # single windows a task holds before it sends them
SALTS = 64  # parts in which the holders of a single window are reduced
_PLACE = np.uint64((1 << 28) - 1)


@dataclass(frozen=True)
class Rule:
    """What a unit is, how long a window and its anchor are, how many regions of one anchor a single task may compare, and
    how many units are compared at once (whole anchors, so up to ``heavy`` regions more)."""

    unit: str  # "byte" or "word"
    length: int
    anchor: int
    heavy: int = 4096
    solved: int = 1 << 18


class Units:
    """The units of several texts."""

    def __init__(self, rule: Rule, data: np.ndarray, offsets: np.ndarray):
        self.words = Words(data, offsets, SPACED) if rule.unit == "word" else None
        self.values = self.words.hashes() if self.words else byte_values(data)
        self.offsets = self.words.offsets if self.words else offsets
        self.raw = data.tobytes()

    def between(self, first: int, end: int) -> bytes:
        if not self.words:
            return self.raw[first:end]
        return b" ".join(self.raw[self.words.first[first]:self.words.end[end - 1]].split())


def without(rule: Rule, text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The units outside the spans: bytes put together, words joined by one space."""
    units = text.split() if rule.unit == "word" else text
    out, at = [], 0
    for first, end in [*spans, (len(units), len(units))]:
        out.append(units[at:first])
        at = end
    return b" ".join(w for part in out for w in part) if rule.unit == "word" else b"".join(out)


@dataclass
class Anchors:
    """By anchor: its text's number, the first and last start of its windows, its hash and its region's hash."""

    doc: np.ndarray
    first: np.ndarray
    last: np.ndarray
    key: np.ndarray
    region: np.ndarray


def anchors(rule: Rule, units: Units) -> Anchors:
    starts = np.flatnonzero(room(units.offsets, rule.length))
    if not len(starts):
        none = np.zeros(0, np.int64)
        return Anchors(none, none, none, none.astype(np.uint64), none.astype(np.uint64))
    runs = Runs(units.values)
    hashes = runs.every(rule.anchor)
    least = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)  # ties go to the first place
    width, have = rule.length - rule.anchor + 1, 1
    while have < width:  # smallest of ``have`` places, doubled until it spans the window
        step = min(have, width - have)
        least = np.minimum(least[:-step], least[step:])
        have += step
    at = (least[starts] & _PLACE).astype(np.int64)
    new = np.flatnonzero(np.concatenate([[True], (np.diff(at) != 0) | (np.diff(starts) != 1)]))
    first, at = starts[new], at[new]
    last = starts[np.append(new[1:], len(starts)) - 1]
    shape = ((at - first).astype(np.uint64) << np.uint64(32)) | (last - first).astype(np.uint64)
    region = mix(runs.between(first, last + rule.length) ^ mix(shape + np.uint64(1)))
    key = mix(hashes[at] ^ np.uint64(0x5851F42D4C957F2D))
    return Anchors(np.searchsorted(units.offsets, first, "right") - 1, first, last, key, region)


def bounds(*columns: np.ndarray) -> np.ndarray:
    """First index of each run of equal rows, and the end."""
    n = len(columns[0])
    if not n:
        return np.zeros(1, np.int64)
    change = np.zeros(n - 1, bool)
    for c in columns:
        change |= c[1:] != c[:-1]
    return np.concatenate([[0], np.flatnonzero(change) + 1, [n]])


PROBE = "bucket int, doc_id long, tkey long, ids binary, tkeys binary, counts binary, keys binary, regions binary"
_PROBE = pa.schema([("bucket", pa.int32()), ("doc_id", pa.int64()), ("tkey", pa.int64()), *((c, pa.binary()) for c in ("ids", "tkeys", "counts", "keys", "regions"))])
VERDICT = "doc_id long, tkey long, repeats binary, asked binary, split binary"
_VERDICT = ["doc_id", "tkey", "repeats", "asked", "split"]


def deal(held: list[tuple[np.ndarray, ...]], buckets: int, told: Callable) -> Iterator[pa.RecordBatch]:
    """Rows of PROBE for (doc_id, tkey, key, region) held by a task, which are used up. told(ids, least, most): of which holders it
    is known already, from the smallest and largest id that holds the region here."""
    ids, tkeys, keys, regions = (np.concatenate(x) for x in zip(*held))
    held.clear()
    by = np.lexsort((tkeys, ids, regions))
    ids, tkeys, keys, regions = ids[by], tkeys[by], keys[by], regions[by]
    edge = bounds(regions)
    least, most = (np.repeat(ids[x], np.diff(edge)) for x in (edge[:-1], edge[1:] - 1))
    new = np.zeros(len(ids), bool)
    new[bounds(regions, ids, tkeys)[:-1]] = True
    known = np.flatnonzero(new & told(ids, least, most))
    known = known[np.lexsort((tkeys[known], ids[known]))]
    edge = bounds(ids[known], tkeys[known])
    if len(known):
        own, m = known[edge[:-1]], len(edge) - 1
        none = pa.nulls(m, pa.binary())
        bucket = (mix(tkeys[own].astype(np.uint64) + ids[own].astype(np.uint64)) % np.uint64(buckets)).astype(np.int32)  # copies go to many
        yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(ids[own]), pa.array(tkeys[own]), none, none, none, none, pack(regions[known], edge)], schema=_PROBE)
    first = np.flatnonzero(new & (ids == least))
    ids, tkeys, keys, regions = ids[first], tkeys[first], keys[first], regions[first]
    bucket = (keys % np.uint64(buckets)).astype(np.int32)
    by = np.lexsort((tkeys, ids, bucket))
    ids, tkeys, keys, regions, bucket = ids[by], tkeys[by], (keys >> np.uint64(32)).astype(np.uint32)[by], regions[by], bucket[by]
    runs, cells = bounds(bucket, ids, tkeys), bounds(bucket)
    inner = np.searchsorted(runs, cells)
    m = len(cells) - 1
    yield pa.RecordBatch.from_arrays([
        pa.array(bucket[cells[:-1]]), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()), pack(ids[runs[:-1]], inner), pack(tkeys[runs[:-1]], inner),
        pack(np.diff(runs).astype(np.uint32), inner), pack(keys, cells), pack(regions, cells)], schema=_PROBE)


def probe(batches: Iterator[pa.RecordBatch], rule: Rule, buckets: int) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, ...]] = []
    n = 0
    send = partial(deal, held, buckets, lambda ids, least, most: ids > least)
    for batch in batches:
        for rows, data, offsets in slices(batch, "text"):
            found = anchors(rule, Units(rule, data, offsets))
            ids = column(rows, "doc_id")
            keep = found.doc if not ids.null_count else found.doc[ids.is_valid().to_numpy(zero_copy_only=False)[found.doc]]
            pick = slice(None) if not ids.null_count else ids.is_valid().to_numpy(zero_copy_only=False)[found.doc]
            if len(keep):
                held.append((ids.fill_null(0).to_numpy()[keep], column(rows, "tkey").to_numpy()[keep], found.key[pick], found.region[pick]))
                n += len(keep)
            if n >= PROBES:
                yield from send()
                n = 0
    if held:
        yield from send()


def by_key(batches: Iterator[pa.RecordBatch], key: str, enough: Callable[[list[pa.RecordBatch]], bool]) -> Iterator[pa.Table]:
    """Rows sorted by key, in tables that hold whole keys and are as large as ``enough`` says, or one key."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        values = column(batch, key).to_numpy()
        edge = bounds(values)
        for a, z in zip(edge[:-1].tolist(), edge[1:].tolist()):
            if held and values[a] != last and enough(held):
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, z - a))
            last = values[a]
    if held:
        yield pa.Table.from_batches(held)


def in_buckets(batches: Iterator[pa.RecordBatch], names: list[str], verdicts: Callable) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, tkey, regions by verdict) of what was dealt. verdicts(keys, regions, ids): one mask for each verdict over the rows of
    a bucket, sorted by these. What a task knew already has the first verdict."""
    for cell in by_key(batches, "bucket", lambda held: True):
        local = cell.filter(cell["ids"].is_null())
        if local.num_rows:
            none = pa.array([b""] * local.num_rows, pa.binary())
            yield from pa.table([local["doc_id"], local["tkey"], local["regions"], *[none] * (len(names) - 3)], names=names).to_batches()
        sent = cell.filter(cell["ids"].is_valid())
        if not sent.num_rows:
            continue
        cells = lambda c: sent[c].to_pylist()
        ids, tkeys, counts = unpack(cells("ids"), np.int64), unpack(cells("tkeys"), np.int64), unpack(cells("counts"), np.uint32)
        keys, regions = unpack(cells("keys"), np.uint32), unpack(cells("regions"), np.uint64)
        holder = np.repeat(np.arange(len(ids)), counts)
        own = ids[holder]
        by = np.lexsort((own, regions, keys))
        holder, own, keys, regions = holder[by], own[by], keys[by], regions[by]
        told = verdicts(keys, regions, own)
        some = np.flatnonzero(np.logical_or.reduce(told))
        some = some[np.argsort(holder[some], kind="stable")]
        rows = bounds(holder[some])
        if len(some):
            who = holder[some][rows[:-1]]
            upto = [np.concatenate([[0], np.cumsum(x[some])])[rows] for x in told]
            yield pa.RecordBatch.from_arrays([
                pa.array(ids[who]), pa.array(tkeys[who]), *(pack(regions[some][x[some]], u) for x, u in zip(told, upto))], names=names)


def judge(batches: Iterator[pa.RecordBatch], rule: Rule) -> Iterator[pa.RecordBatch]:
    def verdicts(keys: np.ndarray, regions: np.ndarray, own: np.ndarray) -> list[np.ndarray]:
        edge = bounds(keys, regions)
        size = np.diff(edge)
        least = np.repeat(own[edge[:-1]], size)
        groups = np.searchsorted(edge[:-1], bounds(keys))  # regions of each key
        low = np.minimum.reduceat(own[edge[:-1]], groups[:-1])
        high = np.maximum.reduceat(own[edge[:-1]], groups[:-1])
        per_region = lambda x: np.repeat(np.repeat(x, np.diff(groups)), size)
        repeat = own > least
        asked = ~repeat & per_region(low != high)
        split = asked & per_region(np.diff(groups) > rule.heavy)
        return [repeat, asked & ~split, split]

    return in_buckets(batches, _VERDICT, verdicts)


def merged(first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Disjoint runs in order, as rows (first, end); touching runs are one."""
    if not len(first):
        return np.zeros((0, 2), np.int64)
    by = np.argsort(first, kind="stable")
    first, reach = first[by], np.maximum.accumulate(end[by])
    new = np.flatnonzero(np.concatenate([[True], first[1:] > reach[:-1]]))
    return np.stack([first[new], reach[np.append(new[1:], len(first)) - 1]], 1)


#: Without units, a row says where repeated windows start. Regions to compare have the salt -1, those to split 0 and a key of their own,
#: single windows the salt of their task.
ASKED = "doc_id long, tkey long, key long, salt int, firsts binary, units binary"
_ASKED = pa.schema([("doc_id", pa.int64()), ("tkey", pa.int64()), ("key", pa.int64()), ("salt", pa.int32()), ("firsts", pa.binary()), ("units", pa.binary())])


class Windows:
    """Single windows that a task asks for: each with its smallest doc_id only, as all others are repeats of that one."""

    def __init__(self):
        self.numbers: dict[bytes, int] = {}
        self.keys: list[int] = []
        self.held: list[tuple[int, int, int, int]] = []  # window, doc_id, tkey, start

    def add(self, doc_id: int, tkey: int, first: int, key: int, cell: bytes) -> None:
        number = self.numbers.setdefault(cell, len(self.numbers))
        if number == len(self.keys):
            self.keys.append(key)
        self.held.append((number, doc_id, tkey, first))

    def send(self, salt: int) -> Iterator[pa.RecordBatch]:
        number, ids, tkeys, first = np.array(self.held, np.int64).T
        units, keys = np.array([*self.numbers], object), np.array(self.keys, np.int64)
        least = np.full(len(keys), np.iinfo(np.int64).max)
        np.minimum.at(least, number, ids)
        known = ids > least[number]
        for some in (np.flatnonzero(known), np.flatnonzero(~known)):
            if not len(some):
                continue
            told = known[some[0]]
            window = np.where(known, 0, number)  # all starts of a document that are known go together
            some = some[np.lexsort((first[some], window[some], tkeys[some], ids[some]))]
            edge = bounds(ids[some], tkeys[some], window[some])
            own = some[edge[:-1]]
            key = mix(ids[own].astype(np.uint64) + tkeys[own].astype(np.uint64)).view(np.int64) if told else keys[number[own]]
            yield pa.RecordBatch.from_arrays([
                pa.array(ids[own]), pa.array(tkeys[own]), pa.array(key), pa.array(np.full(len(own), salt, np.int32)), pack(first[some], edge),
                pa.nulls(len(own), pa.binary()) if told else pa.array(units[number[own]].tolist(), pa.binary())], schema=_ASKED)
        self.__init__()


def ask(batches: Iterator[pa.RecordBatch], rule: Rule) -> Iterator[pa.RecordBatch]:
    """The regions that the verdicts on a document ask for."""
    for batch in batches:
        for rows, data, offsets in slices(batch, "text"):
            units = Units(rule, data, offsets)
            some = anchors(rule, units)
            edge = np.searchsorted(some.doc, np.arange(rows.num_rows + 1))
            tkeys = column(rows, "tkey").to_numpy()
            owner, keys, salts, firsts, cells = [], [], [], [], []
            for k, verdict in enumerate(column(rows, "verdicts").to_pylist()):
                part = slice(edge[k], edge[k + 1])
                whole, split = (np.isin(some.region[part], unpack([v[c] for v in verdict], np.uint64)) for c in ("asked", "split"))
                told = whole | split
                first, last, split = some.first[part][told], some.last[part][told], split[told]
                start = first - int(units.offsets[k])
                own = mix(tkeys[k:k + 1].astype(np.uint64) + mix(start.astype(np.uint64)))  # one for each region
                keys.append(np.where(split, own, some.key[part][told]).view(np.int64))
                salts.append(split.astype(np.int32) - 1)
                firsts.append(start)
                cells += [units.between(f, z + rule.length) for f, z in zip(first.tolist(), last.tolist())]
                owner += [k] * len(first)
            if owner:
                yield pa.RecordBatch.from_arrays([
                    column(rows, "doc_id").take(pa.array(owner)), column(rows, "tkey").take(pa.array(owner)), pa.array(np.concatenate(keys)),
                    pa.array(np.concatenate(salts).astype(np.int32)), pack(np.concatenate(firsts), np.arange(len(owner) + 1)), pa.array(cells, pa.binary())], schema=_ASKED)


def windows(batches: Iterator[pa.RecordBatch], rule: Rule) -> Iterator[tuple[pa.RecordBatch, Units, np.ndarray, np.ndarray, np.ndarray]]:
    """Regions, their units, and of every window in them the place of its first unit, the region's number and the hash."""
    for batch in batches:
        texts = column(batch, "units").cast(pa.large_binary()).view(pa.large_string())
        for rows, data, offsets in slices(batch.append_column("text", texts), "text"):
            units = Units(rule, data, offsets)
            place = np.flatnonzero(room(units.offsets, rule.length))
            if len(place):
                yield rows, units, place, np.searchsorted(units.offsets, place, "right") - 1, Runs(units.values).every(rule.length)[place]


def sift(batches: Iterator[pa.RecordBatch], rule: Rule, buckets: int) -> Iterator[pa.RecordBatch]:
    """The hashes of the windows of regions to split; these regions stand in the place of documents, with their keys as tkeys."""
    held: list[tuple[np.ndarray, ...]] = []
    n = 0
    send = partial(deal, held, buckets, lambda ids, least, most: least != most)
    for rows, _, _, region, hashes in windows(batches, rule):
        held.append((column(rows, "doc_id").to_numpy()[region], column(rows, "key").to_numpy()[region], hashes, hashes))
        n += len(hashes)
        if n >= PROBES:
            yield from send()
            n = 0
    if held:
        yield from send()


SHARED = "doc_id long, key long, shared binary"


def judge_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each region the hashes of windows that another document has too."""
    def verdicts(keys: np.ndarray, regions: np.ndarray, own: np.ndarray) -> list[np.ndarray]:
        edge = bounds(keys, regions)
        return [np.repeat(own[edge[:-1]] != own[edge[1:] - 1], np.diff(edge))]

    return in_buckets(batches, ["doc_id", "key", "shared"], verdicts)


def single(batches: Iterator[pa.RecordBatch], rule: Rule) -> Iterator[pa.RecordBatch]:
    """The shared windows of regions to split, one by one."""
    from pyspark import TaskContext

    context = TaskContext.get()
    salt = context.partitionId() if context else 0
    held = Windows()
    for rows, units, place, region, hashes in windows(batches, rule):
        ids, tkeys = column(rows, "doc_id").to_pylist(), column(rows, "tkey").to_pylist()
        firsts = unpack(column(rows, "firsts").to_pylist(), np.int64).tolist()
        edge = np.searchsorted(region, np.arange(rows.num_rows + 1))
        for k, shared in enumerate(column(rows, "shared").to_pylist()):
            part = slice(edge[k], edge[k + 1])
            for i in (np.flatnonzero(np.isin(hashes[part], unpack(shared, np.uint64))) + edge[k]).tolist():
                at = int(place[i])
                held.add(ids[k], tkeys[k], firsts[k] + at - int(units.offsets[k]), int(hashes[i:i + 1].view(np.int64)[0]), units.between(at, at + rule.length))
            if len(held.held) >= WINDOWS:
                yield from held.send(salt % SALTS)
                salt += 1
    if held.held:
        yield from held.send(salt % SALTS)


def compare(batches: Iterator[pa.RecordBatch], rule: Rule, solve: Callable) -> Iterator[pa.RecordBatch]:
    """solve(rule, regions in bytes, ids): for each region the starts in it of windows that a smaller id has too."""
    def enough(held: list[pa.RecordBatch]) -> bool:
        return sum(b.num_rows for b in held) * 2 * rule.length > rule.solved

    for group in by_key(batches, "key", enough):
        ids, firsts = group["doc_id"].to_numpy(), group["firsts"].to_pylist()
        starts = solve(rule, group["units"].to_pylist(), ids)
        some = [k for k, s in enumerate(starts) if len(s)]
        if some:
            found = [np.add.outer(np.asarray(starts[k], np.int64), np.frombuffer(firsts[k], np.int64)).tobytes() for k in some]
            yield pa.RecordBatch.from_arrays([
                pa.array(ids[some]), pa.array(group["tkey"].to_numpy()[some]), pa.array(group["key"].to_numpy()[some]),
                pa.array(np.full(len(some), -1, np.int32)), pa.array(found, pa.binary()), pa.nulls(len(some), pa.binary())], schema=_ASKED)


def reduce_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Single windows by (salt, key, doc_id): the smallest holder of each window stays asked, the others are repeats."""
    last, least = None, {}
    for batch in batches:
        units = column(batch, "units").to_pylist()
        for k, (salt, key, doc_id, cell) in enumerate(zip(*(column(batch, c).to_pylist() for c in ("salt", "key", "doc_id")), units)):
            if (salt, key) != last:
                last, least = (salt, key), {}
            if cell is not None and least.setdefault(cell, doc_id) < doc_id:
                units[k] = None
        yield pa.RecordBatch.from_arrays([*(column(batch, c) for c in _ASKED.names[:-1]), pa.array(units, pa.binary())], schema=_ASKED)


def compare_regions(batches: Iterator[pa.RecordBatch], rule: Rule, solve: Callable) -> Iterator[pa.RecordBatch]:
    """Regions are solved; those to split, which come behind them, are handed on."""
    behind: list[pa.RecordBatch] = []

    def regions() -> Iterator[pa.RecordBatch]:
        for batch in batches:
            edge = int(np.searchsorted(column(batch, "salt").to_numpy(), 0))
            if edge:
                yield batch.slice(0, edge)
            if edge < batch.num_rows:
                behind.append(batch.slice(edge))
                return

    yield from compare(regions(), rule, solve)
    yield from chain(behind, batches)


RESULT = "doc_id long, n_units long, spans array<struct<first:long,end:long>>, kept binary"
_SPANS = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))


def finish(batches: Iterator[pa.RecordBatch], rule: Rule) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, data, offsets in slices(batch, "text"):
            units = Units(rule, data, offsets)
            marks = column(rows, "marks").to_pylist()
            some = anchors(rule, units) if any(m["repeats"] for mark in marks for m in mark or ()) else None
            kept, spans = [], []
            for k, mark in enumerate(marks):
                base = int(units.offsets[k])
                first, end = np.zeros(0, np.int64), np.zeros(0, np.int64)
                if mark and some:
                    a, z = np.searchsorted(some.doc, [k, k + 1])
                    hit = np.isin(some.region[a:z], unpack([m["repeats"] for m in mark if m["repeats"]], np.uint64))
                    first, end = some.first[a:z][hit] - base, some.last[a:z][hit] - base + rule.length
                if mark:
                    starts = unpack([m["starts"] for m in mark if m["starts"]], np.int64)
                    first, end = np.concatenate([first, starts]), np.concatenate([end, starts + rule.length])
                found = merged(first, end).tolist()
                kept.append(without(rule, units.raw[offsets[k]:offsets[k + 1]], found))
                spans.append([{"first": f, "end": z} for f, z in found])
            yield pa.RecordBatch.from_arrays([
                column(rows, "doc_id"), pa.array(np.diff(units.offsets)), pa.array(spans, _SPANS), pa.array(kept, pa.binary())], names=["doc_id", "n_units", "spans", "kept"])


def remove_repeats(docs: DataFrame, rule: Rule, solve: Callable) -> DataFrame:
    """doc_id, n_units, spans (maximal removed runs, in units) and kept bytes, for documents (doc_id, text)."""
    n = parts(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("tkey"))
    sent = arrays(texts, PROBE, partial(probe, rule=rule, buckets=n))
    verdicts = written(arrays(sent.repartition(n, "bucket").sortWithinPartitions("bucket"), VERDICT, partial(judge, rule=rule)), "repeat-verdicts")
    told = verdicts.filter("length(asked) > 0 or length(split) > 0").groupBy("doc_id", "tkey").agg(F.collect_list(F.struct("asked", "split")).alias("verdicts"))
    asked = arrays(texts.join(told.hint("shuffle_hash"), ["doc_id", "tkey"]), ASKED, partial(ask, rule=rule))
    compared = written(arrays(
        asked.repartition(n, "key").sortWithinPartitions("salt", "key"), ASKED, partial(compare_regions, rule=rule, solve=solve)), "repeat-starts")
    split = compared.filter("units is not null")
    sifted = arrays(split.select("doc_id", "key", "units"), PROBE, partial(sift, rule=rule, buckets=n))
    shared = arrays(sifted.repartition(n, "bucket").sortWithinPartitions("bucket"), SHARED, judge_windows) \
        .groupBy("doc_id", "key").agg(F.collect_list("shared").alias("shared"))
    alone = arrays(split.join(shared.hint("shuffle_hash"), ["doc_id", "key"]), ASKED, partial(single, rule=rule))
    reduced = written(arrays(alone.repartition(n, "key", "salt").sortWithinPartitions("salt", "key", "doc_id"), ASKED, reduce_windows), "repeat-windows")
    left = reduced.filter("units is not null").repartition(n, "key").sortWithinPartitions("key")
    starts = compared.unionByName(reduced).filter("units is null").unionByName(arrays(left, ASKED, partial(compare, rule=rule, solve=solve))) \
        .select("doc_id", "tkey", F.col("firsts").alias("starts"))
    marks = verdicts.filter("length(repeats) > 0").select("doc_id", "tkey", "repeats").unionByName(starts, allowMissingColumns=True) \
        .groupBy("doc_id", "tkey").agg(F.collect_list(F.struct("repeats", "starts")).alias("marks"))
    return arrays(texts.join(marks.hint("shuffle_hash"), ["doc_id", "tkey"], "left"), RESULT, partial(finish, rule=rule))
