"""Near-duplicate groups by SuperMinHash signatures, banding, exact verification and union-find.

1. ``signatures``: every shingle of a set takes the positions 0 .. m - 1 of the signature in an order of its own (a random permutation, drawn
   step by step) and offers each position its rank there plus a random fraction; a position keeps the least offer. As each shingle's ranks
   are a permutation, its offers are spread over all positions, which lowers the variance of an estimate against independent hashes. At rank r
   only documents that still have a position of value r or more go on: large sets end after one or two ranks, for whatever m.
2. Equal sets are one class from here on; the smallest doc_id stands for it.
3. A position is kept as 16 bits; ``ROWS`` of them make a band, a 64-bit number. Classes that share a band meet in its bucket, and all buckets
   whose smallest member is the same are one unit. No pairs are written: a class goes to each of its units.
4. In a unit, classes that share a band, agree in ``AGREE`` positions and are not connected yet are compared on their full sets, exactly. What
   links is joined in a union-find, and one row per join is written, so a unit of k classes gives k - 1 rows at most. Units with many shingles are
   split: each part is compared within itself and with the parts before it.
5. Components of these rows, over all units, are the groups.

Two sets at the threshold of 0.85 miss each other if no band agrees: (1 - 0.85^4)^32 = 6e-11 with independent positions, and less with these,
for set sizes below m. Fewer than ``AGREE`` agreements of 128 have a probability below 1e-12 there. Shingles are told apart by 64-bit hashes.

Defined cases: a null or empty text, or one without words, has an empty set and links with nothing; fewer words than a shingle are
one shingle; rows that share a doc_id are one document, which links by any of its texts, each row with the size of its own set; a row without
doc_id links with nothing, has no component and is kept; repeated rows get equal results each; an empty table gives an empty result; other
columns are ignored, or kept by ``kept_documents``. A text of any length is handled as one slice; its permutations are drawn for 65,536 shingles at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.components import components
from tidemark.llm.frames import arrays, spare
from tidemark.llm.scratch import parts, written
from tidemark.llm.text import SPACED, Runs, Words, column, doc_of, mix, pack, slices

SHINGLE, PERCENT = 3, 85
POSITIONS, ROWS = 128, 4  # a band is ROWS positions of 16 bits
BANDS = POSITIONS // ROWS
AGREE = 70
DRAWN = 1 << 16  # shingles whose permutations are in memory at once
UNIT_SHINGLES = 1 << 19  # shingles of a unit that one task compares at once
JOINS = 1 << 14  # rows a task holds before it sends them
OPEN = np.uint64((1 << 64) - 1)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each text, ascending, and where each text's begin."""
    words = Words(data, offsets, SPACED, lower=True)
    runs = Runs(words.hashes())
    n = np.diff(words.offsets)
    each = np.where(n > 0, np.maximum(n - size + 1, 1), 0)
    doc = np.repeat(np.arange(len(n)), each)
    first = np.repeat(words.offsets[:-1] - (np.cumsum(each) - each), each) + np.arange(each.sum())
    tokens = runs.between(first, np.minimum(first + size, words.offsets[1:][doc]))
    by = np.lexsort((tokens, doc))
    doc, tokens = doc[by], tokens[by]
    new = np.ones(len(tokens), bool)
    new[1:] = (tokens[1:] != tokens[:-1]) | (doc[1:] != doc[:-1])
    return tokens[new], np.searchsorted(doc[new], np.arange(len(n) + 1))


def signatures(tokens: np.ndarray, edge: np.ndarray, positions: int = POSITIONS) -> np.ndarray:
    """SuperMinHash signatures of sets, as 64-bit numbers: rank in the upper half, fraction in the lower; open positions of empty sets."""
    count = len(edge) - 1
    signed = np.full(count * positions, OPEN)
    owner = doc_of(edge)
    for a in range(0, len(tokens), DRAWN):
        token, doc = tokens[a:a + DRAWN], owner[a:a + DRAWN]
        order = np.tile(np.arange(positions, dtype=np.uint8 if positions <= 256 else np.uint32), (len(token), 1))
        row = np.arange(len(token))
        for rank in range(positions):
            if rank:  # a document whose positions all have a smaller rank is done
                docs = np.arange(doc[0], doc[-1] + 1)
                going = signed.reshape(count, positions)[docs].max(1) >= np.uint64(rank << 32)
                on = going[doc - doc[0]]
                if not on.any():
                    break
                token, doc, row = token[on], doc[on], row[on]
            drawn = mix(token ^ np.uint64((rank + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
            swap = rank + (((drawn >> np.uint64(32)) * np.uint64(positions - rank)) >> np.uint64(32)).astype(np.int64)
            place = order[row, swap]
            order[row, swap] = order[row, rank]
            offer = np.uint64(rank << 32) | (drawn & np.uint64(0xFFFFFFFF))
            np.minimum.at(signed, doc * positions + place, offer)
    return signed.reshape(count, positions)


def prints_of(signed: np.ndarray) -> np.ndarray:
    """16 bits of each position."""
    return (mix(signed.copy()) >> np.uint64(48)).astype(np.uint16)


def band_keys(prints: np.ndarray) -> np.ndarray:
    """A key for each band of each set; the same positions in another band give another."""
    bands = np.ascontiguousarray(prints).view(np.uint64)
    salts = mix(np.arange(1, bands.shape[1] + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return mix(bands ^ salts)


def set_prints(tokens: np.ndarray, edge: np.ndarray, salt: int) -> np.ndarray:
    """One number for each set, the same for equal sets."""
    sums = np.zeros(len(edge) - 1, np.uint64)
    full = np.flatnonzero(np.diff(edge))
    if len(full):
        sums[full] = np.add.reduceat(mix(tokens ^ np.uint64(salt)), edge[full])
    return sums.view(np.int64)


SIGNED_DDL = "doc_id long, tkey long, n long, print_a long, print_b long, prints binary"


def sign_documents(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, data, offsets in slices(batch, "text"):
            tokens, edge = shingle_sets(data, offsets, size)
            prints = prints_of(signatures(tokens, edge))
            yield pa.RecordBatch.from_arrays([
                column(rows, "doc_id"), column(rows, "tkey"), pa.array(np.diff(edge)), *(pa.array(set_prints(tokens, edge, s)) for s in (0x9E6C63D0876A9A99, 0xC2B2AE3D27D4EB4F)),
                pack(prints.ravel(), np.arange(len(edge)) * POSITIONS)], names=["doc_id", "tkey", "n", "print_a", "print_b", "prints"])


def explode_bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(band, rep) for every band of a class."""
    for batch in batches:
        prints = np.frombuffer(b"".join(column(batch, "prints").to_pylist()), np.uint16).reshape(-1, POSITIONS)
        keys = band_keys(prints)
        yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), pa.array(np.repeat(column(batch, "rep").to_numpy(), keys.shape[1]))], names=["band", "rep"])


SET_DDL = "rep long, tkey long, tokens binary"


def sets_of(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, data, offsets in slices(batch, "text"):
            tokens, edge = shingle_sets(data, offsets, size)
            yield pa.RecordBatch.from_arrays([column(rows, "rep"), column(rows, "tkey"), pack(tokens, edge)], names=["rep", "tkey", "tokens"])


class Unit:
    """Classes of one part of a unit: signatures, sets, and a union-find over them and those that ask."""

    def __init__(self, percent: int):
        self.percent = percent
        self.reps: list[int] = []
        self.sets: list[np.ndarray] = []
        self.known: list[np.ndarray] = []  # 16-bit positions
        self.root = np.zeros(0, np.int64)
        self.table: np.ndarray | None = None

    def add(self, rep: int, tokens: np.ndarray, prints: np.ndarray) -> None:
        self.reps.append(rep)
        self.sets.append(tokens)
        self.known.append(prints)

    def close(self) -> None:
        """No further members come."""
        self.table = np.stack(self.known)
        self.bands = np.ascontiguousarray(self.table).view(np.uint64)
        self.sizes = np.array([len(s) for s in self.sets])
        self.root = np.arange(len(self.sets))

    def links(self, tokens: np.ndarray, prints: np.ndarray, upto: int, own: int) -> list[int]:
        """Members (of the first ``upto``) by which the set becomes connected with what it was not; ``own``: its root, or -1."""
        n, percent = len(tokens), self.percent
        size = self.sizes[:upto]
        open_ = np.flatnonzero((self.root[:upto] != own) & (100 * np.minimum(size, n) >= percent * np.maximum(size, n)))
        if len(open_):
            open_ = open_[(self.bands[open_] == np.ascontiguousarray(prints).view(np.uint64)).any(1)]
        if len(open_):
            open_ = open_[(self.table[open_] == prints).sum(1) >= AGREE]
        joined = []
        while len(open_):
            some, open_ = open_[:64], open_[64:]
            theirs = np.concatenate([self.sets[k] for k in some])
            at = np.minimum(np.searchsorted(tokens, theirs), n - 1)
            edge = np.cumsum([0, *(len(self.sets[k]) for k in some)])
            shared = np.add.reduceat((tokens[at] == theirs).astype(np.int64), edge[:-1])
            for k in some[100 * shared >= percent * (n + self.sizes[some] - shared)].tolist():
                if self.root[k] != own:
                    joined.append(k)
                    own = self.join(k, own)
            open_ = open_[self.root[open_] != own]
        return joined

    def join(self, k: int, own: int) -> int:
        """The root of both; an asking set without a root takes that of the member."""
        other = int(self.root[k])
        if own < 0:
            return other
        low, high = min(other, own), max(other, own)
        self.root[self.root == high] = low
        return low


JOIN_DDL = "a long, b long"


def verify_units(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Rows (a, b) that connect what links in each part of a unit; members come before the classes that ask."""
    unit, where = None, None
    found: list[tuple[int, int]] = []

    def send(least: int = 1) -> Iterator[pa.RecordBatch]:
        if len(found) >= least:
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], names=["a", "b"])
            found.clear()

    def settle() -> Iterator[pa.RecordBatch]:
        """All members are here: they are compared among each other."""
        if unit is None or unit.table is not None or not unit.sets:
            return
        unit.close()
        for k in range(1, len(unit.sets)):
            for other in unit.links(unit.sets[k], unit.table[k], k, int(unit.root[k])):
                found.append((unit.reps[k], unit.reps[other]))
            yield from send(JOINS)

    for batch in batches:
        cells = [column(batch, c) for c in ("lead", "part", "asks", "rep", "tokens", "prints")]
        for lead, part, asks, rep, tokens, prints in zip(*(c.to_pylist() for c in cells[:4]), cells[4], cells[5]):
            if where != (lead, part):
                yield from settle()
                unit, where = Unit(percent), (lead, part)
            tokens, prints = np.frombuffer(tokens.as_buffer(), np.uint64), np.frombuffer(prints.as_buffer(), np.uint16)
            if not asks:
                unit.add(rep, tokens.copy(), prints.copy())
                continue
            if not unit.sets:
                continue
            yield from settle()
            for other in unit.links(tokens, prints, len(unit.sets), -1):
                found.append((rep, unit.reps[other]))
            yield from send(JOINS)
    yield from settle()
    yield from send()


def units_of(classes: DataFrame) -> DataFrame:
    """(rep, lead): the units of every class that shares a band with another."""
    bands = arrays(classes.select("rep", "prints"), "band long, rep long", explode_bands)
    met = bands.groupBy("band").agg(F.min("rep").alias("lead"), F.count("*").alias("members")).filter("members > 1").select("band", "lead")
    return bands.join(met, "band").select("rep", "lead").distinct()


def near_duplicates(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, unit_shingles: int = UNIT_SHINGLES) -> DataFrame:
    """doc_id, tkey (hash of the text), n_shingles, component_id and kept, for each row of documents (doc_id, text)."""
    buckets = parts(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("tkey"))
    signed = written(arrays(texts, SIGNED_DDL, partial(sign_documents, size=size)), "minhash-signatures")
    full = signed.filter("doc_id is not null and n > 0")
    same = ["n", "print_a", "print_b"]
    # The smallest (doc_id, text) of a class stands for it: its text is read again for the set.
    classes = written(full.groupBy(*same).agg(F.min(F.struct("doc_id", "tkey")).alias("first"), F.min("prints").alias("prints"))
                      .select(*same, F.col("first.doc_id").alias("rep"), F.col("first.tkey").alias("tkey"), "prints"), "minhash-classes")
    units = written(units_of(classes), "minhash-units")

    asked = units.select("rep").distinct().join(classes, "rep").select("rep", "tkey", "n", "prints")
    wanted = asked.select("rep", "tkey").distinct()
    met = texts.join(wanted.withColumnRenamed("rep", "doc_id").hint("shuffle_hash"), ["doc_id", "tkey"], "left_semi").select(F.col("doc_id").alias("rep"), "tkey", "text")
    sets = arrays(met, SET_DDL, partial(sets_of, size=size)).groupBy("rep", "tkey").agg(F.first("tokens").alias("tokens"))
    sets = written(sets.join(asked.select("rep", "tkey", "n", "prints"), ["rep", "tkey"]).select("rep", "n", "prints", "tokens"), "minhash-sets")

    many = units.join(asked.groupBy("rep").agg(F.sum("n").alias("n")), "rep").groupBy("lead").agg(F.ceil(F.sum("n") / F.lit(unit_shingles)).cast("int").alias("pieces"))
    dealt = units.join(many, "lead").withColumn("own", F.pmod(F.xxhash64("rep"), F.col("pieces")).cast("int"))
    members = dealt.select("rep", "lead", F.col("own").alias("part"), F.lit(0).alias("asks"))
    asking = dealt.filter("own > 0").select("rep", "lead", F.explode(F.sequence(F.lit(0), F.col("own") - 1)).alias("part"), F.lit(1).alias("asks"))
    work = members.unionByName(asking).join(sets, "rep").repartition(buckets, "lead", "part").sortWithinPartitions("lead", "part", "asks", "n", "rep")
    linked = arrays(work.select("lead", "part", "asks", "rep", "tokens", "prints"), JOIN_DDL, partial(verify_units, percent=percent))

    placed = signed.filter("doc_id is not null").join(classes.select(*same, "rep"), same, "left").withColumn("rep", F.coalesce("rep", "doc_id"))
    # A doc_id with several texts is one document: its classes belong together.
    several = placed.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("z")).filter("a < z").select("doc_id", "a")
    texts_of_one = placed.join(several, "doc_id").select("a", F.col("rep").alias("b"))
    groups = components(linked.unionByName(texts_of_one))
    found = placed.join(groups.withColumnRenamed("node", "rep"), "rep", "left") \
        .select("doc_id", "tkey", F.col("n").alias("n_shingles"), F.coalesce("component", "rep").alias("component_id"))
    lost = signed.filter("doc_id is null").select("doc_id", "tkey", F.col("n").alias("n_shingles"), F.lit(None).cast("long").alias("component_id"))
    return found.unionByName(lost).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def kept_documents(docs: DataFrame) -> DataFrame:
    """The rows of the document with the smallest id of each group, and rows without an id, with the columns they came with."""
    id_, key = spare(docs, "group_id"), spare(docs, "group_text")
    gone = near_duplicates(docs.select("doc_id", "text")).filter("not kept").select(F.col("doc_id").alias(id_), F.col("tkey").alias(key)).distinct()
    return docs.join(gone.hint("shuffle_hash"), (docs["doc_id"] == gone[id_]) & (F.xxhash64(docs["text"]) == gone[key]), "left_anti")
