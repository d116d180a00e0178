"""Token ids as Arrow files of equal-length sequences, written by the executors and read back without copies.

Documents are dealt by ranges of doc_id; each task encodes its range in order and writes one file. A file is an Arrow
stream with a footer whose record batches hold ``BATCH`` rows of two fixed-size lists: ``ids`` and ``mask`` (true for a
real id). All sequences are equally long, so sequence k is row k % BATCH of batch k // BATCH, and a memory-mapped file
gives it without decoding or copying. The ids of a file run on across its rows; only the last row is padded. Beside
each file lies one with the documents in it: doc_id, first id, number of ids.

Files get a name of their own for each attempt of a task, and only those that the manifest names count: a lost executor or a
second attempt leaves at worst a file that nobody reads.

Encoding: the vocabulary's rules never look across ASCII white space or from an ASCII letter to ASCII punctuation, so
distinct pieces between such places are encoded once per worker and kept in a bounded table; a document's ids are gathered
from it. Texts that hold the opening of a special token are encoded whole.

Defined cases: a null or empty text is a document of the end id alone; null doc_ids come first; repeated rows are documents
of their own, in any order among equal ones; an empty table gives no files and an empty result; further columns are
ignored here.
"""

from __future__ import annotations

import uuid
import zlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidemark.llm.frames import arrays
from tidemark.llm.scratch import folder, parts, written
from tidemark.llm.text import SPACED, Words, byte_set, column, slices

END = 2
SEQUENCE = 2048
BATCH = 64
KEPT_PIECES = 1 << 20
_LETTER = byte_set((0x41, 0x5A), (0x61, 0x7A))
_PUNCTUATION = byte_set((0x21, 0x26), (0x28, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7E))  # without the apostrophe


# How the vocabulary that is cut here by rule normalizes and cuts texts. Other ones get whole texts.
NORMALIZED = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
CUT = [
    {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
]


def cut_by_rule(path: str) -> bool:
    """Whether a tokenizer file normalizes and cuts as above."""
    with open(path, encoding="utf-8") as file:
        told = json.load(file)
    parts = [((told.get(k) or {}).get(inner)) for k, inner in (("normalizer", "normalizers"), ("pre_tokenizer", "pretokenizers"))]
    return parts == [NORMALIZED, CUT] and told["model"]["type"] == "BPE"


class Encoder:
    """Ids of whole texts by a tokenizer, with the ids of the pieces met so far at hand if it cuts texts as this class does."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.by_rule = cut_by_rule(path)
        self.width = np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        self.specials = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.clear()

    def clear(self) -> None:
        self.keys, self.slots = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.starts, self.ids = np.zeros(1, np.int64), np.zeros(0, self.width)

    def learn(self, keys: np.ndarray, pieces: list[bytes]) -> None:
        texts = [p.decode() for p in pieces]
        plain = [t.isascii() and t.isalpha() for t in texts]
        rest = iter(self.tokenizer.encode_batch_fast([t for t, p in zip(texts, plain) if not p], add_special_tokens=False))
        model = self.tokenizer.model
        found = [[x.id for x in model.tokenize(t.lower())] if p else next(rest).ids for t, p in zip(texts, plain)]
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        at = np.searchsorted(self.keys, keys)
        self.slots = np.insert(self.slots, at, len(self.starts) - 1 + np.arange(len(keys)))
        self.keys = np.insert(self.keys, at, keys)
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(lengths)])
        self.ids = np.concatenate([self.ids, np.fromiter((i for x in found for i in x), self.width, int(lengths.sum()))])

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids, each text's followed by the end id, and the number of ids of each text."""
        if not self.by_rule:
            return self.encode_texts(data, offsets)
        words = Words(data, offsets, SPACED, lower=True)
        letter, other = _LETTER[data], _PUNCTUATION[data]
        cut = np.flatnonzero((letter[:-1] & other[1:]) | (other[:-1] & letter[1:])) + 1
        cut = cut[~np.isin(cut, offsets)] if len(offsets) > 2 else cut
        words.first, words.end = np.sort(np.concatenate([words.first, cut])), np.sort(np.concatenate([words.end, cut]))
        bounds = np.searchsorted(words.first, offsets)
        hashes = words.hashes()
        if len(self.keys) > KEPT_PIECES:
            self.clear()
        keys, place, number = np.unique(hashes, return_index=True, return_inverse=True)
        near = np.searchsorted(self.keys, keys)
        new = (np.append(self.keys, np.uint64(0))[near] != keys) | (near == len(self.keys))
        if new.any():
            raw = data.tobytes()
            self.learn(keys[new], [raw[a:z].lower() for a, z in zip(words.first[place[new]].tolist(), words.end[place[new]].tolist())])
        slot = self.slots[np.searchsorted(self.keys, keys)][number]
        start, length = self.starts[slot], self.starts[slot + 1] - self.starts[slot]
        ends = np.cumsum(length)
        upto = np.concatenate([[0], ends])
        counts = upto[bounds[1:]] - upto[bounds[:-1]]
        # One pass over all ids: where each piece goes (after the end ids of the texts before) and where it comes from.
        total = int(upto[-1])
        text = np.repeat(np.arange(len(counts)), np.diff(bounds))
        ids = np.full(total + len(counts), END, self.width)
        source = np.arange(total) + np.repeat(start - (ends - length), length)
        ids[np.arange(total) + np.repeat(text, length)] = self.ids[source]
        return self.whole(ids, counts + 1, data, offsets)

    def encode_texts(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        raw = data.tobytes()
        found = self.tokenizer.encode_batch_fast([raw[a:z].decode() for a, z in zip(offsets[:-1].tolist(), offsets[1:].tolist())], add_special_tokens=False)
        ids = [np.array([*x.ids, END], self.width) for x in found]
        return np.concatenate([np.zeros(0, self.width), *ids]), np.fromiter(map(len, ids), np.int64, len(ids))

    def whole(self, ids: np.ndarray, counts: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        raw = data.tobytes()
        if not any(s in raw for s in self.specials):
            return ids, counts
        out, at = [], 0
        for k, n in enumerate(counts.tolist()):
            text = raw[offsets[k]:offsets[k + 1]]
            if any(s in text for s in self.specials):
                own = self.tokenizer.encode(text.decode(), add_special_tokens=False).ids
                out.append(np.array([*own, END], self.width))
            else:
                out.append(ids[at:at + n])
            at += n
        return np.concatenate(out), np.fromiter(map(len, out), np.int64, len(out))


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


class SequenceFile:
    """Writes a run of ids as rows of equal length, a record batch at a time."""

    def __init__(self, sink, width, length: int):
        self.length = length
        self.schema = pa.schema([("ids", pa.list_(pa.from_numpy_dtype(width), length)), ("mask", pa.list_(pa.bool_(), length))])
        self.writer = pa.ipc.new_file(sink, self.schema)
        self.held: list[np.ndarray] = []
        self.n, self.width = 0, width

    def add(self, ids: np.ndarray) -> None:
        self.held.append(ids)
        self.n += len(ids)
        if self.n >= BATCH * self.length:
            self.flush(self.n // (BATCH * self.length) * BATCH)

    def flush(self, rows: int) -> None:
        ids = np.concatenate(self.held) if self.held else np.zeros(0, self.width)
        self.held, self.n = [ids[rows * self.length:]], max(0, len(ids) - rows * self.length)
        ids = ids[:rows * self.length]
        for at in range(0, rows, BATCH):
            n = min(BATCH, rows - at)
            part = ids[at * self.length:(at + n) * self.length]
            row = np.zeros(n * self.length, self.width)
            row[:len(part)] = part
            mask = pa.array(np.arange(n * self.length) < len(part))
            self.writer.write_batch(pa.RecordBatch.from_arrays(
                [pa.FixedSizeListArray.from_arrays(pa.array(row), self.length), pa.FixedSizeListArray.from_arrays(mask, self.length)],
                schema=self.schema))

    def close(self) -> None:
        self.flush(-(-self.n // self.length))
        self.writer.close()


def _place(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path if "://" in path else f"file://{path}")


MANIFEST = "part int, file string, index string, first_doc long, n_docs long, n_tokens long"


def write_token_files(docs: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text: str = "text", length: int = SEQUENCE) -> DataFrame:
    """Writes the files below ``path``, a folder all executors reach, and returns the manifest: one row per file, in order."""
    from pyspark import TaskContext

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoder(tokenizer)
        fs, root = _place(path)
        name = sequences = index = None
        first, docs_seen, tokens = None, 0, 0
        schema = pa.schema([("doc_id", pa.int64()), ("first", pa.int64()), ("n_tokens", pa.int64())])
        for batch in batches:
            if not batch.num_rows:
                continue
            if name is None:
                name = f"{root}/{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
                fs.create_dir(root, recursive=True)
                sink, side = fs.open_output_stream(f"{name}.arrow"), fs.open_output_stream(f"{name}.docs.arrow")
                sequences, index = SequenceFile(sink, known.width, length), pa.ipc.new_file(side, schema)
                first = column(batch, id_col)[0].as_py()
            for rows, data, offsets in slices(batch, text):
                ids, counts = known.encode(data, offsets)
                sequences.add(ids)
                index.write_batch(pa.RecordBatch.from_arrays(
                    [column(rows, id_col).cast(pa.int64()), pa.array(tokens + np.cumsum(counts) - counts), pa.array(counts)], schema=schema))
                tokens += int(counts.sum())
                docs_seen += rows.num_rows
        if name is not None:
            sequences.close()
            index.close()
            sink.close()
            side.close()
            leaf = name.rsplit("/", 1)[1]
            yield pa.RecordBatch.from_pylist([{
                "part": TaskContext.get().partitionId(), "file": f"{leaf}.arrow", "index": f"{leaf}.docs.arrow", "first_doc": first,
                "n_docs": docs_seen, "n_tokens": tokens}], schema=pa.schema([
                    ("part", pa.int32()), ("file", pa.string()), ("index", pa.string()), ("first_doc", pa.int64()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())]))

    dealt = docs.select(id_col, text).repartitionByRange(parts(docs.sparkSession), F.col(id_col).asc_nulls_first())
    made = written(arrays(dealt.sortWithinPartitions(F.col(id_col).asc_nulls_first()), MANIFEST, write), "token-manifest")
    # One row per file: a window over all of them is small.
    return made.withColumn("start", F.sum("n_tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n_tokens"))


def sequence(file, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence k of an open token file, as views of the file's memory: ids, and the mask's bits unpacked."""
    row = file.get_batch(k // BATCH)
    ids, mask = row.column(0), row.column(1)
    return ids[k % BATCH].values.to_numpy(zero_copy_only=True), mask[k % BATCH].values.to_numpy(zero_copy_only=False)


def _crcs(file, first: np.ndarray, counts: np.ndarray) -> Iterator[int]:
    """The checksum of each document's ids as 32-bit integers, reading the file batch by batch."""
    batch, at, end, ids = -1, 0, 0, None
    for a, n in zip(first.tolist(), counts.tolist()):
        crc = 0
        while n:
            if a >= end:
                batch += 1
                ids = file.get_batch(batch).column(0).flatten().to_numpy(zero_copy_only=True)
                at, end = end, end + len(ids)
                continue
            take = ids[a - at:min(a + n, end) - at]
            crc = zlib.crc32(take.astype("<u4").tobytes(), crc)
            a, n = a + len(take), n - len(take)
        yield crc


def read_token_files(spark: SparkSession, manifest: DataFrame, path: str) -> DataFrame:
    """One row per document from the files: doc_id, start (ids of all documents before), n_tokens, ids_crc32."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _place(path)
        for batch in batches:
            for row in batch.to_pylist():
                opened = [pa.memory_map(f"{root}/{row[k]}") if isinstance(fs, pafs.LocalFileSystem) else fs.open_input_file(f"{root}/{row[k]}")
                          for k in ("file", "index")]
                file, index = map(pa.ipc.open_file, opened)
                for k in range(index.num_record_batches):
                    docs = index.get_batch(k)
                    first, counts = docs.column(1).to_numpy(), docs.column(2).to_numpy()
                    if k == 0:
                        crcs = _crcs(file, *(np.concatenate([index.get_batch(j).column(c).to_numpy() for j in range(index.num_record_batches)]) for c in (1, 2)))
                    yield pa.RecordBatch.from_arrays([
                        docs.column(0), pa.array(row["start"] + first), pa.array(counts), pa.array([next(crcs) for _ in range(len(counts))], pa.int64()),
                    ], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    files = manifest.select("file", "index", "start").repartition(parts(spark), "file")
    return arrays(files, "doc_id long, start long, n_tokens long, ids_crc32 long", read)


def token_table(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Documents written as token files in the shared folder, and what reading them back gives."""
    import public_tokenizers

    path = folder(docs.sparkSession, "tokens")
    manifest = write_token_files(docs, path, tokenizer or public_tokenizers.path("word_bpe_49k.json"))
    return read_token_files(docs.sparkSession, manifest, path)
