import struct
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import token_files as T
from tidemark.llm.queries import QUERIES
from tidemark.llm.text import text_bytes

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")


def plain(docs):
    from tokenizers import Tokenizer

    tokenizer, start = Tokenizer.from_file(PATH), 0
    for doc_id, text in sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0)):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        yield doc_id, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))
        start += len(ids)


ODD = [
    "", None, " ", "don't 'S we'll x's '", "a.b,c;;d!?", "A<|endoftext|>b <|startoftext|>", "é́ é  x y\x1cz\x85q",
    "ΑΣ ΑΣ. σς İstanbul ẞ", "12 3.5 ½x٣", "…a“b”.c—d", "≠ .́a á. ́x", "漢字かな 🙂🙂a", "\x00\x01 a\x00b", "x" * 5000, "the " * 3000, "퟿_a_b-c'd''s",
]


def test_given_table(spark, given):
    got = sorted(tuple(r) for r in QUERIES["op3_token_files"](spark, "/root/testdata/sf0.001").collect())
    assert got == sorted(plain(given("documents", "doc_id", "text")))


@pytest.mark.parametrize("name, by_rule", [("word_bpe_49k.json", True), ("byte_bpe_50k.json", False)])
def test_odd_texts_one_by_one(name, by_rule):
    known = T.Encoder(public_tokenizers.path(name))
    assert known.by_rule == by_rule
    for text in ODD:
        data, offsets = text_bytes(pa.array([text, "ab", text]))
        ids, counts = known.encode(data, offsets)
        own = [*known.tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        assert counts.tolist() == [len(own), len(counts) and len(known.tokenizer.encode("ab", add_special_tokens=False).ids) + 1, len(own)], text
        assert ids[:len(own)].tolist() == own, text


def test_order_nulls_and_empty(spark, documents):
    rows = [(i, t) for i, t in zip([5, 3, 9, 1, 7, 2, 8, 4, 0, 6, 10, 11, 12, 13, 14, 15], ODD)]
    got = sorted(tuple(r) for r in T.token_table(documents(rows)).collect())
    assert got == sorted(plain(rows))
    twice = [(1, "a b"), (1, "a b"), (None, None)]
    assert sorted((tuple(r) for r in T.token_table(documents(twice)).collect()), key=str) == sorted(plain(twice), key=str)
    assert T.token_table(documents([])).count() == 0


def test_random_access_without_copies(tmp_path):
    path = str(tmp_path / "x.arrow")
    ids = np.arange(70_000, dtype=np.uint16)
    with open(path, "wb") as sink:
        out = T.SequenceFile(sink, np.uint16, 128)
        for part in np.array_split(ids, 7):
            out.add(part)
        out.close()
    mapped = pa.memory_map(path)
    file = pa.ipc.open_file(mapped)
    before = pa.total_allocated_bytes()
    for k in (0, 63, 64, 300, 546):
        row, mask = T.sequence(file, k)
        want = ids[k * 128:(k + 1) * 128]
        assert row[:len(want)].tolist() == want.tolist() and mask.sum() == len(want) and len(row) == 128
    assert pa.total_allocated_bytes() - before < 4096
