import hashlib
import random

import brute
import numpy as np
import pytest

from tidemark.llm import automaton_dedup, repeats, suffix_dedup
from tidemark.llm.queries import QUERIES


def shape(df, spans=False):
    out = []
    for r in df.collect():
        row = (r.doc_id, r.n_units, sum(s["end"] - s["first"] for s in r.spans))
        out.append((*row, len(r.spans)) * spans or row)
        out[-1] += (hashlib.sha256(r.kept).hexdigest(),)
    return sorted(out, key=str)


def test_given_tables(spark, given):
    docs = given("documents", "doc_id", "text")
    assert sorted(map(tuple, QUERIES["op2_automaton_dedup"](spark, "/root/testdata/sf0.001").collect())) == sorted(brute.repeated_words(docs))
    assert sorted(map(tuple, QUERIES["op5_suffix_dedup"](spark, "/root/testdata/sf0.001").collect())) == sorted(brute.repeated_bytes(docs))


def mixed(rng, alphabet, joint, n=70):
    text = lambda k: joint.join(rng.choice(alphabet) for _ in range(k))
    passages = [text(rng.randrange(4, 40)) for _ in range(6)]
    rows = []
    for i in rng.sample(range(1000), n):
        rows.append((i, joint.join([text(rng.randrange(8))] + [x for _ in range(rng.randrange(3)) for x in (rng.choice(passages), text(rng.randrange(6)))])))
    rows += [(2000 + i, t) for i, (_, t) in enumerate(rows[:20])]  # copies
    rows += [rows[0], (rows[1][0], rows[2][1]), (None, passages[0]), (3000, None), (3001, ""), (3002, joint.join(passages) * 30)]
    return rows


@pytest.mark.parametrize("heavy", [4096, 1])
@pytest.mark.parametrize("length, anchor", [(8, 3), (6, 6), (5, 1)])
def test_random(spark, documents, heavy, length, anchor):
    rows = mixed(random.Random(length), "abé ", "")
    got = repeats.remove_repeats(documents(rows), repeats.Rule("byte", length, anchor, heavy), suffix_dedup.sort_windows)
    assert shape(got, True) == sorted(brute.repeated_bytes(rows, length), key=str)
    rows = mixed(random.Random(length + 1), ["x", "y", "z", "é"], " ")
    got = repeats.remove_repeats(documents(rows), repeats.Rule("word", length, anchor, heavy), automaton_dedup.stream_shard)
    assert shape(got) == sorted(brute.repeated_words(rows, length), key=str)


def test_empty(spark, documents):
    assert suffix_dedup.remove_repeated_bytes(documents([])).count() == 0
    assert automaton_dedup.remove_repeated_words(documents([(1, None), (None, None)])).count() == 2


def test_radix_order_groups_are_the_repeats():
    rng = np.random.default_rng(1)
    data = rng.integers(0, 3, 3000).astype(np.uint8)
    starts = np.arange(len(data) - 20)
    same, edge = suffix_dedup.depth_limited_order(data, starts, 11)
    seen = {}
    for s in starts:
        seen.setdefault(data[s:s + 11].tobytes(), []).append(int(s))
    want = sorted(v for v in seen.values() if len(v) > 1)
    assert sorted(sorted(same[a:z].tolist()) for a, z in zip(edge[:-1], edge[1:])) == want


def test_automaton_against_search():
    rng = random.Random(5)
    for _ in range(60):
        seqs = [[rng.randrange(3) for _ in range(rng.randrange(30))] for _ in range(5)]
        owners = [rng.randrange(9) for _ in seqs]
        own = automaton_dedup.SuffixAutomaton()
        for s, o in zip(seqs, owners):
            own.add(s, o)
        own.settle()
        for s, o in zip(seqs, owners):
            want = [i for i in range(len(s) - 3) if any(s[i:i + 4] == t[j:j + 4] and p < o for t, p in zip(seqs, owners) for j in range(len(t) - 3))]
            assert own.repeated(s, o, 4) == want


@pytest.mark.parametrize("unit", ["byte", "word"])
def test_passage_of_many_documents_is_no_hot_key(spark, documents, unit):
    """Everything around the passage differs, so none of its edge regions are equal."""
    rng = random.Random(11)
    joint = " " if unit == "word" else ""
    text = lambda k: joint.join(rng.choice("abcdefghijklmnop") for _ in range(k))
    passage = text(30)
    rows = [(i, joint.join([text(30), passage, text(30)])) for i in rng.sample(range(5000), 400)]
    plain = {"byte": suffix_dedup.sort_windows, "word": automaton_dedup.stream_shard}[unit]
    limit = 64  # of 400 holders

    def solve(rule, regions, ids):
        seen = {}
        for r in regions:
            r = tuple(r.split()) if rule.unit == "word" else r
            for i in range(len(r) - rule.length + 1):
                seen[r[i:i + rule.length]] = seen.get(r[i:i + rule.length], 0) + 1
        if max(seen.values()) > limit:
            raise ValueError("a window came with all its holders")
        return plain(rule, regions, ids)

    got = repeats.remove_repeats(documents(rows).repartition(8), repeats.Rule(unit, 20, 6, 4), solve)
    want = brute.repeated_bytes(rows, 20) if unit == "byte" else brute.repeated_words(rows, 20)
    assert shape(got, unit == "byte") == sorted(want, key=str)
    assert sum(r[2] for r in shape(got)) >= 30 * 399


@pytest.mark.parametrize("unit", ["byte", "word"])
def test_windows_of_one_document_stay_where_they_are(spark, documents, unit):
    """Near copies with an edit each: what holds the edit is in no other document and is not sent to be compared window by window."""
    rng = random.Random(12)
    joint = " " if unit == "word" else ""
    passage = [rng.choice("abcdefghijklmnop") for _ in range(60)]
    rows = []
    for i in rng.sample(range(5000), 300):
        at = rng.randrange(10, 50)
        rows.append((i, joint.join(passage[:at] + [rng.choice("qrstuvwxyz") for _ in range(3)] + passage[at:])))
    plain = {"byte": suffix_dedup.sort_windows, "word": automaton_dedup.stream_shard}[unit]
    texts = [t for _, t in rows]

    def solve(rule, regions, ids):
        plain_window = [r.decode() for r in regions if len(r.split() if unit == "word" else r) == rule.length]
        if sum(sum(r in t for t in texts) == 1 for r in plain_window) > 20:
            raise ValueError("windows that one document holds were sent")
        return plain(rule, regions, ids)

    got = repeats.remove_repeats(documents(rows).repartition(8), repeats.Rule(unit, 20, 6, 4), solve)
    want = brute.repeated_bytes(rows, 20) if unit == "byte" else brute.repeated_words(rows, 20)
    assert shape(got, unit == "byte") == sorted(want, key=str)
    assert sum(r[2] for r in shape(got)) > 0
