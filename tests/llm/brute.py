"""Plain single-process versions of what the operators compute, straight from their definitions."""

import hashlib
import re

SPACED = re.compile(rb"[^\x20\x09-\x0D]+")
ALNUM = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text, pattern=SPACED, lower=False):
    data = (text or "").encode()
    return pattern.findall(data.lower() if lower else data)


def repeats(docs, length):
    """docs: (doc_id, sequence). For each, the places covered by a run that starts in a document with a smaller id."""
    least = {}
    for doc_id, seq in docs:
        for i in range(len(seq) - length + 1 if doc_id is not None else 0):
            run = tuple(seq[i:i + length])
            least[run] = min(least.get(run, doc_id), doc_id)
    out = []
    for doc_id, seq in docs:
        hit = [False] * len(seq)
        for i in range(len(seq) - length + 1 if doc_id is not None else 0):
            if least[tuple(seq[i:i + length])] < doc_id:
                hit[i:i + length] = [True] * length
        out.append(hit)
    return out


def repeated_words(docs, length=50):
    seqs = [(d, words(t)) for d, t in docs]
    for (doc_id, seq), hit in zip(seqs, repeats(seqs, length)):
        kept = b" ".join(w for w, h in zip(seq, hit) if not h)
        yield doc_id, len(seq), sum(hit), hashlib.sha256(kept).hexdigest()


def repeated_bytes(docs, length=50):
    seqs = [(d, (t or "").encode()) for d, t in docs]
    for (doc_id, seq), hit in zip(seqs, repeats(seqs, length)):
        kept = bytes(b for b, h in zip(seq, hit) if not h)
        runs = sum(h and not (i and hit[i - 1]) for i, h in enumerate(hit))
        yield doc_id, len(seq), sum(hit), runs, hashlib.sha256(kept).hexdigest()


def hits(docs, items, window=13):
    """items: (item_id, text)."""
    wanted = {}
    for item_id, text in items:
        seq = words(text, ALNUM, True) if item_id is not None else []
        for run in [tuple(seq[i:i + window]) for i in range(len(seq) - window + 1)] or [tuple(seq)] * bool(seq):
            wanted.setdefault(run, set()).add(item_id)
    lengths = {len(run) for run in wanted}
    for doc_id, text in docs:
        seq = words(text, ALNUM, True)
        hit, found = [False] * len(seq), set()
        for n in lengths:
            for i in range(len(seq) - n + 1):
                if (run := tuple(seq[i:i + n])) in wanted:
                    hit[i:i + n] = [True] * n
                    found |= wanted[run]
        digest = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
        yield doc_id, len(seq), sum(hit), len(found), digest, sum(hit) > 0 and 20 * sum(hit) >= len(seq)


def shingles(text, size=5):
    seq = words(text, lower=True)
    return {tuple(seq[i:i + size]) for i in range(len(seq) - size + 1)} or ({tuple(seq)} if seq else set())


def linked(docs, percent=75):
    """(doc_id, set size, smallest doc_id reachable)."""
    return linked_sets([(d, shingles(t)) for d, t in docs], percent)


def linked_sets(sets, percent):
    root = {d: d for d, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = sorted((find(a), find(b)))
                root[q] = p
    for d, s in sets:
        yield d, len(s), find(d)
