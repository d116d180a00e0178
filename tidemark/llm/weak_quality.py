"""Quality classifier from weak labels: no document has to be labelled by hand.

1. Heuristic labellers vote good, bad or nothing on every document, from counts over its whole text.
2. Expectation-maximisation over the counts of vote patterns estimates how often each labeller votes what on good and on bad documents, and
   with that the probability that a document with a given pattern is good. There are at most 3 ** labellers patterns, however
   many documents; only their counts reach the driver.
3. The posteriors of a bounded sample of documents (``SAMPLE``, the smallest seeded hashes) train a logistic regression on hashed
   features: words, word shapes, pairs of shapes, and whether a word was just said.
4. The scorer, a fixed number of weights, is broadcast and scores every document whole.

Defined cases: a text without words (null and empty ones too) has score 0 and posterior 0 and is rejected; repeated rows get
the same score; with an empty table there is nothing to learn and the result is empty; all columns of the input are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.frames import arrays, spare, with_struct
from tidemark.llm.scratch import written
from tidemark.llm.text import SPACED, Words, byte_set, mix, pack, slices, unpack

BUCKETS = 1 << 16
SAMPLE = 3000
SEED = 11
KEEP_FROM = 0.5
GOOD, BAD, NONE = 1, 0, 2

_UPPER, _LOWER = byte_set((0x41, 0x5A)), byte_set((0x61, 0x7A))
_SYMBOL = byte_set((0x23, 0x26), (0x2A, 0x2B), (0x3C, 0x3E), (0x40, 0x40), (0x5B, 0x60), (0x7B, 0x7E))
_STOP = byte_set((0x2E, 0x2E), (0x21, 0x21), (0x3F, 0x3F))
_COMMA = byte_set((0x2C, 0x2C), (0x3A, 0x3B))
_DIGIT = byte_set((0x30, 0x39))
_CLASS = np.full(256, 6, np.uint64)  # of a byte in a word's shape: letters beyond ASCII are 6
for _k, _set in enumerate((_LOWER, _UPPER, _DIGIT, _STOP, _COMMA, _SYMBOL)):
    _CLASS[_set] = _k
_CLASS[byte_set((0x00, 0x20), (0x22, 0x22), (0x27, 0x29), (0x2D, 0x2D), (0x2F, 0x2F), (0x7F, 0x7F))] = 7

# Frequent function words of the languages expected.
FUNCTION_WORDS = (
    "the of and to in a is that it for was on are as with be by this from or an at which "
    "de la que el en y los se del las un por con no una su para es lo como "
    "le les des et du dans pour au qui ne sur par il une plus ce "
    "der die und den von zu das mit sich des auf ist im dem nicht ein eine als auch"
).split()


@dataclass(frozen=True)
class Labeller:
    """Votes on one count per document: bad from ``bad`` on (or below it, if ``bad`` is the smaller), good beyond ``good``."""

    name: str
    count: str
    good: float
    bad: float
    least_words: int = 1

    def votes(self, counts: dict[str, np.ndarray]) -> np.ndarray:
        x = counts[self.count]
        high = self.bad > self.good
        out = np.full(len(x), NONE)
        out[x <= self.good if high else x >= self.good] = GOOD
        out[x >= self.bad if high else x <= self.bad] = BAD
        out[counts["words"] < self.least_words] = NONE
        return out


#: Thresholds of published web-corpus filters, rounded; the labellers overlap on purpose.
LABELLERS = (
    Labeller("symbols", "symbols", 0.02, 0.1),
    Labeller("symbol words", "symbol_words", 0.05, 0.3),
    Labeller("capitals", "capitals", 0.15, 0.5),
    Labeller("shouting", "shouting", 0.1, 0.3),
    Labeller("echoes", "echoes", 0.03, 0.15, 5),
    Labeller("variety", "variety", 0.5, 0.2, 20),
    Labeller("pairs", "pair_variety", 0.7, 0.4, 20),
    Labeller("function words", "function_words", 0.1, 0.01, 20),
    Labeller("lone marks", "lone_marks", 0.02, 0.1),
)


def per_doc(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums by text; a text's sum does not depend on the texts around it."""
    out, full = np.zeros(len(offsets) - 1), np.flatnonzero(np.diff(offsets))
    if len(full):
        out[full] = np.add.reduceat(values.astype(np.float64), offsets[full])
    return out


def _distinct(hashes: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    keys, first = np.unique(hashes ^ mix(doc.astype(np.uint64) + np.uint64(1)), return_index=True)
    return np.bincount(doc[first], minlength=n)


class Texts:
    """Words of several texts, and what labellers and features read off them."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.words = Words(data, offsets, SPACED, lower=True)
        self.data, self.bytes = data, offsets
        self.hashes = self.words.hashes()
        self.offsets = self.words.offsets
        self.n = len(offsets) - 1
        self.doc = np.repeat(np.arange(self.n), np.diff(self.offsets))
        first = np.zeros(len(self.hashes), bool)
        first[self.offsets[:-1][np.diff(self.offsets) > 0]] = True
        before = np.roll(self.hashes, 1)
        self.echo = (self.hashes == before) & ~first
        self.first = first

    def counts(self) -> dict[str, np.ndarray]:
        data, words, off = self.data, self.words, self.offsets
        n = np.maximum(np.diff(off), 1)
        size = np.maximum(np.diff(self.bytes), 1)
        upper, lower = per_doc(_UPPER[data], self.bytes), per_doc(_LOWER[data], self.bytes)
        last = data[np.maximum(words.end - 1, 0)] if len(words.end) else np.zeros(0, np.uint8)
        length = words.end - words.first
        letters = np.concatenate([[0], np.cumsum(_UPPER[data] | _LOWER[data] | _DIGIT[data] | (data >= 0x80))])
        pairs = mix(self.hashes * np.uint64(3) + np.roll(self.hashes, 1))
        inner = ~self.first
        return {
            "words": np.diff(off),
            "symbols": per_doc(_SYMBOL[data], self.bytes) / size,
            "symbol_words": per_doc(_SYMBOL[last], off) / n,
            "capitals": upper / np.maximum(upper + lower, 1),
            "shouting": per_doc(last == 0x21, off) / n,
            "echoes": per_doc(self.echo, off) / n,
            "variety": _distinct(self.hashes, self.doc, self.n) / n,
            "pair_variety": _distinct(pairs[inner], self.doc[inner], self.n) / np.maximum(n - 1, 1),
            "function_words": per_doc(np.isin(self.hashes, _function_words()), off) / n,
            "lone_marks": per_doc((letters[words.end] - letters[words.first] == 0) & (length <= 3), off) / n,
        }

    def features(self) -> np.ndarray:
        """Buckets of the features of each word, one row per word."""
        data, words = self.data, self.words
        length = (words.end - words.first).astype(np.uint64)
        shape = np.minimum(length, np.uint64(12))
        for k in range(2):  # the first two bytes and the last three
            shape = shape * np.uint64(8) + _CLASS[data[np.minimum(words.first + k, words.end - 1)]]
        for k in range(1, 4):
            shape = shape * np.uint64(8) + _CLASS[data[np.maximum(words.end - k, words.first)]]
        shape = mix(shape + np.uint64(1))
        before = np.where(self.first, np.uint64(0), np.roll(shape, 1))
        second = ~self.first & ~np.roll(self.first, 1)  # at least two words of the text stand before
        said = np.where(self.echo, np.uint64(1), np.where(second & (np.roll(self.hashes, 2) == self.hashes), np.uint64(2), np.uint64(3)))
        kinds = (self.hashes, shape, shape * np.uint64(5) + before, said)
        return np.stack([(mix(x * np.uint64(16) + np.uint64(k + 1)) % np.uint64(BUCKETS)).astype(np.int32) for k, x in enumerate(kinds)], 1)


def _function_words() -> np.ndarray:
    texts = " ".join(sorted(set(FUNCTION_WORDS))).encode()
    return np.sort(Words(np.frombuffer(texts, np.uint8), np.array([0, len(texts)]), SPACED, lower=True).hashes())


def vote_patterns(texts: Texts, labellers=LABELLERS) -> np.ndarray:
    """The votes on each document as one number, base three."""
    counts, out = texts.counts(), np.zeros(texts.n, np.int64)
    for labeller in labellers:
        out = out * 3 + labeller.votes(counts)
    return out


def unfold(patterns: np.ndarray, labellers: int) -> np.ndarray:
    """Votes by pattern and labeller."""
    return patterns[:, None] // 3 ** np.arange(labellers - 1, -1, -1) % 3


@dataclass
class LabelModel:
    """How labellers vote on bad and good documents: log probabilities by class, labeller and vote."""

    prior: np.ndarray
    votes: np.ndarray

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """Probability of good."""
        cast = unfold(patterns, self.votes.shape[1])
        logs = np.log(self.prior) + np.log(self.votes[:, np.arange(cast.shape[1]), cast]).sum(2).T
        return 1 / (1 + np.exp(np.clip(logs[:, BAD] - logs[:, GOOD], -500, 500)))


def fit_labels(patterns: np.ndarray, counts: np.ndarray, labellers: int = len(LABELLERS), rounds: int = 100) -> LabelModel:
    """Expectation-maximisation, started from the majority of the votes: any bad vote outweighs one good one."""
    cast = unfold(patterns, labellers)
    good, bad = (cast == GOOD).sum(1), (cast == BAD).sum(1)
    p = np.where(bad >= np.maximum(1, good / 3), 0.1, 0.9)
    for _ in range(rounds):
        weight = np.stack([(1 - p) * counts, p * counts])
        prior = (weight.sum(1) + 1) / (weight.sum() + 2)
        votes = np.stack([[[(w * (cast[:, j] == v)).sum() for v in (BAD, GOOD)] for j in range(labellers)] for w in weight]) + 0.5
        votes = np.concatenate([votes / votes.sum(2, keepdims=True), np.ones((2, labellers, 1))], 2)  # no vote says nothing
        model = LabelModel(prior, votes)
        new = model.posterior(patterns)
        if np.abs(new - p).max() < 1e-6:
            break
        p = new
    return model


@dataclass
class Scorer:
    """Mean weight of a document's features, and a bias, through the logistic function."""

    weights: np.ndarray
    bias: float

    def score(self, texts: Texts) -> np.ndarray:
        per_word = self.weights[texts.features()].sum(1) if len(texts.hashes) else np.zeros(0)
        n = np.diff(texts.offsets)
        z = per_doc(per_word, texts.offsets) / np.maximum(n, 1) + self.bias
        return np.where(n > 0, 1 / (1 + np.exp(-np.clip(z, -50, 50))), 0.0)


def fit_scorer(rows: np.ndarray, buckets: np.ndarray, shares: np.ndarray, labels: np.ndarray, rounds: int = 300, rate: float = 1.0, decay: float = 1e-6) -> Scorer:
    """Logistic regression with soft labels by adaptive gradient steps over all rows.

    Entries (row, bucket, share) are sorted by row. The classes weigh the same, as bad documents are few.
    """
    weights, bias = np.zeros(BUCKETS), 0.0
    seen, seen_bias = np.full(BUCKETS, 1e-10), 1e-10
    sums = np.array([max(1e-9, (1 - labels).sum()), max(1e-9, labels.sum())])
    for _ in range(rounds):
        z = np.bincount(rows, weights[buckets] * shares, minlength=len(labels)) + bias
        p = 1 / (1 + np.exp(-np.clip(z, -50, 50)))
        # Soft labels: each document counts as good and as bad, by its posterior.
        off = p * (1 - labels) / sums[0] / 2 - (1 - p) * labels / sums[1] / 2
        slope = np.bincount(buckets, off[rows] * shares, minlength=BUCKETS) + decay * weights
        seen += slope * slope
        weights -= rate * slope / np.sqrt(seen)
        seen_bias += off.sum() ** 2
        bias -= 0.1 * rate * off.sum() / np.sqrt(seen_bias)
    return Scorer(weights, float(bias))


def _votes(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, data, offsets in slices(batch, text):
            texts = Texts(data, offsets)
            full = np.diff(texts.offsets) > 0
            yield pa.RecordBatch.from_arrays([
                pa.array(vote_patterns(texts)[full]), rows.column(1).filter(pa.array(full))], names=["pattern", "pick"])


def _examples(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, data, offsets in slices(batch, text):
            texts = Texts(data, offsets)
            n = np.diff(texts.offsets)
            features = texts.features()
            keys, count = np.unique(np.repeat(texts.doc, features.shape[1]) * BUCKETS + features.ravel(), return_counts=True)
            doc = keys // BUCKETS
            edge = np.searchsorted(doc, np.arange(texts.n + 1))
            shares = (count / np.maximum(n, 1)[doc]).astype(np.float32)
            full = pa.array(n > 0)
            yield pa.RecordBatch.from_arrays([
                pa.array(vote_patterns(texts)).filter(full), pack((keys % BUCKETS).astype(np.int32), edge).filter(full), pack(shares, edge).filter(full)],
                names=["pattern", "buckets", "shares"])


def fit(docs: DataFrame, text: str = "text", sample: int = SAMPLE) -> tuple[LabelModel, Scorer] | None:
    """The label model from all documents, and the scorer from a sample of at most ``sample`` documents with words."""
    picked = docs.select(text, F.xxhash64(F.lit(SEED), F.col(text)).alias("pick"))
    votes = written(arrays(picked, "pattern long, pick long", lambda b: _votes(b, text)), "votes")
    found = sorted(map(tuple, votes.groupBy("pattern").count().collect()))
    if not found:
        return None
    labels = fit_labels(np.array([r[0] for r in found]), np.array([r[1] for r in found], float))
    last = votes.select("pick").distinct().orderBy("pick").limit(sample).agg(F.max("pick")).first()[0]
    rows = arrays(picked.filter(F.col("pick") <= last).dropDuplicates(["pick"]), "pattern long, buckets binary, shares binary", lambda b: _examples(b, text)).collect()
    rows.sort(key=lambda r: (r[0], bytes(r[1])))  # the sum of slopes is the same on every run
    buckets, shares = unpack([r[1] for r in rows], np.int32), unpack([r[2] for r in rows], np.float32)
    number = np.repeat(np.arange(len(rows)), [len(r[1]) // 4 for r in rows])
    return labels, fit_scorer(number, buckets, shares, labels.posterior(np.array([r[0] for r in rows])))


def judge_quality(docs: DataFrame, out: str, text: str = "text", sample: int = SAMPLE) -> DataFrame:
    """``docs`` with a struct ``out``: score (of the scorer), posterior (of the votes) and rejected."""
    models = docs.sparkSession.sparkContext.broadcast(fit(docs, text, sample))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Array]:
        for batch in batches:
            score, posterior = np.zeros(batch.num_rows), np.zeros(batch.num_rows)
            labels, scorer = models.value or (None, None)
            at = 0
            for rows, data, offsets in slices(batch, text):
                texts, z = Texts(data, offsets), at + rows.num_rows
                if not scorer:
                    break  # no document has words
                score[at:z] = scorer.score(texts)
                posterior[at:z] = np.where(np.diff(texts.offsets) > 0, labels.posterior(vote_patterns(texts)), 0)
                at = z
            yield pa.StructArray.from_arrays([pa.array(score), pa.array(posterior), pa.array(score < KEEP_FROM)], names=["score", "posterior", "rejected"])

    return with_struct(docs, out, "score double, posterior double, rejected boolean", work)


def good_documents(docs: DataFrame) -> DataFrame:
    """The documents that are not rejected, with the columns they came with."""
    out = spare(docs, "quality")
    return judge_quality(docs, out).filter(~F.col(f"`{out}`.rejected")).drop(out)
