"""Exact substring removal: suffixes ordered by radix passes that go no deeper than the threshold.

Suffixes are sorted by their most significant digit first, a digit being eight bytes; each pass orders only within the groups the pass
before left, and drops the groups of one. After the pass that reaches the threshold, the groups left are exactly the
repeated windows. The first digit dealt between tasks is the anchor of a window (see ``repeats``), which equal windows share, and
windows whose whole region is known to be a repeat are not sorted again.

Defined cases: a null text is empty; a row without doc_id keeps all its bytes and removes nothing elsewhere; rows with the same
doc_id remove nothing from each other; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from tidemark.llm.repeats import Rule, bounds, remove_repeats

THRESHOLD = 50
ANCHOR = 20
DIGIT = 8


def depth_limited_order(data: np.ndarray, starts: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix numbers that share their first ``depth`` bytes with another, group by group, and the groups' bounds."""
    left = np.arange(len(starts))
    rank = np.zeros(len(starts), np.int64)
    for at in range(0, depth, DIGIT):
        width = min(DIGIT, depth - at)
        raw = np.zeros((len(left), DIGIT), np.uint8)
        raw[:, :width] = data[starts[left][:, None] + np.arange(at, at + width)]
        digit = raw.view(">u8").ravel().astype(np.uint64)
        by = np.lexsort((digit, rank))
        left, rank, digit = left[by], rank[by], digit[by]
        size = np.diff(bounds(rank, digit))
        group = np.repeat(np.arange(len(size)), size)
        more = np.repeat(size > 1, size)
        left, rank = left[more], group[more]
    return left, bounds(rank)


def sort_windows(rule: Rule, regions: list[bytes], ids: np.ndarray) -> list[np.ndarray]:
    data = np.frombuffer(b"".join(regions), np.uint8)
    sizes = np.fromiter(map(len, regions), np.int64, len(regions))
    base, windows = np.cumsum(sizes) - sizes, sizes - rule.length + 1
    region = np.repeat(np.arange(len(regions)), windows)
    place = np.arange(len(region)) - np.repeat(np.cumsum(windows) - windows, windows)
    same, edge = depth_limited_order(data, base[region] + place, rule.length)
    if not len(same):
        return [np.zeros(0, np.int64)] * len(regions)
    own = ids[region[same]]
    least = np.repeat(np.minimum.reduceat(own, edge[:-1]), np.diff(edge))
    hit = np.sort(same[own > least])
    return np.split(place[hit], np.searchsorted(region[hit], np.arange(1, len(regions))))


def remove_repeated_bytes(docs: DataFrame, threshold: int = THRESHOLD, anchor: int = ANCHOR) -> DataFrame:
    """doc_id, n_units, spans and kept bytes: every byte goes that lies in a window which starts in a smaller doc_id as well."""
    return remove_repeats(docs, Rule("byte", threshold, anchor), sort_windows)
