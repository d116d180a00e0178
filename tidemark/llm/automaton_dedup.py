"""Removal of long repeated spans of words with suffix automata of reference shards.

A shard is a bounded set of passages that may repeat each other (see ``repeats``, which routes passages by anchor). Its suffix automaton
holds, for each state, the smallest doc_id in which the state's words end. Passages are streamed through it; the matching
statistic, kept at no more than the threshold, leads at each word to the state of the window that ends there, and the window goes if the
state's smallest id is below the passage's own. A broadcast of automata of all documents would grow with the corpus, so each
automaton is built where the passages that can match it have been sent.

Defined cases: a null text has no words; a row without doc_id keeps all its words and removes nothing elsewhere; rows with the same
doc_id remove nothing from each other; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from tidemark.llm.repeats import Rule, remove_repeats

THRESHOLD = 50
ANCHOR = 8
PASSAGES = 512  # of one anchor in a shard at most; a shard's automaton has about 2 states for each of its words
SHARD_WORDS = 1 << 16
NO_ID = 1 << 63


class SuffixAutomaton:
    """Of several sequences, with the smallest owner of every state; no state's words cross from one sequence to the next."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.length, self.least = [-1], [0], [NO_ID]

    def add(self, symbols: list, owner: int) -> None:
        last = 0
        for c in symbols:
            last = self._extend(last, c, owner)

    def _state(self, length: int, link: int, edges: dict, owner: int) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.length.append(length)
        self.least.append(owner)
        return len(self.next) - 1

    def _extend(self, last: int, c, owner: int) -> int:
        edges, link, length = self.next, self.link, self.length
        known = edges[last].get(c)
        if known is not None and length[known] == length[last] + 1:
            self.least[known] = min(self.least[known], owner)
            return known
        new = self._state(length[last] + 1, 0, {}, owner) if known is None else None
        at = last
        if known is None:
            while at >= 0 and c not in edges[at]:
                edges[at][c] = new
                at = link[at]
            if at < 0:
                return new
        old = edges[at][c]
        if length[old] == length[at] + 1:
            link[new] = old
            return new
        copy = self._state(length[at] + 1, link[old], dict(edges[old]), NO_ID)
        link[old] = copy
        while at >= 0 and edges[at].get(c) == old:
            edges[at][c] = copy
            at = link[at]
        if new is None:
            self.least[copy] = owner
            return copy
        link[new] = copy
        return new

    def settle(self) -> None:
        """A state's words also end wherever those of the states linked to it do."""
        for v in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            up = self.link[v]
            if self.least[v] < self.least[up]:
                self.least[up] = self.least[v]

    def repeated(self, symbols: list, owner: int, window: int) -> list[int]:
        """Starts of the windows that a smaller owner has."""
        edges, link, length, least = self.next, self.link, self.length, self.least
        state, have, out = 0, 0, []
        for i, c in enumerate(symbols):
            while state and c not in edges[state]:
                state = link[state]
                have = length[state]
            if c in edges[state]:
                state, have = edges[state][c], have + 1
            while have > window and length[link[state]] >= window:
                state = link[state]
            have = min(have, window)
            if have == window and length[link[state]] >= window:
                state = link[state]
            if have == window and least[state] < owner:
                out.append(i - window + 1)
        return out


def stream_shard(rule: Rule, regions: list[bytes], ids: np.ndarray) -> list[list[int]]:
    """The regions are the shard's reference and its documents at once."""
    numbers: dict[bytes, int] = {}
    passages = [[numbers.setdefault(w, len(numbers)) for w in r.split()] for r in regions]
    automaton = SuffixAutomaton()
    owners = ids.tolist()
    for passage, owner in zip(passages, owners):
        automaton.add(passage, owner)
    automaton.settle()
    return [automaton.repeated(p, o, rule.length) for p, o in zip(passages, owners)]


def remove_repeated_words(docs: DataFrame, threshold: int = THRESHOLD, anchor: int = ANCHOR) -> DataFrame:
    """doc_id, n_units, spans and kept words: every word goes that lies in a window which starts in a smaller doc_id as well."""
    return remove_repeats(docs, Rule("word", threshold, anchor, PASSAGES, SHARD_WORDS), stream_shard)
