"""Recompression of word sequences: rounds that name runs and pairs of symbols.

A round first names each maximal run of one symbol, then splits the symbols by a hash into left and right
ones and names each left symbol that stands before a right one together with it.  Names are hashes of
what they stand for, so a name means the same in every document and task.

Whether a symbol stands somewhere depends on a bounded context only.  ``Parse`` keeps for each symbol the
words ``low:high`` that decide it: wherever these words occur, the symbol occurs at the same place
(its interior is consistent).  ``low`` or ``high`` outside the document means that its edge decides.
"""

from __future__ import annotations

import numpy as np

from wattline.llm.tokens import mix, pair_hash

_RUN = np.uint64(0x52554E)


class Parse:
    """Symbols of several documents after ``rounds`` rounds; document i has words ``first[i]:first[i + 1]``.

    ``levels`` holds (name, low, high, doc) of the symbols after each round.
    """

    def __init__(self, words: np.ndarray, first: np.ndarray, rounds: int):
        n = len(words)
        self.words = words
        self.name = words.copy()
        self.start, self.end = np.arange(n), np.arange(1, n + 1)
        self.low, self.high = self.start.copy(), self.end.copy()
        self.doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
        self.levels = []
        for r in range(rounds):
            self._runs()
            self._pairs(r)
            self.levels.append((self.name, self.low, self.high, self.doc))

    def _next(self) -> np.ndarray:
        """Whether the next symbol is in the same document."""
        out = np.zeros(len(self.name), dtype=bool)
        out[:-1] = self.doc[1:] == self.doc[:-1]
        return out

    def _merge(self, heads: np.ndarray, name: np.ndarray) -> None:
        """Keep the symbols at ``heads``; each takes in the symbols up to the next head."""
        last = np.append(heads[1:], len(self.name)) - 1
        self.name, self.start, self.end = name, self.start[heads], self.end[last]
        self.low = np.minimum.reduceat(self.low, heads)
        self.high = np.maximum.reduceat(self.high, heads)
        self.doc = self.doc[heads]

    def _runs(self) -> None:
        if not len(self.name):
            return
        goes_on = self._next()
        equal = goes_on.copy()
        equal[:-1] &= self.name[1:] == self.name[:-1]
        heads = np.flatnonzero(~np.append(False, equal[:-1]))
        length = np.diff(np.append(heads, len(self.name)))
        name = self.name[heads]
        many = length > 1
        name[many] = pair_hash(mix(name[many] ^ _RUN), length[many].astype(np.uint64))
        # the symbol at either edge of a run, to tell it from its neighbours
        one_end, one_start = self.end[heads] - 1, self.start[heads + length - 1]
        self._merge(heads, name)
        self._context(one_end, one_start)

    def _context(self, last_word: np.ndarray, first_word: np.ndarray) -> None:
        """A run ends where the neighbour differs: one other word shows that, else the neighbour's context."""
        goes_on = self._next()
        low, high = self.low.copy(), self.high.copy()
        edge = np.flatnonzero(~np.append(False, goes_on[:-1]))
        low[edge] = np.minimum(low[edge], self.start[edge] - 1)
        right = np.flatnonzero(~goes_on)
        high[right] = np.maximum(high[right], self.end[right] + 1)
        at = np.flatnonzero(goes_on)                   # symbols with a right neighbour
        differs = self.words[self.end[at]] != self.words[first_word[at]]
        high[at] = np.maximum(high[at], np.where(differs, self.end[at] + 1, self.high[at + 1]))
        at = at + 1                                    # symbols with a left neighbour
        differs = self.words[self.start[at] - 1] != self.words[last_word[at]]
        low[at] = np.minimum(low[at], np.where(differs, self.start[at] - 1, self.low[at - 1]))
        self.low, self.high = low, high

    def _pairs(self, r: int) -> None:
        if not len(self.name):
            return
        right = (mix(self.name + np.uint64(r + 1)) & np.uint64(1)).astype(bool)
        goes_on = self._next()
        pair = goes_on & ~right
        pair[:-1] &= right[1:]
        second = np.append(False, pair[:-1])
        low, high = self.low.copy(), self.high.copy()
        # a left symbol that stays alone depends on its right neighbour, a right one on its left neighbour
        at = np.flatnonzero(~right & ~pair)
        inside = at[goes_on[at]]
        high[inside] = np.maximum(high[inside], self.high[inside + 1])
        outside = at[~goes_on[at]]
        high[outside] = np.maximum(high[outside], self.end[outside] + 1)
        at = np.flatnonzero(right & ~second)
        before = np.append(False, goes_on[:-1])
        inside = at[before[at]]
        low[inside] = np.minimum(low[inside], self.low[inside - 1])
        outside = at[~before[at]]
        low[outside] = np.minimum(low[outside], self.start[outside] - 1)
        self.low, self.high = low, high
        heads = np.flatnonzero(~second)
        name = self.name[heads]
        paired = pair[heads]
        name[paired] = pair_hash(name[paired], self.name[heads[paired] + 1])
        self._merge(heads, name)
