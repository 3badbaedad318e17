"""FM-index over a row of word numbers, searched in both directions by whole levels.

The text is a circle of numbers in which 0 is a barrier that no phrase crosses. Its suffixes
are sorted by as many words as the longest phrase needs; the symbols before them are the
Burrows-Wheeler transform, and the step from a row to that of its longer suffix is the
LF mapping. A second one over the reversed text extends phrases to the right. A phrase is
an interval of either, and extending it in one keeps the other in step.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Side:
    """The transform of one direction, and the row that each of its rows steps to."""

    last: np.ndarray
    step: np.ndarray


@dataclass
class Phrases:
    """Phrases of one length: their words, where their intervals begin, and how often they occur."""

    words: np.ndarray
    forward: np.ndarray
    backward: np.ndarray
    counts: np.ndarray

    def __getitem__(self, kept: np.ndarray) -> Phrases:
        return Phrases(self.words[kept], self.forward[kept], self.backward[kept], self.counts[kept])


def last_column(text: np.ndarray, depth: int) -> np.ndarray:
    """Symbols before the suffixes of a circular text, these sorted by at least ``depth`` symbols."""
    rank, width = text.astype(np.int64), 1
    while width < depth:
        key = rank * (int(rank.max(initial=0)) + 1) + np.roll(rank, -width)
        width *= 2
        if width < depth:
            rank = np.unique(key, return_inverse=True)[1]
        else:
            rank = key
    order = np.argsort(rank, kind="stable")
    return text[order - 1]


def side(last: np.ndarray) -> Side:
    step = np.empty(len(last), np.int64)
    step[np.argsort(last, kind="stable")] = np.arange(len(last))
    return Side(last, step)


class WordIndex:
    """Both directions of a text, from their transforms."""

    def __init__(self, forward: np.ndarray, backward: np.ndarray) -> None:
        self.left, self.right = side(forward), side(backward)
        self.symbols = int(forward.max(initial=0)) + 1

    def single_words(self) -> Phrases:
        counts = np.bincount(self.left.last, minlength=self.symbols)
        begins = np.cumsum(counts) - counts
        words = np.flatnonzero(counts[1:]) + 1
        return Phrases(words[:, None], begins[words], begins[words], counts[words])

    def extend_right(self, phrases: Phrases) -> Phrases:
        """Every phrase followed by each word that follows it somewhere."""
        owner, word, own, other, counts = self._extend(self.right, phrases.backward, phrases.forward, phrases.counts)
        return Phrases(np.column_stack([phrases.words[owner], word]), other, own, counts)

    def extend_left(self, phrases: Phrases) -> Phrases:
        """Every phrase after each word that it follows somewhere."""
        owner, word, own, other, counts = self._extend(self.left, phrases.forward, phrases.backward, phrases.counts)
        return Phrases(np.column_stack([word, phrases.words[owner]]), own, other, counts)

    def _extend(self, side: Side, own: np.ndarray, other: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, ...]:
        """All intervals by all symbols found in them: the old one, the symbol, both beginnings, the size."""
        ends = np.cumsum(sizes)
        starts = ends - sizes
        total = int(ends[-1]) if len(ends) else 0
        owner = np.repeat(np.arange(len(sizes)), sizes)
        rows = np.arange(total) + np.repeat(own - starts, sizes)
        key = owner * self.symbols + side.last[rows].astype(np.int64)
        order = np.argsort(key, kind="stable")
        key = key[order]
        first = np.flatnonzero(np.diff(key, prepend=-1))
        counts = np.diff(first, append=total)
        old, symbol = np.divmod(key[first], self.symbols)
        # Rows of one symbol step to rows in a row; rows of lesser symbols come before in the other direction.
        begins, others = side.step[rows[order[first]]], other[old] + first - starts[old]
        real = symbol > 0
        return old[real], symbol[real], begins[real], others[real], counts[real]
