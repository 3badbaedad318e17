"""Words, lines and word windows of whole texts, as arrays over a block of texts.

A word is a run of bytes other than U+0020 and U+0009 to U+000D. Words, lines and windows are
compared by 64-bit hashes that mix in eight bytes, or one word, after the other. Features of models
come from running sums instead, which give the hash of any stretch at once, but are equal for some
regular texts that differ.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from starloom.llm.batches import text_bytes

# Words in a window, for repeats and for similarity.
WINDOW_WORDS = 5
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
# Stretches of more bytes are hashed by themselves.
LONG_BYTES = 2048


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that any of their bits can be used."""
    values = values.astype(np.uint64, copy=True)
    values ^= values >> np.uint64(30)
    values *= np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    values ^= values >> np.uint64(31)
    return values


# A value for every byte, for the running sums.
BYTE_VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def hash_stretches(content: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of the bytes of every stretch, mixed eight bytes at a time; long ones are hashed one by one."""
    padded = np.concatenate([content, np.zeros(8, np.uint8)])
    eights = np.ndarray((len(content) + 1,), "<u8", padded, strides=(1,))
    out = mixed((ends - begins).astype(np.uint64) * np.uint64(BASE))
    long = ends - begins > LONG_BYTES
    for row in np.flatnonzero(long):
        digest = hashlib.blake2b(content[begins[row] : ends[row]].tobytes(), digest_size=8).digest()
        out[row] = int.from_bytes(digest, "little")
    rows, at, left = np.flatnonzero(~long), begins[~long], (ends - begins)[~long]
    while len(rows):
        more = left > 0
        rows, at, left = rows[more], at[more], left[more]
        kept = np.minimum(left, 8).astype(np.uint64) * np.uint64(8)
        part = eights[at] & (np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(64) - kept))
        out[rows] = mixed(out[rows] * np.uint64(BASE) ^ part)
        at, left = at + 8, left - 8
    return out


def hash_rows(hashes: np.ndarray, firsts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A hash of so many values in a row from each first one on, mixed one after the other."""
    out = mixed(sizes.astype(np.uint64) * np.uint64(INVERSE))
    for k in range(int(sizes.max(initial=0))):
        rows = np.flatnonzero(sizes > k)
        out[rows] = mixed(out[rows] * np.uint64(BASE) ^ hashes[firsts[rows] + k])
    return out


class Stretches:
    """Hashes of any stretch of a row of symbols, given as 64-bit values. For features only."""

    def __init__(self, values: np.ndarray) -> None:
        n = len(values)
        self.back = powers(INVERSE, n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values * powers(BASE, n), out=self.sums[1:])

    def raw(self, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Equal for equal stretches, but not spread over all bits."""
        return (self.sums[ends] - self.sums[begins]) * self.back[begins]

    def hashes(self, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Equal for equal stretches; their length counts too."""
        return mixed(self.raw(begins, ends) + (ends - begins).astype(np.uint64) * np.uint64(INVERSE))


@dataclass
class Words:
    """Words of a block: bytes ``begins`` to ``ends``, ``starts`` says which word is the first of a text."""

    content: np.ndarray
    bounds: np.ndarray
    begins: np.ndarray
    ends: np.ndarray
    starts: np.ndarray

    @property
    def per_text(self) -> np.ndarray:
        return np.diff(self.starts)

    @property
    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.starts) - 1), self.per_text)


def find_words(texts: pa.Array) -> Words:
    content, bounds = text_bytes(texts)
    inside = np.ones(len(content) + 1, bool)
    inside[:-1] = (content != 32) & ((content < 9) | (content > 13))
    inside[-1] = False
    before = np.zeros(len(content) + 1, bool)
    before[1:] = inside[:-1]
    border = np.zeros(len(content) + 1, bool)  # a text begins here
    border[bounds] = True
    begins = np.flatnonzero(inside & (~before | border))
    ends = np.flatnonzero(before & (~inside | border))
    return Words(content, bounds, begins, ends, np.searchsorted(begins, bounds))


def word_hashes(words: Words) -> np.ndarray:
    return hash_stretches(words.content, words.begins, words.ends)


def windows(hashes: np.ndarray, words: Words, size: int = WINDOW_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first word of every window of ``size`` words inside a text."""
    left = words.starts[1:][words.owner] - np.arange(len(hashes))
    firsts = np.flatnonzero(left >= size)
    return hash_rows(hashes, firsts, np.full(len(firsts), size)), firsts
