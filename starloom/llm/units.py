"""Texts as sequences of few distinct units, each beginning at a space."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


@dataclass
class Units:
    """``codes[starts[i]:starts[i + 1]]`` are the units of text i, as places in ``words``."""

    words: pa.Array
    codes: np.ndarray
    starts: np.ndarray


def split_at_spaces(texts: pa.Array) -> Units:
    """Cut texts at every U+0020; the spaces are left out, so two in a row leave an empty unit."""
    parts = pc.split_pattern(texts, " ")
    starts = np.asarray(parts.offsets, np.int64)
    coded = parts.flatten().dictionary_encode()
    return Units(coded.dictionary, np.asarray(coded.indices, np.int64), starts - starts[0])


def joined(values: np.ndarray, starts: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lists ``values[starts[c]:starts[c + 1]]`` for every code in a row, and where each begins."""
    sizes = (starts[1:] - starts[:-1])[codes]
    ends = np.concatenate([[0], np.cumsum(sizes)])
    places = np.arange(ends[-1]) + np.repeat(starts[codes] - ends[:-1], sizes)
    return values[places], ends
