"""Rows with nulls, empty and long texts, ties and repeats, and columns with awkward names."""

from __future__ import annotations

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")

TEXTS = [
    None,
    "",
    " ",
    "  \n ",
    "one",
    "a b c d",
    "the quick brown fox jumps over the lazy dog and runs away",
    "the quick brown fox jumps over the lazy dog and runs away",
    "line one here\nline one here\n\nline two\r\nline two\r\n",
    "again and again and again and again and again and again and again",
    "é ß 日本語 𝒳  x y ▁ \x00 <|endoftext|> <s>",
    "  leading, trailing and  double  spaces  ",
    "word " * 3000,
    "x" * 20000,
]


def case_rows() -> list[tuple]:
    """``doc_id, text, source, n_words, row``: the last two have names that operators use."""
    rows = [(k, text, f"s{k % 3}", -1, "r") for k, text in enumerate(TEXTS)]
    rows += [(None, TEXTS[6], None, None, None), (None, None, None, 0, ""), (3, TEXTS[3], "s0", 7, "again")]
    return rows + [rows[6]] * 3


SCHEMA = "doc_id bigint, text string, source string, n_words bigint, row string"
EMPTY = "doc_id bigint, text string, source string"


def grams(text: str | None, size: int = 5) -> frozenset:
    words = WORD.findall(text or "")
    if not words:
        return frozenset()
    return frozenset(tuple(words[k : k + size]) for k in range(max(1, len(words) - size + 1)))
