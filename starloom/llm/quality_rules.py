"""Quality rules: rules on each text, and verdicts on hosts from the failures of their documents.

The share of failing documents of a host says little while it has few documents. It is
therefore shrunk towards the share in the corpus with a beta prior whose strength is
fitted to the spread of the shares between hosts, and a host is rejected if its shrunk
share is above a limit. Failures are counted per host before they are shuffled, and the
verdicts are joined back to the documents, by broadcast if the table of hosts is small.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.batches import add_text_columns
from starloom.llm.words import WINDOW_WORDS, find_words, hash_stretches, mixed, windows, word_hashes
from starloom.session import BROADCAST_BYTES, ROW_BYTES, cut_lineage

LEAST_WORDS = 10
MOST_REPEATED_PERCENT = 20
# A host is rejected if more than this share of its documents is expected to fail.
MOST_FAILING = 0.5
# Bounds of the strength of the prior, in documents.
WEAKEST, STRONGEST = 1.0, 1000.0
# The characters that count as symbols.
SYMBOLS = "#*$%&|<>"

MEASURES = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint"


def repeats(hashes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether an entry has an equal one in the same text, and whether an equal one comes before it."""
    keys = mixed(hashes ^ mixed(owner.astype(np.uint64) + np.uint64(1)))
    order = np.argsort(keys, kind="stable")
    same = np.zeros(len(keys) + 1, bool)
    same[1:-1] = keys[order][1:] == keys[order][:-1]
    again, later = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    again[order], later[order] = same[1:] | same[:-1], same[:-1]
    return again, later


def per_text(flags: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sum of an array over the texts."""
    sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return sums[starts[1:]] - sums[starts[:-1]]


def measure(texts: pa.Array) -> dict[str, np.ndarray]:
    """The measures of every text of a block."""
    words = find_words(texts)
    content, bounds = words.content, words.bounds

    in_words = np.zeros(len(content) + 1, np.int8)
    in_words[words.begins] += 1
    in_words[words.ends] -= 1
    in_words = np.cumsum(in_words[:-1], dtype=np.int8).astype(bool)
    symbols = np.zeros(256, bool)
    symbols[list(SYMBOLS.encode())] = True

    breaks = np.flatnonzero(content == 10)
    line_begins = np.sort(np.concatenate([bounds[:-1], breaks + 1]))
    line_owner = np.searchsorted(bounds[1:], line_begins, "right")
    # A text may end in a line break: its last, empty line begins where the next text does.
    filled = np.searchsorted(words.begins, line_begins)
    line_ends = np.concatenate([line_begins[1:], bounds[-1:]])
    worded = (filled < len(words.begins)) & (np.append(words.begins, len(content))[filled] < line_ends)
    line_begins, line_owner, line_ends = line_begins[worded], line_owner[worded], line_ends[worded]
    line_ends = line_ends - (content[line_ends - 1] == 10)
    _, dup = repeats(hash_stretches(content, line_begins, line_ends), line_owner)

    hashes, firsts = windows(word_hashes(words), words)
    owner = words.owner
    again, _ = repeats(hashes, owner[firsts])
    covered = np.zeros(len(words.begins) + WINDOW_WORDS + 1, np.int64)
    covered[firsts[again]] += 1
    covered[firsts[again] + WINDOW_WORDS] -= 1
    covered = np.cumsum(covered)[: len(words.begins)] > 0
    return {
        "n_words": words.per_text,
        "word_chars": per_text(in_words & ((content & 0xC0) != 0x80), bounds),
        "n_symbols": per_text(symbols[content], bounds),
        "n_dup_lines": np.bincount(line_owner, dup, len(texts)).astype(np.int64),
        "n_repeat_words": per_text(covered, words.starts),
    }


def measure_rules(df: DataFrame, text: str = "text") -> DataFrame:
    """Add the measures of every whole text and ``base_failed``.

    A null or empty text has no words and fails. Columns named as the new ones are
    replaced, an empty table stays empty, and repeated rows count each.
    """
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")
    )
    return add_text_columns(df, text, MEASURES, lambda: measure).withColumn("base_failed", failed)


def prior(n: float, f: float, hosts: int, ff: float, nn: float) -> tuple[float, float]:
    """Share of failures and strength of the prior, from the sums of n, f, f * f / n and n * n over the hosts."""
    m = f / n if n else 0.0
    room = n - nn / n - (hosts - 1) if n else 0.0
    if not 0 < m < 1 or room <= 0:
        return m, STRONGEST
    correlation = ((ff - m * f) / (m * (1 - m)) - (hosts - 1)) / room
    return m, min(max(1 / correlation - 1, WEAKEST), STRONGEST) if correlation > 0 else STRONGEST


def host_verdicts(rules: DataFrame, host: str = "source", failed: str = "base_failed") -> DataFrame:
    """``host, n_docs, n_failed, shrunk_rate, host_kept``, one row per host; documents without one share a row.

    With m the share of failures in the corpus, n documents and f failures of a host, N and H the numbers of
    all documents and hosts, the spread sum(n (f/n - m)^2) / (m (1 - m)) would be H - 1 by chance alone.
    What is above that, divided by N - sum(n^2) / N - (H - 1), is the correlation c of the documents
    of a host; the prior has the strength s = 1 / c - 1 within bounds, the strongest one
    where the hosts differ by no more than chance. The shrunk rate is (f + s m) / (n + s).
    """
    counts = cut_lineage(
        rules.groupBy(F.col(host).alias("host")).agg(
            F.count("*").alias("n_docs"), F.sum(F.col(failed).cast("long")).alias("n_failed")
        )
    )
    n, f = F.col("n_docs").cast("double"), F.col("n_failed").cast("double")
    found = counts.agg(
        F.sum(n).alias("n"), F.sum(f).alias("f"), F.count("*").alias("hosts"),
        F.sum(f * f / n).alias("ff"), F.sum(n * n).alias("nn"),
    ).first()
    m, strength = prior(found.n or 0.0, found.f or 0.0, found.hosts, found.ff or 0.0, found.nn or 0.0)
    shrunk = (F.col("n_failed") + F.lit(strength * m)) / (F.col("n_docs") + F.lit(strength))
    return counts.withColumn("shrunk_rate", shrunk).withColumn("host_kept", F.col("shrunk_rate") <= MOST_FAILING)


def join_verdicts(rules: DataFrame, verdicts: DataFrame, host: str = "source") -> DataFrame:
    """Add ``shrunk_rate`` of the host and ``kept``: the text passed, and so did its host.

    The table of hosts is broadcast if it is small; beyond, the join shuffles and
    adaptive execution splits a host that holds much of the corpus.
    """
    names = verdicts.select(F.col("host").alias("_rule_host"), F.col("shrunk_rate").alias("_rule_rate"), "host_kept")
    size = verdicts.agg(F.sum(F.coalesce(F.octet_length("host"), F.lit(0)) + ROW_BYTES + 64)).first()[0] or 0
    kept = [name for name in rules.columns if name not in ("shrunk_rate", "kept")]
    rows = rules.select(F.struct(*kept).alias("_rule_row"), F.col(f"`{host}`").alias("_rule_own"))
    side = F.broadcast(names) if size <= BROADCAST_BYTES else names
    joined = rows.join(side, F.col("_rule_own").eqNullSafe(F.col("_rule_host")), "left")
    return joined.select(
        *[F.col(f"_rule_row.`{name}`").alias(name) for name in kept],
        F.col("_rule_rate").alias("shrunk_rate"),
        (~F.col("_rule_row.base_failed") & F.col("host_kept")).alias("kept"),
    )


def apply_quality_rules(df: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """Every document with its measures, the rate of its host and ``kept``.

    The texts are measured twice, once for the counts of the hosts and once for the rows,
    so that no text is shuffled or stored in between. Who does not need the texts in the
    result calls the three parts and stores the measures.
    """
    narrow = df.select(F.col(text).alias("text"), F.col(host).cast("string").alias("host"))
    verdicts = host_verdicts(measure_rules(narrow, "text"), "host")
    return join_verdicts(measure_rules(df, text), verdicts, host)
