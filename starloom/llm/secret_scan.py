"""Secret scans: fixed rules, and a character network over every other candidate.

A candidate is a run of 16 or more letters, digits and ``+/_=-``. The network reads it with the
text around it. It learns from labelled findings: candidates that a rule has found are
secrets, the others are not; random strings and ordinary names laid into the same texts say
more about the two sides than the rules do. All distinct findings take part, in shards: in a round every shard
trains the network on its own, and the means of what they reach go into the next round. A part of the findings
is held out to turn its answers into probabilities and to choose, for each family of characters, the highest
threshold that still finds the wanted share of the secrets held out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom import session
from starloom.llm.batches import add_text_columns, texts_of
from starloom.llm.char_cnn import (
    BODY,
    EPOCHS,
    LEFT,
    LENGTH,
    RIGHT,
    Net,
    as_numbers,
    from_numbers,
    logits,
    net_of,
    new_state,
    train,
    train_round,
)

# The rules, and how long a finding must be.
ASSIGN = re.compile(
    rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE
)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]{24,}")
LEAST_ASSIGN, LEAST_ACCESS = 6, 20
KINDS = ("assign", "access", "hex", "learned")
LEARNED = 3

CANDIDATE = re.compile(rb"[A-Za-z0-9+/_=-]{16,}")
# About so many distinct findings make a shard; there are as many shards as all of them take.
SHARD_ROWS = 4000
# The states of shards are added up as whole multiples of this, so their order does not matter.
WHOLE = 2.0**36
# Answers count in steps of this size, within so many units, so how many there are of each says all about them.
STEPS, FURTHEST = 256, 32
# Of the findings every fourth is held out; so many of a family are needed for a threshold.
HELD_OUT, LEAST_HELD = 4, 20
# Share of the held-out secrets of a family that its threshold must find.
RECALL = 0.98
SPANS = "spans array<struct<kind: string, begin: int, end: int>>"

# What random secrets and ordinary names are made of.
LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
ALPHABETS = ("0123456789abcdef", "0123456789ABCDEF", LOWER + UPPER + DIGITS, LOWER + DIGITS, UPPER + DIGITS, LOWER + UPPER + DIGITS + "+/_-")


def _codes() -> np.ndarray:
    codes = np.full(256, 128, np.uint8)
    codes[1:128] = np.arange(1, 128)
    return codes


CODE_OF = _codes()


@dataclass(frozen=True)
class Scanner:
    """``thresholds[family]``: the least logit of a secret. Without a network nothing is learned."""

    net: Net | None
    slope: float
    offset: float
    thresholds: tuple[float, ...]

    def probability(self, answers: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * answers + self.offset, -60, 60)))


def answered(net: Net, codes: np.ndarray) -> np.ndarray:
    """The network's answers in whole steps."""
    return np.clip(np.floor(logits(net, codes) * STEPS), -FURTHEST * STEPS, FURTHEST * STEPS).astype(np.int64)


def base_spans(text: bytes) -> list[tuple[int, int, int]]:
    """What the rules find: ``begin, kind, end`` in bytes, leftmost and without overlap for each kind."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_ASSIGN]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def candidates(text: bytes, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, bool]]:
    """Every candidate, and whether it shares characters with what a rule has found."""
    found = [(m.start(), m.end()) for m in CANDIDATE.finditer(text)]
    if not found or not spans:
        return [(*c, False) for c in found]
    begins = np.array([s[0] for s in spans])
    # Spans of different kinds overlap, so the end that counts is the furthest so far.
    ends = np.maximum.accumulate([s[2] for s in spans])
    before = np.searchsorted(begins, [end for _, end in found], "left")
    return [(b, e, bool(k and ends[k - 1] > b)) for (b, e), k in zip(found, before, strict=True)]


def windows(text: bytes, begin: int, end: int) -> list[bytes]:
    """The candidate in stretches of 64 characters, each with what surrounds the candidate, as codes."""
    left = text[max(0, begin - LEFT) : begin].rjust(LEFT, b"\0")
    right = text[end : end + RIGHT].ljust(RIGHT, b"\0")
    return [left + text[at : min(at + BODY, end)].ljust(BODY, b"\0") + right for at in range(begin, end, BODY)]


def as_codes(rows: list[bytes]) -> np.ndarray:
    """Codes of windows; a character 0 within the text counts as none."""
    raw = np.frombuffer(b"".join(rows), np.uint8).reshape(-1, LENGTH)
    return np.where(raw > 0, CODE_OF[raw], 0).astype(np.int64)


def families(codes: np.ndarray) -> np.ndarray:
    """Which kinds of characters a stretch has: digits 1, lower case 2, upper case 4, others 8, added up."""
    body = codes[:, LEFT : LEFT + BODY]
    has = lambda low, high: ((body >= low) & (body <= high)).any(axis=1)
    digit, lower, upper = has(48, 57), has(97, 122), has(65, 90)
    other = has(43, 47) | has(61, 61) | has(95, 95)
    return digit * 1 + lower * 2 + upper * 4 + other * 8


def _planted(rng: np.random.Generator, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Random strings, and names, numbers and rules made of ordinary words, in the place of candidates."""
    words = sorted({w for row in codes[:, LEFT : LEFT + BODY] for w in re.findall("[a-z]{4,12}", bytes(row[row > 0]).decode("ascii", "replace").lower())})
    words = words or ["name", "value", "index"]

    def random_string() -> str:
        alphabet = ALPHABETS[rng.integers(len(ALPHABETS))]
        return "".join(alphabet[k] for k in rng.integers(0, len(alphabet), rng.integers(16, 65)))

    def ordinary() -> str:
        kind, parts = rng.integers(5), [words[k] for k in rng.integers(0, len(words), 6)]
        if kind == 0:
            return "".join(DIGITS[k] for k in rng.integers(0, 10, rng.integers(16, 24)))
        if kind == 1:
            return "-".join(str(k) for k in rng.integers(0, 10_000, rng.integers(4, 7)))
        if kind == 2:
            return DIGITS[rng.integers(10)].join("=-_/+"[rng.integers(5)] * rng.integers(16, 40) for _ in range(2))
        text = "_-/"[rng.integers(3)].join(parts) if kind == 3 else "".join(p.capitalize() for p in parts)
        return text + str(rng.integers(0, 2100)) * int(rng.integers(2))

    out, labels = [], []
    for row in codes:
        for label, text in ((1, random_string()), (0, ordinary())):
            new = row.copy()
            body = np.frombuffer(text.encode()[:BODY], np.uint8)
            new[LEFT : LEFT + BODY] = np.pad(CODE_OF[body], (0, BODY - len(body)))
            out.append(new)
            labels.append(label)
    return np.array(out, np.int64).reshape(-1, LENGTH), np.array(labels, np.int64)


def _calibrated(answers: np.ndarray, labels: np.ndarray, counts: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve through the held-out answers, each so many times, by Newton steps."""
    at = np.array([1.0, 0.0])
    secrets, others = counts[labels > 0].sum(), counts[labels == 0].sum()
    sides = np.where(labels > 0, (secrets + 1) / (secrets + 2), 1 / (others + 2))
    columns = np.column_stack([answers, np.ones(len(answers))])
    for _ in range(50):
        chance = 1 / (1 + np.exp(-np.clip(columns @ at, -30, 30)))
        weight = np.maximum(chance * (1 - chance), 1e-9) * counts
        pull = columns.T @ ((chance - sides) * counts)
        step = np.linalg.solve((columns * weight[:, None]).T @ columns + 1e-6 * np.eye(2), pull)
        at = at - np.clip(step, -1, 1)
    return float(at[0]), float(at[1])


def _laid_out(codes: np.ndarray, labels: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All findings and what is made of them, their labels, and which are held out."""
    secrets, others = np.flatnonzero(labels > 0), np.flatnonzero(labels == 0)
    parts, marks = [codes], [labels]
    if len(secrets) and len(others):  # secrets where nothing around them gives them away
        moved = codes[rng.choice(others, len(secrets))].copy()
        moved[:, LEFT : LEFT + BODY] = codes[secrets, LEFT : LEFT + BODY]
        parts.append(moved)
        marks.append(np.ones(len(secrets), np.int64))
    laid, sides = _planted(rng, codes)
    codes, labels = np.concatenate([*parts, laid]), np.concatenate([*marks, sides])
    return codes, labels, rng.permutation(len(codes)) % HELD_OUT == 0


def _settled(net: Net, held: np.ndarray, recall: float) -> Scanner:
    """Calibrate and choose the thresholds by the held-out rows: ``family, label, answer, n``, sorted."""
    family, labels, steps, counts = held.T
    answers = steps / STEPS
    scanner = Scanner(net, *_calibrated(answers, labels, counts), ())
    thresholds = []
    for k in range(16):
        secret = (family == k) & (labels > 0)
        chances, order = scanner.probability(answers[secret]), np.argsort(scanner.probability(answers[secret]), kind="stable")
        ends = np.cumsum(counts[secret][order])
        # A family in which hardly any secret is known has no threshold that could be trusted.
        known = len(ends) and ends[-1] >= LEAST_HELD
        thresholds.append(float(chances[order][np.searchsorted(ends, int((1 - recall) * ends[-1]), "right")]) if known else np.inf)
    return Scanner(net, scanner.slope, scanner.offset, tuple(thresholds))


def _no_scanner() -> Scanner:
    return Scanner(None, 1.0, 0.0, (np.inf,) * 16)


def fit(codes: np.ndarray, labels: np.ndarray, recall: float = RECALL, seed: int = 0) -> Scanner:
    """Train on three quarters of findings that fit one machine, calibrate and choose the thresholds on the others."""
    if not len(codes):
        return _no_scanner()
    codes, labels, held = _laid_out(codes, labels, np.random.default_rng(seed))
    net = train(codes[~held], labels[~held], seed)
    rows = np.column_stack([families(codes[held]), labels[held], answered(net, codes[held])])
    found, counts = np.unique(rows, axis=0, return_counts=True)
    return _settled(net, np.column_stack([found, counts]), recall)


def findings(docs: DataFrame, text: str = "text") -> DataFrame:
    """Every candidate's first stretch as codes with its label: ``codes, label``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, labels = [], []
            for value in texts_of(batch.column(0)):
                content = value.as_buffer().to_pybytes()
                for begin, end, known in candidates(content, base_spans(content)):
                    rows.append(windows(content, begin, end)[0])
                    labels.append(int(known))
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary()), pa.array(labels, pa.int32())], ["codes", "label"])

    return docs.select(F.col(f"`{text}`").cast("string")).mapInArrow(run, "codes binary, label int")


def training_rows(docs: DataFrame, text: str = "text", seed: int = 0) -> DataFrame:
    """All distinct findings and what is made of them, a shard in each partition: ``codes, label, held``.

    Shards are dealt by hash and sorted, so they are the same however the documents are stored.
    """
    distinct = session.cut_lineage(findings(docs, text).dropDuplicates())
    shards = max(1, -(-distinct.count() // SHARD_ROWS))
    number = F.pmod(F.xxhash64("codes", "label"), F.lit(shards)).cast("int")
    dealt = distinct.withColumn("shard", number).repartitionById(shards, F.col("shard")).sortWithinPartitions("codes", "label")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [batch for batch in batches if batch.num_rows]
        if not parts:
            return
        table = pa.Table.from_batches(parts)
        rng = np.random.default_rng([seed, table.column("shard")[0].as_py()])
        labels = table.column("label").to_numpy().astype(np.int64)
        codes, labels, held = _laid_out(as_codes(table.column("codes").to_pylist()), labels, rng)
        rows = pa.array([row.tobytes() for row in codes.astype(np.uint8)], pa.binary())
        yield pa.RecordBatch.from_arrays([rows, pa.array(labels, pa.int32()), pa.array(held)], ["codes", "label", "held"])

    return session.cut_lineage(dealt.mapInArrow(run, "codes binary, label int, held boolean"))


def _rows_in(batches: Iterator[pa.RecordBatch], held: bool) -> tuple[np.ndarray, np.ndarray]:
    """Codes and labels of the rows of a shard that are held out, or of the others."""
    raw, labels = [], []
    for batch in batches:
        keep = np.asarray(batch.column(2)) == held
        labels.append(np.asarray(batch.column(1))[keep].astype(np.int64))
        raw += batch.column(0).filter(pa.array(keep)).to_pylist()
    codes = np.frombuffer(b"".join(raw), np.uint8).reshape(-1, LENGTH).astype(np.int64)
    return codes, np.concatenate([*labels, np.zeros(0, np.int64)])


def _round(rows: DataFrame, state: Net, number: int, seed: int) -> Net:
    """The mean of what all shards reach from a state, by their rows. The driver gets one row per value."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, labels = _rows_in(batches, False)
        if len(codes):
            reached = as_numbers(train_round(state, codes, labels, number, seed))
            whole = np.append(np.clip(np.rint(reached * len(codes) * WHOLE), -(2.0**62), 2.0**62).astype(np.int64), len(codes))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(whole))), pa.array(whole)], ["place", "value"])

    added = rows.mapInArrow(run, "place long, value long").groupBy("place").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
    sums = [row.value for row in sorted(added.collect())]
    return from_numbers(state, np.array([float(v) for v in sums[:-1]]) / (float(sums[-1]) * WHOLE)) if sums else state


def train_scanner(docs: DataFrame, text: str = "text", recall: float = RECALL, seed: int = 0) -> Scanner:
    """Fit on all distinct findings: trained in shards whose means meet after every round, calibrated by all held-out rows."""
    rows = training_rows(docs, text, seed)
    if rows.isEmpty():
        return _no_scanner()
    state = new_state(seed)
    for number in range(EPOCHS):
        state = _round(rows, state, number, seed)
    net = net_of(state)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, labels = _rows_in(batches, True)
        columns = [families(codes), labels, answered(net, codes)] if len(codes) else [np.zeros(0, np.int64)] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], ["family", "label", "answer"])

    held = rows.mapInArrow(run, "family long, label long, answer long").groupBy("family", "label", "answer").count()
    return _settled(net, np.array(sorted(map(tuple, held.collect())), np.int64).reshape(-1, 4), recall)


def _learned(scanner: Scanner, contents: list[bytes], found: list[list[tuple[int, int]]]) -> list[list[tuple[int, int, int]]]:
    """The candidates of each text that the network takes for secrets; a long one by its likeliest stretch."""
    rows, owner = [], []
    flat = [(k, begin, end) for k, spans in enumerate(found) for begin, end in spans]
    for at, (k, begin, end) in enumerate(flat):
        cut = windows(contents[k], begin, end)
        rows += cut
        owner += [at] * len(cut)
    out: list[list[tuple[int, int, int]]] = [[] for _ in contents]
    if not rows or scanner.net is None:
        return out
    codes = as_codes(rows)
    chances = scanner.probability(answered(scanner.net, codes) / STEPS)
    secret = np.zeros(len(flat), bool)
    np.logical_or.at(secret, owner, chances >= np.array(scanner.thresholds)[families(codes)])
    for at in np.flatnonzero(secret):
        k, begin, end = flat[at]
        out[k].append((begin, LEARNED, end))
    return out


def scan_secrets(df: DataFrame, scanner: Scanner, text: str = "text") -> DataFrame:
    """Add ``spans``: kind, begin and end, in characters, of all findings in each whole text.

    Kinds are ``assign``, ``access``, ``hex`` and ``learned``, sorted by begin, then in this order. What the rules find
    always stays; the network adds candidates that share no character with it. A null text
    counts as empty and has none; other columns stay, one named ``spans`` is replaced.
    """
    about = (scanner.net, scanner.slope, scanner.offset, scanner.thresholds)
    sent = df.sparkSession.sparkContext.broadcast(about)

    def make():
        fitted = Scanner(*sent.value)

        def work(texts: pa.Array) -> dict[str, pa.Array]:
            contents = [t.as_buffer().to_pybytes() for t in texts]
            base = [base_spans(c) for c in contents]
            free = [[(b, e) for b, e, known in candidates(c, s) if not known] for c, s in zip(contents, base, strict=True)]
            more = _learned(fitted, contents, free)
            out = []
            for content, spans, learned in zip(contents, base, more, strict=True):
                spans = sorted(spans + learned)
                places = sorted({p for begin, _, end in spans for p in (begin, end)})
                chars, at, seen = {}, 0, 0
                for place in places:
                    seen += len(content[at:place].decode("utf-8"))
                    chars[place], at = seen, place
                out.append([{"kind": KINDS[kind], "begin": chars[b], "end": chars[e]} for b, kind, e in spans])
            kind = pa.struct([("kind", pa.string()), ("begin", pa.int32()), ("end", pa.int32())])
            return {"spans": pa.array(out, pa.list_(kind))}

        return work

    return add_text_columns(df, text, SPANS, make)
