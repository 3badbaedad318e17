import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from starloom.llm import phrase_mining as M
from starloom.llm.fm_index import WordIndex, last_column

PIECES, WORDS = re.compile(r"[.,;:!?\x0a-\x0d]"), re.compile(r"[^\x20\x09]+")
UPPER = {k: k + 32 for k in range(65, 91)}


def mined(rows, least, top=None):
    """The definition, phrase by phrase."""
    counts, totals = {}, Counter()
    for text, lang in rows:
        found = counts.setdefault(lang or "und", Counter())
        for piece in PIECES.split((text or "").translate(UPPER)):
            words = WORDS.findall(piece)
            totals[lang or "und"] += len(words)
            found.update(tuple(words[k : k + d]) for d in range(1, 5) for k in range(len(words) - d + 1))
    out = []
    for lang, found in counts.items():
        candidates = {p: a for p, a in found.items() if len(p) > 1 and a >= least}
        inside = {}
        for phrase, a in candidates.items():
            for size in range(2, len(phrase)):
                for k in range(len(phrase) - size + 1):
                    part = phrase[k : k + size]
                    inside[part] = max(inside.get(part, 0), a)
        scored = []
        for phrase, a in candidates.items():
            if 100 * inside.get(phrase, 0) >= 80 * a:
                continue
            cuts = [(found[phrase[:k]], found[phrase[k:]], k) for k in range(1, len(phrase))]
            score, _, l, r = min((2000000 * a // (l + r), k, l, r) for l, r, k in cuts)
            scored.append((-score, -a, " ".join(phrase).encode(), l, r))
        scored.sort()
        for rank, (score, a, phrase, l, r) in enumerate(scored[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, totals[lang], -score))
    return sorted(out)


def texts(seed, n=300, words=30):
    rng = random.Random(seed)
    weights = [1 / (k + 1) for k in range(words)]
    for _ in range(n):
        parts = rng.choices([f"W{k}" if k % 3 else f"é{k}" for k in range(words)], weights, k=rng.randint(0, 60))
        seams = rng.choices([" ", "  ", "\t", ". ", ",", "\n", " : ", "!?"], [20, 2, 1, 2, 2, 1, 1, 1], k=len(parts))
        yield "".join(p + s for p, s in zip(parts, seams)), rng.choice(["en", "en", "fr", None])


@pytest.mark.parametrize(("seed", "least", "shard"), [(1, 30, 1 << 24), (2, 5, 4000), (3, 3, 200)])
def test_equals_the_definition(spark, seed, least, shard, monkeypatch):
    monkeypatch.setattr(M, "SHARD_BYTES", shard)
    rows = [*texts(seed), (None, "en"), ("", None), ("... !!", "de"), ("lone", "de")] + [("one two three four five", "it")] * 40
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(5)
    found = sorted(map(tuple, M.mine_phrases(docs, least=least).collect()))
    want = mined(rows, least, 2000)
    assert found == want and len(found) > 20


def test_few_bits_lose_nothing(spark, monkeypatch):
    """A full bit table lets rare phrases through to the count; the result is the same."""
    monkeypatch.setattr(M, "MOST_BITS", 64)
    rows = list(texts(7, 120))
    docs = spark.createDataFrame(rows, "text string, lang string")
    assert sorted(map(tuple, M.mine_phrases(docs, least=4, top=50).collect())) == mined(rows, 4, 50)


def test_long_texts_columns_and_empty_tables(spark, monkeypatch):
    monkeypatch.setattr(M, "SHARD_BYTES", 500)
    rng = random.Random(5)
    long = " ".join(rng.choices(["a", "b", "c", "d"], k=4000))
    pieces = ". ".join(" ".join(rng.choices(["x", "y"], k=7)) for _ in range(600))
    rows = [(long, "en", 1, 2), (pieces, "en", 3, 4), (long, "en", 1, 2)]
    docs = spark.createDataFrame(rows, "text string, lang string, phrase int, f int")
    assert sorted(map(tuple, M.mine_phrases(docs).collect())) == mined([r[:2] for r in rows], 30, 2000)
    assert M.mine_phrases(docs.limit(0)).collect() == []
    assert M.mine_phrases(docs.filter("phrase = 3").withColumn("text", M.F.lit(None).cast("string"))).collect() == []


def test_large_counts_are_exact(spark):
    score = "(cast(a as decimal(20,0)) * 2000000) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))"
    rows = [(2**62, 2**62 + 1, 2**62 + 7), (2**61 + 3, 2**62, 2**63 - 1)]
    got = spark.createDataFrame(rows, "a long, l long, r long").selectExpr(f"{score} AS s").collect()
    assert [r.s for r in got] == [2000000 * a // (l + r) for a, l, r in rows]


def test_index_extends_both_ways():
    rng = np.random.default_rng(3)
    text = np.concatenate([[0], rng.integers(0, 6, 2000), [0]])
    index = WordIndex(last_column(text, 3), last_column(text[::-1], 3))
    want = {d: Counter() for d in (1, 2, 3, 4)}
    for d in want:
        want[d].update(tuple(int(x) for x in text[k : k + d]) for k in range(len(text) - d + 1) if text[k : k + d].all())
    found = index.single_words()
    for turn, d in ((None, 1), ("right", 2), ("left", 3), ("right", 4)):
        if turn:
            found = index.extend_right(found) if turn == "right" else index.extend_left(found)
        assert {tuple(map(int, w)): int(n) for w, n in zip(found.words, found.counts)} == want[d]
    assert math.isclose(sum(found.counts), sum(want[4].values()))
