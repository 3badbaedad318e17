"""Measures and verdicts of the quality rules."""

import random
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from starloom.llm import quality_rules as rules

from cases import EMPTY, SCHEMA, TEXTS, WORD, case_rows


def by_hand(text):
    words = WORD.findall(text or "")
    seen, dups = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dups += line in seen
            seen.add(line)
    found = Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))
    covered = {j for k in range(len(words) - 4) if found[tuple(words[k : k + 5])] > 1 for j in range(k, k + 5)}
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(words), sum(map(len, words)), symbols, dups, len(covered)


def failed(text):
    n, _, _, _, repeated = by_hand(text)
    return n < 10 or 100 * repeated > 20 * n


def test_measures():
    rng = random.Random(8)
    texts = [t or "" for t in TEXTS] + ["\n", "a\n", "a\n\na\n", "\na\n a\n a"]
    texts += ["".join(rng.choice("ab \n\té#\x0b") for _ in range(rng.randint(0, 60))) for _ in range(500)]
    texts += [" ".join(rng.choice("ab") for _ in range(rng.randint(0, 60))) for _ in range(200)]
    found = rules.measure(pa.array(texts))
    got = list(zip(*(found[n].tolist() for n in
                     ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")), strict=True))
    assert got == [by_hand(text) for text in texts]


def verdicts_by_hand(rows):
    """Whether a host is kept, from ``host, failed``."""
    n, f = Counter(), Counter()
    for host, bad in rows:
        n[host] += 1
        f[host] += bad
    docs, m = sum(n.values()), sum(f.values()) / sum(n.values())
    s = rules.STRONGEST
    if 0 < m < 1:
        excess = sum(n[h] * (f[h] / n[h] - m) ** 2 for h in n) / (m * (1 - m)) - (len(n) - 1)
        room = docs - sum(k * k for k in n.values()) / docs - (len(n) - 1)
        c = excess / room if room > 0 else 0
        s = min(max(1 / c - 1, rules.WEAKEST), rules.STRONGEST) if c > 0 else s
    return {h: (f[h] + s * m) / (n[h] + s) <= rules.MOST_FAILING for h in n}


@pytest.mark.parametrize("broadcast", [True, False])
def test_hosts_are_judged(spark, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(rules, "BROADCAST_BYTES", 0)
    good, bad = "all of these ten words are said once in here now", "too short"
    rows = [(k, bad if k % 10 else good, "poor") for k in range(200)]
    rows += [(k, good if k % 10 else bad, "rich") for k in range(1000, 1600)] + [(5000, bad, "new"), (5001, good, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    want = verdicts_by_hand([(r[2], failed(r[1])) for r in rows])
    assert not want["poor"] and want["rich"] and want[None]
    got = rules.apply_quality_rules(df).collect()
    assert len(got) == len(rows)
    for row in got:
        assert row.kept == (not failed(row.text) and want[row.source])


def test_awkward_rows(spark):
    rows = case_rows()
    got = rules.apply_quality_rules(spark.createDataFrame(rows, SCHEMA)).collect()
    want = verdicts_by_hand([(r[2], failed(r[1])) for r in rows])
    counts = defaultdict(int)
    for row in got:
        assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words) == by_hand(row.text)
        assert row.kept == (not failed(row.text) and want[row.source])
        counts[row.doc_id, row["row"]] += 1
    assert counts == Counter((r[0], r[4]) for r in rows)
    assert rules.apply_quality_rules(spark.createDataFrame([], EMPTY)).count() == 0


def judged(spark, hosts):
    rows = [(f"h{k}", n, f) for k, (n, f) in enumerate(hosts)]
    table = spark.createDataFrame(rows, "source string, n int, f int")
    each = table.selectExpr("source", "explode(sequence(1, n)) AS at", "f").selectExpr("source", "at <= f AS base_failed")
    return {int(r.host[1:]): r for r in rules.host_verdicts(each).collect()}


def test_hosts_that_do_not_differ_are_all_kept(spark):
    """20,000 hosts of three documents, each document failing with 0.3: chance alone rejects none."""
    rng = random.Random(2)
    found = judged(spark, [(3, sum(rng.random() < 0.3 for _ in range(3))) for _ in range(20_000)])
    assert all(r.host_kept for r in found.values())
    assert max(abs(r.shrunk_rate - 0.3) for r in found.values()) < 0.05


def test_a_bad_host_among_small_ones_is_rejected(spark):
    rng = random.Random(3)
    hosts = [(n, sum(rng.random() < 0.08 for _ in range(n))) for n in rng.choices([1, 2, 3, 200], k=3000)]
    hosts += [(60, 51), (500, 460), (3, 3)]
    found = judged(spark, hosts)
    assert [k for k, r in found.items() if not r.host_kept] in ([3000, 3001], [3001, 3000])


def test_the_prior_is_that_of_the_hosts(spark):
    """Hosts drawn from a beta distribution: its strength is found again, whatever their sizes."""
    rng = random.Random(5)
    for a, b in ((2, 8), (10, 30)):
        counts = []
        for _ in range(30_000):
            n, rate = rng.choice([1, 2, 5, 40]), rng.betavariate(a, b)
            counts.append((n, sum(rng.random() < rate for _ in range(n))))
        sums = [sum(x) for x in zip(*((n, f, 1, f * f / n, n * n) for n, f in counts))]
        m, strength = rules.prior(*sums)
        assert abs(m - a / (a + b)) < 0.01 and abs(strength / (a + b) - 1) < 0.15


def thue_morse(order):
    text = "a"
    for _ in range(order):
        text += text.translate(str.maketrans("ab", "ba"))
    return text


@pytest.mark.parametrize("order", [10, 11, 12])
def test_regular_lines_that_differ_are_no_repeats(order):
    one = thue_morse(order)
    other = one.translate(str.maketrans("ab", "ba"))
    texts = [f"{one}\n{other}", f"{one}\n{one}", " ".join([*one[:1024], *other[:1024]])]
    found = rules.measure(pa.array(texts))
    assert found["n_dup_lines"].tolist() == [0, 1, 0]
    assert found["n_repeat_words"].tolist() == [by_hand(t)[4] for t in texts]
    assert rules.word_hashes(rules.find_words(pa.array([one, other]))).tolist()[0] != rules.word_hashes(rules.find_words(pa.array([other]))).tolist()[0]
