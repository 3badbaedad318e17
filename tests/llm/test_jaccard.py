"""The similarity join against all pairs."""

import random
from collections import Counter

import numpy as np
import pytest

from starloom.llm import jaccard_join as join
from starloom.llm import stages
from starloom.llm.components import connected_components

from cases import EMPTY, SCHEMA, case_rows, grams


def all_pairs(rows, threshold=(4, 5)):
    """Least key of the class and number of links, per row; keys may be null or repeated."""
    sets = [grams(text) for _, text in rows]
    above, below = threshold
    root = list(range(len(rows)))
    links = [0] * len(rows)

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] == sets[b] or below * both >= above * (len(sets[a]) + len(sets[b]) - both):
                links[a] += 1
                links[b] += 1
                root[max(find(a), find(b))] = min(find(a), find(b))
    classes = {}
    for k, (key, _) in enumerate(rows):
        classes.setdefault(find(k), []).append(key)
    least = {k: min((key for key in keys if key is not None), default=None) for k, keys in classes.items()}
    return [(least[find(k)], links[k]) for k in range(len(rows))]


def texts_with_copies(rng, n):
    """Random texts, copies with a few words changed, and passages that many of them share."""
    words = [f"w{k}" for k in range(300)]
    passage = [rng.choice(words) for _ in range(60)]
    texts = []
    for _ in range(n):
        turn = rng.random()
        if texts and turn < 0.5:
            own = rng.choice(texts).split()
            for _ in range(rng.choice((0, 0, 1, 1, 2, 3, 5))):
                own[rng.randrange(len(own))] = rng.choice(words)
            texts.append(" ".join(own))
        else:
            own = [rng.choice(words) for _ in range(rng.randint(1, 150))]
            texts.append(" ".join(own + passage if turn > 0.8 else own))
    return texts


@pytest.mark.parametrize("rows_of_block", [join.BLOCK_ROWS, 3])
def test_links_and_classes(spark, monkeypatch, rows_of_block):
    monkeypatch.setattr(join, "BLOCK_ROWS", rows_of_block)
    monkeypatch.setattr(join, "PAIRS_AT_ONCE", 50)
    monkeypatch.setattr(join, "CELLS_AT_ONCE", 500)
    rows = list(enumerate(texts_with_copies(random.Random(6), 250)))
    got = join.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    want = {key: found for (key, _), found in zip(rows, all_pairs(rows), strict=True)}
    assert {r.doc_id: (r.class_id, r.n_links) for r in got} == want
    sets = {key: grams(text) for key, text in rows}
    first = {}
    for key in sorted(sets):
        first.setdefault(sets[key], key)
    assert all(r.copy_id == first[sets[r.doc_id]] for r in got)
    kept = Counter(r.class_id for r in got if r.kept)
    assert set(kept.values()) == {1} and all(r.doc_id == r.class_id for r in got if r.kept)


def test_a_large_group_emits_no_pairs(spark, monkeypatch):
    monkeypatch.setattr(join, "BLOCK_ROWS", 100)
    base = [f"b{k}" for k in range(200)]
    rows = []
    for k in range(350):
        own = list(base)
        own[k % 200] = f"x{k}"
        rows.append((k, " ".join(own)))
    got = join.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r.class_id for r in got} == {0} and {r.n_links for r in got} == {349}


def test_awkward_rows(spark):
    rows = case_rows()
    got = join.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    want = Counter((key, *found) for (key, *_), found in zip(rows, all_pairs([r[:2] for r in rows]), strict=True))
    assert Counter((r.doc_id, r.class_id, r.n_links) for r in got) == want
    assert join.near_duplicates(spark.createDataFrame([], EMPTY)).count() == 0
    nulls = join.near_duplicates(spark.createDataFrame([(None, "a b"), (None, "a b"), (None, None)], EMPTY[:26])).collect()
    assert sorted(r.n_links for r in nulls) == [0, 1, 1] and {r.class_id for r in nulls} == {None}


@pytest.mark.parametrize("rows_of_block", [join.BLOCK_ROWS, 1])
def test_repeated_rows_with_a_near_copy(spark, monkeypatch, rows_of_block):
    monkeypatch.setattr(join, "BLOCK_ROWS", rows_of_block)
    base = [f"b{k}" for k in range(100)]
    near, copy = " ".join([*base[:50], "x", *base[51:]]), " ".join(base)
    rows = [(1, copy)] * 2 + [(2, near)] + [(3, copy)]
    got = join.near_duplicates(spark.createDataFrame(rows * 5, "doc_id bigint, text string").repartition(6)).collect()
    want = Counter((key, *found) for (key, _), found in zip(rows * 5, all_pairs(rows * 5), strict=True))
    assert Counter((r.doc_id, r.class_id, r.n_links) for r in got) == want
    few = join.near_duplicates(spark.createDataFrame(rows[:3], "doc_id bigint, text string")).collect()
    assert sorted((r.doc_id, r.n_links) for r in few) == [(1, 2), (1, 2), (2, 2)]


def test_one_of_each_stays(spark):
    rows = case_rows()
    kept = stages.keep_one_of_each(spark.createDataFrame(rows, SCHEMA)).collect()
    found = all_pairs([r[:2] for r in rows])
    assert sorted(r.doc_id for r in kept) == sorted({least for least, _ in found})
    assert set(map(tuple, kept)) <= set(rows) and kept[0].asDict().keys() == {"doc_id", "text", "source", "n_words", "row"}


def test_pruning_keeps_similar_pairs():
    least = join.least_agreements(0.8, join.TOLERANCE)
    assert list(least) == sorted(least) and 0 < least[0] < join.STEP
    rng = np.random.default_rng(5)
    for similarity, share in ((0.85, 1.0), (0.8, 0.995), (0.3, 0.0)):
        left = rng.integers(0, 256, (4000, join.HASHES), np.uint8)
        right = np.where(rng.random(left.shape) < similarity, left, rng.integers(0, 256, left.shape, np.uint8))
        pairs = np.arange(4000)
        alive = join.surviving(np.concatenate([left, right]), pairs, pairs + 4000, least)
        assert len(alive) / 4000 >= share if share else len(alive) == 0


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(3)
    pool = np.unique(rng.integers(0, 1 << 63, 3000, np.uint64))
    a, b = pool[:2000], pool[500:2500]
    values = join.signatures([np.sort(a), np.sort(b)])
    agreed = (values[0] == values[1]).mean()
    assert abs(agreed - 1500 / 2500) < 0.15


@pytest.mark.parametrize("links", [
    [], [(1, 1)], [(k, k + 1) for k in range(60)], [(0, k) for k in range(1, 60)], [(5, 3), (3, 5), (9, 8), (8, 9), (2, 1)],
])
def test_components(spark, links):
    got = connected_components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    root = {}

    def find(k):
        while root.setdefault(k, k) != k:
            k = root[k]
        return k

    for a, b in links:
        if a != b:
            root[max(find(a), find(b))] = min(find(a), find(b))
    assert {r.node: r.component for r in got} == {k: find(k) for k in list(root)} and len(got) == len(root)


def test_regular_texts_that_differ_have_different_sets():
    """A Thue-Morse sequence and its complement, as words and as one word: no sum of powers tells them apart."""
    one = "a"
    for _ in range(11):
        one += one.translate(str.maketrans("ab", "ba"))
    other = one.translate(str.maketrans("ab", "ba"))
    long, twin = (" ".join(["x", text, "y", "z", "t"]) for text in (one, other))
    a, b, c, d = join.gram_sets(join.pa.array([long, twin, one, other]))
    assert not set(a) & set(b) and not set(c) & set(d)
