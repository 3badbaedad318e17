"""Trees against hashlib, comparisons, and neighbours in key order."""

import hashlib
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from starloom.llm import neighbours
from starloom.llm.fingerprints import PIECE, add_likeness, add_tree, changed_paragraphs
from starloom.llm.neighbours import with_next_text

from cases import EMPTY, SCHEMA, TEXTS, case_rows


def short(text):
    return hashlib.sha256(text.encode()).hexdigest()[:32]


def tree(text):
    pieces = [[short(p) for p in re.findall(PIECE, line)] for line in (text or "").split("\n")]
    lines = [short(" ".join(row)) for row in pieces]
    parts = "".join(h + (" |" if h.startswith("0") else " ") for h in lines).split("|")
    root = hashlib.sha256(" ".join(map(short, parts)).encode()).hexdigest()
    held, found = [[]], [p for row in pieces for p in row]
    for h, row in zip(lines, pieces):
        held[-1] += row
        held += [[]] if h.startswith("0") else []
    return root, [short(p) for p in parts], held, lines, len(found)


def plain(tree):
    return tree.root, tree.sections, [row.split() for row in tree.held], tree.paragraphs, tree.n_pieces


def test_trees(spark):
    rows = spark.createDataFrame(case_rows(), SCHEMA)
    for row in add_tree(rows, "text", "n_words").collect():
        assert plain(row.n_words) == tree(row.text)
    many = "\n".join(f"line {k}. It is long enough! Is it?" for k in range(300))
    got = add_tree(spark.createDataFrame([(many,), (many,)], "text string")).collect()
    assert plain(got[0].tree) == tree(many) and len(got[0].tree.sections) > 5 and got[0] == got[1]
    assert add_tree(spark.createDataFrame([], EMPTY)).count() == 0


def test_pieces_cover_a_text():
    for text in TEXTS:
        for line in (text or "").split("\n"):
            assert "".join(re.findall(PIECE, line)) == line


def compared(spark, pairs):
    df = spark.createDataFrame([(k, *p) for k, p in enumerate(pairs)], "k int, a string, b string")
    df = add_likeness(add_tree(add_tree(df, "a", "x"), "b", "y"), "x", "y", "near")
    at = changed_paragraphs(F.col("x"), F.col("y"))
    return df.select("k", "near", *[at[name].alias(name) for name in ("begin", "end", "other_end")]).orderBy("k").collect()


def near(a, b):
    """Pieces in common, each as often as both have it."""
    if tree(a)[0] == tree(b)[0]:
        return 1.0
    x, y = (Counter(p for line in (t or "").split("\n") for p in re.findall(PIECE, line)) for t in (a, b))
    return 2 * (x & y).total() / (x.total() + y.total() + 2)


def test_edits_are_located(spark):
    lines = [f"This is paragraph {k}. It has two sentences." for k in range(200)]
    edited = [*lines]
    edited[17] = "Another thing. It has two sentences."
    inserted = lines[:50] + ["New one."] + lines[50:]
    moved = lines[:30] + lines[31:60] + [lines[30]] + lines[60:]
    repeated = lines[:81] + [lines[80]] + lines[81:]
    whole = "\n".join(lines)
    got = compared(spark, [(whole, whole), *[("\n".join(x), whole) for x in (edited, inserted, moved, repeated)], (whole, "else\nentirely")])
    same, edit, insert, move, again, apart = got
    place = lambda r: (r.begin, r.end, r.other_end)
    assert same.near == 1.0 and place(same) == (0, 0, 0)
    assert 0.98 < edit.near < 1 and place(edit) == (17, 18, 18)
    assert 0.98 < insert.near < 1 and place(insert) == (50, 51, 50)
    assert 0.98 < move.near < 1 and place(move) == (30, 60, 60)
    assert 0.98 < again.near < 1 and place(again) == (81, 82, 81)
    assert apart.near < 0.02 and place(apart) == (0, 200, 2)


def test_order_and_number_count(spark):
    pairs = [
        ("p one.\nq two.", "q two.\np one."), ("a.\na.\nb.", "a.\nb."), ("a. a. a.", "a."), ("", ""), (None, ""), ("", "x"), ("\n", ""),
        ("One is here. Two is here. Three is here.", "One is here. Two is here. Four."),
    ]
    got = compared(spark, pairs)
    assert [r.near for r in got] == [near(*p) for p in pairs]
    assert all((r.near < 1) == (tree(a)[0] != tree(b)[0]) for r, (a, b) in zip(got, pairs))
    assert (got[0].begin, got[0].end, got[0].other_end) == (0, 2, 2)
    assert (got[1].begin, got[1].end, got[1].other_end) == (1, 2, 1)


def test_likeness_equals_a_count_of_all_pieces(spark):
    """Whatever sections two texts share, and how often: going down the tree gives what counting everything would."""
    rng = random.Random(6)
    lines = [f"{rng.choice('abcdef')} {k % 9}. And {k % 4}!" for k in range(60)] + ["", "same."]
    texts = ["\n".join(rng.choices(lines, k=rng.randint(0, 120))) for _ in range(40)]
    pairs = [(rng.choice(texts), rng.choice(texts)) for _ in range(60)]
    pairs += [(t, "\n".join([*t.split("\n")[:40], "new", *t.split("\n")[30:]])) for t in texts]
    pairs += [("word\n" * 30_000, "word\n" * 29_999 + "other"), ("x. " * 40_000, "x. " * 30_000)]
    assert [r.near for r in compared(spark, pairs)] == [near(*p) for p in pairs]


def follow(rows):
    return [(*row, rows[(k + 1) % len(rows)][1]) for k, row in enumerate(rows)]


def test_neighbours(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "STEP", 5)
    rng = random.Random(2)
    for n in (1, 2, 40, 900):
        keys = rng.sample(range(-5000, 5000), n)
        rows = [(k, f"t{k}", "z") for k in keys]
        df = spark.createDataFrame(rows, "doc_id bigint, text string, next_text string").repartition(5)
        got = {(r.doc_id, r.text, r.next_text) for r in with_next_text(df).collect()}
        assert got == set(follow(sorted(((k, t) for k, t, _ in rows), reverse=True)))


def test_one_key_for_many_rows(spark):
    rows = [(7 if k % 3 == 0 else k if k % 50 else None, f"t{k}") for k in range(1500)]
    got = with_next_text(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted(r.text for r in got) == sorted(t for _, t in rows)
    # Following the links from any row visits every row once, in descending order of the keys.
    after = {r.text: r.next_text for r in got}
    keys = {t: (-1e9 if k is None else k) for k, t in rows}
    at = start = max(keys, key=lambda t: (keys[t], after[t] is not None))
    seen = []
    while not seen or at != start:
        seen.append(keys[at])
        at = after[at]
    assert len(seen) == len(rows)
    turns = sum(a < b for a, b in zip(seen, seen[1:] + seen[:1]))
    assert turns == 1
    assert with_next_text(spark.createDataFrame([], EMPTY)).count() == 0
    repeated = with_next_text(spark.createDataFrame([(1, "a")] * 5, "doc_id bigint, text string")).collect()
    assert [tuple(r) for r in repeated] == [(1, "a", "a")] * 5
