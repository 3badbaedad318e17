"""Document fingerprints: a Merkle tree over the sections and paragraphs of a text.

Paragraphs are lines. A paragraph is hashed over its pieces (sentences, or stretches of
bounded length where there is no sentence end), a section over its paragraphs, the root
over the sections. A section ends after a paragraph whose hash begins with a certain digit,
so an insertion moves no border but its own. Equal texts have equal roots; for different
texts, the comparison goes down the branches that differ and finds where they do.

Everything is written with functions of Spark on arrays; no text leaves its row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Digits of a hash that are kept below the root: 128 bits.
DIGITS = 32
# A paragraph whose hash begins so ends a section: one in 16.
SECTION_END = "0"
# A piece: up to so many characters and the sentence end behind them, or sentence ends alone.
PIECE = "[^.!?]{1,80}[.!?]*|[.!?]+"
# Equal hashes in a row.
RUN = rf"([0-9a-f]{{{DIGITS}}})(?: \1)*+"
SECTION_RUN = r"(#[^#]*+)(?:\1(?=#|$))*+"


def _digest(text: Column) -> Column:
    return F.substring(F.sha2(text, 256), 1, DIGITS)


def _pieces(text: Column) -> Column:
    """Per paragraph the hashes of its pieces, which cover every character of it."""
    return F.transform(
        F.split(F.coalesce(text, F.lit("")), "\n", -1),
        lambda line: F.transform(F.regexp_extract_all(line, F.lit(PIECE), F.lit(0)), _digest),
    )


def _sections(paragraphs: Column) -> Column:
    """The paragraph hashes of every section in a row.

    Each one is followed by a blank, and by a bar where the section ends, so that nothing
    has to be gathered step by step.
    """
    marked = F.transform(
        paragraphs, lambda h: F.concat(h, F.when(h.startswith(SECTION_END), F.lit(" |")).otherwise(F.lit(" ")))
    )
    return F.split(F.array_join(marked, ""), r"\|", -1)


def add_tree(df: DataFrame, text: str | Column = "text", tree: str = "tree") -> DataFrame:
    """Add the tree of every whole text: ``root, sections, held, paragraphs, n_pieces``.

    The root is hexadecimal text. ``sections`` are the hashes of the sections, ``held`` the hashes of the pieces in each,
    put in a row, ``paragraphs`` the hash of every line. A null text
    counts as empty, and an empty text has one empty paragraph. A column of the name of the
    new one is replaced; repeated rows get a tree each.
    """
    column = F.col(f"`{text}`") if isinstance(text, str) else text
    pieces, lines, parts = "_tree_pieces", "_tree_lines", "_tree_parts"
    rows = df.withColumn(pieces, F.transform(_pieces(column), lambda row: F.array_join(row, " ")))
    rows = rows.withColumn(lines, F.transform(pieces, _digest))
    rows = rows.withColumn(parts, F.transform(_sections(F.col(lines)), _digest))
    # The pieces of every line, with a bar where its section ends.
    marked = F.zip_with(
        lines, pieces, lambda h, row: F.concat(row, F.when(h.startswith(SECTION_END), F.lit(" |")).otherwise(F.lit(" ")))
    )
    held = F.transform(F.split(F.array_join(marked, ""), r"\|", -1), lambda row: F.trim(row))
    count = F.aggregate(F.transform(pieces, _n_hashes), F.lit(0).cast("long"), lambda n, k: n + k)
    root = F.sha2(F.array_join(parts, " "), 256)
    found = F.struct(
        root.alias("root"),
        F.col(parts).alias("sections"),
        held.alias("held"),
        F.col(lines).alias("paragraphs"),
        count.alias("n_pieces"),
    )
    return rows.withColumn(tree, found).drop(pieces, lines, parts)


def _n_hashes(row: Column) -> Column:
    """How many hashes are in a row, with a blank between them."""
    return F.floor((F.length(row) + 1) / (DIGITS + 1)).cast("long")


def _numbered(hashes: Column) -> Column:
    """The hashes with a number each, so that equal ones differ: the first is 0, the next 1, and so on."""
    runs = F.regexp_extract_all(F.array_join(F.array_sort(hashes), " "), F.lit(RUN), F.lit(0))
    tags = F.transform(
        runs,
        lambda run: F.transform(
            F.sequence(F.lit(0).cast("long"), _n_hashes(run) - 1),
            lambda k: F.concat(F.substring(run, 1, DIGITS), F.lit(":"), k.cast("string")),
        ),
    )
    return F.flatten(tags)


def _numbered_sections(held: Column) -> Column:
    """The sections, each as ``#`` and its pieces, with a number so that equal ones differ."""
    joined = F.array_join(F.array_sort(F.transform(held, lambda row: F.concat(F.lit("#"), row))), "")
    runs = F.regexp_extract_all(joined, F.lit(SECTION_RUN), F.lit(0))
    tags = F.transform(
        runs,
        lambda run: F.transform(
            F.split(F.substring(run, 2, 1 << 30), "#", -1), lambda row, k: F.concat(F.lit("#"), row, F.lit(":"), k.cast("string"))
        ),
    )
    return F.flatten(tags)


def _pieces_of(sections: Column) -> Column:
    """The pieces of some numbered sections."""
    return F.regexp_extract_all(F.array_join(sections, " "), F.lit(f"[0-9a-f]{{{DIGITS}}}"), F.lit(0))


def add_likeness(df: DataFrame, a: str, b: str, name: str) -> DataFrame:
    """Add how alike two trees are, 0 to 1, and 1 only for equal roots.

    It is the share of what the trees have in common of their pieces, each as often as it occurs, and their
    roots. The comparison goes down from the roots: sections that both have, as often as both have them, are equal as
    they are, and only the pieces of the other sections are compared.
    """
    own, other, below_own, below_other = (f"_like_{k}" for k in range(4))
    differ = F.col(f"{a}.root") != F.col(f"{b}.root")
    rows = df.withColumns(
        {
            own: F.when(differ, _numbered_sections(F.col(f"{a}.held"))),
            other: F.when(differ, _numbered_sections(F.col(f"{b}.held"))),
        }
    )
    # No function on arrays refers to a column from within: the column would be computed for every element.
    rows = rows.withColumns(
        {below_own: _pieces_of(F.array_except(own, other)), below_other: _pieces_of(F.array_except(other, own))}
    )
    met = F.size(F.array_intersect(_numbered(F.col(below_own)), _numbered(F.col(below_other))))
    common = F.col(f"{a}.n_pieces") - F.size(below_own) + met
    share = 2.0 * common / (F.col(f"{a}.n_pieces") + F.col(f"{b}.n_pieces") + 2)
    return rows.withColumn(name, F.when(differ, share).otherwise(F.lit(1.0))).drop(own, other, below_own, below_other)


def _equal_beginning(a: Column, b: Column) -> Column:
    """How many entries two arrays have in common from their beginnings on."""
    first = F.array_position(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), False)
    return F.when(first > 0, first - 1).otherwise(F.size(a)).cast("int")


def changed_paragraphs(a: Column, b: Column) -> Column:
    """Where the first text differs from the second: ``begin, end, other_end``, paragraphs counted from 0.

    Paragraphs ``begin`` to ``end`` of the first stand where the second has those from ``begin`` to ``other_end``; all before and
    behind are equal. Moved, repeated and removed paragraphs lie in that branch; the two ends are ``begin`` where one
    side has nothing there, and all three are 0 for equal roots.
    """
    x, y = a["paragraphs"], b["paragraphs"]
    begin = _equal_beginning(x, y)
    behind = F.least(_equal_beginning(F.reverse(x), F.reverse(y)), F.least(F.size(x), F.size(y)) - begin)
    differ = a["root"] != b["root"]
    place = lambda at: F.when(differ, at).otherwise(F.lit(0))
    return F.struct(
        place(begin).alias("begin"), place(F.size(x) - behind).alias("end"), place(F.size(y) - behind).alias("other_end")
    )
