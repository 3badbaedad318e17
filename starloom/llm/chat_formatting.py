"""Chat formatting with rotating perspective.

A dialogue is rendered once for each of its participants: that speaker's turns become the
assistant's, everybody else is a user with a name, and the mask covers what the speaker
says. Turns of a system role stay instructions and are nobody's perspective.

A rendering comes in pages of a fixed number of turns, so that a conversation of any
length is spread over rows of bounded size; its pages put in a row are the whole
rendering. Mask spans count characters from the beginning of their page.

Different speakers have different names, and no text can forge a marker of the format: characters that
a name cannot have are written by their bytes, and markers within a text get one more bar.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.session import cut_lineage, join_cell_table

PAGE_TURNS = 64
# Stands for the page of turns without a number in joins.
NO_PAGE = -(1 << 62)
# The markers of the chat format.
START, END = "<|im_start|>", "<|im_end|>"
ASSISTANT = START + "assistant\n"
# Characters of a name that are kept. An underscore is doubled, and others stand as hexadecimal bytes between two.
IN_NAMES = "[A-Za-z0-9-]"
# The beginning of a marker within a text.
MARKER = r"<(\|+)im_"
NO_NAME = "unknown"
# Rows of a page, times its turns, above which it is cut.
MOST_ROWS = 4


def speaker_name(role: Column) -> Column:
    """The name of a speaker, another one for every role."""
    written = F.transform(
        F.filter(F.split(role, ""), lambda c: c != ""),
        lambda c: F.when(c.rlike(f"^{IN_NAMES}$"), c)
        .when(c == "_", F.lit("__"))
        .otherwise(F.concat(F.lit("_"), F.lower(F.hex(F.encode(c, "utf-8"))), F.lit("_"))),
    )
    return F.array_join(written, "")


def safe_text(text: Column) -> Column:
    """A text in which no marker can be read; one bar less in each ``<||im_`` gives it back."""
    return F.regexp_replace(text, MARKER, r"<$1|im_")


def _cut_pages(told: DataFrame, page_turns: int) -> DataFrame:
    """Add ``part``: 0, or the part of a page whose turn numbers are held by very many rows.

    Rows of such pages are ranked by ranges, so no task orders a whole page.
    """
    sizes = told.groupBy("key", "page").agg(F.count("*").alias("rows")).filter(F.col("rows") > MOST_ROWS * page_turns)
    hot = cut_lineage(sizes.select(F.col("key").alias("hot_key"), F.coalesce("page", F.lit(NO_PAGE)).alias("hot_page")))
    if hot.isEmpty():
        return told.withColumn("part", F.lit(0).cast("long"))
    on = (F.col("key") == F.col("hot_key")) & (F.coalesce("page", F.lit(NO_PAGE)) == F.col("hot_page"))
    rest = join_cell_table(told, hot, on, "left_anti").withColumn("part", F.lit(0).cast("long"))
    n = int(told.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["key", "page", "said"]
    placed = join_cell_table(told, hot, on, "left_semi").repartitionByRange(n, *order).sortWithinPartitions(*order)
    placed = cut_lineage(placed.withColumn("place", F.monotonically_increasing_id()))
    # Rows of a page in each range, and in the ranges before.
    held = placed.groupBy("key", "page", F.shiftright("place", 33).alias("range")).agg(
        F.count("*").alias("rows"), F.min("place").alias("first")
    )
    before = Window.partitionBy("key", "page").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    held = held.select(
        F.col("key").alias("own_key"), F.coalesce("page", F.lit(NO_PAGE)).alias("own_page"), "range",
        (F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.col("first")).alias("shift"),
    )
    on = (F.col("key") == F.col("own_key")) & (F.coalesce("page", F.lit(NO_PAGE)) == F.col("own_page"))
    ranked = placed.join(held, on & (F.shiftright("place", 33) == F.col("range")))
    part = F.floor((F.col("place") + F.col("shift")) / page_turns).cast("long")
    return rest.unionByName(ranked.select("key", "page", "said", part.alias("part")))


def _segment(role: Column, text: Column, own: Column, system: Column) -> Column:
    """One turn as the perspective sees it."""
    head = (
        F.when(system, F.lit(START + "system\n"))
        .when(own, F.lit(ASSISTANT))
        .otherwise(F.concat(F.lit(START + "user name="), speaker_name(role), F.lit("\n")))
    )
    return F.concat(head, text, F.lit(END + "\n"))


def rotate_perspectives(
    turns: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    system_roles: tuple[str, ...] = ("system",),
    page_turns: int = PAGE_TURNS,
) -> DataFrame:
    """``conversation, speaker, page, part, n_turns, rendered, mask``, a row per perspective and page.

    ``mask`` is an array of ``begin, end``: in each of the speaker's turns the text and the
    marker that ends it. Turns follow their number, then role and text; a null number
    comes first, on a page without a number. A null role is a speaker called
    ``unknown``, a null text is empty, and a turn without a conversation is one by itself.
    Repeated rows are rendered each; a page whose numbers are held by more than four times its turns of
    rows, such as one for turns without a number, comes in parts of so many rows, else ``part`` is 0. A conversation of system turns alone has no row, nor has an empty table;
    columns other than the four named are left out.
    """
    rows = turns.select(
        F.col(f"`{conversation}`").alias("key"),
        F.floor(F.col(turn) / page_turns).cast("long").alias("page"),
        F.struct(
            F.col(turn).alias("turn"),
            F.coalesce(role, F.lit(NO_NAME)).alias("role"),
            safe_text(F.coalesce(text, F.lit(""))).alias("text"),
        ).alias("said"),
    )
    told = rows.filter(F.col("key").isNotNull())
    speakers = told.select("key", F.col("said.role").alias("speaker")).distinct()
    speakers = speakers.filter(~F.col("speaker").isin(*system_roles)) if system_roles else speakers
    paged = _cut_pages(told, page_turns).groupBy("key", "page", "part")
    pages = paged.agg(F.sort_array(F.collect_list("said")).alias("said"))
    first = F.lit(0).cast("long").alias("part")
    alone = rows.filter(F.col("key").isNull()).select("key", "page", first, F.array("said").alias("said"))
    alone = alone.withColumn("speaker", F.get("said", F.lit(0))["role"])
    alone = alone.filter(~F.col("speaker").isin(*system_roles)) if system_roles else alone
    seen = pages.join(speakers, "key").select("key", "page", "part", "said", "speaker").unionByName(alone).withColumn(
        "segments",
        F.transform(
            "said",
            lambda s: _segment(
                s["role"], s["text"], s["role"] == F.col("speaker"), s["role"].isin(*system_roles or [""])
            ),
        ),
    )
    seen = seen.withColumn("sizes", F.transform("segments", F.char_length))
    spans = F.transform(
        "said",
        lambda s, i: F.when(
            s["role"] == F.col("speaker"),
            F.aggregate(F.slice("sizes", F.lit(1), i), F.lit(0), lambda a, n: a + n) + len(ASSISTANT),
        ),
    )
    spans = F.transform(
        spans,
        lambda begin, i: F.when(
            begin.isNotNull(),
            F.struct(
                begin.alias("begin"), (begin + F.char_length(F.get("said", i)["text"]) + len(END)).alias("end")
            ),
        ),
    )
    seen = seen.withColumn("mask", F.filter(spans, lambda span: span.isNotNull()))
    seen = seen.withColumn("n_turns", F.size("said")).withColumn("rendered", F.array_join("segments", ""))
    return seen.select(F.col("key").alias(conversation), "speaker", "page", "part", "n_turns", "rendered", "mask")
