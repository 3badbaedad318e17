"""Main text of web pages: boosted trees over the nodes of a page, decoded from the top down.

Every block element gets the probability that its subtree holds main text, from features
of its subtree, its attributes, its depth and its siblings. A page is then decoded as a whole:
a node can only be kept if its parent is, and of all choices that obey this the likeliest one
is taken, so a verdict on an element never contradicts one on what is in it. The text
directly in kept elements is the main text.

There are no labels. Where a page says itself which part is the article, by the elements
article and main, that part is taken as its main text, without parts that name themselves
otherwise. For pages that say nothing, and for layouts that the pages at hand do not
have, the text of those pages is laid out anew in many ways, with its place known.
"""

from __future__ import annotations

import html
import pickle
import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.batches import add_text_columns, texts_of
from starloom.llm.boosted_trees import BoostedTrees, fit_trees
from starloom.llm.page_nodes import ATTRIBUTE_WORDS, KIND, Nodes, add_up, inside, node_features, parse_pages

# Pages that the trees are fitted on, most bytes of one, and layouts made of each.
SAMPLE_PAGES, PAGE_BYTES, LAYOUTS = 300, 1 << 18, 3
# Paragraphs of a page that a layout uses at most.
LAYOUT_BLOCKS = 12
SLICE_BYTES = 1 << 20
# How the element around a main text may name itself in a layout, and what lies around that.
CONTENT_LABELS = (
    "", ' class="content"', ' id="main-content"', ' class="post-body"', ' class="entry"', ' class="article-text"',
    ' class="story"', ' class="page"', ' id="body"', ' class="c12"',
)
WRAPPER, PAGE = ' class="wrapper"', ' id="page"'
FORM_LABELS = ("", ' id="form1"', ' id="aspnetForm"', ' id="mainForm"', ' name="form1"', ' class="page-form"', ' id="ctl00"')
# Names of an article that usually mark something else.
ODD_LABELS = (
    ' class="review"', ' class="reviews"', ' class="story comment"', ' id="comment"', ' class="message"', ' class="ad-review"',
    ' class="widget-story"', ' class="alert"', ' class="profile author"', ' class="contact"',
)


def keep_nodes(nodes: Nodes, odds: np.ndarray) -> np.ndarray:
    """The likeliest choice of nodes in which every kept node's parent is kept.

    Nodes without text have no say. The root of a page is always kept.
    """
    silent = add_up(nodes, nodes.chars) == 0
    keep = np.where(silent, 0.0, -np.logaddexp(0, -odds))
    drop = np.where(silent, 0.0, -np.logaddexp(0, odds))
    dropped, best_below = add_up(nodes, drop), np.zeros(len(odds))
    levels = int(nodes.depth.max(initial=0))
    kept_score = np.zeros(len(odds))
    for level in range(levels, -1, -1):
        at = np.flatnonzero(nodes.depth == level)
        kept_score[at] = keep[at] + best_below[at]
        if level:
            np.add.at(best_below, nodes.parent[at], np.maximum(kept_score[at], dropped[at]))
    kept = nodes.parent < 0
    for level in range(1, levels + 1):
        at = np.flatnonzero(nodes.depth == level)
        kept[at] = kept[nodes.parent[at]] & (kept_score[at] >= dropped[at])
    return kept


def main_texts(pages: list[str], trees: BoostedTrees) -> list[str]:
    """The main text of every page: its blocks in page order, joined by blanks."""
    nodes = parse_pages(pages)
    kept = keep_nodes(nodes, trees.log_odds(node_features(nodes)))
    parts: list[list[str]] = [[] for _ in pages]
    for node, text in zip(nodes.segment_node.tolist(), nodes.segments, strict=True):
        if kept[node]:
            parts[nodes.page[node]].append(text)
    return [" ".join(part) for part in parts]


# ---------------------------------------------------------------- what the trees learn from


def own_labels(nodes: Nodes) -> tuple[np.ndarray, np.ndarray]:
    """Whether the text directly in a node is main text, and whether its page says so itself."""
    names = list(ATTRIBUTE_WORDS)
    other = sum(1 << names.index(name) for name in ("menu", "advert", "side", "notice", "comment", "form", "share"))
    article, main = nodes.kind == KIND["article"], nodes.kind == KIND["main"]
    inside_article, inside_main = inside(nodes, article), inside(nodes, main)
    outside = np.isin(nodes.kind, [KIND[name] for name in ("nav", "aside", "footer", "button")])
    # A form or dialog around an article says nothing about it, and neither do the article's own names.
    wraps = np.isin(nodes.kind, [KIND[name] for name in ("form", "dialog")])
    outside |= wraps & (inside_article | inside_main)
    outside |= ((nodes.groups & other) > 0) & ~article & ~main & ~wraps
    barred = inside(nodes, outside)
    n_pages = int(nodes.page.max(initial=-1)) + 1
    has_article = np.bincount(nodes.page, article, n_pages) > 0
    has_main = np.bincount(nodes.page, main, n_pages) > 0
    within = np.where(has_article[nodes.page], inside_article, inside_main)
    return within & ~barred, (has_article | has_main)[nodes.page]


def without_forms(markup: str) -> str:
    """Forms as blocks with the same attributes: a form cannot lie in a form."""
    return markup.replace("<form", "<div").replace("</form>", "</div>")


class Layouts:
    """Pages made of given texts: main text in blocks that bear ``data-keep``, other parts around it."""

    def __init__(self, lines: list[str], rng: random.Random) -> None:
        self.lines, self.rng = lines, rng

    def line(self) -> str:
        return html.escape(self.rng.choice(self.lines))

    def name(self) -> str:
        words = self.rng.choice(self.lines).split()[: self.rng.randint(1, 2)]
        return html.escape(" ".join(words) or "x")

    def links(self, n: int) -> str:
        return "".join(f'<li><a href="/{self.name()}">{self.name()}</a></li>' for _ in range(n))

    def attribute(self, *names: str) -> str:
        return f' {self.rng.choice(("class", "id"))}="{self.rng.choice(names)}"'

    def wrapped(self, tags: tuple[str, ...], attribute: str, inner: str) -> str:
        tag = self.rng.choice(tags)
        return f"<{tag}{attribute}>{inner}</{tag}>"

    def menu(self) -> str:
        items = f"<ul>{self.links(self.rng.randint(2, 9))}</ul>"
        if self.rng.random() < 0.5:
            return f"<nav>{items}</nav>"
        return f"<div{self.attribute('menu', 'navbar', 'main-nav', 'breadcrumbs')}>{items}</div>"

    def header(self) -> str:
        inner = f"<h2>{self.name()} {self.name()}</h2><p>{self.line()}</p>"
        if self.rng.random() < 0.5:
            return f"<header>{inner}</header>"
        return f"<div{self.attribute('header', 'site-header', 'top-banner', 'masthead')}>{inner}</div>"

    def footer(self) -> str:
        choice = self.rng.random()
        if choice < 0.3:
            return f"<footer>&copy; {self.name()} {self.line()}</footer>"
        if choice < 0.6:
            return f"<footer><ul>{self.links(4)}</ul><p>{self.line()}</p></footer>"
        return f"<div{self.attribute('footer', 'site-footer', 'bottom', 'copyright')}><p>{self.line()}</p></div>"

    def side(self) -> str:
        attribute = self.attribute("sidebar", "related-posts", "widget", "right-rail")
        inner = self.rng.choice(
            (f"<h3>{self.name()}</h3><p>{self.line()}</p>", f"<ul>{self.links(5)}</ul>",
             f"<h3>{self.name()}</h3><p>{self.line()}</p><ul>{self.links(4)}</ul>")
        )
        return f"<aside>{inner}</aside>" if self.rng.random() < 0.3 else self.wrapped(("aside", "div"), attribute, inner)

    def advert(self) -> str:
        attribute = self.attribute("ad", "advert", "ad-slot", "sponsored", "promo-box", "banner-ad")
        return self.wrapped(("div", "section", "p", "aside"), attribute, self.line())

    def notice(self) -> str:
        attribute = self.attribute("cookie-notice", "consent-banner", "alert", "popup", "gdpr-message")
        attribute = ' role="alert"' if self.rng.random() < 0.15 else attribute
        inner = f"<p>{self.line()}</p><button>{self.name()}</button>"
        return self.wrapped(("div", "section", "aside"), attribute, inner)

    def form(self) -> str:
        attribute = "" if self.rng.random() < 0.5 else self.attribute("newsletter", "search", "signup")
        inner = f'<label>{self.name()}</label><input type="text"><button>{self.name()}</button>'
        return f"<form{attribute}><p>{self.line()}</p>{inner}</form>"

    def remark(self) -> str:
        return self.rng.choice(
            (f'<div class="comment"><b>{self.name()}</b><p>{self.line()}</p></div>',
             f"<li><p>{self.name()}</p><p>{self.line()} {self.line()}</p></li>", f"<p>{self.line()}</p>")
        )

    def comments(self) -> str:
        remarks = "".join(self.remark() for _ in range(self.rng.randint(1, 6)))
        attribute = self.attribute("comments", "comment-list", "discussion", "responses")
        return self.wrapped(("div", "section", "ul"), attribute, f"<h3>{self.name()}</h3>{remarks}")

    def share(self) -> str:
        attribute = self.attribute("share", "social-links", "byline", "author-meta")
        return f'<div{attribute}>{self.name()} <a href="#">{self.name()}</a></div>'

    def block(self, text: str, first: bool) -> str:
        rng, text = self.rng, html.escape(text)
        tag = "h1" if first and rng.random() < 0.7 else "p"
        if tag == "p" and rng.random() < 0.3:
            tag = rng.choice(("h2", "blockquote", "li", "pre", "div"))
        if tag == "p" and rng.random() < 0.15:
            inline, words = rng.choice(("b", "em", "a")), text.split(" ")
            text = " ".join([f"<{inline}>{words[0]}</{inline}>", *words[1:]])
        piece = f"<{tag} data-keep>{text}</{tag}>"
        return f"<ul>{piece}</ul>" if tag == "li" else piece

    def table_around(self, inner: str) -> str:
        """A table that lays out the page: cells with links and notes beside, above or below the one with the text."""
        rng = self.rng
        row = lambda *cells: f"<tr>{''.join(f'<td>{c}</td>' for c in cells)}</tr>"
        links = lambda: rng.choice((" ", " | ", "<br>")).join(f'<a href="#">{self.name()}</a>' for _ in range(rng.randint(2, 8)))
        other = lambda: rng.choice((links, links, self.line, self.advert, self.footer))()
        middle = row(*rng.choice(((inner,), (inner,), (links(), inner), (inner, other()))))
        above = row(other()) if rng.random() < 0.5 else ""
        below = row(other()) if rng.random() < 0.5 else ""
        return f"<table>{above}{middle}{below}</table>"

    def short(self) -> str:
        return self.line() if self.rng.random() < 0.4 else self.name()

    def structure(self) -> str:
        """A list, table, section or the like within a text, all of it kept."""
        rng, several = self.rng, range(self.rng.randint(2, 5))
        choice = rng.randrange(10)
        if choice < 2:
            items = "".join(f"<li>{self.short()}</li>" for _ in several)
            return self.wrapped(("ul", "ol"), " data-keep", items)
        if choice < 4:
            wide = range(rng.randint(1, 4))
            head = f"<tr>{''.join(f'<th>{self.name()}</th>' for _ in wide)}</tr>" if rng.random() < 0.5 else ""
            rows = "".join(f"<tr>{''.join(f'<td>{self.short()}</td>' for _ in wide)}</tr>" for _ in several)
            return f"<table data-keep>{head}{rows}</table>"
        if choice == 4:
            return f"<dl data-keep>{''.join(f'<dt>{self.name()}</dt><dd>{self.short()}</dd>' for _ in several)}</dl>"
        if choice == 5:
            return f"<details data-keep><summary>{self.name()}</summary><p>{self.line()}</p></details>"
        if choice < 8:
            tag = rng.choice(("h2", "h3"))
            inner = f"<{tag}>{self.name()}</{tag}>{''.join(f'<p>{self.line()}</p>' for _ in range(rng.randint(1, 3)))}"
            return self.wrapped(("section", "section", "div"), " data-keep", inner)
        if choice == 8:
            return f"<figure data-keep><figcaption>{self.short()}</figcaption></figure>"
        return self.wrapped(("noscript", "object", "blockquote"), " data-keep", f"<p>{self.line()}</p>")

    def page(self, blocks: list[str]) -> str:
        """A page with this main text."""
        rng = self.rng
        content = []
        for k, text in enumerate(blocks):
            content.append(self.block(text, k == 0))
            while rng.random() < 0.3:
                content.append(self.structure())
            if rng.random() < 0.08:
                content.append(rng.choice((self.advert, self.side, self.form, self.share, self.notice))())
        label = rng.choice(CONTENT_LABELS) if rng.random() < 0.75 else ""  # or a page that marks nothing
        tag = rng.choice(("article", "article", "main", "div", "section", "div"))
        if tag in ("article", "main") and rng.random() < 0.3:
            label = rng.choice(ODD_LABELS)
        inner = f"<{tag}{label}>{''.join(content)}</{tag}>"
        if rng.random() < 0.15:
            inner = self.table_around(inner)
        # Before the text the frame of the page, behind it what readers and machines have added.
        before = [self.menu, self.header, self.notice, self.advert, self.side, self.share]
        after = [self.comments, self.side, self.advert, self.form, self.share, self.footer, self.menu, self.notice]
        before = [part() for part in rng.sample(before, len(before)) if rng.random() < 0.45]
        after = [part() for part in rng.sample(after, len(after)) if rng.random() < 0.4]
        if rng.random() < 0.25:  # some of it within the same element
            inner = f"<div>{inner}{''.join(after)}</div>"
            after = []
        for _ in range(rng.randint(0, 2)):
            inner = f"<div{rng.choice(('', WRAPPER, PAGE))}>{inner}</div>"
        turn = rng.random()
        if turn < 0.04:  # the text in an open dialog
            inner = f"<dialog open>{inner}</dialog>"
        elif turn < 0.15:  # a form around the text
            inner = f"<form{rng.choice(FORM_LABELS)}>{without_forms(inner)}</form>"
        whole = f"{''.join(before)}{inner}{''.join(after)}"
        if turn > 0.85:  # or around the page
            whole = f"<form{rng.choice(FORM_LABELS)}>{without_forms(whole)}</form>"
        return f"<html><body>{whole}</body></html>"


def fit_extractor(pages: list[str], seed: int = 0) -> BoostedTrees:
    """Fit on pages that mark their article, and on layouts made of their text."""
    rng = random.Random(seed)
    nodes = parse_pages(pages)
    own, known = own_labels(nodes)
    texts: dict[int, list[str]] = {}
    others: list[str] = []
    for node, text in zip(nodes.segment_node.tolist(), nodes.segments, strict=True):
        if own[node]:
            texts.setdefault(int(nodes.page[node]), []).append(text)
        if 2 <= text.count(" ") <= 60:
            others.append(text)
    parts = []
    if known.any():
        parts.append((nodes, own, known))
    made = []
    for blocks in texts.values():
        for _ in range(LAYOUTS):
            first = rng.randrange(max(1, len(blocks) - LAYOUT_BLOCKS + 1))
            chosen = blocks[first : first + rng.randint(1, LAYOUT_BLOCKS)]
            made.append(Layouts(others or blocks, rng).page(chosen))
    if made:
        laid = parse_pages(made)
        parts.append((laid, laid.marked, np.ones(len(laid.page), bool)))
    rows, labels = [], []
    for part, mark, use in parts:
        spoken = add_up(part, part.chars) > 0
        use = use & spoken & (part.parent >= 0)
        rows.append(node_features(part)[use])
        labels.append((add_up(part, part.chars * mark) > 0)[use])
    if not rows:
        rows, labels = [np.zeros((1, node_features(parse_pages([""])).shape[1]), np.float32)], [np.ones(1, bool)]
    features, marks = np.concatenate(rows), np.concatenate(labels).astype(np.float64)
    return fit_trees(features, marks, np.ones(len(marks)))


def train_extractor(
    pages: DataFrame, page: str = "html", key: str = "page_id", rows: int = SAMPLE_PAGES
) -> BoostedTrees:
    """Fit on at most ``rows`` pages of bounded size, those with the least hash of their key.

    The sample goes to one task, which returns the trees. Without a page that marks its
    article the trees know nothing and keep all text.
    """
    turn = F.xxhash64(F.col(key).cast("string"))
    chosen = (
        pages.select(F.col(page).alias("page"), turn.alias("turn"))
        .filter(F.col("page").isNotNull() & (F.octet_length("page") <= PAGE_BYTES))
        .orderBy("turn", "page")
        .limit(rows)
    )

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sample = sorted(row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        trees = fit_extractor([content for _, content in sample])
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(vars(trees))], pa.binary())], ["trees"])

    fitted = chosen.select("turn", "page").coalesce(1).mapInArrow(train, "trees binary").first()
    if fitted is None:
        return fit_extractor([])
    return BoostedTrees(**pickle.loads(bytes(fitted.trees)))


def extract_main_text(df: DataFrame, trees: BoostedTrees, page: str = "html", text: str = "text") -> DataFrame:
    """Add the main text of every whole page; a null or empty page has an empty text.

    Character references are decoded, white space inside a block becomes one blank, and blocks
    are joined by one. Markup that is broken is read as browsers roughly do. Columns named
    as the new one are replaced; repeated rows are extracted each. The trees go to the
    executors in a broadcast of fixed size.
    """
    sent = df.sparkSession.sparkContext.broadcast(vars(trees))

    def make():
        fitted = BoostedTrees(**sent.value)
        return lambda pages: {text: pa.array(main_texts(texts_of(pages).to_pylist(), fitted), pa.string())}

    return add_text_columns(df, page, f"`{text}` string", make, SLICE_BYTES)
