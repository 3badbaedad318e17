"""Web pages as trees of block elements with text, in arrays over many pages."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

import numpy as np

# What HTML defines about its elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset(
    "script style textarea title template iframe svg select head annotation annotation-xml".split()
)
# Of these, the ones that take the rest of a page if they are left open.
SWALLOWS = frozenset("script style textarea title".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var "
    "maction math menclose merror mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace "
    "msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover semantics".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hr main menu nav ol p pre section table ul".split()
)
# An element that ends when one of its kind begins, and where the search for it ends.
ENDS_BEFORE = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select",)),
}
KINDS = (
    "article main section div p h1 h2 h3 h4 ul ol li dl table td nav header footer aside form button fieldset "
    "blockquote pre figure figcaption details summary dialog address tr th dt dd noscript object".split()
)
KIND = {name: k for k, name in enumerate(KINDS)}
# Words of class, id, role and similar attributes, by what they usually mark.
ATTRIBUTE_WORDS = {
    "content": "article articlebody body content contents entry main maincontent page post prose story text",
    "menu": "breadcrumb breadcrumbs crumbs menu menubar nav navbar navigation pagination pager tabs toc topbar",
    "frame": "banner bottom colophon contentinfo copyright foot footer head header legal masthead top",
    "advert": "ad ads adbox adsense advert advertisement adverts promo promoted promotion sponsor sponsored",
    "side": "aside complementary rail recommended related secondary sidebar trending widget widgets",
    "notice": "alert alertdialog consent cookie cookies dialog gdpr message modal notice notification overlay popup "
    "privacy status toast warning",
    "comment": "comment commenter comments discussion disqus feedback replies reply respond responses review reviews",
    "form": "captcha contact form login newsletter register search searchbox signin signup subscribe subscription",
    "share": "author avatar byline facebook follow like likes meta print rating share sharing social tags twitter",
}
GROUP = {word: g for g, words in enumerate(ATTRIBUTE_WORDS.values()) for word in words.split()}

TAG = re.compile(
    r"<!--(?:.*?-->|.*\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)>",
    re.S,
)
ATTRIBUTE = re.compile(r"(class|id|role|itemprop|aria-label|data-keep|hidden)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)
ATTRIBUTE_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
PUNCTUATION = re.compile(r"[.,;:!?]")


@dataclass
class Nodes:
    """Block elements of many pages, a page's root first and parents before their children.

    ``segments`` are the texts between block borders, in page order, with their node.
    """

    page: np.ndarray
    parent: np.ndarray
    depth: np.ndarray
    kind: np.ndarray
    groups: np.ndarray
    marked: np.ndarray
    chars: np.ndarray
    words: np.ndarray
    link_chars: np.ndarray
    punctuation: np.ndarray
    segment_node: np.ndarray
    segments: list[str]


def attribute_groups(attributes: str) -> tuple[int, bool]:
    """Which groups of words the attributes hold, as bits; and whether they mark text to keep."""
    groups, keep = 0, False
    for name, value in ATTRIBUTE.findall(attributes):
        name = name.lower()
        if name == "data-keep":
            keep = True
        elif value:
            for part in ATTRIBUTE_PART.findall(value):
                if (group := GROUP.get(part.lower())) is not None:
                    groups |= 1 << group
            for part in re.findall(r"[a-z]+", value.lower()):
                if (group := GROUP.get(part)) is not None:
                    groups |= 1 << group
    return groups, keep


def parse_pages(pages: list[str]) -> Nodes:
    """All pages of a list. Broken markup never fails: what is not a tag is text."""
    page, parent, depth, kind, groups, marked = [], [], [], [], [], []
    chars, words, link_chars, punctuation = [], [], [], []
    segment_node: list[int] = []
    segments: list[str] = []

    for number, source in enumerate(pages):
        root = len(page)
        stack: list[tuple[str, int]] = [("", root)]
        links = 0
        held: list[str] = []

        def add(own_parent: int, own_kind: int, own_groups: int, own_mark: bool) -> int:
            page.append(number)  # noqa: B023
            parent.append(own_parent)
            depth.append(depth[own_parent] + 1 if own_parent >= 0 else 0)
            kind.append(own_kind)
            groups.append(own_groups)
            marked.append(own_mark)
            for column in (chars, words, link_chars, punctuation):
                column.append(0)
            return len(page) - 1

        def flush() -> None:
            text = " ".join("".join(held).split())  # noqa: B023
            held.clear()  # noqa: B023
            if text:
                node = stack[-1][1]  # noqa: B023
                chars[node] += len(text)
                words[node] += text.count(" ") + 1
                punctuation[node] += len(PUNCTUATION.findall(text))
                segment_node.append(node)
                segments.append(text)

        def close(k: int) -> None:
            nonlocal links
            links -= sum(1 for name, _ in stack[k:] if name == "a")  # noqa: B023
            del stack[k:]  # noqa: B023

        add(-1, len(KINDS), 0, False)
        at = 0
        while True:
            match = TAG.search(source, at)
            end = match.start() if match else len(source)
            if end > at:
                text = html.unescape(source[at:end])
                held.append(text)
                if links:
                    link_chars[stack[-1][1]] += len(text)
            if not match:
                break
            at = match.end()
            shut, name, attributes = match[1] or match[4], match[2] or match[5], match[3] or match[6]
            if not name:
                continue  # a comment or declaration
            name = name.lower()
            if name in RAW and not shut:
                # Its content is no text of the page. Most may be left open.
                if not (attributes or "").rstrip().endswith("/"):
                    over = re.compile(rf"</{name}(?=[\s/>])[^>]*>" + ("|(?=<body\\b)" if name == "head" else ""), re.I)
                    found = over.search(source, at)
                    at = found.end() if found else len(source) if name in SWALLOWS else at
                continue
            if name in ("html", "body", "head"):
                continue
            if name in VOID:
                if name in ("br", "hr", "img"):
                    held.append(" ")
                if name == "hr":
                    flush()
                continue
            if name in INLINE:
                if name in ("mspace", "mtd", "mtr"):
                    held.append(" ")
                if not shut:
                    stack.append((name, stack[-1][1]))
                    links += name == "a"
                else:
                    for k in range(len(stack) - 1, 0, -1):
                        if stack[k][0] == name:
                            links -= name == "a"
                            del stack[k]
                            break
                        if stack[k][0] not in INLINE:
                            break
                continue
            flush()
            if shut:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] == name:
                        close(k)
                        break
                continue
            if name in CLOSES_P:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] == "p":
                        close(k)
                        break
                    if stack[k][0] not in INLINE:
                        break
            if name in ENDS_BEFORE:
                own, borders = ENDS_BEFORE[name]
                upto = None
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] in own:
                        upto = k
                        if name != "tr":
                            break
                    if stack[k][0] in borders:
                        break
                if upto is not None:
                    close(upto)
            found, keep = attribute_groups(attributes) if attributes and attributes.strip() else (0, False)
            keep = keep or marked[stack[-1][1]]
            stack.append((name, add(stack[-1][1], KIND.get(name, len(KINDS)), found, keep)))
        flush()

    as_array = lambda values: np.array(values, np.int64)
    return Nodes(
        *map(as_array, (page, parent, depth, kind, groups)),
        np.array(marked, bool),
        *map(as_array, (chars, words, link_chars, punctuation, segment_node)),
        segments,
    )


def inside(nodes: Nodes, flags: np.ndarray) -> np.ndarray:
    """Whether a node, or one that it lies in, has the flag."""
    out = flags.copy()
    for level in range(1, int(nodes.depth.max(initial=0)) + 1):
        at = np.flatnonzero(nodes.depth == level)
        out[at] |= out[nodes.parent[at]]
    return out


def add_up(nodes: Nodes, values: np.ndarray) -> np.ndarray:
    """Sums over the subtree of every node."""
    out = values.astype(np.float64)
    for level in range(int(nodes.depth.max(initial=0)), 0, -1):
        at = np.flatnonzero(nodes.depth == level)
        np.add.at(out, nodes.parent[at], out[at])
    return out


def node_features(nodes: Nodes) -> np.ndarray:
    """A row of numbers per node: its subtree's density, its attributes and depth, its siblings."""
    n = len(nodes.page)
    parent = np.maximum(nodes.parent, 0)
    has_parent = nodes.parent >= 0
    chars, words = add_up(nodes, nodes.chars), add_up(nodes, nodes.words)
    links = np.minimum(add_up(nodes, nodes.link_chars), chars)
    punctuation = add_up(nodes, nodes.punctuation)
    elements = add_up(nodes, np.ones(n))
    paragraphs = add_up(nodes, nodes.kind == KIND["p"])
    items = add_up(nodes, nodes.kind == KIND["li"])
    texts = add_up(nodes, nodes.chars > 0)
    articles = add_up(nodes, (nodes.kind == KIND["article"]) | (nodes.kind == KIND["main"]))
    roots = np.flatnonzero(~has_parent)
    root = roots[np.searchsorted(roots, np.arange(n), "right") - 1]

    # Text before a node, in page order: its parent's before, and that of earlier siblings.
    order = np.argsort(parent * 1.0 + np.where(has_parent, 0.5, 0.0), kind="stable")
    sums = np.concatenate([[0.0], np.cumsum(chars[order])])
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    group_start = np.searchsorted((parent * 1.0 + np.where(has_parent, 0.5, 0.0))[order],
                                  parent * 1.0 + np.where(has_parent, 0.5, 0.0))
    rank = place - group_start
    before = sums[place] - sums[group_start]
    siblings = np.bincount(parent[has_parent], minlength=n)[parent]
    previous = np.where(rank > 0, chars[order[np.maximum(place - 1, 0)]], 0.0)
    following = np.where(rank + 1 < siblings, chars[order[np.minimum(place + 1, n - 1)]], 0.0)
    above = np.zeros(n, np.int64)
    offset = np.zeros(n)
    for level in range(1, int(nodes.depth.max(initial=0)) + 1):
        at = np.flatnonzero(nodes.depth == level)
        above[at] = above[parent[at]] | nodes.groups[parent[at]]
        offset[at] = offset[parent[at]] + before[at]
    total = np.maximum(chars[root], 1.0)
    below_article = inside(nodes, (nodes.kind == KIND["article"]) | (nodes.kind == KIND["main"]))
    kind_above = np.where(has_parent, nodes.kind[parent], len(KINDS))
    bits = lambda values: [(values >> g) & 1 for g in range(len(ATTRIBUTE_WORDS))]
    columns = [
        *[nodes.kind == k for k in range(len(KINDS))],
        *[kind_above == KIND[name] for name in ("article", "main", "section", "div", "nav", "footer", "aside", "form", "dialog", "details")],
        below_article,
        *bits(nodes.groups),
        *bits(above),
        nodes.depth,
        np.log1p(chars),
        np.log1p(words),
        links / np.maximum(chars, 1),
        chars / elements,
        words / np.maximum(texts, 1),
        punctuation / np.maximum(words, 1),
        np.log1p(paragraphs),
        np.log1p(items),
        np.log1p(articles),
        np.log1p(elements),
        nodes.chars / np.maximum(chars, 1),
        chars / total,
        offset / total,
        (offset + chars) / total,
        chars / np.maximum(chars[parent], 1),
        links[parent] / np.maximum(chars[parent], 1),
        rank,
        rank / np.maximum(siblings, 1),
        siblings,
        np.log1p(previous),
        np.log1p(following),
    ]
    return np.stack([np.asarray(column, np.float32) for column in columns], 1)
