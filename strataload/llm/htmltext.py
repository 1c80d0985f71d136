"""Main text of web pages by boosted trees over the nodes of the page.

A page is read into a tree of elements.  Every element of block kind gets features of
its own and of its place: text and link amounts of its subtree, their density, tokens of
its tag and attributes, depth, and how it compares with its siblings.  Gradient-boosted
trees give probabilities for the element.

Two such models are boosted: one for "some of the subtree is article", one for "all of
it is".  Decoding goes from the root down.  A node without article text is cut with all
that is below it; below a node that is all article only clear furniture is cut.  So no
kept text is inside a cut ancestor, and no node contradicts the one above it.

The model is fitted on pages put together by :func:`training_pages`, a rule that deals
out page furniture and articles in many layouts, with the texts of a bounded sample of
the given pages as filling.  There are no labelled pages to learn from.

Text rules: character references are decoded; scripts, styles, comments, forms' fields
and other markup give no text; white space inside a block becomes one space, ends are
trimmed, empty blocks are left out; blocks are joined by line breaks in page order.

Defined cases: NULL or empty html has an empty text; html without tags is one block,
kept; broken markup is read like a browser would roughly do it (open elements end with
their parent); repeated pages are read alike; an empty table gives an empty result;
other columns pass through, those named like an added column are replaced.
"""

from __future__ import annotations

import html
import random
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataload.llm.common import append, settle


@dataclass(frozen=True)
class HtmlSpec:
    training_pages: int = 600
    filling_rows: int = 200  # pages whose words fill the training pages
    filling_words: int = 3000  # of their words, chosen by a hash
    trees: int = 80
    depth: int = 4
    step: float = 0.2
    bins: int = 32
    cut: float = 0.3  # below: not article, with all descendants
    cut_inside: float = 0.15  # the same below a node that is all article
    whole: float = 0.7  # all of the node is article


# Fixed values of the HTML standard.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript template iframe xmp".split())
_SILENT = frozenset("head script style noscript template iframe title textarea select option svg canvas object audio video button input".split())
_HEAD_CONTENT = frozenset("base basefont bgsound link meta title noscript noframes style script template".split())
_BLOCK = frozenset(
    "html body main article section div header footer nav aside p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead "
    "tbody tfoot tr td th caption blockquote pre figure figcaption form fieldset address details summary hgroup "
    "menu dialog center search".split()
)
_ENDS_P = frozenset(
    "address article aside blockquote center details dialog div dl fieldset figcaption figure footer form h1 h2 h3 h4 "
    "h5 h6 header hgroup hr main menu nav ol p pre search section table ul".split()
)
_SAME_ENDS = {"li": "li", "dt": "dt dd", "dd": "dt dd", "tr": "tr td th", "td": "td th", "th": "td th", "option": "option"}
_SCOPE = {"li": "ul ol menu", "dt": "dl", "dd": "dl", "tr": "table", "td": "tr table", "th": "tr table", "option": "select"}


class Node:
    __slots__ = ("tag", "attributes", "children", "parent")

    def __init__(self, tag: str, attributes: str, parent):
        self.tag, self.attributes, self.parent = tag, attributes, parent
        self.children: list = []  # nodes and strings


_OPENS = re.compile(r"<(?:(!--)|([!?])|(/?)([A-Za-z][^\s/>]*))")
_STOPS = re.compile("[>\"']")


def _tag_end(page: str, at: int) -> int:
    """Where the ``>`` of a tag stands that is not in quotes; -1 without one."""
    while stop := _STOPS.search(page, at):
        if stop.group() == ">":
            return stop.start()
        at = page.find(stop.group(), stop.end()) + 1
        if not at:
            return -1
    return -1


def _body_of(here: Node, text: str) -> Node:
    """Where ``text`` belongs: one that is not blank ends an open head, whose end tag is optional."""
    return here.parent if here.tag == "head" and text.strip() else here


def parse(page: str) -> Node:
    """The element tree of a page."""
    root = Node("html", "", None)
    here, at = root, 0
    last = page.rfind(">")
    quotes = True  # until one is found open at the end of the page; then quotes are signs as others
    opened: Counter = Counter()  # names of the elements around ``here``, itself included

    def leave(node: Node) -> Node:
        """Up to the parent of ``node``."""
        at = here
        while at is not node.parent:
            opened[at.tag] -= 1
            at = at.parent
        return at

    while True:
        found = _OPENS.search(page, at)
        if found is None or (found.start() > last and not found.group(1)):
            if at < len(page):
                _body_of(here, page[at:]).children.append(page[at:])
            return root
        if found.start() > at:
            after = _body_of(here, page[at : found.start()])
            here = here if after is here else leave(here)
            here.children.append(page[at : found.start()])
        if found.group(1) or found.group(2):
            end = page.find("-->", found.end()) + 2 if found.group(1) else page.find(">", found.end())
            at = end + 1 if end > 1 else len(page)
            continue
        end = _tag_end(page, found.end()) if quotes else page.find(">", found.end())
        if end < 0:
            quotes, end = False, page.find(">", found.end())
        attributes, at = page[found.end() : end], end + 1
        name = found.group(4).lower()
        if found.group(3):  # an end tag closes the nearest open element of its name
            if opened[name]:
                node = here
                while node.tag != name:
                    node = node.parent
                here = leave(node)
            continue
        if name == "html":
            root.attributes += attributes
            continue
        if here.tag == "head" and name not in _HEAD_CONTENT:
            here = leave(here)
        if name in _ENDS_P or name in _SAME_ENDS:
            ends = {"p"} if name in _ENDS_P else set(_SAME_ENDS[name].split())
            stops = set(_SCOPE.get(name, "").split()) or {"button", "td", "th", "li", "article", "section", "div", "body", "blockquote"}
            node = here if any(opened[e] for e in ends) else root
            while node is not root and node.tag not in ends and node.tag not in stops:
                node = node.parent
            if node.tag in ends:
                here = leave(node)
        node = Node(name, attributes, here)
        here.children.append(node)
        if name in _RAW:
            end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
            node.children.append(page[at : end.start() if end else len(page)])
            at = end.end() if end else len(page)
        elif name not in _VOID and not attributes.endswith("/"):
            here = node
            opened[name] += 1


_NAMES = re.compile(r"(?:class|id|role|itemprop|aria-label|data-component)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_TOKENS = re.compile(r"[a-z]+")

# Attribute tokens, by what they usually name.
_GROUPS = {
    "article": "article post entry story content main body text prose markdown blogpost articlebody newsarticle page",
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs pagination pager toc tabs toolbar dropdown skip sitemap",
    "frame": "header masthead banner footer copyright legal colophon topbar bottom site logo brand",
    "side": "sidebar aside rail widget related recommended recommendations popular trending more also teaser promo module tags tag",
    "advert": "ad ads advert adverts advertisement sponsor sponsored sponsorship promoted dfp adsense adslot commercial affiliate",
    "notice": "cookie cookies consent gdpr notice alert modal popup overlay newsletter subscribe subscription paywall signup toast disclaimer",
    "comment": "comment comments disqus reply replies respond discussion thread reviews feedback",
    "social": "share sharing social follow like likes author byline meta date time print caption credit login search form",
}
_TOKEN_GROUP = {token: i for i, words in enumerate(_GROUPS.values()) for token in words.split()}
_TAG_GROUPS = (
    "p", "h1", "h2 h3 h4 h5 h6 hgroup", "li dt dd", "ul ol dl menu", "div", "section", "article", "main", "nav", "header",
    "footer", "aside", "form fieldset search", "table thead tbody tfoot tr td th caption", "blockquote", "pre",
    "figure figcaption", "details summary dialog", "body html", "address",
)
_TAG_GROUP = {tag: i for i, tags in enumerate(_TAG_GROUPS) for tag in tags.split()}

_BASICS = (
    "depth", "place", "siblings", "own_chars", "chars", "link_share", "links", "tags_per_char", "words_per_block",
    "stops", "share_of_parent", "share_of_page", "same_tag_siblings", "chars_before", "chars_after", "heading_in",
    "fields_in", "list_in", "lines_up", "parent_link_share", "prose_in_parent", "furniture_tag", "furniture_tokens",
    "furniture_above",
)
FEATURES = (
    *_BASICS,
    *(f"tag_{i}" for i in range(len(_TAG_GROUPS))),
    *(f"own_{g}" for g in _GROUPS),
    *(f"above_{g}" for g in _GROUPS),
    *(f"tag_above_{t}" for t in ("article", "main", "nav", "header", "footer", "aside", "form")),
)


def _token_groups(node: Node) -> np.ndarray:
    out = np.zeros(len(_GROUPS), np.float32)
    if node.attributes:
        for found in _NAMES.finditer(node.attributes):
            value = next((g for g in found.groups() if g), "")
            value = re.sub(r"([a-z])([A-Z])", r"\1 \2", value).lower()
            for token in _TOKENS.findall(value):
                group = _TOKEN_GROUP.get(token)
                if group is not None:
                    out[group] = 1
    return out


@dataclass
class _Stats:
    """Of a block element: the counts of its subtree, and its text blocks."""

    node: Node
    parent: int
    depth: int
    own: int = 0
    chars: int = 0
    linked: int = 0
    links: int = 0
    tags: int = 0
    words: int = 0
    blocks: int = 0
    stops: int = 0
    headings: int = 0
    fields: int = 0
    items: int = 0
    kids: list = field(default_factory=list)


@dataclass
class Page:
    blocks: list  # of _Stats, parents first
    pieces: list  # (index of the block, text), in page order


def outline(root: Node) -> Page:
    """Block elements of a page and the pieces of text that stand directly in them."""
    blocks: list[_Stats] = []
    pieces: list[tuple[int, str]] = []
    # (child or closing mark, its block, inside a link)
    blocks.append(_Stats(root, -1, 0))
    stack: list = [(c, 0, False) for c in reversed(root.children)]
    own: dict[int, list[str]] = {0: []}

    def flush(block: int) -> None:
        text = " ".join(html.unescape("".join(own[block])).split()) if own[block] else ""
        own[block] = []
        if text:
            pieces.append((block, text))
            stats = blocks[block]
            stats.own += len(text)
            stats.chars += len(text)
            stats.words += text.count(" ") + 1
            stats.blocks += 1
            stats.stops += text.count(". ") + text.count(".") - text.count("..") + text.count(",")

    while stack:
        child, block, linked = stack.pop()
        if child is None:  # the end of a block
            flush(block)
            continue
        if isinstance(child, str):
            own[block].append(child)
            if linked:
                blocks[block].linked += len(child.strip())
            continue
        tag = child.tag
        stats = blocks[block]
        stats.tags += 1
        if tag in ("input", "select", "textarea", "button"):
            stats.fields += 1
        if tag in _SILENT:
            continue
        if tag == "br":
            own[block].append(" ")
            continue
        if tag == "hr":
            flush(block)
            continue
        if tag in _BLOCK:
            flush(block)
            blocks.append(_Stats(child, block, stats.depth + 1))
            index = len(blocks) - 1
            stats.kids.append(index)
            own[index] = []
            if tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
                blocks[index].headings = 1
            if tag == "li":
                blocks[index].items = 1
            stack.append((None, index, False))
            stack.extend((c, index, linked) for c in reversed(child.children))
            continue
        if tag == "a":
            stats.links += 1
        stack.extend((c, block, linked or tag == "a") for c in reversed(child.children))
    flush(0)
    for stats in reversed(blocks):
        if stats.parent >= 0:
            up = blocks[stats.parent]
            for name in ("chars", "linked", "links", "tags", "words", "blocks", "stops", "headings", "fields", "items"):
                setattr(up, name, getattr(up, name) + getattr(stats, name))
    return Page(blocks, pieces)


_FURNITURE_TAGS = frozenset("nav header footer aside form menu dialog fieldset search".split())
_TAGS_ABOVE = ("article", "main", "nav", "header", "footer", "aside", "form")


def node_features(page: Page) -> np.ndarray:
    """One row of features per block element."""
    blocks = page.blocks
    out = np.zeros((len(blocks), len(FEATURES)), np.float32)
    groups = [_token_groups(b.node) for b in blocks]
    above_at = len(_BASICS) + len(_TAG_GROUPS) + len(_GROUPS)
    tags_at = above_at + len(_GROUPS)
    furniture_at = _BASICS.index("furniture_tag")
    total = max(1, blocks[0].chars)
    before = 0
    place_of: dict[int, tuple[int, int, int]] = {}
    for stats in blocks:
        tags = [blocks[k].node.tag for k in stats.kids]
        for place, k in enumerate(stats.kids):
            place_of[k] = place, len(tags), tags.count(tags[place])
    for i, stats in enumerate(blocks):
        up = blocks[stats.parent] if stats.parent >= 0 else stats
        place, siblings, same = place_of.get(i, (0, 1, 1))
        chars = stats.chars
        out[i, : len(_BASICS)] = (
            stats.depth, place / siblings, np.log1p(siblings), np.log1p(stats.own), np.log1p(chars),
            stats.linked / max(1, chars), np.log1p(stats.links), stats.tags / max(1, chars),
            stats.words / max(1, stats.blocks), stats.stops / max(1, stats.words), chars / max(1, up.chars), chars / total,
            same / siblings, before / total, max(0, total - before - chars) / total, min(stats.headings, 5),
            min(stats.fields, 5), stats.items / max(1, stats.blocks), np.log1p(stats.blocks),
            up.linked / max(1, up.chars), up.words / max(1, up.blocks), stats.node.tag in _FURNITURE_TAGS,
            groups[i][1:].sum(), 0,
        )
        if stats.parent >= 0:
            marked = out[stats.parent, furniture_at : furniture_at + 3]
            out[i, furniture_at + 2] = marked[2] + (marked[0] > 0 or marked[1] > 0)
        tag = _TAG_GROUP.get(stats.node.tag)
        if tag is not None:
            out[i, len(_BASICS) + tag] = 1
        out[i, above_at - len(_GROUPS) : above_at] = groups[i]
        if stats.parent >= 0:
            p = stats.parent
            out[i, above_at:tags_at] = np.maximum(out[p, above_at:tags_at], groups[p])
            out[i, tags_at:] = out[p, tags_at:]
            if blocks[p].node.tag in _TAGS_ABOVE:
                out[i, tags_at + _TAGS_ABOVE.index(blocks[p].node.tag)] = 1
        before += stats.own
    return out


@dataclass
class Trees:
    """Boosted trees of fixed depth: per tree the features, cuts and leaves in heap order."""

    base: float
    features: np.ndarray
    cuts: np.ndarray
    leaves: np.ndarray

    def probability(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        depth = int(np.log2(self.leaves.shape[1])) if len(self.leaves) else 0
        rows = np.arange(len(x))
        for features, cuts, leaves in zip(self.features, self.cuts, self.leaves):
            at = np.zeros(len(x), np.int64)
            for _ in range(depth):
                at = 2 * at + 1 + (x[rows, features[at]] > cuts[at])
            total += leaves[at - (len(leaves) - 1)]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def boost(x: np.ndarray, y: np.ndarray, spec: HtmlSpec) -> Trees:
    """Gradient boosting on binned features with logistic loss."""
    share = float(np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3))
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, spec.bins + 1)[1:-1], method="lower")) for j in range(x.shape[1])]
    at = np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)], axis=1)
    width = spec.bins
    inner, size = 2**spec.depth - 1, x.shape[1]
    flat = at + np.arange(size) * width
    total = np.full(len(y), np.log(share / (1 - share)))
    trees = Trees(float(total[0]) if len(y) else 0.0, np.zeros((0, inner), int), np.zeros((0, inner)), np.zeros((0, inner + 1)))
    made = []
    for _ in range(spec.trees):
        p = 1 / (1 + np.exp(-np.clip(total, -30, 30)))
        g, h = y - p, p * (1 - p)
        features, cuts = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(len(y), np.int64)
        for k in range(inner):
            rows = np.flatnonzero(node == k)
            nxt = 2 * k + 1
            if len(rows) >= 10:
                cells = flat[rows].ravel()
                gs = np.bincount(cells, np.repeat(g[rows], size), size * width).reshape(size, width).cumsum(axis=1)
                hs = np.bincount(cells, np.repeat(h[rows], size), size * width).reshape(size, width).cumsum(axis=1)
                gt, ht = gs[:, -1:], hs[:, -1:]
                gain = gs**2 / (hs + 1) + (gt - gs) ** 2 / (ht - hs + 1) - gt**2 / (ht + 1)
                gain[(hs < 1e-3) | (ht - hs < 1e-3)] = 0
                j, b = np.unravel_index(int(np.argmax(gain)), gain.shape)
                if gain[j, b] > 1e-6 and b < len(edges[j]):
                    features[k], cuts[k] = j, edges[j][b]
                    node[rows] = nxt + (at[rows, j] > b)
                    continue
            node[rows] = nxt
        leaf = node - inner
        gl, hl = np.bincount(leaf, g, inner + 1), np.bincount(leaf, h, inner + 1)
        leaves = spec.step * gl / (hl + 1)
        total += leaves[leaf]
        made.append((features, cuts, leaves))
    if made:
        trees.features, trees.cuts, trees.leaves = (np.stack(part) for part in zip(*made))
    return trees


@dataclass
class PageModel:
    """``some``: article text is in the subtree; ``all``: nothing else is."""

    some: Trees
    all: Trees


def decode(page: Page, some: np.ndarray, whole: np.ndarray, spec: HtmlSpec) -> str:
    """The text of the kept blocks, decided from the root down.

    Below a node that is all article only clear furniture is cut; below one that is cut
    nothing is kept.
    """
    state = np.zeros(len(page.blocks), np.int8)  # 2: all article, 1: kept, -1: cut
    for i, stats in enumerate(page.blocks):
        up = state[stats.parent] if stats.parent >= 0 else 0
        if up < 0 or (i and some[i] < (spec.cut_inside if up == 2 else spec.cut)):
            state[i] = -1
        else:
            state[i] = 2 if up == 2 or whole[i] >= spec.whole else 1
    return "\n".join(text for block, text in page.pieces if state[block] > 0)


def extract(texts, model: PageModel, spec: HtmlSpec) -> list[str]:
    """Main texts of pages; the nodes of all pages are scored together."""
    pages = [outline(parse(t)) if t else None for t in texts]
    rows = [node_features(p) for p in pages if p is not None]
    if not rows:
        return ["" for _ in texts]
    x = np.concatenate(rows)
    some, whole = model.some.probability(x), model.all.probability(x)
    out, at = [], 0
    for page in pages:
        if page is None:
            out.append("")
            continue
        size = len(page.blocks)
        out.append(decode(page, some[at : at + size], whole[at : at + size], spec))
        at += size
    return out


_GOLD = 'data-gold="1"'  # marks elements of the article in training pages
_FURNITURE = (
    # tag, class names, what is inside
    ("nav", "menu main-nav navigation navbar site-nav", "links"),
    ("div", "menu nav-bar breadcrumbs topbar pagination", "links"),
    ("ul", "menu nav tabs breadcrumb pager", "items"),
    ("header", "site-header masthead top banner", "short"),
    ("div", "header banner logo site-title", "short"),
    ("footer", "site-footer footer colophon", "mixed"),
    ("div", "footer copyright bottom legal", "mixed"),
    ("aside", "sidebar widget related side", "mixed"),
    ("div", "sidebar widget related-posts recommended more-stories trending popular", "mixed"),
    ("section", "related recommended teasers", "mixed"),
    ("div", "ad advert ads advertisement sponsored ad-slot promo", "prose"),
    ("aside", "ad advert sponsored promo", "prose"),
    ("div", "cookie-notice cookie-banner consent gdpr notice alert notification", "prose"),
    ("section", "notice alert cookie-consent", "prose"),
    ("form", "newsletter-form search subscribe login signup contact", "form"),
    ("div", "newsletter subscribe subscription signup-box", "form"),
    ("section", "comments discussion responses reader-comments", "comments"),
    ("div", "comments comment-list disqus replies", "comments"),
    ("ol", "comment-list commentlist comments", "comment_items"),
    ("div", "share social-links follow tags meta-links", "links"),
)
_ARTICLES = (
    ("article", ""), ("article", "post entry article"), ("main", "content main"), ("section", "story article-body content"),
    ("div", "post-content entry-content article-body story content text main-text"), ("div", "content main post article"),
    ("td", "content main body"), ("div", ""),
)


class _Writer:
    """Deals out one training page."""

    def __init__(self, words: list[str], seed: int):
        self.words, self.random, self.named = words, random.Random(seed), False

    def some(self, low: int, high: int) -> str:
        r = self.random
        out = [r.choice(self.words) for _ in range(r.randint(low, high))]
        return " ".join(out)

    def sentence(self) -> str:
        text = self.some(3, 16)
        return html.escape(text[:1].upper() + text[1:] + self.random.choice((".", ".", ",", "")), quote=False)

    def prose(self, low: int = 1, high: int = 5) -> str:
        return " ".join(self.sentence() for _ in range(self.random.randint(low, high)))

    def attributes(self, names: str) -> str:
        r = self.random
        if not names or (not self.named and r.random() < 0.08):
            return f' class="{r.choice("abcxyz")}{r.randint(1, 99)}"' if r.random() < 0.3 else ""
        name = r.choice(names.split())
        return f' {"id" if r.random() < 0.25 else "class"}="{name}{" c" + str(r.randint(1, 9)) if r.random() < 0.2 else ""}"'

    def links(self, count: int, inside: str = "") -> str:
        made = [f'<a href="/{i}">{html.escape(self.some(1, 4))}</a>' for i in range(count)]
        return "".join(f"<{inside}>{x}</{inside}>" for x in made) if inside else self.random.choice((" ", " | ")).join(made)

    def furniture(self, tag: str, names: str, inside: str) -> str:
        r = self.random
        if inside == "links":
            body = f"<ul>{self.links(r.randint(2, 9), 'li')}</ul>" if r.random() < 0.6 else self.links(r.randint(2, 9))
        elif inside == "items":
            body = self.links(r.randint(2, 9), "li")
        elif inside == "short":
            body = r.choice(("", f"<h1>{self.some(1, 4)}</h1>", f'<a href="/">{self.some(1, 3)}</a>')) + f"<p>{self.some(2, 8)}</p>"
        elif inside == "prose":
            body = self.prose(1, 3) if r.random() < 0.5 else self.some(1, 4) if r.random() < 0.4 else "".join(f"<p>{self.prose(1, 2)}</p>" for _ in range(r.randint(1, 3)))
            body += r.choice(("", "", f'<a href="/x">{self.some(1, 3)}</a>', "<button>OK</button>"))
        elif inside == "form":
            body = f"<p>{self.prose(1, 2)}</p>" if r.random() < 0.6 else ""
            field_text = f"<label>{self.some(1, 3)}</label><input type=text><button>{self.some(1, 2)}</button>"
            body += field_text if tag == "form" else f"<form>{field_text}</form>"
        elif inside in ("comments", "comment_items"):
            one = "li" if inside == "comment_items" else r.choice(("div", "p", "li"))
            body = "" if one == "li" and tag == "ol" else f"<h{r.randint(2, 4)}>{self.some(1, 3)}</h3>"
            for _ in range(r.randint(1, 8)):
                author = f"<span>{self.some(1, 2)}</span> " if r.random() < 0.5 else ""
                text = self.prose(1, 4) if one == "p" or r.random() < 0.4 else f"<p>{self.prose(1, 4)}</p>"
                body += f"<{one}{self.attributes('comment reply comment-body') if r.random() < 0.6 else ''}>{author}{text}</{one}>"
        else:
            body = r.choice(("", f"<h3>{self.some(1, 3)}</h3>"))
            body += r.choice((self.prose(1, 2), f"<p>{self.prose(1, 2)}</p>", f"&copy; {self.some(1, 3)} &middot; {self.sentence()}"))
            body += r.choice(("", "", f"<ul>{self.links(r.randint(2, 8), 'li')}</ul>", self.links(r.randint(1, 6))))
        return f"<{tag}{self.attributes(names)}>{body}</{tag}>"

    def any_furniture(self, named: bool = False) -> str:
        """``named``: as furniture inside an article is, or nothing would tell it from the article."""
        self.named = named
        made = self.furniture(*self.random.choice(_FURNITURE))
        self.named = False
        return made

    def article(self) -> str:
        r = self.random
        parts = [f"<h1 {_GOLD}>{self.sentence()}</h1>"] if r.random() < 0.85 else []
        for _ in range(r.choice((1, 1, 2, 3, 4, 6, 9, 14, 25))):
            kind = r.random()
            if kind < 0.72:
                text = self.prose(1, r.choice((1, 2, 4, 9)))
                if r.random() < 0.15:
                    text = f"<b>{text}<br>" if r.random() < 0.5 else f'{text} <a href="/y">{self.some(1, 3)}</a> {self.prose(1, 2)}'
                parts.append(f"<p {_GOLD}>{text}" + ("</p>" if r.random() < 0.85 else ""))
            elif kind < 0.80:
                parts.append(f"<h2 {_GOLD}>{self.some(1, 7)}</h2>")
            elif kind < 0.86:
                parts.append(f"<ul {_GOLD}>" + "".join(f"<li {_GOLD}>{self.prose(1, 1)}</li>" for _ in range(r.randint(2, 6))) + "</ul>")
            elif kind < 0.90:
                parts.append(f"<blockquote {_GOLD}><p {_GOLD}>{self.prose(1, 3)}</p></blockquote>")
            elif kind < 0.93:
                parts.append(f"<pre {_GOLD}>{self.prose(1, 3)}</pre>")
            elif kind < 0.96:
                cells = "".join(f"<td {_GOLD}>{self.some(1, 5)}</td>" for _ in range(3))
                parts.append(f"<table {_GOLD}><tr {_GOLD}>{cells}</tr></table>")
            else:
                parts.append(f"<div {_GOLD}>{self.prose(1, 4)}</div>")
            if r.random() < 0.03:
                parts.append(self.any_furniture(named=True))
        if r.random() < 0.15:
            parts.append(self.any_furniture(named=True))
        body = "".join(parts)
        if r.random() < 0.2:
            body = f"<div {_GOLD}>{body}</div>"
        tag, names = r.choice(_ARTICLES)
        made = f"<{tag}{self.attributes(names)} {_GOLD}>{body}</{tag}>"
        return f"<table><tr>{made}</tr></table>" if tag == "td" else made

    def page(self) -> str:
        r = self.random
        before = "".join(self.any_furniture() for _ in range(r.randint(0, 4)))
        after = "".join(self.any_furniture() for _ in range(r.randint(0, 5)))
        middle = self.article()
        for _ in range(r.randint(0, 2)):
            tag = r.choice(("div", "main", "section", "div"))
            extra = self.any_furniture() if r.random() < 0.3 else ""
            middle = f"<{tag}{self.attributes('wrapper container main content page site layout column')}>{middle}{extra}</{tag}>"
        head = f"<head><title>{self.some(2, 6)}</title><script>var a='<p>';</script></head>" if r.random() < 0.9 else ""
        return f"<!DOCTYPE html><html>{head}<body>{before}{middle}{after}</body></html>"


def training_pages(words: list[str], count: int) -> Iterator[str]:
    """Pages put together by rule; elements of the article carry a mark that features do not see."""
    words = sorted(set(words)) or ["text"]
    for seed in range(count):
        yield _Writer(words, seed).page()


def labelled_nodes(pages: Iterator[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all block elements with text; whether some and whether all of it is article."""
    xs, some, whole = [], [], []
    for text in pages:
        page = outline(parse(text))
        own = np.array([b.own for b in page.blocks])
        gold = np.where([_GOLD in b.node.attributes for b in page.blocks], own, 0)
        for i in range(len(page.blocks) - 1, 0, -1):
            gold[page.blocks[i].parent] += gold[i]
        chars = np.array([b.chars for b in page.blocks])
        xs.append(node_features(page)[chars > 0])
        some.append((gold > 0)[chars > 0])
        whole.append((gold == chars)[chars > 0])
    return np.concatenate(xs), np.concatenate(some).astype(float), np.concatenate(whole).astype(float)


_WORD = re.compile(r"[^\W\d_]{1,20}")


def fit(pages: DataFrame, spec: HtmlSpec = HtmlSpec()) -> PageModel:
    """Trees fitted on training pages that are filled with words of a sample of ``pages``."""
    sample = pages.filter("html is not null").select("page_id", "html")
    sample = settle(sample.select("page_id").orderBy(F.xxhash64(F.lit("filling"), "page_id"), "page_id").limit(spec.filling_rows))
    rows = pages.select("page_id", "html").join(sample.distinct(), "page_id", "left_semi")

    def words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = set()
            for text in batch.html:
                for _, piece in outline(parse(text or "")).pieces:
                    found.update(_WORD.findall(piece))
            yield pd.DataFrame({"word": sorted(found)}, dtype=object)

    filling = rows.select("html").mapInPandas(words, "word string").distinct()
    filling = filling.orderBy(F.xxhash64("word"), "word").limit(spec.filling_words)
    pages_of = training_pages([r["word"] for r in filling.collect()], spec.training_pages)
    x, some, whole = labelled_nodes(pages_of)
    return PageModel(boost(x, some, spec), boost(x, whole, spec))


def main_text(pages: DataFrame, model: PageModel, spec: HtmlSpec = HtmlSpec()) -> DataFrame:
    """``pages`` with the columns text and n_chars (code points of it)."""
    sent = pages.sparkSession.sparkContext.broadcast(model)  # a few thousand numbers

    def run(batch: pd.DataFrame) -> pd.DataFrame:
        texts = extract(batch.html.tolist(), sent.value, spec)
        return pd.DataFrame({"text": texts, "n_chars": [len(t) for t in texts]})

    return append(pages, ["html"], run, T.StructType().add("text", "string").add("n_chars", "long"))
