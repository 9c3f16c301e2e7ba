"""Main text of web pages (operator 4).

A page becomes a flat list of text blocks. Each block has its word count and
link density, those of the block before and the block after, and whether its
surroundings name boilerplate or an article. A decision tree, trained here on
the small labelled table below, decides which blocks are main text. Names decide
where there are any; word counts and densities of a block and its neighbours
decide on the rest, such as pages without an article tag.

A class name speaks for what its element holds, unless that is the page's layout:
an element that holds the article, or the page's title where there is none, says
nothing about the blocks in it.

Tags are found in one pass over the page: what is not closed is looked for once.

Pages are independent: one map over whole pages, no shuffle.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape
from itertools import pairwise

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts

# Fixed values of the markup language.
MARKUP = re.compile(r"<!--|<[!?]|<(/?)([a-zA-Z][^\s/>]*)")
TAG_END = re.compile(r">|=\s*([\"'])")
SILENT = {"script", "style", "head", "noscript", "template", "svg", "iframe", "object", "select", "textarea",
          "button", "canvas", "math", "audio", "video"}
RAW = {"script", "style", "textarea", "iframe", "noscript", "svg"}
#: Tags that leave an open head open, and those of them whose content is skipped.
HEAD_TAGS = {"html", "head", "title", "meta", "link", "base", "basefont", "bgsound", "noframes", "script", "style",
             "noscript", "template"}
HEAD_CONTENT = {"title", "script", "style", "noscript", "noframes", "template"}
#: Silent tags that may hold another of their name.
NESTED = {"object", "template"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i",
          "img", "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike",
          "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "br"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr",
        "option"}
#: Tags that an unclosed silent tag may hold beside those of running text.
HELD = (VOID - {"hr"}) | {"param", "optgroup"}
#: Tags whose end may be left out: the open tags that a new one ends, and the tags below which it finds them.
ENDS = {"li": ({"li"}, {"div", "p", "address"}), "dt": ({"dt", "dd"}, {"div", "p", "address"}),
        "dd": ({"dt", "dd"}, {"div", "p", "address"}), "tr": ({"tr"}, {"td", "th", "div", "p", "ul", "ol", "li"}),
        "td": ({"td", "th"}, {"div", "p", "ul", "ol", "li"}), "th": ({"td", "th"}, {"div", "p", "ul", "ol", "li"})}
#: Tags that an end tag of these does not reach beyond.
WALLS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}}
BOILER_TAGS = {"nav", "footer", "aside", "form", "header", "menu", "dialog"}
BOILER_WORDS = {"ad", "ads", "adv", "advert", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs",
                "comment", "comments", "consent", "cookie", "cookies", "copyright", "disclaimer", "footer", "gdpr",
                "header", "login", "masthead", "menu", "menubar", "modal", "nav", "navbar", "navigation", "newsletter",
                "notice", "notices", "pager", "pagination", "popup", "promo", "promoted", "reader", "readers",
                "related", "replies", "search", "share", "sharing", "sidebar", "signup", "social", "sponsor",
                "sponsored", "subscribe", "toolbar", "topbar", "widget"}
ARTICLE_TAGS = {"article", "main"}
#: An article's own head is none of the site's.
HEAD_WORDS = {"header", "masthead"}
ARTICLE_WORDS = {"article", "post", "entry", "story", "page", "title"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "alert", "dialog"}
ATTR = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)

FEATURES = 8


def names_boilerplate(attrs: str) -> bool:
    for key, value in ATTR.findall(attrs):
        words = set(re.split(r"[^a-z]+", value.lower()))
        named = words & BOILER_WORDS
        if named and not (named <= HEAD_WORDS and words & ARTICLE_WORDS) or key.lower() == "role" and words & ROLES:
            return True
    return False


class Markup:
    """Tags of a page, each found in time that its length takes; ``next(at)`` is the first at or after a place.

    A quote opens a value after an equals sign only. A value or tag without end is
    looked for once: from then on such quotes, or all quotes, are plain characters.
    """

    def __init__(self, html: str):
        self.html, self.plain, self.open_quotes = html, False, set()

    def _end(self, at: int) -> int:
        if not self.plain:
            place = at
            while m := TAG_END.search(self.html, place):
                if not m[1]:
                    return m.start()
                stop = -1 if m[1] in self.open_quotes else self.html.find(m[1], m.end())
                if stop < 0:
                    self.open_quotes.add(m[1])
                place = m.end() if stop < 0 else stop + 1
            self.plain = True
        return self.html.find(">", at)

    def next(self, at: int):
        """(start, end, whether it is an end tag, name in lower case or None, attributes), or None."""
        m = MARKUP.search(self.html, at)
        if not m:
            return None
        if m[0] == "<!--":
            stop = self.html.find("-->", m.end())
            return m.start(), len(self.html) if stop < 0 else stop + 3, False, None, ""
        stop = self._end(m.end()) if m[2] else self.html.find(">", m.end())
        if stop < 0:
            return None
        return m.start(), stop + 1, bool(m[1]), m[2] and m[2].lower(), self.html[m.end():stop] if m[2] else ""


def blocks(html: str) -> list[tuple[str, int, int, bool, bool]]:
    """(text, words, words inside links, in boilerplate, in an article) of each block, in page order."""
    out: list = []
    open_tags: list[tuple[str, int, bool]] = []  # name, element, in an article
    is_open: Counter = Counter()
    # Of each element: its parent, whether its tag or its class names boilerplate, whether it holds an article, a title.
    parent, by_tag, by_class, holds_article, holds_title = [], [], [], [], []
    text: list[str] = []
    state = {"links": 0, "link": 0}

    def close():
        body = " ".join(unescape("".join(text)).split())
        if body:
            element, article = open_tags[-1][1:] if open_tags else (-1, False)
            out.append((body, body.count(" ") + 1, min(state["links"], body.count(" ") + 1), element, article))
        text.clear()
        state["links"] = 0

    def leave(ended: set, below: set | None = None, walls: set = frozenset()):
        """Close the innermost of the open tags ``ended``, where only tags ``below`` and no ``walls`` stand above it."""
        if not any(is_open[t] for t in ended):
            return
        for k in range(len(open_tags) - 1, -1, -1):
            if open_tags[k][0] in ended:
                is_open.subtract(t[0] for t in open_tags[k:])
                del open_tags[k:]
                return
            if open_tags[k][0] in walls or below is not None and open_tags[k][0] not in below:
                return

    def closer(tag: str, start: int):
        """The next end tag of this name; each is looked for once."""
        found = ends.get(tag, False)
        if found is False or found is not None and found.start() < start:
            found = ends[tag] = re.compile(f"</{re.escape(tag)}(?=[\\s/>]|$)", re.I).search(html, start)
        return found

    def opener(tag: str, start: int):
        """The next start or end tag of this name."""
        found = starts.get(tag)
        if found is None or found.start() < start:
            found = starts[tag] = re.compile(f"<(/?){re.escape(tag)}(?=[\\s/>]|$)", re.I).search(html, start)
        return found

    ends: dict = {}
    starts: dict = {}
    inline: Counter = Counter()
    # The tag whose content is skipped, the tags opened in it, and whether its end is missing.
    skip, inner, unclosed = None, [], False
    at, markup = 0, Markup(html)
    while m := markup.next(at):
        piece = html[at:m[0]]
        at = m[1]
        if skip == "head" and piece.strip():
            skip = None
        if skip is None:
            text.append(piece)
            if state["link"]:
                state["links"] += len(unescape(piece).split())
        end, tag, attrs = m[2:]
        if not tag:
            continue
        if skip == "head":
            if end:
                skip = None if tag == "head" else skip
                continue
            if tag in HEAD_CONTENT:
                stop = closer(tag, at)
                if stop:
                    at = stop.start()
                elif tag in ("script", "style"):
                    at = len(html)
                continue
            if tag in HEAD_TAGS:
                continue
            skip = None
        elif skip is not None:
            if end and tag in inner:
                while inner.pop() != tag:
                    pass
                continue
            if end and tag == skip:
                skip = None
                continue
            if end:
                parents = tag == "a" and state["link"] or inline[tag] or is_open[tag]
                if not parents:
                    continue
            elif unclosed and (tag == skip or tag not in INLINE and tag not in SILENT and tag not in HELD):
                pass
            else:
                stop = closer(tag, at) if tag in RAW else None
                if stop:
                    at = stop.end()
                elif tag not in VOID and tag not in ("br", "img", "wbr") and not attrs.rstrip().endswith("/"):
                    inner.append(tag)
                continue
            skip = None
        if tag in SILENT:
            if not end and not attrs.rstrip().endswith("/"):
                skip, inner, unclosed = tag, [], False
                if tag in RAW:  # its content is no markup
                    stop = closer(tag, at)
                    if stop or tag in ("script", "style"):
                        at = stop.start() if stop else len(html)
                    else:
                        unclosed = True
                elif tag != "head":
                    following = opener(tag, at) if closer(tag, at) else None
                    unclosed = following is None or not following[1] and tag not in NESTED
                if tag not in RAW and tag != "head":
                    text.append(" ")
            continue
        if tag == "a":
            state["link"] = 0 if end else 1
            continue
        if tag in INLINE:
            inline[tag] = max(0, inline[tag] + (-1 if end else 1))
            if tag == "br":
                text.append(" ")
            continue
        close()
        state["link"] = 0
        if end:
            if tag not in VOID:
                leave({tag}, walls=WALLS.get(tag, frozenset()))
            continue
        if tag not in VOID or tag == "hr":
            leave({"p"}, set())
        if tag in VOID or attrs.rstrip().endswith("/"):
            continue
        if tag in ENDS:
            leave(*ENDS[tag])
        above, article = open_tags[-1][1:] if open_tags else (-1, False)
        own_header = tag == "header" and article
        article = article or tag in ARTICLE_TAGS
        parent.append(above)
        by_tag.append(tag in BOILER_TAGS and not own_header)
        by_class.append(tag != "body" and names_boilerplate(attrs))
        holds_article.append(tag in ARTICLE_TAGS)
        holds_title.append(tag == "h1")
        open_tags.append((tag, len(parent) - 1, article))
        is_open[tag] += 1
    rest = html[at:]
    if skip is None or skip == "head" and rest.strip():
        text.append(rest)
    close()
    # An element is older than what it holds.
    for k in range(len(parent) - 1, -1, -1):
        if parent[k] >= 0:
            holds_article[parent[k]] |= holds_article[k]
            holds_title[parent[k]] |= holds_title[k]
    by_title = not any(holds_article)
    boiler: list[bool] = []
    for k, up in enumerate(parent):
        layout = holds_article[k] or by_title and holds_title[k]
        named = by_tag[k] and not holds_article[k] or by_class[k] and not layout
        boiler.append(named or up >= 0 and boiler[up])
    return [(*b[:3], b[3] >= 0 and boiler[b[3]], b[4]) for b in out]


def features(page: list) -> np.ndarray:
    """Rows: words and link density of the block before, this one and the next; boilerplate; article."""
    words = np.array([0, *(b[1] for b in page), 0], dtype=float)
    links = np.array([0, *(b[2] for b in page), 0], dtype=float)
    density = links / np.maximum(words, 1)
    out = np.zeros((len(page), FEATURES))
    for k in range(3):
        out[:, k] = words[k:k + len(page)]
        out[:, 3 + k] = density[k:k + len(page)]
    out[:, 6] = [b[3] for b in page]
    out[:, 7] = [b[4] for b in page]
    return out


# The labelled table: blocks of invented pages as (markup, main text or not).
# Each inner list is a page; neighbours matter, so blocks stay in page order.
_LONG = "The river rose during the night and the people of the lower town carried what they could to the hill."
_MORE = "By morning the bridge was gone, and it took the council most of a year to agree on how a new one should look."
LABELLED = [
    [("<nav><ul><li><a href='/'>Home</a></li><li><a href='/n'>News</a></li></ul></nav>", 0),
     (f"<article><h1>The flood</h1></article>", 1), (f"<article><p>{_LONG}</p></article>", 1),
     ("<article><p>So it was.</p></article>", 1), (f"<article><p>{_MORE}</p></article>", 1),
     ("<footer>All rights reserved. Example press.</footer>", 0)],
    [("<div class='ad'>Buy two pairs of shoes and get one more for free until the end of this month.</div>", 0),
     ("<article><h1>Of</h1></article>", 1), ("<article><p>It.</p></article>", 1),
     ("<article><p>See <a href='/x'>the older report</a> for more.</p></article>", 1),
     (f"<aside>{_LONG}</aside>", 0), (f"<div class='comments'><p>{_MORE}</p></div>", 0),
     ("<footer><a href='/imprint'>Imprint</a> and <a href='/terms'>terms</a></footer>", 0)],
    [("<div><a href='/'>Home</a> <a href='/w'>World</a> <a href='/s'>Sport</a></div>", 0),
     (f"<div><p>{_LONG}</p></div>", 1), (f"<div><p>{_MORE}</p></div>", 1), (f"<div><p>{_LONG} {_MORE}</p></div>", 1),
     ("<div>Next: <a href='/2'>page two of the story</a></div>", 0), ("<div>Example press 2020</div>", 0)],
    [("<div>Example press</div>", 0), ("<div><a href='/'>Home</a></div>", 0), (f"<p>{_MORE}</p>", 1),
     (f"<p>{_LONG} It was told by <a href='/a'>one witness</a>.</p>", 1), (f"<p>{_MORE}</p>", 1),
     ("<div><a href='/p'>Privacy</a></div>", 0), ("<div><a href='/c'>Contact us</a></div>", 0)],
    [(f"<div class='cookie-notice'>{_LONG}</div>", 0), (f"<form>Your name and your {_MORE}</form>", 0),
     ("<main><h2>Part one</h2></main>", 1), (f"<main><p>{_LONG}</p></main>", 1),
     ("<main><ul><li><a href='/1'>First source</a></li></ul></main>", 1), (f"<main><p>{_MORE}</p></main>", 1),
     (f"<header>{_LONG}</header>", 0), (f"<div id='sidebar'>{_MORE}</div>", 0)],
    [("<article><p><a href='/s'>Sources</a></p></article>", 1), (f"<article><p>{_LONG}</p></article>", 1),
     (f"<div class='promo'>{_LONG}</div>", 0), (f"<article><div class='comment'>{_MORE}</div></article>", 0),
     (f"<article><nav><a href='/t'>{_LONG}</a></nav></article>", 0)],
]


LABELLED += [
    [("<article><h1>Short</h1></article>", 1), (f"<article><p>{_LONG}</p></article>", 1)],
    [("<article><p>Is.</p></article>", 1)],
    [("<article><p><a href='/a'>A linked line of text</a></p></article>", 1), ("<article><p>Of it.</p></article>", 1)],
    [(f"<p>{_LONG}</p>", 1), (f"<p>{_MORE}</p>", 1)],
]


def unnamed_pages() -> list:
    """Pages whose elements have no telling names: counts and densities of neighbours alone tell their blocks apart.

    Titles and short paragraphs stand beside running text, boilerplate lines beside links and the page's edges.
    """
    words = (_LONG + " " + _MORE).replace(".", "").split()
    plain = lambda n: f"<p>{' '.join((words * 9)[:n])}.</p>"
    links = lambda n: "".join(f"<div><a href='/{w}'>{w} {v}</a></div>" for w, v in zip(words[:n], words[n:]))
    half = lambda n: f"<p>{' '.join(words[:n])} <a href='/'>{' '.join(words[n:n + max(1, n // 3)])}</a></p>"
    out = []
    for long in (16, 24, 45, 90, 200):
        out += [[(plain(long), 1)], [(links(3), 0), (plain(long), 1)], [(plain(long), 1), (links(3), 0)]]
        for short in (1, 2, 4, 7, 11):
            out.append([(links(5), 0), (plain(short), 1), (plain(long), 1), (plain(short), 1), (plain(long), 1),
                        (half(long), 1), (plain(short), 1), (links(4), 0), (plain(short), 0), (links(2), 0)])
            out.append([(plain(short), 0), (links(3), 0), (plain(long), 1), (plain(long + short), 1), (links(1), 0),
                        (plain(min(short, 4)), 0)])
            out.append([(plain(short), 1), (plain(long), 1), (plain(short), 1), (plain(short), 1), (plain(long), 1)])
    return out


def named_pages() -> list:
    """Articles of short and linked blocks between named boilerplate of any length: there, names decide."""
    words = (_LONG + " " + _MORE).replace(".", "").split()
    part = lambda tag, n: f"<{tag}>{' '.join((words * 9)[:n])}</{tag.split()[0]}>"
    article = lambda n: f"<article>{part('p', n)}</article>"
    linked = "<article><p><a href='/a'>An older report</a></p></article>"
    out = []
    for n in (1, 3, 8, 20, 60):
        out.append([(part("nav", n), 0), (article(n), 1), (linked, 1), (article(1), 1), (part("div class='ad'", n), 0), (article(2), 1),
                    (part("aside", n), 0), (article(n), 1), (part("div class='comment'", n), 0), (part("div class='comment'", 1), 0),
                    (article(1), 1), (part("footer", n), 0)])
        out += [[(article(m), 1), (article(n), 1), (article(m), 1)] for m in (1, 3, 12)]
    return out


LABELLED += unnamed_pages() + named_pages()


def training_rows(labelled=None) -> tuple[np.ndarray, np.ndarray]:
    x, y = [], []
    for page in LABELLED if labelled is None else labelled:
        found = blocks("".join(markup for markup, _ in page))
        marks = [mark for markup, mark in page for _ in blocks(markup)]
        x.append(features(found))
        y += marks
    return np.concatenate(x), np.array(y)


class Tree:
    """Binary decision tree grown by Gini impurity; arrays of nodes, so that it can be sent to tasks."""

    def __init__(self, x: np.ndarray, y: np.ndarray, depth: int = 6):
        self.feature, self.cut, self.left, self.right, self.value = [], [], [], [], []
        self._grow(x, y, depth)

    def _grow(self, x, y, depth) -> int:
        node = len(self.value)
        for column, v in ((self.feature, -1), (self.cut, 0.0), (self.left, -1), (self.right, -1),
                          (self.value, float(y.mean()))):
            column.append(v)
        best = self._split(x, y) if depth and 0 < y.sum() < len(y) else None
        if best:
            self.feature[node], self.cut[node] = best
            low = x[:, best[0]] <= best[1]
            self.left[node] = self._grow(x[low], y[low], depth - 1)
            self.right[node] = self._grow(x[~low], y[~low], depth - 1)
        return node

    @staticmethod
    def _split(x, y):
        """(feature, cut) with the lowest impurity; ties go to the later feature, then the lower cut."""
        best, least = None, np.inf
        for f in range(x.shape[1] - 1, -1, -1):
            for a, b in pairwise(np.unique(x[:, f])):
                low = x[:, f] <= (a + b) / 2
                impurity = sum(len(p) * 2 * p.mean() * (1 - p.mean()) for p in (y[low], y[~low]))
                if impurity < least - 1e-12:
                    best, least = (f, float((a + b) / 2)), impurity
        return best

    def predict(self, x: np.ndarray) -> np.ndarray:
        feature, cut, left, right = map(np.array, (self.feature, self.cut, self.left, self.right))
        node = np.zeros(len(x), dtype=np.int64)
        while (inner := feature[node] >= 0).any():
            rows = np.flatnonzero(inner)
            at = node[rows]
            node[rows] = np.where(x[rows, feature[at]] <= cut[at], left[at], right[at])
        return np.array(self.value)[node] > 0.5


def trained() -> Tree:
    return Tree(*training_rows())


def main_blocks(html: str, tree: Tree) -> list[str]:
    page = blocks(html)
    if not page:
        return []
    return [b[0] for b, wanted in zip(page, tree.predict(features(page))) if wanted]


def extract(pages: DataFrame, html_col: str = "html", keep: list[str] | None = None,
            tree: Tree | None = None) -> DataFrame:
    """Columns ``keep`` (default: all) of each page with its main text.

    New columns: ``text string`` (main blocks in page order, joined by an empty
    line; empty if none) and ``n_chars long`` (its code points). One row for each
    input row, repeated rows too. A null or empty page has an empty text; a page
    cut off inside a tag, comment or script ends there. A head without end ends
    at the first text or tag of the body, any other silent tag without end at the
    next block or where its parent ends. Pages of any length are
    read whole. Input columns named like new ones give way.
    """
    tree = trained() if tree is None else tree

    def make():
        def compute(pages):
            return {"text": ["\n\n".join(main_blocks(p.decode("utf-8", "replace"), tree)) if p else ""
                             for p in pages]}
        return compute

    keep = pages.columns if keep is None else keep
    out = map_texts(pages, html_col, [c for c in keep if c.lower() != "n_chars"], "text string", make)
    return out.withColumn("n_chars", F.length("text").cast("long"))
