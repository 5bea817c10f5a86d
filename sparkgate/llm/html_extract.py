"""Main text of web pages by a tree-structured graphical model.

Method: the block elements of a page are the variables (main text or not) of a tree whose
edges are those of the DOM. Node potentials come from what a block looks like (tag, words in
its class and id, share of link text, length), parent-child potentials from how labels follow
each other down the tree; both are smoothed counts over labelled pages (``train``). Messages
go up and then down the tree (sum-product), which gives each block its exact marginal, and the
text of the blocks that are more likely main text than not is kept.

Each page is one row and its work is proportional to its length; there is no shuffle.

Text: character references decoded, white space inside a block one space, trimmed, blocks in
page order joined by one space. Scripts, styles, templates, the head and comments have no text.
An end tag ends the innermost open element of its name, however many were opened since;
self-closed elements of svg and math content and self-closed custom elements end at once.

Nulls, ties and odd rows: a null or empty page has the empty text; null ids and urls stay
null; every input row gives one output row, repeated rows included; a marginal of exactly one
half is not main text; markup that breaks off or nests thousands deep is read as far as it
goes, without recursion; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkgate.llm.common import map_rows, slices

INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img input ins kbd mark "
                   "nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("head script style template noscript iframe object svg math select textarea button "
                   "title".split())
IN_HEAD = frozenset("title meta link script style base noscript template".split())
#: Open elements that a start tag ends, up to the element that holds them.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "option": ({"option"}, {"select", "optgroup", "datalist"}), "optgroup": ({"optgroup"}, {"select"}),
        "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}
#: Elements with content of their own, in which only tags of ``KNOWN_TAGS`` end a paragraph.
FOREIGN = ("svg", "math")
KNOWN_TAGS = frozenset("html body nav ul ol li div p h1 h2 h3 h4 article main section aside header footer form "
                       "table tr td blockquote pre dl dt dd figure figcaption label".split())
#: Tags that say what they hold.
TELLING = {"nav": "beside", "aside": "beside", "footer": "beside", "form": "beside", "article": "main",
           "main": "main"}
#: Words of classes and ids that often stand on blocks beside the main text, and on it.
BESIDE = re.compile(r"(^|[-_ ])(ads?|advert\w*|banner|bio|breadcrumbs?|card|comments?|cookies?|copyright|discussion|"
                    r"disqus|footer|header|legal|logo|menu|modal|nav\w*|newsletter|notice|alert|pag(ination|er)|popup|"
                    r"promo\w*|recommend\w*|related|repl(y|ies)|respond|share|sidebar|social|sponsor\w*|subscri\w*|tags|"
                    r"terms|toolbar|widget|consent|search|login)($|[-_ ])", re.I)
MAIN = re.compile(r"(^|[-_ ])(article|body|content|entry|main|post|story|text)($|[-_ ])", re.I)
SPACES = re.compile(r"\s+")


@dataclass
class Page:
    """The blocks of a page, parents before children, and its text in page order."""

    parent: list[int] = field(default_factory=lambda: [-1])
    tag: list[str] = field(default_factory=lambda: ["#page"])
    names: list[str] = field(default_factory=lambda: [""])
    label: list[int | None] = field(default_factory=lambda: [None])
    chars: list[int] = field(default_factory=lambda: [0])
    linked: list[int] = field(default_factory=lambda: [0])
    texts: list[tuple[int, list[str]]] = field(default_factory=list)


class Reader(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.page = Page()
        self.open: list[tuple[str, int]] = [("#page", 0)]   # tag and block of open elements
        self.places: dict[str, list[int]] = {}   # of open elements by tag, outermost first
        self.hidden = 0
        self.link = self.fresh = False

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "br":
            self.handle_data(" ")
        if tag in INLINE:
            self.link = self.link or tag == "a"
            return
        if tag in VOID:
            self.fresh = True
            return
        if tag not in IN_HEAD and len(self.open) > 1 and self.places.get("head"):
            self._end("head")
        if tag not in HIDDEN:
            if tag == "optgroup":
                self._end("option", "select", "optgroup")
            elif tag != "option" and (tag in KNOWN_TAGS or not self._foreign()):
                self._end("p", "td", "th", "li", "dd", "div", "section", "article", "table")
            closed, within = ENDS.get(tag, ((), ()))
            if closed:
                self._end_any(closed, within)
        page, values = self.page, dict(attrs)
        page.parent.append(self.open[-1][1])
        page.tag.append(tag)
        page.names.append(" ".join(v for k in ("class", "id", "role") if (v := values.get(k))))
        mark = values.get("data-content")
        page.label.append(int(mark) if mark in ("0", "1") else None)
        page.chars.append(0)
        page.linked.append(0)
        self.places.setdefault(tag, []).append(len(self.open))
        self.open.append((tag, len(page.tag) - 1))
        self.hidden += tag in HIDDEN
        self.fresh = True

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag in FOREIGN or "-" in tag or self._foreign():
            self.handle_endtag(tag)

    def _foreign(self) -> bool:
        return any(self.places.get(t) for t in FOREIGN)

    def handle_endtag(self, tag: str) -> None:
        if tag == "a":
            self.link = False
        if tag not in INLINE and tag not in ("body", "html"):
            self._end(tag)
            self.fresh = True

    def _end(self, tag: str, *within: str) -> None:
        self._end_any((tag,), within)

    def _end_any(self, tags, within) -> None:
        """End the innermost open element of ``tags``, unless one of ``within`` is inside it."""
        last = lambda names: max((at[-1] for t in names if (at := self.places.get(t))), default=0)
        i = last(tags)
        if i and i >= last(within):
            for name, _ in self.open[i:]:
                self.places[name].pop()
                self.hidden -= name in HIDDEN
            del self.open[i:]
            self.link = False

    def handle_data(self, data: str) -> None:
        if self.hidden:
            return
        block = self.open[-1][1]
        page = self.page
        if self.fresh or not page.texts or page.texts[-1][0] != block:
            page.texts.append((block, []))
            self.fresh = False
        page.texts[-1][1].append(data)
        n = len(data.strip())
        page.chars[block] += n
        if self.link:
            page.linked[block] += n


def read(html: str) -> Page:
    reader = Reader()
    reader.feed(html)
    reader.close()
    return reader.page


def looks(page: Page) -> list[tuple]:
    """What each block looks like: tag, names, the nearest telling tag or name around it, link
    share of all it holds, own length."""
    all_chars, all_linked = page.chars[:], page.linked[:]
    for v in range(len(page.tag) - 1, 0, -1):
        all_chars[page.parent[v]] += all_chars[v]
        all_linked[page.parent[v]] += all_linked[v]
    out, around = [], []
    for v, tag in enumerate(page.tag):
        names = page.names[v]
        name = "-" if not names else "beside" if BESIDE.search(names) else "main" if MAIN.search(names) else "other"
        n, own = all_chars[v], page.chars[v]
        share = "none" if not n else min(3, 4 * all_linked[v] // n)
        length = 0 if not own else 1 if own < 25 else 2 if own < 120 else 3
        outer = around[page.parent[v]] if v else "-"
        around.append(name if name in ("beside", "main") else TELLING.get(tag, outer))
        out.append((tag if tag in KNOWN_TAGS else "other", name, outer, share, length))
    return out


class Model:
    """Log odds of the potentials: node features, child given parent, and the root."""

    def __init__(self, pages: list[str]):
        seen = [[Counter(), Counter()] for _ in range(5)]
        n, follow = [0, 0], [[1, 1], [1, 1]]
        for html in pages:
            page = read(html)
            state = [0] * len(page.tag)
            for v, look in enumerate(looks(page)):
                up = page.parent[v]
                state[v] = page.label[v] if page.label[v] is not None else state[up] if v else 0
                if v:
                    follow[state[up]][state[v]] += 1
                    n[state[v]] += 1
                    for f, value in enumerate(look):
                        seen[f][state[v]][value] += 1
        self.weights = [
            {x: math.log((c[1][x] + 0.5) / (n[1] + 1)) - math.log((c[0][x] + 0.5) / (n[0] + 1))
             for x in c[0] | c[1]} for c in seen]
        self.follow = [[x / sum(row) for x in row] for row in follow]
        self.root = -1.0

    def beliefs(self, page: Page) -> list[float]:
        """Log odds of each block's marginal, by messages up and down the tree."""
        (p00, p01), (p10, p11) = self.follow
        w, exp, log = self.weights, math.exp, math.log
        near = lambda x: -30.0 if x < -30 else 30.0 if x > 30 else x
        up = [sum(w[f].get(x, 0.0) for f, x in enumerate(look)) for look in looks(page)]
        up[0] = self.root
        sent = [0.0] * len(up)
        for v in range(len(up) - 1, 0, -1):
            q = exp(near(up[v]))
            sent[v] = log((p10 + p11 * q) / (p00 + p01 * q))
            up[page.parent[v]] += sent[v]
        for v in range(1, len(up)):   # a parent's belief is whole before its children's
            c = exp(near(up[page.parent[v]] - sent[v]))
            up[v] += log((p01 + p11 * c) / (p00 + p10 * c))
        return up

    def main_text(self, html: str) -> str:
        page = read(html)
        odds = self.beliefs(page)
        blocks = (SPACES.sub(" ", "".join(parts)).strip() for v, parts in page.texts if odds[v] > 0)
        return " ".join(b for b in blocks if b)


def train(pages: list[str] | None = None) -> Model:
    """A model from labelled pages (by default those of ``html_training``)."""
    if pages is None:
        from sparkgate.llm.html_training import PAGES
        pages = PAGES
    return Model(pages)


def extract(pages: DataFrame, model: Model, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` of every whole page."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in slices(frames, "html"):
            texts = [model.main_text(h) for h in frame["html"]]
            yield pd.DataFrame({"page_id": frame["page_id"].to_numpy(), "url": frame["url"].to_numpy(),
                                "text": texts, "n_chars": np.array([len(t) for t in texts], np.int64)})
    rows = pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).alias("url"),
                        F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    return map_rows(rows, run, "page_id bigint, url string, text string, n_chars bigint")
