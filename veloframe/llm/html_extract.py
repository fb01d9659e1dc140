"""Main text of web pages by a tree-structured graphical model over the DOM.

A page's block elements form a tree. Each node is content or not; a potential
per node looks at its tag, attribute words and text, and a potential per
parent-child edge lets labels follow the tree. Messages up and down the tree
give each node's exact content marginal; weights are fitted by gradient
ascent of the likelihood of labelled pages (``html_training``).

Cases: a null or empty page has empty text; text outside any element counts
as the page's own; unclosed, stray and unknown tags are read as a browser
would; very long and very deep pages are read whole; equal pages give equal
texts; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field
from functools import lru_cache
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from veloframe.llm.common import sliced

# HTML's element kinds.
#: Entries of the cache of features by attribute words, which vary without bound over the web.
CACHED = 20_000
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup html iframe ins label legend li "
    "main menu nav noscript object ol optgroup option p pre search section select summary table tbody td template "
    "textarea tfoot th thead title tr ul".split())
SILENT = frozenset(("script", "style"))
SPACED = frozenset(("br", "hr", "wbr", "img", "input"))
CLOSES_P = BLOCKS - frozenset("button caption body head html ins label li dd dt legend object option optgroup "
                              "select tbody td textarea tfoot th thead title tr iframe noscript template".split())
#: Elements that end an open one of the same group, up to the nearest of the holders.
GROUPS = {"li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
          "tr": (("tr", "td", "th"), ("table", "tbody", "thead", "tfoot")),
          "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
          "option": (("option",), ("select",))}
HEAD_ONLY = frozenset(("title", "meta", "link", "base", "head", "script", "style", "html", "noscript", "template"))
MARKS = re.compile(r"[a-z]+")
LIMIT = 30.0


class Page(HTMLParser):
    """Block nodes of one page, parents first, and its runs of text in page order."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.tags, self.attrs, self.parents = ["#page"], [""], [-1]
        self.runs: list[list] = [[0, [], 0]]  # node, pieces, characters inside links
        self.open, self.links, self.silent = [0], 0, 0
        self.open_at: dict[str, list[int]] = {}  # places in ``open`` of each tag
        self.labels: list[str | None] = [None]
        self.feed(html)
        self.close()
        self.chars, self.linked = [0] * len(self.tags), [0] * len(self.tags)
        texts = []
        for node, pieces, linked in self.runs:
            if text := " ".join("".join(pieces).split()):
                texts.append((node, text))
                self.chars[node] += len(text)
                self.linked[node] += linked
        self.texts = texts

    def turn(self) -> None:
        self.runs.append([self.open[-1], [], 0])

    def pop_to(self, k: int) -> None:
        for node in self.open[k:]:
            self.open_at[self.tags[node]].pop()
        del self.open[k:]
        self.turn()

    def find(self, names: tuple[str, ...], holders: tuple[str, ...] = ()) -> int:
        """Place of the innermost open element of ``names`` with none of ``holders`` within it, or 0."""
        def last(tags: tuple[str, ...]) -> int:
            return max((self.open_at[t][-1] for t in tags if self.open_at.get(t)), default=0)

        place = last(names)
        return place if place > last(holders) else 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in SILENT:
            self.silent += 1
            return
        if tag == "a":
            self.links = 1
        if tag in SPACED:
            self.runs[-1][1].append(" ")
        if tag not in BLOCKS:
            return
        if tag not in HEAD_ONLY and (k := self.find(("head",))):
            self.pop_to(k)
        if tag in CLOSES_P and (k := self.find(("p",), ("button", "td", "th", "object"))):
            self.pop_to(k)
        if group := GROUPS.get(tag):
            while k := self.find(*group):
                self.pop_to(k)
        self.links = 0
        self.tags.append(tag)
        self.parents.append(self.open[-1])
        words = " ".join(v for n, v in attrs if v and n in ("class", "id", "role")) if attrs else ""
        self.attrs.append(words.lower())
        self.labels.append(next((v for n, v in attrs if n == "data-content"), None) if attrs else None)
        self.open.append(len(self.tags) - 1)
        self.open_at.setdefault(tag, []).append(len(self.open) - 1)
        self.turn()

    def handle_endtag(self, tag: str) -> None:
        if tag in SILENT:
            self.silent = 0
        elif tag == "a":
            self.links = 0
        elif tag in BLOCKS and (k := self.find((tag,))):
            self.links = 0
            self.pop_to(k)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag in SILENT:
            self.silent = 0

    def handle_data(self, data: str) -> None:
        if not self.silent:
            run = self.runs[-1]
            run[1].append(data)
            run[2] += len(data) * self.links


def features(page: Page, node: int) -> tuple[str, ...]:
    tag, words, n = page.tags[node], page.attrs[node], page.chars[node]
    size = 0 if not n else 1 if n < 20 else 2 if n < 60 else 3 if n < 160 else 4
    linked = page.linked[node] / n if n else 0.0
    density = 0 if linked < 0.1 else 1 if linked < 0.5 else 2
    return _features(tag, words, size, density)


@lru_cache(maxsize=CACHED)
def _features(tag: str, words: str, size: int, density: int) -> tuple[str, ...]:
    return ("bias", f"tag {tag}", f"size {size}", f"links {density}", f"tag {tag} links {density}", *(f"mark {w}" for w in set(MARKS.findall(words))))


def edge_kind(page: Page, node: int) -> int:
    """How a child starts: 0 plainly, 1 with attribute words or a sectioning tag, 2 below the page's own frame."""
    if page.tags[page.parents[node]] in ("#page", "html", "body"):
        return 2
    return int(bool(page.attrs[node]) or page.tags[node] in ("article", "aside", "footer", "form", "head", "header",
                                                            "main", "nav", "noscript", "section", "iframe", "ins"))


@dataclass
class Model:
    """Weights of node features, and log potentials edge[kind][parent label][child label]."""

    weights: dict[str, float] = field(default_factory=dict)
    edges: list[list[list[float]]] = field(default_factory=lambda: [[[0.0, 0.0], [0.0, 0.0]] for _ in range(3)])

    def infer(self, parents: list[int], nodes: list[tuple[str, ...]], kinds: list[int]
              ) -> tuple[list[float], list[tuple[float, float, float, float] | None]]:
        """Content log odds of each node, and the joint marginals of each edge to its parent."""
        get, n = self.weights.get, len(parents)
        up = [sum(get(f, 0.0) for f in fs) for fs in nodes]
        e = [[[math.exp(x) for x in row] for row in kind] for kind in self.edges]
        sent = [0.0] * n
        for i in range(n - 1, 0, -1):  # children before parents
            up[i] = max(-LIMIT, min(LIMIT, up[i]))
            (a, b), (c, d) = e[kinds[i]]
            o = math.exp(up[i])
            sent[i] = math.log((c + d * o) / (a + b * o))
            up[parents[i]] += sent[i]
        full, joint = up[:], [None] * n
        full[0] = max(-LIMIT, min(LIMIT, up[0]))
        for i in range(1, n):
            (a, b), (c, d) = e[kinds[i]]
            p = math.exp(max(-LIMIT, min(LIMIT, full[parents[i]] - sent[i])))
            o = math.exp(up[i])
            full[i] = max(-LIMIT, min(LIMIT, up[i] + math.log((b + d * p) / (a + c * p))))
            z = a + b * o + c * p + d * p * o
            joint[i] = (a / z, b * o / z, c * p / z, d * p * o / z)
        return full, joint

    def content(self, html: str) -> list[tuple[str, float]]:
        """(text, content log odds) of each text run in page order."""
        page = Page(html)
        every = range(len(page.tags))
        odds, _ = self.infer(page.parents, [features(page, i) for i in every], [edge_kind(page, i) for i in every])
        return [(text, odds[node]) for node, text in page.texts]

    def main_text(self, html: str) -> str:
        return " ".join(text for text, odds in self.content(html) if odds > 0)


def fit(pages: list[str], passes: int = 120, rate: float = 0.5, ridge: float = 2e-4) -> Model:
    """Fit on pages whose elements carry data-content="1" or "0"; without it, the parent's label holds."""
    data = []
    for html in pages:
        page = Page(html)
        labels = [1]
        for i in range(1, len(page.tags)):
            labels.append(labels[page.parents[i]] if page.labels[i] is None else int(page.labels[i] == "1"))
        every = range(len(page.tags))
        data.append((page.parents, [features(page, i) for i in every], [edge_kind(page, i) for i in every], labels))
    model, past_w, past_e = Model(), {}, {}
    count = sum(len(d[0]) for d in data)
    for _ in range(passes):
        up_w = {f: -ridge * count * w for f, w in model.weights.items()}
        up_e = {(k, a, b): -ridge * count * model.edges[k][a][b] for k in (0, 1, 2) for a in (0, 1) for b in (0, 1)}
        for parents, nodes, kinds, labels in data:
            odds, joint = model.infer(parents, nodes, kinds)
            for i, (y, o) in enumerate(zip(labels, odds, strict=True)):
                miss = y - 1 / (1 + math.exp(-o))
                for f in nodes[i]:
                    up_w[f] = up_w.get(f, 0.0) + miss
                if i:
                    for cell, p in enumerate(joint[i]):
                        a, b = divmod(cell, 2)
                        up_e[kinds[i], a, b] += (labels[parents[i]] == a and y == b) - p
        for f, g in up_w.items():
            past_w[f] = past_w.get(f, 1e-8) + g * g
            model.weights[f] = model.weights.get(f, 0.0) + rate * g / math.sqrt(past_w[f])
        for (k, a, b), g in up_e.items():
            past_e[k, a, b] = past_e.get((k, a, b), 1e-8) + g * g
            model.edges[k][a][b] += rate * g / math.sqrt(past_e[k, a, b])
    return model


def extracted(html: Column, model: Model) -> Column:
    """The main text of each page; empty where there is none."""

    @F.arrow_udf("string")
    def main(column: pa.Array) -> pa.Array:
        return sliced(lambda c: pa.array([model.main_text(x) if x else "" for x in c.to_pylist()], pa.string()),
                      pa.string(), column)

    return main(html)
