"""Main text of web pages by a tree-structured graphical model over the DOM."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import fresh

#: Pages of the table that the model is fitted on, beside the hand-labelled ones,
#: and the length up to which a page is taken for that.
SAMPLE = 64
SAMPLE_CHARS = 50_000
#: Passes over the labelled pages.
ROUNDS = 60
#: Marginal above which a block is content.
CUT = 0.5

# HTML elements by their role in the tree.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset("head script style noscript template title textarea select option iframe object svg canvas".split())
RAW = frozenset("noframes noembed xmp".split())
TEXT_ONLY = frozenset("script style title textarea iframe noscript".split())
IN_HEAD = frozenset("base basefont bgsound head link meta noframes noscript script style template title".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp "
                   "small span strike strong sub sup time tt u var wbr".split())
CLOSES_P = frozenset("address article aside blockquote details dialog dd div dl dt fieldset figcaption figure footer "
                     "form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre search section table ul".split())
ITEMS = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"),
         "th": ("tr", "table"), "option": ("select",)}
LEAVES = frozenset("p li h1 h2 h3 h4 h5 h6 td th tr dt dd figcaption blockquote pre table ul ol dl label".split())
CONTENT_MARKS = frozenset("article main".split())
OTHER_MARKS = frozenset("nav aside footer form header".split())


class Stack:
    """Names of open elements; whether one is open takes no search."""

    def __init__(self) -> None:
        self.names: list[str] = []
        self.times: Counter = Counter()

    def push(self, name: str) -> None:
        self.names.append(name)
        self.times[name] += 1

    def cut(self, name: str) -> bool:
        """Close the last ``name`` and what is open in it; False if none is open."""
        if not self.times[name]:
            return False
        while self.pop() != name:
            pass
        return True

    def pop(self) -> str:
        name = self.names.pop()
        self.times[name] -= 1
        return name

    def clear(self) -> None:
        self.names.clear()
        self.times.clear()


@dataclass
class Node:
    """An element, or (``tag`` = ``#text``) one block of running text."""
    tag: str
    parent: int
    hints: list[str] = field(default_factory=list)
    mark: str | None = None
    text: str = ""
    linked: int = 0
    chars: int = 0
    link_chars: int = 0
    content_chars: int = 0
    named: int = -1  # the nearest element with names, itself included, up to the landmark
    landmark: int = -1  # the nearest landmark, itself included


class Tree(HTMLParser):
    """The elements and text blocks of a page in page order; parents come first.

    ``marks``: whether ``data-y`` is read, for hand-labelled pages only.
    """

    def __init__(self, marks: bool = False) -> None:
        super().__init__(convert_charrefs=True)
        self.marks = marks
        self.nodes = [Node("#root", -1)]
        self.open = [0]
        self.tags: Counter = Counter()  # of the open elements
        self.inline, self.unseen = Stack(), Stack()
        self.passed = Stack()  # open elements below unseen ones
        self.run: list[str] = []
        self.run_linked = 0

    def end_run(self) -> None:
        text = " ".join("".join(self.run).split())
        if text:
            self.nodes.append(Node("#text", self.open[-1], text=text, linked=min(self.run_linked, len(text))))
        self.run, self.run_linked = [], 0

    def see(self) -> None:
        self.unseen.clear()
        self.passed.clear()

    def pop_to(self, tag: str, within: Iterable[str] = ()) -> None:
        """Close the nearest open ``tag``, unless an element of ``within`` is nearer."""
        if not self.tags[tag]:
            return
        for depth in range(len(self.open) - 1, 0, -1):
            name = self.nodes[self.open[depth]].tag
            if name == tag:
                self.end_run()
                self.tags.subtract(self.nodes[i].tag for i in self.open[depth:])
                del self.open[depth:]
                self.inline.clear()
                return
            if name in within:
                return

    def handle_starttag(self, tag, attrs):
        if self.unseen.names:
            if tag == "body" or (self.unseen.names == ["head"] and tag not in IN_HEAD):
                self.see()  # the end tag of head is optional
            else:
                if self.unseen.names[-1] == "option" and tag in ("option", "optgroup", "hr"):
                    self.unseen.pop()  # as is that of option
                if tag in UNSEEN | RAW and tag != "head":
                    self.unseen.push(tag)
                elif tag not in VOID:
                    self.passed.push(tag)
                return
        if tag in UNSEEN:
            self.unseen.push(tag)
            return
        if tag in INLINE:
            if tag == "br":
                self.run.append(" ")
            elif tag not in VOID:
                self.inline.push(tag)
            return
        if tag in CLOSES_P:
            self.pop_to("p", ("article", "section", "div", "td", "li", "body", "blockquote"))
        if tag in ITEMS:
            self.pop_to(tag, ITEMS[tag])
        self.end_run()
        self.inline.clear()
        if tag in VOID:
            return
        known = dict(attrs)
        names = " ".join(known.get(k) or "" for k in ("class", "id", "role", "aria-label", "itemprop"))
        hints = [w.lower() for w in re.findall(r"[A-Z]?[a-z]+|[A-Z]+", names)]
        self.nodes.append(Node(tag, self.open[-1], sorted(set(hints)), known.get("data-y") if self.marks else None))
        self.open.append(len(self.nodes) - 1)
        self.tags[tag] += 1

    def handle_startendtag(self, tag, attrs):
        if tag == "svg" or self.unseen.times["svg"]:
            return  # only there a slash closes an element
        if tag in TEXT_ONLY:  # all up to the end tag is its text
            self.handle_starttag(tag, attrs)
            if tag in self.CDATA_CONTENT_ELEMENTS:
                self.set_cdata_mode(tag)
        elif tag not in UNSEEN:
            self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if self.unseen.names:
            if self.unseen.cut(tag):
                if not self.unseen.names:
                    self.see()
                return
            if self.passed.cut(tag):
                return
            if self.unseen.names[0] != "option" or not self.tags[tag]:
                return
            self.see()  # an option ends with its parent
        if tag in INLINE:
            self.inline.cut(tag)
        else:
            self.pop_to(tag)

    def handle_data(self, data):
        if self.unseen.names == ["head"] and data.strip():
            self.see()
        if not self.unseen.names:
            self.run.append(data)
            if self.inline.times["a"]:
                self.run_linked += len(data.strip())


def tree(html: str | None, marks: bool = False) -> list[Node]:
    """Nodes of a page with the text and link lengths below each, and the nearest names and
    landmark above; in one pass down and one up, however deep the page is."""
    parser = Tree(marks)
    parser.feed(html or "")
    parser.close()
    parser.end_run()
    for i, n in enumerate(parser.nodes[1:], 1):
        up = parser.nodes[n.parent]
        is_mark = n.tag in CONTENT_MARKS or n.tag in OTHER_MARKS
        n.landmark = i if is_mark else up.landmark
        n.named = i if n.hints else -1 if is_mark else up.named
    for n in reversed(parser.nodes):
        if n.tag == "#text":
            n.chars, n.link_chars = len(n.text), n.linked
        if n.parent >= 0:
            up = parser.nodes[n.parent]
            up.chars += n.chars
            up.link_chars += n.link_chars
    return parser.nodes


def features(n: Node, nodes: list[Node]) -> list[str]:
    """What a node shows: element, names, length, share of links, sentences."""
    links = n.link_chars / n.chars if n.chars else 0.0
    out = [f"tag {n.tag}", f"links {min(3, math.ceil(links * 3))}"]
    out += [f"name {h}" for h in n.hints]
    if n.tag == "#text":
        size = len(n.text)
        out.append(f"size {sum(size >= s for s in (15, 40, 100, 250))}")
        out.append(f"sentence {n.text[-1] in '.!?…'}")
        out.append(f"in {nodes[n.parent].tag}")
        if n.named >= 0:
            out += [f"below name {h}" for h in nodes[n.named].hints]
        if n.landmark >= 0:
            out.append(f"below {nodes[n.landmark].tag}")
    else:
        out.append(f"chars {sum(n.chars >= s for s in (1, 60, 300, 1500))}")
    return out


def labelled(nodes: list[Node]) -> list[int]:
    """1 for content. A text block takes the nearest ``data-y`` above it (read on hand-labelled
    pages only); on pages without, that of the nearest landmark (article or main: content; nav, aside,
    header, footer, form and what lies outside: not). An element is content if
    half of its text is."""
    marked = any(n.mark is not None for n in nodes)
    state, out = [0] * len(nodes), [0] * len(nodes)
    for i, n in enumerate(nodes):
        if i:
            state[i] = state[n.parent]
        if marked:
            state[i] = int(n.mark) if n.mark is not None else state[i]
        elif n.tag in CONTENT_MARKS:
            state[i] = 1
        elif n.tag in OTHER_MARKS:
            state[i] = 0
        n.content_chars = n.chars * state[i] if n.tag == "#text" else 0
    for n in reversed(nodes):
        if n.parent >= 0:
            nodes[n.parent].content_chars += n.content_chars
    for i, n in enumerate(nodes):
        out[i] = int(2 * n.content_chars >= n.chars) if n.chars else state[i]
    return out


@dataclass
class Model:
    """Log potentials: ``unary`` of each feature for content, ``edge`` of (parent,
    child) states by the child's kind."""
    unary: dict[str, float]
    edge: dict[str, list[list[float]]]


def kind(n: Node) -> str:
    return "text" if n.tag == "#text" else "leaf" if n.tag in LEAVES else "element"


def log_sum(a: float, b: float) -> float:
    return max(a, b) + math.log1p(math.exp(-abs(a - b)))


def infer(nodes: list[Node], feats: list[list[str]], model: Model) -> tuple[list[float], list[list[list[float]]]]:
    """Probability of content of every node and of the states of every (parent,
    child), by sum-product: messages from the leaves to the root and back."""
    local = [[0.0, sum(model.unary.get(f, 0.0) for f in fs)] for fs in feats]
    edges = [model.edge[kind(n)] for n in nodes]
    up = [[0.0, 0.0] for _ in nodes]
    for i in range(len(nodes) - 1, 0, -1):
        e, own = edges[i], local[i]
        up[i] = [log_sum(e[0][0] + own[0], e[0][1] + own[1]), log_sum(e[1][0] + own[0], e[1][1] + own[1])]
        above = local[nodes[i].parent]
        above[0] += up[i][0]
        above[1] += up[i][1]
    out, pairs, belief = [0.0] * len(nodes), [[[0.0, 0.0], [0.0, 0.0]]] * len(nodes), [[0.0, 0.0]] * len(nodes)
    for i, n in enumerate(nodes):
        own = local[i]  # own evidence and all messages from below
        if i:
            b, e = belief[n.parent], edges[i]
            pair = [[b[p] - up[i][p] + e[p][y] + own[y] for y in (0, 1)] for p in (0, 1)]
            total = log_sum(log_sum(*pair[0]), log_sum(*pair[1]))
            pairs[i] = [[math.exp(pair[p][y] - total) for y in (0, 1)] for p in (0, 1)]
            own = [log_sum(pair[0][y], pair[1][y]) for y in (0, 1)]
        low = max(own)
        belief[i] = own = [x - low for x in own]
        out[i] = 1.0 / (1.0 + math.exp(min(700.0, own[0] - own[1])))
    return out, pairs


def marginals(nodes: list[Node], model: Model) -> list[float]:
    return infer(nodes, [features(n, nodes) for n in nodes], model)[0]


def train(pages: Iterable[str], rounds: int = ROUNDS, decay: float = 0.02) -> Model:
    """Potentials of the greatest likelihood of the pages' labels: in each round
    they move by the observed less the expected counts of what they weigh."""
    from tidemark.llm.labelled_pages import PAGES
    ours, read = frozenset(PAGES), []
    for html in pages:
        nodes = tree(html, marks=html in ours)
        read.append((nodes, [features(n, nodes) for n in nodes], labelled(nodes)))
    model = Model({}, {k: [[0.5, -0.5], [-0.5, 0.5]] for k in ("text", "leaf", "element")})
    moved: Counter = Counter()
    for _ in range(rounds):
        step: Counter = Counter()
        for nodes, feats, labels in read:
            content, pairs = infer(nodes, feats, model)
            for i, y in enumerate(labels):
                for f in feats[i]:
                    step[f] += y - content[i]
                if i:
                    for p in (0, 1):
                        for q in (0, 1):
                            seen = (labels[nodes[i].parent], y) == (p, q)
                            step[kind(nodes[i]), p, q] += seen - pairs[i][p][q]
        for name, g in step.items():
            k = isinstance(name, tuple)
            row, at = (model.edge[name[0]][name[1]], name[2]) if k else (model.unary, name)
            now = row[at] if k else row.get(at, 0.0)
            g -= decay * now
            moved[name] += g * g
            row[at] = now + 0.3 * g / math.sqrt(moved[name] + 1e-9)
    return model


def extract(html: str | None, model: Model) -> str:
    """The content blocks in page order, one to a line (no content: empty)."""
    nodes = tree(html)
    return "\n".join(n.text for n, p in zip(nodes, marginals(nodes, model)) if n.tag == "#text" and p > CUT)


def fit(pages: DataFrame, html_col: str = "html", sample: int = SAMPLE) -> Model:
    """A model from the hand-labelled pages and from at most ``sample`` pages of
    the table (by hash of the page, copies once) that mark their article themselves."""
    html = F.col(html_col)
    own = pages.where(html.rlike("(?i)<(article|main)[ >]") & (F.length(html) <= SAMPLE_CHARS))
    own = own.select(html.alias("h"), F.xxhash64(html).alias("k"))
    keys = [r["k"] for r in own.select("k").distinct().orderBy("k").limit(sample).collect()]  # keys only from every task
    rows = own.where(F.col("k") <= max(keys)).groupBy("k").agg(F.min("h").alias("h")).orderBy("k").collect() if keys else []
    from tidemark.llm.labelled_pages import PAGES
    return train([*PAGES * 2, *(r["h"] for r in rows)])


def main_text(pages: DataFrame, model: Model, html_col: str = "html", out: str = "text") -> DataFrame:
    """``pages`` with the main text of ``html_col`` in ``out``.

    Character references are decoded; white space within a block is one space;
    blocks are joined by one line feed. Defined cases: null or empty html, or a
    page without content: empty text; broken and cut-off markup is read as far
    as it goes; pages of any length are read whole; repeated rows agree; extra
    columns are kept, one called ``out`` is replaced.
    """
    @F.pandas_udf("string")
    def texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([extract(h, model) for h in batch], dtype=object)

    found, = fresh(pages, "found")
    kept = [F.col(c) for c in pages.columns if c.lower() != out.lower()]
    return pages.withColumn(found, texts(F.col(html_col))).select(*kept, F.col(found).alias(out))
