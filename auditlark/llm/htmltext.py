"""Main text of web pages by a tree-structured graphical model over their elements.

Every element of a page is a node with two states, content or not. Unary potentials come from its tag, the words of its class,
id and role, and the amount, link share and punctuation of its text; pair potentials connect each parent and child. One
sum-product pass up and one down the tree give the exact probability of each element; the text whose element
is content with a probability of at least ``cut`` is kept.

The model is fitted on a bounded sample of labelled pages: those that mark their content by ``<article>``,
``<main>`` or ``role="main"``; what lies inside and in none of the boilerplate elements is content. The unary
weights shrink towards a prior that knows common names of boilerplate, so that names the sample lacks keep a meaning.

A block is the text between two block-level tags: character references decoded, white space (and ``<br>``) turned into one space, trimmed.
A null, empty or textless page gives an empty text. Broken markup is read as browsers do: missing end tags are implied, an
end tag without start is ignored, a page may stop anywhere. Rows that share an id are extracted each by itself; other columns are kept.
"""

from __future__ import annotations

import dataclasses
import html.parser
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from auditlark.llm.batches import with_text
from auditlark.llm.samples import uniform

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("script style head title noscript template svg iframe object select option textarea".split())
INLINE = frozenset("a abbr b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
CLOSES_ITSELF = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}
CONTENT_WORDS = frozenset("article content main post entry story text".split())
BOILERPLATE_WORDS = frozenset(
    "ad ads advert advertisement aside banner breadcrumb comment comments consent cookie disqus footer form header login menu modal nav navbar navigation "
    "newsletter notice pager pagination popup promo recommended related search share sharing sidebar social sponsor sponsored subscribe toolbar widget".split())
BOILERPLATE_TAGS = frozenset("nav header footer aside form menu dialog button fieldset".split())
NAME = re.compile(r"[a-z]+")
BLANKS = re.compile(r"\s+")


class Page(html.parser.HTMLParser):
    """Elements in page order (parents first) and the blocks of text with the element of each piece."""

    def __init__(self, markup: str | None):
        super().__init__(convert_charrefs=True)
        self.tags, self.names, self.parents = ["#page"], [()], [-1]
        self.open, self.silent = [0], 0
        self.blocks: list[list[tuple[int, str]]] = [[]]
        self.feed(markup or "")
        self.close()
        self.blocks = [b for b in self.blocks if any(not t.isspace() for _, t in b)]

    def _break(self) -> None:
        if self.blocks[-1]:
            self.blocks.append([])

    def _pop(self, depth: int) -> None:
        """Close the open elements from ``depth`` on."""
        for at in self.open[depth:]:
            self.silent -= self.tags[at] in SILENT
        del self.open[depth:]

    def _close_to(self, tag: str, walls: frozenset | set) -> None:
        for depth in range(len(self.open) - 1, 0, -1):
            name = self.tags[self.open[depth]]
            if name == tag:
                return self._pop(depth)
            if name in walls:
                return None
        return None

    def handle_starttag(self, tag, attrs):
        if tag not in INLINE:
            self._break()
            if tag in CLOSES_ITSELF:
                self._close_to(tag, CLOSES_ITSELF[tag])
            elif tag not in SILENT:
                self._close_to("p", {"table", "td", "th", "button", "object"})
        elif tag == "br" and self.blocks[-1]:
            self.blocks[-1].append((self.open[-1], " "))
        if tag in VOID:
            return
        names = {w for k, v in attrs if k in ("class", "id", "role") and v for w in NAME.findall(v.lower())}
        self.tags.append(tag)
        self.names.append(tuple(sorted(names)))
        self.parents.append(self.open[-1])
        self.open.append(len(self.tags) - 1)
        self.silent += tag in SILENT

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag not in INLINE:
            self._break()
        if tag not in VOID:
            self._close_to(tag, set())

    def handle_data(self, data):
        if not self.silent:
            self.blocks[-1].append((self.open[-1], data))

    def barred(self) -> list[bool]:
        """Whether an element is boilerplate by its tag or names, or lies in such a one; a header of the content itself is none."""
        out, inside = [False] * len(self.tags), [False] * len(self.tags)
        for at in range(1, len(self.tags)):
            tag, names, up = self.tags[at], set(self.names[at]), self.parents[at]
            inside[at] = inside[up] or tag in ("article", "main")
            own = {"header"} if inside[up] or names & CONTENT_WORDS else set()
            out[at] = out[up] or tag in BOILERPLATE_TAGS - own or tag in SILENT or bool(names & (BOILERPLATE_WORDS - own))
        return out

    def statistics(self) -> list[tuple[int, int, int]]:
        """Per element the characters, those inside links, and the sentence marks of all text below it."""
        n = len(self.tags)
        total, linked, marks = [0] * n, [0] * n, [0] * n
        inside = [False] * n
        for at in range(1, n):
            inside[at] = self.tags[at] == "a" or inside[self.parents[at]]
        for block in self.blocks:
            for at, text in block:
                size = len(text)
                total[at] += size
                marks[at] += text.count(".") + text.count(",")
                if inside[at]:
                    linked[at] += size
        for at in range(n - 1, 0, -1):
            up = self.parents[at]
            total[up] += total[at]
            linked[up] += linked[at]
            marks[up] += marks[at]
        return list(zip(total, linked, marks))


def features(tag: str, names: tuple[str, ...], barred: bool, total: int, linked: int, marks: int) -> list[str]:
    found = ["bias", f"tag={tag}", f"size={min(12, total.bit_length())}"]
    found.extend(f"name={w}" for w in names)
    if barred:
        found.append("within=boilerplate")
    if total:
        found.append(f"links={4 * linked // total}")
        found.append(f"marks={min(4, 100 * marks // total)}")
    return found


def prior(feature: str) -> float:
    kind, _, value = feature.partition("=")
    if kind == "tag":
        return -3.0 if value in BOILERPLATE_TAGS else 3.0 if value in ("article", "main") else 0.0
    if kind == "name":
        return -4.0 if value in BOILERPLATE_WORDS else 2.0 if value in CONTENT_WORDS else 0.0
    if kind == "within":
        return -8.0
    return -0.5 if kind == "links" and value != "0" else 0.0


@dataclasses.dataclass
class Model:
    weights: dict[str, float]
    pair: tuple[float, float, float, float]   # potentials of (parent, child) states 00, 01, 10, 11
    known: dict = dataclasses.field(default_factory=dict)

    def unary(self, page: Page) -> list[float]:
        known, out = self.known, []
        for tag, names, barred, (total, linked, marks) in zip(page.tags, page.names, page.barred(), page.statistics()):
            key = (tag, names, barred, total.bit_length(), 4 * linked // total if total else -1, min(4, 100 * marks // total) if total else -1)
            z = known.get(key)
            if z is None:
                if len(known) > 200_000:
                    known.clear()
                z = known[key] = sum(self.weights.get(f, prior(f)) for f in features(tag, names, barred, total, linked, marks))
            out.append(z)
        return out

    def marginals(self, page: Page) -> list[float]:
        """Log-odds of content of every element: messages from the leaves to the root, then back."""
        p00, p01, p10, p11 = self.pair
        up, n = self.unary(page), len(page.tags)
        to_parent = [0.0] * n
        for at in range(n - 1, 0, -1):
            e = math.exp(max(-500.0, min(500.0, up[at])))
            to_parent[at] = math.log((p10 + p11 * e) / (p00 + p01 * e))
            up[page.parents[at]] += to_parent[at]
        for at in range(1, n):  # parents come first, so up[parent] is already its full belief
            e = math.exp(max(-500.0, min(500.0, up[page.parents[at]] - to_parent[at])))
            up[at] += math.log((p01 + p11 * e) / (p00 + p10 * e))
        return up


def labels(page: Page) -> list[int] | None:
    """Content or not per element of a page that marks its content itself; None for others."""
    roots = {at for at, (t, names) in enumerate(zip(page.tags, page.names)) if t in ("article", "main")}
    if not roots:
        return None
    state, barred = [0] * len(page.tags), page.barred()
    for at in range(1, len(page.tags)):
        state[at] = int(not barred[at] and (at in roots or state[page.parents[at]] == 1))
    return state


def train(pages: list[Page], strength: float = 0.02, rounds: int = 300, rate: float = 0.5) -> Model:
    """Unary weights by logistic regression around the prior, pair potentials from the labels' transitions."""
    rows: Counter = Counter()
    moves = np.ones(4)
    for page in pages:
        state = labels(page)
        if state is None:
            continue
        for at, (tag, names, barred, stats) in enumerate(zip(page.tags, page.names, page.barred(), page.statistics())):
            rows[tuple(features(tag, names, barred, *stats)), state[at]] += 1
            if at:
                moves[2 * state[page.parents[at]] + state[at]] += 1
    numbers: dict[str, int] = {}
    members, row_of, y, n = [], [], [], []
    for (found, state), count in sorted(rows.items()):
        row_of.extend([len(y)] * len(found))
        members.extend(numbers.setdefault(f, len(numbers)) for f in found)
        y.append(state)
        n.append(count)
    members, row_of, y, n = np.array(members, "i8"), np.array(row_of, "i8"), np.array(y, "f8"), np.array(n, "f8")
    centre = np.array([prior(f) for f in numbers])
    w, m, v = centre.copy(), np.zeros(len(numbers)), np.zeros(len(numbers))
    for step in range(1, rounds + 1 if len(y) else 1):
        z = np.bincount(row_of, w[members], len(y))
        miss = (0.5 * (1 + np.tanh(z / 2)) - y) * n / n.sum()
        g = np.bincount(members, miss[row_of], len(w)) + strength / len(w) * (w - centre)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= rate / math.sqrt(step) * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-5)
    given = moves.reshape(2, 2) / moves.reshape(2, 2).sum(1, keepdims=True)
    given = 0.9 * given + 0.1 * np.array([[0.8, 0.2], [0.2, 0.8]])  # the sample may lack a kind of nesting, pages at large do not
    share = moves.reshape(2, 2).sum(0) / moves.sum()
    pair = given / share
    return Model(dict(zip(numbers, w.tolist())), tuple(pair.reshape(-1).tolist()))


def fit(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", sample: int = 400, max_chars: int = 200_000, seed: int = 5) -> Model:
    """Fit on about ``sample`` of the pages with at most ``max_chars`` characters that mark their content."""
    markup = F.col(html_col).cast("string")
    marked = pages.select(F.col(id_col).alias("id"), markup.alias("html")).where((F.length("html") <= max_chars) & F.lower("html").rlike("<(article|main)[ >]"))
    n = marked.count()
    drawn = marked.where(uniform("id", seed) < min(1.0, sample / n)).limit(2 * sample).toArrow().to_pylist() if n else []
    return train([Page(r["html"]) for r in sorted(drawn, key=lambda r: (str(r["id"]), r["html"]))])


def main_blocks(model: Model, markup: str | None, cut: float = 0.5) -> list[str]:
    page = Page(markup)
    if not page.blocks:
        return []
    belief, least = model.marginals(page), math.log(cut / (1 - cut))
    texts = (BLANKS.sub(" ", "".join(t for at, t in block if belief[at] >= least)).strip() for block in page.blocks)
    return [t for t in texts if t]


def extract(pages: DataFrame, model: Model, html_col: str = "html", cut: float = 0.5) -> DataFrame:
    """All columns of ``pages`` with ``text`` and its code points ``n_chars``; existing columns of these names are replaced."""
    shared = pages.sparkSession.sparkContext.broadcast(model)  # one weight per name seen in the sample
    others = [c for c in pages.columns if c not in ("text", "n_chars")]
    rows, at = with_text(pages, others, html_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            texts = ["\n".join(main_blocks(m, markup.as_py(), cut)) for markup in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(others)], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                             names=[*others, "text", "n_chars"])

    schema = T.StructType([*(pages.schema[c] for c in others), T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    return rows.mapInArrow(run, schema)
