"""Main text of HTML pages by a tree-structured graphical model over the DOM.

Each node (element or text) has a hidden part: ``m`` holding several parts, ``c`` article, ``b`` anything
else.  Potentials between parent and child, and of a part for a node's features (tag, names in class, id
and role, length, share of link text, end of sentence), are counted from labelled pages.  Sum-product
messages go up and down the tree; texts whose marginal for ``c`` is largest are kept.  Blocks are those of
block elements, white space inside one becomes a single space, blocks are joined by one newline.

Defined results: a null, empty or text-free page has the empty string; repeated rows are treated row by
row; an empty table gives no rows; unclosed elements end where HTML ends them.  Results replace input
columns of the same name.
"""

from __future__ import annotations

import functools
import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.labelled_pages import labelled_pages

PARTS = "mcb"
# Elements of HTML by their kind.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("script style noscript template iframe svg object head title canvas audio video map math".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong "
                   "sub sup time tt u var wbr input button select textarea option".split())
HEAD = frozenset("base basefont bgsound link meta title noframes style script noscript template".split())
SCOPE = frozenset("table td th caption button html body".split())
ENDED_BY = {"li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr", "td", "th"]),
            "td": frozenset(["td", "th"]), "th": frozenset(["td", "th"]), "option": frozenset(["option"])}
LISTS = frozenset("ul ol dl table select".split())


class Page(HTMLParser):
    """The tree: ``tag``, ``parent``, ``names`` and ``label`` of each node; ``order``: text nodes, None at block ends."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.tag, self.parent, self.names, self.label = ["#root"], [-1], [()], ["m"]
        self.text: dict[int, str] = {}
        self.order: list[int | None] = []
        self.stack, self.hidden = [0], 0
        self.depths: defaultdict[str, list[int]] = defaultdict(list)  # of the open elements of each tag
        self.feed(html)
        self.close()

    def _node(self, tag: str, names: tuple = (), label: str | None = None) -> int:
        up = self.stack[-1]
        self.tag.append(tag)
        self.parent.append(up)
        self.names.append(names)
        self.label.append(label or self.label[up])
        return len(self.tag) - 1

    def _pop(self, depth: int) -> None:
        while len(self.stack) > depth:
            tag = self.tag[self.stack.pop()]
            self.depths[tag].pop()
            self.hidden -= tag in HIDDEN
            if tag not in INLINE:
                self.order.append(None)

    def _open(self, tags: frozenset, ends: frozenset) -> int | None:
        """Depth of the innermost open element of ``tags``, unless one of ``ends`` is inside of it."""
        found, end = (max((self.depths[t][-1] for t in some if self.depths[t]), default=0) for some in (tags, ends))
        return found if found and found >= end else None

    def _in_head(self) -> bool:
        return self.tag[self.stack[-1]] == "head"

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "head" and len(self.tag) > (2 if self.tag[1:2] == ["html"] else 1) or tag == "html" and self._in_head():
            return  # too late for a head
        if tag == "body" and (depth := self._open(frozenset(["head"]), frozenset(["template"]))) is not None:
            self._pop(depth)
        elif self._in_head() and tag not in HEAD:  # the head's end tag is optional
            self._pop(len(self.stack) - 1)
        if tag not in INLINE:
            if (depth := self._open(frozenset(["p"]), SCOPE)) is not None:
                self._pop(depth)
            self.order.append(None)
        if tag in ENDED_BY and (depth := self._open(ENDED_BY[tag], LISTS)) is not None:
            self._pop(depth)
        a = dict(attrs)
        if tag in VOID:
            if tag == "br" and not self.hidden:
                self.handle_data(" ")
            return
        names = tuple(re.findall(r"[a-z]+", " ".join(a.get(k) or "" for k in ("class", "id", "role")).lower()))
        self.depths[tag].append(len(self.stack))
        self.stack.append(self._node(tag, names, a.get("y")))
        self.hidden += tag in HIDDEN

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)  # only void elements can end themselves

    def handle_endtag(self, tag: str) -> None:
        if tag == "br":
            self.handle_starttag(tag, [])
        elif (depth := self._open(frozenset([tag]), frozenset(["td", "th"]) if tag in INLINE or tag == "p" else frozenset())) is not None:
            self._pop(depth)

    def handle_data(self, data: str) -> None:
        if self._in_head() and data.strip():
            self._pop(len(self.stack) - 1)
        if self.hidden or not data:
            return
        if not data.strip():
            if self.order and self.order[-1] is not None:  # white space between words of a block
                self.text[self.order[-1]] += " "
            return
        n = self._node("#text")
        self.text[n] = data
        self.order.append(n)

    def tree(self) -> list[tuple[int, int, tuple]]:
        """(node, parent, features) of the nodes of the model, parents first.

        An unnamed element that only wraps another one has its parent's part and is left out.
        """
        n = len(self.tag)
        chars, linked, ends, inside = [0] * n, [0] * n, [0] * n, [0] * n
        for k, t in self.text.items():
            t = t.strip()
            chars[k], ends[k] = len(t), t[-1:] in ".!?…。"
        for k in range(n - 1, 0, -1):
            up = self.parent[k]
            chars[up] += chars[k]
            linked[up] += chars[k] if self.tag[k] == "a" else linked[k]
            ends[up] |= ends[k]
            inside[up] += 2 if self.tag[k] == "#text" else 1
        owner, out = list(range(n)), []
        for k in range(n):
            up = owner[self.parent[k]] if k else -1
            if k and inside[k] == 1 and not self.names[k] and self.tag[k] in ("div", "section", "span", "html", "body"):
                owner[k] = up
                continue
            size = 0 if not chars[k] else 1 + min(4, int(math.log(chars[k] / 12 + 1, 3)))
            share = 0 if not chars[k] else -(-4 * linked[k] // chars[k])
            out.append((k, up, (("t", self.tag[k]), ("s", self.tag[k] == "#text", size, ends[k]), ("l", share),
                                *(("n", x) for x in self.names[k]))))
        return out


class Model:
    """Log potentials: ``start`` of the root, ``step[parent][child]``, and of each feature, by part."""

    def __init__(self, pages: list[str], smooth: float = 0.02):
        root, step, seen, total, often = Counter(), Counter(), Counter(), Counter(), Counter()
        for html in pages:
            page = Page(html)
            label = ["c" if t == "#text" and y == "m" else y for t, y in zip(page.tag, page.label)]
            for k, up, found in page.tree():
                y = label[k]
                if up < 0:
                    root[y] += 1
                else:
                    step[label[up], y] += 1
                for f in found:
                    seen[f, y] += 1
                    total[f[0], y] += 1
                    often[f] += 1
        all_ = {kind: sum(total[kind, y] for y in PARTS) for kind in "tsln"}
        self.start = [(root[y] + smooth) / (sum(root.values()) + 3 * smooth) for y in PARTS]
        self.step = [[(step[p, y] + smooth) / (sum(step[p, z] for z in PARTS) + 3 * smooth) for y in PARTS] for p in PARTS]
        self.weight = {f: tuple(math.log((seen[f, y] + smooth * often[f] / all_[f[0]]) / (total[f[0], y] + smooth)) for y in PARTS) for f in often}
        self.local = functools.lru_cache(maxsize=100_000)(self._local)

    def _local(self, found: tuple) -> tuple[float, float, float]:
        """The parts' potentials for a node's features, the largest 1; unknown features say nothing."""
        a = b = c = 0.0
        for f in found:
            w = self.weight.get(f)
            if w:
                a, b, c = a + w[0], b + w[1], c + w[2]
        top = max(a, b, c)
        return math.exp(a - top), math.exp(b - top), math.exp(c - top)

    def marginals(self, page: Page) -> dict[int, tuple[float, float, float]]:
        """Each node's probabilities of the parts, by messages up to the root and down again."""
        tree, step = page.tree(), self.step
        below = {k: list(self.local(f)) for k, _, f in tree}
        up: dict[int, tuple[float, float, float]] = {}
        for k, parent, _ in reversed(tree):  # children come after their parents
            x, y, z = below[k]
            a, b, c = (s[0] * x + s[1] * y + s[2] * z for s in step)
            top = max(a, b, c)
            up[k] = a, b, c = a / top, b / top, c / top
            if parent >= 0:
                t = below[parent]
                x, y, z = t[0] * a, t[1] * b, t[2] * c
                top = max(x, y, z)
                t[:] = (x / top, y / top, z / top) if top < 1e-100 else (x, y, z)
        out: dict[int, tuple[float, float, float]] = {}
        for k, parent, _ in tree:
            if parent < 0:
                x, y, z = (s * b for s, b in zip(self.start, below[k]))
            else:  # the parent's marginal without this child's message
                (p, q, r), (a, b, c) = out[parent], up[k]
                p, q, r = p / max(a, 1e-300), q / max(b, 1e-300), r / max(c, 1e-300)
                x, y, z = (below[k][j] * (p * step[0][j] + q * step[1][j] + r * step[2][j]) for j in range(3))
            s = x + y + z
            out[k] = x / s, y / s, z / s
        return out


@functools.lru_cache(maxsize=1)
def trained(pages: int = 400) -> Model:
    return Model(labelled_pages(pages))


def main_text(html: str | None, model: Model) -> str:
    page = Page(html or "")
    found = model.marginals(page)
    blocks, run = [], []
    for k in [*page.order, None]:
        if k is not None:
            m, c, b = found[k]
            if c > b and c > m:
                run.append(page.text[k])
        elif run:
            blocks.append(" ".join("".join(run).split()))
            run = []
    return "\n".join(x for x in blocks if x)


def extract(pages: DataFrame, html: str = "html", out: str = "text", training_pages: int = 400) -> DataFrame:
    """``pages`` without ``html``, with its main text as ``out``; the model is trained once per worker."""
    kept = [c for c in pages.columns if c not in (html, out)]
    at = len(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = trained(training_pages)
        for whole in batches:
            for x in range(0, whole.num_rows, 256):
                b = whole.slice(x, 256)
                texts = pa.array([main_text(h, model) for h in b.column(at).to_pylist()], pa.string())
                yield pa.RecordBatch.from_arrays([*b.columns[:at], texts], names=[*kept, out])

    types = dict(pages.dtypes)
    return pages.select(*kept, F.col(html)).mapInArrow(run, ", ".join([*(f"`{c}` {types[c]}" for c in kept), f"`{out}` string"]))
