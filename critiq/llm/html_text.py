"""Main-text extraction by a tree-structured graphical model.

A page's DOM becomes a tree of binary variables (content or not): one for each
block element and one for each run of text in it.  Node potentials come from
features of tag, class, id and role names, text length, link share and
punctuation; parent-child potentials tie a node to its parent by the kind of
the node.  Sum-product messages, once upward and once downward, give exact
content marginals; the text runs with a marginal of a half or more are the main
text.  The weights maximise the likelihood of labelled pages (expected minus
observed features, by the same message passing).  The labelled pages are laid
out by rule in ``labelled_pages``: semantic and class-named layouts with menus,
notices, adverts, sidebars, forms, comments and footers around and inside
articles; fitting takes a bounded, fixed set of them.

Blocks keep page order and are joined by one newline; white space inside a block
becomes one space; character references are decoded; script, style and head
contents and elements that are not shown (``hidden``, ``display:none``,
``visibility:hidden``) are no text.  Map-only: a page is one row, a lost task repeats alone.

Edge cases: null and empty html give an empty text; text outside any element
counts like a block of the body; unclosed and stray tags are mended as browsers
do for the common cases; a page cut off in a tag or a comment ends there; equal
rows give equal texts; an empty table gives an empty result; other columns are
ignored.
"""
from __future__ import annotations

import functools
import html
import math
import random
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea iframe xmp".split())
# Elements in which ``/>`` closes a start tag.
FOREIGN = frozenset(("svg", "math"))
# Of the raw elements, a form's text area is a form's; the rest is never text.
BLOCK = frozenset("""address article aside blockquote button caption center dd details dialog div dl dt fieldset figcaption figure footer form
    h1 h2 h3 h4 h5 h6 header hgroup label legend li main menu nav ol option p pre search section select summary table tbody tfoot thead tr ul""".split())
# A start tag that closes an open element of its list (up to a boundary).
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}),
          "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
_NO_P = frozenset("""address article aside blockquote center details dialog div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header
    hgroup hr main menu nav ol p pre search section table ul""".split())
_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^>"'])*)(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""", re.S)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?=[\s/=]|\Z)(?!\s*=\s*["']?until-found)|\bstyle\s*=\s*(?:"[^"]*|'[^']*|)(?:display\s*:\s*none|visibility\s*:\s*hidden)""", re.I)
_ATTR = re.compile(r"""\b(class|id|role|aria-label|itemprop)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""", re.I)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


class Node:
    __slots__ = ("tag", "parent", "names", "text", "linked", "kids")

    def __init__(self, tag: str, parent: int, names: tuple[str, ...] = ()):
        self.tag, self.parent, self.names = tag, parent, names
        self.text: str | None = None
        self.linked = 0
        self.kids = 0


def parse(page: str, labels: list[int] | None = None) -> list[Node]:
    """Block elements and text runs in page order; a parent comes before its
    children, the root first.  ``labels`` collects the marks of labelled pages."""
    # The root is the body, tagged or not.
    nodes = [Node("body", -1)]
    stack: list[tuple[str, int]] = [("body", 0)]  # open elements and their block
    opened: Counter[str] = Counter(("body",))  # the same by tag, so that no tag walks the stack in vain
    unseen: list[int] = []  # depths of open elements that are not shown
    marks = [0]
    run: list[str] = []
    linked, in_link, at, n = 0, 0, 0, len(page)

    def flush() -> None:
        nonlocal linked
        if run:
            text = " ".join(html.unescape("".join(run)).split())
            run.clear()
            if text:
                k = stack[-1][1]
                node = Node("#text", k)
                node.text, node.linked = text, min(linked, len(text))
                nodes[k].kids += 1
                nodes.append(node)
                marks.append(marks[k])
        linked = 0

    def close(to: int) -> None:
        nonlocal in_link
        if any(t in BLOCK for t, _ in stack[to:]):
            flush()
        in_link -= sum(t == "a" for t, _ in stack[to:])
        opened.subtract(t for t, _ in stack[to:])
        del stack[to:]
        while unseen and unseen[-1] >= to:
            unseen.pop()

    while at < n:
        m = _TOKEN.search(page, at)
        text = page[at:m.start() if m else n]
        if text and not unseen:
            run.append(text)
            if in_link > 0:
                linked += len(text)
        if m is None:
            break
        at = m.end()
        tag = m[2] or m[5]
        if not tag:
            continue
        tag, attrs = tag.lower(), m[3] or m[6] or ""
        if m[1] or m[4]:
            if opened[tag] > 0:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] == tag:
                        close(k)
                        break
            continue
        if tag in ("html", "body"):
            flush()
            if labels is not None and "data-content" in attrs:
                marks[0] = int('data-content="1"' in attrs)
            continue
        if attrs.endswith("/") and (tag in FOREIGN or any(opened[t] > 0 for t in FOREIGN)):
            run.append(" ")
            continue
        if tag in RAW:
            end = re.compile(r"</" + re.escape(tag) + r"(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else n
            run.append(" ")
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            run.append(" ")
            continue
        if tag in _NO_P and opened["p"] > 0:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == "p":
                    close(k)
                    break
                if stack[k][0] in ("button", "td", "th", "div", "article", "section", "li"):
                    break
        if tag in CLOSES and any(opened[t] > 0 for t in CLOSES[tag][0]):
            same, bound = CLOSES[tag]
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] in same:
                    close(k)
                    break
                if stack[k][0] in bound:
                    break
        opened[tag] += 1
        if tag == "template" or attrs and _HIDDEN.search(attrs):
            unseen.append(len(stack))
        if tag in BLOCK:
            flush()
            names: list[str] = []
            mark = -1
            if attrs:
                for a in _ATTR.finditer(attrs):
                    value = a[2] or a[3] or a[4] or ""
                    names += [w.lower() for w in _NAME.findall(value)]
                if labels is not None and "data-content" in attrs:
                    mark = int('data-content="1"' in attrs)
            parent = stack[-1][1]
            nodes.append(Node(tag, parent, tuple(dict.fromkeys(names))))
            nodes[parent].kids += 1
            marks.append(marks[parent] if mark < 0 else mark)
            stack.append((tag, len(nodes) - 1))
        else:
            if tag in ("td", "th"):
                run.append(" ")
            stack.append((tag, stack[-1][1]))
            in_link += tag == "a"
    flush()
    if labels is not None:
        labels[:] = marks
    return nodes


_KIND = {**dict.fromkeys(("nav", "footer", "aside", "form", "header", "menu", "select", "button", "dialog", "fieldset"), 1),
         **dict.fromkeys(("article", "main"), 2), "#text": 3, **dict.fromkeys(("div", "section"), 4)}
KINDS = 6


def kind(node: Node) -> int:
    """The class of a node's potential with its parent: plain blocks, page
    parts, articles, text runs, boxes, and blocks with names."""
    k = _KIND.get(node.tag, 0)
    if k == 4 and not node.names:
        return 0
    return 5 if node.names and k == 0 else k


_BOX = frozenset(("content", "post", "entry", "story", "article", "main", "text"))


def features(nodes: list[Node]) -> list[list[str]]:
    """Names of the features of each node; the root's tell whether the page has
    a box for its content, an article's whether it is inside another box."""
    boxed = any(node.tag in ("article", "main") and not node.names or not _BOX.isdisjoint(node.names) for node in nodes)
    out = []
    for node in nodes:
        f = ["t:" + node.tag]
        if node.parent < 0:
            f.append("boxed" if boxed else "plain")
        elif node.tag in ("article", "main", "header", "footer", "section") and not node.names:
            above = nodes[node.parent]
            f.append(node.tag + (" outer" if above.tag in ("body", "main") or "wrapper" in above.names else " inner"))
        if node.text is None:
            f += ["n:" + x for x in node.names]
        else:
            p = nodes[node.parent]
            size = len(node.text)
            f = ["len:" + str(min(7, size.bit_length() - 1) if size < 256 else 8), "in:" + p.tag,
                 "link:" + str(round(4 * node.linked / size))]
            if node.text[-1] in ".!?…:;\"”»":
                f.append("stop")
            if "©" in node.text[:40] or "all rights reserved" in node.text.lower():
                f.append("rights")
        out.append(f)
    return out


class TreeModel:
    """Weights of the node features and of the parent-child potentials."""

    def __init__(self, unary: dict[str, float], pair: list[list[float]]):
        self.unary, self.pair = unary, pair  # pair[kind] = [p0c1, p1c0, p1c1] against p0c0

    def marginals(self, nodes: list[Node], feats: list[list[str]]) -> tuple[list[float], list[tuple[float, float, float]]]:
        """Content marginal of every node, and of every edge the joint marginals
        (0, 1), (1, 0) and (1, 1) of parent and child."""
        n = len(nodes)
        get = self.unary.get
        score = [sum(get(f, 0.0) for f in feats[i]) for i in range(n)]
        up = [0.0] * n  # log odds of a node from itself and its subtree
        msg0, msg1 = [0.0] * n, [0.0] * n
        for i in range(n):
            up[i] = score[i]
        for i in range(n - 1, 0, -1):
            c01, c10, c11 = self.pair[kind(nodes[i])]
            x = up[i]
            msg0[i], msg1[i] = _lse(0.0, c01 + x), _lse(c10, c11 + x)
            up[nodes[i].parent] += msg1[i] - msg0[i]
        full = up[:]  # log odds with the message from above
        edge = [(0.0, 0.0, 0.0)] * n
        for i in range(1, n):
            c01, c10, c11 = self.pair[kind(nodes[i])]
            above = full[nodes[i].parent] - (msg1[i] - msg0[i])
            full[i] = up[i] + _lse(c01, above + c11) - _lse(0.0, above + c10)
            x = up[i]
            w = (0.0, c01 + x, above + c10, above + c11 + x)
            z = max(w)
            e = [math.exp(v - z) for v in w]
            s = sum(e)
            edge[i] = (e[1] / s, e[2] / s, e[3] / s)
        return [_sigmoid(v) for v in full], edge

    def text(self, page: str | None) -> str:
        """The main text of a page."""
        if not page:
            return ""
        nodes = parse(page)
        p, _ = self.marginals(nodes, features(nodes))
        return "\n".join(node.text for node, q in zip(nodes, p) if node.text is not None and q >= 0.5)


def _lse(a: float, b: float) -> float:
    return a + math.log1p(math.exp(b - a)) if a >= b else b + math.log1p(math.exp(a - b))


def _sigmoid(v: float) -> float:
    return 1 / (1 + math.exp(-v)) if v >= 0 else math.exp(v) / (1 + math.exp(v))


# Names of the parts around and inside articles, for the labelled layouts.
_CONTENT = [*[("article", "")] * 4, *[("main", "")] * 2, ("article", "post"), ("div", "content"), ("div", "article body"), ("section", "entry content"),
            ("div", "main text"), ("div", "post content"), ("article", "story"), ("div", "page body")]
_MENU = [("nav", ""), ("nav", "menu"), ("div", "navigation"), ("ul", "menu"), ("div", "navbar"), ("div", "breadcrumb"), ("ol", "breadcrumbs"), ("div", "topnav links")]
_NOTICE = [("div", "cookie notice"), ("div", "cookie banner"), ("div", "consent"), ("section", "notice"), ("div", "alert"), ("dialog", "gdpr popup"), ("div", "banner message"), ("div", "disclaimer")]
_ADVERT = [("div", "ad"), ("div", "ads"), ("aside", "advert"), ("div", "advertisement"), ("div", "sponsored"), ("section", "promo"), ("div", "ad slot"), ("div", "sponsor")]
_SIDE = [("aside", ""), ("aside", "sidebar"), ("div", "sidebar"), ("div", "widget"), ("section", "related"), ("div", "related posts"), ("div", "recommended"), ("div", "share social"), ("div", "tags"), ("div", "side column"), ("div", "trending")]
_FORM = [("form", ""), ("form", "newsletter"), ("div", "subscribe"), ("form", "search"), ("form", "login"), ("form", "contact")]
_COMMENT = [("section", "comments"), ("div", "comments"), ("div", "comment list"), ("ol", "comment thread"), ("section", "replies"), ("div", "discussion"), ("div", "responses"), ("section", "reader comments"), ("div", "disqus")]
_FOOT = [("footer", ""), ("footer", "site footer"), ("div", "footer"), ("div", "copyright"), ("div", "legal")]
_HEAD = [("header", ""), ("header", "site header"), ("div", "header"), ("div", "masthead"), ("div", "logo")]


def labelled_pages(count: int = 900, seed: int = 11) -> list[str]:
    """Pages whose parts carry ``data-content`` marks (1 main text, 0 not)."""
    rng = random.Random(seed)
    stems = ["ba", "cor", "den", "el", "fin", "gra", "hol", "in", "jor", "kal", "lum", "mor", "nes", "or", "pel", "qui", "ras", "sol", "tan", "ver"]

    def words(a: int, b: int, stop: bool = True) -> str:
        w = [rng.choice(stems) + rng.choice(stems) * rng.randint(0, 1) for _ in range(rng.randint(a, b))]
        return " ".join(w).capitalize() + ("." if stop and rng.random() < 0.9 else "")

    def part(kind: list[tuple[str, str]], inner: str, mark: int) -> str:
        tag, name = rng.choice(kind)
        how = rng.random()
        sep = rng.choice([" ", "-", "_"])
        label = f' {"id" if how < 0.25 else "class"}="{name.replace(" ", sep)}"' if name else ""
        return f'<{tag}{label} data-content="{mark}">{inner}</{tag}>'

    def links() -> str:
        items = [f'<li><a href="/x">{words(1, 3, False)}</a></li>' for _ in range(rng.randint(3, 7))]
        return "<ul>" + "".join(items) + "</ul>" if rng.random() < 0.7 else " | ".join(f'<a href="/x">{words(1, 2, False)}</a>' for _ in items)

    def prose(a: int, b: int) -> str:
        out = []
        for _ in range(rng.randint(a, b)):
            r = rng.random()
            if r < 0.68:
                out.append(f"<p>{words(1, 60 if rng.random() < 0.75 else 5)}</p>")
            elif r < 0.76:
                out.append(f"<h2>{words(1, 6, False)}</h2>")
            elif r < 0.83:
                out.append("<ul>" + "".join(f"<li>{words(1, 14)}</li>" for _ in range(rng.randint(2, 5))) + "</ul>")
            elif r < 0.88:
                out.append(f"<blockquote><p>{words(5, 30)}</p></blockquote>")
            elif r < 0.92:
                out.append(f"<div>{words(3, 50)}</div>")
            elif r < 0.95:
                out.append("<table>" + "".join(f"<tr><td>{words(1, 3, False)}</td><td>{words(1, 3, False)}</td></tr>" for _ in range(3)) + "</table>")
            elif r < 0.97:
                out.append(f"<pre>{words(4, 12, False)}</pre>")
            else:
                out.append(f'<p>{words(3, 20)} <a href="/y">{words(1, 4, False)}</a> {words(2, 20)}</p>')
        return "".join(out)

    def noise() -> str:
        r = rng.randrange(5)
        if r == 0:
            return part(_ADVERT, rng.choice(["", "<p>"]) + words(2, 25), 0)
        if r == 1:
            return part(_SIDE, f"<h3>{words(1, 3, False)}</h3>" + (links() if rng.random() < 0.6 else f"<p>{words(4, 30)}</p>"), 0)
        if r == 2:
            return part(_FORM, f"<label>{words(1, 4, False)}</label><input><button>{words(1, 2, False)}</button>" + (f"<p>{words(3, 12)}</p>" if rng.random() < 0.5 else ""), 0)
        if r == 3:
            return part(_NOTICE, f"<p>{words(4, 30)}</p><button>{words(1, 2, False)}</button>" if rng.random() < 0.6 else words(4, 30), 0)
        return part(_COMMENT, "".join(f'<{t}{" class=comment" if t == "article" else ""}><p>{words(2, 50)}</p></{t}>' for t in [rng.choice(["div", "li", "article"])] for _ in range(rng.randint(1, 4))), 0)

    out = []
    for _ in range(count):
        body = []
        if rng.random() < 0.6:
            body.append(part(_HEAD, (f"<p>{words(1, 6)}</p>" if rng.random() < 0.5 else f"<h1>{words(1, 4, False)}</h1>") + (part(_MENU, links(), 0) if rng.random() < 0.5 else ""), 0))
        body += [part(_MENU, links(), 0) for _ in range(rng.randint(0, 2))]
        body += [noise() for _ in range(rng.randint(0, 3))]
        # Some pages have no box for their content: the body itself is it.
        bare = int(rng.random() < 0.15)
        head = f"<h1>{words(1, 10, False)}</h1>" if rng.random() < 0.85 else ""
        if head and not bare and rng.random() < 0.25:
            head = f'<header data-content="1">{head}</header>'
        text = head + prose(0 if head else 1, 5)
        if rng.random() < 0.5:
            text += noise() + prose(0, 4)
        body.append(text if bare else part(_CONTENT, text, 1))
        body += [noise() for _ in range(rng.randint(0, 3))]
        if rng.random() < 0.85:
            body.append(part(_FOOT, (f"&copy; {words(2, 8)}" if rng.random() < 0.6 else f"<p>{words(3, 30)}</p>") + (links() if rng.random() < 0.3 else ""), 0))
        inner = "".join(body)
        if rng.random() < 0.08:  # nothing but the text, tagged or not
            bare = 1
            inner = rng.choice([words(1, 30), f"<p>{words(1, 30)}</p>", prose(1, 3), f'<article data-content="1">{prose(1, 2)}</article>'])
        elif rng.random() < 0.3:
            inner = f'<div class="wrapper" data-content="{bare}">{inner}</div>'
        out.append(f'<html><head><title>x</title></head><body data-content="{bare}">{inner}</body></html>')
    return out


# Prior means of the weights of plain semantic boxes; those of the rest are 0.
START = {"article outer": 3.0, "main outer": 3.0, "t:article": 2.0, "t:main": 2.0}


class _Forest:
    """The trees of all labelled pages as arrays, for message passing level by level."""

    def __init__(self, pages: list[str]):
        parents, kinds, marks, depth, names, owner = [], [], [], [], [], []
        self.number: dict[str, int] = {}
        for page in pages:
            labels: list[int] = []
            nodes, base = parse(page, labels), len(parents)
            for i, (node, found) in enumerate(zip(nodes, features(nodes))):
                parents.append(base + node.parent if i else -1)
                depth.append(depth[base + node.parent] + 1 if i else 0)
                kinds.append(kind(node))
                for f in found:
                    names.append(self.number.setdefault(f, len(self.number)))
                    owner.append(base + i)
            marks += labels
        self.parent, self.kind, self.marks = np.array(parents), np.array(kinds), np.array(marks, dtype=float)
        self.names, self.owner, self.pages = np.array(names), np.array(owner), len(pages)
        depths = np.array(depth)
        self.levels = [np.flatnonzero(depths == d) for d in range(1, int(depths.max()) + 1)]

    def gradient(self, unary: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Observed minus expected features, by name and by (kind, potential)."""
        n = len(self.parent)
        up = np.bincount(self.owner, weights=unary[self.names], minlength=n)
        gain, edge = np.zeros(n), np.zeros((n, 3))
        for level in reversed(self.levels):
            c01, c10, c11 = pair[self.kind[level]].T
            gain[level] = np.logaddexp(c10, c11 + up[level]) - np.logaddexp(0.0, c01 + up[level])
            np.add.at(up, self.parent[level], gain[level])
        full = up.copy()
        for level in self.levels:
            c01, c10, c11 = pair[self.kind[level]].T
            x, above = up[level], full[self.parent[level]] - gain[level]
            full[level] = x + np.logaddexp(c01, above + c11) - np.logaddexp(0.0, above + c10)
            w = np.stack([np.zeros(len(level)), c01 + x, above + c10, above + c11 + x])
            w = np.exp(w - w.max(0))
            edge[level] = (w[1:] / w.sum(0)).T
        p = 0.5 * (1 + np.tanh(full / 2))
        g_unary = np.bincount(self.names, weights=(self.marks - p)[self.owner], minlength=len(self.number))
        g_pair = np.zeros((KINDS, 3))
        inner = np.concatenate(self.levels)
        a, b = self.marks[self.parent[inner]], self.marks[inner]
        for k, (x, y) in enumerate(((0, 1), (1, 0), (1, 1))):
            g_pair[:, k] = np.bincount(self.kind[inner], weights=((a == x) & (b == y)) - edge[inner, k], minlength=KINDS)
        return g_unary, g_pair


def fit(pages: list[str], rounds: int = 200, rate: float = 1.0, decay: float = 0.0001) -> TreeModel:
    """Weights by gradient ascent (Adagrad) on the mean log likelihood."""
    data = _Forest(pages)
    start = np.array([START.get(f, 0.0) for f in data.number])
    unary, pair = start.copy(), np.tile([-3.0, -3.0, 0.0], (KINDS, 1))
    seen_u, seen_p = np.full(unary.shape, 1e-8), np.full(pair.shape, 1e-8)
    for _ in range(rounds):
        gu, gp = data.gradient(unary, pair)
        gu, gp = gu / data.pages - decay * (unary - start), gp / data.pages
        seen_u += gu * gu
        seen_p += gp * gp
        unary, pair = unary + rate * gu / np.sqrt(seen_u), pair + rate * gp / np.sqrt(seen_p)
    return TreeModel({**START, **dict(zip(data.number, unary.tolist()))}, pair.tolist())


@functools.lru_cache(maxsize=1)
def default_model() -> TreeModel:
    return fit(labelled_pages())


def extract(pages: DataFrame, model: TreeModel | None = None) -> DataFrame:
    """One row per page: page_id, url, text (the main text), n_chars."""
    small_batches(pages.sparkSession)
    model = model or default_model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [model.text(x.as_py()) for x in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                             names=["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")) \
        .mapInArrow(run, "page_id long, url string, text string, n_chars long")
