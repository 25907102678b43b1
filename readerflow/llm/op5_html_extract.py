"""Main text of web pages: boosted trees over DOM nodes, decoded along the tree.

A page is read once into its block elements (and inline elements that carry a
class, id or role) in document order. Every node gets features: its tag, tokens
of its attributes, depth, place among its siblings, and the density of text,
links and paragraphs in its subtree. Gradient-boosted trees give each node a
probability of being part of the article. Decoding picks the most probable
labelling in which nothing below a dropped node is kept, by one pass from the
leaves and one from the root, so that ancestors and descendants never disagree.

The trees are trained here, on ``n_pages`` pages written by ``training_page``
with known labels (a bounded sample; the layouts vary in landmarks, class names
and surroundings).

Only the contents of script, style, title and textarea are no text; every other
element is a node or part of one, so nothing else is dropped before the trees.
Buttons, labels, selections and noscript parts are nodes like blocks, so that they
can go while the text around them stays. Reading a page takes time in proportion
to its length, however broken its tags and quotes are.

Defined results: null, empty and text-free html gives an empty text; repeated
rows are extracted each; an empty table gives an empty result. Only page_id, url
and html are read, so further columns never clash.
"""

from __future__ import annotations

import bisect
import html as html_lib
import random
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import slices, table

RAW = {t: re.compile(rf"</{t}(?=[\s/>])", re.I) for t in ("script", "style", "textarea", "title")}
NAME = re.compile(r"[a-zA-Z][^\s/>]*")
QUOTED = re.compile(r"(?:[^>\"']|\"[^\"]*\"|'[^']*')*+")
MARK = re.compile("[>\"']")
ATTRS = re.compile(r"\b(class|id|role|data-keep)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "html body head article section main header footer nav aside div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption "
    "blockquote pre figure figcaption form fieldset legend address details summary dialog menu hgroup center hr search".split())
INLINE_SELF_CLOSING = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}
# parts of forms and notices in the run of a text: nodes of their own, though they begin no block
EMBEDDED = frozenset("noscript select option optgroup datalist button label".split())
CLOSES_P = BLOCK - {"html", "body", "head", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "legend", "summary"}
LIMITS = frozenset("table ul ol dl td th article section div body html".split())
TAGS = ["html", "body", "article", "main", "section", "div", "p", "h1", "h2", "h3", "li", "ul", "td", "table", "blockquote", "pre", "figure",
        "header", "footer", "nav", "aside", "form", "address", "dialog", "menu", "noscript", "select", "option", "button", "label"]
GROUPS = [
    ("body", r"article|content|entry|story|main|post|text|prose|body"),
    ("menu", r"nav|menu|breadcrumb|pagination|pager|toc|skip"),
    ("head", r"header|masthead|topbar|logo|branding|toolbar"),
    ("foot", r"footer|copyright|colophon|legal"),
    ("side", r"side|aside|related|recommend|widget|teaser|more|popular|trending|rail"),
    ("advert", r"^ads?$|^ads?[-_0-9]|[-_]ads?$|advert|sponsor|promo|banner|affiliate"),
    ("talk", r"comment|repl(y|ies)|disqus|discussion|respond|review"),
    ("notice", r"cookie|notice|consent|alert|modal|popup|newsletter|subscribe|paywall|overlay|gdpr|warning"),
    ("form", r"form|login|search|signup|register|contact"),
    ("social", r"share|social|follow|like|tags?$|byline|meta|author"),
]
GROUP_RE = [re.compile(p) for _, p in GROUPS]
NEGATIVE_TAGS = frozenset(("nav", "footer", "aside", "form", "dialog", "menu", "search", "noscript", "select", "button", "label"))
N_FEATURES = 20 + len(GROUPS)


class Page:
    """Nodes of one page in document order, and its pieces of text as (node, block, text)."""

    __slots__ = ("tag", "parent", "depth", "last", "above", "attr", "nth", "own", "link", "kids", "keep", "pieces")

    def __init__(self) -> None:
        self.tag, self.parent, self.depth, self.last, self.above, self.attr, self.nth = [], [], [], [], [], [], []
        self.own, self.link, self.kids, self.keep, self.pieces = [], [], [], [], []


_ATTR_CACHE: dict[str, int] = {}


def _attr_bits(tokens: str) -> int:
    bits = _ATTR_CACHE.get(tokens)
    if bits is None:
        words = re.split(r"[\s]+", tokens.lower())
        bits = sum(1 << k for k, r in enumerate(GROUP_RE) if any(r.search(w) for w in words if w))
        if len(_ATTR_CACHE) < 50_000:
            _ATTR_CACHE[tokens] = bits
    return bits


class Ends:
    """Where start tags end in one page: at the first ``>`` outside of quotes, or, if the quotes do not close, at the first one.

    What a search for closing quotes runs over and fails on is remembered, so that no stretch is searched twice.
    """

    def __init__(self, doc: str) -> None:
        self.doc = doc
        self.marks: list[int] | None = None  # places of > " ', made where quotes first fail to close
        self.next_same: list[int] = []
        self.dead: set[int] = set()

    def find(self, at: int) -> int:
        """Place of the end of the start tag whose attributes begin at ``at``; there is a ``>`` behind."""
        if self.marks is None:
            stop = QUOTED.match(self.doc, at).end()
            if stop < len(self.doc) and self.doc[stop] == ">":
                return stop
            self.marks = [m.start() for m in MARK.finditer(self.doc, at)]
            later: dict[str, int] = {}
            self.next_same = [0] * len(self.marks)
            for k in range(len(self.marks) - 1, -1, -1):
                c = self.doc[self.marks[k]]
                self.next_same[k] = later.get(c, -1)
                later[c] = k
        k, seen = bisect.bisect_left(self.marks, at), []
        while k < len(self.marks) and k not in self.dead:
            if self.doc[self.marks[k]] == ">":
                return self.marks[k]
            seen.append(k)
            if self.next_same[k] < 0:
                break
            k = self.next_same[k] + 1
        self.dead.update(seen)
        return self.doc.find(">", at)


def tokens(doc: str):
    """(begin, end, name of an end tag, name of a start tag, its attributes) of comments, declarations, raw text and tags, in one pass.

    Comments without an end and the contents of raw-text elements without an end tag reach to the end of the page. A ``<`` that begins none of these is text.
    """
    ends, last, at = Ends(doc), doc.rfind(">"), doc.find("<")
    while at >= 0:
        c = doc[at + 1:at + 2]
        stop = end = tag = None
        attrs = ""
        if doc.startswith("<!--", at):
            stop = doc.find("-->", at + 4)
            stop = len(doc) if stop < 0 else stop + 3
        elif last > at:
            if c in ("!", "?") and c:
                stop = doc.find(">", at) + 1
            elif c == "/":
                m = NAME.match(doc, at + 2)
                if m and m.end() <= last:
                    end, stop = m[0], doc.find(">", m.end()) + 1
            elif m := NAME.match(doc, at + 1):
                raw = RAW.get(m[0].lower())
                if raw is not None and m.end() <= last:
                    stop = doc.find(">", m.end()) + 1
                    close = raw.search(doc, stop)
                    stop = doc.find(">", close.end()) + 1 if close else 0
                    stop = stop or len(doc)
                elif m.end() <= last:
                    stop = ends.find(m.end())
                    tag, attrs, stop = m[0], doc[m.end():stop], stop + 1
        if stop is None:
            at = doc.find("<", at + 1)
            continue
        yield at, stop, end, tag, attrs
        at = doc.find("<", stop)


def parse(html: str | None) -> Page:
    """One pass over the tags; missing and stray end tags are repaired as browsers do for the common cases."""
    page = Page()
    tag_no = {t: k for k, t in enumerate(TAGS)}
    stack: list[tuple[str, int]] = []  # (tag, node or the node around an inline tag)
    # places in the stack of each open tag, of the open blocks and of the open limits
    held: dict[str, list[int]] = {}
    blocks: list[int] = []
    limits: list[int] = []
    block, links, top = 0, 0, -1
    at, doc = 0, html or ""

    def text(raw: str) -> None:
        if top < 0 or not raw:
            return
        if "&" in raw:
            raw = html_lib.unescape(raw)
        page.pieces.append((top, block, raw))
        n = len(raw.strip())
        page.own[top] += n
        if links:
            page.link[top] += n

    def pop(to: int) -> None:
        nonlocal top, links, block
        while len(stack) > to:
            tag, node = stack.pop()
            held[tag].pop()
            if tag in LIMITS:
                limits.pop()
            if tag in BLOCK:
                blocks.pop()
            if tag == "a":
                links -= 1
            if tag in BLOCK:
                block += 1
            if node >= 0 and (not stack or stack[-1][1] != node):
                page.last[node] = len(page.tag)
        top = stack[-1][1] if stack else -1

    def push(tag: str, attrs: str) -> None:
        nonlocal top, links, block
        found = ATTRS.findall(attrs) if attrs and "=" in attrs and tag != "a" else ()
        names = " ".join(a or b or c for k, a, b, c in found if k.lower() != "data-keep")
        if tag in BLOCK or tag in EMBEDDED or names or top < 0:
            k = len(page.tag)
            page.tag.append(tag_no.get(tag, len(TAGS)))
            page.parent.append(top)
            page.depth.append(page.depth[top] + 1 if top >= 0 else 0)
            bits = _attr_bits(names) if names else 0
            neg = tag in NEGATIVE_TAGS or bits & ~1
            page.attr.append(bits)
            page.above.append(page.above[top] | (1 if tag in ("article", "main") else 0) | (2 if neg else 0) if top >= 0 else 0)
            if top >= 0:
                page.kids[top] += 1
            page.nth.append(page.kids[top] if top >= 0 else 1)
            page.kids.append(0)
            page.own.append(0)
            page.link.append(0)
            page.last.append(0)
            page.keep.append(next((int(a or b or c) for k2, a, b, c in found if k2.lower() == "data-keep"), -1) if found else -1)
            top = k
        held.setdefault(tag, []).append(len(stack))
        if tag in LIMITS:
            limits.append(len(stack))
        if tag in BLOCK:
            blocks.append(len(stack))
        stack.append((tag, top))
        if tag == "a":
            links += 1
        if tag in BLOCK:
            block += 1

    def place(names) -> int:
        """Place of the innermost open element of these names, or -1."""
        return max((held[t][-1] for t in names if held.get(t)), default=-1)

    for s, stop, end, tag, attrs in tokens(doc):
        if s > at:
            if top < 0:
                if doc[at:s].strip():
                    push("body", "")
                    text(doc[at:s])
            else:
                text(doc[at:s])
        at = stop
        if end:
            end = end.lower()
            k = place((end,))
            if k < 0:
                block += end in ("p", "br")
            elif not (end not in BLOCK and blocks and blocks[-1] > k or end in ("p", "li") and limits and limits[-1] > k):
                pop(k)
        elif tag:
            tag = tag.lower()
            if tag in VOID:
                if tag == "br" and top >= 0:
                    page.pieces.append((top, block, " "))
                elif tag == "hr":
                    block += 1
                continue
            if tag in ("html", "body") and held.get(tag):
                continue
            if tag == "body" and held.get("head"):
                pop(held["head"][0])
            closes = INLINE_SELF_CLOSING.get(tag, ()) + (("p",) if tag in CLOSES_P else ())
            k = place(closes)
            if k >= 0 and (not limits or k >= limits[-1]):
                pop(k)
            push(tag, attrs)
            if attrs.endswith("/") and tag not in BLOCK:
                pop(len(stack) - 1)
    if at < len(doc):
        if top < 0 and doc[at:].strip():
            push("body", "")
        text(doc[at:])
    pop(0)
    return page


def features(pages: list[Page]) -> tuple[np.ndarray, np.ndarray]:
    """(feature rows of all nodes, where each page's nodes begin)."""
    starts = np.concatenate([[0], np.cumsum([len(p.tag) for p in pages])]).astype(np.int64)
    n = int(starts[-1])
    flat = lambda name: np.fromiter((x for p in pages for x in getattr(p, name)), np.float64, n)
    base = np.repeat(starts[:-1], np.diff(starts))
    tag, own, link, depth, nth, kids, attr, above = (flat(k) for k in ("tag", "own", "link", "depth", "nth", "kids", "attr", "above"))
    parent = flat("parent").astype(np.int64)
    root = parent < 0
    up = np.where(root, np.arange(n), parent + base)
    last = flat("last").astype(np.int64) + base
    me = np.arange(n)

    def below(x: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0.0], np.cumsum(x)])
        return total[np.maximum(last, me + 1)] - total[me]

    text, links, nodes = below(own), below(link), below(np.ones(n))
    paragraphs = below((tag == TAGS.index("p")).astype(float))
    items = below((tag == TAGS.index("li")).astype(float))
    whole = text[base] if n else text
    siblings = kids[up]
    bits = attr.astype(np.int64)
    cols = [
        tag, depth, nth, siblings, np.where(siblings > 0, nth / np.maximum(siblings, 1), 1), kids,
        np.log1p(own), np.log1p(text), text / np.maximum(1, whole), links / np.maximum(1, text), text / np.maximum(1, nodes),
        np.log1p(paragraphs), np.log1p(items), text / np.maximum(1, text[up]), links[up] / np.maximum(1, text[up]), np.log1p(text[up]),
        tag[up], (above.astype(np.int64) & 1).astype(float), (above.astype(np.int64) >> 1 & 1).astype(float), (bits[up] & 1).astype(float),
        *((bits >> k & 1).astype(float) for k in range(len(GROUPS))),
    ]
    return np.stack(cols, 1).astype(np.float32), starts


@dataclass(frozen=True)
class Trees:
    """Complete trees of one depth: split features, thresholds and leaf values."""

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray

    def logits(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for f, t, leaf in zip(self.feature, self.threshold, self.leaf):
            k = np.zeros(len(x), np.int64)
            for _ in range(int(np.log2(len(leaf)))):
                k = 2 * k + 1 + (x[rows, f[k]] > t[k])
            out += leaf[k - len(f)]
        return out


def boost(x: np.ndarray, y: np.ndarray, rounds: int = 50, depth: int = 3, rate: float = 0.2, bins: int = 32, ridge: float = 1.0) -> Trees:
    """Newton boosting of the logistic loss on quantile bins."""
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], 1)
    base = float(np.log(y.mean() / (1 - y.mean())))
    z = np.full(len(y), base)
    all_f, all_t, all_l = [], [], []
    inner = (1 << depth) - 1
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-z))
        g, h = y - p, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        f, t = np.zeros(inner, np.int64), np.full(inner, np.inf, np.float32)
        for level in range(depth):
            for k in range((1 << level) - 1, (2 << level) - 1):
                rows = np.flatnonzero(node == k)
                best = (1e-6, 0, np.inf)
                if len(rows) > 10:
                    gs, hs = g[rows].sum(), h[rows].sum()
                    for j, e in enumerate(edges):
                        if not len(e):
                            continue
                        gl = np.cumsum(np.bincount(binned[rows, j], weights=g[rows], minlength=len(e) + 1))[:-1]
                        hl = np.cumsum(np.bincount(binned[rows, j], weights=h[rows], minlength=len(e) + 1))[:-1]
                        gain = gl**2 / (hl + ridge) + (gs - gl) ** 2 / (hs - hl + ridge) - gs**2 / (hs + ridge)
                        c = int(np.argmax(gain))
                        if gain[c] > best[0]:
                            best = (float(gain[c]), j, np.float32(e[c]))
                f[k], t[k] = best[1], best[2]
                node[rows] = 2 * k + 1 + (x[rows, f[k]] > t[k])
        leaf = np.array([rate * g[node == inner + k].sum() / (h[node == inner + k].sum() + ridge) for k in range(1 << depth)])
        z += leaf[node - inner]
        all_f.append(f)
        all_t.append(t)
        all_l.append(leaf)
    return Trees(base, np.array(all_f), np.array(all_t, np.float32), np.array(all_l))


def decode(page: Page, logit: np.ndarray) -> list[bool]:
    """Most probable labels under the rule that everything below a dropped node is dropped."""
    n = len(page.tag)
    z = np.clip(logit, -12, 12)
    keep = (-np.logaddexp(0, -z)).tolist()
    drop = (-np.logaddexp(0, z)).tolist()
    whole = drop[:]  # best value of the subtree if its top is dropped: all of it is
    parent = page.parent
    for k in range(n - 1, 0, -1):
        u = parent[k]
        if u >= 0:
            keep[u] += keep[k] if keep[k] > whole[k] else whole[k]
            whole[u] += whole[k]
    out = [False] * n
    for k in range(n):
        u = parent[k]
        out[k] = (u < 0 or out[u]) and keep[k] > whole[k]
    return out


def page_text(page: Page, kept: list[bool]) -> str:
    """Kept pieces joined to blocks; white space inside a block becomes one blank."""
    out, now, parts = [], -1, []
    for node, block, piece in page.pieces:
        if kept[node]:
            if block != now:
                if parts:
                    out.append("".join(parts))
                now, parts = block, []
            parts.append(piece)
    if parts:
        out.append("".join(parts))
    lines = (" ".join(b.split()) for b in out)
    return "\n".join(b for b in lines if b)


_WORDS = "lorem ipsum dolor sit amet elit sed tempor magna aliqua quis nostrud velit esse fugiat nulla sint culpa anim est".split()


def training_page(rng: random.Random) -> str:
    """A page of a random layout; data-keep marks the nodes of the article (1) and the others (0)."""
    pick = rng.choice

    def say(a: int, b: int) -> str:
        n = rng.randint(a, b)
        return " ".join(pick(_WORDS) for _ in range(n)).capitalize() + ("." if n > 4 else "")

    def el(tag: str, keep: int, inner: str, names: tuple[str, ...] = (), share: float = 0.7) -> str:
        cls = f' {pick(("class", "class", "id"))}="{pick(names)}"' if names and rng.random() < share else ""
        return f'<{tag}{cls} data-keep="{keep}">{inner}</{tag}>'

    def links(n: int, keep: int = 0) -> str:
        return el(pick(("ul", "ul", "div")), keep, "".join(el("li", keep, f'<a href="/x">{say(1, 4)}</a>') for _ in range(n)))

    def embedded() -> str:
        """A part of a form or a notice, as it stands in the run of a text."""
        r = rng.random()
        if r < 0.3:
            return el("button", 0, say(1, 3), ("btn", "share", "more"), 0.4)
        if r < 0.5:
            return el("noscript", 0, say(1, 12))
        if r < 0.75:
            return el("label", 0, say(1, 3), ("field",), 0.2) + (el("select", 0, "".join(el("option", 0, say(1, 2)) for _ in range(rng.randint(1, 5)))) if rng.random() < 0.6 else "<input>")
        return el("select", 0, "".join(el("option", 0, say(1, 2)) for _ in range(rng.randint(1, 5))))

    def paragraphs(n: int, keep: int, a: int, b: int) -> str:
        some = (el("p", keep, (f"<b>{say(a, b)}</b>" if rng.random() < 0.1 else say(a, b)) + (f' <a href="/y">{say(1, 3)}</a>' if rng.random() < 0.15 else "")
                   + (" " + embedded() if rng.random() < 0.04 else "")) for _ in range(n))
        return "".join(some)

    body = []
    if rng.random() < 0.85:
        body.append(el(pick(("nav", "nav", "div")), 0, links(rng.randint(2, 9)), ("nav", "menu", "navbar", "main-menu", "breadcrumb")))
    if rng.random() < 0.5:
        body.append(el(pick(("header", "div")), 0, el("div", 0, say(1, 4), ("logo", "site-title")) + (links(rng.randint(2, 5)) if rng.random() < 0.5 else ""), ("header", "site-header", "masthead", "topbar"), 0.9))
    if rng.random() < 0.4:
        body.append(el("div", 0, paragraphs(1, 0, 5, 25) + say(0, 3), ("cookie-notice", "notice", "consent", "alert", "newsletter", "popup"), 1.0))
    ads = lambda: el(pick(("div", "div", "aside")), 0, say(3, 25), ("ad", "ads", "advert", "sponsored", "promo", "banner"), 1.0)
    if rng.random() < 0.5:
        body.append(ads())
    n = pick((1, 1, 2, 3, 5, 8, 14, 25))
    inside = [el("h1", 1, say(3, 10))] if rng.random() < 0.8 else []
    for k in range(n):
        inside.append(paragraphs(1, 1, *pick(((1, 3), (4, 12), (15, 60), (40, 160)))))
        r = rng.random()
        if r < 0.06:
            inside.append(el("h2", 1, say(2, 6)))
        elif r < 0.10:
            inside.append(el("ul", 1, "".join(el("li", 1, say(3, 20)) for _ in range(rng.randint(2, 5)))))
        elif r < 0.13:
            inside.append(el("blockquote", 1, paragraphs(1, 1, 10, 40)))
        elif r < 0.17:
            inside.append(ads())
        elif r < 0.19:
            inside.append(el("div", 0, links(3), ("share", "social", "related"), 1.0))
        elif r < 0.22:
            inside.append(embedded())
    article = el(pick(("article", "article", "main", "div", "section")), 1, "".join(inside), ("content", "article-body", "post", "entry-content", "story"), 0.5)
    if rng.random() < 0.3:
        article = el(pick(("main", "div")), 1, article, ("main", "wrapper", "container"), 0.6)
    body.append(article)
    if rng.random() < 0.4:
        body.append(el(pick(("aside", "div")), 0, el("h3", 0, say(1, 3)) + (links(rng.randint(3, 8)) if rng.random() < 0.7 else paragraphs(2, 0, 5, 30)), ("sidebar", "related", "widget", "popular"), 0.8))
    if rng.random() < 0.4:
        talk = "".join(el("div", 0, el("span", 0, say(1, 2), ("author",), 1.0) + paragraphs(rng.randint(1, 2), 0, 3, 50), ("comment", "reply"), 0.9) for _ in range(rng.randint(1, 6)))
        body.append(el(pick(("section", "div")), 0, el("h3", 0, "Comments") + talk, ("comments", "discussion", "disqus", "responses"), 1.0))
    if rng.random() < 0.15:
        body.append(embedded())
    if rng.random() < 0.35:
        body.append(el("form", 0, el("p", 0, say(2, 8)) + el("div", 0, say(1, 3)) + (embedded() if rng.random() < 0.6 else ""), ("search", "login", "signup", "contact"), 0.6))
    if rng.random() < 0.8:
        body.append(el(pick(("footer", "footer", "div")), 0, (paragraphs(1, 0, 3, 20) if rng.random() < 0.5 else say(3, 20)) + (links(3) if rng.random() < 0.4 else ""), ("footer", "site-footer", "copyright"), 0.9))
    return f'<html data-keep="1"><head data-keep="0"></head><body data-keep="1">{"".join(body)}</body></html>'


def fit_trees(n_pages: int = 400, seed: int = 11) -> Trees:
    """Trees trained on ``n_pages`` written pages."""
    rng = random.Random(seed)
    pages = [parse(training_page(rng)) for _ in range(n_pages)]
    x, _ = features(pages)
    y = np.array([k for p in pages for k in p.keep], np.float64)
    known = y >= 0
    return boost(x[known], y[known])


def extract_text(pages: DataFrame, trees: Trees, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per row: page_id, url, text and n_chars."""
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    kind = rows.schema["page_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for b in slices(batch, "html", 1 << 20):
                parsed = [parse(h) for h in b.column(2).to_pylist()]
                x, starts = features(parsed)
                z = trees.logits(x)
                texts = [page_text(p, decode(p, z[s:e])) for p, s, e in zip(parsed, starts, starts[1:])]
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                                 names=["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"), fit_trees())
