"""Main text of HTML pages by sum-product message passing over the DOM tree.

A page becomes a tree: its elements, and as leaves its text blocks (text
between two block-level tags). Every node is content or not. A node's features
(tag, telling words in class and id, amount of text, share of link text,
punctuation, place) give its own log-odds; parent and child are tied by a
potential of two by two, one for elements and one for blocks. Messages run
upward from the leaves and downward from the root, which on a tree gives the
exact marginal of every node; the blocks with a marginal over one half are the
text.

Training maximises the likelihood of labelled pages: the exact gradient is the
difference of the labels and the marginals. Labelled are ``GENERATED`` pages laid
out from labelled parts, and at most ``LABELLED`` of the given pages (by the
smallest hash of page_id) that mark their own text with an ``article`` or
``main`` element; in half of the latter that element is shown as a plain
``div``, so that the tag is not the only thing learnt. An element's label is that of most
of its text.

One pass over the pages without a shuffle; the weights are broadcast. Parsing is
a linear scan of the whole page.

Defined results: a null, empty or text-free page gives an empty text; unclosed
tags close where their parent does, a head where text or an element that can't
stand in it begins, and a hidden element without an end tag at the next
block-level tag; a page cut off inside a tag, a comment or a
script ends there; repeated rows give repeated results; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, table
from .html_pages import CONTENT, REST, labelled_page

LABELLED = 150
GENERATED = 500
STEPS = 150
RATE = 0.08
DECAY = 1e-4

# Element names of the HTML standard by kind, and telling words of class and id values.
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
                  "header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed frame hr img input link meta param source track wbr".split())
UNSEEN = frozenset("script style noscript template head title svg math iframe object select textarea button canvas audio video datalist noframes".split())
IN_HEAD = frozenset("base basefont bgsound head link meta noframes noscript script style template title".split())
ENDS = ("svg", "math", "object", "select", "button", "canvas", "audio", "video", "datalist")      # hidden elements that may stand unclosed
_ENDS = {t: (re.compile(rf"</{t}[\s/>]", re.I), re.compile(rf"<{t}[\s/>]", re.I)) for t in ENDS}
RAW = frozenset("script style textarea title noscript iframe noframes xmp".split())
CLOSES_P = BLOCK - {"html", "body", "tbody", "thead", "tfoot", "tr", "td", "th", "caption", "optgroup", "option"}
SAME = {"li": ("li", ("ul", "ol", "menu", "dir")), "dd": ("dd dt", ("dl",)), "dt": ("dd dt", ("dl",)), "tr": ("tr td th", ("table",)), "td": ("td th", ("tr", "table")),
        "th": ("td th", ("tr", "table")), "option": ("option", ("select",)), "tbody": ("tbody thead tfoot tr td th", ("table",)), "thead": ("tbody thead tfoot", ("table",)), "tfoot": ("tbody thead tfoot tr td th", ("table",))}
TAGS = ("article", "main", "nav", "header", "footer", "aside", "form", "section", "div", "ul ol menu dl", "li dd dt", "p", "h1", "h2 h3", "h4 h5 h6", "blockquote pre figure", "table tr td th tbody", "body html")
HINTS = (r"nav|menu|breadcrumb|pagina|links?\b", r"foot|copyright|legal", r"head|mast|\btop|logo", r"side|widget|related|recommend|right|tags?\b|share|social", r"\bads?\b|advert|promo|sponsor|banner",
         r"comment|repl(y|ies)|respon|discuss", r"cookie|notice|alert|consent|popup|modal|newsletter|subscri", r"form|search|login", r"article|content|post|entry|story|\bmain|\btext|body")
_HINTS = [re.compile(h, re.I) for h in HINTS]
_GROUP = {t: i for i, ts in enumerate(TAGS) for t in ts.split()}
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_STOP = re.compile(r">|=\s*[\"']")
_ATTR = re.compile(r"""(class|id|role|style|hidden|aria-hidden)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)


class Page:
    """Nodes in page order: parent, tag, attribute text, and for blocks their text."""

    __slots__ = ("parent", "tag", "attrs", "text", "linked")

    def __init__(self):
        self.parent, self.tag, self.attrs, self.text, self.linked = [-1], ["html"], [""], [None], [0]

    def add(self, parent: int, tag: str, attrs: str = "", text: str | None = None, linked: int = 0) -> int:
        self.parent.append(parent)
        self.tag.append(tag)
        self.attrs.append(attrs)
        self.text.append(text)
        self.linked.append(linked)
        return len(self.tag) - 1


def parse(source: str | None) -> Page:
    """Tree of a page, in one pass from left to right."""
    page, src = Page(), source or ""
    stack: list[tuple[str, int]] = [("html", 0)]        # open elements and their nodes; inline ones have their block's node
    open_: Counter = Counter()                          # how many of each name are open
    held: list[str] = []                                # pieces of the current block
    hid: list[int] = []                                 # places in the stack of hidden elements
    ahead: dict[tuple[str, int], int] = {}              # next end tag (0) and start tag (1) of a name
    links = linked = 0
    at, n = 0, len(src)
    no_end = False

    def flush() -> None:
        nonlocal linked
        if held:
            text = " ".join("".join(held).split())
            if text:
                page.add(stack[-1][1], "#text", "", text, linked)
            held.clear()
        linked = 0

    def close(k: int) -> None:
        nonlocal links
        for name, _ in stack[k:]:
            links -= name == "a"
            open_[name] -= 1
        while hid and hid[-1] >= k:
            hid.pop()
        if any(name in BLOCK for name, _ in stack[k:]):
            flush()
        del stack[k:]

    def following(name: str, kind: int) -> int:
        if ahead.get((name, kind), -1) < at:
            m = _ENDS[name][kind].search(src, at)
            ahead[name, kind] = m.start() if m else n
        return ahead[name, kind]

    def unclosed(name: str) -> bool:
        """No end tag follows, or only that of a later element of the name (objects, svg and math may nest)."""
        end = following(name, 0)
        return end == n or (name not in ("object", "svg", "math") and following(name, 1) < end)

    def words(s: str) -> None:
        nonlocal linked
        if hid and stack[-1][0] == "head" and s.strip():   # text ends the head
            close(len(stack) - 1)
        if s and not hid:
            s = html.unescape(s)
            held.append(s)
            if links > 0:
                linked += len(s)

    while at < n:
        lt = src.find("<", at)
        if lt < 0:
            words(src[at:])
            break
        words(src[at:lt])
        after = src[lt + 1:lt + 4]
        if after == "!--":
            end = src.find("-->", lt + 4)
            if end < 0:
                break
            at = end + 3
            continue
        if after[:1] in ("!", "?"):
            end = src.find(">", lt)
            if end < 0:
                break
            at = end + 1
            continue
        m = _NAME.match(src, lt)
        if not m:
            words("<")
            at = lt + 1
            continue
        # the tag's end: the first > outside of quoted values, or the first > if a quote never ends
        end, j = -1, m.end()
        while not no_end:
            s = _STOP.search(src, j)
            if not s:
                no_end = True
                break
            if s[0] == ">":
                end = s.start()
                break
            quote = src.find(s[0][-1], s.end())
            if quote < 0:
                end = src.find(">", s.end())
                break
            j = quote + 1
        if end < 0:
            end = src.find(">", m.end())
        if end < 0:
            break
        name, inside = m[1].lower(), src[m.end():end]
        at = end + 1
        if src[lt + 1] == "/":
            if name == "p":                                 # without an open one it still stands for an empty paragraph
                flush()
            for k in range(len(stack) - 1, 0, -1) if open_[name] else ():
                if stack[k][0] == name:
                    close(k)
                    break
            continue
        if name == "br":
            if hid and stack[-1][0] == "head":
                close(len(stack) - 1)
            words(" ")
            continue
        if name in VOID:
            if name in BLOCK:
                flush()
            continue
        if name in RAW:
            stop = re.compile(rf"</{re.escape(name)}[\s/>]", re.I).search(src, at)
            if not stop:
                break
            at = src.find(">", stop.start()) + 1 or n
            continue
        if name in ("html", "body") and any(t == name for t, _ in stack[1:]):
            continue
        if name == "head" and open_["body"]:
            continue
        if hid and stack[-1][0] == "head" and name not in IN_HEAD:
            close(len(stack) - 1)
        while hid and name in BLOCK and name not in ("option", "optgroup") and stack[hid[-1]][0] in ENDS and unclosed(stack[hid[-1]][0]):
            close(hid[-1])
        if name in BLOCK:
            flush()
            if name in CLOSES_P and open_["p"]:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] == "p":
                        close(k)
                        break
                    if stack[k][0] in BLOCK and stack[k][0] != "p":
                        break
            if name in SAME:
                ends, fence = SAME[name]
                ends = ends.split()
                found = 0
                for k in range(len(stack) - 1, 0, -1) if any(open_[t] for t in ends) else ():
                    if stack[k][0] in fence:
                        break
                    if stack[k][0] in ends:
                        found = k
                if found:
                    close(found)
            attrs = " ".join(f"{k.lower()}={(v or '1').strip(chr(34) + chr(39))}" for k, v in _ATTR.findall(inside)) if inside.strip() else ""
            node = page.add(stack[-1][1], name, attrs)
        else:
            node = stack[-1][1]
        if not inside.endswith("/") or name in BLOCK:
            stack.append((name, node))
            open_[name] += 1
            links += name == "a"
            if name in UNSEEN:
                hid.append(len(stack) - 1)
    flush()
    return page


# ------------------------------------------------------------------------ features
N_FEATURES = 2 * (len(TAGS) + 1) + 2 * len(HINTS) + 13
_CACHE: dict[str, tuple] = {}


def _hints(attrs: str) -> tuple:
    got = _CACHE.get(attrs)
    if got is None:
        if len(_CACHE) > 20_000:
            _CACHE.clear()
        got = _CACHE[attrs] = tuple(float(bool(h.search(attrs))) for h in _HINTS) if attrs else (0.0,) * len(HINTS)
    return got


def features(pages: list[Page]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(features, parent, depth, is block) of all nodes of all pages one after another."""
    rows, parents, depths, blocks = [], [], [], []
    for p in pages:
        base = len(parents)
        n = len(p.tag)
        depth = [0] * n
        chars, linked, marks = [0] * n, [0] * n, [0] * n
        for i in range(1, n):
            depth[i] = depth[p.parent[i]] + 1
            if p.text[i] is not None:
                t = p.text[i]
                chars[i], linked[i], marks[i] = len(t), min(p.linked[i], len(t)), t.count(".") + t.count(",") + t.count("!")
        for i in range(n - 1, 0, -1):
            q = p.parent[i]
            chars[q] += chars[i]
            linked[q] += linked[i]
            marks[q] += marks[i]
        whole = max(chars[0], 1)
        before = 0
        above = [(0.0,) * len(HINTS)] * n
        for i in range(n):
            q = p.parent[i]
            own = _hints(p.attrs[i])
            over = tuple(max(a, b) for a, b in zip(above[q], _hints(p.attrs[q]))) if q >= 0 and i else (0.0,) * len(HINTS)
            above[i] = over
            tag = [0.0] * (len(TAGS) + 1)
            tag[_GROUP.get(p.tag[i], len(TAGS))] = 1.0
            up = [0.0] * (len(TAGS) + 1)
            if q >= 0:
                up[_GROUP.get(p.tag[q], len(TAGS))] = 1.0
            c = max(chars[i], 1)
            leaf = p.text[i] is not None
            dens = linked[i] / c
            a = p.attrs[i]
            rows.append((*tag, *up, *own, *over, 1.0, float(leaf), np.log1p(c) / 6, leaf * np.log1p(c) / 6, dens, leaf * dens, min(marks[i] / c * 20, 2),
                         chars[i] / whole, before / whole, (before / whole) ** 2, min(depth[i] / 8, 2), float("hidden" in a or "display:none" in a.replace(" ", "")), float(leaf and c < 25)))
            if leaf:
                before += chars[i]
        parents += [base + q if q >= 0 else -1 for q in p.parent]
        depths += depth
        blocks += [t is not None for t in p.text]
    return np.array(rows, dtype=np.float64).reshape(-1, N_FEATURES), np.array(parents, dtype=np.int64), np.array(depths, dtype=np.int64), np.array(blocks, dtype=bool)


# --------------------------------------------------------------------------- model
class TreeModel:
    """``w`` scores content; ``pair[kind][parent][child]`` ties parent and child (kind 1: the child is a block)."""

    def __init__(self):
        self.w = np.zeros(N_FEATURES)
        self.pair = np.zeros((2, 2, 2))

    def sum_product(self, x, parent, depth, block):
        """(log marginals per node, log marginals of (parent, child) states per node, log partition per root)."""
        own = np.column_stack([np.zeros(len(x)), x @ self.w])
        kind = block.astype(np.int64)
        order = np.argsort(depth, kind="stable")
        cut = np.searchsorted(depth[order], np.arange(depth.max(initial=0) + 2))
        below = own.copy()                                  # own score and the messages of children
        up = np.zeros_like(own)                             # message to the parent
        for d in range(len(cut) - 2, 0, -1):
            at = order[cut[d]:cut[d + 1]]
            pair = self.pair[kind[at]]
            up[at] = np.logaddexp(pair[:, :, 0] + below[at, 0, None], pair[:, :, 1] + below[at, 1, None])
            np.add.at(below, parent[at], up[at])
        down = np.zeros_like(own)
        pairs = np.zeros((len(x), 2, 2))
        for d in range(1, len(cut) - 1):
            at = order[cut[d]:cut[d + 1]]
            rest = below[parent[at]] + down[parent[at]] - up[at]          # parent without this child
            joint = rest[:, :, None] + self.pair[kind[at]]
            down[at] = np.logaddexp(joint[:, 0], joint[:, 1])
            pairs[at] = joint + below[at][:, None, :]
        total = below + down
        log_z = np.logaddexp(total[:, 0], total[:, 1])
        return total - log_z[:, None], pairs - log_z[:, None, None], log_z

    def fit(self, x, parent, depth, block, label, weight) -> TreeModel:
        child = np.flatnonzero(parent >= 0)
        kind = block[child].astype(np.int64)
        params = [self.w, self.pair]
        m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        for step in range(1, STEPS + 1):
            single, pairs, _ = self.sum_product(x, parent, depth, block)
            gw = x.T @ (weight * (np.exp(single[:, 1]) - label)) + DECAY * self.w
            gp = DECAY * self.pair
            expect = np.exp(pairs[child]) * weight[child][:, None, None]
            gp = gp + np.stack([expect[kind == k].sum(axis=0) for k in (0, 1)])
            np.subtract.at(gp, (kind, label[parent[child]], label[child]), weight[child])
            for p, g, a, b in zip(params, (gw, gp), m, v):
                a += 0.1 * (g - a)
                b += 0.01 * (g * g - b)
                p -= RATE * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.99 ** step)) + 1e-9)
        return self

    def texts(self, pages: list[Page]) -> list[str]:
        x, parent, depth, block = features(pages)
        single, _, _ = self.sum_product(x, parent, depth, block)
        good = single[:, 1] > np.log(0.5)
        out, at = [], 0
        for p in pages:
            out.append("\n".join(t for t, g in zip(p.text, good[at:at + len(p.text)]) if t is not None and g))
            at += len(p.text)
        return out


# ------------------------------------------------------------------------- training
_REST = frozenset(("nav", "footer", "aside", "form"))


def marked_labels(page: Page) -> list[int] | None:
    """Labels of the blocks of a page that marks its own text; None for others."""
    spot = [i for i, t in enumerate(page.tag) if t in ("article", "main")]
    if not spot:
        return None
    state = [0] * len(page.tag)
    for i in range(1, len(page.tag)):
        q, t = page.parent[i], page.tag[i]
        state[i] = 0 if t in _REST or any(_hints(page.attrs[i])[k] for k in (0, 3, 4, 5, 6)) else 1 if t in ("article", "main") else state[q]
    return state


def element_labels(page: Page, block: list[int]) -> list[int]:
    """Elements take the label of most of their text."""
    yes, all_ = [0] * len(page.tag), [0] * len(page.tag)
    for i in range(len(page.tag) - 1, -1, -1):
        if page.text[i] is not None:
            all_[i] = len(page.text[i])
            yes[i] = all_[i] * block[i]
        if page.parent[i] >= 0:
            yes[page.parent[i]] += yes[i]
            all_[page.parent[i]] += all_[i]
    return [block[i] if page.text[i] is not None else int(2 * yes[i] > all_[i]) for i in range(len(page.tag))]


def training_pages(sources: list[str], seed: int = 11) -> tuple[list[Page], list[list[int]]]:
    rng = np.random.default_rng(seed)
    vocabulary = sorted({w for s in sources for w in re.findall(r"[^\W\d_]{2,}", re.sub(r"<[^>]*>", " ", s))})[:20_000] or "some plain words of text to lay out pages with and a few more".split()
    pages, labels = [], []
    for k, s in enumerate(sources):
        p = parse(s)
        lab = marked_labels(p)
        if lab is None:
            continue
        if k % 2:
            p.tag = ["div" if t in ("article", "main") else t for t in p.tag]
        pages.append(p)
        labels.append(element_labels(p, lab))
    for _ in range(GENERATED):
        p = parse(labelled_page(rng, vocabulary))
        lab = [int(t is not None and t.startswith(CONTENT)) for t in p.text]
        p.text = [t if t is None else t.replace(CONTENT, "").replace(REST, "").strip() for t in p.text]
        pages.append(p)
        labels.append(element_labels(p, lab))
    return pages, labels


def trained(sources: list[str]) -> TreeModel:
    pages, labels = training_pages(sources)
    x, parent, depth, block = features(pages)
    weight = np.concatenate([np.full(len(p.tag), 1 / len(p.tag)) for p in pages]) / len(pages)
    return TreeModel().fit(x, parent, depth, block, np.array([y for lab in labels for y in lab]), weight)


def training_sources(pages: DataFrame, most: int = LABELLED) -> list[str]:
    """At most ``most`` pages with an article or main element, by the hash of page_id."""
    some = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("html").cast("string").alias("html")).filter(F.col("html").rlike("(?i)<(article|main)[ >]"))
    order = [F.xxhash64("page_id"), F.col("page_id"), F.xxhash64("html")]
    ids = some.select("page_id", F.xxhash64("html").alias("h")).orderBy(F.xxhash64("page_id"), "page_id", "h").limit(most)
    got = some.join(F.broadcast(ids), some.page_id.eqNullSafe(ids.page_id) & (F.xxhash64("html") == ids.h), "left_semi").distinct()
    return [h for h, in got.orderBy(*order).select("html").limit(most).collect()]


def extract(pages: DataFrame, model: TreeModel) -> DataFrame:
    """page_id, url, text of every row of ``pages``."""
    weights = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi in slices(b, "html"):
                s = b.slice(lo, hi - lo)
                texts = weights.value.texts([parse(h) for h in s.column("html").to_pylist()])
                yield pa.RecordBatch.from_arrays([s.column("page_id"), s.column("url"), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    src = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return src.mapInArrow(run, "page_id long, url string, text string")


def op3_html_extract(spark, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return extract(pages, trained(training_sources(pages))).select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
