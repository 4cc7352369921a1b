"""Main text of web pages by a recurrent block labeller.

A page is cut into leaf blocks in page order: the text between two block-level
tags, inline tags joined, ``br`` a space, character references decoded, white
space collapsed. Scripts, styles, templates, comments and the head leave no
block. Every block is described by its tag path (element names, classes, ids
and roles of all open elements, hashed), its words (hashed), its length, its
share of linked text and its place. A bidirectional LSTM in numpy reads the
blocks of the whole page and labels each as main text or not; the main blocks
joined by one space are the text.

The labeller is trained here on a bounded sample of pages (``MAX_TRAIN``), in two
ways: the pages as they are, labelled by their semantic elements, and layouts
composed from their blocks with menus, headers, footers, sidebars, notices,
adverts, forms and reader comments around and inside the article, whose labels
are known. Training is seeded, so reruns agree.

Cases: null and empty html give the empty text; a tag cut off at the end of a
page is dropped with all behind it, a stray or unclosed quote in a tag is an
ordinary character, elements left open end with the page; a page of any length
takes linear time, its blocks are read in windows; a page without any
element is one block; repeated rows get equal results; an empty table gives an
empty result; other columns are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orbitfit.llm.base import bounded_sample

MAX_TRAIN = 240        # pages the labeller learns from
HIDDEN = 16
PATH, WORDS = 512, 32
INPUT = PATH + WORDS + 4
ROUNDS = 12            # passes over the training pages
WINDOW = 96            # blocks of a training page
LAYOUTS = 4            # layouts composed from each
SCORED = 64            # pages labelled together
DEPTH = 200            # open elements that are kept apart; what is nested deeper counts as this deep
READ = 4096            # blocks read at a time; longer pages are read in overlapping windows
LAP = 256              # blocks that a window shares with each neighbour

# A tag up to its end. A quote opens a value only behind "=" and only if it is closed somewhere; any other
# quote is an ordinary character. The possessive repetitions never go back, so a match takes linear time.
TAG = re.compile(r"""<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>"'=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+|["'])*+)>""")
# Elements whose content is no text; an unclosed one ends where the body begins, or with the page.
RAW = {t: re.compile(rf"</{t}\s*+>|(?=<body\b)", re.I)
       for t in "script style template noscript iframe svg textarea head select".split()}
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small "
                   "span strike strong sub sup time tt u var wbr img input".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# An opening tag that ends an open element of these names.
ENDS = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
        "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
for _t in ("div section article aside nav header footer main ul ol dl table form blockquote pre h1 h2 h3 h4 h5 h6 "
           "figure hr address details fieldset").split():
    ENDS[_t] = ("p",)

BOILER_TAGS = frozenset("nav header footer aside form button menu dialog title".split())
BOILER_NAMES = frozenset(
    "nav navbar navigation menu header masthead footer sidebar aside ad ads adv advert advertisement sponsor sponsored "
    "promo banner cookie cookies consent notice alert popup modal comment comments commentary reply replies response "
    "responses feedback remarks opinions reactions discussion disqus share "
    "sharing social related recommended breadcrumb breadcrumbs newsletter subscribe signup login search widget toolbar "
    "copyright legal complementary contentinfo form".split())
MAIN_NAMES = frozenset("article main content post entry story body text".split())


def tags(html: str) -> Iterator[tuple[str, str, str, str]]:
    """(text before, "/" of an end tag, name, attributes) of every tag, and the text behind the last one.

    One pass: every step goes on behind what it has read. Comments, declarations and the
    content of raw elements are passed over; behind the last ">" a tag cannot end and is dropped.
    """
    text: list[str] = []
    at, last = 0, html.rfind(">")
    while True:
        lt = html.find("<", at)
        if lt < 0:
            break
        text.append(html[at:lt])
        after = html[lt + 1:lt + 3]
        if after[:1] in ("!", "?"):
            close = "-->" if html.startswith("<!--", lt) else ">"
            end = html.find(close, lt + 2)
            at = len(html) if end < 0 else end + len(close)
        elif not re.match(r"/?[a-zA-Z]", after):
            text.append("<")
            at = lt + 1
        else:
            m = TAG.match(html, lt) if lt < last else None
            if m is None:
                at = len(html)
                break
            at, name = m.end(), m[2].lower()
            raw = RAW.get(name)
            if raw and not m[1]:
                end = raw.search(html, at)
                at = end.end() if end else len(html)
                continue
            yield "".join(text), m[1], name, m[3]
            text.clear()
    text.append(html[at:])
    yield "".join(text), "", "", ""


def blocks(html: str) -> list[tuple[tuple, str, float]]:
    """(path, text, linked share) of the leaf blocks; a path is a tuple of element names and marks."""
    stack: list[tuple[str, tuple]] = []
    out, text, linked = [], [], 0

    def close() -> None:
        nonlocal linked
        flat = " ".join(unescape("".join(text)).split())
        if flat:
            out.append((tuple(m for _, marks in stack for m in marks), flat, min(1.0, linked / len(flat))))
        text.clear()
        linked = 0

    def add(part: str) -> None:
        nonlocal linked
        text.append(part)
        if any(t == "a" for t, _ in stack):
            linked += len(part)

    for before, end, tag, rest in tags(html):
        if before:
            add(before)
        if tag == "br":
            text.append(" ")
        elif end:
            names = [t for t, _ in stack]
            if tag in names:
                k = len(names) - 1 - names[::-1].index(tag)
                if any(t not in INLINE for t in names[k:]):
                    close()
                del stack[k:]
        elif tag:
            if tag not in INLINE:
                close()
                enders = ENDS.get(tag, ())
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] in enders:
                        del stack[k:]
                        break
                    if stack[k][0] not in INLINE and stack[k][0] != "p":
                        break
            if tag not in VOID and not rest.rstrip().endswith("/"):
                stack.append((tag, marks(tag, rest)))
                del stack[DEPTH:]
    close()
    return out


def marks(tag: str, rest: str) -> tuple:
    """Name of an element and the words of its class, id and role."""
    if "=" not in rest:
        return (f"<{tag}",)
    words = [w for _, a, b, c in ATTRIBUTE.findall(rest) for w in re.split(r"[\s_-]+", (a or b or c).lower()) if w]
    return (f"<{tag}", *words)


def features(page: list[tuple[tuple, str, float]], memo: dict) -> np.ndarray:
    """(blocks, INPUT) descriptions."""
    x = np.zeros((len(page), INPUT), np.float32)
    for i, (path, text, linked) in enumerate(page):
        places = memo.get(path)
        if places is None:
            # The last element counts twice: as an ancestor and as the leaf.
            leaf = [p for p in path if p[0] == "<"][-1:]
            names = {*path, *(f"leaf {p}" for p in leaf)}
            places = memo[path] = np.array([crc32(n.encode("utf-8", "surrogatepass")) % PATH for n in names], np.int64)
        x[i, places] = 1
        words = text.lower().split()
        h = np.bincount([crc32(w.encode("utf-8", "surrogatepass")) % WORDS for w in words], minlength=WORDS)
        x[i, PATH:PATH + WORDS] = h / np.sqrt((h * h).sum())
        x[i, PATH + WORDS:] = (min(1.0, np.log1p(len(words)) / 6), linked, i / len(page), text[-1:] in ".!?")
    return x


def teacher(page: list[tuple[tuple, str, float]]) -> np.ndarray:
    """Labels from semantic elements, for training pages as they are."""
    inside = [{"<article", "<main"} & set(p) or (MAIN_NAMES & set(p)) for p, _, _ in page]
    any_main = any(inside)
    label = np.zeros(len(page))
    for i, (path, text, linked) in enumerate(page):
        boiler = any((p[1:] in BOILER_TAGS) if p[0] == "<" else (p in BOILER_NAMES) for p in path)
        label[i] = not boiler and (bool(inside[i]) if any_main else linked < 0.5)
    return label


def composed(page: list[tuple[tuple, str, float]], rng: np.random.Generator) -> tuple[list, np.ndarray] | None:
    """A layout made from a page's blocks with known labels."""
    label = teacher(page)
    main = [(p, t) for (p, t, _), y in zip(page, label) if y]
    rest = [t for (_, t, _), y in zip(page, label) if not y]
    if not main:
        return None
    pick = lambda options: options[int(rng.integers(len(options)))]
    boiler = sorted(BOILER_NAMES)
    words = [w for _, t in main for w in t.split()] + [w for t in rest for w in t.split()]

    def some(n: int) -> str:
        a = int(rng.integers(max(1, len(words) - n)))
        return " ".join(words[a:a + n])

    def extra(around: tuple) -> list:
        kind = int(rng.integers(5))
        if kind == 0:   # a menu of links
            box = pick([("<nav",), ("<div", "menu"), ("<header", "<nav"), ("<ul", "nav"), ("<div", "breadcrumb"), ("<menu",)])
            return [((*around, *box, "<ul", "<li", "<a"), some(int(rng.integers(1, 3))), 1.0) for _ in range(int(rng.integers(2, 8)))]
        if kind == 1:   # reader comments, whole sentences
            box = pick([("<div", "comments"), ("<section", "comments"), ("<ol", "comment", "list"), ("<div", "comment"),
                        ("<section", "discussion"), ("<div", "responses"), ("<section", "responses"), ("<ul", "replies"),
                        ("<div", "feedback"), ("<div", "reader", "feedback"), ("<div", "reactions"), ("<ol", "remarks")])
            return [((*around, *box, pick(["<p", "<div", "<li"])), some(int(rng.integers(3, 30))) + ".", 0.0) for _ in range(int(rng.integers(1, 5)))]
        if kind == 2:
            box = pick([("<aside",), ("<footer",), ("<header",), ("<form",), ("<dialog",), ("<button",), ("<form", "<label")])
        else:
            box = (pick(["<div", "<section", "<ul", "<p", "<span"]), pick(boiler))
        leaf = pick([(), ("<p",), ("<div",), ("<a",), ("<h1",), ("<h2",), ("<p", "<a")])
        return [((*around, *box, *leaf), some(int(rng.integers(1, 25))), float("<a" in leaf)) for _ in range(int(rng.integers(1, 4)))]

    def unnamed() -> str:     # a class that tells nothing
        return "".join(pick("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(int(rng.integers(1, 8))))

    home = pick([("<div", unnamed()), ("<div", unnamed(), unnamed()), ("<div", unnamed(), "<div", unnamed()),
                 ("<section", unnamed()), ("<div",), ("<article",), ("<main",), ("<main", "<article"), ("<div", "content"), ("<div", "post", "content"),
                 (), ("<div", "main"), ("<section", "article", "body"), ("<div", "entry"), ("<div", "story")])
    outer = pick([("<html", "<body"), ("<html", "<body", "<div", "wrapper"), ("<html", "<body", "<div", "page"),
                  ("<html", "<body", "<div", "container"), ("<body",), ()])
    out, y = [], []
    for _ in range(int(rng.integers(1, 4))):
        more = extra(outer)
        out += more
        y += [0] * len(more)
    for path, text in main:
        names = [p for p in path if p[0] == "<"]
        leaf = names[-1] if names and names[-1] in ("<p", "<h1", "<h2", "<h3", "<li", "<b", "<pre", "<blockquote", "<td") else "<p"
        out.append(((*outer, *home, leaf), text, 0.0))
        y.append(1)
        if rng.random() < 0.1:
            more = extra((*outer, *home))
            out += more
            y += [0] * len(more)
    for _ in range(int(rng.integers(1, 4))):
        more = extra(outer)
        out += more
        y += [0] * len(more)
    return out, np.array(y, float)


class Labeller:
    """Bidirectional LSTM with a logistic output per block."""

    def __init__(self, seed: int = 5):
        rng = np.random.default_rng(seed)
        h = HIDDEN
        self.w = [rng.normal(0, 0.1, (INPUT, 4 * h)) for _ in range(2)]
        self.u = [rng.normal(0, 0.15, (h, 4 * h)) for _ in range(2)]
        self.b = [np.concatenate((np.zeros(h), np.ones(h), np.zeros(2 * h))) for _ in range(2)]
        self.v, self.c, self.skip = rng.normal(0, 0.2, 2 * h), np.zeros(1), np.zeros(INPUT)

    def parameters(self) -> list[np.ndarray]:
        return [*self.w, *self.u, *self.b, self.v, self.c, self.skip]

    def sweep(self, x: np.ndarray, live: np.ndarray, d: int, keep: bool = False):
        """Hidden states (time, rows, HIDDEN) of one direction; padded steps keep the state."""
        steps, n, _ = x.shape
        h, c = np.zeros((n, HIDDEN), x.dtype), np.zeros((n, HIDDEN), x.dtype)
        z0 = x @ self.w[d] + self.b[d]
        out, trace = np.zeros((steps, n, HIDDEN), x.dtype), {}
        for t in (range(steps) if d == 0 else range(steps - 1, -1, -1)):
            z = z0[t] + h @ self.u[d]
            g = 1 / (1 + np.exp(-np.clip(z[:, :3 * HIDDEN], -30, 30)))
            i, f, o = g[:, :HIDDEN], g[:, HIDDEN:2 * HIDDEN], g[:, 2 * HIDDEN:]
            a = np.tanh(z[:, 3 * HIDDEN:])
            m = live[t][:, None]
            nc = np.where(m, f * c + i * a, c)
            th = np.tanh(nc)
            nh = np.where(m, o * th, h)
            if keep:
                trace[t] = (i, f, o, a, c, h, th, m)
            h, c = nh, nc
            out[t] = h
        return (out, trace) if keep else out

    def logits(self, x: np.ndarray, live: np.ndarray) -> np.ndarray:
        both = np.concatenate([self.sweep(x, live, 0), self.sweep(x, live, 1)], axis=2)
        return both @ self.v + x @ self.skip + self.c

    def gradients(self, x: np.ndarray, live: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        runs = [self.sweep(x, live, d, keep=True) for d in (0, 1)]
        both = np.concatenate([r[0] for r in runs], axis=2)
        p = 1 / (1 + np.exp(-np.clip(both @ self.v + x @ self.skip + self.c, -30, 30)))
        err = (p - y) * live / live.sum()
        gw, gu, gb = [], [], []
        for d in (0, 1):
            trace, steps = runs[d][1], x.shape[0]
            down = err[..., None] * self.v[d * HIDDEN:(d + 1) * HIDDEN]
            dh, dc = np.zeros_like(down[0]), np.zeros_like(down[0])
            dz = np.zeros((*x.shape[:2], 4 * HIDDEN))
            du = np.zeros_like(self.u[d])
            for t in (range(steps - 1, -1, -1) if d == 0 else range(steps)):
                i, f, o, a, c0, h0, th, m = trace[t]
                dh = dh + down[t]
                on_h, on_c = dh * m, dc * m
                on_c = on_c + on_h * o * (1 - th * th)
                z = np.concatenate((on_c * a * i * (1 - i), on_c * c0 * f * (1 - f), on_h * th * o * (1 - o),
                                    on_c * i * (1 - a * a)), axis=1)
                dz[t] = z
                du += h0.T @ z
                dh, dc = z @ self.u[d].T + dh * ~m, on_c * f + dc * ~m
            flat = dz.reshape(-1, 4 * HIDDEN)
            gw.append(x.reshape(-1, INPUT).T @ flat)
            gu.append(du)
            gb.append(flat.sum(axis=0))
        return [*gw, *gu, *gb, (both * err[..., None]).sum(axis=(0, 1)), np.array([err.sum()]),
                (x * err[..., None]).sum(axis=(0, 1))]


def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(time, pages, INPUT) features and which of them are blocks."""
    x = np.zeros((max(map(len, pages)), len(pages), pages[0].shape[1]), pages[0].dtype)
    live = np.zeros(x.shape[:2], bool)
    for i, p in enumerate(pages):
        x[:len(p), i], live[:len(p), i] = p, True
    return x, live


def train(htmls: list[str]) -> Labeller:
    rng, memo = np.random.default_rng(17), {}
    data = []
    for html in htmls:
        page = blocks(html)
        if not page:
            continue
        variants = [(page, teacher(page))] + [composed(page, rng) for _ in range(LAYOUTS)]
        variants.append(([((), page[int(rng.integers(len(page)))][1], 0.0)], np.ones(1)))   # a page without elements
        data += [(features(b, memo)[:WINDOW].astype(np.float64), y[:WINDOW]) for b, y in filter(None, variants)]
    if not data:
        raise ValueError("no training page holds a block")
    model = Labeller()
    state = [(np.zeros_like(p), np.zeros_like(p)) for p in model.parameters()]
    k = 0
    for r in range(ROUNDS):
        # Pages of like length share a batch; the order of the batches is drawn.
        order = sorted(range(len(data)), key=lambda i: (len(data[i][1]), i))
        batches = [order[i:i + 24] for i in range(0, len(order), 24)]
        for at in rng.permutation(len(batches)):
            x, live = padded([data[i][0] for i in batches[at]])
            y = padded([data[i][1][:, None] for i in batches[at]])[0][..., 0]
            k += 1
            rate = 0.012 * min(1.0, 2 * (1 - r / ROUNDS) + 0.1)
            for p, g, (m, v) in zip(model.parameters(), model.gradients(x, live, y), state):
                m *= 0.9
                m += 0.1 * g
                v *= 0.99
                v += 0.01 * g * g
                p -= rate * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-8)
    for group in (model.w, model.u, model.b):
        group[:] = [a.astype(np.float32) for a in group]
    model.v, model.c, model.skip = (a.astype(np.float32) for a in (model.v, model.c, model.skip))
    return model


def extract(htmls: list[str | None], model: Labeller, memo: dict) -> list[str]:
    """Main text of each page."""
    pages = [blocks(h) if h else [] for h in htmls]
    texts = [""] * len(pages)
    order = sorted((i for i, p in enumerate(pages) if p), key=lambda i: len(pages[i]))
    start = 0
    while start < len(order):
        # Pages of like length are read together, while the padded block stays small.
        stop = start + 1
        while (stop < len(order) and stop - start < SCORED and len(pages[order[stop]]) * (stop - start) < 20_000
               and len(pages[order[stop]]) <= READ):
            stop += 1
        part = order[start:stop]
        if len(pages[part[0]]) > READ:
            scores = [windowed(features(pages[i], memo), model) for i in part]
        else:
            x, live = padded([features(pages[i], memo) for i in part])
            z = model.logits(x, live)
            scores = [z[:len(pages[i]), k] for k, i in enumerate(part)]
        for i, z in zip(part, scores):
            texts[i] = " ".join(t for (_, t, _), s in zip(pages[i], z) if s > 0)
        start = stop
    return texts


def windowed(x: np.ndarray, model: Labeller) -> np.ndarray:
    """Scores of a long page: windows of ``READ`` blocks, each read with ``LAP`` more on either side."""
    out = np.empty(len(x), np.float32)
    for a in range(0, len(x), READ):
        lo = max(0, a - LAP)
        part, live = padded([x[lo:a + READ + LAP]])
        out[a:a + READ] = model.logits(part, live)[a - lo:a - lo + len(out[a:a + READ]), 0]
    return out


def fit(pages: DataFrame, id_col: str, html_col: str) -> Labeller:
    known = pages.select(F.col(id_col).alias("k"), F.col(html_col).alias("html")).filter(F.length("html") > 0)
    holds = F.udf(lambda html: bool(blocks(html)), "boolean")
    # Pages with a block are searched for only where the first draw holds none.
    for source in (known, known.filter(holds("html"))):
        # The share drawn varies a little around the bound; the sort makes the order the same on every run.
        rows = sorted(r["html"] for r in bounded_sample(source, F.col("k"), MAX_TRAIN).select("html").collect())
        if any(blocks(html) for html in rows):
            return train(rows)
    return Labeller()   # no page holds a block, so none is labelled


def main_text(pages: DataFrame, id_col: str = "page_id", html_col: str = "html",
              keep: tuple[str, ...] = ()) -> DataFrame:
    """Per row: id, the columns ``keep``, text."""
    model = fit(pages, id_col, html_col)

    @F.pandas_udf("string")
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        memo: dict = {}
        for htmls in batches:
            rows = htmls.tolist()
            out: list[str] = []
            for i in range(0, len(rows), 512):
                out += extract(rows[i:i + 512], model, memo)
                if len(memo) > 50_000:
                    memo.clear()
            yield pd.Series(out, dtype=object)

    return pages.select(F.col(id_col), *[F.col(c) for c in keep], text(F.col(html_col)).alias("text"))
