"""Main text of web pages by gradient-boosted trees over DOM nodes.

A page becomes a tree of its block elements.  Each node has features: its tag
and those above it, tokens of class, id and role (its own and inherited),
depth, density of text and links in its subtree, its share of its parent's and
of the page's text, and what its siblings are like.  Boosted trees give each
node a probability of being main text.  Decoding is hierarchical: on any way
from the root, nodes are first `outside`, then `main`, then `cut`, and never
go back; the likeliest such labelling of the whole tree is found exactly by
dynamic programming, so no choice contradicts that of an ancestor.

The trees are learnt from `example_pages`: pages made by rule in many layouts,
the same every time, PAGES of them.  The rule that makes a page also says which
element is its main part and which branches inside it are not of it (adverts,
side bars, forms, comments, menus), with or without names that tell; labels
come from there, not from names.  Headings are main text, and so is a header
element inside the main part; the page's own header is not.

Text: character references are decoded, white space in a block becomes one
space, blocks are trimmed and joined in page order by one line end; a line
break element is white space.  Scripts, styles, templates, titles, comments
and markup are never text.

Nulls, empty and long pages: null and empty html gives an empty text; pages
are read whole; broken markup and a tag cut off by the end of the page are
read as browsers do.  Repeated rows give repeated results; an empty table
gives no rows.  Null ids and urls stay null.  Other columns are never looked at.
"""

from __future__ import annotations

import html as entities
import re
import uuid
from math import log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from sluice.llm.batches import arrow_map, held, table

PAGES, TREES, DEPTH, RATE, BINS = 500, 40, 4, 0.25, 32
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<[a-zA-Z/!?][^>]*+(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"\b(class|id|role|itemprop|aria-label)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
#: Kinds of elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("script style template noscript title svg math iframe object head".split())
BLOCKS = frozenset("address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup html legend li main menu nav ol optgroup option p pre section select summary table tbody td textarea tfoot th thead tr ul".split())
CLOSES = {
    "li": ("li", ("ul", "ol", "menu", "dir")),
    "dt": ("dt dd", ("dl",)),
    "dd": ("dt dd", ("dl",)),
    "tr": ("tr td th", ("table", "tbody", "thead", "tfoot")),
    "td": ("td th", ("tr",)),
    "th": ("td th", ("tr",)),
    "option": ("option", ("select",)),
    "tbody": ("tbody thead tfoot tr td th", ("table",)),
    "tfoot": ("tbody thead tfoot tr td th", ("table",)),
}
TAGS = (
    "nav",
    "header",
    "footer",
    "aside",
    "form fieldset button select textarea option legend",
    "article main",
    "p",
    "ul ol menu dl",
    "li dt dd",
    "h1 h2 h3 h4 h5 h6",
    "div section",
    "table tbody tr td th",
    "blockquote pre figure figcaption",
)
MARKS = (
    "nav navbar navigation menu breadcrumb breadcrumbs tabs toolbar pagination pager toc",
    "ad ads advert adverts advertisement sponsor sponsored promo banner promotion",
    "comment comments disqus reply replies respond discussion feedback",
    "notice cookie cookies consent alert popup modal newsletter subscribe signup gdpr warning overlay",
    "sidebar side aside widget related recommended share social tags rail",
    "footer foot bottom copyright legal colophon contentinfo",
    "header head masthead top logo brand site",
    "search login form contact",
    "content article main post entry story body text articlebody prose page",
)
_TAG = {t: i for i, ts in enumerate(TAGS) for t in ts.split()}
_MARK = {t: i for i, ts in enumerate(MARKS) for t in ts.split()}
OUTSIDE, MAIN, CUT = 0, 1, 2


class Page:
    """The block elements of a page in document order, and its runs of text."""

    def __init__(self, source: str):
        self.tag, self.parent, self.marks, self.depth = ["html"], [-1], [0], [0]
        self.runs: list[tuple[int, str, int]] = []  # node, text, letters inside links
        self._read(source)

    def _read(self, source: str) -> None:
        stack, text, linked, in_link, at, end = [0], [], 0, False, 0, len(source)
        search = TOKEN.search

        def flush():
            nonlocal linked
            if text:
                whole = " ".join(entities.unescape("".join(text)).split())
                if whole:
                    self.runs.append((stack[-1], whole, min(linked, len(whole))))
                text.clear()
            linked = 0

        while at < end:
            m = search(source, at)
            if m is None:
                text.append(source[at:])
                if in_link:
                    linked += end - at
                break
            if m.start() > at:
                text.append(source[at : m.start()])
                if in_link:
                    linked += m.start() - at
            at = m.end()
            name = m.group(2)
            if name is None:
                continue
            name = name.lower()
            if m.group(1):
                if name == "a":
                    in_link = False
                elif name in BLOCKS:
                    flush()
                    for k in range(len(stack) - 1, 0, -1):
                        if self.tag[stack[k]] == name:
                            del stack[k:]
                            in_link = False
                            break
                continue
            if name == "br":
                text.append(" ")
            elif name == "a":
                in_link = True
            elif name in SILENT and name != "head":
                close = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I).search(source, at) if not m.group(3).endswith("/") else None
                at = close.end() if close else (end if name in ("script", "style", "title") else at)
            elif name in BLOCKS:
                flush()
                in_link = False
                if name in ("html", "body"):
                    if name == "html" or any(self.tag[x] == "body" for x in stack):
                        continue
                if name not in ("button", "option", "select", "optgroup") and self.tag[stack[-1]] == "p":
                    stack.pop()
                if name in CLOSES:
                    shut, until = CLOSES[name]
                    for k in range(len(stack) - 1, 0, -1):
                        t = self.tag[stack[k]]
                        if t in until:
                            break
                        if t in shut.split():
                            del stack[k:]
                            break
                self.tag.append(name)
                self.parent.append(stack[-1])
                self.depth.append(len(stack))
                marks = 0
                if m.group(3):
                    for _, value in ATTRIBUTE.findall(m.group(3)):
                        for token in NAME.findall(value):
                            if (k := _MARK.get(token.lower())) is not None:
                                marks |= 1 << k
                self.marks.append(marks)
                stack.append(len(self.tag) - 1)
            elif name == "hr":
                flush()
        flush()

    def features(self) -> np.ndarray:
        """A row per node."""
        n, parent = len(self.tag), self.parent
        own, links, stops, nodes = [0] * n, [0] * n, [0] * n, [1] * n
        for node, text, linked in self.runs:
            own[node] += len(text)
            links[node] += linked
            stops[node] += text.count(".") + text.count(",")
        below = own.copy()
        kids = [0] * n
        seen: list[dict] = [{} for _ in range(n)]
        for i in range(n - 1, 0, -1):
            p = parent[i]
            below[p] += below[i]
            links[p] += links[i]
            stops[p] += stops[i]
            nodes[p] += nodes[i]
            kids[p] += 1
            seen[p][self.tag[i]] = seen[p].get(self.tag[i], 0) + 1
        tags, marks = [1 << _TAG[t] if t in _TAG else 0 for t in self.tag], self.marks
        over_t, over_m, order = [0] * n, [0] * n, [0] * n
        count = [0] * n
        rows = []
        page = max(1, below[0])
        for i in range(n):
            p = parent[i]
            if p >= 0:
                over_t[i], over_m[i] = over_t[p] | tags[p], over_m[p] | marks[p]
                order[i] = count[p]
                count[p] += 1
            k = kids[p] if p >= 0 else 1
            around = below[p] if p >= 0 else page
            rows.append((
                tags[i],
                over_t[i],
                marks[i],
                over_m[i],
                self.depth[i],
                log1p(own[i]),
                log1p(below[i]),
                links[i] / max(1, below[i]),
                below[i] / nodes[i],
                below[i] / page,
                below[i] / max(1, around),
                k,
                (seen[p][self.tag[i]] if p >= 0 else 1) / k,
                log1p(around / k),
                order[i] / k,
                i / n,
                stops[i] / max(1, below[i]),
                kids[i],
            ))
        x = np.array(rows, float)
        bits = lambda c, k: (x[:, c].astype(np.int64)[:, None] >> np.arange(k)) & 1
        return np.column_stack([bits(0, len(TAGS)), bits(1, len(TAGS)), bits(2, len(MARKS)), bits(3, len(MARKS)), x[:, 4:]])

    def decoded(self, p: np.ndarray) -> list[int]:
        """The likeliest labels of all nodes that never go back from main to outside or from cut to main."""
        n, parent = len(self.tag), self.parent
        p = np.clip(p, 1e-6, 1 - 1e-6)
        yes, no = np.log(p).tolist(), np.log(1 - p).tolist()
        best = [[no[i], yes[i], no[i]] for i in range(n)]
        pick = [[0, 0, 0] for _ in range(n)]
        for i in range(n - 1, 0, -1):
            out, main, cut = best[i]
            inside = MAIN if main >= cut else CUT
            first = OUTSIDE if out >= main else MAIN  # a branch without main text is outside throughout
            pick[i] = [first, inside, CUT]
            up = best[parent[i]]
            up[OUTSIDE] += best[i][first]
            up[MAIN] += best[i][inside]
            up[CUT] += cut
        label = [OUTSIDE] * n
        label[0] = OUTSIDE if best[0][OUTSIDE] >= best[0][MAIN] else MAIN
        for i in range(1, n):
            label[i] = pick[i][label[parent[i]]]
        return label

    def text(self, p: np.ndarray) -> str:
        label = self.decoded(p)
        return "\n".join(t for node, t, _ in self.runs if label[node] == MAIN)


class Boosted:
    """Gradient-boosted trees for a probability; every tree is complete, of DEPTH levels."""

    def __init__(self, bias: float, feature: np.ndarray, threshold: np.ndarray, leaf: np.ndarray):
        self.bias, self.feature, self.threshold, self.leaf = bias, feature, threshold, leaf

    @classmethod
    def fitted(cls, x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = RATE, l2: float = 1.0) -> Boosted:
        edges = [np.unique(np.quantile(c, np.arange(1, BINS) / BINS)) for c in x.T]
        bins = np.column_stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T)]).astype(np.int64)
        m = x.shape[1]
        bias = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
        margin = np.full(len(y), bias)
        features, thresholds, leaves = [], [], []
        for _ in range(trees):
            p = 1 / (1 + np.exp(-margin))
            g, h = y - p, p * (1 - p)
            node = np.zeros(len(y), np.int64)
            feature, threshold = np.zeros(2**depth - 1, np.int64), np.full(2**depth - 1, np.inf)
            for level in range(depth):
                k = 2**level
                local = node - (k - 1)
                cell = ((local[:, None] * m + np.arange(m)) * BINS + bins).ravel()
                gs, hs = (np.bincount(cell, np.repeat(v, m), k * m * BINS).reshape(k, m, BINS).cumsum(2) for v in (g, h))
                total_g, total_h = gs[:, :, -1:], hs[:, :, -1:]
                gain = gs**2 / (hs + l2) + (total_g - gs) ** 2 / (total_h - hs + l2) - total_g**2 / (total_h + l2)
                gain[(hs < 1) | (total_h - hs < 1)] = 0
                best = gain.reshape(k, -1).argmax(1)
                for j in range(k):
                    f, b = divmod(int(best[j]), BINS)
                    if gain[j, f, b] > 1e-9 and b < len(edges[f]):
                        feature[k - 1 + j], threshold[k - 1 + j] = f, edges[f][b]
                node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] > threshold[node])
            end = node - (2**depth - 1)
            leaf = rate * np.bincount(end, g, 2**depth) / (np.bincount(end, h, 2**depth) + l2)
            margin += leaf[end]
            features.append(feature)
            thresholds.append(threshold)
            leaves.append(leaf)
        return cls(bias, np.array(features), np.array(thresholds), np.array(leaves))

    def __call__(self, x: np.ndarray) -> np.ndarray:
        margin, row = np.full(len(x), self.bias), np.arange(len(x))
        depth = self.leaf.shape[1].bit_length() - 1
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[row, feature[node]] > threshold[node])
            margin += leaf[node - (2**depth - 1)]
        return 1 / (1 + np.exp(-margin))


def example_pages(n: int = PAGES, seed: int = 23) -> list[str]:
    """Pages made by rule; the main part's element has a data-main attribute, and branches in it that are not main a data-cut one."""
    rng = np.random.default_rng(seed)
    pick = lambda xs: xs[int(rng.integers(len(xs)))]
    word = lambda: "".join(pick("aeioustnrlmdcphgbvéüñ") for _ in range(int(rng.integers(1, 10))))

    def prose(most: int) -> str:
        out = [word() for _ in range(int(rng.integers(1, most)))]
        end = pick([".", ".", ".", "", " ###", "!!", " |"])
        return " ".join(w + ("," if rng.random() < 0.08 else end if rng.random() < 0.12 else "") for w in out) + end

    def links(k: int, wrap: str = "li") -> str:
        return "".join(f"<{wrap}><a href='/{i}'>{word()}</a></{wrap}>" for i in range(k))

    def menu() -> str:
        body = pick([f"<ul>{links(int(rng.integers(2, 9)))}</ul>", links(5, "span"), f"<ol>{links(4)}</ol>"])
        return pick([
            f"<nav>{body}</nav>",
            f"<div class='{pick(['menu', 'navbar', 'main-nav', 'breadcrumbs'])}'>{body}</div>",
            f"<div id='navigation'>{body}</div>",
            f"<header>{body}<p>{prose(6)}</p></header>",
            f"<div role='navigation'>{body}</div>",
        ])

    def links_only() -> str:
        return f"<div{pick(['', ' class=' + word(), ' id=' + word()])}><p>{word()}</p><ul>{links(int(rng.integers(3, 8)))}</ul></div>"

    def advert() -> str:
        return pick(["<div class='{}'>{}</div>", "<aside class='{}'><p>{}</p></aside>", "<section id='{}'>{}</section>"]).format(
            pick(["ad", "ads top", "sponsored", "advert-box", "promo", "banner"]),
            prose(int(pick([8, 20, 60]))),
        )

    def notice() -> str:
        return f"<div class='{pick(['cookie-banner', 'notice', 'alert', 'newsletter', 'consent popup'])}'><p>{prose(30)}</p>{pick(['', '<button>' + word() + '</button>'])}</div>"

    def side() -> str:
        return pick(["<aside><h3>{0}</h3><ul>{1}</ul><p>{2}</p></aside>", "<div class='sidebar'><h3>{0}</h3><p>{2}</p><ul>{1}</ul></div>", "<div class='related widget'><ul>{1}</ul></div>"]).format(
            prose(4),
            links(5),
            prose(25),
        )

    def form() -> str:
        return f"<form class='{pick(['search', 'contact', 'x'])}'><label>{word()}</label><input name=q><textarea>{word()}</textarea><select><option>{word()}<option>{word()}</select><button>{word()}</button></form>"

    def comments() -> str:
        each = "".join(pick(["<li><b>{0}</b><p>{1}</p></li>", "<div class='comment'><p>{1}</p></div>", "<article class='comment'><p>{1}</p></article>"]).format(
            word(),
            prose(40),
        ) for _ in range(int(rng.integers(1, 6))))
        return pick(["<section class='comments'><h2>{0}</h2>{1}</section>", "<div id='comments'>{1}</div>", "<ol class='comment-list'>{1}</ol>", "<div class='discussion replies'>{1}</div>"]).format(
            word(),
            each,
        )

    def foot() -> str:
        return pick([
            "<footer>{0}</footer>",
            "<footer><p>{0}</p></footer>",
            "<div class='footer'>{0}</div>",
            "<div id='site-footer'><p>{0}</p></div>",
        ]).format("&copy; " + word() + " &middot; " + prose(int(pick([5, 20, 50]))))

    def paragraph() -> str:
        body = prose(int(pick([2, 10, 60, 150])))
        return pick(["<p>{0}</p>"] * 8 + ["<p><b>{0}<br>", "<p>{0}", "<h2>{0}</h2><p>{1}</p>", "<ul><li>{0}</li><li>{1}</li></ul>", "<blockquote><p>{0}</p></blockquote>", "<pre>{0}</pre>", "<table><tr><td>{0}</td><td>{1}</td></tr></table>", "<div>{0}</div>", "<p>{0} <a href='/x'>{1}</a></p>", "<figure><img src=x><figcaption>{0}</figcaption></figure>"]).format(
            body,
            prose(12),
        )

    def main() -> str:
        head = pick(["<h1>{0}</h1>", "<h1>{0}</h1>", "<h1>{0}</h1>", "", "<header><h1>{0}</h1></header>"]).format(prose(14))
        parts = [paragraph() for _ in range(int(pick([1, 1, 2, 4, 8, 16])))]
        for other in [f() for f in (advert, side, form, comments, links_only) if rng.random() < 0.15]:
            parts.insert(int(rng.integers(len(parts) // 2, len(parts) + 1)), re.sub(r"^<(\w+)", r"<\1 data-cut", other))
        body = head + "".join(parts)
        return pick(["<article data-main>{0}</article>"] * 5 + [
            "<main data-main>{0}</main>",
            "<div data-main class='content'>{0}</div>",
            "<div data-main class='post-body entry'>{0}</div>",
            "<div data-main id='story'>{0}</div>",
            "<section data-main class='article-text'>{0}</section>",
            "<div data-main>{0}</div>",
            "<main><article data-main>{0}</article></main>",
            "<div class='page-content'><div data-main class='text'>{0}</div></div>",
        ]).format(body)

    pages = []
    for _ in range(n):
        above = [f() for f in (menu, advert, notice, side, form, menu) if rng.random() < 0.45]
        under = [f() for f in (advert, side, form, comments, notice, menu) if rng.random() < 0.35]
        body = "".join(above) + main() + "".join(under) + (foot() if rng.random() < 0.85 else "")
        if rng.random() < 0.3:
            body = f"<div class='{pick(['wrap', 'container', 'page', 'site'])}'>{body}</div>"
        body = f"<html><head><title>{word()}</title><style>p{{}}</style></head><body>{body}</body></html>"
        pages.append(body[: int(len(body) * rng.uniform(0.5, 1))] if rng.random() < 0.1 else body)
    return pages


def fitted(pages: int = PAGES) -> Boosted:
    """Trees from example pages: nodes of the main part are main but for such branches as menus, adverts, forms and comments."""
    xs, ys = [], []
    for source in example_pages(pages):
        page = Page(source)
        xs.append(page.features())
        ys += example_labels(source, page)
    return Boosted.fitted(np.concatenate(xs), np.array(ys, float))


def _nodes(source: str, attribute: str) -> set[int]:
    """The numbers of the elements with an attribute."""
    return {len(Page(source[: source.find(">", m.start()) + 1]).tag) - 1 for m in re.finditer(f" {attribute}", source)}


def example_labels(source: str, page: Page) -> list[int]:
    """Of each node of an example page, whether it is main text: below the main part and not below a branch that is cut."""
    main, cut = _nodes(source, "data-main"), _nodes(source, "data-cut")
    label = [0] * len(page.tag)
    for i, p in enumerate(page.parent):
        label[i] = int(i in main or (p >= 0 and label[p] and i not in cut))
    return label


def extracted(pages: DataFrame, model: Boosted | None = None) -> DataFrame:
    """page_id, url, text and n_chars of each page."""
    own = model or fitted()
    shared, name = pages.sparkSession.sparkContext.broadcast((own.bias, own.feature, own.threshold, own.leaf)), uuid.uuid4().hex
    kind = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def rows(batches):
        trees = held(("trees", name), lambda: Boosted(*shared.value))
        for batch in batches:
            for a in range(0, batch.num_rows, 200):
                part = batch.slice(a, 200)
                read = [Page(x or "") for x in part.column("html").to_pylist()]
                features = [p.features() for p in read]
                chance = np.split(trees(np.concatenate(features)), np.cumsum([len(f) for f in features])[:-1])
                texts = [p.text(c) for p, c in zip(read, chance)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("page_id").cast(pa.int64()),
                        part.column("url"),
                        pa.array(texts, pa.string()),
                        pa.array([len(t) for t in texts], pa.int64()),
                    ],
                    schema=kind,
                )

    return arrow_map(pages.select("page_id", "url", "html"), rows, "page_id long, url string, text string, n_chars long")


def op8_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return extracted(table(spark, sf_dir, "pages"))
