"""Main text of web pages: flat text blocks classified by a decision tree.

A page is cut at block tags into flat text blocks. A block has its word count and link density, those of its two
neighbours, whether it is a heading, whether it lies in an article (or main) element, whether the page has one, and
whether it lies in an element that announces other content (navigation, footer, form, an advert or comment class and
so on). A decision tree, grown on the small labelled table below, keeps a block or drops it. Inside an article element
words alone don't decide, as a short paragraph looks like a notice; lists of links there are dropped by the densities of
the block and both neighbours. On pages without such an element counts and densities decide.

Defined cases: null, empty and tag-only pages give an empty text; unclosed tags, comments and scripts end with the
page; a "<" that opens no tag is text; repeated rows get a row each; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import flat

# Elements by their part in a page.
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark meter picture q ruby rt rp s samp small source span strike strong sub sup time track tt u var wbr".split())
RAW = set("script style noscript template svg math iframe object canvas audio video textarea title".split())
ASIDE = set("nav footer aside form menu dialog select button fieldset head".split())
MAIN = set("article main".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
# Words in class, id and role that announce other content.
HINTS = set("ad ads adv advert adverts advertisement advertising adsbygoogle banner sponsor sponsored sponsors promo promoted promotion sidebar menu nav navbar navigation navi breadcrumb breadcrumbs header masthead topbar footer bottombar comment comments commentlist disqus reply replies respond cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login search share sharing social related recommended recommendations widget widgets toolbar pagination pager paginator skip complementary contentinfo dialog tracking outbrain taboola".split())
# of class names that say an element isn't shown, only whole ones: overflow-hidden or md:hidden don't hide it
HIDDEN = {"hidden", "is-hidden", "visually-hidden"}
GOOD_HINTS = set("article post entry story content main body".split())

LINKY = 0.75
NAMES = ["words", "links", "prev_words", "prev_links", "next_words", "next_links", "heading", "in_main", "has_main", "aside"]
# The labelled table: the features in the order of NAMES, then 1 for main text and 0 for anything else.
TABLE = """
62 0 40 0 55 0 0 1 1 0 1
48 0.1 3 0 70 0 0 1 1 0 1
1 0 60 0 33 0 0 1 1 0 1
2 0 0 0 0 0 0 1 1 0 1
9 0 12 0 80 0 1 1 1 0 1
6 0 5 1 41 0 1 1 1 0 1
3 0 30 0 4 0 0 1 1 0 1
25 0.4 44 0 20 0 0 1 1 0 1
4 1 50 0 39 0 0 1 1 0 1
15 0 1 1 9 0 1 1 1 0 1
130 0 9 0 2 1 0 1 1 0 1
3 1 4 1 2 1 0 1 1 0 0
5 0.8 2 1 6 0.9 0 1 1 0 0
1 1 1 1 1 1 0 0 1 1 0
1 1 0 0 1 1 0 0 1 1 0
14 0 1 1 12 0 0 0 1 1 0
40 0 1 1 9 0 0 0 1 1 0
22 0.05 70 0 0 0 0 0 1 1 0
3 1 2 1 12 0 0 0 1 0 0
18 0 5 1 10 0 0 0 1 0 0
35 0 60 0 0 0 0 0 1 0 0
5 0 0 0 7 0 1 0 1 0 0
8 0 100 0 20 0 0 0 1 0 0
30 0 60 0 45 0 0 1 1 1 0
7 0.9 80 0 5 1 0 1 1 1 0
55 0 70 0 0 0 0 1 1 1 0
12 0 44 0 40 0 1 1 1 1 0
50 0 30 0 44 0 0 0 0 0 1
70 0.08 8 0 61 0 0 0 0 0 1
28 0.15 60 0 75 0 0 0 0 0 1
16 0 45 0 12 0 0 0 0 0 1
12 0 55 0 66 0 0 0 0 0 1
6 0 70 0 62 0 0 0 0 0 1
7 0 2 1 58 0 1 0 0 0 1
9 0 64 0 47 0 1 0 0 0 1
33 0.2 3 1 40 0 0 0 0 0 1
1 1 1 1 1 1 0 0 0 0 0
2 1 3 1 2 1 0 0 0 0 0
4 0.8 1 1 3 1 0 0 0 0 0
12 0.9 5 1 20 0.8 0 0 0 0 0
20 0.7 2 1 30 0 0 0 0 0 0
3 0 2 1 2 1 0 0 0 0 0
5 0 3 1 0 0 0 0 0 0 0
2 0 4 0 3 0 0 0 0 0 0
6 0.5 50 0 2 1 0 0 0 0 0
40 0.6 10 1 6 1 0 0 0 0 0
8 0 3 1 4 0 1 0 0 0 0
45 0 2 1 50 0 0 0 0 1 0
1 1 1 1 1 1 0 0 0 1 0
20 0 66 0 0 0 0 0 0 1 0
60 0.1 5 0 12 0 0 0 0 1 0
10 0 0 0 45 0 1 0 0 1 0
25 0 1 0 1 1 0 0 0 0 1
22 0 1 0 25 0 0 0 0 0 1
18 0.1 3 0 2 0 0 0 0 0 1
15 0 2 1 3 1 0 0 0 0 1
30 0 1 0 0 0 0 0 0 0 1
27 0.2 1 0 1 0 0 0 0 0 1
90 0 1 1 1 1 0 0 0 0 1
11 0 1 0 2 0 0 0 0 0 1
1 0 22 0 25 0 0 0 0 0 1
2 0 15 0 18 0 0 0 0 0 1
3 0 1 0 1 1 0 0 0 0 0
14 0.8 3 1 2 1 0 0 0 0 0
"""


def labelled() -> tuple[np.ndarray, np.ndarray]:
    """The table and its variations: where an element tells a block's part, its size and neighbours are any in the
    table, but a block of links among blocks of links is none of the main text even there; elsewhere the counts vary by
    a third."""
    rows = np.array([[float(v) for v in line.split()] for line in TABLE.strip().splitlines()])
    told = (rows[:, 7] > 0) | (rows[:, 8] > 0) | (rows[:, 9] > 0)
    out = [rows]
    linky = (rows[:, [1, 3, 5]] >= LINKY).all(axis=1)
    for r in rows[told & ~linky]:
        more = rows[:, :7].copy()
        told_rows = np.column_stack([more, np.repeat(r[None, 7:], len(more), axis=0)])
        told_rows[(more[:, [1, 3, 5]] >= LINKY).all(axis=1), -1] = 0
        out.append(told_rows)
    for k in (0.7, 1.3):
        more = rows[~told].copy()
        more[:, [0, 2, 4]] = np.ceil(more[:, [0, 2, 4]] * k)
        out.append(more)
    rows = np.concatenate(out)
    return rows[:, :-1], rows[:, -1]


def grow(x: np.ndarray, y: np.ndarray, depth: int = 8) -> tuple:
    """A Gini decision tree: (feature, cut, low branch, high branch) or (label,)."""
    if depth == 0 or y.min() == y.max():
        return (float(y.mean() >= 0.5),)
    best = None
    for j in range(x.shape[1]):
        v = np.unique(x[:, j])
        for c in (v[1:] + v[:-1]) / 2:
            low = x[:, j] <= c
            gini = sum(len(p) * p.mean() * (1 - p.mean()) for p in (y[low], y[~low]))
            if best is None or gini < best[0] - 1e-12:
                best = gini, j, c
    if best is None:
        return (float(y.mean() >= 0.5),)
    _, j, c = best
    low = x[:, j] <= c
    return j, float(c), grow(x[low], y[low], depth - 1), grow(x[~low], y[~low], depth - 1)


def classify(tree: tuple, x: np.ndarray) -> np.ndarray:
    if len(tree) == 1:
        return np.full(len(x), tree[0] > 0)
    low = x[:, tree[0]] <= tree[1]
    out = np.zeros(len(x), dtype=bool)
    out[low] = classify(tree[2], x[low])
    out[~low] = classify(tree[3], x[~low])
    return out


# No backtracking and at most 512 runs and quoted values in a tag, so that a page of stray quotes takes linear time; a tag
# beyond that ends at the next ">".
TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+'){0,512}+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>""", re.S)
OPEN_END = re.compile(r"<!.*|<\?.*", re.S)
ATTR = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
UNSEEN = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.I)
WORD = re.compile(r"[a-z]+|[A-Z][a-z]*")


def _hint(attrs: str) -> int:
    """-1: the element isn't shown, or class, id or role announce other content; 1: main text; 0: neither."""
    out = 0
    for m in ATTR.finditer(attrs):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name == "hidden" or name == "aria-hidden" and value.strip().lower() == "true" or name == "style" and UNSEEN.search(value):
            return -1
        if name not in ("class", "id", "role"):
            continue
        if HIDDEN & set(value.lower().split()):
            return -1
        words = {w.lower() for w in WORD.findall(value)}
        if words & HINTS:
            return -1
        if words & GOOD_HINTS:
            out = 1
    return out


def blocks(page: str) -> tuple[list[str], np.ndarray]:
    """Text blocks in page order, and their features."""
    texts, rows = [], []
    stack: list[tuple[str, int, bool]] = []  # container, 1 for main text, announces other content
    parts: list[str] = []
    linked = heading = 0
    in_link = in_head = False
    main = other = 0
    has_main = False

    def flush():
        nonlocal parts, linked
        text = " ".join("".join(parts).split())
        parts = []
        if text:
            texts.append(text)
            n = len(text.split(" "))
            rows.append([n, min(1.0, linked / len(text)), 0, 0, 0, 0, in_head, main > 0, 0, other > 0])
        linked = 0

    def say(raw: str):
        nonlocal linked
        if raw:
            text = entities.unescape(raw)
            parts.append(text)
            if in_link:
                linked += len(" ".join(text.split()))

    at, size, last = 0, len(page), page.rfind(">")
    opened: Counter[str] = Counter()
    while at < size:
        # behind the last ">" only a comment or a declaration that ends with the page is no text
        m = TAG.search(page, at) if at <= last else OPEN_END.search(page, at)
        if m is None:
            say(page[at:])
            break
        say(page[at : m.start()])
        at = m.end()
        name = (m[2] or m[5] or "").lower() if m.re is TAG else ""
        if not name:
            continue
        closing, attrs = bool(m[1] or m[4]), m[3] or m[6] or ""
        if name in RAW and not closing:
            if not attrs.rstrip().endswith("/"):
                end = re.compile(rf"</{re.escape(name)}\b", re.I).search(page, at)
                at = page.find(">", end.end()) + 1 if end else 0
                at = at or size
            if name != "title":
                parts.append(" ")
            continue
        if name == "a":
            in_link = not closing
        if name in INLINE:
            continue
        if name == "br":
            parts.append(" ")
            continue
        flush()
        if name in ("h1", "h2", "h3", "h4", "h5", "h6"):
            in_head = not closing
        elif name in ("p", "li", "td", "div"):
            in_head = False
        in_link = in_link and name == "a"
        if name in VOID or name in ("p", "li", "td", "th", "tr", "option", "dt", "dd", "h1", "h2", "h3", "h4", "h5", "h6") and not (attrs and _hint(attrs) < 0) and not closing:
            continue
        if not closing:
            if attrs.rstrip().endswith("/"):
                continue
            if name in ("body", "html"):
                continue
            hint = _hint(attrs) if attrs else 0
            bad = name in ASIDE or name == "header" and not main or hint < 0
            good = (name in MAIN or hint > 0) and not bad
            has_main |= good
            stack.append((name, int(good), bad))
            opened[name] += 1
            main, other = main + good, other + bad
        elif opened[name]:
            while True:
                top = stack.pop()
                opened[top[0]] -= 1
                main, other = main - top[1], other - top[2]
                if top[0] == name:
                    break
    flush()
    x = np.array(rows, dtype=float).reshape(-1, len(NAMES))
    if len(x):
        x[1:, 2:4], x[:-1, 4:6] = x[:-1, :2], x[1:, :2]
        x[:, 8] = has_main
    return texts, x


def _extract(tree: tuple):
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def run(batches):
        for b in flat.slices(batches, "html"):
            out = []
            for page in b.column("html").to_pylist():
                texts, x = blocks(page) if page else ([], None)
                out.append(" ".join(t for t, k in zip(texts, classify(tree, x).tolist(), strict=True) if k) if texts else "")
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())], schema=schema)

    return run


def extract(pages: DataFrame) -> DataFrame:
    """Per row of ``pages`` (page_id, url, html): page_id, url, text, n_chars."""
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return pages.mapInArrow(_extract(grow(*labelled())), "page_id long, url string, text string, n_chars long")
