"""Main text of web pages: boosted trees over DOM nodes, decoded along the hierarchy.

A page is read into a tree of units: every element that isn't plain inline markup.  Each unit has
features of its tag and attribute words, of markers above it, of its subtree (characters, share of
links, length of blocks, tags and punctuation per word, share of the page), of depth and place, and
of its siblings.  Gradient-boosted trees (softmax over three classes, histogram splits) say how
likely a unit is *main* (all of it belongs to the article), *mixed* (the article is somewhere
below) or *other*.  Decoding takes the most likely labelling of the whole tree in which nothing
below *other* is anything else, and nothing below *main* is *mixed*: an advert may be taken out of
an article, but no article text out of an advert.

Training is weakly supervised: on a bounded sample of pages that mark their article with
``article`` or ``main`` (at most ``sample_pages``, of at most ``LONG_PAGE`` characters, by a hash of
id and address), the markup is the label.  So that the trees don't read that one tag only, every
sampled page is also learned in ``variants`` other layouts: its own parts are put together again with
the tags changed to ``div`` with or without speaking class names, wrapped or unwrapped, with
sidebars, comments, notices, forms, related links and adverts made from other sampled pages'
text, some of them inside the article.  The trees are small (``rounds`` x 3 trees of ``DEPTH``
levels) and broadcast; every page is read whole.

Text of main units is cut into blocks at block-level elements; a line break is white space.  White
space inside a block becomes one space, blocks are joined by two line feeds.

Edge cases: null or empty html gives an empty text, as does a page without a main unit; without any
page that marks its article nothing can be learned and all texts are empty; pages may be broken
off anywhere (an unfinished tag is text, an unfinished comment or script ends the page); ids may be
null or repeated; an empty table gives no rows; other columns don't matter.
"""

from __future__ import annotations

import random
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from html import escape, unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daypanel.llm.common import clear, with_fields

LONG_PAGE = 200_000
DEPTH = 4
BINS = 32
MAIN, MIXED, OTHER = 2, 1, 0

# Fixed values of HTML: elements without content, raw text, blocks, inline markup, implied ends.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea template xmp noembed noframes iframe svg math".split())
BLOCK = set("""address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption
figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p
pre search section select summary table tbody td tfoot th thead title tr ul""".split())
INLINE = set("""a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label link mark meta nobr q rp rt ruby s
samp small span strike strong sub sup time tt u var wbr""".split())
ENDS_P = BLOCK - set("button caption dd dt head html body legend li optgroup option select summary tbody td tfoot th thead title tr".split())
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dd": ({"dd", "dt"}, {"dl"}), "dt": ({"dd", "dt"}, {"dl"}),
        "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tr": ({"tr"}, {"table"}),
        "option": ({"option"}, {"select"}), "tbody": ({"tbody", "thead", "tfoot"}, {"table"})}
OTHER_TAGS = set("nav header footer aside form menu dialog button select fieldset noscript head search".split())
MAIN_TAGS = {"article", "main"}
TEXT_TAGS = set("p blockquote pre dd figcaption td th".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
LISTS = set("ul ol dl li dt menu".split())
OTHER_WORDS = set("""ad ads advert adverts advertisement advertising aside banner breadcrumb breadcrumbs byline comment comments
consent cookie cookies copyright dialog discussion disqus follow foot footer form gdpr head header login masthead menu
modal nav navbar navigation newsletter notice overlay pager pagination popup promo promoted promotion recommended related
replies reply respond search share sharing sidebar signup skip social sponsor sponsored subscribe tags toolbar topbar widget""".split())
MAIN_WORDS = set("article articlebody body content entry main post posttext story text".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<raw>.*?)(?:\]\]>|\Z)|<[!?][^>]*>|"
    r"<(?P<end>/?)(?P<tag>[A-Za-z][^\s/<>]*)(?P<attrs>(?:[^<>\"']+|\"[^\"]*\"|'[^']*')*+|[^<>]*+)>", re.S)
_ATTR = re.compile(r"""(?:^|[\s"'])(class|id|role|data-truth)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_RAW_END = {t: re.compile(f"</{t}(?=[\\s/>])", re.I) for t in RAW}


@dataclass
class Page:
    tags: list[str]
    parents: list[int]                       # -1: the root
    marks: list[tuple[int, int, str]]        # other words, main words, truth of a generated layout
    runs: list[tuple[int, int, str, bool]]   # unit, block, text, in a link


def _marks(attrs: str, seen: dict[str, tuple]) -> tuple[int, int, str]:
    got = seen.get(attrs)
    if got is None:
        other = main = 0
        truth = ""
        for name, value in _ATTR.findall(attrs):
            if name == "data-truth":
                truth = value.strip("\"'")
                continue
            words = [w.lower() for w in _WORD.findall(value)]
            other += sum(w in OTHER_WORDS for w in words)
            main += sum(w in MAIN_WORDS for w in words)
        got = (other, main, truth)
        if len(seen) < 10_000:
            seen[attrs] = got
    return got


def parse(html: str, seen: dict[str, tuple]) -> Page:
    """The units and text runs of a page."""
    tags, parents, marks, runs = ["#root"], [-1], [(0, 0, "")], []
    stack: list[tuple[str, int, bool]] = [("#root", 0, False)]  # tag, its unit or the one around it, in a link
    opened: Counter = Counter()  # tags on the stack
    block, at, size = 0, 0, len(html)

    def text(s: str) -> None:
        if s:
            top = stack[-1]
            runs.append((top[1], block, unescape(s) if "&" in s else s, top[2]))

    def innermost(wanted: set[str]) -> int:
        """Place on the stack of the innermost open element of ``wanted``; 0: none."""
        if not any(opened[t] for t in wanted):
            return 0
        return next(k for k in range(len(stack) - 1, 0, -1) if stack[k][0] in wanted)

    def close(down_to: int) -> None:
        nonlocal block
        for tag, _, _ in stack[down_to:]:
            block += tag in BLOCK
            opened[tag] -= 1
        del stack[down_to:]

    while at < size:
        m = _TOKEN.search(html, at)
        if m is None:
            text(html[at:])
            break
        text(html[at:m.start()])
        at = m.end()
        tag = m["tag"]
        if tag is None:
            if m["raw"]:
                text(m["raw"].replace("&", "&amp;"))
            continue
        tag = tag.lower()
        if m["end"]:
            k = innermost({tag})
            if not k:
                block += tag in BLOCK
            elif tag in INLINE and any(s[0] in BLOCK for s in stack[k + 1:]):
                opened[tag] -= 1
                del stack[k]  # markup that ends inside a block it began outside of
            else:
                close(k)
            continue
        if tag in RAW:
            end = _RAW_END[tag].search(html, at)
            at = size if end is None else html.find(">", end.end()) + 1 or size
            continue
        if tag in ENDS_P and opened["p"]:
            k = innermost({"p", "button"})
            if stack[k][0] == "p":
                close(k)
        if tag in ENDS:
            ends, stop = ENDS[tag]
            k = innermost(ends | stop)
            if k and stack[k][0] in ends:
                close(k)
        block += tag in BLOCK
        if tag == "br":
            text(" ")
        if tag in VOID:
            continue
        attrs = m["attrs"]
        mark = _marks(attrs, seen) if attrs and not attrs.isspace() else (0, 0, "")
        unit, linked = stack[-1][1], stack[-1][2] or tag == "a"
        if tag not in INLINE or mark[0] or mark[1] or mark[2]:
            parents.append(unit)
            unit = len(tags)
            tags.append(tag)
            marks.append(mark)
        stack.append((tag, unit, linked))
        opened[tag] += 1
    return Page(tags, parents, marks, runs)


FEATURES = """other_tag main_tag text_tag heading list other_words main_words other_above main_above depth chars link_share
block_chars tags_per_word stops_per_word children before share siblings same_tag sibling_links prev_chars next_chars
sibling_share main_below other_below heading_below own_share in_head""".split()


def features(page: Page) -> list[list[float]]:
    """A row of ``FEATURES`` for each unit."""
    tags, parents, n = page.tags, page.parents, len(page.tags)
    chars, links, words, stops, blocks, own, before = ([0] * n for _ in range(7))
    last_block, total = -1, 0
    begins = [None] * n
    for u, block, text, linked in page.runs:
        c = len(text) - text.count(" ") if not text.isspace() else 0
        if not c:
            continue
        chars[u] += c
        words[u] += text.count(" ") + 1
        stops[u] += text.count(".") + text.count(",") + text.count("?") + text.count("!")
        if linked:
            links[u] += c
        if block != last_block:
            blocks[u] += 1
            last_block = block
        if begins[u] is None:
            begins[u] = total
        total += c
    own = list(chars)
    other = [t in OTHER_TAGS for t in tags]
    main = [t in MAIN_TAGS for t in tags]
    count = [1] * n
    kids = [0] * n
    main_below, other_below, heads = [0] * n, [0.0] * n, [0] * n
    depth, other_above, main_above, in_head = [0] * n, [0] * n, [0] * n, [0] * n
    for u in range(1, n):
        p = parents[u]
        depth[u] = depth[p] + 1
        other_above[u] = other_above[p] + (other[p] or page.marks[p][0] > 0)
        main_above[u] = main_above[p] + (main[p] or page.marks[p][1] > 0)
        in_head[u] = in_head[p] or tags[u] == "head"
    for u in range(n - 1, 0, -1):
        p = parents[u]
        chars[p] += chars[u]
        links[p] += links[u]
        words[p] += words[u]
        stops[p] += stops[u]
        blocks[p] += blocks[u]
        count[p] += count[u]
        kids[p] += 1
        main_below[p] += main_below[u] + (main[u] or page.marks[u][1] > 0)
        other_below[p] += chars[u] if other[u] or page.marks[u][0] else other_below[u]
        heads[p] += heads[u] + (tags[u] in HEADINGS)
        if begins[u] is not None and (begins[p] is None or begins[u] < begins[p]):
            begins[p] = begins[u]
    prev, nxt, latest = [0] * n, [0] * n, [-1] * n
    same: dict[tuple[int, str], int] = {}
    most, kid_chars, kid_links = [0] * n, [0] * n, [0] * n
    for u in range(1, n):
        p = parents[u]
        if latest[p] >= 0:
            prev[u] = chars[latest[p]]
            nxt[latest[p]] = chars[u]
        latest[p] = u
        same[p, tags[u]] = same.get((p, tags[u]), 0) + 1
        most[p] = max(most[p], chars[u])
        kid_chars[p] += chars[u]
        kid_links[p] += links[u]
    here, rows = 0, []
    whole = max(1, chars[0])
    for u in range(n):
        p = max(0, parents[u])
        here = begins[u] if begins[u] is not None else here
        c, w = chars[u], max(1, words[u])
        rows.append([
            other[u], main[u], tags[u] in TEXT_TAGS, tags[u] in HEADINGS, tags[u] in LISTS, page.marks[u][0], page.marks[u][1],
            other_above[u], main_above[u], depth[u], c, links[u] / c if c else 0, c / blocks[u] if blocks[u] else 0, count[u] / w,
            stops[u] / w, kids[u], here / whole, c / whole, kids[p], same.get((p, tags[u]), 0) / max(1, kids[p]),
            (kid_links[p] - links[u]) / max(1, kid_chars[p] - c), prev[u], nxt[u], c / max(1, most[p]), main_below[u],
            other_below[u] / c if c else 0, heads[u], own[u] / c if c else 0, in_head[u]])
    return rows


@dataclass
class Boost:
    """Trees as full binary heaps: split feature and threshold of inner nodes, values of leaves."""

    features: np.ndarray    # (trees, 2 ** DEPTH - 1)
    limits: np.ndarray
    leaves: np.ndarray      # (trees, 2 ** DEPTH); tree i is of class i mod 3
    prior: np.ndarray

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        """Logarithms of the three classes' probabilities for rows ``x``."""
        out = np.tile(self.prior, (len(x), 1))
        rows = np.arange(len(x))
        for i in range(len(self.features)):
            at = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                at = 2 * at + 1 + (x[rows, self.features[i][at]] > self.limits[i][at])
            out[:, i % 3] += self.leaves[i][at - (2 ** DEPTH - 1)]
        top = out.max(axis=1, keepdims=True)
        return out - top - np.log(np.exp(out - top).sum(axis=1, keepdims=True))


def boost(x: np.ndarray, y: np.ndarray, rounds: int, rate: float = 0.25, least: float = 2.0, ridge: float = 1.0) -> Boost:
    """Fit by second-order boosting; ``least`` is a leaf's smallest sum of second derivatives."""
    n, width = x.shape
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(width)]
    binned = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
    base = binned + np.arange(width) * BINS
    prior = np.log((np.bincount(y, minlength=3) + 1.0) / (n + 3))
    score = np.tile(prior, (n, 1))
    feats, limits, leaves = [], [], []
    for _ in range(rounds):
        p = np.exp(score - score.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        for c in range(3):
            grad, hess = (y == c) - p[:, c], np.maximum(p[:, c] * (1 - p[:, c]), 1e-6)
            feat, limit = np.zeros(2 ** DEPTH - 1, np.int64), np.full(2 ** DEPTH - 1, np.inf)
            at = np.zeros(n, np.int64)
            for level in range(DEPTH):
                first, k = 2 ** level - 1, 2 ** level
                slot = ((at - first)[:, None] * (width * BINS) + base).ravel()
                shape = (k, width, BINS)
                g = np.bincount(slot, np.repeat(grad, width), k * width * BINS).reshape(shape).cumsum(axis=2)
                h = np.bincount(slot, np.repeat(hess, width), k * width * BINS).reshape(shape).cumsum(axis=2)
                gt, ht = g[:, :, -1:], h[:, :, -1:]
                gain = g**2 / (h + ridge) + (gt - g)**2 / (ht - h + ridge) - gt**2 / (ht + ridge)
                gain[(h < least) | (ht - h < least)] = 0
                best = gain.reshape(k, -1).argmax(axis=1)
                f, b = best // BINS, best % BINS
                good = gain.reshape(k, -1)[np.arange(k), best] > 1e-9
                for j in range(k):
                    if good[j] and b[j] < len(cuts[f[j]]):
                        feat[first + j], limit[first + j] = f[j], cuts[f[j]][b[j]]
                at = 2 * at + 1 + (x[np.arange(n), feat[at]] > limit[at])
            leaf = at - (2 ** DEPTH - 1)
            value = rate * np.bincount(leaf, grad, 2 ** DEPTH) / (np.bincount(leaf, hess, 2 ** DEPTH) + ridge)
            score[:, c] += value[leaf]
            feats.append(feat)
            limits.append(limit)
            leaves.append(value)
    return Boost(np.array(feats), np.array(limits), np.array(leaves), prior)


def decode(parents: list[int], odds: list[list[float]]) -> list[int]:
    """The most likely labels of a page's units that don't contradict each other."""
    n = len(parents)
    best = [list(o) for o in odds]
    for u in range(n - 1, 0, -1):
        p, (other, mixed, main) = best[parents[u]], best[u]
        p[OTHER] += other
        p[MIXED] += max(other, mixed, main)
        p[MAIN] += max(other, main)
    labels = [OTHER] * n
    for u in range(n):
        other, mixed, main = best[u]
        above = labels[parents[u]] if u else MIXED
        if above == MIXED:
            labels[u] = MIXED if mixed > max(other, main) else MAIN if main > other else OTHER
        elif above == MAIN:
            labels[u] = MAIN if main > other else OTHER
    return labels


def blocks_of(page: Page, labels: list[int]) -> str:
    """Text of the main units, block by block."""
    blocks: dict[int, list[str]] = {}
    for u, block, text, _ in page.runs:
        if labels[u] == MAIN:
            blocks.setdefault(block, []).append(text)
    lines = (" ".join("".join(b).split()) for b in blocks.values())
    return "\n\n".join(b for b in lines if b)


def truths(page: Page) -> list[int] | None:
    """Labels that a page's own markup gives: inside article or main, above it, or neither; None without any."""
    n = len(page.tags)
    labels = [OTHER] * n
    for u in range(1, n):
        above, (other, _, truth) = labels[page.parents[u]], page.marks[u]
        if truth:
            labels[u] = MAIN if truth == "main" else OTHER
        elif above == MAIN:
            inner = page.tags[u] in OTHER_TAGS and page.tags[u] != "header"
            labels[u] = OTHER if other or inner else MAIN
        elif page.tags[u] in MAIN_TAGS and not _under_other(page, u):
            labels[u] = MAIN
    if MAIN not in labels:
        return None
    for u in range(n - 1, 0, -1):
        p = page.parents[u]
        if labels[u] != OTHER and labels[p] == OTHER:
            labels[p] = MIXED
    return labels


def _under_other(page: Page, u: int) -> bool:
    while u > 0:
        u = page.parents[u]
        if page.tags[u] in OTHER_TAGS:
            return True
    return False


def layouts(pages: list[Page], variants: int) -> Iterator[str]:
    """The sampled pages' own text in other layouts, with the truth written on the parts."""
    rng = random.Random(7)
    bodies, extras = [], []
    for page in pages:
        labels = truths(page)
        if labels is None:
            continue
        parts: dict[int, list[str]] = {}
        tag: dict[int, str] = {}
        for u, block, text, _ in page.runs:
            if labels[u] == MAIN:
                parts.setdefault(block, []).append(text)
                tag[block] = page.tags[u] if page.tags[u] in TEXT_TAGS | HEADINGS else "p"
            elif text.strip() and page.tags[u] not in ("title", "head"):
                extras.append(" ".join(text.split()))
        bodies.append([(tag[b], s) for b, ts in parts.items() if (s := " ".join("".join(ts).split()))])
    extras = extras or ["more"]

    def words(k: int) -> str:
        return escape(" ".join(rng.choice(extras) for _ in range(k)))

    def part(body: list, most: int = 3) -> str:
        return "".join(f"<p>{escape(rng.choice(body)[1])}</p>" for _ in range(rng.randint(1, most)))

    def links(k: int) -> str:
        return "<ul>" + "".join(f'<li><a href="/{i}">{words(1)}</a></li>' for i in range(k)) + "</ul>"

    def named(tag: str, names: str, content: str, sure: bool = False) -> str:
        """An element of another part: by its own tag, by a class or id, seldom (outside of articles) by neither."""
        pick = rng.uniform(0.35, 0.9) if sure else rng.random()
        name = rng.choice(names.split()) + rng.choice(["", "", "-box", "_1", " left", "Area"])
        if pick < 0.35:
            return f'<{tag} data-truth="other">{content}</{tag}>'
        attr = f' {rng.choice(["class", "id"])}="{name}"' if pick < 0.95 else ""
        return f'<div{attr} data-truth="other">{content}</div>'

    def varied(body: list) -> list:
        """The same article with a short heading, or with one much longer paragraph, or as it is."""
        body = list(body)
        if rng.random() < 0.3 and body[0][0] in HEADINGS:
            body[0] = (body[0][0], " ".join(body[0][1].split()[:rng.randint(1, 3)])[:rng.randint(1, 30)].strip() or "x")
        if rng.random() < 0.2:
            tag, s = body[-1]
            body[-1] = (tag, " ".join([s] * rng.randint(5, 40)))
        if rng.random() < 0.2:
            body = body[:rng.randint(1, len(body))]
        return body

    for plain in bodies:
        for _ in range(variants if plain else 0):
            body = plain
            others = rng.choice(bodies) or body
            body = varied(body)
            pool = [
                named("nav", "nav menu navbar breadcrumb pagination", links(rng.randint(2, 9))),
                named("aside", "sidebar widget related recommended", f"<h3>{words(1)}</h3>" + rng.choice([links(4), part(others, 2)])),
                named("section", "comments replies discussion comment-list", f"<h3>{words(1)}</h3>" + "".join(
                    named("div", "comment reply", part(others, 2)) for _ in range(rng.randint(1, 4)))),
                named("div", "cookie-notice consent popup newsletter alert-banner", f"<p>{words(2)}</p><button>ok</button>"),
                named("form", "search login subscribe form", f"<label>{words(1)}</label><input name=q><button>{words(1)}</button>"),
                named("div", "ad advert sponsored promo banner", rng.choice([words(1), f"<p>{words(2)}</p>", f'<a href="/x">{words(2)}</a>'])),
                named("div", "share social follow tags", links(3))]
            inner = []
            for tag, s in body:
                inner.append(f"<{tag}>{escape(s)}</{tag}>")
                if rng.random() < 0.04:
                    inner.append(named("aside", "ad related newsletter promo sidebar", rng.choice([words(1), f"<p>{words(2)}</p>", links(3)]), True))
            if rng.random() < 0.3 and inner and body[0][0] in HEADINGS:
                inner[0] = f'<header data-truth="main">{inner[0]}</header>'
            if rng.random() < 0.2:
                inner.append(named("section", "comments replies discussion", f"<h3>{words(1)}</h3>" + part(others, 3), True))
            shape, text = rng.random(), "".join(inner)
            if shape < 0.25:
                text = f'<article data-truth="main">{text}</article>'
            elif shape < 0.4:
                text = f'<main data-truth="main">{text}</main>'
            elif shape < 0.75:
                name = rng.choice(["post", "content", "entry-content", "article-body", "story", "main", "postText"])
                text = f'<div {rng.choice(["class", "id"])}="{name}" data-truth="main">{text}</div>'
            elif shape < 0.9:
                text = f'<div data-truth="main">{text}</div>'
            else:
                text = "".join(re.sub(r"^<(\w+)(?! data)", r'<\1 data-truth="main"', s) if "data-truth" not in s[:40] else s for s in inner)
            for _ in range(rng.randint(0, 2)):
                text = f'<div class="{rng.choice(["wrap", "container", "row", "col", "page"])}">{text}</div>'
            top = [named("header", "header masthead topbar head", rng.choice([f"<h1>{words(1)}</h1>", f"<p>{words(1)}</p>"]) + rng.choice(["", pool[0]]))]
            rng.shuffle(pool)
            k, j = rng.randint(0, 3), rng.randint(0, 3)
            bottom = [named("footer", "footer copyright foot", f"&copy; {words(1)}")]
            yield (f"<html><head><title data-truth=\"other\">{escape(body[0][1][:60])}</title></head><body>" + "".join(
                (top if rng.random() < 0.7 else []) + pool[:k]) + text + "".join(pool[k:k + j] + (bottom if rng.random() < 0.8 else []))
                + "</body></html>")


def fit(pages: DataFrame, html: Column, order: list[Column], sample_pages: int = 400, variants: int = 2, rounds: int = 30) -> Boost | None:
    """Trees learned from a bounded sample of ``pages``; None where no sampled page marks its article."""
    rows = pages.select(F.xxhash64(*order).alias("h"), html.alias("html"))
    first = rows.select("h").distinct().orderBy("h").limit(sample_pages).agg(F.max("h")).first()[0]
    if first is None:
        return None
    chosen = (rows.filter((F.col("h") <= F.lit(first)) & (F.length("html") <= LONG_PAGE))
              .groupBy("h").agg(F.min("html").alias("html")).orderBy("h").collect())
    seen: dict[str, tuple] = {}
    sampled = [parse(r["html"], seen) for r in chosen]
    marked = [p for p in sampled if truths(p)]
    if not marked:
        return None
    x, y = [], []
    for page in [*marked, *marked, *(parse(h, seen) for h in layouts(marked, variants))]:
        x += features(page)
        y += truths(page)
    return boost(np.array(x, dtype=np.float64), np.array(y), rounds)


def _extract(batches: Iterator[pa.RecordBatch], shared, most: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    model: Boost | None = shared.value
    seen: dict[str, tuple] = {}

    def texts(pages: list[Page]) -> list[str]:
        if model is None or not pages:
            return [""] * len(pages)
        odds = model.log_odds(np.array([r for p in pages for r in features(p)], dtype=np.float64)).tolist()
        out, at = [], 0
        for p in pages:
            n = len(p.tags)
            out.append(blocks_of(p, decode(p.parents, odds[at:at + n])))
            at += n
        return out

    for b in batches:
        column = b.column(b.num_columns - 1)
        lo, size, pages = 0, 0, []
        for k in range(b.num_rows + 1):
            if k == b.num_rows or size > most:
                if pages:
                    got = texts(pages)
                    yield pa.RecordBatch.from_arrays(
                        [*(c.slice(lo, len(pages)) for c in b.columns[:-1]), pa.array(got, pa.string()), pa.array(map(len, got), pa.int64())],
                        names=[*b.schema.names[:-1], "text", "n_chars"])
                lo, size, pages = k, 0, []
            if k < b.num_rows:
                html = column[k].as_py() or ""
                pages.append(parse(html, seen))
                size += len(html)


def extract(pages: DataFrame, model: Boost | None, keep: list[str], html: Column | str = "html") -> DataFrame:
    """``keep`` columns with text and n_chars of every page."""
    shared = pages.sparkSession.sparkContext.broadcast(model)
    rows = pages.select(*clear(keep, "text", "n_chars"), (F.col(html) if isinstance(html, str) else html).alias("_html"))
    return rows.mapInArrow(lambda it: _extract(it, shared), with_fields(rows, "text string, n_chars long"))
