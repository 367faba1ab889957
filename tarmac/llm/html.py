"""Main text of web pages: gradient-boosted trees over DOM nodes, decoded along the tree.

Every block element, and every other element with a class, id or role, is a node.  Its features
are its depth, sibling place, subtree size, text and link density, punctuation, and which groups
of tags and attribute tokens name it and its ancestors.  Trees are fitted in numpy on a bounded
sample (``SAMPLE_PAGES`` pages that mark their main part with article or main): each page is
used as it is and in ``VARIANTS`` rebuilt forms, its main part under other wrappers and amid
menus, notices, adverts, forms, comments and the like, so what the model needs to know of those
blocks does not depend on the sampled site.

Decoding gives each node one of three states along every path: before the main part, in it,
removed.  A node can only be in the main part under a node before or in it, and nothing under a
removed node returns; the assignment with the largest sum of node scores is taken bottom-up.

Edge cases: null or empty html gives empty text; unclosed tags close as browsers close them;
an unclosed svg, select, template or noscript tag hides nothing;
without pages to learn from, rebuilt pages from the given pages' text are used alone; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm import boosting
from tarmac.llm.common import arrays, draw_limit, table

SAMPLE_PAGES = 400
VARIANTS = 3
BATCH_PAGES = 256

# Element classes of HTML, and the attribute words that pages commonly use.
RAW = frozenset("script style textarea noscript template title iframe svg select xmp noembed".split())
LOOSE = frozenset("noscript template svg select".split())    # of them those that hold markup: without an end tag they hold nothing
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body button center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table "
    "tbody td tfoot th thead tr ul".split())
ENDS_P = BLOCK - frozenset("button td th tr tbody thead tfoot option optgroup legend summary body html li dd dt".split())
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
            "th": ("td", "th"), "option": ("option",), "p": ("p",), "tbody": ("tbody", "thead", "tr", "td", "th"),
            "tfoot": ("tbody", "thead", "tr", "td", "th")}
HOLDERS = frozenset("ul ol dl table body div article section main aside td th select menu blockquote".split())
TAG_GROUPS = [frozenset(x.split()) for x in (
    "article main", "nav menu", "footer", "header", "aside", "form fieldset button label legend dialog option optgroup",
    "p blockquote pre", "h1 h2 h3 h4 h5 h6 hgroup", "ul ol dl li dt dd", "div section", "table tbody thead tr td th",
    "body html")]
TOKEN_GROUPS = [frozenset(x.split()) for x in (
    "article content post entry body main story text hentry articlebody page",
    "nav navigation navbar menu breadcrumb breadcrumbs pagination pager topbar tabs toc skip",
    "ad ads advert advertisement adsense banner promo promotion sponsor sponsored dfp outbrain taboola commercial",
    "comment comments reply replies disqus discussion respond responses reader feedback review reviews commentlist",
    "footer foot copyright legal credits colophon bottom contentinfo",
    "header head masthead logo branding site title",
    "sidebar side aside widget widgets related recommended recommendations popular trending more complementary rail",
    "notice cookie cookies consent gdpr popup modal overlay alert newsletter subscribe signup login form search paywall "
    "message info disclaimer warning privacy",
    "share social sharing follow facebook twitter tags tag meta byline author date print tools toolbar hidden")]

TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)[^>]*+(?:>|\Z)""",
                 re.S)
ATTR = re.compile(r"""(?:^|\s)(class|id|role|data-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
WORD = re.compile(r"[a-z]+")
CAMEL = re.compile(r"([a-z])([A-Z])")


@dataclass
class Page:
    """Nodes in page order: parent, tag, attribute tokens, label mark, text events (node, text or None for a break)."""
    parent: list[int] = field(default_factory=lambda: [-1])
    tag: list[str] = field(default_factory=lambda: ["#"])
    tokens: list[frozenset] = field(default_factory=lambda: [frozenset()])
    mark: list[str] = field(default_factory=lambda: [""])
    link: list[int] = field(default_factory=lambda: [0])          # link characters of the node itself
    controls: list[int] = field(default_factory=lambda: [0])
    inline: list[int] = field(default_factory=lambda: [0])        # tags of the node that are no nodes
    events: list[tuple[int, str | None]] = field(default_factory=list)


def parse(source: str) -> Page:
    """The page's tree.  Raw elements (scripts, styles, templates, ...) and comments leave nothing; MathML is text."""
    page = Page()
    endless: set[str] = set()                          # names without another end tag
    stack: list[tuple[str, int]] = [("#", 0)]          # open elements with the node their text belongs to
    at, links = 0, 0
    while at < len(source):
        m = TAG.search(source, at)
        cut = m.start() if m else len(source)
        if cut > at:
            text = source[at:cut]
            node = stack[-1][1]
            page.events.append((node, html.unescape(text) if "&" in text else text))
            if links:
                page.link[node] += cut - at
        if not m:
            break
        at = m.end()
        name = m.group(2)
        if name is None:
            continue
        name = name.lower()
        if m.group(1):
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == name:
                    links -= sum(x[0] == "a" for x in stack[k:])
                    del stack[k:]
                    break
                if name not in BLOCK and stack[k][0] in HOLDERS:      # a stray inline end tag closes no block
                    break
            if name in BLOCK:
                page.events.append((stack[-1][1], None))
            continue
        if name in RAW:
            close = None if name in endless else re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>", re.I).search(source, at)
            page.controls[stack[-1][1]] += name in ("textarea", "select")
            if close is None:
                endless.add(name)
            if not m.group(3).rstrip().endswith("/") or name != "svg":
                at = close.end() if close else at if name in LOOSE else len(source)
            continue
        if name in ENDS_P:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == "p":
                    links -= sum(x[0] == "a" for x in stack[k:])
                    del stack[k:]
                    break
                if stack[k][0] in BLOCK:
                    break
        if name in SIBLINGS:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] in SIBLINGS[name]:
                    links -= sum(x[0] == "a" for x in stack[k:])
                    del stack[k:]
                    if name not in ("tr", "tbody", "tfoot"):
                        break
                    continue
                if stack[k][0] in HOLDERS:
                    break
        above = stack[-1][1]
        if name in VOID:
            page.controls[above] += name == "input"
            if name in ("br", "hr"):
                page.events.append((above, None))
            continue
        found = {a.lower(): b or c or d for a, b, c, d in ATTR.findall(m.group(3))} if "=" in m.group(3) else {}
        block = name in BLOCK
        if block or found:
            words = " ".join(CAMEL.sub(r"\1 \2", v) for k, v in found.items() if k != "data-label").lower()
            page.parent.append(above)
            page.tag.append(name)
            page.tokens.append(frozenset(WORD.findall(words)))
            page.mark.append(found.get("data-label", ""))
            page.link.append(0)
            page.controls.append(int(name == "button"))
            page.inline.append(0)
            node = len(page.tag) - 1
            if block:
                page.events.append((node, None))
        else:
            node = above
            page.inline[node] += 1
        links += name == "a"
        stack.append((name, node))
    return page


N_FEATURES = 16 + len(TAG_GROUPS) + 2 * len(TOKEN_GROUPS) + len(TAG_GROUPS)


def node_features(page: Page) -> np.ndarray:
    n = len(page.tag)
    parent = np.array(page.parent)
    own, commas, words = np.zeros(n), np.zeros(n), np.zeros(n)
    for node, text in page.events:
        if text:
            own[node] += len(text)
            commas[node] += text.count(",") + text.count(".")
            words[node] += text.count(" ") + 1
    paragraphs = np.array([t == "p" for t in page.tag], float)
    items = np.array([t == "li" for t in page.tag], float)
    # Summed over each subtree: parents come before children, so one pass from the end will do.
    sums = np.stack([np.ones(n), own, np.array(page.link, float), commas, words, paragraphs, items,
                     np.array(page.controls, float), np.array(page.inline, float)], 1)
    depth, index, siblings = np.zeros(n), np.zeros(n), np.zeros(n)
    tags = np.array([[t in g for g in TAG_GROUPS] for t in page.tag], float)
    tokens = np.array([[len(w & g) > 0 for g in TOKEN_GROUPS] for w in page.tokens], float)
    above, above_tags = tokens.copy(), tags.copy()
    for i in range(n - 1, 0, -1):
        sums[parent[i]] += sums[i]
    for i in range(1, n):
        p = parent[i]
        depth[i] = depth[p] + 1
        index[i] = siblings[p]
        siblings[p] += 1
        above[i] = np.maximum(above[p], above[i])
        above_tags[i] = np.maximum(above_tags[p], above_tags[i])
    of = np.where(parent >= 0, siblings[np.maximum(parent, 0)], 1)
    size, text, link, comma, word, para, item, control, inline = sums.T
    total = max(text[0], 1)
    plain = np.stack([
        depth, np.log1p(size), np.log1p(text), link / np.maximum(text, 1), text / (size + inline), text / total,
        np.log1p(para), np.log1p(of), index / np.maximum(of, 1), comma / np.maximum(text, 1) * 100,
        text / np.maximum(word, 1), np.log1p(control), item / size, np.log1p(own), np.log1p(siblings),
        np.where(parent >= 0, text / np.maximum(text[np.maximum(parent, 0)], 1), 1)], 1)
    return np.concatenate([plain, tags, tokens, above, above_tags], 1).astype(np.float32)


def decode(page: Page, z: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Which nodes are in the main part: the consistent assignment with the largest score."""
    n = len(page.tag)
    gain = np.clip(z, -6, 6) * (0.2 + np.log1p(own))
    before, inside = np.zeros(n), gain.copy()
    for i in range(n - 1, 0, -1):
        p = page.parent[i]
        before[p] += max(before[i], inside[i])
        inside[p] += max(inside[i], 0.0)
    state = np.zeros(n, np.int8)                          # 0 before, 1 in, 2 removed
    state[0] = inside[0] > before[0]
    for i in range(1, n):
        s = state[page.parent[i]]
        state[i] = 2 if s == 2 else (inside[i] > before[i]) if s == 0 else (1 if inside[i] > 0 else 2)
    return state == 1


def main_text(page: Page, kept: np.ndarray) -> str:
    """Kept text in page order; a break or removed text ends a block, white space becomes one space."""
    return " ".join("".join(" " if text is None or not kept[node] else text for node, text in page.events).split())


def own_length(page: Page) -> np.ndarray:
    own = np.zeros(len(page.tag))
    for node, text in page.events:
        if text:
            own[node] += len(text.strip())
    return own


def extract(sources: list[str], model: boosting.Trees) -> list[str]:
    pages = [parse(s) for s in sources]
    z = model.logits(np.concatenate([node_features(p) for p in pages])) if pages else np.empty(0)
    at = np.cumsum([0] + [len(p.tag) for p in pages])
    return [main_text(p, decode(p, z[a:b], own_length(p))) for p, a, b in zip(pages, at[:-1], at[1:], strict=True)]


# ---- training ------------------------------------------------------------------------------

WRAPPERS = ['<article data-label="1">{}</article>', '<main data-label="1">{}</main>',
            '<div class="post-content" data-label="1">{}</div>', '<div id="content" data-label="1">{}</div>',
            '<section class="entry" data-label="1">{}</section>', '<div data-label="1">{}</div>',
            '<main class="page"><div class="story" data-label="1">{}</div></main>',
            '<div class="wrapper"><article class="hentry" data-label="1">{}</article></div>',
            '<main><article data-label="1">{}</article></main>', '<table><tr><td data-label="1">{}</td></tr></table>']
AROUND = ['<header class="site-header"><h1>{0}</h1><p>{1}</p></header>', '<div id="header"><a href="/">{0}</a> {1}</div>',
          '<nav><ul><li><a href="#">{0}</a></li><li><a href="#">{1}</a></li></ul></nav>',
          '<div class="menu"><a href="#">{0}</a> <a href="#">{1}</a></div>', '<aside class="sidebar"><h2>{0}</h2><p>{2}</p></aside>',
          '<div id="sidebar"><h3>{0}</h3><ul><li><a href="#">{1}</a></li><li>{2}</li></ul></div>', '<aside><p>{2}</p></aside>',
          '<div class="cookie-notice">{2} <button>{0}</button></div>', '<div class="notice"><p>{2}</p></div>',
          '<footer><p>{2}</p></footer>', '<div class="footer">{1} {2}</div>', '<footer>&copy; {0} &middot; {2}</footer>',
          '<section class="comments"><h2>{0}</h2><div class="comment"><p>{2}</p></div><div class="comment"><p>{3}</p></div></section>',
          '<div id="comments"><h3>{0}</h3><ol><li><b>{1}</b><p>{3}</p></li><li><p>{2}</p></li></ol></div>',
          '<form action="/s"><label>{0}</label><input><button>{1}</button></form>', '<div class="related"><p><a href="#">{1}</a></p></div>',
          '<div class="ad">{2}</div>', '<div class="advert"><p>{2}</p></div>', '<ul class="breadcrumb"><li><a href="#">{0}</a></li></ul>']
WITHIN = ['<div class="ad">{2}</div>', '<div class="promo"><p>{2}</p></div>', '<aside><p>{2}</p></aside>',
          '<form><p>{1}</p><input><button>{0}</button></form>', '<nav><a href="#">{0}</a> <a href="#">{1}</a></nav>',
          '<div class="share">{0}</div>', '<div class="newsletter"><p>{2}</p><form><input></form></div>',
          '<section id="comments"><h2>{0}</h2><div class="comment"><p>{3}</p></div><div><p>{2}</p></div></section>',
          '<div class="comments"><p>{3}</p><p>{2}</p></div>', '<footer><p>{2}</p></footer>', '<header><p>{1}</p></header>',
          '<div class="notice">{2}</div>']
MAIN = re.compile(r"<(article|main)\b[^>]*>(.*)</\1\s*>", re.S | re.I)
PARTS = re.compile(r"(?=<(?:p|h[1-6]|ul|ol|blockquote|table|div)\b)", re.I)


def rebuilt(inner: str, words: list[str], rng: np.random.Generator) -> str:
    """The main part ``inner`` under another wrapper, amid blocks made of the given words."""
    def block(kinds: list[str]) -> str:
        def some(k: int) -> str:
            return " ".join(words[i] for i in rng.integers(0, len(words), k))
        return kinds[rng.integers(len(kinds))].format(some(1), some(rng.integers(2, 6)), some(rng.integers(5, 60)),
                                                      some(rng.integers(8, 90)))
    parts = [x for x in PARTS.split(inner) if x]
    for _ in range(rng.integers(0, 3)):
        parts.insert(rng.integers(0, len(parts) + 1), block(WITHIN).replace(">", ' data-label="0">', 1))
    body = WRAPPERS[rng.integers(len(WRAPPERS))].format("".join(parts))
    return "<html><body>" + "".join(block(AROUND) for _ in range(rng.integers(1, 5))) + body \
        + "".join(block(AROUND) for _ in range(rng.integers(1, 5))) + "</body></html>"


def labels(page: Page) -> np.ndarray:
    """1 in the marked main part, 0 outside it and in blocks put into it."""
    inside = np.zeros(len(page.tag))
    for i in range(1, len(inside)):
        inside[i] = {"1": 1, "0": 0}.get(page.mark[i], inside[page.parent[i]])
    return inside


def train(sources: list[str], seed: int = 11) -> boosting.Trees:
    rng = np.random.default_rng(seed)
    pages = []
    for source in sources:
        m = MAIN.search(source)
        inner = m.group(2) if m else ""
        words = html.unescape(re.sub(r"<[^>]*>", " ", source)).split() or ["page"]
        words = [html.escape(w) for w in words]
        if m:
            pages.append(source[:m.start()] + f'<{m.group(1)} data-label="1">{inner}</{m.group(1)}>' + source[m.end():])
        else:
            inner = "".join(f"<p>{' '.join(words[i:i + 60])}</p>" for i in range(0, min(len(words), 600), 60))
        pages += [rebuilt(inner, words, rng) for _ in range(VARIANTS)]
    if not pages:
        pages = [rebuilt("<h1>Title</h1><p>Some text of a page, in a sentence.</p>", ["word"], rng)]
    parsed = [parse(p) for p in pages]
    return boosting.fit(np.concatenate([node_features(p) for p in parsed]), np.concatenate([labels(p) for p in parsed]))


def fit(pages: DataFrame, sample: int = SAMPLE_PAGES) -> boosting.Trees:
    """Train on at most about ``sample`` pages, drawn by a hash of their html."""
    rows = pages.select(F.col("html").cast("string").alias("html")).where(F.length("html") > 0)
    draw = F.xxhash64("html", F.lit(3))
    n = rows.select(draw.alias("draw")).distinct().count()
    found = rows.where(draw <= F.lit(draw_limit(sample, n)).cast("long")).distinct().collect()
    return train(sorted(r[0] for r in found))


def main_texts(pages: DataFrame, model: boosting.Trees) -> DataFrame:
    """page_id, url, text, n_chars for every row of ``pages``."""
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, whole.num_rows, BATCH_PAGES):
                batch = whole.slice(a, BATCH_PAGES)
                texts = extract([x or "" for x in batch.column("html").to_pylist()], model)
                yield arrays([batch.column("page_id"), batch.column("url"), texts, [len(t) for t in texts]], schema)

    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html")) \
        .mapInArrow(read, "page_id long, url string, text string, n_chars long")


def op5_html_extraction(spark, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return main_texts(pages, fit(pages))
