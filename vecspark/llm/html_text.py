"""Main-text extraction by boosted trees over DOM nodes and hierarchical decoding.

Every block element of a page is a node with features of its subtree (text
density, link share, share of the page), its attribute words, its depth and
its siblings.  Gradient-boosted trees give each node the probability of
being main content.  Decoding then picks the likeliest labelling in which
nothing inside a dropped node is kept: bottom-up, a node is worth the better
of dropping its whole subtree or keeping itself with its children's best.
Kept nodes' text runs, in page order, are the result.

No table has labels for pages, so training is by weak supervision on a
bounded sample of ``SAMPLE_PAGES`` pages (drawn by a hash of the html over
all pages): markup that names its role (``nav``, ``footer``, words such as
"advert" or "comments" in attributes) labels its subtree.  Each sampled
page is also seen with other names for its elements, with furniture of
other kinds added around and inside the article, and without names at all,
so that the trees learn shape as well as names.  The sample's html, of
bounded number, is all that reaches the driver.

Defined results: a null or empty html has empty text; a page in which
nothing is content has empty text; malformed and truncated markup is read
as far as it goes; repeated rows and extra columns do not matter.
"""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecspark.llm.boosting import Boosted, fit
from vecspark.llm.common import parts_of, texts_of
from vecspark.llm.dom import Node, parse

SAMPLE_PAGES = 200
MOST_SAMPLE_CHARS = 200_000  # sampled pages are of this length at most, so the sample is bounded

# Words of attributes and the roles they tell.
ROLES = {
    "menu": "nav navigation navbar menu breadcrumb breadcrumbs pagination pager toc tabs skip",
    "header": "header masthead topbar banner logo branding",
    "footer": "footer bottombar copyright colophon legal",
    "side": "sidebar side aside rail related recommended recommendations popular trending tags widget widgets complementary",
    "notice": "cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe signup paywall disclaimer",
    "advert": "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion promoted",
    "form": "form login search contact register share social sharing",
    "comment": "comment comments reply replies respond discussion disqus reviews feedback thread",
    "content": "article content post entry story text main body articlebody mainentity prose page",
}
_ROLE_OF = {w: i for i, words in enumerate(ROLES.values()) for w in words.split()}
N_ROLES, CONTENT = len(ROLES), len(ROLES) - 1
#: element name: role it tells
_TAG_ROLE = {"nav": 0, "menu": 0, "header": 1, "footer": 2, "aside": 3, "dialog": 4, "form": 6, "fieldset": 6, "search": 6,
             "article": CONTENT, "main": CONTENT}
_TAGS = ("p", "h1", "h2", "h3", "li", "ul", "ol", "td", "table", "div", "section", "pre", "blockquote")


def roles(node: Node) -> list[bool]:
    out = [False] * N_ROLES
    if node.tag in _TAG_ROLE:
        out[_TAG_ROLE[node.tag]] = True
    for w in node.words:
        if w in _ROLE_OF:
            out[_ROLE_OF[w]] = True
    return out


def _weak_labels(nodes: list[Node], told: list[list[bool]]) -> np.ndarray:
    """1 for content: no node on the way from the root tells another role; the header of an article is content."""
    out = np.ones(len(nodes))
    in_article = [False] * len(nodes)
    for i, n in enumerate(nodes):
        if n.parent >= 0:
            out[i] = out[n.parent]
            in_article[i] = in_article[n.parent]
        other = [r for r in range(N_ROLES - 1) if told[i][r]]
        strong = n.tag in ("article", "main")
        if other and not strong and not (i == 0) and not (other == [1] and in_article[i] and n.tag == "header"):
            out[i] = 0
        in_article[i] = in_article[i] or strong
    return out


def features(nodes: list[Node], told: list[list[bool]]) -> np.ndarray:
    """One row per node."""
    n = len(nodes)
    chars = np.array([x.chars for x in nodes], dtype=np.float64)
    linked = np.array([x.linked for x in nodes], dtype=np.float64)
    size, runs = np.ones(n), np.array([x.runs for x in nodes], dtype=np.float64)
    own = chars.copy()
    for i in range(n - 1, 0, -1):
        p = nodes[i].parent
        chars[p] += chars[i]
        linked[p] += linked[i]
        size[p] += size[i]
        runs[p] += runs[i]
    own_roles = np.array(told, dtype=np.float64)
    above = own_roles.copy()
    # role of the nearest element that tells one: 1 content, -1 another, 0 none; and whether any tells another
    nearest = np.where(own_roles[:, :CONTENT].any(1), -1.0, own_roles[:, CONTENT])
    parent = np.array([x.parent for x in nodes])
    for i in range(1, n):
        above[i] = np.maximum(above[i], above[parent[i]])
        if nearest[i] == 0:
            nearest[i] = nearest[parent[i]]
    told_above = np.stack((nearest, above[:, :CONTENT].max(1)), 1)
    p0 = np.maximum(parent, 0)
    siblings = np.array([len(nodes[p].children) for p in p0], dtype=np.float64)
    place = np.zeros(n)
    for x in nodes:
        for k, c in enumerate(x.children):
            place[c] = k
    numbers = np.stack([
        np.array([x.depth for x in nodes]), np.log1p(chars), np.log1p(own), linked / np.maximum(chars, 1),
        chars / np.maximum(chars[0], 1), np.log1p(chars / size), np.log1p(size), np.log1p(chars / np.maximum(runs, 1)),
        linked[p0] / np.maximum(chars[p0], 1), chars / np.maximum(chars[p0], 1), np.log1p(siblings),
        place / np.maximum(siblings - 1, 1), np.log1p(place), np.log1p((chars[p0] - chars) / np.maximum(siblings - 1, 1)),
    ], 1)
    names = np.array([[x.tag == t for t in _TAGS] for x in nodes], dtype=np.float64)
    return np.concatenate((numbers, names, told_above, own_roles, above), 1)


def decode(nodes: list[Node], margin: np.ndarray) -> np.ndarray:
    """Kept nodes of the likeliest labelling without content inside a dropped node.

    Nodes weigh by the log of their text, so bare wrappers do not decide.
    """
    weight = np.array([np.log1p(x.chars) if x.chars else 0.05 for x in nodes])
    keep, drop = -np.logaddexp(0, -margin) * weight, -np.logaddexp(0, margin) * weight
    for i in range(len(nodes) - 1, 0, -1):
        p = nodes[i].parent
        keep[p] += max(keep[i], drop[i])
        drop[p] += drop[i]
    kept = np.zeros(len(nodes), dtype=bool)
    kept[0] = True
    for i in range(1, len(nodes)):
        kept[i] = kept[nodes[i].parent] and keep[i] >= drop[i]
    return kept


def main_texts(pages: list[str], model: Boosted) -> list[str]:
    """Main text of whole pages."""
    parsed = [parse(x) for x in pages]
    rows = [features(nodes, [roles(x) for x in nodes]) for nodes, _ in parsed]
    margin = model.margin(np.concatenate(rows)) if rows else np.zeros(0)
    out, at = [], 0
    for nodes, runs in parsed:
        kept = decode(nodes, margin[at:at + len(nodes)])
        at += len(nodes)
        out.append(" ".join(words for i, words in runs if kept[i]))
    return out


_RENAMED = {
    "article": ['<div class="post-content">', '<main>', '<div id="content"><div class="entry">', '<section class="story">',
                '<div class="article-body">', '<div role="main">'],
    "nav": ['<div class="menu">', '<ul class="navbar">', '<div id="navigation">', '<div role="navigation">'],
    "footer": ['<div class="footer">', '<div id="site-footer">', '<div class="copyright">'],
}


def _renamed(page: str, rng: random.Random, bare: bool) -> str:
    """The page with other names for its sectioning elements, or with none."""
    for tag, others in _RENAMED.items():
        opening = "<div><div>" if bare and tag == "article" else "<div>" if bare else rng.choice(others)
        closing = "".join(f"</{t}>" for t in reversed(re.findall(r"<(\w+)", opening)))
        page = re.sub(rf"<{tag}\b[^>]*>", lambda _, o=opening: o, page, flags=re.I)
        page = re.sub(rf"</{tag}\s*>", lambda _, c=closing: c, page, flags=re.I)
    if bare:
        page = re.sub(r"\s(?:class|id|role)=(?:\"[^\"]*\"|'[^']*')", "", page)
    return page


def _furniture(page: str, rng: random.Random, text: str) -> str:
    """The page with furniture of other kinds around and inside its content."""
    words = text.split() or ["more"]

    def some(a, b):
        n, at = rng.randint(a, b), rng.randrange(len(words))
        return " ".join(words[at:at + n]) or words[0]

    def links(n):
        return "<ul>" + "".join(f'<li><a href="/x">{some(1, 4)}</a></li>' for _ in range(n)) + "</ul>"

    before = [
        f'<header class="site-header"><p>{some(1, 6)}</p>{links(3)}</header>', f'<div class="cookie-notice"><p>{some(5, 25)}</p></div>',
        f'<div class="top-banner">{some(2, 12)}</div>', f'<form action="/s" class="search"><label>{some(1, 3)}</label></form>']
    after = [
        f'<aside class="sidebar"><h3>{some(1, 3)}</h3>{links(5)}</aside>', f'<div class="related"><h3>{some(1, 3)}</h3><p>{some(5, 40)}</p></div>',
        f'<section id="comments"><h2>{some(1, 3)}</h2>' + "".join(
            f'<div class="comment"><p>{some(5, 60)}</p></div>' for _ in range(rng.randint(1, 5))) + "</section>",
        f'<form class="newsletter-signup"><p>{some(3, 15)}</p></form>', f'<div class="advert">{some(3, 30)}</div>',
        f'<div class="share">{links(4)}</div>']
    page = re.sub(r"(<body[^>]*>)", lambda m: m[1] + "".join(rng.sample(before, rng.randint(1, 3))), page, count=1, flags=re.I)
    inside = "".join(rng.sample(after, rng.randint(1, 3)))
    close = "</article>" if rng.random() < 0.5 else "<footer"
    return page.replace(close, (inside + close), 1)


def train(pages: list[str], seed: int = 7) -> Boosted:
    """Boosted trees from weakly labelled pages and their variants."""
    rng = random.Random(seed)
    xs, ys = [], []
    for page in pages:
        fuller = _furniture(page, rng, " ".join(w for _, w in parse(page)[1]))
        for base in (page, fuller):
            nodes, _ = parse(base)
            told = [roles(x) for x in nodes]
            label = _weak_labels(nodes, told)
            xs.append(features(nodes, told)), ys.append(label)
            named = parse(_renamed(base, rng, False))[0]
            told = [roles(x) for x in named]
            xs.append(features(named, told)), ys.append(_weak_labels(named, told))
            # without names the labels are those the names told
            nothing = [[False] * N_ROLES for _ in nodes]
            plain = [Node("div" if x.tag in _TAG_ROLE else x.tag, [], x.parent, x.depth) for x in nodes]
            for a, b in zip(plain, nodes, strict=True):
                a.children, a.chars, a.linked, a.runs = b.children, b.chars, b.linked, b.runs
            xs.append(features(plain, nothing)), ys.append(label)
    if not xs:
        return Boosted(4)
    return fit(np.concatenate(xs), np.concatenate(ys))


def extract(pages: DataFrame, html_col: str = "html", sample_pages: int = SAMPLE_PAGES, text_col: str = "text") -> DataFrame:
    """``row`` (all columns of ``pages``) and its main ``text``."""
    html = F.col(f"`{html_col}`")
    total = pages.count()
    share = min(1.0, 2.0 * sample_pages / total) if total else 1.0
    point = F.xxhash64(html, F.lit(17)).bitwiseAND(F.lit((1 << 40) - 1)) / float(1 << 40)
    short = F.length(html).between(1, MOST_SAMPLE_CHARS)
    drawn = (pages.where((point <= share) & short)
             .groupBy(html.alias("html")).agg(F.min(point).alias("point")).orderBy("point", "html").limit(sample_pages))
    sample = [r["html"] for r in drawn.select("html").collect()]
    if not sample:  # no page is short enough (or the share missed the few that are): the shortest one of all
        sample = [r["html"] for r in pages.where(F.length(html) > 0).select(html.alias("html")).orderBy(F.length("html"), "html").limit(1).collect()]
    model = train(sample)
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            raw, found = texts_of(batch.column("html")), []
            for a, b in parts_of(raw, 1 << 21):
                found.extend(main_texts([x.decode("utf-8", "replace") for x in raw[a:b]], shared.value))
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(found, pa.string())], names=["row", "text"])

    row = F.struct(*[F.col(f"`{c}`") for c in pages.columns if c != html_col])
    packed = pages.select(row.alias("row"), html.alias("html"))
    return packed.mapInArrow(run, f"row {packed.schema['row'].dataType.simpleString()}, text string")


def op2_html_text(spark, sf_dir: str) -> DataFrame:
    from vecspark.llm.common import table

    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = extract(pages)
    return found.select("row.page_id", "row.url", "text", F.length("text").cast("long").alias("n_chars"))
