"""Main text of web pages by a tree-structured graphical model.

A page becomes a tree: block elements, and as leaves the text blocks (text between two
block boundaries). Every node is content or not. Node potentials are a logistic model
of the node's own features, parent-child potentials are the log chances of a child's
class given its parent's; both are learned from labelled pages (piecewise). Messages
go up the tree and down again, which gives each text block its exact marginal; blocks
over one half are the text of the page.
"""

from __future__ import annotations

import html as entities
import math
import random
import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|<(?=/?[a-zA-Z]).*\Z", re.S)
_NAMED = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
RAW = frozenset("script style noscript template iframe textarea title svg math object video audio canvas xmp".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset((
    "html body head main article section header footer nav aside div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead "
    "tbody tfoot tr td th caption blockquote pre figure figcaption address form fieldset details summary dialog hr menu "
    "center select option button label legend hgroup search noframes").split())
#: never part of the article, with all they hold
OUT = frozenset("head nav form aside select button dialog menu search label option fieldset".split())
#: an opening tag closes these, up to the nearest of the containers
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
          "th": ("td", "th"), "option": ("option",), "tbody": ("tr", "td", "th", "thead", "tbody")}
SCOPES = frozenset("ul ol dl table select div section article main body td th blockquote aside nav footer header form".split())
#: fixed values: words in class, id and role names that speak against and for content
AGAINST = frozenset((
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation "
    "menu menus breadcrumb breadcrumbs sidebar side aside widget widgets footer foot copyright header masthead topbar "
    "toolbar cookie cookies consent gdpr notice notices alert popup modal overlay subscribe subscription newsletter signup "
    "login share sharing social comment comments commentlist respond reply replies disqus discussion feedback reader "
    "readers related recommended recommendation more tags tag pagination pager search form hidden skip legal "
    "disclaimer contentinfo complementary").split())
FOR = frozenset("article content post entry story main body text page hentry prose markdown copy blog news".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
N_FEATURES = 19
MAX_PAGES, MADE_PAGES, ROUNDS = 300, 300, 300


class Node:
    __slots__ = ("tag", "parent", "against", "favour", "out", "text", "chars", "link_chars", "under", "in_article", "truth")

    def __init__(self, tag, parent, nodes, names=""):
        up = nodes[parent] if parent >= 0 else None
        words = {w.lower() for w in _PARTS.findall(names)} if names else ()
        self.tag, self.parent = tag, parent
        self.against = not AGAINST.isdisjoint(words)
        self.favour = not FOR.isdisjoint(words)
        self.in_article = tag in ("article", "main") or bool(up and up.in_article)
        self.out = tag in OUT or bool(up and up.out) or (tag in ("header", "footer") and not self.in_article)
        self.text = None
        #: in an element whose names speak against content (body and mixed names aside)
        self.under = bool(up and up.under) or (self.against and not self.favour and tag not in ("html", "body"))
        self.chars = self.link_chars = 0
        self.truth = None


def parse(page: str) -> list[Node]:
    """The tree, parents before children. Text blocks have tag "#" and a text, possibly empty."""
    nodes = [Node("html", -1, [])]
    stack = [0]
    run: list[str] = []
    linked = anchors = 0
    at = 0

    def flush():
        nonlocal run, linked
        if run:
            text = " ".join(entities.unescape("".join(run)).split())
            if text:
                leaf = Node("#", stack[-1], nodes)
                leaf.text, leaf.chars, leaf.link_chars = text, len(text), min(linked, len(text))
                nodes.append(leaf)
            run = []
        linked = 0

    def say(piece):
        nonlocal linked
        if piece:
            run.append(piece)
            if anchors:
                linked += len(piece.strip())

    end = len(page)
    while at < end:
        m = _TOKEN.search(page, at)
        if not m:
            say(page[at:])
            break
        say(page[at:m.start()])
        at = m.end()
        tag = m["tag"]
        if not tag:
            continue
        tag = tag.lower()
        if m["close"]:
            if tag == "a":
                anchors = max(0, anchors - 1)
            elif tag in BLOCKS:
                flush()
                for k in range(len(stack) - 1, 0, -1):
                    if nodes[stack[k]].tag == tag:
                        del stack[k:]
                        break
            continue
        if tag in RAW:
            if not m["attrs"].rstrip().endswith("/") or tag in ("script", "style"):
                close = re.compile(rf"</{tag}\s*[^>]*(?:>|\Z)", re.I).search(page, at)
                at = close.end() if close else end
            continue
        if tag == "br":
            run.append(" ")
        elif tag == "a":
            anchors += 1
        elif tag in BLOCKS:
            flush()
            anchors = 0
            if tag in CLOSES:
                for k in range(len(stack) - 1, 0, -1):
                    t = nodes[stack[k]].tag
                    if t in CLOSES[tag]:
                        del stack[k:]
                        break
                    if t in SCOPES and t not in CLOSES[tag]:
                        break
            elif tag not in ("html", "hr"):
                for k in range(len(stack) - 1, 0, -1):  # a paragraph or heading ends where a block begins
                    if nodes[stack[k]].tag in ("p",):
                        del stack[k:]
                        break
                    if nodes[stack[k]].tag in SCOPES:
                        break
            if tag in ("body",) and nodes[stack[-1]].tag == "head":
                stack.pop()
            if tag not in VOID and tag != "html":
                names = " ".join(x.strip("\"'") for x in _NAMED.findall(m["attrs"])) if m["attrs"] else ""
                nodes.append(Node(tag, stack[-1], nodes, names))
                stack.append(len(nodes) - 1)
    flush()
    for node in reversed(nodes[1:]):  # children come after their parents
        up = nodes[node.parent]
        up.chars += node.chars
        up.link_chars += node.link_chars
    return nodes


def features(n: Node) -> list[float]:
    leaf = n.tag == "#"
    share = n.link_chars / n.chars if n.chars else 0.0
    words = n.text.count(" ") + 1 if leaf else 0
    return [1.0, float(leaf), float(n.against), float(n.favour), float(n.tag in ("article", "main")), float(n.in_article),
            float(n.tag in ("header", "footer", "address")), float(n.tag in ("ul", "ol", "li", "dl", "table")),
            float(n.tag in ("p", "blockquote", "pre", "figcaption")), float(n.tag in HEADINGS), share,
            math.log1p(n.chars) / 8 if leaf else 0.0, math.log1p(n.chars) / 8 if not leaf else 0.0,
            float(leaf and words < 4), float(leaf and n.text[-1] in ".!?…\"”»"), float(leaf and n.text[0] in "©®"),
            float(n.tag in ("div", "section")), float(n.tag in ("body", "html")), float(n.under)]


def marginals(nodes: list[Node], w: np.ndarray, pair: np.ndarray) -> list[float]:
    """P(content) of every node by sum-product: messages up, then down."""
    n = len(nodes)
    unary = (np.array([features(x) for x in nodes]) @ w).tolist()
    odds = [-40.0 if x.out else max(-30.0, min(30.0, u)) for x, u in zip(nodes, unary)]
    p00, p01, p10, p11 = pair.ravel().tolist()  # [parent class][child class]
    exp, log = math.exp, math.log
    up = [0.0] * n  # message to the parent, as log odds
    below = odds[:]  # own potential and all messages from children
    for i in range(n - 1, 0, -1):
        b = exp(max(-40.0, min(40.0, below[i])))
        up[i] = log((p10 + p11 * b) / (p00 + p01 * b))
        below[nodes[i].parent] += up[i]
    full = below[:]
    for i in range(1, n):
        rest = exp(max(-40.0, min(40.0, full[nodes[i].parent] - up[i])))
        full[i] = below[i] + log((p01 + p11 * rest) / (p00 + p10 * rest))
    return [1 / (1 + exp(max(-40.0, min(40.0, -f)))) for f in full]


def label(nodes: list[Node]) -> None:
    """Element classes from the truth of their text blocks: content if most of the text is."""
    mine = [0] * len(nodes)
    for i in range(len(nodes) - 1, -1, -1):
        x = nodes[i]
        if x.tag == "#":
            mine[i] = x.chars if x.truth else 0
        elif x.chars:
            x.truth = mine[i] * 2 > x.chars
        if i:
            mine[x.parent] += mine[i]


def train(pages: list[list[Node]]) -> tuple[np.ndarray, np.ndarray]:
    """(weights, parent-child chances) of labelled trees."""
    rows, y = [], []
    pair = np.array([[20.0, 1.0], [2.0, 20.0]])
    for nodes in pages:
        for x in nodes:
            if x.truth is None or x.out:
                continue
            rows.append(features(x))
            y.append(float(x.truth))
            up = nodes[x.parent] if x.parent >= 0 else None
            if up is not None and up.truth is not None:
                pair[int(up.truth), int(x.truth)] += 1
    w = np.zeros(N_FEATURES)
    if rows:
        a, t = np.array(rows), np.array(y)
        seen = np.full(N_FEATURES, 1e-8)
        for _ in range(ROUNDS):
            g = a.T @ (1 / (1 + np.exp(-np.clip(a @ w, -30, 30))) - t) / len(t) + 1e-3 * w
            seen += g * g
            w -= 0.5 * g / np.sqrt(seen)
    return w, pair / pair.sum(axis=1, keepdims=True)


def made_page(rng: random.Random, words: list[str]) -> list[Node]:
    """A labelled page: places that articles and boilerplate are found in, filled with the corpus's words.

    Content blocks are told from the others by a mark that is taken off the texts again.
    """
    def say(n):
        return " ".join(rng.choice(words) for _ in range(n))

    def attr():
        return rng.choice(["class", "id"])

    def around(inner, tag, names):
        return f'<{tag} {attr()}="{names}">{inner}</{tag}>' if names else f"<{tag}>{inner}</{tag}>"

    def boiler():
        tag, names = rng.choice([
            ("nav", ""), ("div", "menu"), ("ul", "nav-links"), ("div", "sidebar"), ("aside", ""), ("div", "ad"), ("div", "advert-box"),
            ("div", "cookie-notice"), ("section", "comments"), ("div", "comment-list"), ("footer", ""), ("div", "site-footer"),
            ("header", ""), ("div", "page-header"), ("div", "related-posts"), ("div", "share"), ("div", "newsletter"), ("form", ""),
            ("div", "widget"), ("div", "banner"), ("div", "breadcrumbs"), ("div", ""), ("ul", "")])
        kind = rng.random()
        if kind < 0.45 or not names and tag in ("div", "ul"):
            inner = "<ul>" + "".join(f'<li><a href="/">{say(rng.randint(1, 3))}</a></li>' for _ in range(rng.randint(3, 8))) + "</ul>"
        elif kind < 0.8:
            inner = "".join(f"<p>{say(rng.randint(2, 25))}.</p>" for _ in range(rng.randint(1, 4)))
        else:
            inner = say(rng.randint(2, 15))
        return around(inner, tag, names)

    def block():
        kind = rng.random()
        if kind < 0.75:
            return f"<p>\x02{say(rng.choice([2, 8, 20, 60]))}.</p>"
        if kind < 0.82:
            return f"<h2>\x02{say(rng.randint(2, 7))}</h2>"
        if kind < 0.9:
            return "<ul>" + "".join(f"<li>\x02{say(rng.randint(3, 15))}</li>" for _ in range(rng.randint(2, 5))) + "</ul>"
        if kind < 0.95:
            return f"<blockquote>\x02{say(rng.randint(8, 30))}.</blockquote>"
        return f'<p>\x02{say(6)} <a href="/">{say(3)}</a> {say(9)}.</p>'

    body = [block() for _ in range(rng.randint(2, 10))]
    for _ in range(rng.choice([0, 0, 0, 1, 2])):
        body.insert(rng.randint(0, len(body)), around(f"<p>{say(rng.randint(3, 20))}.</p>", "div", rng.choice(["ad", "share", "related", "newsletter", "promo"])))
    tag, names = rng.choice([("article", ""), ("article", "post"), ("main", ""), ("div", "content"), ("div", "post-body"),
                             ("div", "entry-content"), ("div", "article"), ("section", "story"), ("div", "main"), ("div", "")])
    head = f"<h1>\x02{say(rng.randint(2, 9))}</h1>"
    inner = head + "".join(body)
    if rng.random() < 0.2:
        inner = f"<header>{head}</header>" + "".join(body)
    core = around(inner, tag, names)
    if rng.random() < 0.4:
        core = around(core, "div", rng.choice(["", "wrapper", "page", "container"]))
    page = "".join(boiler() for _ in range(rng.randint(1, 3))) + core + "".join(boiler() for _ in range(rng.randint(1, 4)))
    nodes = parse(f"<html><body>{page}</body></html>")
    for x in nodes:
        if x.tag == "#":
            x.truth = "\x02" in x.text
            x.text = x.text.replace("\x02", "").strip() or "-"
    label(nodes)
    return nodes


def tagged_page(page: str) -> list[Node] | None:
    """A page that names its article by element: its text blocks are labelled by that."""
    nodes = parse(page)
    if not any(x.tag in ("article", "main") for x in nodes):
        return None
    for x in nodes:
        if x.tag == "#":
            held = x
            truth = x.in_article
            while held.parent >= 0:
                held = nodes[held.parent]
                truth = truth and not held.against and held.tag not in ("footer", "aside", "nav", "form")
            x.truth = truth
    label(nodes)
    return nodes


def fit(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> tuple[np.ndarray, np.ndarray]:
    """The model, from at most MAX_PAGES pages of the table that name their article, and MADE_PAGES made ones.

    Pages are taken by the order of the hash of their html, and at most 200,000 code
    points of each (this bounds the training sample only).
    """
    src = pages.select(F.coalesce(html_col, F.lit("")).alias("h")).withColumn("k", F.xxhash64("h"))
    # only numbers go through the ordering; the pages themselves are then MAX_PAGES at most
    picked = src.select("k").distinct().orderBy("k").limit(MAX_PAGES)
    rows = (src.join(F.broadcast(picked), "k").select("k", F.left("h", F.lit(200_000)).alias("h"))
            .groupBy("k").agg(F.min("h").alias("h")).collect())
    rows.sort(key=lambda r: r.k)
    labelled, words = [], []
    for r in rows:
        nodes = tagged_page(r.h)
        if nodes:
            labelled.append(nodes)
            words += [w for x in nodes if x.tag == "#" for w in x.text.split()[:200]]
    rng = random.Random(7)
    words = words or "the of and to in is that for on with as by this from at or".split()
    return train(labelled + [made_page(rng, words) for _ in range(MADE_PAGES)])


def main_text(page: str, w: np.ndarray, pair: np.ndarray) -> str:
    nodes = parse(page)
    p = marginals(nodes, w, pair)
    return "\n\n".join(x.text for x, q in zip(nodes, p) if x.tag == "#" and q > 0.5)


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", model=None) -> DataFrame:
    """``id_col``, url, text, n_chars for every row of ``pages``.

    Null or empty html, and pages without content: empty text. Repeated rows come back
    as often as they came in. An empty table gives an empty result. ``model``: what
    ``fit`` returned; by default it is fitted here.
    """
    w, pair = model or fit(pages, id_col, html_col)
    shared = pages.sparkSession.sparkContext.broadcast((w, pair))

    def run(frames):
        for f in frames:
            texts = [main_text(h or "", *shared.value) for h in f["html"]]
            yield pd.DataFrame({"id": f["id"].astype(object), "url": f["url"].astype(object), "text": pd.Series(texts, dtype=object, index=f.index)})

    src = pages.select(F.col(id_col).cast("string").alias("id"), F.col("url"), F.col(html_col).alias("html"))
    out = src.mapInPandas(run, "id string, url string, text string")
    kind = dict(pages.dtypes)[id_col]
    return out.select(F.col("id").cast(kind).alias(id_col), "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op3_html_extraction(spark, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
