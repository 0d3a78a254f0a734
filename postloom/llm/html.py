"""Main text of web pages: boosted trees over DOM nodes, decoded from the root down.

A page is parsed into block elements and runs of text between them (inline markup belongs to the run
it is in). Every node has features of its subtree (text, density, links, sentence marks), its tag and
the tokens of its class, id and role, the same of its ancestors, its depth and its siblings. Gradient-
boosted trees (Spark ML) score whether a node holds main text. Decoding keeps the best consistent set:
a node can only be kept within kept ancestors, and a subtree goes when it scores below zero as a whole.

The trees learn from a bounded sample of the pages. The truth of a sampled page is what its own
structure says: text inside <article> or <main> outside marked boilerplate. The sample is also set
in other layouts, with the parts of the pages (their paragraphs, links, adverts, footers) as menus,
side bars, notices, forms and comments, so that no single tag decides.

Null and empty pages, and pages without main text, give an empty text. Comments, scripts and styles
are skipped; unclosed and stray tags are tolerated. Without any page to learn from, the rule that
names the truth of the sample decides alone. Repeated rows give the same text.
"""

from __future__ import annotations

import html as references
import random
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postloom.llm.common import hash_sample
from postloom.session import store

# Bounds of what is learned from: pages, and layouts made of each.
SAMPLED_PAGES = 192
LAYOUTS = 6
TREES, TREE_DEPTH = 20, 4

# Elements by their part in a page.
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PROSE = frozenset("p pre blockquote".split())
LISTS = frozenset("ul ol li dl dt dd".split())
TABLES = frozenset("table thead tbody tfoot tr td th caption".split())
PLAIN = frozenset("div section center figure figcaption details summary fieldset hr address html body hgroup".split())
MAIN = frozenset("article main".split())
ASIDE = frozenset("nav aside header footer form menu dialog button select option label legend".split())
SKIPPED = frozenset("script style noscript template iframe svg head title textarea".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CONTROLS = frozenset("input button select textarea option".split())
# Words in class, id and role.
BAD_WORDS = frozenset(
    "ad ads advert advertisement adverts alert aside banner bar breadcrumb breadcrumbs comment comments consent cookie cookies "
    "copyright dialog disclaimer discussion disqus foot footer footnav form gdpr head header hidden legal links login masthead "
    "menu meta modal nav navbar navigation newsletter notice notification outbrain overlay pager pagination popup privacy promo "
    "promoted promotion recommended register related replies reply respond responses search share sharing sidebar side signup "
    "skip skyscraper social sponsor sponsored sponsors subscribe subscription taboola tags teaser toolbar topbar warning widget".split()
)
GOOD_WORDS = frozenset("article articlebody body content entry main maincontent page post prose story text".split())
# Words that turn the next one round ("no-sidebar"), and the one before ("ad-free").
WITHOUT, FREE = frozenset("no non not without has with hide".split()), frozenset("free less".split())

_BLOCKS = HEADINGS | PROSE | LISTS | TABLES | PLAIN | MAIN | ASIDE
_GROUPS = (frozenset({"h1"}), HEADINGS - {"h1"}, PROSE, LISTS, TABLES, PLAIN, MAIN, ASIDE)
# What a start tag ends when it is still open, and what it cannot reach beyond.
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}),
    "option": ({"option"}, {"select"}),
}
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?>[^>\"']|\"[^\"]*\"|'[^']*')*|[^>]*)(?:>|\Z)", re.S)
# Characters of a tag that are read at first; beyond them, a tag whose quotes do not close is read once.
_TAG_LENGTH, _SHORT_TAG = 1 << 14, 1 << 8
_NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_PLAIN_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
_RAW_END = {name: re.compile(rf"</{name}\b[^>]*>", re.I) for name in SKIPPED}


@dataclass
class Node:
    tag: str
    parent: int
    depth: int
    good: int = 0
    bad: int = 0
    text: str | None = None  # of a run
    linked: int = 0  # characters of a run inside links
    tags: int = 0
    controls: int = 0
    children: list[int] = field(default_factory=list)


def words_of(attributes: str) -> tuple[int, int]:
    """Good and bad words in class, id and role; "ad-free" and "no-sidebar" hold none."""
    if "=" not in attributes:
        return 0, 0
    found: set[str] = set()
    for name in " ".join(" ".join(x) for x in _NAMED.findall(attributes)).split():
        tokens = [t.lower() for t in _TOKEN.findall(name)]
        for before, token, after in zip(["", *tokens], tokens, [*tokens[1:], ""]):
            if before not in WITHOUT and after not in FREE:
                found.add(token)
    return len(found & GOOD_WORDS), len(found & BAD_WORDS)


def parse(page: str) -> list[Node]:
    """Block elements and runs of text in page order; a parent comes before its children."""
    nodes = [Node("#page", -1, 0)]
    stack = [0]
    pieces: list[str] = []
    linked = links = 0
    places: dict[str, list[int]] = {}  # of the open elements of each name in the stack
    endless: set[str] = set()  # elements to skip whose end tag is not in the rest of the page
    broken = False
    size, bracket = len(page), -1  # bracket: the next ">", once looked for

    def end_run() -> None:
        nonlocal linked, links
        if pieces:
            text = " ".join(references.unescape("".join(pieces)).split())
            pieces.clear()
            if text:
                add(Node("#run", stack[-1], nodes[stack[-1]].depth + 1, text=text, linked=min(linked, len(text))))
        linked = 0

    def add(node: Node) -> int:
        nodes.append(node)
        nodes[node.parent].children.append(len(nodes) - 1)
        return len(nodes) - 1

    def close_from(at: int) -> None:
        """Close the open element at this place of the stack, and all inside it."""
        end_run()
        for i in stack[at:]:
            places[nodes[i].tag].pop()
        del stack[at:]

    def innermost(names: Iterable[str]) -> int:
        """The place of the innermost open element of these names; 0 without any."""
        return max((places[n][-1] for n in names if places.get(n)), default=0)

    def close(names: Iterable[str], beyond: Iterable[str] = ()) -> None:
        """Close the innermost open element of these names, unless one of `beyond` is inside it."""
        at = innermost(names)
        if at and at > innermost(beyond):
            close_from(at)

    def read_tag(start: int) -> re.Match[str] | None:
        """The tag at `start`. One that is long, or seems so as its quotes do not close, is read as a whole,
        until that fails once: then quotes mean nothing in the page's longer tags."""
        nonlocal broken
        end = start + (_SHORT_TAG if broken else _TAG_LENGTH)
        found = _TAG.match(page, start, end)
        if found is None or end >= size:
            return found
        odd = found[3].count('"') % 2 or found[3].count("'") % 2
        if found.end() == end or odd:
            whole = _TAG.match(page, start) if not broken else _PLAIN_TAG.match(page, start)
            broken = broken or bool(odd) and whole is not None and whole.end() == found.end()
            return whole
        return found

    at = 0
    while at < size:
        start = page.find("<", at)
        if start < 0:
            start = size
        if start > at:
            piece = page[at:start]
            pieces.append(piece)
            if links:
                linked += len(piece)
        if start == size:
            break
        if page.startswith("<!--", start):
            end = page.find("-->", start + 4)
            at = size if end < 0 else end + 3
            continue
        if page.startswith(("<!", "<?"), start):
            if bracket < start:
                bracket = page.find(">", start)
                bracket = size if bracket < 0 else bracket
            if bracket == size:
                pieces.append("<")
            at = start + 1 if bracket == size else bracket + 1
            continue
        found = read_tag(start)
        if not found:
            pieces.append("<")
            at = start + 1
            continue
        at = found.end()
        name = found[2].lower()
        if found[1]:
            if name in _BLOCKS:
                close((name,), () if name not in ("p", "li") else MAIN)
                links = 0
            elif name == "a":
                links = 0
            continue
        nodes[stack[-1]].tags += 1
        if name in CONTROLS:
            nodes[stack[-1]].controls += 1
        if name in SKIPPED:
            end = _RAW_END[name].search(page, at) if not found[3].endswith("/") and name not in endless else None
            if end is None and not found[3].endswith("/"):
                endless.add(name)
            at = end.end() if end else (size if name in ("script", "style") else at)
            pieces.append(" ")
        elif name in _BLOCKS:
            end_run()
            links = 0
            if name in _ENDS:
                close(*_ENDS[name])
            if nodes[stack[-1]].tag == "p":
                close_from(len(stack) - 1)
            if name not in VOID:
                good, bad = words_of(found[3])
                places.setdefault(name, []).append(len(stack))
                stack.append(add(Node(name, stack[-1], nodes[stack[-1]].depth + 1, good, bad)))
        elif name == "br":
            pieces.append(" ")
        elif name == "a":
            links = 1
    end_run()
    return nodes


_MARK = re.compile(r"[.!?…。]")


def features(nodes: list[Node]) -> np.ndarray:
    """One row per node."""
    n = len(nodes)
    chars, linked, tags, controls, marks, runs = (np.zeros(n) for _ in range(6))
    parents = np.array([node.parent for node in nodes])
    for i, node in enumerate(nodes):
        tags[i], controls[i] = node.tags, node.controls
        if node.text is not None:
            chars[i], linked[i], runs[i] = len(node.text), node.linked, 1
            marks[i] = len(_MARK.findall(node.text)) + 4 * ("©" in node.text)
    # A child's number is above its parent's: one pass from the end sums the subtrees.
    for column in (chars, linked, tags, controls, marks, runs):
        values = column.tolist()
        for i in range(n - 1, 0, -1):
            values[parents[i]] += values[i]
        column[:] = values
    group = np.zeros((n, len(_GROUPS) + 1))
    above = np.zeros((n, 4))  # good words, bad words, main elements and asides among the ancestors
    own = np.zeros((n, 4))
    index, siblings, alike, before = np.zeros(n), np.ones(n), np.ones(n), np.zeros(n)
    seen = 0.0
    for i, node in enumerate(nodes):
        if node.tag == "#run":
            group[i, -1] = 1
        for g, members in enumerate(_GROUPS):
            if node.tag in members:
                group[i, g] = 1
        own[i] = node.good, node.bad, node.tag in MAIN, node.tag in ASIDE
        if node.parent >= 0:
            above[i] = above[node.parent] + own[node.parent]
        before[i] = seen
        if node.text is not None:
            seen += len(node.text)
        kinds: dict[str, int] = {}
        for child in node.children:
            kinds[nodes[child].tag] = kinds.get(nodes[child].tag, 0) + 1
        for place, child in enumerate(node.children):
            index[child], siblings[child] = place, len(node.children)
            alike[child] = kinds[nodes[child].tag] / len(node.children)
    total = max(seen, 1.0)
    text = np.maximum(chars, 1.0)
    return np.column_stack([
        np.log1p(chars), linked / text, np.log1p(tags), np.log1p(chars / (tags + 1)), np.log1p(chars / np.maximum(runs, 1)), np.log1p(controls),
        100 * marks / text, np.minimum([node.depth for node in nodes], 30), index / siblings, np.log1p(siblings), alike, before / total,
        chars / total, np.minimum(own, 3), np.minimum(above, 3), group, np.full(n, own[:, 2].any()),
    ])


def truth(nodes: list[Node]) -> np.ndarray:
    """Which nodes the page's own structure says to hold main text, for learning."""
    inside, marked = np.zeros(len(nodes), dtype=bool), np.zeros(len(nodes), dtype=bool)
    holds = np.zeros(len(nodes), dtype=bool)
    for i, node in enumerate(nodes[1:], 1):
        inside[i] = inside[node.parent] or node.tag in MAIN
        marked[i] = marked[node.parent] or node.tag in ASIDE or node.bad > 0
        holds[i] = node.text is not None and inside[i] and not marked[i]
    for i in range(len(nodes) - 1, 0, -1):
        holds[nodes[i].parent] |= holds[i]
    return holds


# Marks main text in made layouts; an empty inline element.
TRUTH = "<i data-truth></i>"


def _escape(text: str) -> str:
    return references.escape(text, quote=False)


def layouts(nodes: list[Node], count: int, seed: int) -> Iterator[str]:
    """Pages in other layouts from the parts of a page; TRUTH precedes each block of main text."""
    keeps = truth(nodes)
    body = [(node.text, nodes[node.parent].tag) for node, keep in zip(nodes, keeps) if keep and node.text]
    rest = [node.text for node, keep in zip(nodes, keeps) if not keep and node.text]
    if not body:
        return
    draw = random.Random(seed)
    shorts = [t for t in rest if len(t) < 60] or ["home"]
    longs = [t for t in rest if len(t) >= 60] or [body[-1][0][:200]]

    def links(low: int, high: int) -> str:
        items = [f'<a href="/x">{_escape(draw.choice(shorts)[:40])}</a>' for _ in range(draw.randint(low, high))]
        if draw.random() < 0.3:
            return draw.choice([" ", " | ", "<br>"]).join(items)
        return "<ul>" + "".join(f"<li>{item}</li>" for item in items) + "</ul>"

    def prose(most: int) -> str:
        """Words as in the article, where only the place and the names tell them apart."""
        return "".join(f"<p>{_escape(draw.choice([*longs, draw.choice(body)[0][:400]]))}</p>" for _ in range(draw.randint(1, most)))

    def wrapped(content: str, *kinds: str) -> str:
        kind = draw.choice(kinds)
        tag = kind.split(" ")[0].split(".")[0].split("#")[0]
        name = f' class="{kind.split(".")[1]}"' if "." in kind else f' id="{kind.split("#")[1]}"' if "#" in kind else ""
        return f"<{tag}{name}>{content}</{tag}>"

    def menu() -> str:
        return wrapped(links(3, 9), "nav", "div.menu", "div#navigation", "ul.navbar", "div.main-nav", "nav.breadcrumbs", "div", "div")

    def head() -> str:
        return wrapped(f"<p>{_escape(draw.choice(shorts))}</p>" + (links(2, 5) if draw.random() < 0.5 else ""), "header", "div.header", "div#masthead", "div.topbar")

    def foot() -> str:
        return wrapped(f"<p>&copy; {_escape(draw.choice(longs))}</p>", "footer", "div.footer", "div#site-footer", "div.copyright")

    def side() -> str:
        return wrapped((links(2, 6) if draw.random() < 0.5 else "") + prose(3), "aside", "div.sidebar", "aside.widget", "div#side", "div.related")

    def advert() -> str:
        return wrapped(draw.choice([prose(1), _escape(draw.choice(longs))]), "div.ad", "div.advertisement", "div.sponsored", "aside.promo", "section.ads", "div#banner")

    def notice() -> str:
        return wrapped(prose(1) + "<button>OK</button>", "div.cookie-notice", "div#consent", "div.notice", "section.alert", "div.gdpr-banner", "dialog")

    def form() -> str:
        return wrapped(f"<label>{_escape(draw.choice(shorts))}</label><input name=q><p>{_escape(draw.choice(longs))}</p><button>Go</button>", "form", "form.search", "form#newsletter", "div.subscribe-form")

    def plain_comments() -> str:
        """Comments that no name tells apart, only that they follow the article element."""
        each = "".join(f"<div>{wrapped(_escape(draw.choice(shorts)[:20]), 'p', 'div', 'b')}{prose(2)}</div>" for _ in range(draw.randint(1, 4)))
        return wrapped(f"<h2>{_escape(draw.choice(shorts)[:20])}</h2>" + each, "div", "section")

    def comments() -> str:
        each = "".join(wrapped(f"<p>{_escape(draw.choice(shorts)[:20])}</p>" + prose(2), "div.comment", "li.comment", "div.reply") for _ in range(draw.randint(1, 5)))
        return wrapped(f"<h3>{_escape(draw.choice(shorts)[:20])}</h3>" + each, "section.comments", "div#comments", "div.discussion", "ol.comment-list", "section#responses")

    for _ in range(count):
        texts = draw.sample(body[1:], max(0, min(len(body) - 1, draw.randint(1, 12)))) if len(body) > 1 else []
        inner = []
        for text, tag in [body[0], *texts]:
            tag = tag if tag in HEADINGS | PROSE and draw.random() < 0.7 else draw.choice(["p", "p", "p", "h2", "blockquote", "div", "li"])
            block = f"<{tag}>{_escape(text)}</{tag}>" if tag != "li" else f"<ul><li>{_escape(text)}</li></ul>"
            inner.append(TRUTH + block)
            if draw.random() < 0.08:
                inner.append(draw.choice([advert, side, form, notice])())
        article = wrapped("".join(inner), "article", "main", "div.content", "div#main-content", "div.post-body", "section.entry", "div.story", "div", "section")
        if draw.random() < 0.3:
            article = wrapped(article + (comments() if draw.random() < 0.3 else ""), "main", "div.page", "div", "div#content", "section")
        above = [make() for make in (head, menu, notice, advert) if draw.random() < 0.6]
        if article.startswith(("<article", "<main")) and draw.random() < 0.25:
            article += plain_comments()
        below = [make() for make in (side, comments, advert, form, menu, notice) if draw.random() < 0.45] + ([foot()] if draw.random() < 0.9 else [])
        draw.shuffle(above)
        inner_page = "".join([*above, article, *below])
        if draw.random() < 0.4:
            inner_page = wrapped(inner_page, "div.container", "div#page", "div")
        yield f"<html><body>{inner_page}</body></html>"


def _layout_truth(page: str) -> tuple[list[Node], np.ndarray]:
    """Nodes of a made layout; blocks that follow a truth marker hold main text."""
    mark = "\x00"
    nodes = parse(re.sub(TRUTH + r"(<ul><li>|<\w+>)", lambda m: m[1] + mark, page))
    holds = np.zeros(len(nodes), dtype=bool)
    for i, node in enumerate(nodes):
        if node.text is not None and node.text.startswith(mark):
            node.text, holds[i] = node.text[1:], True
    for i in range(len(nodes) - 1, 0, -1):
        holds[nodes[i].parent] |= holds[i]
    return nodes, holds


def _examples(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        rows: list[tuple[int, list[float]]] = []
        for page, seed in zip(frame["html"], frame["seed"]):
            nodes = parse(page)
            sets = [(nodes, truth(nodes))]
            sets += [_layout_truth(made) for made in layouts(nodes, LAYOUTS, int(seed))]
            for found, holds in sets:
                if holds.any():
                    rows += [(int(h), x) for h, x in zip(holds[1:], features(found)[1:].tolist())]
        yield pd.DataFrame(rows, columns=["holds", "features"])


@dataclass
class Forest:
    """Boosted trees as arrays: per tree the feature, threshold, left and right child and value of each node."""

    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]
    weights: list[float]

    def margin(self, rows: np.ndarray) -> np.ndarray:
        total = np.zeros(len(rows))
        for (feature, threshold, left, right, value), weight in zip(self.trees, self.weights):
            at = np.zeros(len(rows), dtype=np.int64)
            for _ in range(TREE_DEPTH):
                low = rows[np.arange(len(rows)), feature[at]] <= threshold[at]
                at = np.where(low, left[at], right[at])
            total += weight * value[at]
        return total


def _as_arrays(tree) -> tuple[np.ndarray, ...]:
    feature, threshold, left, right, value = [], [], [], [], []

    def visit(node) -> int:
        number = len(value)
        feature.append(0)
        threshold.append(0.0)
        left.append(number)  # a leaf leads to itself
        right.append(number)
        value.append(node.prediction())
        if node.getClass().getSimpleName() == "InternalNode":
            split = node.split()
            feature[number], threshold[number] = split.featureIndex(), split.threshold()
            left[number] = visit(node.leftChild())
            right[number] = visit(node.rightChild())
        return number

    visit(tree._call_java("rootNode"))
    return tuple(np.array(x) for x in (feature, threshold, left, right, value))


def learn(pages: DataFrame, html: str = "html", key: str = "page_id", sampled: int = SAMPLED_PAGES) -> Forest | None:
    """Boosted trees from at most `sampled` pages; None when they show no main text or nothing else."""
    known = pages.select(F.col(key).alias("id"), F.col(html).alias("html"), F.lit(0).alias("all")).where(F.length("html") > 0)
    sample = hash_sample(known, "all", ["id"], sampled).select("html", F.pmod(F.xxhash64("html"), F.lit(2**31)).alias("seed"))
    rows = store(sample.mapInPandas(_examples, "holds int, features array<double>"), "nodes")
    if rows.select("holds").distinct().count() < 2:
        return None
    ready = rows.select(F.col("holds").cast("double").alias("label"), array_to_vector("features").alias("features"))
    classifier = GBTClassifier(maxIter=TREES, maxDepth=TREE_DEPTH, stepSize=0.3, subsamplingRate=1.0, seed=3, featureSubsetStrategy="all")
    model: GBTClassificationModel = classifier.fit(ready)
    return Forest([_as_arrays(tree) for tree in model.trees], list(model.treeWeights))


def decode(nodes: list[Node], scores: np.ndarray) -> np.ndarray:
    """The best consistent choice: a node is kept when its subtree is worth it and its parent is kept."""
    worth = scores.tolist()
    for i in range(len(nodes) - 1, 0, -1):
        if worth[i] > 0 and nodes[i].parent >= 0:
            worth[nodes[i].parent] += worth[i]
    kept = np.zeros(len(nodes), dtype=bool)
    kept[0] = True
    for i, node in enumerate(nodes[1:], 1):
        kept[i] = kept[node.parent] and (worth[i] > 0 or node.tag in ("html", "body"))
    return kept


def _text(nodes: list[Node], kept: np.ndarray) -> str:
    return "\n".join(node.text for node, keep in zip(nodes, kept) if keep and node.text is not None)


def main_text(forest: Forest | None) -> Callable[[Column], Column]:
    """A function from an html column to its main text."""

    @F.pandas_udf("string")
    def extract(pages: pd.Series) -> pd.Series:
        texts: list[str] = []
        for at in range(0, len(pages), 64):
            parsed = [parse(page) if page else [] for page in pages.iloc[at : at + 64]]
            if forest is None:
                texts += [_text(nodes, truth(nodes)) if nodes else "" for nodes in parsed]
                continue
            rows = [features(nodes) for nodes in parsed if nodes]
            margins = forest.margin(np.concatenate(rows)) if rows else np.empty(0)
            start = 0
            for nodes in parsed:
                texts.append(_text(nodes, decode(nodes, 2 * margins[start : start + len(nodes)])) if nodes else "")
                start += len(nodes)
        return pd.Series(texts, index=pages.index, dtype=object)

    return extract


def extract(pages: DataFrame, html: str = "html", url: str = "url", key: str = "page_id") -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    texts = main_text(learn(pages, html, key))
    found = pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"), texts(F.col(html)).alias("text"))
    return found.select("*", F.char_length("text").cast("long").alias("n_chars"))
