"""HTML extraction with a tree-structured graphical model over the DOM.

Block elements and the runs of text between them are the nodes of a page's
tree; each is content or not. A node has a potential from its features (tag,
words of its class, id and role, lengths, links, punctuation), a parent and its child
have a potential by the child's kind. Sum-product messages go up from the
leaves and down from the root; they give every node's marginal, and the main
text is the runs that are more likely content than not. The weights are learned
by gradient ascent on the likelihood of labelled pages, whose gradient comes
from the same marginals.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quadra.llm.common import bounded_batches
from quadra.llm.samplepages import LABEL, labelled_pages

# --- fixed values: elements of HTML, and words that name parts of a page ---------------
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Their text is never shown as text of the page.
UNSEEN = frozenset("script style template noscript iframe object svg canvas select textarea audio video title button datalist".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PARTS = {
    "menu": "nav navbar navigation menu menubar toolbar tabs breadcrumb crumb pagination pager toc skip jump topbar",
    "head": "header masthead logo branding tagline banner top",
    "foot": "footer foot copyright legal colophon bottom imprint contentinfo",
    "side": "sidebar aside side widget rail complementary column secondary related recommend more trending popular tag cloud archive",
    "notice": "cookie consent gdpr notice alert popup modal overlay toast message warning paywall disclaimer info privacy",
    "ad": "ad ads advert advertisement sponsor sponsored promo promotion adsense dfp commercial partner",
    "form": "form search login signup subscribe newsletter register subscription contact input",
    "reader": "comment comments disqus reply replies respond discussion review feedback thread commentlist",
    "share": "share sharing social follow like facebook twitter",
    "main": "article content post entry main story body text copy prose read page blog news hentry document maincontent",
    "title": "title headline heading",
}
# ------------------------------------------------------------------------------------------
HIDDEN = len(PARTS) + 1
_PART = {word: k for k, words in enumerate(PARTS.values(), 1) for word in words.split()}
_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+'|["'])*+)(?:>|\Z)""",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")
# Elements that a new one of a kind ends, and those that stop the search for it.
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dd": ({"dd", "dt"}, {"dl"}), "dt": ({"dd", "dt"}, {"dl"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tr": ({"tr", "td", "th"}, {"table"}),
    "tbody": ({"tbody", "thead", "tfoot"}, {"table"}), "thead": ({"tbody", "thead", "tfoot"}, {"table"}), "tfoot": ({"tbody", "thead", "tfoot"}, {"table"}),
}


class Page:
    """A page's nodes in page order: parent, depth, tag (``#text`` for a run), label; the parts that elements name; texts of runs."""

    def __init__(self) -> None:
        self.parent: list[int] = [-1]
        self.depth: list[int] = [0]
        self.tag: list[str] = ["html"]
        self.label: list[int] = [0]
        self.named: list[tuple[int, int]] = []
        self.text: dict[int, str] = {}
        self.linked: list[int] = []

    def add(self, parent: int, tag: str, label: int) -> int:
        self.parent.append(parent), self.depth.append(self.depth[parent] + 1), self.tag.append(tag), self.label.append(label)
        return len(self.tag) - 1


def _own_parts(attributes: str) -> tuple[set[int], int | None]:
    """Parts that an element's attributes name (``HIDDEN`` if it is not shown), and its label where it bears one."""
    found, label = set(), None
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), a or b or c
        if name in ("class", "id", "role", "aria-label", "itemprop"):
            for token in _TOKEN.findall(value):
                token = token.lower()
                part = _PART.get(token) or _PART.get(token.removesuffix("s"))
                if part:
                    found.add(part)
        elif name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and _HIDDEN.search(value)):
            found.add(HIDDEN)
        elif name == LABEL:
            label = int(value)
    return found, label


def parse(html: str) -> Page:
    """The tree of a page; whatever is malformed is read as browsers do: open paragraphs, items and cells end where the next begins."""
    page = Page()
    stack = [0]
    parts: list[str] = []
    linked = 0
    link_at = 0  # depth of the stack at which a link was opened; 0 outside links

    def close_run() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                page.text[page.add(stack[-1], "#text", page.label[stack[-1]])] = text
                page.linked.append(linked)
            parts.clear()
        linked = 0

    def pop_to(size: int) -> None:
        nonlocal link_at
        close_run()
        del stack[size:]
        if link_at > len(stack):
            link_at = 0

    at, end = 0, len(html)
    while at < end:
        tag = _TAG.search(html, at)
        raw = html[at : tag.start() if tag else end]
        if raw:
            raw = entities.unescape(raw) if "&" in raw else raw
            parts.append(raw)
            if link_at:
                linked += len(raw)
        if tag is None:
            break
        at = tag.end()
        name = tag[2]
        if name is None:
            continue
        name = name.lower()
        if tag[1]:
            if name == "a":
                link_at = 0
            elif name in BLOCKS and name not in ("html", "body"):
                for k in range(len(stack) - 1, 0, -1):
                    if page.tag[stack[k]] == name:
                        pop_to(k)
                        break
        elif name in UNSEEN:
            close = re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I).search(html, at)
            if close:
                at = close.end()
            elif name in ("script", "style", "title", "textarea"):
                break
            parts.append(" ")
        elif name == "br":
            parts.append(" ")
        elif name == "hr":
            close_run()
        elif name == "a":
            link_at = len(stack)
        elif name in BLOCKS and name != "html":
            if page.tag[stack[-1]] == "p" or (name in HEADINGS and page.tag[stack[-1]] in HEADINGS):
                pop_to(len(stack) - 1)
            ends, until = _ENDS.get(name, ((), ()))
            for k in range(len(stack) - 1 if ends else 0, 0, -1):
                if page.tag[stack[k]] in until:
                    break
                if page.tag[stack[k]] in ends:
                    pop_to(k)
                    if name not in ("tr", "tbody", "thead", "tfoot"):
                        break
            close_run()
            own, label = _own_parts(tag[3]) if tag[3] else ((), None)
            stack.append(page.add(stack[-1], name, page.label[stack[-1]] if label is None else label))
            page.named += [(stack[-1], part) for part in own]
    close_run()
    return page


# --- features ---------------------------------------------------------------------
_KIND = {"#text": 0, "p": 1, "li": 3, "dd": 3, "dt": 3, "td": 4, "th": 4, "tr": 4, "tbody": 4, "thead": 4, "table": 4, "div": 5, "section": 5, "center": 5}
_KIND |= dict.fromkeys(HEADINGS, 2) | dict.fromkeys(("nav", "footer", "header", "aside", "form", "menu"), 6) | dict.fromkeys(("article", "main", "body"), 7)
KINDS = 9
_SENTENCE = tuple(".!?…:;\"”»')]")
_RIGHTS = re.compile(r"©|\ball rights reserved\b|\bcopyright\b", re.I)
_NOTICE = re.compile(r"\b(?:cookies?|consent|privacy policy|subscribe|newsletter|sign (?:up|in)|log ?in|advertisement|sponsored|javascript)\b", re.I)
# Runs of up to so many words are searched for such words.
_SAYING = 60
_TAGS = {name: k for k, name in enumerate(sorted(BLOCKS))}
# Elements whose named parts count anew: a comment may be an article, an article has a header.
_PAIRED = {"article": 0, "header": 1, "section": 2}
# Groups of features, and the bounds of those that are numbers put in classes.
_CLASSES = {
    "words": (2, 4, 8, 16, 40, 100), "linked": (0.01, 0.5, 0.95), "place": (0.02, 0.1, 0.9, 0.98),
    "size": (1, 40, 200, 1000), "links": (0.01, 0.2, 0.5, 0.8), "runs": (1, 2, 4, 10), "sentences": (0.2, 0.5, 0.8),
    "paragraphs": (1, 3), "of": (0.1, 0.4, 0.8),
}
_SIZES = {name: len(bounds) + 1 for name, bounds in _CLASSES.items()} | {
    "ended": 2, "sole": 2, "titled": 1, "in": len(_TAGS), "tag": len(_TAGS), "rights": 1, "notice": 1, "part": HIDDEN + 1, "paired": len(_PAIRED) * (HIDDEN + 1),
}
_FIRST = dict(zip(_SIZES, np.cumsum([0, *_SIZES.values()]).tolist(), strict=False))
FEATURES = sum(_SIZES.values())


# --- the graphical model -----------------------------------------------------------------
class Forest:
    """The trees of many pages in arrays, nodes in order of depth: parents, kinds of the child at each edge, features."""

    def __init__(self, pages: list[Page]):
        sizes = np.array([len(p.tag) for p in pages])
        first = np.cumsum(sizes) - sizes
        tags = [t for p in pages for t in p.tag]
        n = len(tags)
        depth = np.array([d for p in pages for d in p.depth])
        self.order = np.argsort(depth, kind="stable")
        place = np.empty(n, np.int64)
        place[self.order] = np.arange(n)
        self.pages = np.repeat(np.arange(len(pages)), sizes)
        self.pages_in_order = self.pages[self.order]
        parent = np.array([u for p in pages for u in p.parent]) + np.repeat(first, sizes)
        self.edges = np.concatenate([[0], np.cumsum(np.bincount(depth))])
        self.parent = np.where(depth > 0, place[np.where(depth > 0, parent, 0)], -1)[self.order]
        self.kind = np.array([_KIND.get(t, KINDS - 1) for t in tags])[self.order]
        self.root = place[np.repeat(first, sizes)][self.order]

        run = np.array([k + f for p, f in zip(pages, first, strict=True) for k in p.text], dtype=np.int64)
        texts = [t for p in pages for t in p.text.values()]
        long = np.array([len(t) for t in texts], dtype=np.int64)
        words = np.array([t.count(" ") + 1 for t in texts], dtype=np.int64)
        linked = np.minimum(long, np.array([k for p in pages for k in p.linked], dtype=np.int64))
        ended = np.array([t.endswith(_SENTENCE) for t in texts], dtype=np.int64)
        said = [_RIGHTS.search(t) is not None if w < _SAYING else False for t, w in zip(texts, words, strict=True)]
        noted = [_NOTICE.search(t) is not None if w < _SAYING else False for t, w in zip(texts, words, strict=True)]
        at = place[run]

        def whole(values: np.ndarray) -> np.ndarray:
            """Sums over every node's subtree of values of runs."""
            total = np.zeros(n)
            total[at] = values
            return self.gathered(total)

        chars, links, runs, sentences = whole(long), whole(linked), whole(np.ones(len(run))), whole(ended)
        code = np.array([_TAGS.get(t, -1) for t in tags])[self.order]
        own_paragraphs = (code == _TAGS["p"]) & (chars > 0)
        paragraphs = np.bincount(self.parent[own_paragraphs], minlength=n)
        page_chars = np.maximum(chars[self.root], 1)
        before = np.cumsum(long) - long
        begins = np.zeros(len(pages), np.int64)
        page_of = self.pages[run]
        begins[page_of[::-1]] = before[::-1]
        element = np.flatnonzero(code >= 0)

        found: list[tuple[np.ndarray, np.ndarray]] = []

        def classed(name: str, nodes: np.ndarray, values: np.ndarray) -> None:
            found.append((nodes, _FIRST[name] + np.searchsorted(np.array(_CLASSES[name]), values, side="right")))

        classed("words", at, words)
        classed("linked", at, linked / np.maximum(long, 1))
        classed("place", at, (before - begins[page_of]) / page_chars[at])
        found += [(at, _FIRST["ended"] + ended), (at, _FIRST["in"] + np.maximum(code[self.parent[at]], 0))]
        found += [(at[np.array(yes, dtype=bool)], np.full(sum(yes), _FIRST[name])) for name, yes in (("rights", said), ("notice", noted))]
        found.append((element, _FIRST["tag"] + code[element]))
        # The page's only article, or its only main element; elements that hold a title.
        for k, name in enumerate(("article", "main")):
            of = np.flatnonzero(code == _TAGS[name])
            of = of[np.bincount(self.pages_in_order[of], minlength=len(pages))[self.pages_in_order[of]] == 1]
            found.append((of, np.full(len(of), _FIRST["sole"] + k)))
        titles = self.gathered((code == _TAGS["h1"]).astype(float))
        titled = element[titles[element] > 0]
        found.append((titled, np.full(len(titled), _FIRST["titled"])))
        classed("size", element, chars[element])
        classed("links", element, (links / np.maximum(chars, 1))[element])
        classed("runs", element, runs[element])
        classed("sentences", element, (sentences / np.maximum(runs, 1))[element])
        classed("paragraphs", element, paragraphs[element])
        classed("of", element, (chars / page_chars)[element])
        named = [(k + f, part, tags[k + f]) for p, f in zip(pages, first.tolist(), strict=True) for k, part in p.named]
        found.append((place[np.array([k for k, _, _ in named], dtype=np.int64)], _FIRST["part"] + np.array([part for _, part, _ in named], dtype=np.int64)))
        paired = [(k, _PAIRED[t] * (HIDDEN + 1) + part) for k, part, t in named if t in _PAIRED]
        found.append((place[np.array([k for k, _ in paired], dtype=np.int64)], _FIRST["paired"] + np.array([c for _, c in paired], dtype=np.int64)))
        self.owner, self.column = (np.concatenate(x) for x in zip(*found, strict=True))

    def gathered(self, total: np.ndarray) -> np.ndarray:
        """Values of nodes summed over their subtrees, level by level."""
        for a, b, c in zip(self.edges[-3::-1], self.edges[-2:0:-1], self.edges[:1:-1], strict=False):
            total[a:b] += np.bincount(self.parent[b:c] - a, total[b:c], b - a)
        return total

    def beliefs(self, weights: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Marginals of every node and of every node with its parent, by messages up and then down the trees."""
        n = len(self.parent)
        up = np.zeros((n, 2))
        up[:, 1] = np.bincount(self.owner, weights[self.column], n)
        link = edges[self.kind]  # [node, label of the parent, label of the node]
        sent = np.zeros((n, 2))
        bounds = self.edges
        for k in range(len(bounds) - 2, 0, -1):
            a, level = bounds[k - 1], slice(bounds[k], bounds[k + 1])
            sent[level] = np.logaddexp(link[level, :, 0] + up[level, None, 0], link[level, :, 1] + up[level, None, 1])
            for y in (0, 1):
                up[a : bounds[k], y] += np.bincount(self.parent[level] - a, sent[level, y], bounds[k] - a)
        belief, joint = up.copy(), np.zeros((n, 2, 2))
        for k in range(1, len(bounds) - 1):
            level = slice(bounds[k], bounds[k + 1])
            rest = belief[self.parent[level]] - sent[level]
            rest -= rest.max(axis=1, keepdims=True)
            both = link[level] + rest[:, :, None]
            belief[level] = up[level] + np.logaddexp(both[:, 0], both[:, 1])
            joint[level] = both + up[level][:, None, :]
        node = _normal(belief)
        return node, _normal(joint.reshape(n, 4)).reshape(n, 2, 2)


def _normal(scores: np.ndarray) -> np.ndarray:
    shares = np.exp(scores - scores.max(axis=1, keepdims=True))
    return shares / shares.sum(axis=1, keepdims=True)


class Model:
    """Weights of the features for content, and potentials [child's kind, parent's label, child's label]."""

    def __init__(self, weights: np.ndarray, edges: np.ndarray):
        self.weights, self.edges = weights, edges

    def marginals(self, pages: list[Page]) -> list[np.ndarray]:
        """Each page's probabilities of content, by node."""
        if not pages:
            return []
        forest = Forest(pages)
        node, _ = forest.beliefs(self.weights, self.edges)
        found = np.empty(len(node))
        found[forest.order] = node[:, 1]
        return np.split(found, np.cumsum([len(p.tag) for p in pages])[:-1])


def train(htmls: Iterable[str], steps: int = 150, rate: float = 0.2, ridge: float = 0.001) -> Model:
    """A model from labelled pages: elements marked with the attribute ``data-content`` 0 or 1, which holds for all inside.

    The gradient of the log-likelihood is the observed counts of features and of
    edges less the expected ones; steps are Adam's. The pages are held in memory.
    """
    pages = [parse(h) for h in htmls]
    forest = Forest(pages)
    label = np.array([y for p in pages for y in p.label])[forest.order]
    inner = forest.parent >= 0
    observed = np.zeros((KINDS, 2, 2))
    np.add.at(observed, (forest.kind[inner], label[forest.parent[inner]], label[inner]), 1)
    m = len(pages)
    theta = np.zeros(FEATURES + 4 * KINDS)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        node, joint = forest.beliefs(theta[:FEATURES], theta[FEATURES:].reshape(KINDS, 2, 2))
        flat = joint[inner].reshape(-1, 4)
        expected = np.stack([np.bincount(forest.kind[inner], flat[:, c], KINDS) for c in range(4)], axis=1).reshape(KINDS, 2, 2)
        slope = np.concatenate([np.bincount(forest.column, (label - node[:, 1])[forest.owner], FEATURES), (observed - expected).ravel()]) / m - ridge * theta
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
        theta += rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return Model(theta[:FEATURES], theta[FEATURES:].reshape(KINDS, 2, 2))


def main_text(page: Page, content: np.ndarray) -> str:
    """The page's runs that are content, in page order, parted by two line feeds."""
    return "\n\n".join(text for node, text in page.text.items() if content[node] >= 0.5)


# --- the operator -----------------------------------------------------------------------
def extract(html: Column, model: Model) -> Column:
    """Main text of a page's html; the empty text for null, for empty html and for pages without content.

    White space (Unicode's) inside a block is one space; character references
    are decoded once. A page is judged by itself, so repeated rows get one
    answer; its whole tree is held in one task.
    """
    @F.pandas_udf("string")
    def texts(htmls: pd.Series) -> pd.Series:
        pages = [parse(h or "") for h in htmls]
        return pd.Series([main_text(p, c) for p, c in zip(pages, model.marginals(pages), strict=True)], dtype=object)

    return texts(F.coalesce(html, F.lit("")))


def op13_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages' main text, by a model of labelled sample pages."""
    pages = bounded_batches(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    found = pages.select("page_id", "url", extract(F.col("html"), train(labelled_pages())).alias("text"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
