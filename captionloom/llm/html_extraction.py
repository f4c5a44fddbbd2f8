"""HTML extraction with a tree-structured graphical model over the page's blocks.

A page becomes a tree: its block elements, and below them the runs of text that they hold. Every
node is content or not. Unary potentials are log-linear in what a node shows (tag, words of class, id
and role, length, share of link text, how it ends); pairwise potentials tie each child to its parent, apart for
elements and for text. Sum-product message passing, upward and downward, gives each node's exact
marginal; the same marginals give the gradient when the weights are trained (by the likelihood of labelled
pages, see html_pages). Text whose marginal is at least one half is kept.

Defined cases: null and empty pages give the empty text; text outside any element and pages without a body are
taken as they stand; unclosed and stray tags are closed or ignored as browsers mostly do; a page
that ends inside a tag, comment or script loses that tail; where no run is content the text is empty; very
long pages are taken whole; repeated rows give repeated results; an empty table gives no rows; further columns pass through.
"""

from __future__ import annotations

import functools
import html
import math
import pickle
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from captionloom.llm.common import safe_name
from captionloom.llm.html_pages import LABEL, labelled_pages

#: Labelled pages, passes over them, and the pace and decay of their gradients.
PAGES, PASSES, RATE, DECAY = 320, 40, 0.1, 1e-3

# Elements by how they are laid out.
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup html label legend li main menu nav ol optgroup option p pre section select summary table tbody td tfoot th thead tr ul button".split())
SKIPPED = frozenset("script style title noscript template iframe textarea svg math head object canvas audio video".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: A start tag closes these, up to the nearest of the second set.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
NOT_IN_P = BLOCKS - {"label", "button", "option", "optgroup", "select"}

_TOKEN = re.compile(r"<!--(?:.*?-->|.*)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*)(?:>|$)", re.S)
_ATTR = re.compile(r"([a-zA-Z][\w:-]*+)\s*+(?:=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]*+)))?")
_SPACE = re.compile(r"\s+")
_NAMES = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Node:
    """An element or, with tag '#', a run of text."""

    __slots__ = ("tag", "parent", "features", "text", "label", "chars", "linked")

    def __init__(self, tag: str, parent: int, features: list[str], label: int | None = None):
        self.tag, self.parent, self.features, self.label = tag, parent, features, label
        self.text: list[str] = []
        self.chars = self.linked = 0


def _element_features(tag: str, attrs: str) -> tuple[list[str], int | None]:
    out, label = [f"tag={tag}"], None
    if attrs and not attrs.isspace():
        named = 0
        for m in _ATTR.finditer(attrs):
            name, value = m.group(1).lower(), m.group(2) or m.group(3) or m.group(4) or ""
            if name == LABEL:
                label = int(value)
            elif name in ("class", "id", "role"):
                for x in _NAMES.findall(value)[:24]:
                    out.append(f"name={x.lower()}")
                    named = 1
            elif name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and "none" in value):
                out.append("hidden")
        if named:
            out.append("named")
    return list(dict.fromkeys(out)), label


def parse(page: str | None) -> list[Node]:
    """Nodes in page order, parents before children; the first is the page itself."""
    nodes = [Node("#page", -1, ["tag=#page"])]
    stack: list[tuple[str, int]] = [("#page", 0)]
    run: Node | None = None
    links = 0
    text = page or ""
    at = 0

    def say(piece: str) -> None:
        nonlocal run
        if run is None:
            if piece.isspace():
                return
            run = Node("#", stack[-1][1], [], nodes[stack[-1][1]].label)
            nodes.append(run)
        run.text.append(piece)
        n = len(piece.strip())
        run.chars += n
        if links:
            run.linked += n

    def pop_to(k: int) -> None:
        nonlocal run
        del stack[k:]
        run = None

    size = len(text)
    while at < size:
        m = _TOKEN.search(text, at)
        if not m:
            say(text[at:])
            break
        if m.start() > at:
            say(text[at : m.start()])
        at = m.end()
        tag = m.group(2) or m.group(5)
        if not tag:
            continue
        tag = tag.lower()
        if m.group(1) or m.group(4):
            if tag == "a":
                links = max(0, links - 1)
            elif tag in BLOCKS:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] == tag:
                        pop_to(k)
                        break
                run = None
            continue
        if tag in SKIPPED:
            if tag == "head":
                continue
            end = re.compile(f"</{re.escape(tag)}(?=[\\s/>])[^>]*>", re.I).search(text, at)
            at = end.end() if end else size
            continue
        if tag == "br":
            say(" ")
        elif tag == "hr":
            run = None
        elif tag == "a":
            links += 1
        elif tag in BLOCKS:
            if tag in NOT_IN_P:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] == "p":
                        pop_to(k)
                        break
                    if stack[k][0] in ("td", "th", "li", "div", "section", "article", "button"):
                        break
            if tag in CLOSES:
                closed, inside = CLOSES[tag]
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] in closed:
                        pop_to(k)
                    elif stack[k][0] in inside:
                        break
            features, label = _element_features(tag, m.group(3) or m.group(6) or "")
            features.append(f"tag={tag},in={stack[-1][0]}")
            nodes.append(Node(tag, stack[-1][1], features, label))
            run, links = None, 0
            stack.append((tag, len(nodes) - 1))
    return nodes


def block_text(node: Node) -> str:
    return _SPACE.sub(" ", html.unescape("".join(node.text))).strip()


def _run_features(node: Node, parent: Node, text: str) -> list[str]:
    words = text.count(" ") + 1 if text else 0
    size = 0 if words < 4 else 1 if words < 10 else 2 if words < 25 else 3 if words < 60 else 4
    share = node.linked / node.chars if node.chars else 0.0
    linked = 0 if share == 0 else 1 if share < 0.35 else 2 if share < 0.8 else 3
    out = [f"words={size}", f"linked={linked}", f"in={parent.tag}", f"in={parent.tag},linked={linked}"]
    if text[-1:] in ".!?…:;\"”»":
        out.append("ends")
    if "©" in text:
        out.append("copyright")
    if "|" in text or "·" in text or "»" in text:
        out.append("bars")
    return out


def tree(page: str | None) -> tuple[list[Node], list[str]]:
    """Nodes with all their features, and the runs' texts (empty for elements)."""
    nodes = parse(page)
    texts = [""] * len(nodes)
    for k, node in enumerate(nodes):
        if node.tag == "#":
            texts[k] = block_text(node)
            node.features = _run_features(node, nodes[node.parent], texts[k])
    return nodes, texts


class Model:
    """Unary weights (log-odds of content) and, for elements and for text, the pairwise log potentials of
    (parent, child) = (0, 1), (1, 0) and (1, 1); that of (0, 0) is zero."""

    def __init__(self, unary: dict[str, float], pairs: dict[str, list[float]]):
        self.unary, self.pairs = unary, pairs

    def marginals(self, nodes: list[Node]) -> tuple[list[float], list[tuple[float, float, float]]]:
        """Probability that each node is content, and the pairwise marginals (0, 1), (1, 0), (1, 1) with its parent."""
        n, get, exp, log = len(nodes), self.unary.get, math.exp, math.log
        own = [sum(get(f, 0.0) for f in node.features) for node in nodes]
        tables = {kind: [1.0, exp(w[0]), exp(w[1]), exp(w[2])] for kind, w in self.pairs.items()}
        text, element = tables["text"], tables["element"]
        up = [0.0] * n
        # Upward: children come after their parents, so a backward pass meets all of a node's children first.
        for k in range(n - 1, 0, -1):
            node = nodes[k]
            s = own[k]
            s = 30.0 if s > 30 else -30.0 if s < -30 else s
            e = exp(s)
            p = text if node.tag == "#" else element
            up[k] = log((p[2] + p[3] * e) / (p[0] + p[1] * e))
            own[node.parent] += up[k]
        # Downward: own holds a node's unary log-odds and all its children's messages.
        out = [0.0] * n
        joint = [(0.0, 0.0, 0.0)] * n
        belief = own[:]
        for k in range(n):
            node = nodes[k]
            if k:
                p = text if node.tag == "#" else element
                rest = belief[node.parent] - up[k]
                rest = 30.0 if rest > 30 else -30.0 if rest < -30 else rest
                r = exp(rest)
                s = own[k]
                s = 30.0 if s > 30 else -30.0 if s < -30 else s
                e = exp(s)
                a, b, c, d = p[0], p[1] * e, r * p[2], r * p[3] * e
                total = a + b + c + d
                joint[k] = (b / total, c / total, d / total)
                belief[k] = own[k] + log((p[1] + r * p[3]) / (p[0] + r * p[2]))
            x = belief[k]
            out[k] = 1 / (1 + exp(-x)) if x > -700 else 0.0
        return out, joint

    def extract(self, page: str | None) -> str:
        nodes, texts = tree(page)
        probability, _ = self.marginals(nodes)
        return "\n\n".join(texts[k] for k, p in enumerate(probability) if p >= 0.5 and texts[k])


def _targets(nodes: list[Node]) -> list[int]:
    """A run has its element's label; an element is content if anything in it is."""
    out = [0] * len(nodes)
    for k in range(len(nodes) - 1, 0, -1):
        node = nodes[k]
        if node.tag == "#":
            out[k] = node.label or 0
        if out[k]:
            out[node.parent] = 1
    return out


def train(pages: list[str], passes: int = PASSES) -> Model:
    """Gradient ascent (Adam) on the likelihood of the labelled pages' nodes."""
    trees = [tree(p)[0] for p in pages]
    wanted = [_targets(nodes) for nodes in trees]
    seen: defaultdict[str, int] = defaultdict(int)
    for nodes in trees:
        for f in {f for node in nodes for f in node.features}:
            seen[f] += 1
    model = Model({f: 0.0 for f, n in seen.items() if n >= 2}, {"text": [-8.0, 0.0, 0.0], "element": [-8.0, 0.0, 0.0]})
    first: defaultdict = defaultdict(float)
    second: defaultdict = defaultdict(float)
    step, group = 0, 16
    for _ in range(passes):
        for lo in range(0, len(trees), group):
            g: defaultdict = defaultdict(float)
            for nodes, y in zip(trees[lo : lo + group], wanted[lo : lo + group], strict=True):
                p, joint = model.marginals(nodes)
                for k, node in enumerate(nodes):
                    miss = y[k] - p[k]
                    for f in node.features:
                        g[f] += miss
                    if k:
                        kind, state = ("text" if node.tag == "#" else "element"), (y[node.parent], y[k])
                        for j, s in enumerate(((0, 1), (1, 0), (1, 1))):
                            g[kind, j] += (state == s) - joint[k][j]
            step += 1
            for f, x in g.items():
                pair = isinstance(f, tuple)
                if not pair and f not in model.unary:
                    continue
                value = model.pairs[f[0]][f[1]] if pair else model.unary[f]
                x = x / group - DECAY * value
                first[f] = 0.9 * first[f] + 0.1 * x
                second[f] = 0.99 * second[f] + 0.01 * x * x
                value += RATE * (first[f] / (1 - 0.9**step)) / (math.sqrt(second[f] / (1 - 0.99**step)) + 1e-3)
                if pair:
                    model.pairs[f[0]][f[1]] = max(-12.0, min(12.0, value))
                else:
                    model.unary[f] = value
    return model


@functools.lru_cache(maxsize=2)
def default_model(pages: int = PAGES) -> Model:
    return train(labelled_pages(pages))


def extract(pages: DataFrame, model: Model | None = None, html_col: str = "html", text_col: str = "text") -> DataFrame:
    """Adds the main text of each page."""
    text_col = safe_name(pages, text_col)
    sent = pages.sparkSession.sparkContext.broadcast(pickle.dumps(model or default_model()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Model = pickle.loads(sent.value)
        for whole in batches:
            for lo in range(0, whole.num_rows, 256):
                batch = whole.slice(lo, 256)
                texts = [own.extract(p) for p in batch.column(html_col).to_pylist()]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, text_col])

    return pages.mapInArrow(run, T.StructType([*pages.schema.fields, T.StructField(text_col, T.StringType())]))
