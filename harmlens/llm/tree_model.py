"""Tree-structured model over page nodes: parent-child potentials, sum-product messages up and down.

Every node is content or not. A node's own potential is linear in hashed features of its tag, names, text
and place; each parent-child pair has a 2 x 2 table by the kind of child. Messages of all nodes of one depth
are computed together, upward from the deepest, then downward, and give exact marginals of all nodes.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from zlib import crc32

import numpy as np

from harmlens.llm.page_tree import EMBEDDED, Page

KINDS = ("#text", "p", "h", "list", "table", "div", "section", "other")
GROUP = {"#text": 0, "p": 1, "blockquote": 1, "pre": 1, "ul": 3, "ol": 3, "li": 3, "dl": 3, "dt": 3, "dd": 3, "table": 4, "tr": 4, "td": 4, "th": 4, "tbody": 4, "thead": 4, "tfoot": 4, "caption": 4, "div": 5, "section": 6, "article": 6, "main": 6} | {f"h{k}": 2 for k in range(1, 7)}
FRAMES = EMBEDDED.union("article main nav header footer aside form section menu dialog address".split())
BUCKETS = 1 << 14


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    pairs: np.ndarray  # kind of pair, parent's state, child's state
    names: frozenset[str] = frozenset()  # that tell what an element holds; the others have no part


def kind_of(tag: str) -> int:
    return GROUP.get(tag, 7)


def pair_kind(tag: str, names: tuple[str, ...]) -> int:
    """A named part of a page breaks away from its parent more often than an unnamed one."""
    return kind_of(tag) + len(KINDS) * bool(names)


def _level(x: float, steps: tuple[float, ...]) -> int:
    return sum(x >= s for s in steps)


def told(names: tuple[str, ...], known: frozenset[str] | None) -> tuple[str, ...]:
    return names if known is None else tuple(name for name in names if name in known)


def features(page: Page, known: frozenset[str] | None = None) -> list[list[str]]:
    """Features of each node: its own, and those of all elements around it, with their names (that are ``known``)."""
    nodes = page.nodes
    chars, linked = [0] * len(nodes), [0] * len(nodes)
    for i in range(len(nodes) - 1, 0, -1):
        node = nodes[i]
        if node.tag == "#text":
            chars[i], linked[i] = len(node.text), min(node.linked, len(node.text))
        chars[node.parent] += chars[i]
        linked[node.parent] += linked[i]
    total = max(1, chars[0])
    out = []
    around: list[tuple[str, ...]] = []  # features of the elements that a node stands in, its own included
    for i, node in enumerate(nodes):
        above = around[node.parent] if i else ()
        names = told(node.names, known)
        if node.tag != "#text" and (names or node.tag in FRAMES):
            new = [f for f in dict.fromkeys((*(f"un:{name}" for name in names), f"u:{node.tag}")) if f not in above]
            above = (*above, *new) if new else above
        around.append(above)
        density = _level(linked[i] / max(1, chars[i]), (0.01, 0.2, 0.5, 0.9))
        size = _level(chars[i], (1, 15, 40, 100, 300, 1000))
        f = ["bias", f"t:{node.tag}", f"s:{kind_of(node.tag)}:{size}", f"d:{kind_of(node.tag)}:{density}", f"ds:{density}:{size}"]
        f += [f"n:{name}" for name in names]
        if node.tag == "#text":
            text = node.text
            if size < 5:  # punctuation tells prose from labels only where there is little text
                stops = sum(text.count(c) for c in ".,;:!?")
                f.append(f"stop:{_level(stops / max(1, len(text)), (0.001, 0.01, 0.03))}:{size}")
            f += [f"up:{nodes[node.parent].tag}", *above]
            if text[0] in "©|»«›‹•·":
                f.append("mark")
        elif node.tag != "#page":
            f += [f"share:{_level(chars[i] / total, (0.02, 0.1, 0.3, 0.6, 0.95))}", *around[node.parent]]
        out.append(f)
    return out


_KNOWN: dict[str, int] = {}


def _bucket(name: str) -> int:
    at = _KNOWN.get(name)
    if at is None:
        if len(_KNOWN) > 200_000:
            _KNOWN.clear()
        at = _KNOWN[name] = crc32(name.encode()) % BUCKETS
    return at


@dataclass
class Forest:
    """Nodes of many pages, ready for messages."""

    parent: np.ndarray
    kind: np.ndarray
    depth: np.ndarray
    flat: np.ndarray
    owner: np.ndarray
    begin: np.ndarray  # of each page

    @classmethod
    def of(cls, pages: list[Page], known: frozenset[str] | None = None) -> Forest:
        parent, kind, depth, flat, counts, begin = [], [], [], [], [], [0]
        for page in pages:
            base = begin[-1]
            for node, f in zip(page.nodes, features(page, known)):
                parent.append(node.parent + base if node.parent >= 0 else -1)
                kind.append(pair_kind(node.tag, told(node.names, known)))
                depth.append(node.depth)
                flat.extend(map(_bucket, f))
                counts.append(len(f))
            begin.append(base + len(page.nodes))
        ints = lambda x: np.array(x, dtype=np.int64)
        return cls(ints(parent), ints(kind), ints(depth), ints(flat), np.repeat(np.arange(len(counts)), ints(counts)), ints(begin))


def marginals(forest: Forest, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """P(content) of each node, and pair marginals (parent's state, child's state) of each node with its parent."""
    n = len(forest.parent)
    own = np.bincount(forest.owner, model.weights[forest.flat], minlength=n)
    order = np.argsort(forest.depth, kind="stable")
    cuts = np.searchsorted(forest.depth[order], np.arange(forest.depth.max(initial=0) + 2))
    levels = [order[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
    table = model.pairs[forest.kind]
    up = own.copy()  # log-odds of a node's subtree
    message = np.zeros(n)
    for level in levels[:0:-1]:
        t, u = table[level], up[level]
        message[level] = np.logaddexp(t[:, 1, 1] + u, t[:, 1, 0]) - np.logaddexp(t[:, 0, 1] + u, t[:, 0, 0])
        np.add.at(up, forest.parent[level], message[level])
    down = np.zeros(n)
    for level in levels[1:]:
        above = forest.parent[level]
        rest = up[above] + down[above] - message[level]  # the parent without this child
        t = table[level]
        down[level] = np.logaddexp(t[:, 1, 1] + rest, t[:, 0, 1]) - np.logaddexp(t[:, 1, 0] + rest, t[:, 0, 0])
    p = 1 / (1 + np.exp(-np.clip(up + down, -500, 500)))
    pair = np.zeros((n, 2, 2))
    child = forest.parent >= 0
    above = forest.parent[child]
    rest = up[above] + down[above] - message[child]
    logs = table[child] + np.stack([np.zeros_like(rest), rest], axis=1)[:, :, None] + np.stack([np.zeros_like(rest), up[child]], axis=1)[:, None, :]
    logs -= logs.max(axis=(1, 2), keepdims=True)
    pair[child] = np.exp(logs)
    pair[child] /= pair[child].sum(axis=(1, 2), keepdims=True)
    return p, pair


def labels_of(page: Page) -> np.ndarray:
    """Runs by their label; an element is content where most of its text is."""
    nodes = page.nodes
    good, total = np.zeros(len(nodes)), np.zeros(len(nodes))
    for i in range(len(nodes) - 1, 0, -1):
        if nodes[i].tag == "#text":
            total[i] = len(nodes[i].text)
            good[i] = total[i] if nodes[i].label == 1 else 0
        total[nodes[i].parent] += total[i]
        good[nodes[i].parent] += good[i]
    return ((good > 0.5 * total) & (total > 0)).astype(int)


def telling_names(pages: list[Page], labels: list[np.ndarray], purity: float = 0.8, least: int = 3) -> frozenset[str]:
    """Names whose elements are mostly content, or mostly not, on some pages at least; a page counts once for a name and state.

    Names of looks stand on elements of any kind, many at once: together they would outweigh the few that tell.
    """
    seen = (Counter(), Counter())
    for page, y in zip(pages, labels):
        for state in (0, 1):
            seen[state].update({name for node, label in zip(page.nodes, y) if label == state for name in node.names})
    total = seen[0] + seen[1]
    return frozenset(name for name, n in total.items() if n >= least and max(seen[0][name], seen[1][name]) >= purity * n)


def fit(pages: list[Page], steps: int = 250, ridge: float = 1e-5) -> Model:
    """Maximise the likelihood of labelled pages with full gradients."""
    labels = [labels_of(page) for page in pages]
    known = telling_names(pages, labels)
    forest = Forest.of(pages, known)
    y = np.concatenate(labels)
    child = forest.parent >= 0
    observed = np.zeros((2 * len(KINDS), 2, 2))
    np.add.at(observed, (forest.kind[child], y[forest.parent[child]], y[child]), 1.0)
    model = Model(np.zeros(BUCKETS), np.zeros((2 * len(KINDS), 2, 2)), known)
    size, pair_size = np.zeros(BUCKETS), np.zeros_like(model.pairs)
    n = len(y)
    for _ in range(steps):
        p, pair = marginals(forest, model)
        g = np.bincount(forest.flat, (y - p)[forest.owner], minlength=BUCKETS) / n - ridge * model.weights
        size += g * g
        model.weights[:] += 0.5 * g / (np.sqrt(size) + 1e-9) * (np.abs(g) > 1e-12)
        expected = np.zeros_like(observed)
        np.add.at(expected, forest.kind[child], pair[child])
        g = (observed - expected) / n - ridge * model.pairs
        pair_size += g * g
        model.pairs[:] += 0.5 * g / (np.sqrt(pair_size) + 1e-9)
    return model
