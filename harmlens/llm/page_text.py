"""Main text of HTML pages by a tree-structured model trained on labelled pages.

Each page becomes a tree (``page_tree``); exact content marginals of all nodes (``tree_model``) decide which
text runs stay. Character references are decoded, white space inside a run becomes one space, and runs
join in page order by one newline. Pages are read whole; null, empty and markup-only pages give an empty text.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from harmlens.llm import labelled_pages, tree_model
from harmlens.llm.batches import attach
from harmlens.llm.page_tree import parse

TEXT = "__main_text"
TRAINING_PAGES = 800
CONTENT = 0.5
TOGETHER = 64  # pages whose messages are computed together


@lru_cache(maxsize=1)
def default_model() -> tree_model.Model:
    return fit(labelled_pages.pages(TRAINING_PAGES))


def fit(pages: list[str]) -> tree_model.Model:
    """Train on pages whose elements carry ``data-y`` labels; the list is held on the driver and bounded by its maker."""
    return tree_model.fit([parse(html) for html in pages])


def main_texts(pages: list[str], model: tree_model.Model) -> list[str]:
    """Main text of each page."""
    out = []
    for at in range(0, len(pages), TOGETHER):
        trees = [parse(html) for html in pages[at : at + TOGETHER]]
        forest = tree_model.Forest.of(trees, model.names)
        p, _ = tree_model.marginals(forest, model)
        for tree, begin in zip(trees, forest.begin):
            out.append("\n".join(n.text for i, n in enumerate(tree.nodes, begin) if n.tag == "#text" and p[i] >= CONTENT))
    return out


def extracted(pages: DataFrame, model: tree_model.Model | None = None, html: str = "html") -> DataFrame:
    """``pages`` with ``__main_text`` appended."""
    model = model or default_model()

    def scorer() -> Callable[[pa.Array], list]:
        return lambda column: [main_texts([h or "" for h in column.to_pylist()], model)]

    return attach(pages, html, [T.StructField(TEXT, T.StringType())], scorer)
