"""Connected components of a table of links, by contraction."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harmlens.workspace import cut_lineage


def components(links: DataFrame) -> DataFrame:
    """Rows (id, component) of every id in ``links`` (a, b): the smallest id it can reach.

    Every round each node points at its smallest neighbour, pointers are followed to their ends by doubling, and
    the links between different ends go to the next round. A round leaves at most half of the nodes, and doubling
    takes logarithmically many steps. No node's neighbours are ever gathered: all steps are minima and joins,
    checkpointed so that plans stay short.
    """
    edges = cut_lineage(links.selectExpr("least(a, b) as a", "greatest(a, b) as b").filter("a < b").distinct())
    both = edges.union(edges.select("b", "a"))
    owner = None  # id -> component so far
    while not edges.isEmpty():
        pointer = cut_lineage(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.col("id")).alias("to")))
        moving = True
        while moving:
            onward = pointer.select(F.col("id").alias("to"), F.col("to").alias("next"))
            step = cut_lineage(pointer.join(onward, "to").select("id", F.col("next").alias("to"), (F.col("next") != F.col("to")).alias("moved")))
            moving = not step.filter("moved").isEmpty()
            pointer = step.select("id", "to")
        known = pointer.select(F.col("id").alias("component"), "to")
        if owner is None:
            owner = pointer.select("id", F.col("to").alias("component"))
        else:
            owner = cut_lineage(owner.join(known, "component", "left").select("id", F.coalesce("to", "component").alias("component")))
        ends = pointer.select(F.col("id").alias("a"), F.col("to").alias("x"))
        others = pointer.select(F.col("id").alias("b"), F.col("to").alias("y"))
        edges = cut_lineage(
            edges.join(ends, "a").join(others, "b").selectExpr("least(x, y) as a", "greatest(x, y) as b").filter("a < b").distinct()
        )
        both = edges.union(edges.select("b", "a"))
    if owner is None:
        return links.select(F.col("a").alias("id"), F.col("a").alias("component")).limit(0)
    return owner


def least_reached(linked: np.ndarray, ids_a: np.ndarray, ids_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest id that each member of two groups reaches over the links between them (a boolean matrix)."""
    a, b = ids_a.copy(), ids_b.copy()
    top = np.iinfo(np.int64).max
    rows, cols = np.flatnonzero(linked.any(axis=1)), np.flatnonzero(linked.any(axis=0))
    if not len(rows):
        return a, b
    part = linked[np.ix_(rows, cols)]
    while True:
        new_b = np.minimum(b[cols], np.where(part, a[rows][:, None], top).min(axis=0))
        new_a = np.minimum(a[rows], np.where(part, new_b[None, :], top).min(axis=1))
        if (new_a == a[rows]).all() and (new_b == b[cols]).all():
            return a, b
        a[rows], b[cols] = new_a, new_b
