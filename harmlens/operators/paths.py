"""Shortest paths searched from both ends.

Each hop grows the side with fewer rows, so a path of five edges needs balls of two and three edges instead of one
of five, and the search ends as soon as every pair is joined.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harmlens.functions.exprs import row_count
from harmlens.operators.graph import union_all
from harmlens.workspace import cut_lineage, stored

#: Edges of one node under one key of the edge layout; a node with more is dealt over several keys.
HUB = 4096
#: Rows up to which a counted frontier is sent to the edges; beyond it, the frontier travels to edges laid out by node.
SMALL = 100_000


class Network:
    """Undirected edges without loops and nulls.

    Repeated edges give equal rows, which each hop merges map-side, so they are left in until edges are laid out.
    """

    def __init__(self, edges: DataFrame, hub: int = HUB):
        self.edges, self.hub, self._laid = stored(edges.select("a", "b").filter("a <> b"), "edges"), hub, None

    def both(self) -> DataFrame:
        """Every edge from either end; read, not shuffled."""
        ways = F.inline(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))
        return self.edges.select(ways)

    def laid(self) -> tuple[DataFrame, DataFrame]:
        """Distinct edges with their key (a, part), and the hubs with their number of parts.

        The edges of a hub are dealt over as many parts as its degree needs; other nodes have part 0. They are stored as
        compressed Parquet and dealt by each hop that needs them: a checkpoint that keeps them dealt takes several times
        as many bytes as the hops' shuffles.
        """
        if self._laid is None:
            both = stored(self.both().distinct(), "edges-both-ways")
            degree = both.groupBy(F.col("a").alias("hub")).agg(row_count().alias("degree"))
            hubs = cut_lineage(degree.filter(F.col("degree") > self.hub).select("hub", F.ceil(F.col("degree") / self.hub).cast("int").alias("parts")))
            hubs = _sent(hubs, hubs.count())
            part = F.pmod(F.xxhash64("b"), F.coalesce("parts", F.lit(1))).cast("int")
            dealt = both.join(hubs, F.col("a") == F.col("hub"), "left").select("a", part.alias("part"), "b")
            self._laid = dealt, hubs
        return self._laid

    def step(self, frontier: DataFrame, small: bool) -> DataFrame:
        """The frontier's rows beside each neighbour ``b`` of their ``node``."""
        if small:
            return self.both().join(F.broadcast(frontier), F.col("a") == F.col("node"))
        near, hubs = self.laid()
        parts = F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)
        asked = frontier.join(hubs, F.col("node") == F.col("hub"), "left").select(*frontier.columns, F.explode(parts).alias("__part"))
        return asked.join(near, (F.col("node") == F.col("a")) & (F.col("__part") == F.col("part")))


def _sent(df: DataFrame, rows: int, small: int = SMALL) -> DataFrame:
    """A counted frame, sent to all tasks where it is small; otherwise the join is left to its plan."""
    return F.broadcast(df) if rows <= small else df


@dataclass
class Side:
    """The search from one end: the nodes at each distance from a root, with one value each.

    From the sources the value is the smallest path so far (compared element by element, all of one length); from
    the targets it is the smallest next node towards the target, which is all a smallest path needs there.
    """

    levels: list[DataFrame]
    towards: bool
    rows: int

    def grow(self, network: Network, open_roots: DataFrame | None, small: int) -> None:
        """One hop: from the outermost level to nodes not seen from that root; roots with no open pair stay behind."""
        edge = self.levels[-1]
        if open_roots is not None:
            edge = edge.join(open_roots, "root", "left_semi")
        value = F.col("node") if self.towards else F.concat("value", F.array("b"))
        step = network.step(edge, self.rows <= small).select("root", F.col("b").alias("node"), value.alias("value"))
        step = step.groupBy("root", "node").agg(F.min("value").alias("value"))
        # an undirected neighbour of level d lies on level d - 1, d or d + 1: older levels can't be met again
        seen = union_all(*[level.select("root", "node") for level in self.levels[-2:]])
        self.levels.append(stored(step.join(seen, ["root", "node"], "left_anti"), "level"))
        self.rows = self.levels[-1].count()


def _start(nodes: DataFrame, towards: bool) -> Side:
    """Level 0: each root on itself."""
    value = F.lit(None).cast("string") if towards else F.array("node")
    roots = cut_lineage(nodes.filter("node IS NOT NULL").select("node").distinct().select(F.col("node").alias("root"), "node", value.alias("value")))
    return Side([roots], towards, roots.count())


def paths_from_both_ends(edges: DataFrame, sources: DataFrame, targets: DataFrame, max_hops: int = 5, hub: int = HUB, small: int = SMALL) -> DataFrame:
    """For every source and target, the smallest of the shortest undirected paths of at most ``max_hops`` edges.

    ``edges(a, b)``, ``sources(node)``, ``targets(node)``; the result has ``source``, ``target``, ``path`` and
    ``path_length``, as ``graph.shortest_paths`` gives it. A pair at distance d meets, and meets first, on the nodes
    at f edges from the source and d - f from the target, for every f; each hop lengthens one side, looks for new pairs
    there and takes the smallest first half (map-side, so a node between many pairs is not gathered). The second half
    follows the stored next nodes. Null ends are no nodes; repeated edges and nodes count once; a source is no target of itself.
    """
    network, ahead, back = Network(edges, hub), _start(sources, towards=False), _start(targets, towards=True)
    found: list[tuple[DataFrame, int]] = []
    starts, aims = ahead.rows, back.rows
    own = cut_lineage(ahead.levels[0].select("root").join(back.levels[0].select("root"), "root", "left_semi").withColumn("own", F.lit(1)))
    open_sources = open_targets = None
    for _ in range(max_hops):
        if ahead.rows <= back.rows:
            ahead.grow(network, open_sources, small)
        else:
            back.grow(network, open_targets, small)
        first = ahead.levels[-1].select(F.col("root").alias("source"), F.col("node").alias("at"), F.col("value").alias("path"))
        second = back.levels[-1].select(F.col("root").alias("target"), F.col("node").alias("at"))
        met = first.join(_sent(second, back.rows, small), "at").filter("source <> target")
        met = met.groupBy("source", "target").agg(F.min("path").alias("path"))
        if found:
            met = met.join(union_all(*[pairs.select("source", "target") for pairs, _ in found]), ["source", "target"], "left_anti")
        met = cut_lineage(met)
        found.append((met, len(back.levels) - 1))
        pairs = union_all(*[p.select("source", "target") for p, _ in found])
        open_sources = _open(ahead.levels[0], pairs, "source", own, aims)
        open_targets = _open(back.levels[0], pairs, "target", own, starts)
        if min(ahead.rows, back.rows) == 0 or open_sources.isEmpty():
            break
    return union_all(*[_completed(pairs, back.levels, depth) for pairs, depth in found])


def _open(roots: DataFrame, pairs: DataFrame, end: str, own: DataFrame, others: int) -> DataFrame:
    """The roots of one side that still miss a partner."""
    hits = pairs.groupBy(F.col(end).alias("root")).agg(row_count().alias("hits"))
    rest = roots.select("root").join(hits, "root", "left").join(own, "root", "left")
    missing = F.lit(others) - F.coalesce("own", F.lit(0)) - F.coalesce("hits", F.lit(0))
    return cut_lineage(rest.filter(missing > 0).select("root"))


def _completed(pairs: DataFrame, levels: list[DataFrame], depth: int) -> DataFrame:
    """First halves continued over the next nodes towards the target, one join a hop."""
    for distance in range(depth, 0, -1):
        hop = levels[distance].select(F.col("root").alias("target"), F.col("node").alias("__at"), F.col("value").alias("__next"))
        last = pairs.withColumn("__at", F.element_at("path", -1))
        pairs = last.join(hop, ["target", "__at"]).select("source", "target", F.concat("path", F.array("__next")).alias("path"))
    return pairs.select("source", "target", "path", (F.size("path") - 1).alias("path_length"))
