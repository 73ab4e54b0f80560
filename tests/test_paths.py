"""Shortest paths from both ends against the search from one end and against brute force."""

import random

import pytest

from harmlens.operators import graph as gr
from harmlens.operators.paths import paths_from_both_ends


def smallest_paths(edges, sources, targets, hops):
    near = {}
    for a, b in edges:
        if a is not None and b is not None and a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    out = {}
    for s in sources:
        level, seen = {s: [s]}, {s}
        for _ in range(hops):
            step = {}
            for node, path in level.items():
                for b in near.get(node, ()):
                    if b not in seen:
                        step[b] = min(step.get(b, path + [b]), path + [b])
            seen |= set(step)
            level = step
            out |= {(s, t): tuple(p) for t, p in level.items() if t in targets}
    return out


def found(spark, edges, sources, targets, **options):
    frame = lambda names: spark.createDataFrame([(n,) for n in names], "node string")
    rows = paths_from_both_ends(spark.createDataFrame(edges, "a string, b string"), frame(sources), frame(targets), **options).collect()
    assert len({(r.source, r.target) for r in rows}) == len(rows)
    assert all(r.path_length == len(r.path) - 1 for r in rows)
    return {(r.source, r.target): tuple(r.path) for r in rows}


@pytest.mark.parametrize("seed, hops, hub, small", [(1, 5, 3, 0), (2, 4, 4096, 100_000), (4, 6, 1, 20)])
def test_equals_brute_force(spark, seed, hops, hub, small):
    rng = random.Random(seed)
    nodes = [f"n{i:02d}" for i in range(40)]
    edges = [(rng.choice(nodes), rng.choice(nodes)) for _ in range(44)] + [("hub", n) for n in nodes[:9]] + [(None, "n01"), ("n02", None)]
    sources, targets = rng.sample(nodes, 6), rng.sample(nodes, 15)
    got = found(spark, edges + edges[:5], sources + sources[:1] + [None], targets, max_hops=hops, hub=hub, small=small)
    assert got == smallest_paths(edges, sources, targets, hops)


def test_equals_the_search_from_one_end(spark):
    rng = random.Random(9)
    edges = [(f"n{rng.randrange(25):02d}", f"n{rng.randrange(25):02d}") for _ in range(40)]
    names = spark.createDataFrame([(f"n{i:02d}",) for i in range(25)], "node string")
    few = names.filter("node < 'n04'")
    frame = spark.createDataFrame(edges, "a string, b string")
    key = lambda df: sorted((r.source, r.target, r.path, r.path_length) for r in df.collect())
    assert key(paths_from_both_ends(frame, names, few)) == key(gr.shortest_paths(frame, names, few))


def test_no_edges_no_ends_and_unreachable(spark):
    assert found(spark, [], ["a"], ["b"]) == {}
    assert found(spark, [("a", "b")], [], ["b"]) == {}
    assert found(spark, [("a", "b"), ("c", "d")], ["a"], ["d", "zz", "a"]) == {}
    assert found(spark, [("a", "b"), ("b", "c")], ["a"], ["c"], max_hops=1) == {}


def test_the_last_ball_is_not_formed(spark, monkeypatch):
    """Pairs three edges apart: balls of one and two edges are stored, the third hop looks at edges to targets only."""
    from harmlens.operators import graph

    stored, keep = [], graph.stored if hasattr(graph, "stored") else None
    monkeypatch.setattr(graph, "stored", lambda df, label: stored.append(label) or keep(df, label), raising=False)
    edges = spark.createDataFrame([("A", "x"), ("x", "y"), ("y", "B"), ("x", "z"), ("z", "w")], "a string, b string")
    ends = spark.createDataFrame([("A",), ("B",)], "node string")
    got = {tuple(r) for r in graph.shortest_paths(edges, ends, ends).selectExpr("source", "target", "concat_ws('', path)", "path_length").collect()}
    assert got == {("A", "B", "AxyB", 3), ("B", "A", "ByxA", 3)}
    assert stored.count("frontier") == 2


def test_edges_are_stored_compressed(spark):
    from harmlens.operators.paths import Network

    edges = spark.createDataFrame([("A", "x"), ("x", "B"), ("A", "A")], "a string, b string")
    files = Network(edges).edges.inputFiles()
    assert files and all(f.endswith(".zstd.parquet") for f in files)
