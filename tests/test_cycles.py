"""Cycles and components against plain searches."""

import random

from pyspark.sql import functions as F

from tallyquill.operators import cycles, taxonomy
from tallyquill.operators.cycles import components_on_cycles, cycle_paths


def reach(edges):
    out = {}
    for a, b in edges:
        out.setdefault(a, set()).add(b)
    seen = {}
    for a in out:
        got, todo = set(), [a]
        while todo:
            for b in out.get(todo.pop(), ()):
                if b not in got:
                    got.add(b)
                    todo.append(b)
        seen[a] = got
    return out, seen


def by_hand(edges):
    """(components by node, path by component)."""
    out, seen = reach(edges)
    comp = {a: min(b for b in seen[a] if a in seen.get(b, ())) for a in seen if a in seen[a]}
    paths = {}
    for c in set(comp.values()):
        level, n = [[c]], 0
        while not any(c in out[p[-1]] for p in level):
            level = [[*p, b] for p in level for b in sorted(out[p[-1]]) if comp.get(b) == c and b not in p]
            n += 1
        paths[c] = min([*p, c] for p in level if c in out[p[-1]])
    return comp, {c: " -> ".join(map(str, p)) for c, p in paths.items()}


def check(spark, edges):
    df = spark.createDataFrame(edges, "node long, next long")
    comp, paths = by_hand([e for e in edges if None not in e])
    assert {r.node: r.component for r in components_on_cycles(df).collect()} == comp
    assert {r.component: r.path for r in cycle_paths(df).collect()} == paths


GRAPHS = [
    [(1, 2), (2, 3)], [(1, 1)], [(1, 2), (2, 1), (2, 2), (2, 2)], [(3, 2), (2, 1), (1, 3)],
    [(1, 2), (2, 3), (3, 1), (3, 4), (4, 5), (5, 6), (6, 4), (6, 7), (None, 1), (7, None)],  # two rings and a bridge
    [(1, 2), (2, 3), (3, 4), (4, 1), (1, 5), (5, 6), (6, 1), (2, 6)],
    [(9, 1), (1, 2), (2, 3), (3, 1), (2, 8), (8, 2), (8, 8)],
]


def test_small_graphs(spark):
    """All in one graph, each under ids of its own."""
    check(spark, [tuple(v if v is None else 100 * k + v for v in e) for k, g in enumerate(GRAPHS) for e in g])


def test_random_graphs(spark):
    rnd = random.Random(4)
    check(spark, [(rnd.randrange(14), rnd.randrange(14)) for _ in range(18)])


def test_no_edges(spark):
    df = spark.createDataFrame([], "node long, next long")
    assert components_on_cycles(df).collect() == [] and cycle_paths(df).collect() == []


def test_a_long_chain_takes_few_rounds(spark):
    """A chain of 100,000 nodes that ends in a ring: no closure, no round for each node."""
    chain = spark.range(100_000).select(F.col("id").alias("node"), (F.col("id") + 1).alias("next"))
    tail = spark.createDataFrame([(100_000, 99_990)], "node long, next long")
    on = components_on_cycles(chain.unionByName(tail))
    assert sorted((r.node, r.component) for r in on.collect()) == [(i, 99_990) for i in range(99_990, 100_001)]


def test_lengths_stay_what_they_were(spark):
    df = spark.createDataFrame([("a", "b"), ("b", "a"), ("b", "c"), ("c", "b"), ("c", "d"), ("d", "e"), ("x", "x")], "node string, next string")
    assert sorted(map(tuple, taxonomy.cycles(df).collect())) == [("a", 2), ("b", 2), ("c", 2), ("x", 1)]


def test_trees_and_short_ways_take_few_steps(spark, monkeypatch):
    """A graph of many trees about one large component: steps go by what contraction leaves, not by the depth of the
    trees and the way around."""
    steps = []
    kept = cycles.cut
    monkeypatch.setattr(cycles, "cut", lambda df: steps.append(1) or kept(df))
    n = 600
    edges = {(k, (3 * k + k * k % 25) % n) for k in range(n)} | {(k, k // 2) for k in range(0, n, 4)}
    comp, paths = by_hand(edges)
    df = spark.createDataFrame(sorted(edges), "node long, next long")
    assert {r.node: r.component for r in components_on_cycles(df).collect()} == comp
    assert len(steps) <= 55
    steps.clear()
    assert {r.component: r.path for r in cycle_paths(df).collect()} == paths
    assert len(steps) <= 55 + 1 + max(p.count(" -> ") for p in paths.values())
