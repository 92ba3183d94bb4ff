"""Cycles of a graph of edges (node, next): which nodes lie on one, and how one of them runs.

Strongly connected components, without the closure. A round
1. contracts: a node with one edge out is taken for the node that this edge leads to, by pointers that double
   their reach, so a chain or a tree of any depth is one node after a logarithmic number of steps, and a bare ring
   shows as what never ends; then likewise a node with one edge in, for where it comes from;
2. trims nodes without an edge in or out, which lie on no cycle;
3. colours what is left, once contraction no longer makes much less of it: the greatest node that reaches each node
   goes forward, and what of a colour leads back to the node that gave it is that node's component; edges between
   components go.
Rounds go on while edges are left. Then contracted nodes are let back in, last ones first: of a tree, those on the
way from an edge of a component into the tree to its root, if the root is of that component.
Nothing is collected but whether a table is empty and how many rows it has. Steps are stored, since short tables
are then known to be short and their joins need no shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyquill.sources.shared import stored

SHRUNK = 0.5  # share of the edges that a round must leave at most for the next to contract again at once


def cut(df: DataFrame) -> DataFrame:
    return stored(df, "cycles")


def _turned(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("next").alias("node"), F.col("node").alias("next"))


def _contracted(edges: DataFrame) -> tuple[DataFrame, tuple[DataFrame, list[DataFrame]] | None, DataFrame]:
    """(edges between nodes that have not just one edge out; what ``_let_in`` needs; nodes of bare rings as
    (node, component)). No self-loops in edges, but maybe in the result."""
    inner = edges.groupBy("node").agg(F.count(F.lit(1)).alias("k"), F.min("next").alias("end")).where("k = 1").select("node", "end")
    known = inner.select(F.col("node").alias("end"), F.lit(False).alias("no"))
    at = cut(inner.join(known, "end", "left").select("node", "end", F.col("node").alias("least"), F.coalesce("no", F.lit(True)).alias("out")))
    # where the pointer from each inner node leads, and the least node from it to there
    n, live = at.agg(F.count(F.lit(1)), F.count_if(~F.col("out"))).first()
    if not n:
        return edges, None, at.select("node", F.col("least").alias("component"))
    ways, before = [at], None
    while live and (live != before or 2 ** (len(ways) - 1) < live):  # as many as before: none of these ends
        step = at.select(F.col("node").alias("end"), F.col("end").alias("end2"), F.col("least").alias("least2"), F.col("out").alias("out2"))
        at = cut(at.join(step, "end", "left").select("node", F.coalesce("end2", "end").alias("end"), F.least("least", "least2").alias("least"), F.coalesce("out2", F.lit(True)).alias("out")))
        ways.append(at)
        live, before = at.where("not out").count(), live
    endless = at.where("not out")
    rings = endless.join(endless.select(F.col("end").alias("node")).distinct(), "node", "left_semi").select("node", F.col("least").alias("component"))
    roots = at.select(F.col("node").alias("next"), F.col("end").alias("root"), "out")
    rest = edges.join(at.select("node"), "node", "left_anti").join(roots, "next", "left").where("root is null or out")
    rest = cut(rest.select("node", F.when(F.col("root").isNotNull(), F.col("next")).alias("into"), F.coalesce("root", "next").alias("next")))
    return rest.select("node", "next").distinct(), (rest.where("into is not null"), ways), rings


def _let_in(on: DataFrame, layer: tuple[DataFrame, list[DataFrame]]) -> DataFrame:
    """on with the contracted nodes that lie on cycles."""
    entries, ways = layer
    same = on.select(F.col("node").alias("next"), F.col("component").alias("other"))
    more = entries.join(on, "node").join(same, "next").where("component = other").select(F.col("into").alias("node"), "component").distinct()
    for way in ways:  # 1, 2, 4, ... nodes ahead
        ahead = way.where("not out").select("node", "end")
        more = more.join(ahead, "node", "left").select(F.explode(F.array_compact(F.array("node", "end"))).alias("node"), "component").distinct()
    return cut(named(on.unionByName(more)))


def _trimmed(edges: DataFrame) -> tuple[DataFrame, int]:
    """(edges between nodes with edges in and out, how many)."""
    n = edges.count()
    while n:
        edges = cut(edges.join(edges.select(F.col("next").alias("node")).distinct(), "node", "left_semi").join(edges.select(F.col("node").alias("next")).distinct(), "next", "left_semi").select("node", "next"))
        n, before = edges.count(), n
        if n == before:
            break
    return edges, n


def _coloured(edges: DataFrame) -> DataFrame:
    """(node, component) of the components that one colouring finds, at least one; edges: trimmed, no self-loops."""
    colour = edges.select("node").union(edges.select("next")).distinct().select("node", F.col("node").alias("colour"), F.lit(True).alias("moved"))
    while not colour.where("moved").isEmpty():
        reached = edges.join(colour, "node").groupBy("next").agg(F.max("colour").alias("given")).withColumnRenamed("next", "node")
        colour = cut(colour.join(reached, "node", "left").select("node", F.greatest("colour", "given").alias("colour"), F.coalesce(F.col("given") > F.col("colour"), F.lit(False)).alias("moved")))
    of_next = colour.select(F.col("node").alias("next"), F.col("colour").alias("same"))
    inside = cut(edges.join(colour, "node").join(of_next, "next").where("colour = same").select("node", "next", "colour"))
    found = cut(colour.where("node = colour").select("node", "colour"))
    n, before = found.count(), 0
    while n > before:
        step = inside.join(found.select(F.col("node").alias("next")), "next").select("node", "colour")
        found = cut(found.unionByName(step).distinct())
        n, before = found.count(), n
    return found.select("node", F.col("colour").alias("component"))


def named(on: DataFrame) -> DataFrame:
    """One component for each node: one found by a loop of its own within a larger component belongs to the larger one."""
    return on.groupBy("node").agg(F.max(F.struct((F.col("component") != F.col("node")).alias("larger"), "component")).alias("c")).select("node", "c.component")


def components_on_cycles(edges: DataFrame) -> DataFrame:
    """(node, component) of every node that lies on a cycle; the component's name is its least node. Edges with a
    null end are no edges; repeated ones count once; a node with an edge to itself is a component, if alone."""
    edges = cut(edges.select("node", "next").where("node is not null and next is not null").distinct())
    left, layers, parts = edges.where("node <> next"), [], [edges.where("node = next").select("node", F.col("node").alias("component"))]
    n = left.count()
    while n:
        before = n
        for _ in ("out", "in"):
            left, layer, rings = _contracted(left)
            layers += [layer] if layer else []
            parts += [rings, left.where("node = next").select("node", F.col("node").alias("component"))]  # a tree that comes back to its root
            left = _turned(left.where("node <> next"))
        left, n = _trimmed(left)
        if n <= SHRUNK * before:
            continue
        done = _coloured(left)
        parts.append(done)
        a, b = done, done.select(F.col("node").alias("next"), F.col("component").alias("other"))
        left = cut(left.join(a, "node", "left").join(b, "next", "left").where("component is null and other is null").select("node", "next"))
        n = left.count()
    on = cut(named(reduce(DataFrame.unionByName, parts)))
    for layer in reversed(layers):
        on = _let_in(on, layer)
    least = on.groupBy("component").agg(F.min("node").alias("least"))
    return on.join(least, "component").select("node", F.col("least").alias("component"))


def inner_edges(edges: DataFrame, on: DataFrame) -> DataFrame:
    """Edges between nodes of one component: every cycle is made of these."""
    same = on.select(F.col("node").alias("next"), F.col("component").alias("other"))
    return edges.select("node", "next").distinct().join(on, "node").join(same, "next").where("component = other").select("node", "next", "component")


def cycle_paths(edges: DataFrame, arrow: str = " -> ") -> DataFrame:
    """(component, length, path) of one cycle of each component: a shortest one through its least node, which it
    starts and ends with; among these the one whose nodes come first. As many steps as the longest path has."""
    inside = cut(inner_edges(edges, components_on_cycles(edges)))
    # from the least node backwards, a level at a time: each node's path to it, by the least next node
    frontier = inside.select("component").distinct().select("component", F.col("component").alias("node"), F.col("component").cast("string").alias("path"))
    left, at, k = frontier.count(), None, 0
    while left:
        k += 1
        step = inside.join(frontier.select("component", F.col("node").alias("next"), "path"), ["component", "next"])
        step = step.groupBy("component", "node").agg(F.min_by("path", "next").alias("path")).select("component", "node", F.concat(F.col("node").cast("string"), F.lit(arrow), "path").alias("path"), F.lit(k).alias("length"))
        if at is not None:  # nodes seen keep no path
            seen = at.select("component", "node", F.when(F.col("node") == F.col("component"), F.col("path")).alias("path"), "length")
            step = seen.unionByName(step.join(at.select("component", "node"), ["component", "node"], "left_anti"))
        at = cut(step)
        closed = at.where("node = component").select("component", "length", "path")
        frontier = at.where((F.col("length") == k) & (F.col("node") != F.col("component"))).join(closed.select("component"), "component", "left_anti")
        left -= at.where((F.col("length") == k) & (F.col("node") == F.col("component"))).count()
    return closed if at is not None else frontier.select("component", F.lit(0).alias("length"), "path")
