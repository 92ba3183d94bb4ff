"""Approximate nearest neighbours by cosine over robust-pruned directed graphs.

Distinct vectors are dealt by hash into shards of about ``per_shard``. In each shard a graph is built
from random edges: batches of nodes search for themselves greedily, and of what the search meets each
keeps as out-neighbours the nearest, then the nearest not much closer to one kept than to the node
(distance times ``alpha`` at most): near but diverse edges. Reverse edges are added and pruned alike.
The built shards are written to the shared folder. Queries go in blocks to every shard, search it with
a beam, and the best of all shards are ranked by the exact cosine in double precision.

Equal vectors are one node that carries its k+1 smallest ids, all that k ranks can need; a vector common
to a third of all rows is thus as cheap as any other.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyquill.llm.common import written

DEGREE, BUILD_BEAM, QUERY_BEAM, ALPHA = 28, 40, 96, 1.2
PER_SHARD, PER_BLOCK = 8192, 16_384
BATCH = 256


def beam_search(x: np.ndarray, edges: np.ndarray, entries: np.ndarray, q: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, distances) of the beam nearest nodes met from the entries, for every row of q; -1 where fewer.
    x and q are unit vectors, distance is 1 - cosine."""
    n, starts = len(q), entries[:beam]
    ids = np.full((n, beam), -1, np.int32)
    dist = np.full((n, beam), np.inf, np.float32)
    ids[:, : len(starts)] = starts
    dist[:, : len(starts)] = 1 - q @ x[starts].T
    done = np.zeros((n, beam), bool)
    rows = np.arange(n)
    while len(rows):
        waiting = np.where(done[rows] | (ids[rows] < 0), np.inf, dist[rows])
        best = waiting.argmin(1)
        going = np.isfinite(waiting[np.arange(len(rows)), best])
        rows, best = rows[going], best[going]
        if not len(rows):
            break
        done[rows, best] = True
        near = edges[ids[rows, best]]
        known = (near[:, :, None] == ids[rows][:, None, :]).any(2) | (near < 0)
        d = 1 - np.einsum("ard,ad->ar", x[near], q[rows])
        d[known] = np.inf
        all_d = np.concatenate((dist[rows], d), 1)
        order = np.argpartition(all_d, beam - 1, axis=1)[:, :beam]
        dist[rows] = np.take_along_axis(all_d, order, 1)
        ids[rows] = np.take_along_axis(np.concatenate((ids[rows], np.where(known, -1, near)), 1), order, 1)
        done[rows] = np.take_along_axis(np.concatenate((done[rows], np.zeros_like(known)), 1), order, 1)
    return ids, dist


def robust_prune(x: np.ndarray, at: np.ndarray, cand: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Out-neighbours of each node of ``at`` from its candidates (-1: none), at most degree, padded with -1."""
    d = (1 - np.einsum("bcd,bd->bc", x[cand], x[at])).astype(np.float32)
    d[(cand < 0) | (cand == at[:, None])] = np.inf
    order = np.argsort(d, 1, kind="stable")[:, : 3 * degree]
    cand, d = np.take_along_axis(cand, order, 1), np.take_along_axis(d, order, 1)
    v = x[cand]
    between = 1 - v @ v.transpose(0, 2, 1)
    alive = np.isfinite(d)
    out = np.full((len(at), degree), -1, np.int32)
    rows = np.arange(len(at))
    for k in range(degree):
        pick = alive.argmax(1)
        some = alive[rows, pick]
        if not some.any():
            break
        out[some, k] = cand[rows, pick][some]
        alive &= ~(some[:, None] & (alpha * between[rows, pick] <= d))
        alive[rows, pick] = False
    return out


def build_graph(x: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, alpha: float = ALPHA, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """(edges, entries) over unit vectors x."""
    n, rng = len(x), np.random.default_rng(seed)
    edges = rng.integers(0, n, (n, degree), dtype=np.int32) if n > 1 else np.full((1, degree), -1, np.int32)
    edges[:, degree // 2 :] = -1  # half of each node's places are free for reverse edges
    centre = int((x @ x.mean(0)).argmax())
    entries = np.unique(np.concatenate(([centre], rng.choice(n, min(n, 7), replace=False)))).astype(np.int32)
    for relaxed in (1.0, alpha) if n > 1 else ():
        order = rng.permutation(n)
        for lo in range(0, n, BATCH):
            at = order[lo : lo + BATCH].astype(np.int32)
            met, _ = beam_search(x, edges, entries, x[at], beam)
            edges[at] = robust_prune(x, at, np.concatenate((met, _fresh(edges[at], met)), 1), degree, relaxed)
            _add_reverse(x, edges, at, degree, relaxed)
    return edges, entries


def _fresh(more: np.ndarray, had: np.ndarray) -> np.ndarray:
    return np.where((more[:, :, None] == had[:, None, :]).any(2), -1, more)


def _add_reverse(x: np.ndarray, edges: np.ndarray, at: np.ndarray, degree: int, alpha: float) -> None:
    to, frm = edges[at].ravel(), np.repeat(at, degree)
    order = np.argsort(to[to >= 0], kind="stable")
    to, frm = to[to >= 0][order], frm[to >= 0][order]
    nodes, first, counts = np.unique(to, return_index=True, return_counts=True)
    for wide in (False, True):  # nodes with few new edges apart from hubs, to keep the tables narrow
        pick = (counts > 16) == wide
        if not pick.any():
            continue
        some, width = nodes[pick], int(counts[pick].max())
        new = np.full((len(some), width), -1, np.int32)
        for row, (f, c) in enumerate(zip(first[pick], counts[pick], strict=True)):
            new[row, :c] = frm[f : f + c]
        cand = np.concatenate((edges[some], _fresh(new, edges[some])), 1)
        for lo in range(0, len(some), BATCH):
            part, c = some[lo : lo + BATCH], cand[lo : lo + BATCH]
            full = (c >= 0).sum(1) > degree
            kept = -np.sort(-c, 1)[:, :degree]  # room for all: ids in any order
            if full.any():
                kept[full] = robust_prune(x, part[full], c[full], degree, alpha)
            edges[part] = kept


def _scaled(v: np.ndarray) -> np.ndarray:
    """Rows times a power of two that brings their largest component near 1: cosines are the same to the last
    bit, and products of very large or very small vectors neither overflow nor vanish."""
    return np.ldexp(v, -np.frexp(np.abs(v).max(1, keepdims=True))[1])


def _unit(v: np.ndarray) -> np.ndarray:
    v = _scaled(v)
    return (v / np.linalg.norm(v, axis=1, keepdims=True)).astype(np.float32)


def _index(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("first", ignore_index=True)
    v = np.stack(rows["v"].to_list()).astype(np.float64)
    edges, entries = build_graph(_unit(v))
    ids = np.concatenate(rows["ids"].to_list()).astype(np.int64)
    ends = np.cumsum([len(i) for i in rows["ids"]]).astype(np.int64)
    return pd.DataFrame({"dim": rows["dim"][:1], "shard": rows["shard"][:1], "v": [v.tobytes()], "edges": [edges.tobytes()], "entries": [entries.tobytes()], "ids": [ids.tobytes()], "ends": [ends.tobytes()]})


INDEX = "dim int, shard int, v binary, edges binary, entries binary, ids binary, ends binary"


def _search(k: int, beam: int):
    def run(index: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        if len(index) and len(queries):
            row = index.iloc[0]
            v = np.frombuffer(row["v"]).reshape(-1, row["dim"])
            edges = np.frombuffer(row["edges"], np.int32).reshape(len(v), -1)
            ids, ends = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["ends"], np.int64)
            q = np.stack(queries["v"].to_list()).astype(np.float64)
            unit, units = _unit(v), _unit(q)
            v, q = _scaled(v), _scaled(q)
            norm, norms = np.linalg.norm(v, axis=1), np.linalg.norm(q, axis=1)
            for lo in range(0, len(q), BATCH):
                found, dist = beam_search(unit, edges, np.frombuffer(row["entries"], np.int32), units[lo : lo + BATCH], min(beam, len(v) + 1))
                for i in range(len(found)):
                    own = queries["query_id"].iat[lo + i]
                    near = found[i][np.argsort(dist[i], kind="stable")][: 4 * k]
                    near = near[near >= 0]
                    score = v[near] @ q[lo + i] / (norm[near] * norms[lo + i])
                    some = [(-s, int(c)) for s, node in zip(score, near, strict=True) for c in ids[ends[node - 1] if node else 0 : ends[node]] if c != own]
                    out += [(own, c, -s) for s, c in sorted(some)[:k]]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    return run


def usable(v: Column) -> Column:
    """Not null, not empty, every component finite, not all zero."""
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(v.isNotNull() & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def nearest(rows: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", beam: int = QUERY_BEAM, per_shard: int = PER_SHARD, per_block: int = PER_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found for each row of queries among rows.

    Both tables hold id and vector; a query's own id is no candidate of it. Unusable vectors and null ids
    take no part; vectors are compared with those of their own length only. Ties go to the smaller id.
    Rows repeated with one id and vector count once; one id with several vectors keeps its best score.
    An empty side gives an empty result; other columns are ignored.
    """

    def plain(df: DataFrame) -> DataFrame:
        out = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
        return out.where(usable(F.col("v")) & F.col("id").isNotNull())

    least = Window.partitionBy("v").orderBy("id")
    nodes = plain(rows).withColumn("nth", F.row_number().over(least)).where(F.col("nth") <= k + 1)
    nodes = written(nodes.groupBy("v").agg(F.min("id").alias("first"), F.array_sort(F.collect_set("id")).alias("ids")), "vectors")
    shards = max(1, -(-nodes.count() // per_shard))
    dealt = nodes.withColumn("dim", F.size("v")).withColumn("shard", F.pmod(F.xxhash64("first"), F.lit(shards)).cast("int"))
    index = written(dealt.groupBy("dim", "shard").applyInPandas(_index, INDEX), "graphs")

    asked = plain(queries).select(F.col("id").alias("query_id"), "v")
    blocks = max(1, -(-asked.count() // per_block))
    asked = asked.withColumn("dim", F.size("v")).withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int"))
    asked = asked.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    spread = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    keys = ["dim", "shard", "block"]
    found = spread.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(_search(k, beam), "query_id long, vec_id long, score double")
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")).cast("int"))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
