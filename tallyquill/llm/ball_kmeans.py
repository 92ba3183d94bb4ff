"""Exact Lloyd rounds over integer vectors by balls (ball k-means).

In a round every block (an Arrow batch of rows) sees each of its clusters as a ball: the
members, the new centroid, and the radius that its farthest member has. With squared distances, a centroid j is a
neighbour of ball i if D(i, j) <= 4 radius; a centroid beyond that is farther from every member than i is. The
members are split by the neighbours' distances: those nearer than half the way to the nearest neighbour are
the stable core and stay without any comparison, and the annulus up to half the way to the next neighbour
is compared with the neighbours so far only. Distances are integers, so ties are exact: the smaller number wins.

A block's balls lie within the clusters' balls, so their radii are no greater and fewer neighbours remain, and no
pass over all rows is needed to learn the radii. Rounds read and write rows where they lie; only the sums of
each block's clusters are shuffled, k times the dimensions and two, and as many totals come to the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyquill.llm.common import removed, written

MOST = 1 << 26  # components beyond it have squared distances that a long cannot hold
ROWS = "vec_id long, v binary, cluster int, distance long, sums array<long>"


def whole(vector: Column, scale: float) -> Column:
    """floor(scale * x) of each component, in double precision."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))))


def kept(vectors: DataFrame, id_col: str, vector_col: str, dims: int, scale: float) -> DataFrame:
    """(id, v) of the vectors of ``dims`` components, none null or non-finite. A component too large for exact
    distances stops the job with an error."""
    v = F.col(f"`{vector_col}`")
    fine = v.isNotNull() & (F.size(v) == dims) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    large = F.exists(v, lambda x: F.abs(x.cast("double") * F.lit(float(scale))) > MOST)
    rows = vectors.where(fine).select(F.col(f"`{id_col}`").cast("long").alias("id"), F.when(large, F.raise_error(F.lit(f"a scaled component exceeds {MOST}"))).otherwise(whole(v, scale)).alias("v"))
    return rows.withColumn("v", F.transform("v", lambda x: x.cast("int")))


def seeds(rows: DataFrame, k: int, prefix: str) -> np.ndarray:
    """The vectors of the k smallest SHA-256 of prefix and id; equal ones by their components."""
    place = F.sha2(F.concat(F.lit(prefix), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    return np.array([r.v for r in rows.orderBy(place, "v").limit(k).collect()], np.int64)


def reassigned(x: np.ndarray, cluster: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(cluster, squared distance) of each vector, from the clusters they were in, and the number of distances computed."""
    cluster, distance = cluster.copy(), np.zeros(len(x), np.int64)
    between = ((centroids[:, None, :] - centroids[None, :, :]) ** 2).sum(2)
    before, compared = cluster.copy(), 0
    for i in np.unique(before):
        at = np.flatnonzero(before == i)
        own = ((x[at] - centroids[i]) ** 2).sum(1)
        best, name = own.copy(), np.full(len(at), i, np.int64)
        compared += len(at)
        others = np.argsort(between[i], kind="stable")
        others = others[(others != i) & (between[i][others] <= 4 * own.max())]  # the ball's neighbours, nearest first
        for j in others:
            outer = np.flatnonzero(4 * own >= between[i, j])  # the annuli from this neighbour's half-way on
            if not len(outer):
                break
            d = ((x[at[outer]] - centroids[j]) ** 2).sum(1)
            compared += len(outer)
            nearer = (d < best[outer]) | ((d == best[outer]) & (j < name[outer]))
            best[outer[nearer]], name[outer[nearer]] = d[nearer], j
        cluster[at], distance[at] = name, best
    return cluster, distance, compared


def _batch(ids: pa.Array, x: np.ndarray, cluster: np.ndarray, distance: np.ndarray, k: int) -> pa.RecordBatch:
    """The block's rows, the first of which carries the sums of its clusters."""
    sums = np.zeros((k, x.shape[1] + 2), np.int64)  # per cluster: components, members, distance
    np.add.at(sums, cluster, np.column_stack((x, np.ones(len(x), np.int64), distance)))
    v = pa.FixedSizeBinaryArray.from_buffers(pa.binary(4 * x.shape[1]), len(x), [None, pa.py_buffer(x.astype("<i4").tobytes())]).cast(pa.binary())
    first = pa.array([sums.ravel()] + [None] * (len(x) - 1), pa.list_(pa.int64()))
    return pa.RecordBatch.from_arrays([ids, v, pa.array(cluster.astype(np.int32)), pa.array(distance), first], names=["vec_id", "v", "cluster", "distance", "sums"])


def _packed(centroids: np.ndarray):
    """Rows (id, v) into assigned ones: all are members of one ball first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b for b in batches if b.num_rows):
            x = np.asarray(batch.column(1).flatten(), np.int64).reshape(batch.num_rows, -1)
            yield _batch(batch.column(0), x, *reassigned(x, np.zeros(len(x), np.int64), centroids)[:2], len(centroids))

    return run


def _moved(centroids: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b for b in batches if b.num_rows):
            x = np.frombuffer(b"".join(batch.column(1).to_pylist()), "<i4").astype(np.int64).reshape(batch.num_rows, -1)
            yield _batch(batch.column(0), x, *reassigned(x, np.asarray(batch.column(2), np.int64), centroids)[:2], len(centroids))

    return run


def totals(blocks: DataFrame, k: int, dims: int) -> np.ndarray:
    """Per cluster the exact sums of components, members and distances: k * (dims + 2) numbers."""
    found = blocks.where("sums is not null").select(F.posexplode("sums").alias("at", "n")).groupBy("at").agg(F.sum(F.col("n").cast("decimal(38,0)")).alias("n")).collect()
    out = np.zeros(k * (dims + 2), object)
    for r in found:
        out[r["at"]] = int(r["n"])
    return out.reshape(k, dims + 2)


def ball_kmeans(vectors: DataFrame, k: int = 8, rounds: int = 10, dims: int = 64, scale: float = 1024.0, prefix: str = "3:", id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """((vec_id, cluster, distance) of every kept vector, the final centroids, (members, distance sum) of each).

    Components become floor(scale * x). k centroids start at the kept vectors with the smallest
    SHA-256 of prefix and id; each round assigns every vector and moves every centroid that has members to the floor
    of their mean; then vectors are assigned once more. Of fewer than k vectors each starts a cluster. Repeated
    rows count each for itself; a null id stays null and hashes as empty. An empty table gives an empty result.
    Two copies of the rows lie in the shared folder at a time; the older goes when the newer is complete.
    """
    rows = kept(vectors, id_col, vector_col, dims, scale)
    centroids = seeds(rows, k, prefix)
    if not len(centroids):
        return vectors.sparkSession.createDataFrame([], "vec_id long, cluster int, distance long"), np.zeros((0, dims), np.int64), np.zeros((0, 2), object)
    k = len(centroids)
    blocks, path = written(rows.mapInArrow(_packed(centroids), ROWS), "balls", path_too=True)
    sums = totals(blocks, k, dims)
    for _ in range(rounds):
        full = sums[:, dims] > 0
        centroids = centroids.copy()
        centroids[full] = (sums[full, :dims] // sums[full, dims : dims + 1]).astype(np.int64)
        new, new_path = written(blocks.select("vec_id", "v", "cluster").mapInArrow(_moved(centroids), ROWS), "balls", path_too=True)
        removed(vectors.sparkSession, path)
        blocks, path = new, new_path
        sums = totals(blocks, k, dims)
    return blocks.select("vec_id", "cluster", "distance"), centroids, sums[:, dims:]


def cluster_rows(vectors: DataFrame, k: int = 8, rounds: int = 10) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every kept vector."""
    found, centroids, sums = ball_kmeans(vectors, k, rounds)
    about = [(i, int(sums[i, 1]), int(sums[:, 1].sum()), hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for i, c in enumerate(centroids.tolist())]
    named = vectors.sparkSession.createDataFrame(about, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(named), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")  # k rows


def cluster_sql(k: int = 8, rounds: int = 10, dims: int = 64, scale: int = 1024, prefix: str = "3:") -> str:
    """The same in DuckDB, a pair of tables for each round."""
    out = [
        f"""WITH v0 AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * {scale}) AS BIGINT)) AS v FROM embeddings
WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dims}),
v AS MATERIALIZED (SELECT row_number() OVER () AS r, * FROM v0),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v FROM (SELECT sha256('{prefix}' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h, v FROM v0 ORDER BY h, v LIMIT {k}))"""
    ]
    for i in range(rounds + 1):
        out.append(f"a{i} AS MATERIALIZED (SELECT r, arg_min(c, d * {k} + c) AS c, min(d) AS d FROM (SELECT r, c, list_sum(list_transform(list_zip(v.v, c{i}.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d FROM v, c{i}) GROUP BY r)")
        if i < rounds:
            out.append(
                f"""n{i} AS (SELECT c, pos, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM (SELECT c, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM a{i} JOIN v USING (r)) GROUP BY c, pos),
c{i + 1} AS MATERIALIZED (SELECT c, coalesce(m, v) AS v FROM c{i} LEFT JOIN (SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY pos) AS m FROM n{i} GROUP BY c) USING (c))"""
            )
    last = rounds
    return ",\n".join(out) + f"""
SELECT vec_id, CAST(c AS INT) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c{last}.v, ',')) AS centroid_sha256 FROM a{last} JOIN v USING (r) JOIN c{last} USING (c)"""
