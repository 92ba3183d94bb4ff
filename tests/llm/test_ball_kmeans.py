import hashlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyquill.llm.ball_kmeans import ball_kmeans, cluster_rows, cluster_sql, reassigned


def lloyd(x, ids, k, rounds, prefix="3:"):
    """Plain rounds over all pairs of vectors and centroids."""
    order = sorted(range(len(x)), key=lambda i: (hashlib.sha256(f"{prefix}{'' if ids[i] is None else ids[i]}".encode()).hexdigest(), x[i].tolist()))
    c = x[order[:k]].copy()
    for _ in range(rounds):
        near = ((x[:, None] - c[None]) ** 2).sum(2).argmin(1)
        for j in range(len(c)):
            if (near == j).any():
                c[j] = x[near == j].sum(0) // (near == j).sum()
    d = ((x[:, None] - c[None]) ** 2).sum(2)
    return d.argmin(1), d.min(1), c


@pytest.mark.parametrize("kind", ["spread", "lattice", "copies"])
def test_ball_reassignment_is_exact(kind):
    rng = np.random.default_rng(3)
    x = {"spread": rng.integers(-500, 500, (700, 8)), "lattice": rng.integers(0, 2, (700, 3)), "copies": np.repeat(rng.integers(0, 9, (7, 4)), 100, 0)}[kind].astype(np.int64)
    for _ in range(30):
        c = x[rng.integers(0, len(x), 6)] + rng.integers(0, 2, (6, x.shape[1]))
        d = ((x[:, None] - c[None]) ** 2).sum(2)
        got = reassigned(x, rng.integers(0, 6, len(x)), c)
        assert (got[0] == d.argmin(1)).all() and (got[1] == d.min(1)).all()  # ties: the smaller number


def test_few_neighbours_are_compared():
    rng = np.random.default_rng(5)
    centres = rng.integers(-100_000, 100_000, (40, 16))
    of = rng.integers(0, 40, 4000)
    x = centres[of] + rng.integers(-50, 50, (4000, 16))
    assert reassigned(x, of, centres)[2] < 1.2 * len(x)  # one distance each, nearly all in the stable core


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def test_against_plain_rounds(spark):
    rng = np.random.default_rng(1)
    raw = rng.normal(0, 0.3, (600, 5)).astype(np.float32)
    ids = [*range(598), None, 597]
    df = vectors(spark, [(i, v.tolist(), 1) for i, v in zip(ids, raw, strict=True)]).repartition(7)
    found, centroids, sums = ball_kmeans(df, 6, 4, dims=5)
    x = np.floor(raw.astype(np.float64) * 1024).astype(np.int64)
    name, d, c = lloyd(x, ids, 6, 4)
    key = lambda r: (r[0] is not None, r[0] or 0, r[2])
    assert sorted(map(tuple, found.collect()), key=key) == sorted(zip(ids, name.tolist(), d.tolist(), strict=True), key=key)
    assert (centroids == c).all() and sums[:, 1].sum() == d.sum() and sums[:, 0].sum() == 600


def test_rows_that_take_no_part(spark):
    good = [0.5] * 64
    rows = [(1, good, 0), (1, good, 0), (2, None, 0), (3, [], 0), (4, [0.1] * 63, 0), (5, [None, *good[1:]], 0), (6, [float("nan"), *good[1:]], 0), (7, [float("inf"), *good[1:]], 0), (None, good, 0)]
    got = cluster_rows(vectors(spark, rows).withColumn("cluster", F.lit("clash"))).collect()
    assert sorted((r.vec_id or -1, r.cluster, r.distance) for r in got) == [(-1, 0, 0), (1, 0, 0), (1, 0, 0)]  # equal vectors: the smallest number
    assert cluster_rows(vectors(spark, rows[2:8])).collect() == []
    with pytest.raises(Exception, match="exceeds"):
        cluster_rows(vectors(spark, [(1, [1e9] * 64, 0)])).collect()


def test_one_component_beyond_others(spark):
    rows = [(i, [float(i)] + [0.0] * 63, 0) for i in range(20)]
    con = duckdb.connect()
    con.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding FLOAT[])")
    con.executemany("INSERT INTO embeddings VALUES (?, ?)", [r[:2] for r in rows])
    assert sorted(map(tuple, cluster_rows(vectors(spark, rows)).collect())) == sorted(con.execute(cluster_sql()).fetchall())
