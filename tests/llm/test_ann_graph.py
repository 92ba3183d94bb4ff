import numpy as np

from tallyquill.llm.ann_graph import build_graph, nearest, robust_prune
from tallyquill.llm.queries import op3_ann_graph


def brute(vectors, asked, k):
    """query -> [(id, score)], over (id, vector) pairs with float64 vectors."""
    ids = np.array([i for i, _ in vectors])
    x = np.stack([v for _, v in vectors])
    norm = np.linalg.norm(x, axis=1)
    out = {}
    for i, q in asked:
        score = x @ q / (norm * np.linalg.norm(q))
        out[i] = [(int(ids[j]), score[j]) for j in np.lexsort((ids, -score)) if ids[j] != i][:k]
    return out


def rows_of(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def test_recall_and_scores(spark):
    sf = "/root/testdata/sf0.1"
    vectors = [(r.vec_id, np.array(r.embedding, float)) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want, got = brute(vectors, [x for x in vectors if x[0] % 50 == 0], 5), rows_of(op3_ann_graph(spark, sf))
    assert got.keys() == want.keys()
    hits = [len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 5 for q in want]
    assert np.mean(hits) >= 0.97
    exact = {q: dict(brute(vectors, [(q, dict(vectors)[q])], len(vectors))[q]) for q in list(want)[:10]}
    for q in exact:
        assert all(abs(exact[q][i] - s) < 1e-12 for i, s in got[q])


def test_many_shards_and_blocks(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(700, 12)).round(3)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    want = brute(list(enumerate(x)), [(i, x[i]) for i in range(0, 700, 20)], 5)
    got = rows_of(nearest(df, df.where("vec_id % 20 = 0"), 5, per_shard=100, per_block=9))
    assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 5 for q in want]) >= 0.97


def test_common_vector_and_unusable_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 2.0]) for i in range(100, 160)] + [(1, [1.0, 2.0]), (2, [2.0, 1.0]), (3, None), (4, [0.0, 0.0]), (5, [None, 1.0]), (6, [nan, 1.0]), (7, [inf, 1.0]), (None, [1.0, 1.0]), (8, []), (9, [1.0, 2.0, 3.0])]
    df = spark.createDataFrame([(*r, 0) for r in rows], "vec_id long, embedding array<double>, score int")
    got = rows_of(nearest(df, df, 5))
    assert [i for i, _ in got[1]] == [100, 101, 102, 103, 104] and [i for i, _ in got[100]] == [1, 101, 102, 103, 104]
    assert [i for i, _ in got[2]] == [1, 100, 101, 102, 103] and abs(got[2][0][1] - 0.8) < 1e-12
    assert set(got) == {1, 2, *range(100, 160)}  # 9 has no other vector of its length
    assert nearest(df.limit(0), df, 5).count() == 0 == nearest(df, df.limit(0), 5).count()


def test_prune_keeps_near_and_diverse():
    x = np.array([[1, 0], [0.99, 0.14], [0.985, 0.17], [0.8, -0.6]], np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    kept = robust_prune(x, np.array([0]), np.array([[1, 2, 3]]), 3, 1.2)[0]
    assert kept.tolist() == [1, 3, -1]  # 2 stands behind 1
    edges, _ = build_graph(np.repeat(x, 1, 0))
    assert (edges != np.arange(4)[:, None]).all()


def test_vectors_of_any_size(spark):
    """Very large, very small and ordinary vectors: scores are cosines, parallel ones 1."""
    rows = [(0, [1e200, 2e200]), (1, [1.0, 2.0]), (2, [1e-200, 2e-200]), (3, [-2e300, 1e300]), (4, [5e-324, 0.0]), (5, [1.5e308, 1.5e308])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {(r.query_id, r.vec_id): r.score for r in nearest(df, df, 5).collect()}
    unit = {i: np.array(v) / np.max(np.abs(v)) for i, v in rows}
    for (a, b), s in got.items():
        want = unit[a] @ unit[b] / np.linalg.norm(unit[a]) / np.linalg.norm(unit[b])
        assert abs(s - want) < 1e-12
    assert len(got) == 30
