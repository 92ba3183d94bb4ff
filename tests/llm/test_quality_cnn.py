import numpy as np

from tallyquill.llm.labelled import Logistic, auc
from tallyquill.llm.quality_cnn import CHUNK, FILTERS, PAD, STEP, STRIDE, WIDTH, Network, _affordable, chunks, fit, score_quality
from tallyquill.llm.queries import op6_quality_cnn


def test_chunks_cover_the_whole_text():
    for n in (0, 1, CHUNK - 1, CHUNK, CHUNK + 1, CHUNK + STEP, CHUNK + STEP + 1, 5000):
        data = bytes(i % 251 for i in range(n))
        rows = chunks(data)
        assert rows.shape[1] == CHUNK and len(rows) == 1 + max(0, -(-(n - CHUNK) // STEP))
        whole = np.full(STEP * (len(rows) - 1) + CHUNK, -1)
        for i, r in enumerate(rows):
            whole[i * STEP : i * STEP + CHUNK] = r
        assert whole[:n].tolist() == list(data) and (whole[n:] == PAD).all()


def test_gradients_against_differences():
    net, rng = Network(), np.random.default_rng(2)
    for k in net.p:
        net.p[k] = net.p[k].astype(np.float64)
    rows = np.concatenate([chunks(bytes(rng.integers(0, 256, n).tolist())) for n in (400, 100, 512)])
    y = np.array([1.0, 0.0, 1.0])

    def loss():
        logit = net.forward(rows)[0]
        return float(np.mean(np.logaddexp(0, logit) - y * logit))

    got = net.gradients(rows, y)
    for k, p in net.p.items():
        for i in rng.choice(p.size, min(p.size, 12), replace=False):
            if k == "bytes" and i // p.shape[1] == PAD:
                continue
            old, eps = p.flat[i], 1e-5
            p.flat[i] = old + eps
            up = loss()
            p.flat[i] = old - eps
            down = loss()
            p.flat[i] = old
            assert abs((up - down) / (2 * eps) - got[k].flat[i]) < 1e-4, k


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    rows = op6_quality_cnn(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").toPandas()
    assert auc(rows.quality.to_numpy(), rows.score.to_numpy()) > 0.98
    assert (rows.predicted == rows.quality).mean() > 0.97


def test_awkward_and_without_labels(spark, awkward):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = score_quality(awkward, fit(awkward, none)).collect()
    assert len(rows) == awkward.count() and {r.score for r in rows} == {0.5}
    assert score_quality(awkward.limit(0), fit(awkward, none)).count() == 0


def test_scores_against_a_plain_reading(spark, awkward):
    """The query's scores beside a plain loop over chunks, windows and filters."""
    rng = np.random.default_rng(6)
    net = Network(7)
    curve = Logistic(rng.normal(size=(200, 3)), (rng.random(200) < 0.4).astype(float))
    p = {k: v.astype(float) for k, v in net.p.items()}

    def logit(chunk):
        best = np.full(FILTERS, -np.inf)
        shown = list(chunk) + [PAD] * (CHUNK - len(chunk))
        for at in range(0, CHUNK - WIDTH + 1, STRIDE):
            window = np.concatenate([p["bytes"][b] for b in shown[at : at + WIDTH]])
            best = np.maximum(best, window @ p["filters"])
        pooled = np.append(np.tanh(best + p["bias"]), np.log2(1 + len(chunk)) / 9)
        return np.tanh(pooled @ p["hidden"] + p["hidden_bias"]) @ p["out"] + p["out_bias"][0]

    docs = awkward.where("doc_id <> 5 or doc_id is null").unionByName(spark.createDataFrame([(11, "long text, é and more. " * 90)], "doc_id long, text string"), allowMissingColumns=True)
    got = {(r.doc_id, r.score) for r in score_quality(docs, (net, curve)).collect()}
    for r in docs.collect():
        data = (r.text or "").encode()
        parts = [data[i : i + CHUNK] for i in range(0, max(1, len(data) - CHUNK + STEP), STEP)]
        x = np.array([logit(c) for c in parts])
        want = curve(np.array([[x.mean(), x.min(), x.max()]]))[0]
        assert any(i == r.doc_id and abs(s - want) < 1e-4 for i, s in got)


def test_the_network_is_fitted_on_whole_texts(spark):
    """Marks at the far ends of long texts alone tell good from bad."""
    rows = [(i, "plain words in a row " * 200 + ("#@!" * 150 if i % 2 else "fine end " * 50), i % 2) for i in range(300)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y, 0) for i, _, y in rows], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r.score for r in score_quality(docs, fit(docs, labels)).collect()}
    assert np.mean([(got[i] >= 0.5) == bool(y) for i, _, y in rows]) > 0.95


def test_a_long_text_does_not_empty_the_sample(spark):
    """Whichever places the long texts have in the order, the short ones are drawn up to the bound."""
    short = [(i, "plain words", 0) for i in range(40)]
    for long_ids in ([-1], [3], [*range(100, 110)]):
        docs = spark.createDataFrame(short + [(i, "x" * (STEP * 200), 1) for i in long_ids], "doc_id long, text string, label int")
        assert _affordable(docs, 100).where("label = 0").count() == 40 - (3 in long_ids)
    assert _affordable(docs, 20).count() == 20
