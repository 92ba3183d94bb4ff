import math
import random
import re

import numpy as np
import pytest

from tallyquill.llm.labelled import Logistic, auc
from tallyquill.llm.queries import op4_toxicity
from tallyquill.llm.toxicity import DRIFT, SIGNIFICANT, Model, fit, maximal_segments, score_toxicity, token_nodes


def brute_segments(s, lo=0, hi=None):
    """Ruzzo and Tompa's definition: the best segment, then the same left and right of it."""
    hi = len(s) if hi is None else hi
    best = max(((round(sum(s[a:b]), 9), -(b - a), -a) for a in range(lo, hi) for b in range(a + 1, hi + 1)), default=(0, 0, 0))
    if best[0] <= 0:
        return []
    a, b = -best[2], -best[2] - best[1]
    return [*brute_segments(s, lo, a), (a, b, best[0]), *brute_segments(s, b, hi)]


def test_segments_against_the_definition():
    rnd = random.Random(4)
    for _ in range(300):
        s = [rnd.choice([-3, -2, -1.5, -1, -0.25, 1, 2, 3.5, 0.3]) + rnd.random() / 100 for _ in range(rnd.randint(0, 14))]
        assert [(a, b, round(x, 6)) for a, b, x in maximal_segments(np.array(s))] == [(a, b, round(x, 6)) for a, b, x in brute_segments(s)]


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    rows = op4_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").toPandas()
    assert auc(rows.toxic.to_numpy(), rows.score.to_numpy()) > 0.94
    hit = (rows.predicted & rows.toxic).sum()
    assert hit / rows.predicted.sum() > 0.85 and hit / rows.toxic.sum() > 0.85


def test_awkward_and_without_labels(spark, awkward):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = score_toxicity(awkward, fit(awkward, none)).collect()
    assert len(rows) == awkward.count() and all(0 <= r.score <= 1 and r.passages == 0 for r in rows)
    assert score_toxicity(awkward.limit(0), fit(awkward, none)).count() == 0


def test_tokens_and_prefixes():
    starts, nodes = token_nodes(["Ünder-wear", "", "under WEAR, understood"])
    assert np.diff(starts).tolist() == [2, 0, 3]
    assert (nodes[1] == nodes[3]).all()  # case does not count
    assert nodes[2, 0] == nodes[4, 0] != 0 and nodes[2, 1] == 0 != nodes[4, 1]  # "unde" of both; "under" is no prefix of itself


def test_logistic_and_auc():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(4000, 2))
    y = (rng.random(4000) < 1 / (1 + np.exp(-(2 * x[:, 0] - 1)))).astype(float)
    p = Logistic(x, y)(x)
    assert abs(p.mean() - y.mean()) < 0.01 and auc(y, p) > 0.8
    assert auc(np.array([0, 1, 0, 1]), np.array([1.0, 1.0, 0.0, 2.0])) == pytest.approx(0.875)
    assert Model(np.zeros(0, np.uint64), np.zeros(0)).features(np.zeros(0))[1:] == (0.0, 0.0)


def test_scores_against_a_plain_reading(spark, sf):
    """The query's scores beside a plain loop: tokens by a regular expression, their deepest known prefix by a
    look-up, segments by their definition, the curve by its formula."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").where("n_chars < 600")
    docs = docs.unionByName(spark.createDataFrame([(-1, None), (-2, ""), (-3, "one")], "doc_id long, text string"), allowMissingColumns=True)
    model = fit(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet"))
    known = dict(zip(model.keys.tolist(), model.scores.tolist(), strict=True))
    seen = 0
    got = {r.doc_id: r for r in score_toxicity(docs, model).collect()}
    for r in docs.collect():
        tokens = re.findall(rb"[0-9a-z\x80-\xff]+", (r.text or "").lower().encode())
        s = []
        for t in tokens:
            nodes = token_nodes([t.decode()])[1][0]  # its prefixes, then itself
            hits = [known[int(n)] for n in nodes if int(n) in known]
            s.append((hits[-1] if hits else 0.0) - DRIFT)
        found = brute_segments(s) if len(s) < 60 else [(a, b, x) for a, b, x in maximal_segments(np.array(s))]
        log_kn = model.log_k + math.log(max(1, len(s)))
        e = [log_kn - model.scale * x for _, _, x in found]
        good = [-x for x in e if x < math.log(SIGNIFICANT)]
        best = max(-12.0, min(60.0, -min(e, default=log_kn)))
        z = (np.array([best, math.log1p(sum(good)), math.log1p(len(good))]) - model.curve.mean) / model.curve.scale @ model.curve.w[:-1] + model.curve.w[-1]
        assert abs(got[r.doc_id].score - 1 / (1 + math.exp(-max(-30, min(30, z))))) < 1e-6
        assert got[r.doc_id].passages == len(good)
        seen += len(good) > 0
    assert seen > 0
