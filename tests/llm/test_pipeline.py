from collections import defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from tallyquill.llm import toxicity
from tallyquill.llm.common import read
from tests.llm.test_ngram_join import brute as near_brute
from tests.llm.test_packing import check
from tests.llm.test_secret_scan import base


@pytest.fixture(scope="module")
def stages(spark, sf):
    docs, out = read(spark, sf, "documents"), []
    for name, stage in cp.STAGES:
        before, docs = docs, stage(spark, docs, sf).cache()
        out.append((name, before, docs))
    return {name: (before, after) for name, before, after in out}


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_names_and_columns(stages, spark, sf):
    assert list(stages) == ["toxicity", "exact dedup", "n-gram Jaccard join", "secret scans", "best-fit packing"]
    for name in list(stages)[:-1]:
        assert stages[name][1].dtypes == read(spark, sf, "documents").dtypes


def test_toxicity(stages, spark, sf):
    before, after = map(rows, stages["toxicity"])
    model = toxicity.fit(read(spark, sf, "documents"), read(spark, sf, "labels"))
    score = {r.doc_id: r.score for r in toxicity.score_toxicity(read(spark, sf, "documents"), model).collect()}
    assert set(after) == {i for i in before if score[i] < cp.TOXIC_FROM}


def test_exact_dedup(stages):
    before, after = map(rows, stages["exact dedup"])
    keep = {}
    for i, r in before.items():
        keep[r.text] = max(i, keep.get(r.text, i))
    assert set(after) == set(keep.values()) and all(after[i] == before[i] for i in after)


def test_near_duplicates(stages):
    before, after = map(rows, stages["n-gram Jaccard join"])
    components = near_brute({i: r.text for i, r in before.items()}, 5, 80)
    assert set(after) == {i for i, (_, c) in components.items() if c == i}


def test_secrets(stages):
    before, after = map(rows, stages["secret scans"])
    assert before.keys() == after.keys()
    for i, r in after.items():
        assert r.n_chars == len(r.text) and not base(r.text)
        if "[SECRET]" not in r.text:
            assert r == before[i]


def test_packing_and_run(stages, spark, sf):
    before, after = stages["best-fit packing"]
    check(after.collect(), [(r.doc_id, r.text) for r in before.collect()])
    n = cp.run(spark, sf).groupBy("doc_id").agg(F.sum("length").alias("n"))
    got, want = (defaultdict(int, {r.doc_id: r.n for r in x.collect()}) for x in (n, after.groupBy("doc_id").agg(F.sum("length").alias("n"))))
    assert got == want


def test_awkward_rows_pass_through(spark, awkward, sf):
    docs = awkward.drop("n", "t").withColumns({"lang": F.lit(None).cast("string"), "source": F.lit("s"), "n_chars": F.length("text").cast("long")})
    for _, stage in cp.STAGES[:-1]:
        docs = stage(spark, docs, sf)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(i for i, _ in texts) == [2, 4, 5, 6, 7, 8, 9, 10]
    check(cp.pack(spark, docs, sf).collect(), texts)


def test_columns_of_any_name_pass(spark, sf):
    """Input columns named like the stages' own come out as they went in."""
    names = ["score", "Null", "key", "sha", "nth", "base", "spans", "hidden", "__score", "__id"]
    docs = read(spark, sf, "documents").withColumns({n: F.concat(F.lit(n), "doc_id") for n in names})
    for _, stage in cp.STAGES[:-1]:
        docs = stage(spark, docs, sf)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", *names]
    r = docs.first()
    assert all(r[n] == f"{n}{r.doc_id}" for n in names)
