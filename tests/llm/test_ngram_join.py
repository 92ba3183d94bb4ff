import itertools
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tallyquill.llm.ngram_join import near_duplicates
from tallyquill.llm.partenum import signatures
from tallyquill.llm.queries import op2_ngram_join
from tallyquill.llm.shingles import shingle_sets


def shingles(text, width):
    words = re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().lower())
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def brute(texts, width, percent):
    sets = {i: shingles(t, width) for i, t in texts.items()}
    holders, shared = defaultdict(list), Counter()
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    for ids in holders.values():
        shared.update(itertools.combinations(ids, 2))
    top = {i: i for i in sets}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for (a, b), c in shared.items():
        if 100 * c >= percent * (len(sets[a]) + len(sets[b]) - c):
            a, b = sorted((find(a), find(b)))
            top[b] = a
    return {i: (len(s), find(i)) for i, s in sets.items()}


def got(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def test_documents(spark, sf):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert got(op2_ngram_join(spark, sf)) == brute(texts, 4, 85)


@pytest.mark.parametrize("width,percent", [(5, 80), (4, 85)])
def test_large_groups_of_near_copies(spark, width, percent):
    """Chains and stars of edited copies, so that components reach further than any one link."""
    rnd, texts = random.Random(width), {}
    vocabulary = ["w%d" % i for i in range(300)]
    for length in (3, 4, 6, 9, 14, 30, 80, 400):
        first = [rnd.choice(vocabulary) for _ in range(length)]
        for _ in range(25):
            copy = list(rnd.choice([first, copy])) if texts and rnd.random() < 0.9 else list(first)
            for _ in range(rnd.choice([0, 1, 1, 2])):
                copy[rnd.randrange(len(copy))] = rnd.choice(vocabulary)
            texts[len(texts)] = " ".join(copy)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert got(near_duplicates(df, width, percent)) == brute(texts, width, percent)


def test_a_common_passage_brings_no_strangers_together(spark):
    rnd = random.Random(1)
    passage = " ".join("p%d" % i for i in range(60))
    texts = {i: passage + " " + " ".join("q%d" % rnd.randrange(10**6) for _ in range(rnd.choice([4, 8, 60]))) for i in range(300)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert got(near_duplicates(df, 4, 85)) == brute(texts, 4, 85)


def test_awkward_and_empty(spark, awkward):
    rows = near_duplicates(awkward, 4, 85).collect()
    assert len(rows) == awkward.count()
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in rows}
    assert found[2] == (4, 1) and found[3] == (0, 3) and found[4] == (0, 4) and found[6] == (0, 6) and found[None] == (4, None)
    assert near_duplicates(awkward.limit(0)).count() == 0
    assert got(near_duplicates(spark.createDataFrame([(7, "one two"), (9, "ONE\ttwo"), (8, "one")], "doc_id long, text string"))) == {7: (1, 7), 9: (1, 7), 8: (1, 8)}


@pytest.mark.parametrize("percent", [80, 85])
def test_linked_sets_share_a_signature(percent):
    rnd = np.random.default_rng(percent)
    for size in [*range(2, 40), 90, 333, 1000]:
        x = rnd.integers(0, 2**63, size, dtype=np.uint64)
        for _ in range(20):
            y = list(x)
            while True:  # edit until the link would break
                z = list(y)
                if rnd.random() < 0.5 and len(z) > 1:
                    z.pop(rnd.integers(len(z)))
                else:
                    z.append(np.uint64(rnd.integers(0, 2**63)))
                both = len(set(z) & set(x))
                if 100 * both < percent * (len(z) + len(x) - both):
                    break
                y = z
            if set(y) == set(x):
                continue  # equal sets meet as a class
            h = np.concatenate([np.sort(x), np.sort(np.array(y, np.uint64))])
            for left_out in (None, np.sort(rnd.choice(h, rnd.integers(0, len(h) + 1), replace=False))):
                owner, sig = signatures(np.array([0, len(x), len(h)]), h, percent, left_out)
                assert set(sig[owner == 0].tolist()) & set(sig[owner == 1].tolist())


def test_shingle_sets_agree_with_words():
    texts = ["", " ", "a", "A b", "a b c d", "a b c d e a b c d e", "é É\x0bx y\tz\n", "a b c"]
    starts, h = shingle_sets(texts, 4)
    assert np.diff(starts).tolist() == [len(shingles(t, 4)) for t in texts]
    assert set(h[starts[4] : starts[5]].tolist()) <= set(h[starts[5] : starts[6]].tolist())


def test_each_text_of_a_repeated_id_is_compared_by_its_own_size(spark):
    short, long = " ".join(f"s{i}" for i in range(13)), " ".join(f"l{i}" for i in range(1003))
    near = short + " s13"
    rows = [(1, short), (1, long), (2, near), (3, long + " x"), (4, "by itself"), (4, "quite alone")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = near_duplicates(df, 4, 85).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in out) == [(1, 10, 1), (1, 1000, 1), (2, 11, 1), (3, 1001, 1), (4, 1, 4), (4, 1, 4)]
    alone = near_duplicates(df.where("doc_id in (1, 4)"), 4, 85).collect()
    assert sorted((r.doc_id, r.component_id) for r in alone) == [(1, 1), (1, 1), (4, 4), (4, 4)]


def test_repeated_rows_change_nothing(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").repartition(3)
    once = got(near_duplicates(docs, 4, 85))
    rows = near_duplicates(docs.union(docs), 4, 85).collect()
    assert len(rows) == 2 * len(once) and {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == once


def test_a_hot_signature_and_its_strangers(spark):
    """Hundreds of near copies over several tasks, copies of them, and texts that share a part but do not link."""
    rnd, texts = random.Random(4), {}
    first = ["w%d" % rnd.randrange(400) for _ in range(120)]
    for i in range(600):
        copy = list(first)
        if i % 3:
            copy[rnd.randrange(len(copy))] = f"e{i}"
        if i % 5 == 0:
            copy = copy[: rnd.randrange(20, 120)] + [f"z{rnd.randrange(10**6)}" for _ in range(rnd.randrange(60))]
        texts[1000 - i] = " ".join(copy)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(6)
    assert got(near_duplicates(df, 4, 85)) == brute(texts, 4, 85)


def test_a_class_of_a_third_of_all_rows(spark):
    df = spark.range(6_000).selectExpr("id AS doc_id", "if(id % 3 = 0, 'one text for all of these rows', concat_ws(' ', id, id + 1, id * 7, 'x', id % 11)) AS text")
    found = got(near_duplicates(df, 4, 85))
    assert all(found[i] == ((4, 0) if i % 3 == 0 else (2, i)) for i in range(6_000))
