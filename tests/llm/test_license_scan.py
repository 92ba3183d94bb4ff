import re

import duckdb

from tallyquill.llm.license_scan import NOTICES, PHRASES, license_rows, license_sql, scan_licenses, templates, words_of

MIT = dict(NOTICES)["mit"]


def table(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def by_hand(text):
    """n_words and all places of the phrases, by sliding over the words."""
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    at = [(i, label) for p, label in PHRASES for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
    return len(w), sorted(at)


TEXTS = [
    "Licensed under the Apache License, Version 2.0.", "mit license MIT LICENSE\nmit-license; mit 1 license", "cc by cc by cc", None, "", "  ", "x",
    "gnu general public license gnu general public", "gnu general public licence", "MİT license mıt license mit lıcense", "apache license apache licenseé", "C C BY cc\x00by",
    "漢字 mit license 漢字", MIT, MIT.replace("free of charge", "entirely free of any charge").replace("publish, ", ""), " ".join(MIT.split()[:12]), "a " * 9000 + "cc-by " + "b " * 9000 + MIT,
]


def test_base_places_by_hand(spark):
    rows = {r.doc_id: r for r in license_rows(table(spark, TEXTS)).collect()}
    assert len(rows) == len(TEXTS)
    for i, text in enumerate(TEXTS):
        n, places = by_hand(text)
        r = rows[i]
        assert (r.n_words, r.n_base) == (n, len(places))
        assert (r.first_word, r.last_word) == ((places[0][0], places[-1][0]) if places else (None, None))
        assert r.base_labels == ",".join(sorted({p[1] for p in places}))
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(","))) and 0 <= r.score <= 1


def test_notices_survive_edits_and_parts_do_not_count(spark):
    rows = {r.doc_id: r for r in license_rows(table(spark, TEXTS)).collect()}
    n = len(TEXTS)
    assert (rows[n - 4].labels, rows[n - 4].score) == ("mit", 1.0)
    assert rows[n - 3].labels == "mit" and 0.6 <= rows[n - 3].score < 1
    assert (rows[n - 2].labels, rows[n - 2].score) == ("", 0.0)
    assert rows[n - 1].labels == "cc-by,mit" and rows[n - 1].first_word == 9000


def test_every_notice_finds_itself(spark):
    found = scan_licenses(table(spark, [text for _, text in NOTICES])).collect()
    for r in found:
        label, text = NOTICES[r.doc_id]
        mine = [f for f in r.findings if f.verified and f.label == label and not f.base]
        assert any((f.start, f.end, f.coverage) == (0, len(words_of(text)), 1.0) for f in mine)


def test_awkward_rows(spark, awkward):
    rows = license_rows(awkward.withColumn("row", awkward["doc_id"]).withColumn("label", awkward["t"])).collect()
    assert len(rows) == awkward.count() and {r.labels for r in rows} == {""}
    assert license_rows(awkward.limit(0)).collect() == []


def test_sql_says_the_same(spark):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [(i, t) for i, t in enumerate(TEXTS) if t is None or "\x00" not in t])
    want = sorted(con.execute(license_sql()).fetchall())
    got = sorted(tuple(r) for r in license_rows(table(spark, TEXTS)).collect() if TEXTS[r.doc_id] is None or "\x00" not in TEXTS[r.doc_id])
    assert got == want


def test_plan_has_one_exchange_and_no_python(spark):
    df = license_rows(table(spark, TEXTS).select("doc_id", "text"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert not re.search("ArrowEvalPython|BatchEvalPython|MapInArrow|MapInPandas|FlatMapGroups", plan)


def test_phrases_must_be_whole():
    assert all(t.coverage == 1.0 and t.gap == 0 for t in templates() if t.base)
