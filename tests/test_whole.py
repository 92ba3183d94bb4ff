"""Queries that take whole tables, at a scale where a cut shows."""

import hashlib

import duckdb

from tallyquill.operators import models
from tallyquill.plans.catalogue import QUERIES

SF = "/root/testdata/sf0.01"


def test_incremental_file_source_takes_every_event(spark):
    want = duckdb.execute(f"SELECT event_id, event_type FROM '{SF}/events.parquet'").fetchall()
    got = [tuple(r) for r in QUERIES["incremental_file_source"](spark, SF).collect()]
    assert len(got) == 10_000 and sorted(got) == sorted(want)


def test_antijoin_takes_every_line(spark):
    con = duckdb.connect()
    lines = f"(SELECT l_partkey AS k FROM '{SF}/lineitem.parquet')"
    parts = f"(SELECT CASE WHEN p_partkey % 2 = 0 THEN p_partkey ELSE -p_partkey END AS k FROM '{SF}/part.parquet')"
    want = {
        "ANALYSIS_FOR_UNKNOWN_QUESTION": con.execute(f"SELECT count(*) FROM {lines} WHERE k NOT IN (FROM {parts})").fetchone()[0],
        "QUESTION_NOT_ANALYSED": con.execute(f"SELECT count(*) FROM {parts} WHERE k NOT IN (FROM {lines})").fetchone()[0],
        "DUPLICATE_ANALYSIS": con.execute(f"SELECT count(*) FROM (SELECT k FROM {lines} WHERE k IN (FROM {parts}) GROUP BY k HAVING count(*) > 1)").fetchone()[0],
    }
    got = {r.issue_code: r.n for r in QUERIES["unknown_and_missing_antijoin"](spark, SF).collect()}
    assert got == {k: n for k, n in want.items() if n}


def test_scorecard_takes_every_rated_document(spark):
    n = duckdb.execute(f"SELECT count(*) FROM '{SF}/labels.parquet' JOIN '{SF}/documents.parquet' USING (doc_id) WHERE doc_id % 3 <> 0").fetchone()[0]
    assert {r.n for r in QUERIES["gold_scorecard"](spark, SF).collect()} == {n}


def test_recordings_of_any_number_are_found(spark, tmp_path):
    spark.range(4_000).selectExpr("id AS item_id", "concat('text ', id) AS text").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {r.id: (r.level, r.error) for r in QUERIES["recorded_model_stage"](spark, str(tmp_path)).collect()}
    assert got == {i: (i % 3, None) if i % 4 else (None, "no recorded answer") for i in range(4_000)}


def test_replayed_as_by_a_client(spark):
    prompts = spark.createDataFrame([(i, p) for i, p in enumerate(["a", "b", "c", "a"])], "id long, prompt string")
    answers = {hashlib.sha256(p.encode()).hexdigest(): a for p, a in (("a", "{}"), ("b", " "))}
    want = models.call_model(prompts, lambda: models.RecordedClient(answers)).collect()
    got = models.replayed(prompts, spark.createDataFrame(list(answers.items()), "k string, a string")).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, want))
