"""Snapshots: commits of several tables, failures, races, and what is read and rewritten."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from tallyquill.sources import versions
from tallyquill.sources.snapshots import Conflict, Files, Layout, Store

RUNS = "doc long, run_id long, sequence long, blocking boolean"


def batch(spark, rows):
    runs = spark.createDataFrame(rows, RUNS)
    return runs, runs.select("doc", "run_id", F.explode(F.array(F.lit(1), F.lit(2))).alias("position"))


def shown(snapshot):
    return sorted((r.doc, r.run_id, r.is_current) for r in snapshot.table("runs").collect()), sorted((r.doc, r.run_id, r.position) for r in versions.current_questions(snapshot).collect())


@pytest.fixture
def store(spark, tmp_path):
    s = versions.run_store(spark, str(tmp_path / "store"), parts=8, buckets=2)
    yield s
    s.close()


def test_runs_supersede_and_blocking_ones_do_not(spark, store):
    versions.save_runs(store, *batch(spark, [(1, 10, 1, False), (2, 20, 1, False), (3, 30, 1, True)]))
    snapshot = versions.save_runs(store, *batch(spark, [(1, 11, 2, False), (2, 21, 2, True)]))
    assert shown(snapshot) == ([(1, 10, False), (1, 11, True), (2, 20, True), (2, 21, False), (3, 30, False)], [(1, 11, 1), (1, 11, 2), (2, 20, 1), (2, 20, 2)])


def test_saving_again_changes_nothing(spark, store):
    rows = batch(spark, [(i, 10 * i, 1, False) for i in range(50)])
    first = versions.save_runs(store, *rows)
    assert versions.save_runs(store, *rows).version == first.version == store.latest().version == 1
    assert len(os.listdir(f"{store.base}/data")) == 1


def test_a_failure_between_tables_leaves_the_old_snapshot(spark, store):
    versions.save_runs(store, *batch(spark, [(1, 10, 1, False)]))
    before = shown(store.latest())
    runs, questions = batch(spark, [(1, 11, 2, False), (2, 20, 1, False)])
    written = []

    class Watching(Store):
        def _write(self, name, rows, folder):
            if name == "runs":  # a task of the second table fails
                rows = rows.withColumn("sequence", F.when(F.col("run_id") == 20, F.raise_error(F.lit("lost"))).otherwise(F.col("sequence")).cast("long"))
            super()._write(name, rows, folder)
            written.append(name)

    other = Watching(spark, store.base, store.tables)
    with pytest.raises(Exception, match="lost"):
        versions.save_runs(other, runs, questions)
    assert written == ["questions"]  # the first table was there in full
    assert shown(store.latest()) == before and len(os.listdir(f"{store.base}/data")) == 1 and os.listdir(f"{store.base}/staging") == []
    assert shown(versions.save_runs(store, runs, questions))[0] == [(1, 10, False), (1, 11, True), (2, 20, True)]


def test_the_slower_writer_starts_over(spark, store):
    """Another commit gets in between reading the snapshot and putting the manifest: both are kept."""
    once = []

    class Slow(Store):
        def _write(self, name, rows, folder):
            if not once:
                once.append(1)
                versions.save_runs(store, *batch(spark, [(1, 12, 3, False)]))
            super()._write(name, rows, folder)

    versions.save_runs(store, *batch(spark, [(1, 10, 1, False)]))
    snapshot = versions.save_runs(Slow(spark, store.base, store.tables), *batch(spark, [(1, 11, 2, False)]))
    assert snapshot.version == 3 and shown(snapshot)[0] == [(1, 10, False), (1, 11, False), (1, 12, True)]
    assert len(os.listdir(f"{store.base}/data")) == 3


def test_a_writer_that_always_loses_says_so(spark, store, monkeypatch):
    monkeypatch.setattr(Files, "put", lambda self, name, text: False)
    with pytest.raises(Conflict):
        versions.save_runs(store, *batch(spark, [(1, 10, 1, False)]))
    assert os.listdir(f"{store.base}/data") == [] and store.latest().version == 0


def test_a_name_is_put_once(spark, tmp_path):
    files = Files(spark, str(tmp_path))
    assert files.put("m/1.json", "a") and not files.put("m/1.json", "b")
    assert files.read("m/1.json") == "a" and files.names("m") == ["1.json"]


def test_deleting_a_run_brings_the_older_one_back(spark, store):
    versions.save_runs(store, *batch(spark, [(1, 10, 1, False), (1, 11, 2, False), (2, 20, 1, False)]))
    gone = spark.createDataFrame([(1, 11), (7, 70)], "doc long, run_id long")
    snapshot = versions.delete_runs(store, gone)
    assert shown(snapshot) == ([(1, 10, True), (2, 20, True)], [(1, 10, 1), (1, 10, 2), (2, 20, 1), (2, 20, 2)])
    assert versions.delete_runs(store, gone).version == snapshot.version
    assert shown(versions.delete_runs(store, spark.createDataFrame([(1, 10), (2, 20)], "doc long, run_id long"))) == ([], [])


def test_current_questions_join_without_an_exchange(spark, store):
    versions.save_runs(store, *batch(spark, [(i % 30, i, i, False) for i in range(200)]))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        df = versions.current_questions(store.latest())
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert sorted({r.run_id for r in df.collect()}) == list(range(170, 200))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_a_commit_rewrites_the_touched_parts_alone(spark, store):
    first = versions.save_runs(store, *batch(spark, [(i, i, 1, False) for i in range(100)]))
    second = versions.save_runs(store, *batch(spark, [(5, 1000, 2, False)]))
    a, b = first.manifest["tables"], second.manifest["tables"]
    for name in ("runs", "questions"):
        moved = [k for k in b[name]["parts"] if a[name]["parts"][k] != b[name]["parts"][k]]
        assert len(moved) == 1 and len(b[name]["parts"]) == 8
    files = glob.glob(f"{store.base}/data/*/runs/part=*/*.parquet")
    assert len(files) <= 8 * 2 + 2  # parts x buckets, however many documents


def test_the_archive_reads_one_part_for_a_paper(spark, tmp_path):
    store = versions.archive(spark, str(tmp_path / "a"), parts=8, buckets=2)
    rows = spark.range(500).selectExpr("cast(id % 100 as string) AS paper", "cast(id as string) AS run_id", "id AS written")
    snapshot = versions.write_archive(store, rows)
    assert len(glob.glob(f"{store.base}/data/*/history/part=*/*.parquet")) <= 16
    one = snapshot.of("history", "42")
    assert one.select(F.input_file_name()).distinct().count() == 1
    assert sorted(r.run_id for r in one.collect()) == ["142", "242", "342", "42", "442"] and len(one.inputFiles()) <= 2  # of one part
    assert [r.run_id for r in snapshot.of("latest", "42").collect()] == ["442"]
    assert snapshot.of("latest", "none").collect() == [] and Store(spark, str(tmp_path / "b"), {"latest": Layout("paper", ("paper",))}).latest().of("latest", "x") is None
    store.close()


def test_expired_snapshots_leave_what_the_last_one_needs(spark, store):
    versions.save_runs(store, *batch(spark, [(i, i, 1, False) for i in range(40)]))
    versions.save_runs(store, *batch(spark, [(5, 1000, 2, False)]))
    snapshot = versions.save_runs(store, *batch(spark, [(5, 1001, 3, False)]))
    before = shown(snapshot)
    store.expire()
    again = versions.run_store(spark, store.base)
    assert shown(again.latest()) == before and again.parts == 8 and len(os.listdir(f"{store.base}/data")) == 2
    again.close()


def test_nulls_and_empty_batches(spark, store):
    runs, questions = batch(spark, [(1, 10, 1, None), (2, 20, None, False)])
    assert versions.save_runs(store, runs.limit(0), questions.limit(0)).version == 0
    snapshot = versions.save_runs(store, runs.fillna({"blocking": False}), questions)
    assert shown(snapshot)[0] == [(1, 10, True), (2, 20, False)]  # a run without a place in the order is never current
