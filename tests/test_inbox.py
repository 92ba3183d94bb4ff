"""The inbox: contents once, restarts, and no look at the table."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tallyquill.streaming.inbox import STATE, ingest, keyed

SCHEMA = "id long, text string"


def deliver(path, name, rows):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{name}.json", "w") as f:
        f.writelines(json.dumps(dict(id=i, text=t)) + "\n" for i, t in rows)


def run(spark, base, **more):
    return ingest(spark, f"{base}/inbox", f"{base}/table", f"{base}/checkpoint", SCHEMA, "key", lambda b: keyed(b, "text", "key"), **more)


def stored(spark, base):
    return sorted((r.id, r.text) for r in spark.read.parquet(f"{base}/table").collect())


def test_contents_once_over_batches_and_restarts(spark, tmp_path):
    deliver(f"{tmp_path}/inbox/a", "1", [(1, "x"), (2, "y"), (3, "x")])
    run(spark, tmp_path)
    assert [t for _, t in stored(spark, tmp_path)] == ["x", "y"]
    run(spark, tmp_path)  # nothing new
    deliver(f"{tmp_path}/inbox/b", "2", [(4, "y"), (5, "z")])
    deliver(f"{tmp_path}/inbox/b", "3", [(6, "z"), (7, None), (8, None)])
    q = run(spark, tmp_path, files_per_batch=1)
    assert len({p["batchId"] for p in q.recentProgress if p["numInputRows"]}) == 2
    assert sorted(str(t) for _, t in stored(spark, tmp_path)) == ["None", "x", "y", "z"]
    assert all(spark.conf.get(k, None) != v for k, v in STATE.items())  # the session's own setting is back


def test_a_failed_batch_is_taken_again(spark, tmp_path):
    deliver(f"{tmp_path}/inbox", "1", [(1, "x")])
    run(spark, tmp_path)
    deliver(f"{tmp_path}/inbox", "2", [(2, "x"), (3, "new")])
    broken = lambda b: keyed(b, "text", "key").withColumn("id", F.when(F.col("id") == 3, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("long"))
    with pytest.raises(Exception, match="lost"):
        ingest(spark, f"{tmp_path}/inbox", f"{tmp_path}/table", f"{tmp_path}/checkpoint", SCHEMA, "key", broken)
    assert stored(spark, tmp_path) == [(1, "x")]
    run(spark, tmp_path)
    assert stored(spark, tmp_path) == [(1, "x"), (3, "new")]


def test_the_table_is_not_read(spark, tmp_path):
    deliver(f"{tmp_path}/inbox", "1", [(i, f"t{i}") for i in range(50)])
    q = run(spark, tmp_path)
    plan = q._jsq.explainInternal(False) if hasattr(q._jsq, "explainInternal") else ""
    assert f"{tmp_path}/table" not in plan
    for f in os.listdir(f"{tmp_path}/table"):
        if f.endswith(".parquet"):
            os.rename(f"{tmp_path}/table/{f}", f"{tmp_path}/{f}")  # gone, and the next trigger does not miss it
    deliver(f"{tmp_path}/inbox", "2", [(1, "t1"), (99, "t99")])
    q = run(spark, tmp_path)
    assert sum(p["sink"].get("numOutputRows", 0) for p in q.recentProgress if p["numInputRows"]) in (1, -1)
    left = [f"{tmp_path}/table/{f}" for f in os.listdir(f"{tmp_path}/table") if f.endswith(".parquet")]
    assert [r.text for r in spark.read.parquet(*left).collect()] == ["t99"]
