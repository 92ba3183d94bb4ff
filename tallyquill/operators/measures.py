"""Counts that come with the work: metrics of the run that writes, and statistics kept as states that add up."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tallyquill.operators.stats import with_current
from tallyquill.sources.snapshots import Layout, Snapshot, Store, Tables, joined


def write_observed(rows: DataFrame, path: str, metrics: dict[str, Column], format: str = "parquet") -> dict:
    """Write rows and return aggregates over them, computed by the same job as they pass by."""
    seen = Observation(f"write-{uuid.uuid4().hex}")
    rows.observe(seen, *(c.alias(n) for n, c in metrics.items())).write.mode("append").format(format).save(path)
    return seen.get


def outcome_metrics(status: str = "status", questions: str = "questions") -> dict[str, Column]:
    """Files by status, and questions of the files that went through."""
    s = F.col(status)
    counts = {k: F.count_if(s == k) for k in ("ok", "failed", "duplicate")}
    return {"files": F.count(F.lit(1)), **counts, "questions": F.coalesce(F.sum(F.when(s == "ok", F.col(questions))), F.lit(0))}


# ---- states of runs

def feature_states(questions: DataFrame) -> DataFrame:
    """What one run adds to the feature statistics: doc, run_id, feature, questions, flagged. questions: doc, run_id,
    features (array), flagged."""
    rows = questions.select("doc", "run_id", F.explode("features").alias("feature"), F.col("flagged").cast("long").alias("f"))
    return rows.groupBy("doc", "run_id", "feature").agg(F.count(F.lit(1)).alias("questions"), F.sum("f").alias("flagged"))


def state_store(spark, base: str, **sizes: int) -> Store:
    """runs: doc, run_id, sequence, blocking; states: doc, run_id, feature and sums, of the current runs alone."""
    keys = ("doc", "run_id")
    return Store(spark, base, {"runs": Layout("doc", keys), "states": Layout("doc", keys)}, **sizes)


def add_runs(store: Store, runs: DataFrame, questions: DataFrame) -> Snapshot:
    """Add the states of new runs in one commit. The questions of runs stored before are not read again; the states
    of runs that others supersede are taken back by leaving them out of the part that is rewritten."""

    def merge(old: Tables, batch: Tables) -> Tables:
        fresh = batch["runs"] if "runs" not in old else batch["runs"].join(old["runs"].select("doc", "run_id"), ["doc", "run_id"], "left_anti")
        if fresh.isEmpty():
            return {}
        every = with_current(joined(old.get("runs"), fresh).drop("is_current"), ["doc"], "sequence")
        now = every.where("is_current").select("doc", "run_id")
        states = joined(old.get("states"), batch["states"].join(fresh.select("doc", "run_id"), ["doc", "run_id"], "left_semi"))
        return {"runs": every, "states": states.join(now, ["doc", "run_id"], "left_semi")}

    return store.commit({"runs": runs, "states": feature_states(questions)}, merge)


def merged_rates(snapshot: Snapshot) -> DataFrame:
    """feature, questions, flagged, issue_rate over all current runs, from their states alone."""
    out = snapshot.table("states").groupBy("feature").agg(F.sum("questions").alias("questions"), F.sum("flagged").alias("flagged"))
    return out.withColumn("issue_rate", F.col("flagged") / F.col("questions"))
