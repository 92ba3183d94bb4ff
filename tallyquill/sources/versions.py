"""Versioned runs, analyses, attempts and archives in a snapshot store.

Runs are written once and superseded, never changed: which run of a document is current is settled when its part is
written. Every function is safe to repeat.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyquill.operators.stats import with_current
from tallyquill.sources.snapshots import Layout, Snapshot, Store, Tables, joined


def run_store(spark: SparkSession, base: str, **sizes: int) -> Store:
    """runs: doc, run_id, sequence, blocking, ...; questions: doc, run_id, .... A document's rows share a part."""
    keys = ("doc", "run_id")
    return Store(spark, base, {"runs": Layout("doc", keys), "questions": Layout("doc", keys)}, **sizes)


def _current(runs: DataFrame) -> DataFrame:
    return with_current(runs.drop("is_current"), ["doc"], "sequence")


def save_runs(store: Store, runs: DataFrame, questions: DataFrame) -> Snapshot:
    """Add runs and their questions, all in one commit. Runs already stored are left as they are; the last written
    run of a document that does not block becomes its current one."""

    def merge(old: Tables, batch: Tables) -> Tables:
        fresh = batch["runs"] if "runs" not in old else batch["runs"].join(old["runs"].select("doc", "run_id"), ["doc", "run_id"], "left_anti")
        if fresh.isEmpty():
            return {}
        asked = batch["questions"].join(fresh.select("doc", "run_id"), ["doc", "run_id"], "left_semi")
        return {"questions": joined(old.get("questions"), asked), "runs": _current(joined(old.get("runs"), fresh))}

    return store.commit({"runs": runs, "questions": questions}, merge)


def delete_runs(store: Store, gone: DataFrame) -> Snapshot:
    """Take runs (doc, run_id) and their questions out; an older run becomes current where the current one goes."""

    def merge(old: Tables, batch: Tables) -> Tables:
        if "runs" not in old or old["runs"].join(batch["runs"], ["doc", "run_id"], "left_semi").isEmpty():
            return {}
        left = {name: rows.join(batch["runs"], ["doc", "run_id"], "left_anti") for name, rows in old.items()}
        return left | {"runs": _current(left["runs"])}

    return store.commit({"runs": gone.select("doc", "run_id").distinct()}, merge)


def current_questions(snapshot: Snapshot) -> DataFrame:
    """Questions of each document's current run: both tables lie by the join's keys, so nothing is shuffled."""
    runs = snapshot.table("runs").where("is_current").select("doc", "run_id")
    return runs.join(snapshot.table("questions"), ["doc", "run_id"])


def analysis_store(spark: SparkSession, base: str, **sizes: int) -> Store:
    """analyses: question_key, analysis_run_id, push, ...."""
    return Store(spark, base, {"analyses": Layout("question_key", ("question_key",))}, **sizes)


def push_analyses(store: Store, rows: DataFrame) -> Snapshot:
    """Rows of analysis runs, numbered by ``push``: a run pushed again replaces itself under the questions it names,
    and the last push of a question key is its current one."""

    def merge(old: Tables, batch: Tables) -> Tables:
        new = batch["analyses"]
        if "analyses" not in old:
            kept = new
        else:
            stored = old["analyses"].drop("is_current")
            if new.join(stored, ["question_key", "analysis_run_id", "push"], "left_anti").isEmpty():
                return {}
            kept = stored.join(new.select("question_key", "analysis_run_id").distinct(), ["question_key", "analysis_run_id"], "left_anti").unionByName(new)
        last = F.max("push").over(Window.partitionBy("question_key"))
        return {"analyses": kept.withColumn("is_current", F.col("push") == last)}

    return store.commit({"analyses": rows}, merge)


def attempt_store(spark: SparkSession, base: str, **sizes: int) -> Store:
    return Store(spark, base, {"students": Layout("student_id", ("student_id",)), "attempts": Layout("student_id", ("student_id",))}, **sizes)


def push_attempts(store: Store, attempts: DataFrame, key: str = "attempt_id") -> Snapshot:
    """Attempts not stored yet, and the students of them that are not known."""

    def merge(old: Tables, batch: Tables) -> Tables:
        new = batch["attempts"].dropDuplicates([key])
        if "attempts" in old:
            new = new.join(old["attempts"].select("student_id", key), ["student_id", key], "left_anti")
        if new.isEmpty():
            return {}
        students = joined(old.get("students"), new.select("student_id")).distinct()
        return {"students": students, "attempts": joined(old.get("attempts"), new)}

    return store.commit({"attempts": attempts}, merge)


def archive(spark: SparkSession, base: str, **sizes: int) -> Store:
    """Results by paper: latest holds one row a paper, history all runs. A paper is looked up by Snapshot.of."""
    return Store(spark, base, {"latest": Layout("paper", ("paper",)), "history": Layout("paper", ("paper",))}, **sizes)


def write_archive(store: Store, results: DataFrame, run: str = "run_id", order: str = "written") -> Snapshot:
    """Results (paper, run, order, ...) into the history, once for each run, and the last of each paper as the latest."""

    def merge(old: Tables, batch: Tables) -> Tables:
        new = batch["history"]
        if "history" in old:
            new = new.join(old["history"].select("paper", run), ["paper", run], "left_anti")
        if new.isEmpty():
            return {}
        every = joined(old.get("latest"), new)
        nth = F.row_number().over(Window.partitionBy("paper").orderBy(F.desc(order), F.desc(run)))
        return {"history": joined(old.get("history"), new), "latest": every.withColumn("nth", nth).where("nth = 1").drop("nth")}

    return store.commit({"history": results}, merge)


def blocking(status: Column) -> Column:
    return F.coalesce(status == "F", F.lit(False))
