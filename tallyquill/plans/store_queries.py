"""Queries through the snapshot store: ``orders`` stand for runs of a document (customer), ``lineitem`` for the
questions of a run, ``events`` for attempts, ``documents`` for archived papers."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyquill.plans.registry import query, read
from tallyquill.sources import versions
from tallyquill.sources.shared import fresh_dir


def runs_and_questions(spark, sf_dir):
    o = read(spark, sf_dir, "orders")
    runs = o.select(F.col("o_custkey").alias("doc"), F.col("o_orderkey").alias("run_id"), versions.blocking(F.col("o_orderstatus")).alias("blocking"), F.struct("o_orderdate", "o_orderkey").alias("sequence"), "o_orderpriority")
    lines = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("run_id"), "l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").cast("int").alias("qty"))
    return runs, lines.join(o.select(F.col("o_orderkey").alias("run_id"), F.col("o_custkey").alias("doc")), "run_id")


def saved(spark, sf_dir, batches: int = 2):
    """A store after all runs came in batches, the first of them twice."""
    runs, questions = runs_and_questions(spark, sf_dir)
    store = versions.run_store(spark, fresh_dir(spark, "runs"))
    of = F.pmod(F.hash("run_id"), F.lit(batches))
    for k in (0, *range(batches)):
        versions.save_runs(store, runs.where(of == k), questions.where(of == k))
    return store


CURRENT_SQL = "(SELECT o_custkey, o_orderkey FROM {0} WHERE o_orderstatus <> 'F' QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)"


@query(f"SELECT o_custkey AS doc, o_orderkey AS run_id, l_linenumber, l_partkey, l_suppkey FROM {CURRENT_SQL.format('orders')} JOIN lineitem ON l_orderkey = o_orderkey")
def current_questions_of_snapshot(spark, sf_dir):
    """Runs saved in batches, one of them twice; the questions of each document's current run."""
    return versions.current_questions(saved(spark, sf_dir).latest()).select("doc", "run_id", "l_linenumber", "l_partkey", "l_suppkey")


@query(f"""WITH o AS (SELECT * FROM orders WHERE o_orderpriority <> '1-URGENT'), c AS {CURRENT_SQL.format('o')}
SELECT o.o_custkey AS doc, o.o_orderkey AS run_id, c.o_orderkey IS NOT NULL AS is_current, (SELECT count(*) FROM lineitem WHERE l_orderkey = o.o_orderkey) AS questions FROM o LEFT JOIN c ON c.o_orderkey = o.o_orderkey""")
def runs_after_deletion(spark, sf_dir):
    """All urgent runs taken out again with their questions; older runs become current."""
    store = saved(spark, sf_dir, 1)
    snapshot = versions.delete_runs(store, store.latest().table("runs").where("o_orderpriority = '1-URGENT'"))
    n = snapshot.table("questions").groupBy("doc", "run_id").agg(F.count(F.lit(1)).alias("n"))
    return snapshot.table("runs").join(n, ["doc", "run_id"], "left").select("doc", "run_id", "is_current", F.coalesce("n", F.lit(0)).alias("questions"))


@query("SELECT user_id AS student_id, count(*) AS attempts, CAST(sum(event_id) AS BIGINT) AS ids FROM events GROUP BY user_id")
def pushed_attempts(spark, sf_dir):
    """All events as attempts, pushed twice."""
    rows = read(spark, sf_dir, "events").select(F.col("user_id").alias("student_id"), F.col("event_id").alias("attempt_id"), "event_type")
    store = versions.attempt_store(spark, fresh_dir(spark, "attempts"))
    for batch in (rows.where("event_type <> 'view'"), rows):
        versions.push_attempts(store, batch)
    snapshot = store.latest()
    n = snapshot.table("attempts").groupBy("student_id").agg(F.count(F.lit(1)).alias("attempts"), F.sum("attempt_id").alias("ids"))
    return snapshot.table("students").join(n, "student_id").select("student_id", "attempts", "ids")


@query("""SELECT CAST(event_id AS VARCHAR) AS analysis_run_id, user_id AS question_key, event_id = max(event_id) OVER (PARTITION BY user_id) AS is_current, value FROM events""")
def pushed_analyses(spark, sf_dir):
    """Events as analyses of a question (user), all pushed first with wrong values and then again, twice, with the right ones."""
    rows = read(spark, sf_dir, "events").select(F.col("user_id").alias("question_key"), F.col("event_id").cast("string").alias("analysis_run_id"), F.col("event_id").alias("push"), "value")
    store = versions.analysis_store(spark, fresh_dir(spark, "analyses"))
    for batch in (rows.withColumns({"value": -F.col("value"), "push": -1 - F.col("push")}), rows, rows):
        versions.push_analyses(store, batch)
    return store.latest().table("analyses").select("analysis_run_id", "question_key", "is_current", "value")


@query("SELECT sha256(coalesce(text, ''))[1:12] AS paper, count(*) AS runs, max(doc_id) AS latest, arg_max(n_chars, doc_id) AS n_chars FROM documents GROUP BY 1")
def archived_papers(spark, sf_dir):
    """Documents as results of papers, equal texts being runs of one; latest and history."""
    d = read(spark, sf_dir, "documents").select(F.substring(F.sha2(F.coalesce("text", F.lit("")), 256), 1, 12).alias("paper"), F.col("doc_id").cast("string").alias("run_id"), F.col("doc_id").alias("written"), "n_chars")
    store = versions.archive(spark, fresh_dir(spark, "archive"))
    for batch in (d.where("written % 2 = 1"), d):
        versions.write_archive(store, batch)
    snapshot = store.latest()
    n = snapshot.table("history").groupBy("paper").agg(F.count(F.lit(1)).alias("runs"))
    return snapshot.table("latest").join(n, "paper").select("paper", "runs", F.col("written").alias("latest"), "n_chars")
