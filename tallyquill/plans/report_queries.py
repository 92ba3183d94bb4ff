"""Reports and running statistics. ``orders`` stand for papers and runs, ``lineitem`` for questions, equal texts of
``documents`` for files delivered twice."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyquill.operators import measures, reports, stats
from tallyquill.plans.registry import query, read
from tallyquill.plans.store_queries import CURRENT_SQL, runs_and_questions
from tallyquill.sources.shared import fresh_dir

LINE_ORDER = "l_linenumber, l_partkey, l_suppkey"


@query(f"""WITH q AS (SELECT l_orderkey AS doc, count(*) AS n, string_agg(line, chr(10) ORDER BY {LINE_ORDER}, line) AS lines FROM (SELECT *, '| ' || l_partkey || ' | ' || CAST(l_quantity AS INT) || ' | ' || CASE WHEN l_returnflag = 'N' THEN '' ELSE l_returnflag END || ' |' AS line FROM lineitem) GROUP BY 1),
i AS (SELECT l_orderkey AS doc, string_agg('| ' || s || ' | ' || c || ' | ' || l_partkey || ' |  |', chr(10) ORDER BY r, c, CAST(l_partkey AS VARCHAR)) AS lines FROM
 (SELECT *, CASE WHEN l_quantity > 45 THEN 'high' ELSE 'low' END AS s, CASE WHEN l_quantity > 45 THEN 1 ELSE 3 END AS r, CASE WHEN l_quantity > 45 THEN 'MARKS_INVALID' ELSE 'MARKS_MISSING' END AS c FROM lineitem WHERE l_quantity > 45 OR l_quantity < 3) GROUP BY 1)
SELECT o_orderkey AS doc, '# paper ' || o_orderkey || chr(10) || '- level: ' || o_orderstatus || chr(10) || '- questions: ' || coalesce(n, 0)
 || coalesce(chr(10) || chr(10) || '## Questions' || chr(10) || '| Question | Marks | Answer |' || chr(10) || '| --- | --- | --- |' || chr(10) || q.lines, '')
 || coalesce(chr(10) || chr(10) || '## Issues' || chr(10) || '| Severity | Code | Question | Message |' || chr(10) || '| --- | --- | --- | --- |' || chr(10) || i.lines, '') AS report FROM orders LEFT JOIN q ON q.doc = o_orderkey LEFT JOIN i ON i.doc = o_orderkey""")
def paper_reports(spark, sf_dir):
    """The report of every order as a paper."""
    none = F.lit(None)
    papers = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doc"), F.concat(F.lit("paper "), "o_orderkey").alias("file_name"), F.col("o_orderstatus").alias("level"), none.cast("int").alias("page_count"))
    line = read(spark, sf_dir, "lineitem")
    q = line.select(F.col("l_orderkey").alias("doc"), F.struct(*LINE_ORDER.split(", ")).alias("position"), F.col("l_partkey").cast("string").alias("source_question_id"), F.col("l_quantity").cast("int").alias("marks"), F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("answer"))
    much = F.col("l_quantity") > 45
    issues = line.where(much | (F.col("l_quantity") < 3)).select(F.col("l_orderkey").alias("doc"), F.when(much, "MARKS_INVALID").otherwise("MARKS_MISSING").alias("issue_code"), F.when(much, "high").otherwise("low").alias("severity"), F.col("l_partkey").cast("string").alias("source_question_id"), none.cast("string").alias("message"))
    return reports.paper_reports(papers, q, issues)


OUTCOMES_SQL = "(SELECT source AS batch, doc_id, CASE WHEN coalesce(trim(text), '') = '' THEN 'failed' WHEN doc_id > min(doc_id) OVER (PARTITION BY sha256(coalesce(text, ''))) THEN 'duplicate' ELSE 'ok' END AS status, n_chars AS questions FROM documents)"


def outcomes(spark, sf_dir):
    d = read(spark, sf_dir, "documents").select("source", "doc_id", "n_chars", F.sha2(F.coalesce("text", F.lit("")), 256).alias("sha"), (F.coalesce(F.trim("text"), F.lit("")) == "").alias("empty"))
    status = F.when(F.col("empty"), "failed").when(F.col("status") == "done", "ok").otherwise("duplicate")
    return stats.content_status(d, "sha", "doc_id").select(F.col("source").alias("batch"), F.col("doc_id").alias("file"), status.alias("status"), F.col("n_chars").alias("questions"))


@query(f"SELECT count(*) AS files, count(*) FILTER (WHERE status = 'ok') AS ok, count(*) FILTER (WHERE status = 'failed') AS failed, count(*) FILTER (WHERE status = 'duplicate') AS duplicate, CAST(coalesce(sum(questions) FILTER (WHERE status = 'ok'), 0) AS BIGINT) AS questions FROM {OUTCOMES_SQL}")
def observed_batch(spark, sf_dir):
    """The batch's figures, from the job that writes its outcomes."""
    got = measures.write_observed(outcomes(spark, sf_dir), fresh_dir(spark, "outcomes"), measures.outcome_metrics())
    return spark.createDataFrame([got], ", ".join(f"{k} long" for k in got))


@query(f"""WITH o AS {OUTCOMES_SQL}, s AS (SELECT batch, status, count(*) AS n, sum(questions) AS q FROM o GROUP BY ALL)
SELECT batch, '# Batch' || chr(10) || '| Status | Files | Questions |' || chr(10) || '| --- | --- | --- |' || chr(10) || (SELECT string_agg('| ' || status || ' | ' || n || ' | ' || q || ' |', chr(10) ORDER BY status) FROM s WHERE s.batch = o.batch)
 || chr(10) || chr(10) || '## Files' || chr(10) || '| File | Status | Questions |' || chr(10) || '| --- | --- | --- |' || chr(10) || string_agg('| ' || doc_id || ' | ' || status || ' | ' || questions || ' |', chr(10) ORDER BY doc_id) AS report FROM o GROUP BY batch""")
def batch_reports(spark, sf_dir):
    """A report for each source as a batch, with a line for each of its files."""
    return reports.batch_reports(outcomes(spark, sf_dir))


@query(f"""WITH f AS (SELECT l.*, unnest(list_filter([CASE WHEN l_returnflag = 'R' THEN 'returned' END, CASE WHEN l_linestatus = 'O' THEN 'open' END, CASE WHEN l_discount > 0.05 THEN 'discount' END, 'any'], lambda x: x IS NOT NULL)) AS feature FROM lineitem l JOIN {CURRENT_SQL.format('orders')} ON o_orderkey = l_orderkey)
SELECT feature, count(*) AS questions, CAST(sum(CASE WHEN l_quantity > 30 THEN 1 ELSE 0 END) AS BIGINT) AS flagged, flagged / questions AS issue_rate FROM f GROUP BY feature""")
def merged_feature_rates(spark, sf_dir):
    """Feature rates of the current runs after batches of runs, from states that add up; the last batch comes twice."""
    runs, _ = runs_and_questions(spark, sf_dir)
    runs = runs.select("doc", "run_id", "sequence", "blocking")
    label = [F.when(F.col("l_returnflag") == "R", "returned"), F.when(F.col("l_linestatus") == "O", "open"), F.when(F.col("l_discount") > 0.05, "discount"), F.lit("any")]
    q = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("run_id"), F.array_compact(F.array(*label)).alias("features"), (F.col("l_quantity") > 30).alias("flagged")).join(runs.select("doc", "run_id"), "run_id")
    store = measures.state_store(spark, fresh_dir(spark, "states"))
    of = F.pmod(F.hash("run_id"), F.lit(2))
    for k in (1, 0, 0):
        measures.add_runs(store, runs.where(of == k), q.where(of == k))
    return measures.merged_rates(store.latest())
