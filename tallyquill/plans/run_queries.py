"""Queries over runs, versions and joins. ``orders`` stand for runs of a document (customer), ``lineitem`` for
questions of a run, ``labels`` for hand-rated references, ``benchmark`` for marking schemes."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyquill.functions import texts as T
from tallyquill.operators import compare, models, pictures, rules, solving, stats
from tallyquill.operators.contains import contained_items
from tallyquill.plans.registry import query, read
from tallyquill.sources.shared import fresh_dir
from tallyquill.streaming.inbox import ingest, keyed



#: A total order of an order's lines, whose numbers repeat.
LINE_SQL = "(l_linenumber * 1000000000000 + l_partkey * 100000 + l_suppkey)"


def newest_first():
    return [F.desc("o_orderdate"), F.desc("o_orderkey")]


@query("SELECT o_custkey, o_orderkey, o_orderdate FROM orders WHERE o_orderstatus <> 'F' QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1")
def current_run_per_customer(spark, sf_dir):
    runs = read(spark, sf_dir, "orders")
    return stats.newest(runs, ["o_custkey"], newest_first(), 1, F.col("o_orderstatus") != "F").select("o_custkey", "o_orderkey", "o_orderdate")


@query("SELECT o_custkey, o_orderkey FROM orders WHERE o_orderstatus <> 'F' QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) > 1")
def superseded_runs(spark, sf_dir):
    runs = read(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", (F.col("o_orderstatus") == "F").alias("blocking"))
    return stats.with_current(runs, ["o_custkey"], "o_orderkey").where("not blocking and not is_current").select("o_custkey", "o_orderkey")


@query("SELECT o_custkey, o_orderkey, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS INT) AS nth FROM orders QUALIFY nth <= 2")
def newest_two_runs(spark, sf_dir):
    return stats.newest(read(spark, sf_dir, "orders"), ["o_custkey"], newest_first(), 2).select("o_custkey", "o_orderkey", "nth")


RUN_FIELDS = ["l_partkey", "qty", "l_returnflag"]
DIFF_SQL = """WITH a AS (SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_quantity AS INT) AS qty, l_returnflag FROM lineitem WHERE l_linenumber <> 4),
b AS (SELECT l_orderkey, l_linenumber, l_partkey, CAST(CASE WHEN l_linenumber = 2 AND l_orderkey % 3 = 0 THEN NULL ELSE l_quantity END AS INT) AS qty, CASE WHEN l_orderkey % 5 = 0 THEN 'X' ELSE l_returnflag END AS l_returnflag FROM lineitem WHERE l_linenumber <> 1),
j AS (SELECT coalesce(a.l_orderkey, b.l_orderkey) AS l_orderkey, coalesce(a.l_linenumber, b.l_linenumber) AS l_linenumber, a.l_orderkey IS NULL AS added, b.l_orderkey IS NULL AS removed,
  list_filter([CASE WHEN a.l_partkey IS DISTINCT FROM b.l_partkey THEN 'l_partkey' END, CASE WHEN a.qty IS DISTINCT FROM b.qty THEN 'qty' END, CASE WHEN a.l_returnflag IS DISTINCT FROM b.l_returnflag THEN 'l_returnflag' END], lambda x: x IS NOT NULL) AS c
  FROM a FULL JOIN b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber = b.l_linenumber),
d AS (SELECT l_orderkey, l_linenumber, CASE WHEN added THEN 'added' WHEN removed THEN 'removed' WHEN len(c) > 0 THEN 'changed' ELSE 'identical' END AS status, CASE WHEN added OR removed THEN '' ELSE array_to_string(c, ',') END AS changed FROM j)"""


def two_runs(spark, sf_dir):
    line = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_quantity").cast("int").alias("qty"), "l_returnflag")
    changed = line.where("l_linenumber <> 1").withColumns({"qty": F.when(~((F.col("l_linenumber") == 2) & (F.col("l_orderkey") % 3 == 0)), F.col("qty")), "l_returnflag": F.when(F.col("l_orderkey") % 5 == 0, "X").otherwise(F.col("l_returnflag"))})
    return line.where("l_linenumber <> 4"), changed


@query(DIFF_SQL + " SELECT * FROM d")
def run_diff_full_outer(spark, sf_dir):
    return compare.compare_runs(*two_runs(spark, sf_dir), ["l_orderkey", "l_linenumber"], RUN_FIELDS).withColumn("changed", F.array_join("changed", ","))


@query(DIFF_SQL + """ SELECT count(*) FILTER (WHERE status = 'added') AS added, count(*) FILTER (WHERE status = 'removed') AS removed, count(*) FILTER (WHERE status = 'changed') AS changed,
count(*) FILTER (WHERE status = 'identical') AS identical, count(*) FILTER (WHERE status = 'identical') / count(*) FILTER (WHERE status IN ('changed', 'identical')) AS agreement FROM d""")
def run_agreement(spark, sf_dir):
    return compare.agreement(compare.compare_runs(*two_runs(spark, sf_dir), ["l_orderkey", "l_linenumber"], RUN_FIELDS))


SETS_SQL = "WITH s AS (SELECT l_orderkey, list(DISTINCT l_partkey % 10) FILTER (WHERE l_linenumber <= 3) AS a, list(DISTINCT l_partkey % 10) FILTER (WHERE l_linenumber >= 2) AS b FROM lineitem GROUP BY l_orderkey)"


def two_sets(spark, sf_dir):
    x, n = F.col("l_partkey") % 10, F.col("l_linenumber")
    return read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_set(F.when(n <= 3, x)).alias("a"), F.collect_set(F.when(n >= 2, x)).alias("b"))


@query(SETS_SQL + """ SELECT l_orderkey, array_to_string(list_sort(list_filter(coalesce(b, []), lambda x: NOT list_contains(coalesce(a, []), x))), ',') AS added,
array_to_string(list_sort(list_filter(coalesce(a, []), lambda x: NOT list_contains(coalesce(b, []), x))), ',') AS removed FROM s""")
def array_set_diff(spark, sf_dir):
    d = compare.diff_sets(F.col("a"), F.col("b"))
    return two_sets(spark, sf_dir).select("l_orderkey", F.array_join(d["added"], ",").alias("added"), F.array_join(d["removed"], ",").alias("removed"))


@query(SETS_SQL + " SELECT l_orderkey, CASE WHEN len(list_distinct(list_concat(coalesce(a, []), coalesce(b, [])))) = 0 THEN CAST(1 AS DOUBLE) ELSE len(list_intersect(coalesce(a, []), coalesce(b, []))) / len(list_distinct(list_concat(coalesce(a, []), coalesce(b, [])))) END AS overlap FROM s")
def jaccard_overlap(spark, sf_dir):
    return two_sets(spark, sf_dir).select("l_orderkey", compare.jaccard(F.col("a"), F.col("b")).alias("overlap"))


#: Rated documents; a third of the ratings carry keys that no analysis has.
RATED_SQL = """WITH g AS (SELECT CASE WHEN doc_id % 3 = 0 THEN 'lost' || doc_id ELSE CAST(doc_id AS VARCHAR) END AS question_key, CAST(doc_id % 4 AS INT) AS w_r, CAST(doc_id % 3 AS INT) AS w_p, quality + 1 AS w_d, CAST(doc_id % 2 AS INT) AS w_i, quality AS w_c, toxic * 3 AS w_e,
  ['s' || (doc_id % 5), 's' || (doc_id % 3), 't'] AS skills, CASE WHEN doc_id % 2 = 0 THEN ['e' || (doc_id % 7)] ELSE [] END AS errors FROM labels),
a AS (SELECT CAST(doc_id AS VARCHAR) AS question_key, CAST(n_chars % 4 AS INT) AS r, CAST(n_chars % 2 AS INT) AS p, CAST(n_chars % 3 AS INT) AS d, CAST(doc_id % 4 AS INT) AS i, CASE WHEN n_chars % 5 > 0 THEN CAST(n_chars % 3 AS INT) END AS c, CAST(doc_id % 2 AS INT) AS e,
  ['s' || (n_chars % 5), 't'] AS skills, CASE WHEN doc_id % 4 = 0 THEN ['e' || (doc_id % 7), 'f'] ELSE [] END AS errors FROM documents)"""


@query(RATED_SQL + ", x AS (SELECT unnest([{'dim': 'R', 'got': coalesce(r, 0), 'want': w_r}, {'dim': 'P', 'got': coalesce(p, 0), 'want': w_p}, {'dim': 'D', 'got': coalesce(d, 0), 'want': w_d}, {'dim': 'I', 'got': coalesce(i, 0), 'want': w_i}, {'dim': 'C', 'got': coalesce(c, 0), 'want': w_c}, {'dim': 'E', 'got': coalesce(e, 0), 'want': w_e}], recursive := true) FROM g JOIN a USING (question_key)) SELECT dim, count(*) AS n, count(*) FILTER (WHERE got = want) AS exact, count(*) FILTER (WHERE abs(got - want) <= 1) AS within_one, CAST(sum(abs(got - want)) AS BIGINT) AS abs_diff, CAST(sum(got - want) AS BIGINT) AS bias, exact / n AS exact_rate, within_one / n AS within_one_rate, abs_diff / n AS mean_abs, bias / n AS mean_bias FROM x GROUP BY dim")
def gold_scorecard(spark, sf_dir):
    return compare.score_against_gold(*rated(spark, sf_dir))[0]


def rated(spark, sf_dir):
    """(analyses, gold): six dimensions, skills and errors of each."""
    n, k = F.col("n_chars"), F.col("doc_id")
    levels = {"R": n % 4, "P": n % 2, "D": n % 3, "I": k % 4, "C": F.when(n % 5 > 0, n % 3), "E": k % 2}
    none = F.expr("cast(array() as array<string>)")
    analyses = read(spark, sf_dir, "documents").select(k.cast("string").alias("question_key"), *(v.cast("int").alias(d) for d, v in levels.items()), F.array(F.concat(F.lit("s"), n % 5), F.lit("t")).alias("skills"), F.when(k % 4 == 0, F.array(F.concat(F.lit("e"), k % 7), F.lit("f"))).otherwise(none).alias("errors"))
    wanted = {"R": k % 4, "P": k % 3, "D": F.col("quality") + 1, "I": k % 2, "C": F.col("quality"), "E": F.col("toxic") * 3}
    gold = read(spark, sf_dir, "labels").select(F.when(k % 3 == 0, F.concat(F.lit("lost"), k)).otherwise(k.cast("string")).alias("question_key"), *(v.cast("int").alias(d) for d, v in wanted.items()), F.array(F.concat(F.lit("s"), k % 5), F.concat(F.lit("s"), k % 3), F.lit("t")).alias("skills"), F.when(k % 2 == 0, F.array(F.concat(F.lit("e"), k % 7))).otherwise(none).alias("errors"))
    return analyses, gold


OVERLAP_SQL = "CASE WHEN len(list_distinct(list_concat(g.{0}, a.{0}))) = 0 THEN 1.0 ELSE len(list_intersect(list_distinct(g.{0}), list_distinct(a.{0}))) / len(list_distinct(list_concat(g.{0}, a.{0}))) END"


@query(RATED_SQL + f" SELECT question_key, CAST({OVERLAP_SQL.format('skills')} AS DOUBLE) AS skill_overlap, CAST({OVERLAP_SQL.format('errors')} AS DOUBLE) AS error_overlap, CAST(abs(coalesce(r, 0) - w_r) + abs(coalesce(p, 0) - w_p) + abs(coalesce(d, 0) - w_d) + abs(coalesce(i, 0) - w_i) + abs(coalesce(c, 0) - w_c) + abs(coalesce(e, 0) - w_e) AS INT) AS total_diff FROM g JOIN a USING (question_key)")
def gold_overlaps(spark, sf_dir):
    return compare.score_against_gold(*rated(spark, sf_dir))[1]


@query(RATED_SQL + " SELECT question_key FROM g WHERE question_key LIKE 'lost%'")
def gold_left_join_missing(spark, sf_dir):
    return compare.score_against_gold(*rated(spark, sf_dir))[2]


@query(RATED_SQL + f""", t AS (SELECT question_key, abs(coalesce(r, 0) - w_r) + abs(coalesce(p, 0) - w_p) + abs(coalesce(d, 0) - w_d) + abs(coalesce(i, 0) - w_i) + abs(coalesce(c, 0) - w_c) + abs(coalesce(e, 0) - w_e) AS diff, concat(r, p, d, i, coalesce(c, 0), e) AS got, concat(w_r, w_p, w_d, w_i, w_c, w_e) AS want FROM g JOIN a USING (question_key))
SELECT question_key, CAST(diff AS INT) AS total_diff, got, want FROM t ORDER BY diff DESC, question_key LIMIT 10""")
def largest_disagreements(spark, sf_dir):
    return compare.largest_disagreements(*rated(spark, sf_dir))


@query("""WITH q AS (SELECT DISTINCT CASE WHEN p_partkey % 2 = 0 THEN CAST(p_partkey AS VARCHAR) ELSE 'new' || p_partkey END AS k FROM part), a AS (SELECT CAST(l_partkey AS VARCHAR) AS k FROM lineitem)
SELECT issue_code, severity, count(*) AS n FROM (SELECT 'QUESTION_NOT_ANALYSED' AS issue_code, 'high' AS severity FROM q ANTI JOIN a USING (k) UNION ALL SELECT 'ANALYSIS_FOR_UNKNOWN_QUESTION', 'high' FROM a ANTI JOIN q USING (k)
UNION ALL SELECT 'DUPLICATE_ANALYSIS', 'medium' FROM a JOIN q USING (k) GROUP BY k HAVING count(*) > 1) GROUP BY issue_code, severity""")
def unknown_and_missing_antijoin(spark, sf_dir):
    """All parts as questions, half of them under ids that no analysis names; all lines as analyses."""
    k = F.col("p_partkey")
    q = read(spark, sf_dir, "part").select(F.when(k % 2 == 0, k.cast("string")).otherwise(F.concat(F.lit("new"), k)).alias("source_question_id"))
    a = read(spark, sf_dir, "lineitem").select(F.col("l_partkey").cast("string").alias("source_question_id"))
    return solving.check_payload(q, a).groupBy("issue_code", "severity").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH s AS (SELECT CAST(o_orderkey AS VARCHAR) AS q, o_orderpriority AS p FROM orders WHERE o_orderkey % 5 <> 0),
l AS (SELECT CAST(l_orderkey AS VARCHAR) AS q, arg_max(l_returnflag <> 'R', {LINE_SQL}) AS reached, arg_max(CAST(CAST(l_quantity AS INT) AS VARCHAR), {LINE_SQL}) AS answer FROM lineitem GROUP BY l_orderkey),
j AS (SELECT s.q, l.q IS NULL AS lost, reached, answer, CAST(10 + CAST(s.q AS BIGINT) % 40 AS VARCHAR) AS ref FROM s LEFT JOIN l USING (q))
SELECT source_question_id, issue_code, severity FROM (SELECT q AS source_question_id, 'SOLUTION_MISSING' AS issue_code, 'medium' AS severity FROM j WHERE lost
UNION ALL SELECT q, CASE WHEN CAST(q AS BIGINT) % 3 = 0 THEN 'SOLUTION_NEEDS_DIAGRAM' ELSE 'STRATEGY_DOES_NOT_SOLVE' END, CASE WHEN CAST(q AS BIGINT) % 3 = 0 THEN 'medium' ELSE 'high' END FROM j WHERE NOT reached
UNION ALL SELECT q, 'ANSWER_MISMATCH', 'high' FROM j WHERE reached AND answer <> ref AND length(answer) > 1
UNION ALL SELECT l.q, 'SOLUTION_FOR_UNKNOWN_STRATEGY', 'low' FROM l ANTI JOIN s USING (q)
UNION ALL SELECT CAST(l_orderkey AS VARCHAR), 'STRATEGIES_DISAGREE', 'high' FROM lineitem WHERE l_returnflag <> 'R' GROUP BY l_orderkey HAVING count(DISTINCT CAST(l_quantity AS INT)) > 1)""")
def strategy_solution_checks(spark, sf_dir):
    """Each order is a question with one strategy; its lines are solutions, the last of which counts."""
    o = read(spark, sf_dir, "orders")
    qid, sid = F.col("o_orderkey").cast("string").alias("source_question_id"), F.lit("s").alias("strategy_id")
    strategies = o.where("o_orderkey % 5 <> 0").select(qid, sid, F.col("o_orderpriority").alias("strategy_name"))
    questions = o.select(qid, (10 + F.col("o_orderkey") % 40).cast("string").alias("answer"), (F.col("o_orderkey") % 3 == 0).alias("diagram_required"), F.lit(False).alias("diagram_sent"))
    solutions = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("string").alias("source_question_id"), sid, F.expr(LINE_SQL).alias("ordinal"), (F.col("l_returnflag") != "R").alias("reached_answer"), F.col("l_quantity").cast("int").cast("string").alias("final_answer"), F.lit("").alias("notes"))
    return solving.check_solutions(strategies, solutions, questions).select("source_question_id", "issue_code", "severity")


@query("""WITH s AS (SELECT CAST(l_orderkey AS VARCHAR) AS q, substr(sha256(CAST(l_partkey AS VARCHAR)), 1, 12) AS sid, bool_or(l_returnflag <> 'R') AS reached, bool_or(l_linestatus = 'O' AND l_discount > 0.05) AS hit, bool_or(l_tax > 0.06) AS blind FROM lineitem GROUP BY ALL)
SELECT CASE WHEN NOT reached THEN CASE WHEN blind THEN 'unverified' ELSE 'rejected' END WHEN hit THEN 'proposed' ELSE 'confirmed' END AS status, count(*) AS n FROM s GROUP BY 1""")
def strategy_statuses(spark, sf_dir):
    line = read(spark, sf_dir, "lineitem")
    keys = [F.col("l_orderkey").cast("string").alias("source_question_id"), F.substring(F.sha2(F.col("l_partkey").cast("string"), 256), 1, 12).alias("strategy_id")]
    rows = line.groupBy(*keys).agg(F.bool_or(F.col("l_returnflag") != "R").alias("reached_answer"), F.bool_or((F.col("l_linestatus") == "O") & (F.col("l_discount") > 0.05)).alias("hit"), F.bool_or(F.col("l_tax") > 0.06).alias("blind"))
    message = F.concat(F.lit("q: ["), "strategy_id", F.lit("] is wrong"))
    issues = rows.where("hit").select("source_question_id", F.lit("STRATEGY_STEPS_WRONG").alias("issue_code"), F.lit("high").alias("severity"), message.alias("message"))
    issues = issues.unionByName(rows.where("blind").select("source_question_id", F.lit("SOLUTION_NEEDS_DIAGRAM").alias("issue_code"), F.lit("medium").alias("severity"), message.alias("message")))
    out = solving.strategy_status(rows.select("source_question_id", "strategy_id"), rows.withColumn("ordinal", F.lit(1)), issues)
    return out.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT item_id, doc_id FROM benchmark b JOIN documents d ON contains(d.text, b.text)")
def contains_theta_join(spark, sf_dir):
    items = read(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("item"))
    return contained_items(read(spark, sf_dir, "documents").select("doc_id", "text"), items, "doc_id", "item_id")


@query("""WITH p AS (SELECT p_partkey, p_brand, 'p' || p_size AS s FROM part) SELECT a.p_brand AS folder, a.paper, b.scheme FROM
(SELECT p_brand, s, arg_max(s || '.pdf', p_partkey) AS paper FROM p WHERE p_partkey % 2 = 0 GROUP BY p_brand, s) a JOIN (SELECT p_brand, s, arg_max(upper(s) || '-MS.pdf', p_partkey) AS scheme FROM p WHERE p_partkey % 2 = 1 GROUP BY p_brand, s) b USING (p_brand, s)""")
def pair_by_stem(spark, sf_dir):
    return compare.pair_by_stem(paper_files(spark, sf_dir))[0]


@query("""WITH p AS (SELECT p_partkey, p_brand, 'p' || p_size AS s FROM part) SELECT p_brand AS folder, upper(s) || '-MS.pdf' AS scheme FROM p WHERE p_partkey % 2 = 1 AND NOT EXISTS (SELECT 1 FROM p x WHERE x.p_partkey % 2 = 0 AND x.p_brand = p.p_brand AND x.s = p.s)""")
def orphan_schemes(spark, sf_dir):
    return compare.pair_by_stem(paper_files(spark, sf_dir))[1]


def paper_files(spark, sf_dir):
    stem = F.concat(F.lit("p"), "p_size")
    name = F.when(F.col("p_partkey") % 2 == 0, F.concat(stem, F.lit(".pdf"))).otherwise(F.concat(F.upper(stem), F.lit("-MS.pdf")))
    return read(spark, sf_dir, "part").select(F.col("p_brand").alias("folder"), name.alias("name"), F.col("p_partkey").alias("ordinal"))


@query(f"""WITH s AS (SELECT l_orderkey AS k, arg_max(l_returnflag, {LINE_SQL}) FILTER (WHERE l_returnflag <> 'N') AS answer, arg_min(CAST(l_quantity AS DOUBLE), {LINE_SQL}) FILTER (WHERE l_tax > 0.02) AS marks FROM lineitem GROUP BY 1)
SELECT o_orderkey, CASE WHEN s.k IS NOT NULL AND s.answer IS NOT NULL THEN s.answer ELSE o_orderstatus END AS answer, CASE WHEN s.k IS NOT NULL AND o_orderkey % 2 = 0 AND o_orderkey % 3 <> 0 THEN s.marks WHEN o_orderkey % 2 = 1 THEN CAST(1 AS DOUBLE) END AS marks,
  CASE WHEN s.answer <> o_orderstatus THEN o_orderstatus END AS conflict, CASE WHEN s.k IS NOT NULL THEN 'marking_scheme' ELSE 'paper' END AS answer_source FROM orders LEFT JOIN s ON k = o_orderkey""")
def attach_answers_last_wins(spark, sf_dir):
    k = F.col("o_orderkey")
    q = read(spark, sf_dir, "orders").select(F.lit("d").alias("doc"), k, k.alias("position"), F.concat(F.lit("Q "), k).alias("source_question_id"), F.col("o_orderstatus").alias("answer"), F.lit(None).cast("string").alias("worked_solution"), F.when(k % 2 == 1, 1.0).alias("marks"), F.when(k % 3 == 0, 5.0).alias("group_marks"))
    s = read(spark, sf_dir, "lineitem").select(F.lit("d").alias("doc"), F.expr(LINE_SQL).alias("ordinal"), F.concat(F.lit("q"), "l_orderkey").alias("source_question_id"), F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).otherwise("").alias("answer"), F.lit(None).cast("string").alias("worked_solution"), F.when(F.col("l_tax") > 0.02, F.col("l_quantity").cast("double")).alias("marks"))
    return compare.attach_answers(q, s).select("o_orderkey", "answer", "marks", "conflict", "answer_source")


@query("""WITH n AS (SELECT o_custkey, count(*) AS n, count(*) FILTER (WHERE o_orderstatus = 'O') AS m FROM orders GROUP BY o_custkey HAVING m > 0)
SELECT CAST(o_custkey AS VARCHAR) AS doc, CAST(o_orderkey AS VARCHAR) AS source_question_id, 'Question ' || o_orderkey || ' has no marks, but ' || m || ' of ' || n || ' questions do.' AS message FROM orders JOIN n USING (o_custkey) WHERE o_orderstatus <> 'O'""")
def marks_missing_conditional(spark, sf_dir):
    q = read(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("doc"), F.col("o_orderkey").cast("string").alias("source_question_id"), F.when(F.col("o_orderstatus") == "O", F.col("o_totalprice")).alias("marks"), F.lit(None).cast("double").alias("group_marks"))
    return rules.marks_missing(q).select("doc", "source_question_id", "message")


@query("SELECT o_custkey, o_orderkey, CAST(floor((row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) / 8) AS INT) AS batch FROM orders")
def batch_of_eight(spark, sf_dir):
    return solving.batches(read(spark, sf_dir, "orders").select("o_custkey", "o_orderkey"), ["o_custkey"], "o_orderkey")


@query("SELECT CAST(o_custkey AS VARCHAR) AS doc, 'Only ' || count(*) || ' question(s) found in ' || max(n) || ' pages.' AS message FROM (SELECT o_custkey, CAST(5 + o_custkey % 40 AS INT) AS n FROM orders) GROUP BY o_custkey HAVING count(*) < 0.5 * max(n)")
def density_check(spark, sf_dir):
    pages = (5 + F.col("o_custkey") % 40).cast("int")
    none = F.lit(None)
    docs = read(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).cast("int").alias("n_questions"))
    docs = docs.select(F.col("o_custkey").cast("string").alias("doc"), "n_questions", pages.alias("page_count"), F.lit("F4.pdf").alias("file_name"), F.lit("F4").alias("level"), none.cast("string").alias("level_text"), none.cast("string").alias("module_text"), none.cast("struct<matched:array<string>,unmatched_scheme_ids:array<string>,questions_without_answer:array<string>>").alias("marking_scheme"))
    return rules.document_rules(docs).where("issue_code = 'SUSPICIOUSLY_FEW_QUESTIONS'").select("doc", "message")


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def props_json_projection(spark, sf_dir):
    return read(spark, sf_dir, "events").select("event_id", F.from_json("props", "k long")["k"].alias("k"))


@query("SELECT user_id, count(*) AS attempts, count(*) FILTER (WHERE event_type = 'purchase') AS correct, count(*) FILTER (WHERE event_type = 'error') AS wrong, CAST(sum(CASE WHEN event_type = 'purchase' THEN round(value * 100) END) AS BIGINT) AS cents FROM events GROUP BY user_id")
def attempt_verdicts(spark, sf_dir):
    """Three-valued verdicts of each student: correct, wrong, and the rest unjudged; sums skip nulls."""
    correct = F.when(F.col("event_type") == "purchase", True).when(F.col("event_type") == "error", False)
    cents = F.sum(F.when(F.col("is_correct"), F.round(F.col("value") * 100))).cast("long").alias("cents")
    return stats.verdict_counts(read(spark, sf_dir, "events").withColumn("is_correct", correct), "user_id", "is_correct", cents)


@query("SELECT event_type AS model, count(*) AS calls, CAST(sum(CASE WHEN event_id % 3 > 0 THEN event_id END) AS BIGINT) AS input_tokens, CAST(sum(user_id) AS BIGINT) AS output_tokens FROM events GROUP BY event_type")
def token_sums(spark, sf_dir):
    e = read(spark, sf_dir, "events")
    return stats.token_sums(e.select(F.col("event_type").alias("model"), F.when(F.col("event_id") % 3 > 0, F.col("event_id")).alias("input_tokens"), F.col("user_id").alias("output_tokens")))


@query("""SELECT o_orderkey, len(list_filter(i, lambda x: x.kind = 'diagram')) AS diagrams, len(i) AS images, coalesce(array_to_string(list_transform(i, lambda x: x.kind || x.l_linenumber), ','), '') AS names FROM orders LEFT JOIN
(SELECT l_orderkey, list({'kind': CASE WHEN l_linestatus = 'O' THEN 'diagram' ELSE 'table' END, 'l_linenumber': l_linenumber} ORDER BY CASE WHEN l_linestatus = 'O' THEN 'diagram' ELSE 'table' END, l_linenumber) AS i FROM lineitem GROUP BY 1) x ON l_orderkey = o_orderkey""".replace("len(list_filter(i,", "len(list_filter(coalesce(i, []),").replace("len(i)", "len(coalesce(i, []))"))
def images_nested_collect(spark, sf_dir):
    kind = F.when(F.col("l_linestatus") == "O", "diagram").otherwise("table")
    rows = read(spark, sf_dir, "lineitem").select("l_orderkey", F.lit("q").alias("source_question_id"), kind.alias("kind"), F.col("l_linenumber").alias("index"))
    images = pictures.images_by_question(rows, "l_orderkey").withColumnRenamed("images", "i")
    j = read(spark, sf_dir, "orders").join(images, F.col("o_orderkey") == F.col("l_orderkey"), "left").withColumn("i", F.coalesce("i", F.expr("cast(array() as array<struct<kind:string,index:int>>)")))
    return j.select("o_orderkey", F.size(F.filter("i", lambda x: x["kind"] == "diagram")).cast("long").alias("diagrams"), F.size("i").cast("long").alias("images"), F.array_join(F.transform("i", lambda x: F.concat(x["kind"], x["index"])), ",").alias("names"))


@query("""WITH r AS (SELECT l_orderkey, l_linenumber, CAST(l_partkey % 900 AS INT) AS x, CAST(l_suppkey % 900 AS INT) AS y, CAST(l_quantity AS INT) AS w FROM lineitem),
b AS (SELECT *, x + w AS x2, y + 3 * w AS y2 FROM r)
SELECT l_orderkey, l_linenumber, (y2 <= 1000 AND x2 <= 1000 AND w >= 20) AS usable, greatest(0, CAST(round_even(x / 1000 * 1654 - 0.02 * 1654, 0) AS INT)) AS "left", greatest(0, CAST(round_even(y / 1000 * 2339 - 0.02 * 2339, 0) AS INT)) AS "top",
 greatest(least(1654, CAST(round_even(x2 / 1000 * 1654 + 0.02 * 1654, 0) AS INT)), greatest(0, CAST(round_even(x / 1000 * 1654 - 0.02 * 1654, 0) AS INT)) + 1) AS "right",
 greatest(least(2339, CAST(round_even(y2 / 1000 * 2339 + 0.02 * 2339, 0) AS INT)), greatest(0, CAST(round_even(y / 1000 * 2339 - 0.02 * 2339, 0) AS INT)) + 1) AS "bottom" FROM b""")
def crop_boxes(spark, sf_dir):
    x, y, w = (F.col("l_partkey") % 900).cast("int"), (F.col("l_suppkey") % 900).cast("int"), F.col("l_quantity").cast("int")
    r = F.struct(x.alias("x_min"), y.alias("y_min"), (x + w).alias("x_max"), (y + 3 * w).alias("y_max"))
    box = T.crop_box(F.col("r"), F.lit(1654), F.lit(2339))
    return read(spark, sf_dir, "lineitem").withColumn("r", r).select("l_orderkey", "l_linenumber", T.is_usable_region(F.col("r")).alias("usable"), *(box[s].alias(s) for s in ("left", "top", "right", "bottom")))


@query()
def text_diff(spark, sf_dir):
    """What a second reading of each benchmark text changed."""
    b = read(spark, sf_dir, "benchmark").select(F.col("item_id").alias("id"), F.col("text").alias("before"), F.regexp_replace("text", "the ", "a ").alias("after"))
    return compare.describe_text_changes(b)


@query("""SELECT doc_id AS id, CASE WHEN n > 0 THEN CASE WHEN p > 10 THEN '…' ELSE '' END || substring(text, p - 9, CASE WHEN p < 10 THEN p ELSE 10 END) || '{+‡‡+}' || substring(text, p + 1, 10) || CASE WHEN p + 10 < n THEN '…' ELSE '' END ELSE '{+‡‡+}' END AS detail
FROM (SELECT *, n - n // 3 AS p FROM (SELECT doc_id, text, length(coalesce(text, '')) AS n FROM documents)) WHERE n = 0 OR p >= 10""")
def inserted_text_diff(spark, sf_dir):
    """Documents of which a second reading holds two marks more, at two thirds of the text."""
    d = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.coalesce("text", F.lit("")).alias("before"))
    at = F.length("before") - F.floor(F.length("before") / 3).cast("int")
    d = d.withColumn("after", F.concat(F.substring(F.col("before"), F.lit(1), at), F.lit("‡‡"), F.substring(F.col("before"), at + 1, F.length("before"))))
    return compare.describe_text_changes(d.where((F.length("before") == 0) | (at >= 10))).select("id", "detail")


@query("SELECT item_id AS id, CAST(CASE WHEN item_id % 4 <> 0 THEN item_id % 3 END AS INT) AS level, CASE WHEN item_id % 4 = 0 THEN 'no recorded answer' END AS error FROM benchmark")
def recorded_model_stage(spark, sf_dir):
    """Prompts answered from a recording; those never recorded give a row with an error."""
    b = read(spark, sf_dir, "benchmark").select(F.col("item_id").alias("id"), models.prompt("Rate it.", "QUESTION", F.struct("item_id", "text")).alias("prompt"))
    known = b.where("id % 4 <> 0").select(F.sha2("prompt", 256).alias("k"), F.concat(F.lit('{"level": '), F.col("id") % 3, F.lit("}")).alias("a"))
    out = models.parsed(models.replayed(b, known), "level int")
    return out.select("id", F.col("payload.level").alias("level"), "error")


class Lengths:
    """A client that answers with a prompt's length."""

    def generate(self, prompt: str) -> str:
        return f'{{"n": {len(prompt)}}}'


@query("SELECT item_id AS id, length('Rate it: ' || text) AS n, 1 AS calls FROM benchmark")
def ledgered_model_stage(spark, sf_dir):
    """Even items asked for first, then all of them through the same ledger: no prompt is called twice."""
    b = read(spark, sf_dir, "benchmark").select(F.col("item_id").alias("id"), F.concat(F.lit("Rate it: "), "text").alias("prompt"))
    ledger = fresh_dir(spark, "ledger")
    models.call_once(b.where("id % 2 = 0"), ledger, Lengths, batches=2)
    told = models.parsed(models.call_once(b, ledger, Lengths, batches=2), "n long")
    calls = models.ledger_rows(spark, ledger).groupBy("k").agg(F.count(F.lit(1)).alias("calls"))
    keyed_prompts = b.select("id", F.sha2("prompt", 256).alias("k")).join(calls, "k")
    return told.join(keyed_prompts, "id").select("id", F.col("payload.n").alias("n"), "calls")


@query("SELECT event_id, event_type FROM events")
def incremental_file_source(spark, sf_dir):
    """All events arrive at the inbox, every second one three times; each event is in the table once. The stream is
    started anew from its checkpoint for each delivery and takes it in several batches."""
    base, twice = fresh_dir(spark, "inbox"), "event_id % 2 = 0"
    e = read(spark, sf_dir, "events").select("event_id", "event_type")
    schema = "event_id long, event_type string"
    for k, part in enumerate((e.where(twice), e, e.where(twice))):
        part.repartition(4).write.mode("append").json(f"{base}/inbox/{k}")
        ingest(spark, f"{base}/inbox", f"{base}/table", f"{base}/checkpoint", schema, "key", lambda b: keyed(b, "event_id", "key"), files_per_batch=2)
    return spark.read.parquet(f"{base}/table").select("event_id", "event_type")
