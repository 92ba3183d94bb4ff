"""Queries over literal fixtures: one for each operator that the driver's tables cannot feed. The SQL states the
rows that follow from the rules, worked out by hand."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyquill.functions import names as N
from tallyquill.functions import texts as T
from tallyquill.operators import compare, gold, ingest, pictures, repairs, rules, solving, stats, taxonomy
from tallyquill.sources import archive, rows, store, versions
from tallyquill.sources.shared import fresh_dir
from tests.cases import fixtures as X
from tests.cases.registry import query


def literal(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(v).upper()
    if isinstance(v, int | float):
        return f"CAST({v} AS {'DOUBLE' if isinstance(v, float) else 'INT'})"
    return "'" + str(v).replace("'", "''") + "'"


def table(columns: str, *data: tuple) -> str:
    """SQL of a table of literal rows; a column of NULLs is text."""
    return f"SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(literal, r)) + ')' for r in data)}) t({columns})"


def text_of(c, sep: str = ",") -> F.Column:
    return F.coalesce(F.array_join(c, sep), F.lit(""))


def put(spark, path: str, data: bytes) -> None:
    """A file of these bytes, by the file system that the path names."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = where.getFileSystem(spark._jsc.hadoopConfiguration()).create(where)
    out.write(data)
    out.close()


def validated(spark) -> DataFrame:
    docs = X.papers(spark).select(F.substring("source.sha256", 1, 1).alias("doc"), "document.*")
    return rules.validate_extraction(docs)


FAULTS = [
    ("CONTROL_CHARACTER", "high", "9"), ("DEPENDENCY_SELF", "medium", "17"), ("DEPENDENCY_UNKNOWN", "medium", "18"), ("DEPENDENCY_UNMARKED", "low", "19"), ("DIAGRAM_REGION_UNUSABLE", "medium", "7"), ("DUPLICATE_QUESTION_ID", "medium", "1"),
    ("EMPTY_QUESTION_TEXT", "critical", "2"), ("LATEX_NOT_DELIMITED", "medium", "8"), ("MALFORMED_TABLE", "medium", "12"), ("MARKS_INVALID", "medium", "6"), ("MARKS_MISSING", "low", "16"), ("MISSING_QUESTION_ID", "high", " "),
    ("OPTIONS_MISSING", "medium", "11"), ("OPTIONS_NOT_SEPARATED", "medium", "10"), ("PAGE_NUMBER_INVALID", "high", "3"), ("PAGE_OUT_OF_RANGE", "high", "5"), ("PAGE_RANGE_INVALID", "high", "4"), ("POSSIBLE_BROKEN_POWER", "medium", "15"),
    ("RAGGED_TABLE", "low", "13"), ("REPEATED_TEXT_IN_QUESTION", "medium", "14"), ("TABLE_NOT_CAPTURED", "low", "12"),
]


@query(table("issue_code, severity, source_question_id", *FAULTS))
def question_rule_faults(spark, sf_dir):
    """One question for each rule over a question, its siblings or the marks of its paper."""
    return validated(spark).where("doc = 'a'").select("issue_code", "severity", "source_question_id")


@query(table("doc, issue_code, severity, source_question_id",
    ("b", "CONTROL_CHARACTER", "high", "4"), ("b", "DEPENDENCY_UNMARKED", "low", "3(b)"), ("b", "DEPENDENCY_UNMARKED", "low", "6(b)"), ("b", "LATEX_NOT_DELIMITED", "medium", "5"), ("b", "REPEATED_TEXT_IN_QUESTION", "medium", "3(a)"), ("b", "STEM_CONTAMINATION", "high", "3(a)"), ("b", "STEM_CONTAMINATION", "high", "3(b)"),
    ("c", "ANSWER_NOT_IN_MARKING_SCHEME", "low", "2"), ("c", "INCONSISTENT_MINUS_SIGN", "low", None), ("c", "LEVEL_MISMATCH", "medium", None), ("c", "MARKING_SCHEME_UNMATCHED", "low", None), ("c", "MODULE_MISMATCH", "medium", None), ("c", "SUSPICIOUSLY_FEW_QUESTIONS", "medium", None),
    ("d", "LEVEL_MISSING", "low", None), ("d", "NO_QUESTIONS_FOUND", "critical", None), ("d", "PAGE_COUNT_INVALID", "high", None)))
def document_rule_faults(spark, sf_dir):
    """Faulty stems, schemes, names, dashes and empty papers; paper f is clean."""
    return validated(spark).where("doc <> 'a'").select("doc", "issue_code", "severity", "source_question_id")


@query(table("doc, message",
    ("a", "Question 5 claims page 9, but the document has 3 page(s)."),
    ("c", "File name says F4 but the paper prints '中五' (F5); using F4 from the filename. Rename the file if the paper is right."),
    ("c", "The file name says M1 but the paper prints 'M2' (M2); using M1 from the filename. Rename the file if the paper is right."),
    ("c", "This paper came back with 2 different dash characters (U+002D hyphen x3, U+2013 en dash x3). The page prints one; matching text later needs one.")))
def rule_messages(spark, sf_dir):
    return validated(spark).where("issue_code in ('PAGE_OUT_OF_RANGE', 'LEVEL_MISMATCH', 'MODULE_MISMATCH', 'INCONSISTENT_MINUS_SIGN')").select("doc", "message")


@query(table("doc, blocking", ("a", True), ("b", False), ("c", False), ("d", True)))
def blocking_documents(spark, sf_dir):
    return rules.blocking(validated(spark))


@query(table("source_question_id, question_text, depends_on, notes",
    ("3(a)", "設某公司有若干員工。求該公司員工的平均年齡。", "", "Repaired: removed '求該公司員工的平均年齡' from the stem shared by question 3; it is 3(a)'s own question."),
    ("3(b)", "設某公司有若干員工。由此求標準差是多少呢。", "3(a)", "Repaired: removed '求該公司員工的平均年齡' from the stem shared by question 3; it is 3(a)'s own question.|depends_on filled from the text ('Hence' / '由此' refers to the part before): 3(a)"),
    ("4", "\\( x\\bar \\)", "", "Repaired: restored 1 unescaped backslash(es) before 'b'.|Repaired: wrapped 1 displayed formula(s) in \\( \\)."),
    ("5", "\\( \\alpha = 1 \\)", "", "Repaired: wrapped 1 displayed formula(s) in \\( \\)."),
    ("6(b)", "using (a)", "6(a)", "depends_on filled from the text (named in the text): 6(a)"), ("6(a)", "Solve it.", "", "")))
def repaired_questions(spark, sf_dir):
    q = archive.questions_of(X.papers(spark)).where("doc like 'b%'")
    return repairs.repaired(q).select("source_question_id", "question_text", text_of("depends_on").alias("depends_on"), text_of("extraction_notes", "|").alias("notes"))


@query(table("file, status, questions, lines, codes",
    ("S5-2526_2nd-exam.pdf", "ok", 6, 7, ""),
    ("empty.pdf", "failed", 0, 0, "PAGE_COUNT_INVALID,NO_QUESTIONS_FOUND,LEVEL_MISSING"),
    ("F6 clean (1).pdf", "ok", 3, 0, "ANSWER_NOT_IN_MARKING_SCHEME,MARKING_SCHEME_UNMATCHED")))
def ingest_chain(spark, sf_dir):
    """Repair, attach, validate: the faults of b are mended, d fails, f gets a scheme that fits in part."""
    scheme = spark.createDataFrame([("f" * 12, 1, "1", "5", "", None), ("f" * 12, 2, "8", "x", "", None)], "doc string, ordinal int, source_question_id string, answer string, worked_solution string, marks double")
    files = spark.createDataFrame([("f" * 12, "F6-ms.pdf", "9" * 64, 1)], "doc string, file_name string, sha256 string, page_count int")
    out = ingest.ingested(X.papers(spark).where("substring(source.sha256, 1, 1) in ('b', 'd', 'f')"), scheme, files)
    done = ingest.outcomes(out).select("file", "status", "questions")
    codes = out.select(F.col("source.file_name").alias("file"), F.coalesce(F.size("repairs"), F.lit(0)).alias("lines"), F.when(F.substring("doc", 1, 1) == "d", text_of(F.transform("issues", lambda i: i["issue_code"]))).otherwise(text_of(F.array_sort(F.transform("issues", lambda i: i["issue_code"])))).alias("codes"))
    return done.join(codes, "file")


@query(table("run_id, answers, matched, unmatched, silent", ("late-f", ",,4", "2(b)", "7", "1,2(a)")))
def late_scheme(spark, sf_dir):
    """A scheme that comes after its paper: a new run, the last entry of an id wins, printed answers give way."""
    scheme = spark.createDataFrame([("f" * 12, 1, "2 (B)", "3", "", None), ("f" * 12, 2, "2(b)", "4", "", 2.0), ("f" * 12, 3, "7", "x", "", None)], "doc string, ordinal int, source_question_id string, answer string, worked_solution string, marks double")
    files = spark.createDataFrame([("f" * 12, "F6-ms.pdf", "9" * 64, 1)], "doc string, file_name string, sha256 string, page_count int")
    out = ingest.with_late_scheme(X.papers(spark), scheme, files, F.lit("late-f"), F.lit("2026-02-01"))
    s = F.col("document.marking_scheme")
    return out.select(F.col("run.run_id").alias("run_id"), text_of(F.transform("document.questions", lambda q: F.coalesce(q["answer"], F.lit("")))).alias("answers"), text_of(s["matched"]).alias("matched"), text_of(s["unmatched_scheme_ids"]).alias("unmatched"), text_of(s["questions_without_answer"]).alias("silent"))


@query(table("sha, file_name, page_count, level, module, year, topics", ("a", "F4-faults.pdf", 3, "F4", None, None, None), ("b", "S5-2526_2nd-exam.pdf", 3, "F5", None, None, None), ("c", "F4-M1.pdf", 8, "F4", "M1", None, None), ("d", "empty.pdf", 0, None, None, None, None), ("f", "F6 clean (1).pdf", 3, "F6", None, None, None)))
def document_rows(spark, sf_dir):
    return rows.document_rows(X.papers(spark)).select(F.substring("sha256", 1, 1).alias("sha"), "file_name", "page_count", "level", "module", "year", F.array_join("topics", ",").alias("topics"))


@query(table("run_id, question_count, issue_count, blocking, is_current, scheme, input_tokens", ("run-1-a", 23, 21, True, False, None, 10), ("run-1-b", 6, 7, False, True, None, 10), ("run-1-c", 2, 6, False, True, "ms.pdf", 10), ("run-1-d", 0, 3, True, False, None, 10), ("run-1-f", 3, 0, False, True, None, 10)))
def run_rows(spark, sf_dir):
    results = ingest.with_issues(X.papers(spark).withColumn("doc", N.paper_key(F.col("source.sha256"))))
    return rows.run_rows(results).select("run_id", "question_count", "issue_count", "blocking", "is_current", F.col("marking_scheme_file_name").alias("scheme"), "input_tokens")


@query(table("question_key, position, answer_source, level, images", ("cccccccccccc:1", 1, "marking_scheme", "F4", ""), ("cccccccccccc:2", 2, "paper", "F4", ""), ("ffffffffffff:1", 1, None, "F6", ""), ("ffffffffffff:2(a)", 2, None, "F6", "diagram0"), ("ffffffffffff:2(b)", 3, "paper", "F6", "table1,table0")))
def question_rows(spark, sf_dir):
    q = rows.question_rows(X.papers(spark)).where("substring(sha256, 1, 1) in ('c', 'f')")
    return q.select("question_key", "position", "answer_source", "level", text_of(F.transform("images", lambda i: F.concat(i["kind"], i["index"]))).alias("images"))


@query(table("file_name, level, level_source, module, module_source, paper", ("2526_1st-mock_S4M1_paper-2.pdf", "F4", "filename", "M1", "filename", "2025-26, 1st term, mock, paper 2 (from filename)"), ("x.pdf", "F3", "paper", "compulsory", "default", "unknown"), ("y.pdf", "F6", "old", "M2", "old", "2020 (from old)")))
def backfill(spark, sf_dir):
    old = [X.result("a", [], "2526_1st-mock_S4M1_paper-2.pdf", level=None), X.result("b", [], "x.pdf", level=None, level_text="Form 3", level_source=None), X.result("c", [], "y.pdf", level="F6", level_source="old", module="M2", module_source="old", paper=dict(year="2020", topics=[], source="old"))]
    d = F.col("document")
    return rows.filled_in(X.papers(spark, old)).select(*(d[c].alias(c) for c in ("file_name", "level", "level_source", "module", "module_source")), N.paper_label(d["paper"]).alias("paper"))


@query(table("question_key, rpdice, drivers, issues, solutions, critic, critic_run_id", ("aaaaaaaaaaaa:1", "R1 P1 D0 I0 C0 E0", "", "", "aaaaaaaaaaaa", "LEVEL_OVERRATED", "cr-1"), ("aaaaaaaaaaaa:2", "R2 P1 D0 I1 C0 E2", "R,E", "", "", "SKILL_MISSING", "cr-1"), ("aaaaaaaaaaaa:3", None, "", "NO_STRATEGY", "", "", "cr-1")))
def analysis_rows(spark, sf_dir):
    a = rows.analysis_rows(X.analyses(spark, X.RUN_1))
    return a.select("question_key", F.when(F.col("rpdice").isNotNull(), compare.profile_summary(F.col("rpdice"))).alias("rpdice"), text_of("difficulty_drivers").alias("drivers"), text_of(F.transform("issues", lambda i: i["issue_code"])).alias("issues"), text_of(F.transform("solutions", lambda s: s["strategy_id"])).alias("solutions"), text_of(F.transform("critic_issues", lambda i: i["issue_code"])).alias("critic"), "critic_run_id")


@query(table("student_id, answer_given, is_correct, strategy_match, needs_human, attempted_at", ("s1", "B", True, "listed", False, "t1"), ("s2", "9", None, "none", True, "t2")))
def attempt_rows(spark, sf_dir):
    return rows.attempt_rows(X.attempts(spark)).select("student_id", "answer_given", "is_correct", "strategy_match", "needs_human", "attempted_at")


@query(table("question_key, analysis_run_id, push, is_current", ("aaaaaaaaaaaa:1", "an-1", 3, True), ("aaaaaaaaaaaa:2", "an-1", 3, True), ("aaaaaaaaaaaa:3", "an-1", 3, True), ("aaaaaaaaaaaa:1", "an-2", 2, False), ("aaaaaaaaaaaa:2", "an-2", 2, False), ("aaaaaaaaaaaa:4", "an-2", 2, True)))
def push_analysis(spark, sf_dir):
    """Run 1, run 2, then run 1 again: its first rows go, and it is current where both have a question."""
    path = fresh_dir(spark, "analyses")
    for push, run in enumerate((X.RUN_1, X.RUN_2, X.RUN_1), 1):
        store.push_analyses(rows.analysis_rows(X.analyses(spark, run)), path, push)
    return store.current_analyses(spark.read.parquet(path)).select("question_key", "analysis_run_id", F.col("push").cast("int").alias("push"), "is_current")


@query(table("student_id, attempts", ("s1", 2), ("s2", 2)))
def push_attempt(spark, sf_dir):
    """Students once, attempts as often as they come."""
    kept = versions.attempt_store(spark, fresh_dir(spark, "attempts"))
    for k in range(2):
        versions.push_attempts(kept, rows.attempt_rows(X.attempts(spark)).withColumn("attempt_id", F.concat_ws(":", "student_id", "question_key", F.lit(k))))
    students, attempts = (kept.latest().table(t) for t in ("students", "attempts"))
    return students.join(attempts, "student_id").groupBy("student_id").agg(F.count(F.lit(1)).cast("int").alias("attempts"))


@query(table("part, n", ("documents", 10), ("questions", 68), ("runs", 10), ("current", 11), ("stored", 5)))
def store_round_trip(spark, sf_dir):
    """Five papers saved twice, then saved as second runs: a run once, the newest good run of each current."""
    kept = store.results_store(spark, fresh_dir(spark, "store"))
    again = [r | dict(run=r["run"] | dict(run_id=r["run"]["run_id"].replace("run-1", "run-2"), extracted_at="2026-03-01")) for r in X.PAPERS]
    keyed = N.paper_key(F.col("source.sha256"))
    for results in (X.PAPERS, X.PAPERS, again):
        store.save_results(kept, ingest.with_issues(X.papers(spark, results).withColumn("doc", keyed)))
    d, q, r = (kept.latest().table(t) for t in ("documents", "questions", "runs"))
    parts = {"documents": d, "questions": q, "runs": r, "current": store.current_questions(r, q), "stored": store.stored_documents(d)}
    out = None
    for name, df in parts.items():
        n = df.agg(F.count(F.lit(1)).cast("int").alias("n")).select(F.lit(name).alias("part"), "n")
        out = n if out is None else out.unionByName(n)
    return out


@query(table("sha256, level, module, year, file_name", ("x", "F4", "M1", "2025", "new.pdf")))
def stored_document(spark, sf_dir):
    """A later run that knows less leaves level, module and paper as they were."""
    cols = "sha256 string, file_name string, page_count int, byte_size long, year string, term string, exam_type string, paper_number int, school string, topics array<string>, level string, module string, run_id string, extracted_at string"
    d = spark.createDataFrame([("x", "old.pdf", 1, 1, "2025", None, None, None, None, [], "F4", None, "1", "t1"), ("x", "mid.pdf", 1, 1, None, None, None, None, None, None, None, "M1", "2", "t2"), ("x", "new.pdf", 1, 1, None, None, None, None, None, None, None, None, "3", "t3")], cols)
    return store.stored_documents(d).select("sha256", "level", "module", "year", "file_name")


@query(table("sha256, level, module, file_name", ("a", "F5", "M1", "a2.pdf"), ("b", "F3", None, "b.pdf"), ("c", None, None, "c.pdf")))
def upsert_document(spark, sf_dir):
    cols = "sha256 string, level string, module string, file_name string"
    stored = spark.createDataFrame([("a", "F4", "M1", "a.pdf"), ("b", "F3", None, "b.pdf")], cols)
    new = spark.createDataFrame([("a", "F5", None, "a2.pdf"), ("c", None, None, "c.pdf")], cols)
    return stats.merge_documents(stored, new)


@query(table("doc, kind, idx, file, cropped, box", ("f", "diagram", 0, "2-a.png", True, "0,0,520,1040"), ("f", "table", 0, "2-b-table-1.png", True, "0,0,520,1040"), ("f", "table", 1, "2-b-table-2.png", False, "0,0,1000,2000"), ("a", "diagram", 0, "7.png", False, "0,0,1000,2000"), ("a", "table", 0, "13-table-1.png", True, "0,0,520,1040")))
def planned_images(spark, sf_dir):
    """Pictures of papers a and f, with the pixels to cut on pages of 1000 by 2000."""
    q = archive.questions_of(X.papers(spark)).withColumn("doc", F.substring("doc", 1, 1))
    pages = spark.createDataFrame([(d, p, 1000, 2000) for d in "af" for p in (1, 2)], "doc string, page int, width int, height int")
    plan = pictures.crop_plan(pictures.planned_images(q), pages)
    return plan.select("doc", "kind", F.col("index").alias("idx"), "file", "cropped", F.concat_ws(",", *(F.col("box")[s] for s in ("left", "top", "right", "bottom"))).alias("box"))


@query(table("source_question_id, diagram, tables", ("1", None, ""), ("2(a)", "d.png", ""), ("2(b)", None, "t1.png,t2.png")))
def question_images(spark, sf_dir):
    p = X.papers(spark).where("substring(source.sha256, 1, 1) = 'f'")
    images = p.select(F.lit("f").alias("doc"), F.explode(F.concat("diagrams", "tables")).alias("i")).select("doc", "i.*")
    q = archive.questions_of(p).withColumn("doc", F.lit("f"))
    return pictures.with_images(q, images).select("source_question_id", "diagram", text_of("tables").alias("tables"))


@query(table("json, report, history, pictures", ("F6-clean-1-ffffffffffff.json", "F6-clean-1-ffffffffffff.md", "history/F6-clean-1-ffffffffffff/run-1-f.json", "F6-clean-1-ffffffffffff")))
def output_names(spark, sf_dir):
    return store.output_names(X.papers(spark).where("substring(source.sha256, 1, 1) = 'f'"))


@query(table("part, n", ("good", 5), ("bad", 2), ("latest", 5), ("history", 10)))
def archive_round_trip(spark, sf_dir):
    """Results written twice, and files that are none: latest holds a paper once, history every run."""
    base = fresh_dir(spark, "archive")
    for _ in range(2):
        store.write_archive(X.papers(spark), base)
    for k, text in enumerate([*(json.dumps(p) for p in X.PAPERS), "{not json", '{"other": 1}']):
        put(spark, f"{base}/in/{k}.json", text.encode())
    good, bad = archive.read_archive(spark, f"{base}/in")
    parts = {"good": good, "bad": bad, "latest": spark.read.schema(archive.ARCHIVE).json(f"{base}/latest"), "history": spark.read.schema(archive.ARCHIVE).json(f"{base}/history")}
    out = None
    for name, df in parts.items():
        n = df.agg(F.count(F.lit(1)).cast("int").alias("n")).select(F.lit(name).alias("part"), "n")
        out = n if out is None else out.unionByName(n)
    return out


@query(table("path, destination", ("in/a.pdf", "processed/a.pdf"), ("in/x/a.pdf", "processed/a-2.pdf"), ("in/y/a.pdf", "failed/a.pdf"), ("in/b", "processed/b")))
def route_files(spark, sf_dir):
    files = spark.createDataFrame([("in/a.pdf", "a.pdf", False), ("in/x/a.pdf", "a.pdf", False), ("in/y/a.pdf", "a.pdf", True), ("in/b", "b", False)], "path string, name string, bad boolean")
    return store.route(files, F.col("bad")).select("path", "destination")


@query(table("scheme, path", ("F4-p_ms.pdf", "out/F4-p-0123456789ab.json"), ("Ünit 1 answers.pdf", "out/Ünit-1-aaaaaaaaaaaa.json")))
def find_extraction(spark, sf_dir):
    """The newest archived paper of each late scheme."""
    schemes = spark.createDataFrame([("F4-p_ms.pdf",), ("Ünit 1 answers.pdf",), ("none-ms.pdf",), ("paper.pdf",)], "name string")
    archived = spark.createDataFrame([("out/F4-p-ffffffffffff.json", 1), ("out/F4-p-0123456789ab.json", 2), ("out/Ünit-1-aaaaaaaaaaaa.json", 1), ("out/F4-p-extra.json", 9), ("out/none.json", 1)], "path string, modified int")
    return archive.find_extraction_for(schemes, archived)


@query(table("asked, path, qid", ("key", "out/b-0123456789ab.json", "2(a)"), ("paper", "out/a-ffffffffffff.json", "7")))
def locate_question(spark, sf_dir):
    archived = spark.createDataFrame([("out/b-0123456789ab.json",), ("out/a-ffffffffffff.json",), ("out/ab-ffffffffffff.json",)], "path string")
    by_key = archive.locate(archived, key="0123456789ab:2(a)").select(F.lit("key").alias("asked"), "path", "qid")
    return by_key.unionByName(archive.locate(archived, paper="a", qid="7").select(F.lit("paper").alias("asked"), "path", "qid"))


@query(table("qid, wanted, hit", ("17", "17", True), ("17(a)", "17", True), ("17(b)(i)", "17", True), ("171", "17", False), ("17(a)", "17(a)", True), ("17(a)(i)", "17(a)", True), ("17(b)", "17(a)", False)))
def show_matches(spark, sf_dir):
    d = spark.createDataFrame([("17", "17"), ("17(a)", "17"), ("17(b)(i)", "17"), ("171", "17"), ("17(a)", "17(a)"), ("17(a)(i)", "17(a)"), ("17(b)", "17(a)")], "qid string, wanted string")
    return d.withColumn("hit", archive.matches(F.col("qid"), F.col("wanted")))


@query(table("name, mime", ("a.PNG", "image/png"), ("b.jpeg", "image/jpeg"), ("c.pdf", "application/pdf"), ("d.webp", "image/webp")))
def scan_mime(spark, sf_dir):
    return archive.with_mime(spark.createDataFrame([("a.PNG",), ("b.jpeg",), ("c.pdf",), ("d.webp",)], "name string"))


@query(table("path, error", ("a.pdf", None), ("b.txt", "not a PDF"), ("c.PDF", "empty file"), ("d.pdf", "not a PDF")))
def pdf_errors(spark, sf_dir):
    return archive.checked_files(spark.createDataFrame([("a.pdf", 9, "%PDF-1.7"), ("b.txt", 3, "abc"), ("c.PDF", 0, ""), ("d.pdf", 4, "<htm")], "path string, length int, head string"))


@query(table("line", ("  skipped  x.json  not an extraction",)))
def skipped_files(spark, sf_dir):
    return archive.reported(spark.createDataFrame([("in/x.json",)], "path string"))


@query(table("source_question_id, content", ("2(a)", "png")))
def diagram_images(spark, sf_dir):
    p = X.papers(spark).where("substring(source.sha256, 1, 1) = 'f'").select(F.explode(F.concat("diagrams", "tables")).alias("i")).select("i.*")
    files = spark.createDataFrame([("d.png", "png"), ("t1.png", "png")], "path string, content string")
    return archive.diagram_images(p, files, spark.createDataFrame([("2(a)",), ("2(b)",)], "source_question_id string"))


@query("SELECT * FROM (VALUES ('a.pdf', sha256('%PDF-1.7'), 8), ('B.PDF', sha256('%PDF-1.7'), 8), ('c.pdf', sha256('abc'), 3)) t(name, sha256, byte_size)")
def found_pdfs(spark, sf_dir):
    """PDFs below a folder, suffix in any case, empty ones left out."""
    base = fresh_dir(spark, "pdfs")
    for name, data in (("a.pdf", b"%PDF-1.7"), ("x/B.PDF", b"%PDF-1.7"), ("x/y/c.pdf", b"abc"), ("d.txt", b"abc"), ("e.pdf", b"")):
        put(spark, f"{base}/{name}", data)
    return archive.find_pdfs(spark, base).select("name", "sha256", F.col("byte_size").cast("int").alias("byte_size"))


@query(table("path", ("a1",), ("c",)))
def new_files(spark, sf_dir):
    """Content archived already is left, and of equal files the first by path is taken."""
    files = spark.createDataFrame([("a2", "A"), ("a1", "A"), ("b", "B"), ("c", "C")], "path string, sha256 string")
    return archive.new_files(files, spark.createDataFrame([("B",)], "sha256 string")).select("path")


def csv(spark, name: str, text: str) -> str:
    path = fresh_dir(spark, name)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)
    return path


@query(table("skill_id, name_en, foundation, prerequisites, guide_ref", ("na.a.x", 'x, "y"', "foundation", "na.a.y,na.b.c", "CP-1.1"), ("na.a.y", "y", "?", "", ""), ("na.a.z", "z", None, "", "ext")))
def read_skills(spark, sf_dir):
    path = csv(spark, "skills", '# comment\n\n  # more\nskill_id,name_en,foundation,prerequisites,guide_ref\nna.a.x,"x, ""y""",F, na.a.y ; ;na.b.c,CP-1.1\nna.a.y,y,Q,,\nna.a.z,z,,,ext')
    return archive.read_skills(spark, path).select("skill_id", "name_en", "foundation", text_of("prerequisites").alias("prerequisites"), text_of("guide_ref").alias("guide_ref"))


@query(table("error_id, skills", ("err.a.b", "na.a.x,na.*"), ("err.c.d", "*")))
def read_errors(spark, sf_dir):
    return archive.read_errors(spark, csv(spark, "errors", "error_id,skills\nerr.a.b, na.a.x;na.*\nerr.c.d,*")).select("error_id", text_of("skills").alias("skills"))


@query(table("ref, status", ("CP-1.1", "foundation"), ("M1-2.3", "non-foundation"), ("CP-9", "enrichment")))
def read_objectives(spark, sf_dir):
    path = csv(spark, "objectives", "part,strand,unit_no,unit,obj,nf,time,text,remarks,page\nCP,na,1,u,1.1,F,,t,,1\nM1,m1,1,u,2.3,N,,t,,1\nCP,na,9,u,9,E,,t,,1")
    return archive.read_objectives(spark, path).select("ref", "status")


@query(table("question_key, R, E, skills, errors, status", ("k:1", 1, 2, "a,b", "", "draft"), ("k:2", 0, 3, "a", "e", "confirmed")))
def read_gold(spark, sf_dir):
    path = csv(spark, "gold", "question_key,paper,source_question_id,skills,R,P,D,I,C,E,errors,rater,status,notes\nk:1,p,1,a;b,1,0,0,0,0,2,,me,,\nk:2,p,2,a,0,0,0,0,0,3,e,me,confirmed,")
    return archive.read_gold(spark, path).select("question_key", "R", "E", text_of("skills").alias("skills"), text_of("errors").alias("errors"), "status")


@query(table("file, year, term, exam_type, paper_number, school, topics, source, module", ("2526_1st.pdf", "2025-26", "1st", "quiz", 3, "St. X", "algebra,圖像", "sidecar", "M2"), ("2024_final-mock.pdf", "2024", "final", "mock", None, None, "", "filename", None), ("x.pdf", "2020", None, None, None, None, "", "sidecar", "compulsory")))
def resolved_meta(spark, sf_dir):
    """Sidecar fields first, the file name filling in what they leave."""
    notes = {"2526_1st.pdf": "# about\nExam: quiz\nPaper: no 3\nschool: St. X # yes\nsubject: algebra; 圖像\nPart: Module 2\ncolour: red", "2024_final-mock.pdf": "", "x.pdf": "year: 2019\nyear: 2020\nmodule: compulsory\nterm:"}
    d = spark.createDataFrame(list(notes.items()), "file string, text string").withColumn("m", N.parse_sidecar(F.col("text")))
    r = N.resolve_meta(F.col("file"), F.col("m"))
    return d.select("file", *(r[c].alias(c) for c in ("year", "term", "exam_type", "paper_number", "school")), text_of(r["topics"]).alias("topics"), r["source"].alias("source"), N.sidecar_module(F.col("m")).alias("module"))


@query(table("k, value", ("level", "F4 filename"), ("level paper", "F5 paper"), ("level none", " "), ("asset", "17-a-ii"), ("asset none", "question"), ("marks", "1 mark"), ("marks half", "2.5 marks"), ("pages", "pages 2–4"), ("module", "Extended Part Module 1 (Calculus and Statistics)"), ("expected", "F"), ("expected N", "N"), ("listed", "a,b"), ("hence", "true"), ("bare", "true"), ("bare not", "false"), ("wrapped", "Let\n  \\( x^{2} \\)"), ("parts", "3(a),3(b)(ii),3(c)"), ("prefix", "ab"), ("sentence", "甲。乙？"), ("same id", "true"), ("extended", "true")))
def scalar_cases(spark, sf_dir):
    s = F.lit
    none = s(None).cast("string")
    level = lambda *a: N.resolve_level(*a)
    arr = lambda *x: F.array(*map(F.lit, x))
    cases = {
        "level": F.concat_ws(" ", *(level(s("S4 x.pdf"), s("Form 5"))[c] for c in ("level", "source"))), "level paper": F.concat_ws(" ", *(level(s("x.pdf"), s("中五"))[c] for c in ("level", "source"))), "level none": F.concat(F.coalesce(level(s("S1 S2"), none)["level"], s("")), s(" "), F.coalesce(level(s("S1 S2"), none)["source"], s(""))),
        "asset": N.safe_asset_name(s("17(a)(ii)")), "asset none": N.safe_asset_name(s("（）")), "marks": N.marks_label(s(1.0)), "marks half": N.marks_label(s(2.5)), "pages": N.pages_label(s(2), s(4)), "module": N.module_label(s("M1")),
        "expected": taxonomy.expected_flag(F.expr("cast(array() as array<string>)"), arr("KS2")), "expected N": taxonomy.expected_flag(arr("enrichment", "non-foundation"), arr("CP-1.1")), "listed": text_of(F.filter(F.transform(F.split(s("a; ;b "), ";"), N.stripped), lambda x: x != "")),
        "hence": T.says_hence(s("(b) Hence solve")).cast("string"), "bare": T.is_bare_formula(s(" x_{10} ")).cast("string"), "bare not": T.is_bare_formula(s("設 x_{10}")).cast("string"), "wrapped": T.wrap_bare_formulas(s("Let\n  x^{2}"))["text"],
        "parts": text_of(T.referenced_parts(s("Using (a) and results of (ii), by (c)"), s("3(b)(c)"))), "prefix": repairs.common_prefix(arr("abc", "abd", "ab")), "sentence": repairs.up_to_sentence_end(s("甲。乙？丙")),
        "same id": (N.strategy_id(s("Factor it!"), arr("b", "a")) == N.strategy_id(s("factor  it"), arr("a", "b", "a"))).cast("string"), "extended": N.mentions_extended_part(s("the Extended Part")).cast("string"),
    }
    return spark.range(1).select(F.explode(F.array(*(F.struct(s(k).alias("k"), v.alias("value")) for k, v in cases.items()))).alias("x")).select("x.*")


@query(table("problem", ("k1 is rated more than once",), ("k1: D = 4, not 0-3",), ("k2: error err.x.y does not exist",), ("k2: no skills",), ("k2: status 'open' is not draft or confirmed",), ("k3: skill na.a.b does not exist",)))
def gold_problems(spark, sf_dir):
    cols = "question_key string, R int, P int, D int, I int, C int, E int, skills array<string>, errors array<string>, status string"
    rated = spark.createDataFrame([("k1", 0, 0, 4, 0, 0, 0, ["na.eq.solve"], [], "draft"), ("k1", 0, 0, 0, 0, 0, 0, ["na.eq.solve"], [], "draft"), ("k2", 0, 0, 0, 0, 0, 0, [], ["err.x.y"], "open"), ("k3", 0, 0, 0, 0, 0, 3, ["na.a.b", "na.eq.quad"], ["err.any.copy"], "confirmed")], cols)
    return gold.validate_gold(rated, X.skills(spark), X.errors(spark))


@query(table("compared, mean_skill_overlap, mean_error_overlap", (2, 0.75, 0.5)))
def scorecard_means(spark, sf_dir):
    each = spark.createDataFrame([(0.5, 1.0), (1.0, 0.0)], "skill_overlap double, error_overlap double")
    return gold.scorecard_means(each).select(F.col("compared").cast("int").alias("compared"), "mean_skill_overlap", "mean_error_overlap")


def flat_analyses(spark, run):
    main = solving.primary(F.col("a.strategies"))
    levels = F.struct(*(main["rpdice"][d]["level"].alias(d) for d in "RPDICE"))
    return X.analyses(spark, run).select(F.explode("analyses").alias("a")).where(F.size("a.strategies") > 0).select("a.source_question_id", levels.alias("levels"), F.col("a.atomic_skills").alias("skills"), F.col("a.possible_errors").alias("errors"), main.alias("primary"))


@query(table("source_question_id, status, levels, added, removed, errors, primary_changed", ("1", "both", "R 1->3", "na.poly.factor", "na.eq.quad", "err.sign.lost", False), ("2", "both", "", "", "", "", True), ("4", "added", "", "", "", "", None)))
def analysis_diff(spark, sf_dir):
    d = compare.diff_analyses(flat_analyses(spark, X.RUN_1), flat_analyses(spark, X.RUN_2))
    return d.select("source_question_id", "status", text_of("levels").alias("levels"), text_of(F.col("skills")["added"]).alias("added"), text_of(F.col("skills")["removed"]).alias("removed"), text_of(F.col("errors")["removed"]).alias("errors"), "primary_changed")


@query(table("dim, n", ("R", 1), ("P", 0), ("D", 0), ("I", 0), ("C", 0), ("E", 0)))
def letter_counts(spark, sf_dir):
    return compare.letter_counts(compare.diff_analyses(flat_analyses(spark, X.RUN_1), flat_analyses(spark, X.RUN_2))).select("dim", F.col("n").cast("int").alias("n"))


@query(table("questions, changed, levels, skills, primaries", (3, 3, 1, 1, 1)))
def analysis_diff_summary(spark, sf_dir):
    d = compare.diff_summary(compare.diff_analyses(flat_analyses(spark, X.RUN_1), flat_analyses(spark, X.RUN_2)))
    return d.select(*(F.col(c).cast("int").alias(c) for c in d.columns))


@query(table("what, name, n", ("strand", "na", 3), ("strand", "ms", 1), ("strand", "m1", 1), ("strand", "m2", 1), ("form", "F1", 1), ("form", "F3", 1), ("form", "F4", 1), ("form", "F5", 2), ("form", "F6", 1), ("foundation", "foundation", 1), ("foundation", "non-foundation", 1), ("total", "skills with an error pattern", 4), ("total", "objectives", 6), ("total", "objectives assessed", 5), ("total", "objectives covered", 4), ("total", "skills outside the Guide", 1)))
def taxonomy_counters(spark, sf_dir):
    c = taxonomy.counters(X.skills(spark), X.errors(spark), X.objectives(spark))
    return c.select("what", "name", F.col("n").cast("int").alias("n"))


PAIRS = [("B (1024)", "1024", True), ("B (1024)", "99", False), ("B", "1024", None), ("12", "A", None), ("\\frac{1}{2}", "0.5", True), ("x = 3 cm", "3", True), ("(A)", "a", True), ("", "3", None), ("7", "8", False), ("\\(\\frac{\\frac{1}{2}}{3}\\)", "(1/2)/3", True), ("2.50", "2.5", True), ("-4。", "−4", True)]


@query(table("given, reference, verdict", *PAIRS))
def answer_pairs(spark, sf_dir):
    """Letters against values, brackets that settle them, fractions, units, signs."""
    d = spark.createDataFrame([(g, r) for g, r, _ in PAIRS], "given string, reference string")
    return d.withColumn("verdict", T.answers_match(F.col("given"), F.col("reference")))
