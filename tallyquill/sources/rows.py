"""Rows of the store's tables, built from archived results, analyses and graded attempts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyquill.functions import fixed as X
from tallyquill.functions import names as N
from tallyquill.operators.solving import drivers, primary
from tallyquill.sources.archive import ISSUE, read_json

PAPER_COLUMNS = ("year", "term", "exam_type", "paper_number", "school", "topics")
RPDICE = "struct<" + ",".join(f"{d}:struct<level:int,evidence:array<string>>" for d in X.DIMENSIONS) + ">"
STRATEGY = f"struct<strategy_name:string,steps:array<string>,skills:array<string>,rpdice:{RPDICE},is_primary:boolean,strategy_id:string,source:string,status:string>"
QUESTION_ANALYSIS = (
    f"struct<source_question_id:string,skill_family:string,atomic_skills:array<string>,method_cues:array<string>,strategies:array<{STRATEGY}>,possible_errors:array<string>,"
    "difficulty_drivers:array<string>,proposed_skills:array<string>,proposed_errors:array<string>,confidence:double,empirical_difficulty:double>"
)
SOLUTION = "struct<source_question_id:string,strategy_id:string,final_answer:string,reached_answer:boolean,notes:string>"
RUN = "struct<run_id:string,analyzer_version:string,prompt_sha256:string,model:string,input_tokens:bigint,output_tokens:bigint>"
ANALYSIS = f"sha256 string, file_name string, level string, module string, run {RUN}, critic {RUN}, analyses array<{QUESTION_ANALYSIS}>, issues array<{ISSUE}>, critic_issues array<{ISSUE}>, solutions array<{SOLUTION}>"
ATTEMPT = (
    "student_id string, question_key string, source_question_id string, paper_file_name string, scan_file_name string, scan_sha256 string, "
    "run struct<run_id:string,grader_version:string,model:string,graded_at:string>, "
    "reading struct<option_chosen:string,final_answer:string,transcription:array<string>,strategy_description:string,unclear:array<string>,confidence:double>, "
    "is_correct boolean, reference_answer string, reference_source string, strategy_id string, strategy_match string, skills_evidenced array<string>, skills_not_evidenced array<string>, "
    "error_ids array<string>, slips array<string>, misconceptions array<string>, needs_human boolean, review_reasons array<string>"
)


def read_analyses(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(good, bad) analyses of a folder, as read_archive."""
    return read_json(spark, path, ANALYSIS, F.col("sha256").isNotNull() & F.col("analyses").isNotNull())


def needed(c: Column, what: str) -> Column:
    return F.when(c.isNotNull(), c).otherwise(F.raise_error(F.lit(f"a result without {what} cannot be stored")))


def is_blocking(issues: Column) -> Column:
    return F.coalesce(F.exists(issues, lambda i: i["severity"] == "critical"), F.lit(False))


def document_rows(results: DataFrame) -> DataFrame:
    """One row a result: the source's facts, the paper's columns, level and module where they are known."""
    source, paper = F.col("source"), F.col("document.paper")
    known = [F.when(N.said(F.col(f"document.{c}")), F.col(f"document.{c}")).alias(c) for c in ("level", "module")]
    return results.select(needed(source["sha256"], "a source").alias("sha256"), *(source[c].alias(c) for c in ("file_name", "page_count", "byte_size")), *(paper[c].alias(c) for c in PAPER_COLUMNS), *known)


def run_rows(results: DataFrame) -> DataFrame:
    """One row a run, with counts and whether it blocks; a blocking run is never current."""
    run, scheme = F.col("run"), F.col("document.marking_scheme")
    block = is_blocking(F.col("issues"))
    return results.select(
        needed(run["run_id"], "a run").alias("run_id"),
        F.col("source.sha256").alias("sha256"),
        *(run[c].alias(c) for c in ("extracted_at", "extraction_version", "question_object_version", "model", "prompt_sha256", "input_tokens", "output_tokens")),
        F.size("document.questions").alias("question_count"),
        F.size("issues").alias("issue_count"),
        block.alias("blocking"),
        "issues",
        "repairs",
        scheme["file_name"].alias("marking_scheme_file_name"),
        scheme["sha256"].alias("marking_scheme_sha256"),
        (~block).alias("is_current"),
    )


def images_of(images: Column, qid: Column) -> Column:
    """The images of a question, without its id."""
    own = F.filter(images, lambda i: i["source_question_id"] == qid)
    return F.transform(own, lambda i: F.struct(*(i[c].alias(c) for c in ("kind", "index", "page", "image_path", "cropped", "width", "height"))))


def answer_source(matched: Column, qid: Column, answer: Column, worked: Column) -> Column:
    hit = F.coalesce(F.array_contains(matched, qid), F.lit(False))
    return F.when(hit, "marking_scheme").when(N.said(answer) | N.said(worked), "paper")


def question_rows(results: DataFrame) -> DataFrame:
    """One row a question of a run, position from 1, its images nested: diagrams, then tables."""
    sha, q = F.col("source.sha256"), F.col("q")
    rows = results.select("run", "source", "document", F.concat("diagrams", "tables").alias("images"), F.posexplode("document.questions").alias("at", "q"))
    plain = ("source_question_id", "depends_on", "question_type", "question_text", "options", "marks", "group_marks", "group_marks_scope", "answer", "worked_solution", "page_start", "page_end", "diagram_required", "diagram_region", "table_regions", "extraction_notes")
    return rows.select(
        F.col("run.run_id").alias("extraction_run_id"),
        sha.alias("sha256"),
        (F.col("at") + 1).alias("position"),
        N.question_key(sha, q["source_question_id"]).alias("question_key"),
        F.col("document.level").alias("level"),
        F.col("document.module").alias("module"),
        *(q[c].alias(c) for c in plain),
        answer_source(F.col("document.marking_scheme.matched"), q["source_question_id"], q["answer"], q["worked_solution"]).alias("answer_source"),
        images_of(F.col("images"), q["source_question_id"]).alias("images"),
    )


def analysis_rows(results: DataFrame) -> DataFrame:
    """One row an analysed question: its own issues, solutions and critic findings nested, levels and drivers
    of its primary strategy computed anew."""
    a = F.col("a")
    rows = results.withColumn("a", F.explode("analyses"))
    main = primary(a["strategies"])
    levels = F.when(main.isNotNull(), F.struct(*(main["rpdice"][d]["level"].alias(d) for d in X.DIMENSIONS)))

    def own(c: str) -> Column:
        return F.filter(c, lambda x: x["source_question_id"] == a["source_question_id"]).alias(c)

    return rows.select(
        N.question_key(F.col("sha256"), a["source_question_id"]).alias("question_key"),
        F.col("sha256").alias("source_sha256"),
        a["source_question_id"].alias("source_question_id"),
        F.col("run.run_id").alias("analysis_run_id"),
        *(F.col("run")[c].alias(c) for c in ("analyzer_version", "prompt_sha256", "model")),
        "level",
        "module",
        *(a[c].alias(c) for c in ("skill_family", "atomic_skills", "method_cues", "strategies")),
        levels.alias("rpdice"),
        F.coalesce(F.when(main.isNotNull(), drivers(levels)), F.expr("cast(array() as array<string>)")).alias("difficulty_drivers"),
        *(a[c].alias(c) for c in ("possible_errors", "proposed_skills", "proposed_errors", "confidence")),
        own("issues"),
        own("solutions"),
        own("critic_issues"),
        F.col("critic.run_id").alias("critic_run_id"),
    )


def attempt_rows(attempts: DataFrame) -> DataFrame:
    """One row a graded attempt; the answer given is the option chosen, else the final answer."""
    reading, run = F.col("reading"), F.col("run")
    return attempts.select(
        *("student_id", "question_key", "source_question_id", "paper_file_name", "scan_file_name", "scan_sha256"),
        run["run_id"].alias("grader_run_id"),
        run["grader_version"].alias("grader_version"),
        run["model"].alias("model"),
        F.when(N.said(reading["option_chosen"]), reading["option_chosen"]).otherwise(reading["final_answer"]).alias("answer_given"),
        *("is_correct", "reference_answer", "reference_source", "strategy_id", "strategy_match", "skills_evidenced", "skills_not_evidenced", "error_ids", "slips", "misconceptions"),
        reading["transcription"].alias("transcription"),
        reading["confidence"].alias("confidence"),
        "needs_human",
        "review_reasons",
        run["graded_at"].alias("attempted_at"),
    )


def filled_in(results: DataFrame) -> DataFrame:
    """Results of older versions with level, module and paper read from the file name where they lack them."""
    d = F.col("document")
    level, module, meta = N.resolve_level(d["file_name"], d["level_text"]), N.resolve_module(d["file_name"], d["module_text"], F.lit(None).cast("string")), N.meta_of_name(d["file_name"])
    no_level, no_module = ~N.said(d["level"]), ~N.said(d["module"])
    told = reduce(lambda a, b: a | b, [meta[c].isNotNull() for c in ("year", "term", "exam_type", "paper_number")])
    paper = F.struct(*(meta[c].alias(c) for c in ("year", "term", "exam_type", "paper_number")), F.lit(None).cast("string").alias("school"), F.expr("cast(array() as array<string>)").alias("topics"), F.lit("filename").alias("source"))
    new = {
        "level": F.when(no_level, level["level"]).otherwise(d["level"]),
        "level_source": F.when(no_level & level["level"].isNotNull(), level["source"]).otherwise(d["level_source"]),
        "module": F.when(no_module, module["module"]).otherwise(d["module"]),
        "module_source": F.when(no_module, module["source"]).otherwise(d["module_source"]),
        "paper": F.when(d["paper"].isNotNull(), d["paper"]).when(told, paper),
    }
    return results.withColumn("document", reduce(lambda c, kv: c.withField(*kv), new.items(), d))


def new_run(run: Column, run_id: Column, at: Column) -> Column:
    """A run like another under a new id and time, both given, so that a retried task writes the same."""
    return run.withField("run_id", run_id).withField("extracted_at", at)
