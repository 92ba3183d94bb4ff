"""Small literal papers, vocabularies, analyses and attempts for queries that the driver's tables cannot feed."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyquill.sources.archive import ARCHIVE
from tallyquill.sources.rows import ANALYSIS, ATTEMPT

BOX = dict(page=1, y_min=0, x_min=0, y_max=500, x_max=500)
SMALL_BOX = dict(page=2, y_min=0, x_min=0, y_max=10, x_max=500)
STEM = "設某公司有若干員工。求該公司員工的平均年齡。"


def question(qid: str, text: str = "Solve it.", **more) -> dict:
    return dict(source_question_id=qid, page_start=1, page_end=1, question_text=text, question_type="open", options=[], marks=1.0, group_marks=None, group_marks_scope=None, answer=None, worked_solution=None, diagram_required=False, diagram_region=None, table_regions=[], depends_on=[], extraction_notes=[]) | more


def result(letter: str, questions: list[dict], name: str, pages: int = 3, level: str | None = "F4", run: str = "run-1", at: str = "2026-01-01", **more) -> dict:
    sha = letter * 64
    document = dict(file_name=name, page_count=pages, questions=questions, level=level, level_source="filename", module=None) | more
    return dict(source=dict(file_name=name, sha256=sha, page_count=pages, byte_size=100), run=dict(run_id=f"{run}-{letter}", extracted_at=at, model="m", extraction_version="1", question_object_version="2", prompt_sha256="abc", input_tokens=10, output_tokens=None), document=document, issues=[], diagrams=[], tables=[], repairs=[])


#: One fault a question, named by the rule it breaks.
FAULTY = [
    question(" ", "blank id"), question("1"), question("1"), question("2", "  "), question("3", page_start=0), question("4", page_start=3, page_end=2), question("5", page_end=9), question("6", marks=-1.0),
    question("7", diagram_required=True), question("8", r"so \alpha"), question("9", "a\x0crac"), question("10", "A. x\nB. y\nC. z"), question("11", question_type="multiple_choice"),
    question("12", "| a | b |\n| 1 | 2 |"), question("13", "| a | b |\n|---|---|\n| 1 |", table_regions=[BOX]), question("14", "一二三四五六七八。一二三四五六七八。"), question("15", "225x2"), question("16", marks=None),
    question("17", depends_on=["17"]), question("18", depends_on=["99"]), question("19", "Hence find y."), question("20(a)(i)"), question("21", depends_on=["20(a)"]),
]
BROKEN = [
    question("3(a)", STEM + "求該公司員工的平均年齡。"), question("3(b)", STEM + "由此求標準差是多少呢。"), question("4", "x\x08ar"), question("5", r"\alpha = 1"), question("6(b)", "using (a)"), question("6(a)"),
]
SCHEME = dict(file_name="ms.pdf", sha256="e" * 64, page_count=1, matched=["1"], unmatched_scheme_ids=["9"], questions_without_answer=["2"])
PAPERS = [
    result("a", FAULTY, "F4-faults.pdf"),
    result("b", BROKEN, "S5-2526_2nd-exam.pdf", level="F5"),
    result("c", [question("1", "a - b - c - d – e – f – g"), question("2", answer="7", question_type="multiple_choice", options=["6", "7"])], "F4-M1.pdf", pages=8, level_text="中五", module_text="M2", module="M1", module_source="filename", marking_scheme=SCHEME),
    result("d", [], "empty.pdf", pages=0, level=None),
    result("f", [question("1", r"\(x\)", page_end=2), question("2(a)", diagram_required=True, diagram_region=BOX, marks=None, group_marks=4.0, group_marks_scope="2"), question("2(b)", "| a | b |\n|---|---|\n| 1 | 2 |", table_regions=[BOX, SMALL_BOX], answer="3", depends_on=["2(a)"])], "F6 clean (1).pdf", level="F6"),
]
PICTURES = [
    dict(source_question_id="2(a)", kind="diagram", index=0, page=1, image_path="d.png", cropped=True, width=5, height=6),
    dict(source_question_id="2(b)", kind="table", index=1, page=2, image_path="t2.png", cropped=False, width=5, height=6),
    dict(source_question_id="2(b)", kind="table", index=0, page=1, image_path="t1.png", cropped=True, width=5, height=6),
]


def _parsed(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    text = spark.createDataFrame([(k, json.dumps(r)) for k, r in enumerate(rows)], "k int, j string")
    return text.select("k", F.from_json("j", schema).alias("r")).select("k", "r.*")


def papers(spark: SparkSession, rows: list[dict] | None = None) -> DataFrame:
    rows = rows or [r | dict(diagrams=PICTURES[:1], tables=PICTURES[1:]) if r["source"]["sha256"][0] == "f" else r for r in PAPERS]
    return _parsed(spark, rows, ARCHIVE).drop("k")


SKILLS = [
    ("na.eq.solve", "na", "eq", "Solve", "解", "F1", "foundation", [], ["CP-1.1"]),
    ("na.eq.quad", "na", "eq", "Quadratic", "二次", "F4", "non-foundation", ["na.eq.solve"], ["CP-1.2"]),
    ("na.poly.factor", "na", "poly", "Factor", "因式", "F3", None, ["na.eq.solve"], ["KS2"]),
    ("ms.trig.sine", "ms", "trig", "Sine", "正弦", "F5", None, ["na.eq.quad", "na.poly.factor"], ["ext"]),
    ("m1.calc.limit", "m1", "calc", "Limit", "極限", "F5", None, ["na.eq.quad"], ["M1-1.1"]),
    ("m2.mat.det", "m2", "mat", "Determinant", "行列式", "F6", None, [], ["M2-1.1"]),
]
ERRORS = [
    ("err.sign.lost", "Sign lost", "漏號", ["na.eq.solve"], ""), ("err.trig.ratio", "Wrong ratio", "比", ["ms.trig.sine"], ""), ("err.any.copy", "Copying", "抄", ["*"], ""), ("err.m1.limits", "Limits", "限", ["m1.*"], ""),
]
OBJECTIVES = [("CP-1.1", "CP", "foundation"), ("CP-1.2", "CP", "non-foundation"), ("CP-1.3", "CP", "foundation"), ("CP-1.4", "CP", "enrichment"), ("M1-1.1", "M1", "non-foundation"), ("M2-1.1", "M2", "non-foundation")]


def skills(spark: SparkSession, rows=SKILLS) -> DataFrame:
    return spark.createDataFrame(rows, "skill_id string, strand string, unit string, name_en string, name_zh string, form string, foundation string, prerequisites array<string>, guide_ref array<string>")


def errors(spark: SparkSession, rows=ERRORS) -> DataFrame:
    return spark.createDataFrame(rows, "error_id string, name_en string, name_zh string, skills array<string>, description string")


def objectives(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(OBJECTIVES, "ref string, part string, status string")


def strategy(name: str, levels: str, used: list[str], primary: bool = False, **more) -> dict:
    """A strategy with six levels as digits in R..E order, each with evidence where it is above 0."""
    dims = {d: dict(level=int(n), evidence=["seen"] if int(n) else []) for d, n in zip("RPDICE", levels, strict=True)}
    return dict(strategy_name=name, steps=["s"], skills=used, rpdice=dims, is_primary=primary, strategy_id="", source="analyzer", status="proposed") | more


def analysis(qid: str, strategies: list[dict], atomic: list[str], **more) -> dict:
    return dict(source_question_id=qid, skill_family="x", atomic_skills=atomic, method_cues=[], strategies=strategies, possible_errors=[], difficulty_drivers=[], proposed_skills=[], proposed_errors=[], confidence=0.9, empirical_difficulty=None) | more


def issue(code: str, qid: str, severity: str = "high", message: str = "m") -> dict:
    return dict(issue_code=code, severity=severity, message=message, source_question_id=qid)


GOOD, OTHER = strategy("Factor", "110000", ["na.eq.solve"], True, strategy_id="a" * 12), strategy("Graph", "210102", ["na.eq.quad"], strategy_id="b" * 12)
RUN_1 = dict(
    sha256="a" * 64, file_name="F4-faults.pdf", level="F4", module="compulsory", run=dict(run_id="an-1", analyzer_version="1", prompt_sha256="p", model="m", input_tokens=5, output_tokens=None), critic=dict(run_id="cr-1"),
    analyses=[analysis("1", [OTHER, GOOD], ["na.eq.solve", "na.eq.quad"], possible_errors=["err.sign.lost"]), analysis("2", [OTHER], ["na.eq.quad"]), analysis("3", [], [])],
    issues=[issue("NO_STRATEGY", "3", "critical")], critic_issues=[issue("LEVEL_OVERRATED", "1", "low"), issue("SKILL_MISSING", "2")], solutions=[dict(source_question_id="1", strategy_id="a" * 12, final_answer="4", reached_answer=True, notes="")],
)
RUN_2 = dict(
    RUN_1, run=dict(RUN_1["run"], run_id="an-2", input_tokens=7, output_tokens=3), critic=None, issues=[], critic_issues=[], solutions=[],
    analyses=[analysis("1", [dict(GOOD, rpdice=strategy("", "310000", [])["rpdice"])], ["na.eq.solve", "na.poly.factor"]), analysis("2", [dict(OTHER, strategy_id="c" * 12)], ["na.eq.quad"]), analysis("4", [GOOD], ["na.eq.solve"])],
)


def analyses(spark: SparkSession, *rows: dict) -> DataFrame:
    return _parsed(spark, list(rows) or [RUN_1, RUN_2], ANALYSIS).drop("k")


ATTEMPTS = [
    dict(student_id="s1", question_key="a" * 12 + ":1", source_question_id="1", paper_file_name="F4-faults.pdf", scan_file_name="x.png", scan_sha256="1", run=dict(run_id="g1", grader_version="1", model="m", graded_at="t1"), reading=dict(option_chosen="B", final_answer="7", transcription=["x"], strategy_description="", unclear=[], confidence=0.9), is_correct=True, reference_answer="B", reference_source="marking_scheme", strategy_id="a" * 12, strategy_match="listed", skills_evidenced=["na.eq.solve"], skills_not_evidenced=[], error_ids=[], slips=[], misconceptions=[], needs_human=False, review_reasons=[]),
    dict(student_id="s2", question_key="a" * 12 + ":2", source_question_id="2", paper_file_name="F4-faults.pdf", scan_file_name="y.png", scan_sha256="2", run=dict(run_id="g2", grader_version="1", model="m", graded_at="t2"), reading=dict(option_chosen="", final_answer="9", transcription=[], strategy_description="", unclear=["line 2"], confidence=0.4), is_correct=None, reference_answer=None, reference_source=None, strategy_id=None, strategy_match="none", skills_evidenced=[], skills_not_evidenced=["na.eq.quad"], error_ids=[], slips=["copied badly"], misconceptions=[], needs_human=True, review_reasons=["unreadable: line 2"]),
]


def attempts(spark: SparkSession) -> DataFrame:
    return _parsed(spark, ATTEMPTS, ATTEMPT).drop("k")
