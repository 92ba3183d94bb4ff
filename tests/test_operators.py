"""Rules, repairs, joins, solving, vocabularies, sources and sinks on small fixtures."""

import json

import pytest
from pyspark.sql import functions as F

from tallyquill.functions.alignment import shown
from tallyquill.operators import compare, models, repairs, reports, rules, solving, stats, taxonomy
from tallyquill.sources import archive, store

BOX = dict(page=1, y_min=0, x_min=0, y_max=500, x_max=500)


def question(qid, text="Solve it.", **more):
    base = dict(source_question_id=qid, page_start=1, page_end=1, question_text=text, question_type="open", options=[], marks=1.0, group_marks=None, group_marks_scope=None, answer=None, worked_solution=None, diagram_required=False, diagram_region=None, table_regions=[], depends_on=[], extraction_notes=[])
    return base | more


def result(questions, sha="a" * 64, name="F4-p.pdf", pages=3, **more):
    return dict(source=dict(file_name=name, sha256=sha, page_count=pages, byte_size=1), run=dict(run_id="r1", extracted_at="t"), document=dict(file_name=name, page_count=pages, questions=questions, level="F4", level_source="filename") | more, issues=[], diagrams=[], tables=[], repairs=[])


@pytest.fixture
def load(spark, tmp_path):
    def f(*results):
        for i, r in enumerate(results):
            (tmp_path / f"{i}.json").write_text(r if isinstance(r, str) else json.dumps(r))
        return archive.read_archive(spark, str(tmp_path))

    return f


def codes(spark, load, *questions, **more):
    good, _ = load(result(list(questions), **more))
    docs = good.select(F.lit("d").alias("doc"), "document.*")
    return sorted((r.issue_code, r.severity, r.source_question_id) for r in rules.validate_extraction(docs).collect())


def test_archive_splits_bad_files(load):
    good, bad = load(result([question("1")]), "{not json", json.dumps({"other": 1}))
    assert good.count() == 1 and sorted(r.path.rsplit("/", 1)[1] for r in bad.collect()) == ["1.json", "2.json"]
    q = archive.questions_of(good).first()
    assert (q.doc, q.position, q.source_question_id) == ("a" * 12, 1, "1")


def test_clean_document_has_no_issues(spark, load):
    assert codes(spark, load, question("1"), question("2", "Find $x^{2}$.")) == []


def test_question_rules(spark, load):
    got = codes(
        spark, load,
        question(" ", "blank id"), question("1"), question("1"), question("2", "  "), question("3", page_start=0), question("4", page_start=3, page_end=2), question("5", page_end=9), question("6", marks=-1.0),
        question("7", diagram_required=True), question("8", r"so \alpha"), question("9", "a\x0crac"), question("10", "A. x\nB. y\nC. z"), question("11", question_type="multiple_choice"),
        question("12", "| a | b |\n| 1 | 2 |"), question("13", "| a | b |\n|---|---|\n| 1 |", table_regions=[BOX]), question("14", "一二三四五六七八。一二三四五六七八。"), question("15", "225x2"), question("16", marks=None),
        question("17", depends_on=["17"]), question("18", depends_on=["99"]), question("19", "Hence find y."), question("20(a)(i)"), question("21", depends_on=["20(a)"]),
        pages=3,
    )
    want = [
        ("CONTROL_CHARACTER", "high", "9"), ("DEPENDENCY_SELF", "medium", "17"), ("DEPENDENCY_UNKNOWN", "medium", "18"), ("DEPENDENCY_UNMARKED", "low", "19"), ("DIAGRAM_REGION_UNUSABLE", "medium", "7"), ("DUPLICATE_QUESTION_ID", "medium", "1"),
        ("EMPTY_QUESTION_TEXT", "critical", "2"), ("LATEX_NOT_DELIMITED", "medium", "8"), ("MALFORMED_TABLE", "medium", "12"), ("MARKS_INVALID", "medium", "6"), ("MARKS_MISSING", "low", "16"), ("MISSING_QUESTION_ID", "high", " "),
        ("OPTIONS_MISSING", "medium", "11"), ("OPTIONS_NOT_SEPARATED", "medium", "10"), ("PAGE_NUMBER_INVALID", "high", "3"), ("PAGE_OUT_OF_RANGE", "high", "5"), ("PAGE_RANGE_INVALID", "high", "4"), ("POSSIBLE_BROKEN_POWER", "medium", "15"),
        ("RAGGED_TABLE", "low", "13"), ("REPEATED_TEXT_IN_QUESTION", "medium", "14"), ("TABLE_NOT_CAPTURED", "low", "12"),
    ]
    assert got == sorted(want)


def test_document_rules(spark, load):
    scheme = dict(file_name="ms.pdf", sha256="b", page_count=1, matched=[], unmatched_scheme_ids=["9"], questions_without_answer=["1"])
    got = [c for c, _, _ in codes(spark, load, question("1", "a - b - c - d – e – f – g"), name="F4-M1.pdf", pages=8, level_text="中五", module_text="M2", marking_scheme=scheme)]
    assert got == ["ANSWER_NOT_IN_MARKING_SCHEME", "INCONSISTENT_MINUS_SIGN", "LEVEL_MISMATCH", "MARKING_SCHEME_UNMATCHED", "MARKING_SCHEME_UNUSED", "MODULE_MISMATCH", "SUSPICIOUSLY_FEW_QUESTIONS"]


def test_no_questions_blocks(spark, load):
    good, _ = load(result([], pages=0))
    issues = rules.validate_extraction(good.select(F.lit("d").alias("doc"), "document.*").withColumn("level", F.lit(None).cast("string")))
    assert sorted(r.issue_code for r in issues.collect()) == ["LEVEL_MISSING", "NO_QUESTIONS_FOUND", "PAGE_COUNT_INVALID"]
    assert rules.blocking(issues).first().blocking


STEM = "設某公司有若干員工。求該公司員工的平均年齡。"


def test_stem_repair_and_dependencies(spark, load):
    good, _ = load(result([question("3(a)", STEM + "求該公司員工的平均年齡。"), question("3(b)", STEM + "由此求標準差是多少呢。"), question("4", "x\x08ar"), question("5", r"\alpha = 1"), question("6(b)", "using (a)"), question("6(a)")]))
    q = archive.questions_of(good)
    fault = repairs.stem_contamination(q).first()
    assert (fault.parent, fault.owner, fault.removed, fault.question_ids) == ("3", "3(a)", "求該公司員工的平均年齡", ["3(a)", "3(b)"])
    got = {r.source_question_id: r for r in repairs.repaired(q).collect()}
    assert got["3(a)"].question_text == "設某公司有若干員工。求該公司員工的平均年齡。" and got["3(b)"].question_text == "設某公司有若干員工。由此求標準差是多少呢。"
    assert got["3(b)"].depends_on == ["3(a)"] and got["6(b)"].depends_on == ["6(a)"] and got["3(a)"].depends_on == []
    assert got["4"].question_text == "\\( x\\bar \\)" and got["5"].question_text == r"\( \alpha = 1 \)" and len(got["5"].extraction_notes) == 1
    assert repairs.repaired(repairs.repaired(q)).where("source_question_id = '5'").first().question_text == r"\( \alpha = 1 \)"


def test_text_moves():
    assert shown("abcdefghijklmnop", "abcdefgXhijklmnop", 3) == "…efg{+X+}hij…"
    assert shown("same", "same", 3) == "" and shown("old", "new", 2) == "[-old-]{+new+}"


def test_gold_scores(spark):
    cols = "question_key string, R int, P int, D int, I int, C int, E int, skills array<string>, errors array<string>"
    gold = spark.createDataFrame([("k1", 1, 1, 1, 1, 1, 1, ["a", "b"], []), ("k2", 0, 0, 0, 0, 0, 0, ["a"], [])], cols)
    got = spark.createDataFrame([("k1", 3, 1, 1, 1, 1, 0, ["b", "c"], [])], cols)
    dims, each, missing = compare.score_against_gold(got, gold)
    d = {r.dim: r for r in dims.collect()}
    assert (d["R"].bias, d["R"].within_one, d["E"].bias, d["P"].exact_rate) == (2, 0, -1, 1.0)
    e = each.first()
    assert (e.skill_overlap, e.error_overlap, e.total_diff) == (pytest.approx(1 / 3), 1.0, 3) and [r[0] for r in missing.collect()] == ["k2"]


def test_statuses(spark):
    a, b, c, d = "a" * 12, "b" * 12, "c" * 12, "d" * 12
    strategies = spark.createDataFrame([("1", a, "A"), ("1", b, "B"), ("1", c, "C"), ("1", d, "D"), ("2", a, "E")], "source_question_id string, strategy_id string, strategy_name string")
    solutions = spark.createDataFrame([("1", a, True, 1), ("1", b, False, 1), ("1", c, True, 1), ("1", d, False, 1)], "source_question_id string, strategy_id string, reached_answer boolean, ordinal int")
    issues = spark.createDataFrame([("1", "X", "high", f"1: [{c}] bad"), ("1", "SOLUTION_NEEDS_DIAGRAM", "medium", f"1: [{d}] diagram"), ("1", "ANSWER_MISMATCH", "high", "1: strategy 'A' reached '1' but the reference answer is '2'.")], "source_question_id string, issue_code string, severity string, message string")
    got = {(r.source_question_id, r.strategy_id[0]): r.status for r in solving.strategy_status(strategies, solutions, issues).collect()}
    assert got == {("1", "a"): "confirmed", ("1", "b"): "rejected", ("1", "c"): "proposed", ("1", "d"): "unverified", ("2", "a"): "proposed"}
    strict = {r.strategy_id[0]: r.status for r in solving.strategy_status(strategies.where("source_question_id = '1'"), solutions, issues, strict=True).collect()}
    assert strict["a"] == "proposed"


def test_critic(spark):
    analyses = spark.createDataFrame([("1",)], "source_question_id string")
    raw = spark.createDataFrame([("1", "s", " level_overrated ", "HIGH", "too high"), ("1", None, "made_up", "awful", "1: x"), ("9", None, "SKILL_MISSING", "low", "y")], "source_question_id string, strategy_id string, issue_code string, severity string, message string")
    got = solving.normalise_critic(raw, analyses)
    assert sorted(map(tuple, got.collect())) == [("1", "CRITIC_OTHER", "medium", "1: x"), ("1", "LEVEL_OVERRATED", "high", "1: [s] too high")]
    assert solving.drop_repeats(got, got.where("issue_code = 'CRITIC_OTHER'")).count() == 1


def level(n, evidence=("e",)):
    return dict(level=n, evidence=list(evidence) if n else [])


def test_analysis_rules(spark):
    dim = "struct<level:int,evidence:array<string>>"
    rp = "struct<" + ",".join(f"{d}:{dim}" for d in "RPDICE") + ">"
    ddl = f"source_question_id string, question_text string, atomic_skills array<string>, method_cues array<string>, strategies array<struct<strategy_name:string,steps:array<string>,skills:array<string>,rpdice:{rp},is_primary:boolean,strategy_id:string,source:string,status:string>>, possible_errors array<string>, difficulty_drivers array<string>, confidence double, empirical_difficulty double"
    profile = dict(R=level(2), P=level(1), D=level(1), I=level(1), C=level(1), E=level(2))

    def row(qid, text="Solve.", skills=("na.a.x", "na.a.y"), strategies=None, errors=(), drivers=("R", "E"), confidence=0.9, empirical=None, cues=()):
        plain = [dict(strategy_name="m", steps=["s"], skills=["na.a.x"], rpdice=profile, is_primary=True, strategy_id="i" * 12, source="analyzer", status="proposed")]
        return (qid, text, list(skills), list(cues), plain if strategies is None else strategies, list(errors), list(drivers), confidence, empirical)

    bad = dict(strategy_name="m", steps=[], skills=["m1.z.z"], rpdice=profile | {"R": level(4), "D": level(2), "P": dict(level=1, evidence=[]), "I": level(0)}, is_primary=False, strategy_id="i" * 12, source="me", status="proposed")
    rows = [row("ok"), row("none", strategies=[]), row("bad", "Hence solve.", strategies=[bad, bad], skills=["na.a.x", "zz.q.q"], errors=["err.a.b", "err.no.no"], drivers=[], confidence=2.0, empirical=0.5, cues=["not there"]), row("empty", skills=[])]
    skills = spark.createDataFrame([("na.a.x", "a", "na"), ("na.a.y", "a", "na"), ("m1.z.z", "z", "m1")], "skill_id string, unit string, strand string")
    errors = spark.createDataFrame([("err.a.b",)], "error_id string")
    fits = spark.createDataFrame([("na.a.y", "err.a.b")], "skill_id string, error_id string")
    got = {}
    for r in solving.validate_analyses(spark.createDataFrame(rows, ddl), skills, errors, fits, "M2").collect():
        got.setdefault(r.source_question_id, []).append(r.issue_code)
    assert "ok" not in got and got["none"] == ["NO_STRATEGY"] and got["empty"] == ["NO_SKILLS"]
    assert sorted(set(got["bad"])) == sorted(["PRIMARY_STRATEGY_COUNT", "DUPLICATE_STRATEGY", "STRATEGY_FIELDS_INVALID", "RPDICE_LEVEL_OUT_OF_RANGE", "RPDICE_EVIDENCE_MISSING", "STRATEGY_WITHOUT_STEPS", "SKILL_UNKNOWN", "SKILL_WRONG_MODULE", "ERROR_UNKNOWN", "ERROR_NOT_OF_SKILL", "METHOD_CUE_NOT_IN_TEXT", "DECISION_IGNORES_CUE", "DRIVERS_MISMATCH", "INTEGRATION_INCONSISTENT", "EMPIRICAL_NOT_NULL", "CONFIDENCE_OUT_OF_RANGE"])


def test_vocabulary_audit(spark):
    cols = "skill_id string, strand string, unit string, name_en string, name_zh string, form string, foundation string, prerequisites array<string>, guide_ref array<string>"
    skills = spark.createDataFrame([("na.a.x", "na", "a", "x", "x", "F1", "foundation", ["na.a.y"], ["CP-1.1"]), ("na.a.y", "na", "a", "y", "y", "F9", None, ["na.a.x", "na.q.q"], ["CP-1.2"]), ("ms.b.z", "na", "b", "z", "", "F1", "foundation", [], [])], cols)
    errors = spark.createDataFrame([("err.a.b", "e", "e", ["*"]), ("bad", "e", "", ["na.zz.z"])], "error_id string, name_en string, name_zh string, skills array<string>")
    objectives = spark.createDataFrame([("CP-1.1", "non-foundation"), ("CP-9.9", "foundation")], "ref string, status string")
    got = [r.problem for r in taxonomy.audit(skills, errors, objectives).collect()]
    for part in ("na.a.y has form 'F9'", "says strand 'na'", "needs na.q.q", "prerequisite cycle: na.a.x -> na.a.y -> na.a.x", "ms.b.z has no guide_ref", "ms.b.z is missing", "error id 'bad'", "refers to na.zz.z", "objective CP-1.2", "na.a.x is flagged foundation", "na.a.y is in the Guide"):
        assert any(part in g for g in got), part
    assert [r.ref for r in taxonomy.uncovered_objectives(objectives, skills).collect()] == ["CP-9.9"]
    fixed = taxonomy.repair_skill_ids(spark.createDataFrame([(["ms.a.x", "na.a.x", "q"],)], "atomic_skills array<string>"), skills)
    assert fixed.first().atomic_skills == ["na.a.x", "q"]
    assert sorted((r.start, r.reached, r.depth) for r in taxonomy.prerequisites(skills).collect()) == [("na.a.x", "na.a.x", 2), ("na.a.x", "na.a.y", 1), ("na.a.y", "na.a.x", 1), ("na.a.y", "na.a.y", 2)]


def test_csv_sources(spark, tmp_path):
    p = tmp_path / "s.csv"
    p.write_text('# comment\n\n  # more\nskill_id,strand,unit,name_en,name_zh,form,foundation,prerequisites,guide_ref\nna.a.x,na,a,"x, ""y""",z,F1,F, na.a.y ; ;na.b.c,CP-1.1\nna.a.y,na,a,y,,F1,Q,,\n')
    rows = {r.skill_id: r for r in archive.read_skills(spark, str(p)).collect()}
    assert rows["na.a.x"].name_en == 'x, "y"' and rows["na.a.x"].prerequisites == ["na.a.y", "na.b.c"] and rows["na.a.x"].foundation == "foundation"
    assert rows["na.a.y"].foundation == "?" and rows["na.a.y"].name_zh == "" and rows["na.a.y"].guide_ref == []


def test_store(spark, load, tmp_path):
    good, _ = load(result([question("1"), question(" ")]))
    store.write_archive(good, f"{tmp_path}/out")
    store.write_archive(good, f"{tmp_path}/out")
    latest, _ = archive.read_archive(spark, f"{tmp_path}/out/latest")
    rows = store.archive_rows(good).first()
    assert [q.question_key for q in rows.document.questions] == ["a" * 12 + ":1", None] and rows.latest == "F4-p-" + "a" * 12
    assert latest.count() == 1
    files = spark.createDataFrame([("i/a/x.pdf", "x.pdf", False), ("i/b/x.pdf", "x.pdf", False), ("i/c/x.pdf", "x.pdf", True)], "path string, name string, bad boolean")
    assert sorted(r.destination for r in store.route(files, F.col("bad")).collect()) == ["failed/x.pdf", "processed/x-2.pdf", "processed/x.pdf"]


def test_merge_and_current(spark):
    stored = spark.createDataFrame([("s1", "F4", "M1", "2024")], "sha256 string, level string, module string, year string")
    new = spark.createDataFrame([("s1", None, "M2", None), ("s2", "F5", None, "2025")], "sha256 string, level string, module string, year string")
    assert sorted(map(tuple, stats.merge_documents(stored, new).collect())) == [("s1", "F4", "M2", None), ("s2", "F5", None, "2025")]
    runs = spark.createDataFrame([("d", 1, False), ("d", 2, False), ("d", 3, True), ("e", 4, True)], "doc string, ingest_seq int, blocking boolean")
    assert [r.ingest_seq for r in stats.with_current(runs, ["doc"]).where("is_current").collect()] == [2]


def test_models(spark):
    calls = []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise models.ModelError("busy", 503)
        return "{}"

    assert models.with_retry(flaky, lambda s: None) == "{}" and len(calls) == 3
    with pytest.raises(models.ModelError):
        models.with_retry(lambda: " ", lambda s: None)
    answers = spark.createDataFrame([(1, '{"level": 2}', None), (2, '{"level": ', None), (3, None, "no recorded answer")], "id int, answer string, error string")
    got = {r.id: (r.payload and r.payload.level, r.error) for r in models.parsed(answers, "level int").collect()}
    assert got == {1: (2, None), 2: (None, "response is not JSON"), 3: (None, "no recorded answer")}


def test_reports(spark):
    df = spark.createDataFrame([("b", "a.pdf", "ok", 3), ("b", "x|y\n.pdf", "failed", None), ("c", "d.pdf", "ok", 1)], "batch string, file string, status string, questions int")
    got = {r.batch: r.report for r in reports.batch_reports(df).collect()}
    assert got["b"] == "# Batch\n| Status | Files | Questions |\n| --- | --- | --- |\n| failed | 1 |  |\n| ok | 1 | 3 |\n\n## Files\n| File | Status | Questions |\n| --- | --- | --- |\n| a.pdf | ok | 3 |\n| x y .pdf | failed |  |"
    assert set(got) == {"b", "c"}
    seconds = spark.createDataFrame([(38.0,), (1872.0,)], "s double")
    assert [r[0] for r in seconds.select(reports.duration(F.col("s"))).collect()] == ["38s", "31m12s"]


def test_verdicts(spark):
    ddl = "student_id string, source_question_id string, option_chosen string, final_answer string, reference string, options array<string>, strategy_id_matched string, strategy_description string, transcription array<string>, unclear array<string>, confidence double, listed array<struct<strategy_id:string,skills:array<string>>>, atomic_skills array<string>, main_skills array<string>, skills_evidenced array<string>, known_skills array<string>, errors array<struct<error_id:string,description:string,kind:string>>, known_errors array<string>"
    listed = [("s1", ["a", "b"])]
    rows = [
        ("x", "1", "B", None, "20", ["10", "20"], "s1", None, ["t"], [], 0.9, listed, ["a"], ["a", "b"], ["a", "a", "zz"], ["a", "b"], [("err.k", "d", "slip")], ["err.k"]),
        ("y", "1", None, "21", "20", [], "zz", "own way", ["t"], ["line 2"], 0.5, listed, ["a"], None, [], ["a"], [("no", None, "misconception")], []),
        ("z", "1", None, None, None, [], None, None, [], [], 0.9, listed, ["a"], None, [], ["a"], [], []),
    ]
    got = {r.student_id: r for r in solving.decide(spark.createDataFrame(rows, ddl)).collect()}
    assert got["x"].is_correct and got["x"].strategy_match == "listed" and got["x"].skills_not_evidenced == ["b"] and got["x"].error_ids == ["err.k"] and not got["x"].needs_human
    assert got["y"].is_correct is False and got["y"].strategy_match == "new" and len(got["y"].review_reasons) == 3 and got["y"].misconceptions == ["no"]
    assert got["z"].is_correct is None and got["z"].review_reasons == ["no reference answer to mark against"]
