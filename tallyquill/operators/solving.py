"""Checks of analyses, solutions and critic findings, and what follows for strategies and attempts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyquill.functions import fixed as X
from tallyquill.functions import names as N
from tallyquill.functions import texts as T
from tallyquill.operators.rules import issue, say


def primary(strategies: Column) -> Column:
    """The first strategy marked primary, else the first."""
    return F.coalesce(F.get(F.filter(strategies, lambda s: s["is_primary"]), F.lit(0)), F.get(strategies, F.lit(0)))


def drivers(levels: Column) -> Column:
    """Dimensions at the driver level or above, in R..E order; levels is a struct R..E."""
    return F.array_compact(F.array(*(F.when(levels[d] >= X.DRIVER_FROM, F.lit(d)) for d in X.DIMENSIONS)))


def with_strategy_ids(analyses: DataFrame) -> DataFrame:
    return analyses.withColumn("strategies", F.transform("strategies", lambda s: s.withField("strategy_id", N.strategy_id(s["strategy_name"], s["skills"]))))


def check_payload(questions: DataFrame, analyses: DataFrame) -> DataFrame:
    """Questions not analysed, analyses of unknown questions, questions analysed more than once."""
    qid = "source_question_id"
    lost = questions.select(qid).distinct().join(analyses, qid, "left_anti").select(qid, F.lit("QUESTION_NOT_ANALYSED").alias("issue_code"), F.lit("high").alias("severity"))
    strange = analyses.select(qid).join(questions, qid, "left_anti").select(qid, F.lit("ANALYSIS_FOR_UNKNOWN_QUESTION").alias("issue_code"), F.lit("high").alias("severity"))
    again = analyses.join(questions.select(qid).distinct(), qid).groupBy(qid).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(qid, F.lit("DUPLICATE_ANALYSIS").alias("issue_code"), F.lit("medium").alias("severity"))
    return lost.unionByName(strange).unionByName(again)


def with_vocabulary(a: DataFrame, skills: DataFrame, errors: DataFrame, fits: DataFrame) -> DataFrame:
    """a (all_skills, possible_errors) with what the vocabularies say of each row's own ids: known (skill to unit
    and strand), error_ids and fits ('skill|error'). Ids are looked up by key, once for each distinct list."""

    def told(columns: list[str], found: DataFrame, value: Column, name: str) -> DataFrame:
        keys = [F.col(c).alias(f"__{c}") for c in columns]
        return found.groupBy(*keys).agg(value.alias(name))

    def back(rows: DataFrame, columns: list[str], found: DataFrame) -> DataFrame:
        return rows.join(found, reduce(lambda x, y: x & y, [F.col(c) == F.col(f"__{c}") for c in columns]), "left").drop(*(f"__{c}" for c in columns))

    one = skills.groupBy("skill_id").agg(F.max(F.struct("unit", "strand")).alias("about"))
    s, e = a.select("all_skills").distinct().withColumn("skill_id", F.explode("all_skills")), a.select("possible_errors").distinct().withColumn("error_id", F.explode("possible_errors"))
    both = a.select("all_skills", "possible_errors").distinct().withColumn("skill_id", F.explode("all_skills")).withColumn("error_id", F.explode("possible_errors"))  # of one question
    out = back(a, ["all_skills"], told(["all_skills"], s.join(one, "skill_id"), F.map_from_entries(F.collect_set(F.struct("skill_id", "about"))), "known"))
    out = back(out, ["possible_errors"], told(["possible_errors"], e.join(errors.select("error_id").distinct(), "error_id"), F.collect_set("error_id"), "error_ids"))
    out = back(out, ["all_skills", "possible_errors"], told(["all_skills", "possible_errors"], both.join(fits.select("skill_id", "error_id").distinct(), ["skill_id", "error_id"]), F.collect_set(F.concat_ws("|", "skill_id", "error_id")), "fits"))
    none = F.expr("cast(array() as array<string>)")
    return out.withColumns({"known": F.coalesce("known", F.expr("cast(map() as map<string,struct<unit:string,strand:string>>)")), "error_ids": F.coalesce("error_ids", none), "fits": F.coalesce("fits", none)})


def validate_analyses(analyses: DataFrame, skills: DataFrame, errors: DataFrame, fits: DataFrame, module: str | None = None) -> DataFrame:
    """Issues of analyses (one row a question, question_text included) against the vocabularies.

    fits holds (skill_id, error_id) for every error that a skill or something it rests on can expose.
    A question without strategies gets that issue alone.
    """
    wanted = [*X.COMPULSORY_STRANDS, *(s for s, m in X.MODULE_STRANDS.items() if m == module)]
    a = analyses.withColumn("main", primary(F.col("strategies"))).withColumn("all_skills", F.array_distinct(F.concat("atomic_skills", F.flatten(F.transform("strategies", lambda s: s["skills"])))))
    a = with_vocabulary(a, skills, errors, fits)
    qid = F.col("source_question_id")
    has = F.size("strategies") > 0
    listed = F.filter("atomic_skills", lambda s: F.map_contains_key("known", s))
    marked = F.size(F.filter("strategies", lambda s: s["is_primary"]))
    cues = T.method_cues(F.col("question_text"))
    levels = F.struct(*(F.col("main")["rpdice"][d]["level"].alias(d) for d in X.DIMENSIONS))
    units = F.array_distinct(F.transform(listed, lambda s: F.col("known")[s]["unit"]))
    one = [
        issue("NO_STRATEGY", "critical", ~has, say("%s: no solution strategy given.", qid), 1),
        issue("PRIMARY_STRATEGY_COUNT", "medium", has & (marked != 1), say("%s: %d strategies marked primary; exactly one is expected.", qid, marked), 2),
        issue("NO_SKILLS", "high", has & (F.size("atomic_skills") == 0), say("%s: no atomic_skills.", qid), 9),
        issue("DECISION_IGNORES_CUE", "medium", has & (F.size(cues) > 0) & (levels["D"] > X.MOST_D_WITH_CUE), say("%s: the question states the method but D = %d.", qid, levels["D"]), 14),
        issue("DRIVERS_MISMATCH", "low", has & (F.array_sort("difficulty_drivers") != F.array_sort(drivers(levels))), say("%s: difficulty_drivers are not the dimensions at driver level.", qid), 15),
        issue("INTEGRATION_INCONSISTENT", "low", has & (((levels["I"] == 0) & (F.size("atomic_skills") > 1)) | ((levels["I"] >= 2) & (F.size(units) < 2))), say("%s: I = %d does not fit the listed skills.", qid, levels["I"]), 16),
        issue("EMPIRICAL_NOT_NULL", "high", has & F.col("empirical_difficulty").isNotNull(), say("%s: empirical_difficulty must be null.", qid), 17),
        issue("CONFIDENCE_OUT_OF_RANGE", "medium", has & ~F.col("confidence").between(0, 1), say("%s: confidence is not in 0-1.", qid), 18),
    ]

    def several(items: Column, code: str, severity: str, ordinal: int) -> Column:
        return F.when(has, F.transform(items, lambda x: F.struct(F.lit(code).alias("issue_code"), F.lit(severity).alias("severity"), F.concat(qid, F.lit(": "), x.cast("string")).alias("message"), F.lit(ordinal).alias("ordinal"))))

    ids = F.filter(F.transform("strategies", lambda s: s["strategy_id"]), N.said)
    dims = F.flatten(F.transform("strategies", lambda s: F.array(*(F.struct(F.lit(d).alias("d"), s["rpdice"][d]["level"].alias("level"), F.size(s["rpdice"][d]["evidence"]).alias("n"), s["strategy_name"].alias("name")) for d in X.DIMENSIONS))))
    outside = F.filter(dims, lambda d: ~d["level"].between(0, X.MOST_LEVEL))
    bare = F.filter(dims, lambda d: d["level"].between(1, X.MOST_LEVEL) & (d["n"] == 0))

    def named(d: Column) -> Column:
        return F.concat(d["d"], F.lit(" = "), d["level"].cast("string"), F.lit(" in "), d["name"])

    proposals = F.array_distinct("possible_errors")
    many = [
        several(F.filter(F.array_distinct(ids), lambda i: F.size(F.filter(ids, lambda j: i == j)) > 1), "DUPLICATE_STRATEGY", "medium", 3),
        several(F.transform(F.filter("strategies", lambda s: ~s["source"].isin(*X.STRATEGY_SOURCES) | ~s["status"].isin(*X.STRATEGY_STATUSES)), lambda s: s["strategy_name"]), "STRATEGY_FIELDS_INVALID", "medium", 4),
        several(F.transform(outside, named), "RPDICE_LEVEL_OUT_OF_RANGE", "high", 5),
        several(F.transform(bare, named), "RPDICE_EVIDENCE_MISSING", "medium", 6),
        several(F.transform(F.filter("strategies", lambda s: F.size(s["steps"]) == 0), lambda s: s["strategy_name"]), "STRATEGY_WITHOUT_STEPS", "medium", 7),
        several(F.filter("all_skills", lambda s: ~F.map_contains_key("known", s)), "SKILL_UNKNOWN", "high", 8),
        several(F.filter("all_skills", lambda s: F.lit(module is not None) & F.coalesce(~F.try_element_at("known", s)["strand"].isin(*wanted), F.lit(False))), "SKILL_WRONG_MODULE", "high", 10),
        several(F.filter(proposals, lambda e: ~F.array_contains("error_ids", e)), "ERROR_UNKNOWN", "high", 11),
        several(F.filter(proposals, lambda e: F.array_contains("error_ids", e) & (F.size(listed) > 0) & ~F.exists(listed, lambda s: F.array_contains("fits", F.concat_ws("|", s, e)))), "ERROR_NOT_OF_SKILL", "low", 12),
        several(F.filter("method_cues", lambda c: (c != "") & ~F.coalesce(F.col("question_text"), F.lit("")).contains(c)), "METHOD_CUE_NOT_IN_TEXT", "medium", 13),
    ]
    found = reduce(lambda x, y: F.concat(x, y), [F.array_compact(F.array(*one)), *(F.coalesce(m, F.slice(F.array(*one[:1]), 1, 0)) for m in many)])
    return a.select("source_question_id", F.explode(found).alias("i")).select("source_question_id", "i.*")


def check_solutions(strategies: DataFrame, solutions: DataFrame, questions: DataFrame) -> DataFrame:
    """Every strategy solved, answers agreeing with the reference and each other.

    strategies: source_question_id, strategy_id, strategy_name; solutions: those two keys, ordinal,
    reached_answer, final_answer, notes; questions: source_question_id, answer, diagram_required, diagram_sent.
    """
    keys = ["source_question_id", "strategy_id"]
    last = solutions.groupBy(*keys).agg(F.max_by(F.struct("reached_answer", "final_answer", "notes"), "ordinal").alias("s"))
    j = strategies.join(last, keys, "left").join(questions, "source_question_id", "left")
    s, name, qid, sid = F.col("s"), F.col("strategy_name"), F.col("source_question_id"), F.col("strategy_id")
    failed = s.isNotNull() & ~s["reached_answer"]
    blind = F.coalesce(F.col("diagram_required") & ~F.col("diagram_sent"), F.lit(False))
    wrong = F.coalesce(T.answers_match(s["final_answer"], F.col("answer")) == F.lit(False), F.lit(False))
    issues = [
        issue("SOLUTION_MISSING", "medium", s.isNull(), say("%s: the Solver returned nothing for strategy '%s' (%s).", qid, name, sid), 1),
        issue("SOLUTION_NEEDS_DIAGRAM", "medium", failed & blind, say("%s: [%s] strategy '%s' needs the diagram, which was not available.", qid, sid, name), 2),
        issue("STRATEGY_DOES_NOT_SOLVE", "high", failed & ~blind, say("%s: [%s] strategy '%s' did not reach an answer: %s.", qid, sid, name, F.when(N.said(s["notes"]), s["notes"]).otherwise("no reason given")), 3),
        issue("ANSWER_MISMATCH", "high", s.isNotNull() & s["reached_answer"] & wrong, say("%s: strategy '%s' reached '%s' but the reference answer is '%s'.", qid, name, s["final_answer"], F.col("answer")), 4),
    ]
    own = j.select(qid, F.explode(F.array_compact(F.array(*issues))).alias("i")).select("source_question_id", "i.*")
    strange = last.join(strategies, keys, "left_anti").select(qid, F.lit("SOLUTION_FOR_UNKNOWN_STRATEGY").alias("issue_code"), F.lit("low").alias("severity"), say("%s: a solution for strategy id '%s', which is not in the analysis.", qid, sid).alias("message"), F.lit(5).alias("ordinal"))
    answers = solutions.where(F.col("reached_answer") & N.said(F.col("final_answer"))).groupBy("source_question_id").agg(F.array_sort(F.collect_set(T.normalise_answer(F.col("final_answer")))).alias("all"))
    differ = answers.where(F.size("all") > 1).select(qid, F.lit("STRATEGIES_DISAGREE").alias("issue_code"), F.lit("high").alias("severity"), say("%s: the strategies reach different answers: %s.", qid, F.array_join("all", ", ")).alias("message"), F.lit(6).alias("ordinal"))
    return own.unionByName(strange).unionByName(differ)


def normalise_critic(issues: DataFrame, analyses: DataFrame) -> DataFrame:
    """Critic findings as issues: known questions only, known codes, sane severities, ids in the message."""
    i = issues.join(analyses.select("source_question_id").distinct(), "source_question_id", "left_semi")
    code, severity = F.upper(N.stripped(F.col("issue_code"))), F.lower(N.stripped(F.col("severity")))
    message, sid, qid = N.stripped(F.col("message")), F.col("strategy_id"), F.col("source_question_id")
    message = F.when(N.said(sid) & ~message.startswith(sid), F.concat(F.lit("["), sid, F.lit("] "), message)).otherwise(message)
    message = F.when(~message.startswith(qid), F.concat(qid, F.lit(": "), message)).otherwise(message)
    return i.select(qid, F.when(code.isin(*X.CRITIC_CODES), code).otherwise("CRITIC_OTHER").alias("issue_code"), F.when(severity.isin(*X.CRITIC_SEVERITIES), severity).otherwise("medium").alias("severity"), message.alias("message"))


def drop_repeats(critic: DataFrame, code: DataFrame) -> DataFrame:
    """Critic findings whose code and question no check has raised already, whatever the strategy."""
    return critic.join(code.select("issue_code", "source_question_id").distinct(), ["issue_code", "source_question_id"], "left_anti")


def strategy_in(message: Column) -> Column:
    return N.matched(message, r"\[([0-9a-f]{12})\]", 1)


def strategy_status(strategies: DataFrame, solutions: DataFrame, issues: DataFrame, strict: bool = False) -> DataFrame:
    """strategies plus status: proposed (no solution, or a high issue quotes its id), rejected or unverified
    (no answer reached), else confirmed. With strict, a wrong answer holds a strategy back as well."""
    keys = ["source_question_id", "strategy_id"]
    solved = solutions.groupBy(*keys).agg(F.max_by("reached_answer", "ordinal").alias("reached"))
    # ids quoted in a message are read out of it, so that the join is on equal keys
    quoted = issues.withColumn("strategy_id", F.explode(F.array_distinct(F.regexp_extract_all("message", F.lit(r"(?=([0-9a-f]{12}))"), F.lit(1)))))
    high = quoted.where("severity = 'high'").select(*keys).distinct().withColumn("against", F.lit(True))
    blind = issues.where("issue_code = 'SOLUTION_NEEDS_DIAGRAM'").select("source_question_id", strategy_in(F.col("message")).alias("strategy_id")).distinct().withColumn("blind", F.lit(True))
    j = strategies.join(solved, keys, "left").join(high, keys, "left").join(blind, keys, "left")
    against = F.coalesce("against", F.lit(False))
    if strict:
        named = issues.where("issue_code = 'ANSWER_MISMATCH' and severity = 'high'").select("source_question_id", F.regexp_extract("message", "strategy '([^']*)'", 1).alias("strategy_name")).distinct().withColumn("wrong", F.lit(True))
        j = j.join(named, ["source_question_id", "strategy_name"], "left")
        against = against | F.coalesce("wrong", F.lit(False))
    status = F.when(F.col("reached").isNull(), "proposed").when(~F.col("reached"), F.when(F.col("blind"), "unverified").otherwise("rejected")).when(against, "proposed").otherwise("confirmed")
    return j.select(*strategies.columns, status.alias("status"))


def reference_answers(questions: DataFrame, strategies: DataFrame, solutions: DataFrame) -> DataFrame:
    """source_question_id, reference, reference_source: the marking scheme's answer, else the first one a
    confirmed strategy reached."""
    good = solutions.where(F.col("reached_answer") & N.said(F.col("final_answer"))).join(strategies.where("status = 'confirmed'").select("source_question_id", "strategy_id").distinct(), ["source_question_id", "strategy_id"], "left_semi")
    first = good.groupBy("source_question_id").agg(F.min_by("final_answer", "ordinal").alias("solved"))
    j = questions.join(first, "source_question_id", "left")
    own = N.said(F.col("answer"))
    return j.select("source_question_id", F.when(own, F.col("answer")).otherwise(F.col("solved")).alias("reference"), F.when(own, "marking_scheme").when(F.col("solved").isNotNull(), "solver").alias("reference_source"))


def decide(readings: DataFrame) -> DataFrame:
    """Verdicts on read pages. readings: student_id, source_question_id, option_chosen, final_answer,
    reference, options, strategy_id_matched, strategy_description, transcription, unclear, confidence,
    listed (array of (strategy_id, skills)), atomic_skills, main_skills, skills_evidenced,
    known_skills, errors (array of (error_id, description, kind)), known_errors."""
    opt, fin, ref = F.col("option_chosen"), F.col("final_answer"), F.col("reference")
    given = F.when(N.said(opt), opt).otherwise(fin)
    letter = F.instr(F.lit("ABCDEFGH"), F.substring(F.upper(N.stripped(opt)), 1, 1))
    looked = F.when(N.said(opt) & (letter > 0) & (letter <= F.size("options")), F.get("options", letter - 1))
    correct = F.coalesce(T.answers_match(given, ref), F.when(N.said(ref), T.answers_match(looked, ref)), F.when(N.said(ref) & N.said(fin) & N.said(opt), T.answers_match(fin, ref)))
    hit = F.get(F.filter("listed", lambda s: N.said(s["strategy_id"]) & (s["strategy_id"] == F.col("strategy_id_matched"))), F.lit(0))
    r = readings.withColumns({"is_correct": correct, "hit": hit})
    match = F.when(F.col("hit").isNotNull(), "listed").when((F.size("transcription") > 0) & N.said(F.col("strategy_description")), "new").otherwise("none")
    evidenced = F.filter(F.array_distinct("skills_evidenced"), lambda s: F.array_contains("known_skills", s))
    expected = F.coalesce(F.col("hit")["skills"], F.when(F.col("main_skills").isNotNull(), F.col("main_skills")), F.col("atomic_skills"))
    known = F.filter("errors", lambda e: N.said(e["error_id"]) & F.array_contains("known_errors", e["error_id"]))
    kinds = F.transform("errors", lambda e: F.struct((e["kind"] == "misconception").alias("deep"), F.coalesce(F.when(N.said(e["description"]), e["description"]), e["error_id"], F.lit("")).alias("text")))
    r = r.withColumns({"strategy_match": match, "evidenced": evidenced, "error_ids": F.array_distinct(F.transform(known, lambda e: e["error_id"])), "misconceptions": F.transform(F.filter(kinds, lambda k: k["deep"]), lambda k: k["text"]), "slips": F.transform(F.filter(kinds, lambda k: ~k["deep"]), lambda k: k["text"])})
    reasons = F.array_compact(F.array(
        F.when(F.size("unclear") > 0, F.concat(F.lit("unreadable: "), F.array_join("unclear", "; "))),
        F.when(F.col("confidence") < X.LOW_CONFIDENCE, F.format_string("low confidence %.2f", "confidence")),
        F.when(F.col("strategy_match") == "new", F.lit("the working follows no listed strategy")),
        F.when(F.col("is_correct").isNull(), F.lit("no reference answer to mark against")),
        F.when(F.col("is_correct") & (F.size("misconceptions") > 0), F.lit("correct answer but a misconception was reported")),
    ))
    return r.select("student_id", "source_question_id", given.alias("answer_given"), "is_correct", "reference", F.col("hit")["strategy_id"].alias("strategy_id"), "strategy_match", F.col("evidenced").alias("skills_evidenced"), F.filter(expected, lambda s: ~F.array_contains("evidenced", s)).alias("skills_not_evidenced"), "error_ids", "slips", "misconceptions", reasons.alias("review_reasons"), (F.size(reasons) > 0).alias("needs_human"))


def batches(rows: DataFrame, group: list[str], order: str, size: int = X.SOLVER_BATCH) -> DataFrame:
    """rows with the number of the model call that they go to, ``size`` to a call, in order."""
    from pyspark.sql import Window

    return rows.withColumn("batch", F.floor((F.row_number().over(Window.partitionBy(*group).orderBy(order)) - 1) / size).cast("int"))


def repair_drivers(analyses: DataFrame) -> DataFrame:
    """difficulty_drivers computed from the primary strategy's levels where they differ as sets of letters."""
    main = primary(F.col("strategies"))
    want = drivers(F.struct(*(main["rpdice"][d]["level"].alias(d) for d in X.DIMENSIONS)))
    wrong = main.isNotNull() & (F.array_sort("difficulty_drivers") != F.array_sort(want))
    return analyses.withColumn("difficulty_drivers", F.when(wrong, want).otherwise(F.col("difficulty_drivers")))


def fresh_strategies(analyses: DataFrame) -> DataFrame:
    """Strategies with their computed ids, all of them the analyzer's and proposed, whatever the model said."""
    marked = with_strategy_ids(analyses)
    return marked.withColumn("strategies", F.transform("strategies", lambda s: s.withField("source", F.lit("analyzer")).withField("status", F.lit("proposed"))))


def analysed(payload: DataFrame, skills: DataFrame) -> DataFrame:
    """A model's analyses as they are kept: skill ids repaired, strategies identified, drivers recomputed."""
    from tallyquill.operators.taxonomy import repair_skill_ids

    return repair_drivers(fresh_strategies(repair_skill_ids(payload, skills)))


def to_critique(analyses: DataFrame, critiqued: DataFrame, again: bool = False) -> DataFrame:
    """Analyses that no critic has read yet, or all of them."""
    return analyses if again else analyses.join(critiqued.select("source_question_id").distinct(), "source_question_id", "left_anti")


def paired_files(analyses: DataFrame, extractions: DataFrame) -> DataFrame:
    """Analyses with the extraction of the same paper. Both: sha256, path."""
    key = N.paper_key(F.col("sha256")).alias("paper")
    return analyses.select(key, F.col("path").alias("analysis")).join(extractions.select(key, F.col("path").alias("extraction")), "paper")
