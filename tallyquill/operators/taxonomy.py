"""Vocabularies: wildcard matching without theta joins, prerequisite closure, audits.

skills: skill_id, strand, unit, name_en, name_zh, form, foundation, prerequisites, guide_ref;
errors: error_id, name_en, name_zh, skills, description; objectives: ref, status, ....
"""

from __future__ import annotations

from functools import reduce
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyquill.functions import fixed as X
from tallyquill.functions import names as N
from tallyquill.operators.cycles import components_on_cycles, cycle_paths, inner_edges
from tallyquill.sources.shared import cut

STAR_SALTS = 32  # tasks that the errors of every skill are paired in


def is_wildcard(entry: Column) -> Column:
    return entry.rlike(X.WILDCARD)


def errors_of_skills(skills: DataFrame, errors: DataFrame) -> DataFrame:
    """(skill_id, error_id, general) for every error whose entries cover the skill: exact ids, '<prefix>.*'
    and '*'. Three equal-key joins in place of one theta join; '*' pairs with all skills by its meaning."""
    entries = errors.select("error_id", F.explode("skills").alias("entry"), F.exists("skills", is_wildcard).alias("general"))
    ids = skills.select("skill_id").distinct()
    exact = entries.where("entry <> '*' and not endswith(entry, '.*')").join(ids, F.col("entry") == F.col("skill_id"))
    # every dotted prefix of a skill id, with the dot: what an entry may name before its star
    prefixes = ids.withColumn("parts", F.split("skill_id", r"\.")).where(F.size("parts") > 1).select("skill_id", F.explode(F.transform(F.sequence(F.lit(1), F.size("parts") - 1), lambda n: F.concat(F.array_join(F.slice("parts", F.lit(1), n), "."), F.lit(".")))).alias("prefix"))
    dotted = entries.where("endswith(entry, '.*')").withColumn("prefix", F.expr("left(entry, length(entry) - 1)")).join(prefixes, "prefix")
    every = entries.where("entry = '*'").select("error_id", "general", F.explode(F.sequence(F.lit(0), F.lit(STAR_SALTS - 1))).alias("k"))
    every = every.join(ids.withColumn("k", F.pmod(F.hash("skill_id"), F.lit(STAR_SALTS))), "k")
    out = reduce(DataFrame.unionByName, [df.select("skill_id", "error_id", "general") for df in (exact, dotted, every)])
    return out.distinct()


def closure(edges: DataFrame) -> DataFrame:
    """(start, reached, depth) over edges (node, next): everything reachable, at its least depth, a start
    itself only through a cycle. A frontier is joined with the edges until it brings nothing new."""
    edges = edges.select("node", "next").distinct()
    found = frontier = edges.select(F.col("node").alias("start"), F.col("next").alias("reached"), F.lit(1).alias("depth"))
    for depth in count(2):
        step = frontier.join(edges, F.col("reached") == F.col("node")).select("start", F.col("next").alias("reached")).distinct()
        frontier = cut(step.join(found, ["start", "reached"], "left_anti").withColumn("depth", F.lit(depth)))
        if frontier.isEmpty():
            break
        found = cut(found.unionByName(frontier))
    return found


def prerequisites(skills: DataFrame) -> DataFrame:
    """Closure of the prerequisites among known skills."""
    known = skills.select(F.col("skill_id").alias("next")).distinct()
    edges = skills.select(F.col("skill_id").alias("node"), F.explode("prerequisites").alias("next")).join(known, "next", "left_semi")
    return closure(edges)


def cycles(edges: DataFrame) -> DataFrame:
    """Nodes that reach themselves, with the length of their shortest cycle. Only edges within a strongly
    connected component are followed: the rest of the graph lies on no cycle."""
    inside = cut(inner_edges(edges, components_on_cycles(edges)))
    return closure(inside).where("start = reached").select(F.col("start").alias("node"), F.col("depth").alias("length"))


def fitting_errors(skills: DataFrame, errors: DataFrame) -> DataFrame:
    """(skill_id, error_id): errors that a skill, or something it rests on, can expose."""
    own = errors_of_skills(skills, errors).select("skill_id", "error_id")
    rests = prerequisites(skills).join(own, F.col("reached") == F.col("skill_id")).select(F.col("start").alias("skill_id"), "error_id")
    return own.unionByName(rests).distinct()


def uncovered_objectives(objectives: DataFrame, skills: DataFrame) -> DataFrame:
    covered = skills.select(F.explode("guide_ref").alias("ref"))
    return objectives.where("status <> 'enrichment'").join(covered, "ref", "left_anti")


def unique_suffix(wrong: DataFrame, skills: DataFrame) -> DataFrame:
    """(wrong, skill_id): the one known skill with the same unit and slug as an unknown three-part id."""
    tail = F.expr("substring_index({}, '.', -2)".format("wrong"))
    asked = wrong.select("wrong").distinct().where(F.size(F.split("wrong", r"\.")) == 3).join(skills.select(F.col("skill_id").alias("wrong")), "wrong", "left_anti").withColumn("tail", tail)
    known = skills.select("skill_id", F.expr("substring_index(skill_id, '.', -2)").alias("tail")).distinct().where("tail <> skill_id")
    hits = asked.join(known, "tail").groupBy("wrong").agg(F.count(F.lit(1)).alias("n"), F.min("skill_id").alias("skill_id"))
    return hits.where("n = 1").select("wrong", "skill_id")


def repair_skill_ids(analyses: DataFrame, skills: DataFrame, column: str = "atomic_skills") -> DataFrame:
    """Wrong ids replaced by their unique match, repeats dropped, the first kept. Each distinct list is mended once,
    its ids joined with the fixes by key, and joined back to the rows that hold it."""
    lists = analyses.select(F.col(column).alias("__list")).distinct()
    each = lists.select("__list", F.posexplode("__list").alias("__at", "wrong"))
    fixed = each.join(unique_suffix(each.select("wrong"), skills), "wrong", "left")
    fixed = fixed.groupBy("__list").agg(F.array_sort(F.collect_list(F.struct("__at", F.coalesce("skill_id", "wrong").alias("id")))).alias("__new"))
    out = analyses.join(fixed, F.col(column) == F.col("__list"), "left")
    return out.withColumn(column, F.when(F.col("__new").isNull(), F.col(column)).otherwise(F.array_distinct(F.transform("__new", lambda x: x["id"])))).drop("__list", "__new")


def skills_for_module(skills: DataFrame, module: str | None) -> DataFrame:
    wanted = [*X.COMPULSORY_STRANDS, *(s for s, m in X.MODULE_STRANDS.items() if m == module)]
    return skills.where(F.col("strand").isin(wanted))


def expected_flag(kinds: Column, refs: Column) -> Column:
    """F if any objective is Foundation (or only primary-school knowledge is named), else N, else E."""
    return F.when(F.array_contains(kinds, "foundation") | ((F.size(kinds) == 0) & F.array_contains(refs, "KS2")), "F").when(F.array_contains(kinds, "non-foundation"), "N").when(F.array_contains(kinds, "enrichment"), "E")


def audit(skills: DataFrame, errors: DataFrame, objectives: DataFrame | None = None) -> DataFrame:
    """(problem): every way the vocabularies can be wrong, each once, sorted."""

    def when(rows: DataFrame, condition: Column, text: str, *args: Column) -> DataFrame:
        return rows.where(condition).select(F.format_string(text, *args).alias("problem"))

    sid, strand = F.col("skill_id"), F.col("strand")
    refs = skills.select("skill_id", F.explode("guide_ref").alias("ref")).where("ref not in ('ext', 'KS2')")
    in_guide = F.exists("guide_ref", lambda r: r.rlike(X.GUIDE_REF))
    compulsory = strand.isin(*X.COMPULSORY_STRANDS)
    need = skills.select("skill_id", F.explode("prerequisites").alias("pre"))
    known = skills.select(F.col("skill_id").alias("pre")).distinct()
    uses = errors.select("error_id", F.explode("skills").alias("entry")).where(~is_wildcard(F.col("entry")))
    eid = F.col("error_id")
    out = [
        when(skills.groupBy("skill_id").count(), F.col("count") > 1, "skill %s appears more than once", sid),
        when(skills, ~sid.rlike(X.SKILL_ID), "skill id '%s' is not <strand>.<unit>.<slug>", sid),
        when(skills, sid.rlike(X.SKILL_ID) & (F.substring_index(sid, ".", 1) != strand), "skill %s says strand '%s' but its id says otherwise", sid, strand),
        when(skills, ~strand.isin(*X.STRANDS), "skill %s has unknown strand '%s'", sid, strand),
        when(skills, ~F.col("form").isin(*X.FORMS), "skill %s has form '%s', not F1-F6", sid, F.col("form")),
        when(skills, F.col("foundation") == "?", "skill %s has a foundation flag that is not F, N or blank", sid),
        when(skills, compulsory & F.col("foundation").isNull() & in_guide, "skill %s is in the Guide but has no foundation flag", sid),
        when(skills, ~compulsory & F.col("foundation").isNotNull(), "skill %s has a foundation flag where the split does not apply", sid),
        when(skills, compulsory & (F.size("guide_ref") == 0), "skill %s has no guide_ref", sid),
        when(skills, ~N.said(F.col("name_en")) | ~N.said(F.col("name_zh")), "skill %s is missing an English or Chinese name", sid),
        when(refs, ~F.col("ref").rlike(X.GUIDE_REF), "skill %s has guide_ref '%s', not <part>-<n.m>", sid, F.col("ref")),
        when(need.join(known, "pre", "left_anti"), F.lit(True), "skill %s needs %s, which does not exist", sid, F.col("pre")),
        when(need, F.col("pre") == sid, "skill %s lists itself as a prerequisite", sid),
        when(cycle_paths(need.join(known, "pre", "left_semi").select(F.col("skill_id").alias("node"), F.col("pre").alias("next"))), F.col("length") > 0, "prerequisite cycle: %s", F.col("path")),
        when(errors.groupBy("error_id").count(), F.col("count") > 1, "error %s appears more than once", eid),
        when(errors, ~eid.rlike(X.ERROR_ID), "error id '%s' is not err.<topic>.<slug>", eid),
        when(errors, F.size("skills") == 0, "error %s belongs to no skill", eid),
        when(uses.join(skills.select(F.col("skill_id").alias("entry")), "entry", "left_anti"), F.lit(True), "error %s refers to %s, which does not exist", eid, F.col("entry")),
        when(errors, ~N.said(F.col("name_en")) | ~N.said(F.col("name_zh")), "error %s is missing an English or Chinese name", eid),
    ]
    if objectives is not None:
        named = refs.where(F.col("ref").rlike(X.GUIDE_REF))
        out.append(when(named.join(objectives.select("ref"), "ref", "left_anti"), F.lit(True), "skill %s refers to Guide objective %s, which is not in the objectives", sid, F.col("ref")))
        kinds = refs.join(objectives.select("ref", "status"), "ref").groupBy("skill_id").agg(F.collect_set("status").alias("kinds"))
        flagged = skills.where(compulsory).join(kinds, "skill_id", "left").withColumn("want", expected_flag(F.coalesce("kinds", F.expr("cast(array() as array<string>)")), F.col("guide_ref")))
        flags = F.create_map(*(F.lit(x) for pair in X.FLAGS.items() for x in pair))
        out.append(when(flagged.where("want is not null"), ~flags[F.col("want")].eqNullSafe(F.col("foundation")), "skill %s is flagged %s but its Guide objectives say %s", sid, F.coalesce("foundation", F.lit("blank")), flags[F.col("want")]))
    return reduce(DataFrame.unionByName, out).distinct().orderBy("problem")


def skills_for_form(skills: DataFrame, form: str) -> DataFrame:
    return skills.where(F.col("form") == form)


def skills_in_unit(skills: DataFrame, strand: str, unit: str) -> DataFrame:
    return skills.where((F.col("strand") == strand) & (F.col("unit") == unit))


def in_guide(refs: Column) -> Column:
    """Whether any reference is one of the Guide's."""
    return F.exists(refs, lambda r: r.rlike(X.GUIDE_REF))


def counters(skills: DataFrame, errors: DataFrame, objectives: DataFrame) -> DataFrame:
    """(what, name, n): skills by strand, form and foundation flag, skills with an error pattern (wildcards
    counted as named), objectives, those assessed, those covered, and skills outside the Guide."""

    def by(c: str) -> DataFrame:
        return skills.where(F.col(c).isNotNull()).groupBy(F.lit(c).alias("what"), F.col(c).alias("name")).agg(F.count(F.lit(1)).alias("n"))

    def one(rows: DataFrame, what: str) -> DataFrame:
        return rows.agg(F.count(F.lit(1)).alias("n")).select(F.lit("total").alias("what"), F.lit(what).alias("name"), "n")

    assessed = objectives.where("status <> 'enrichment'")
    covered = errors.select(F.explode("skills").alias("s")).distinct()
    parts = [
        by("strand"), by("form"), by("foundation"), one(covered, "skills with an error pattern"), one(objectives, "objectives"), one(assessed, "objectives assessed"),
        one(assessed.join(skills.select(F.explode("guide_ref").alias("ref")), "ref", "left_semi"), "objectives covered"), one(skills.where(F.array_contains("guide_ref", "ext")), "skills outside the Guide"),
    ]
    return reduce(DataFrame.unionByName, parts)


def load_vocabularies(skills: DataFrame, errors: DataFrame, objectives: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """The vocabularies as they are, or an error that lists every problem the audit finds."""
    problems = [r.problem for r in audit(skills, errors, objectives).collect()]
    if problems:
        raise ValueError(f"{len(problems)} problem(s) in the vocabularies:\n" + "\n".join(problems))
    return skills, errors, objectives


def question_skills(analyses: DataFrame, skills: DataFrame) -> DataFrame:
    """(source_question_id, skills): the skills listed for a question, then what they rest on, each once."""
    listed = analyses.select("source_question_id", F.array_distinct(F.concat("atomic_skills", F.flatten(F.transform("strategies", lambda s: s["skills"])))).alias("listed"))
    each = listed.select("source_question_id", F.posexplode("listed").alias("at", "start"))
    rest = each.join(prerequisites(skills).select("start", "reached", "depth"), "start").groupBy("source_question_id").agg(F.array_sort(F.collect_list(F.struct("at", "depth", "reached"))).alias("r"))
    j = listed.join(rest, "source_question_id", "left")
    more = F.transform(F.coalesce("r", F.expr("cast(array() as array<struct<at:int,depth:int,reached:string>>)")), lambda x: x["reached"])
    return j.select("source_question_id", F.array_distinct(F.concat("listed", more)).alias("skills"))
