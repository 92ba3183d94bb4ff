"""Joins of questions with answer keys, of runs with runs, and of analyses with hand-rated references."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyquill.functions import fixed as X
from tallyquill.functions import names as N
from tallyquill.functions.alignment import shown


def last_per(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The row of greatest order of each key: what a later entry under a key overwrites."""
    values = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*values), order).alias("__v")).select(*keys, "__v.*")


def pair_by_stem(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pairs, orphans) of rows (folder, name, ordinal): schemes go to the paper of their folder and stem,
    upper and lower case alike; the last of several schemes wins; schemes without a paper are orphans."""
    f = files.withColumn("scheme_of", F.lower(N.scheme_stem(F.col("name")))).withColumn("own", F.lower(N.stem(F.col("name"))))
    papers = f.where("scheme_of is null").groupBy("folder", "own").agg(F.max_by("name", "ordinal").alias("paper"))
    schemes = f.where("scheme_of is not null").select("folder", F.col("scheme_of").alias("own"), F.col("name").alias("scheme"), "ordinal")
    pairs = papers.join(schemes.groupBy("folder", "own").agg(F.max_by("scheme", "ordinal").alias("scheme")), ["folder", "own"])
    return pairs.select("folder", "paper", "scheme"), schemes.join(papers, ["folder", "own"], "left_anti").select("folder", "scheme")


def attach_answers(questions: DataFrame, scheme: DataFrame) -> DataFrame:
    """questions with the scheme's answer, worked_solution and marks merged in.

    Ids agree without white space and case. Of questions with one id only the last gets the answers; of
    scheme rows the later non-empty field wins. marks fill in only where neither mark is printed.
    answer_source says where the answer came from; conflict holds a replaced printed answer.
    questions: doc, position, source_question_id, answer, worked_solution, marks, group_marks;
    scheme: doc, ordinal, source_question_id, answer, worked_solution, marks.
    """
    key = N.normal_id(F.col("source_question_id"))

    def last_said(c: str) -> Column:
        return F.max_by(c, F.when(N.said(F.col(c)), F.col("ordinal"))).alias(f"s_{c}")

    # marks come from the first entry that has any: after that the question has marks
    s = scheme.withColumn("k", key).groupBy("doc", "k").agg(last_said("answer"), last_said("worked_solution"), F.min_by("marks", F.when(F.col("marks").isNotNull(), F.col("ordinal"))).alias("s_marks"), F.lit(True).alias("hit"))
    q = questions.withColumn("k", key)
    q = q.withColumn("is_last", F.col("position") == F.max("position").over(Window.partitionBy("doc", "k")))
    q = q.join(s, ["doc", "k"], "left")
    on = F.col("is_last") & F.coalesce("hit", F.lit(False))
    new = {c: F.when(on & N.said(F.col(f"s_{c}")), F.col(f"s_{c}")).otherwise(F.col(c)) for c in ("answer", "worked_solution")}
    new["marks"] = F.when(on & F.col("marks").isNull() & F.col("group_marks").isNull(), F.col("s_marks")).otherwise(F.col("marks"))
    new["conflict"] = F.when(on & N.said(F.col("answer")) & N.said(F.col("s_answer")) & (N.stripped(F.col("answer")) != N.stripped(F.col("s_answer"))), F.col("answer"))
    new["answer_source"] = F.when(on, "marking_scheme").when(N.said(F.col("answer")) | N.said(F.col("worked_solution")), "paper")
    return q.withColumns(new).drop("k", "is_last", "hit", "s_answer", "s_worked_solution", "s_marks")


def unmatched_scheme_rows(questions: DataFrame, scheme: DataFrame) -> DataFrame:
    key = N.normal_id(F.col("source_question_id")).alias("k")
    return scheme.withColumn("k", key).join(questions.select("doc", key), ["doc", "k"], "left_anti").drop("k")


def compare_runs(before: DataFrame, after: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """keys, status (added, removed, changed, identical), changed (fields, in order): a full outer join,
    fields compared with nulls equal to nulls."""
    a = before.select(*keys, F.struct(*fields).alias("old"))
    b = after.select(*keys, F.struct(*fields).alias("new"))
    both = a.join(b, keys, "full_outer")
    changed = F.array_compact(F.array(*(F.when(~F.col("old")[f].eqNullSafe(F.col("new")[f]), F.lit(f)) for f in fields)))
    status = F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "removed").when(F.size(changed) > 0, "changed").otherwise("identical")
    return both.select(*keys, status.alias("status"), F.when(status == "changed", changed).otherwise(F.expr("cast(array() as array<string>)")).alias("changed"))


def agreement(diff: DataFrame) -> DataFrame:
    """added, removed, changed, identical and the share of common rows that are identical (1 of none)."""
    n = [F.count_if(F.col("status") == s).alias(s) for s in ("added", "removed", "changed", "identical")]
    out = diff.agg(*n)
    compared = F.col("changed") + F.col("identical")
    return out.withColumn("agreement", F.when(compared == 0, 1.0).otherwise(F.col("identical") / compared))


def describe_text_changes(pairs: DataFrame, context: int = X.CONTEXT_CHARS) -> DataFrame:
    """pairs (id, before, after) plus detail: what moved, removals as [-old-], additions as {+new+}, with
    some characters around. A sequence alignment has no counterpart among SQL functions; it runs in Arrow batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            detail = [shown(a or "", b or "", context) for a, b in zip(rows.column("before").to_pylist(), rows.column("after").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in ("id", "before", "after")), pa.array(detail, pa.string())], names=["id", "before", "after", "detail"])

    return pairs.select("id", "before", "after").mapInArrow(run, f"id {dict(pairs.dtypes)['id']}, before string, after string, detail string")


def diff_sets(a: Column, b: Column) -> Column:
    """(added, removed) of two lists as sets, sorted."""
    return F.struct(F.array_sort(F.array_except(b, a)).alias("added"), F.array_sort(F.array_except(a, b)).alias("removed"))


def jaccard(a: Column, b: Column) -> Column:
    """Shared over all distinct elements; 1 of two empty lists."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / union)


def same_strategy(a: Column, b: Column) -> Column:
    """By id where both have one, else by name."""
    return F.when(N.said(a["strategy_id"]) & N.said(b["strategy_id"]), a["strategy_id"] == b["strategy_id"]).otherwise(F.lower(N.stripped(a["strategy_name"])) == F.lower(N.stripped(b["strategy_name"])))


def diff_analyses(before: DataFrame, after: DataFrame) -> DataFrame:
    """Per question of two analyses (source_question_id, levels struct R..E, skills, errors, primary struct):
    status, levels that moved as 'R 1->2', set differences and whether the primary strategy changed."""
    a, b = (df.select("source_question_id", F.struct("levels", "skills", "errors", "primary").alias(n)) for df, n in ((before, "x"), (after, "y")))
    j = a.join(b, "source_question_id", "full_outer")
    steps = F.array_compact(F.array(*(F.when(F.col("x")["levels"][d] != F.col("y")["levels"][d], F.concat(F.lit(f"{d} "), F.col("x")["levels"][d].cast("string"), F.lit("->"), F.col("y")["levels"][d].cast("string"))) for d in X.DIMENSIONS)))
    return j.select(
        "source_question_id",
        F.when(F.col("x").isNull(), "added").when(F.col("y").isNull(), "removed").otherwise("both").alias("status"),
        steps.alias("levels"),
        diff_sets(F.col("x")["skills"], F.col("y")["skills"]).alias("skills"),
        diff_sets(F.col("x")["errors"], F.col("y")["errors"]).alias("errors"),
        (~same_strategy(F.col("x")["primary"], F.col("y")["primary"])).alias("primary_changed"),
    )


def dimension_scores(rated: DataFrame) -> DataFrame:
    """Per dimension of rows (dim, got, want): n, exact, within_one, abs_diff, bias and their rates; a
    level that is missing counts as 0."""
    diff = F.coalesce("got", F.lit(0)) - F.col("want")
    n = F.count(F.lit(1))
    sums = {"exact": F.count_if(diff == 0), "within_one": F.count_if(F.abs(diff) <= 1), "abs_diff": F.sum(F.abs(diff)), "bias": F.sum(diff)}
    out = rated.groupBy("dim").agg(n.alias("n"), *(c.cast("long").alias(k) for k, c in sums.items()))
    return out.select("*", *((F.col(k) / F.col("n")).alias(r) for k, r in (("exact", "exact_rate"), ("within_one", "within_one_rate"), ("abs_diff", "mean_abs"), ("bias", "mean_bias"))))


def profile(levels: dict[str, Column]) -> Column:
    """Levels in R..E order as digits, a missing one as 0: '112010'."""
    return F.concat(*(F.coalesce(levels[d], F.lit(0)).cast("string") for d in X.DIMENSIONS))


def profile_summary(levels: Column) -> Column:
    """'R1 P2 D0 I1 C2 E2' of a struct R..E."""
    return F.concat_ws(" ", *(F.concat(F.lit(d), F.coalesce(levels[d], F.lit(0)).cast("string")) for d in X.DIMENSIONS))


def _rated_pairs(analyses: DataFrame, gold: DataFrame) -> DataFrame:
    got = analyses.select("question_key", *(F.col(d).alias(f"g_{d}") for d in X.DIMENSIONS), F.col("skills").alias("g_skills"), F.col("errors").alias("g_errors"), F.lit(True).alias("hit"))
    total = reduce(lambda a, b: a + b, [F.abs(F.coalesce(F.col(f"g_{d}"), F.lit(0)) - F.col(d)) for d in X.DIMENSIONS])
    return gold.join(got, "question_key", "left").withColumn("total_diff", total)


def largest_disagreements(analyses: DataFrame, gold: DataFrame, k: int = 10) -> DataFrame:
    """question_key, total_diff, got, want of the k questions rated most differently; ties by key."""
    j = _rated_pairs(analyses, gold).where("hit")
    got, want = profile({d: F.col(f"g_{d}") for d in X.DIMENSIONS}), profile({d: F.col(d) for d in X.DIMENSIONS})
    return j.select("question_key", "total_diff", got.alias("got"), want.alias("want")).orderBy(F.desc("total_diff"), "question_key").limit(k)


def score_against_gold(analyses: DataFrame, gold: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(dimension scores, overlaps per question with the total difference, missing keys).

    Both tables: question_key, R..E, skills, errors. The gold side decides which questions count."""
    j = _rated_pairs(analyses, gold)
    hit = j.where("hit")
    long = hit.select(F.explode(F.array(*(F.struct(F.lit(d).alias("dim"), F.col(f"g_{d}").alias("got"), F.col(d).alias("want")) for d in X.DIMENSIONS))).alias("r")).select("r.*")
    each = hit.select("question_key", jaccard(F.col("g_skills"), F.col("skills")).alias("skill_overlap"), jaccard(F.col("g_errors"), F.col("errors")).alias("error_overlap"), "total_diff")
    return dimension_scores(long), each, j.where("hit is null").select("question_key")


def letter_counts(diff: DataFrame) -> DataFrame:
    """(dim, n): in how many questions of diff_analyses each dimension's level moved."""
    moved_dims = diff.select(F.explode(F.transform("levels", lambda s: F.substring(s, 1, 1))).alias("dim"))
    dims = diff.sparkSession.createDataFrame([(d, k) for k, d in enumerate(X.DIMENSIONS)], "dim string, at int")
    return dims.join(moved_dims.groupBy("dim").agg(F.count(F.lit(1)).alias("n")), "dim", "left").orderBy("at").select("dim", F.coalesce("n", F.lit(0)).alias("n"))


def diff_summary(diff: DataFrame) -> DataFrame:
    """questions, changed, level, skill and primary changes of diff_analyses, as one row."""
    sets = F.size(F.col("skills")["added"]) + F.size(F.col("skills")["removed"]) > 0
    errs = F.size(F.col("errors")["added"]) + F.size(F.col("errors")["removed"]) > 0
    changed = (F.col("status") != "both") | (F.size("levels") > 0) | sets | errs | F.coalesce("primary_changed", F.lit(False))
    return diff.agg(F.count(F.lit(1)).alias("questions"), F.count_if(changed).alias("changed"), F.count_if(F.size("levels") > 0).alias("levels"), F.count_if(sets).alias("skills"), F.count_if("primary_changed").alias("primaries"))
