"""Statistics over papers, features and issues, and windows over runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyquill.functions import names as N
from tallyquill.functions import texts as T


def question_features(q: str = "") -> Column:
    """Labels of what a question contains; they overlap on purpose. Columns as of a question row."""

    def c(name: str) -> Column:
        return F.col(f"{q}{name}")

    table = (F.size(c("table_regions")) > 0) | T.looks_like_a_table(T.pipe_blocks(c("question_text")))
    choice = F.coalesce(c("question_type") == "multiple_choice", F.lit(False))
    latex = c("question_text").contains("\\(") | c("question_text").contains("$$")
    marks = F.when(c("marks").isNotNull(), "own marks").when(c("group_marks").isNotNull(), "group marks").otherwise("no marks")
    labels = [
        F.when(table, "table"),
        F.when(choice, "multiple choice"),
        F.when(c("diagram_required"), "diagram"),
        F.when(N.parent_of(c("source_question_id")).isNotNull(), "sub-question"),
        F.when(c("page_end") > c("page_start"), "spans pages"),
        F.when(latex, "latex"),
        marks,
        F.when(N.said(c("answer")), "printed answer"),
        F.when(~(table | choice | c("diagram_required") | latex), "prose only"),
    ]
    return F.array_compact(F.array(*labels))


def feature_rates(labelled: DataFrame, features: str = "features", flagged: str = "flagged") -> DataFrame:
    """feature, questions, flagged, issue_rate of rows with an array of features and a flag; total order by
    rate, then questions, both falling, then name."""
    rows = labelled.select(F.explode(features).alias("feature"), F.col(flagged).cast("int").alias("f"))
    out = rows.groupBy("feature").agg(F.count(F.lit(1)).alias("questions"), F.sum("f").cast("long").alias("flagged"))
    return out.withColumn("issue_rate", F.col("flagged") / F.col("questions")).orderBy(F.desc("issue_rate"), F.desc("questions"), "feature")


def feature_report(questions: DataFrame, issues: DataFrame) -> DataFrame:
    """Issue rate of each feature, a question being flagged by issues of its own paper and id, with the most
    common code of each feature (ties: the code first in order)."""
    hits = issues.where("source_question_id is not null").groupBy("doc", "source_question_id").agg(F.collect_list("issue_code").alias("codes"))
    q = questions.withColumn("features", question_features()).join(hits, ["doc", "source_question_id"], "left").withColumn("flagged", F.col("codes").isNotNull())
    codes = q.where("flagged").select(F.explode("features").alias("feature"), "codes").select("feature", F.explode("codes").alias("code")).groupBy("feature", "code").count()
    top = codes.groupBy("feature").agg(F.min_by("code", F.struct(-F.col("count"), F.col("code"))).alias("commonest_code"))
    return feature_rates(q).join(top, "feature", "left").orderBy(F.desc("issue_rate"), F.desc("questions"), "feature")


def per_page(questions: Column, pages: Column) -> Column:
    return F.when(pages == 0, 0.0).otherwise(questions / pages)


def papers(documents: DataFrame) -> DataFrame:
    """doc, pages, questions, questions_per_page, issues; most issues first."""
    n, i = F.size("questions"), F.size("issues")
    return documents.select("doc", F.col("page_count").alias("pages"), n.alias("questions"), per_page(n, F.col("page_count")).alias("questions_per_page"), i.alias("issues")).orderBy(F.desc("issues"), "doc")


def top_k(counts: DataFrame, by: str, ties: list[str], k: int) -> DataFrame:
    return counts.orderBy(F.desc(by), *ties).limit(k)


def newest(runs: DataFrame, keys: list[str], order: list[Column], k: int = 1, eligible: Column | None = None) -> DataFrame:
    """The k newest rows of each key, among the eligible. Spark limits each task's rows per key before the
    shuffle, so that a key with many runs sends k rows a task."""
    rows = runs if eligible is None else runs.where(eligible)
    return rows.withColumn("nth", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("nth") <= k)


def with_current(runs: DataFrame, keys: list[str], sequence: str = "ingest_seq", blocking: str = "blocking") -> DataFrame:
    """runs plus is_current: the last written non-blocking run of its key."""
    last = F.max(F.when(~F.col(blocking), F.col(sequence))).over(Window.partitionBy(*keys))
    return runs.withColumn("is_current", F.coalesce(~F.col(blocking) & (F.col(sequence) == last), F.lit(False)))


def merge_documents(stored: DataFrame, new: DataFrame) -> DataFrame:
    """Upsert on sha256: unknown level and module do not overwrite known ones, other columns do."""
    kept = ("level", "module")
    cols = [c for c in stored.columns if c != "sha256"]
    hit = F.col("b.__new")
    out = {c: F.coalesce(f"b.{c}", f"a.{c}") if c in kept else F.when(hit, F.col(f"b.{c}")).otherwise(F.col(f"a.{c}")) for c in cols}
    a = stored.alias("a").join(new.withColumn("__new", F.lit(True)).alias("b"), "sha256", "full_outer")
    return a.select("sha256", *(v.alias(c) for c, v in out.items()))


def issue_totals(issues: DataFrame) -> DataFrame:
    """(issue_code, n) of all issues, those of whole documents included; commonest first, then by code."""
    return issues.groupBy("issue_code").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "issue_code")


def severity_histogram(issues: DataFrame) -> DataFrame:
    """(severity, n), severest first."""
    from tallyquill.operators.rules import severity_rank

    return issues.groupBy("severity").agg(F.count(F.lit(1)).alias("n")).orderBy(severity_rank(F.col("severity")))


def totals(papers: DataFrame) -> DataFrame:
    """papers, questions and issues of a papers table."""
    return papers.agg(F.count(F.lit(1)).alias("papers"), F.coalesce(F.sum("questions"), F.lit(0)).alias("questions"), F.coalesce(F.sum("issues"), F.lit(0)).alias("issues"))


def token_sums(runs: DataFrame) -> DataFrame:
    """model, calls, input_tokens, output_tokens; calls that gave no counts add nothing."""
    return runs.groupBy("model").agg(F.count(F.lit(1)).alias("calls"), *(F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in ("input_tokens", "output_tokens")))


def content_status(files: DataFrame, sha: str, order: str) -> DataFrame:
    """files with status: done for the first of equal content, duplicate for the rest."""
    first = files.groupBy(sha).agg(F.min(order).alias("first"))
    return files.join(first, sha).withColumn("status", F.when(F.col(order) == F.col("first"), "done").otherwise("duplicate")).drop("first")


def verdict_counts(attempts: DataFrame, student: str = "student_id", correct: str = "is_correct", *more: Column) -> DataFrame:
    """Attempts, correct and wrong ones of each student and further aggregates; the unjudged are in attempts alone."""
    ok = F.col(correct)
    return attempts.groupBy(student).agg(F.count(F.lit(1)).alias("attempts"), F.count_if(ok).alias("correct"), F.count_if(~ok).alias("wrong"), *more)
