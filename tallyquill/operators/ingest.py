"""The chain that a batch of extracted papers goes through: repair, attach marking schemes, validate, and
what of it is stored, filed and reported. Each step is a DataFrame transform over all papers together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyquill.functions import names as N
from tallyquill.operators import compare, repairs, rules
from tallyquill.sources.archive import QUESTION, questions_of
from tallyquill.sources.rows import is_blocking
from tallyquill.sources.shared import stored

ANSWER_COLUMNS = ("answer", "worked_solution", "marks")


def _doc() -> Column:
    return N.paper_key(F.col("source.sha256"))


def repair_lines(before: DataFrame, after: DataFrame) -> DataFrame:
    """(doc, lines): a line '<id>: <note>' for each note that repairs added, in order of questions."""
    old = before.select("doc", "position", F.col("extraction_notes").alias("old"))
    new = after.join(old, ["doc", "position"]).select("doc", "position", F.explode(F.transform(F.slice("extraction_notes", F.size("old") + 1, F.size("extraction_notes")), lambda n: F.concat("source_question_id", F.lit(": "), n))).alias("line"))
    return new.groupBy("doc").agg(F.transform(F.array_sort(F.collect_list(F.struct("position", "line"))), lambda x: x["line"]).alias("lines"))


def attach_reports(questions: DataFrame, scheme: DataFrame, files: DataFrame) -> DataFrame:
    """(doc, marking_scheme): which ids matched, which scheme ids did not, which questions are left without an
    answer, in printed order. files: doc, file_name, sha256, page_count of each scheme."""
    key = N.normal_id(F.col("source_question_id"))

    def listed(c: str) -> Column:
        return F.transform(F.array_sort(F.collect_list(F.struct("at", "id"))), lambda x: x["id"]).alias(c)

    keys = scheme.select("doc", key.alias("k")).distinct()
    q = questions.withColumn("k", key)
    matched = q.join(keys, ["doc", "k"], "left_semi").groupBy("doc", "k").agg(F.max_by(F.struct(F.col("position").alias("at"), F.col("source_question_id").alias("id")), "position").alias("m")).select("doc", "m.*").groupBy("doc").agg(listed("matched"))
    unmatched = compare.unmatched_scheme_rows(questions, scheme).select("doc", F.col("ordinal").alias("at"), F.col("source_question_id").alias("id")).groupBy("doc").agg(listed("unmatched_scheme_ids"))
    silent = questions.where(~N.said(F.col("answer"))).select("doc", F.col("position").alias("at"), F.col("source_question_id").alias("id")).groupBy("doc").agg(listed("questions_without_answer"))
    j = files.join(matched, "doc", "left").join(unmatched, "doc", "left").join(silent, "doc", "left")
    none = F.expr("cast(array() as array<string>)")
    return j.select("doc", F.struct("file_name", "sha256", "page_count", *(F.coalesce(c, none).alias(c) for c in ("matched", "unmatched_scheme_ids", "questions_without_answer"))).alias("scheme"))


def _nested(results: DataFrame, questions: DataFrame) -> DataFrame:
    """results with their questions replaced, in order of position."""
    fields = [c for c in questions.columns if c not in ("doc", "page_count", "position")]
    nested = questions.groupBy("doc").agg(F.transform(F.array_sort(F.collect_list(F.struct("position", F.struct(*fields).cast(QUESTION).alias("q")))), lambda x: x["q"]).alias("__questions"))
    j = results.withColumn("doc", _doc()).join(nested, "doc", "left")
    return j.withColumn("document", F.col("document").withField("questions", F.coalesce("__questions", F.expr(f"cast(array() as array<{QUESTION}>)")))).drop("__questions")


def ingested(results: DataFrame, scheme: DataFrame | None = None, scheme_files: DataFrame | None = None) -> DataFrame:
    """Extracted results (one a paper) repaired, with answers attached and with their issues, ready to be stored.

    scheme: doc, ordinal and the fields of its entries; scheme_files: doc, file_name, sha256, page_count.
    """
    q = questions_of(results)
    fixed = stored(repairs.repaired(q), "repaired")
    lines = repair_lines(q, fixed)
    out = results
    if scheme is not None:
        fixed = compare.attach_answers(fixed, scheme)
        note = F.concat(F.lit("Printed answer replaced by the marking scheme's: "), "conflict")
        fixed = fixed.withColumn("extraction_notes", F.when(F.col("conflict").isNotNull(), F.concat("extraction_notes", F.array(note))).otherwise(F.col("extraction_notes"))).drop("conflict", "answer_source")
        reports = attach_reports(fixed, scheme, scheme_files)
        out = out.withColumn("doc", _doc()).join(reports, "doc", "left").withColumn("document", F.when(F.col("scheme").isNotNull(), F.col("document").withField("marking_scheme", F.col("scheme"))).otherwise(F.col("document"))).drop("doc", "scheme")
    out = _nested(out, fixed).join(lines, "doc", "left").withColumn("repairs", F.coalesce("lines", "repairs")).drop("lines")
    return with_issues(stored(out, "papers"))


def with_issues(results: DataFrame) -> DataFrame:
    """results (with doc) whose issues are those of their validation, in order of rules."""
    found = rules.validate_extraction(results.select("doc", "document.*"))
    nested = found.groupBy("doc").agg(F.transform(F.array_sort(F.collect_list(F.struct("ordinal", "issue_code", "severity", "message", "source_question_id"))), lambda i: F.struct(i["issue_code"], i["severity"], i["message"], i["source_question_id"])).alias("__issues"))
    kind = dict(results.dtypes)["issues"]
    return results.join(nested, "doc", "left").withColumn("issues", F.coalesce(F.col("__issues").cast(kind), F.expr(f"cast(array() as {kind})"))).drop("__issues")


def with_late_scheme(archived: DataFrame, scheme: DataFrame, scheme_files: DataFrame, run_id: Column, at: Column) -> DataFrame:
    """Papers archived before their marking scheme came: answers attached to their questions, as a new run."""
    from tallyquill.sources.rows import new_run

    late = archived.withColumn("doc", _doc()).join(scheme_files.select("doc"), "doc", "left_semi").drop("doc")
    q = compare.attach_answers(questions_of(late), scheme).drop("conflict", "answer_source")
    reports = attach_reports(q, scheme, scheme_files)
    out = _nested(late, q).join(reports, "doc").withColumn("document", F.col("document").withField("marking_scheme", F.col("scheme"))).drop("scheme")
    return with_issues(out).withColumn("run", new_run(F.col("run"), run_id, at))


def outcomes(results: DataFrame) -> DataFrame:
    """(file, status, questions, issues) of each paper: failed where an issue blocks, else ok."""
    return results.select(F.col("source.file_name").alias("file"), F.when(is_blocking(F.col("issues")), "failed").otherwise("ok").alias("status"), F.size("document.questions").alias("questions"), F.size("issues").alias("issues"))
