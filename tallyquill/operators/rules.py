"""Data-quality rules. Each gives rows of one long table of issues.

Rules over a single text or row are evaluated in one projection, as an array of optional issues that is
exploded once, so a text is scanned once. Rules over a document's questions together are grouped
aggregates or windows per document. ``ordinal`` keeps the order in which issues are reported.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyquill.functions import fixed as X
from tallyquill.functions import names as N
from tallyquill.functions import texts as T
from tallyquill.sources.shared import stored

ISSUE = "doc string, issue_code string, severity string, message string, source_question_id string, ordinal int"


def issue(code: str, severity: str | Column, when: Column, message: Column, ordinal: int) -> Column:
    """A struct where the condition holds, else null."""
    severity = F.lit(severity) if isinstance(severity, str) else severity
    return F.when(when, F.struct(F.lit(code).alias("issue_code"), severity.alias("severity"), message.alias("message"), F.lit(ordinal).alias("ordinal")))


def say(template: str, *args: Column) -> Column:
    return F.format_string(template, *args)


def _listed(items: Column, most: int) -> Column:
    return F.array_join(F.slice(F.array_sort(F.array_distinct(items)), 1, most), ", ")


def exploded(rows: DataFrame, issues: list[Column], qid: Column | None = None, doc: str = "doc") -> DataFrame:
    found = rows.select(F.col(doc).alias("doc"), (qid if qid is not None else F.lit(None).cast("string")).alias("source_question_id"), F.explode(F.array_compact(F.array(*issues))).alias("i"))
    return found.select("doc", "i.issue_code", "i.severity", "i.message", "source_question_id", "i.ordinal")


def with_text_facts(questions: DataFrame) -> DataFrame:
    """What the rules read from a text, computed once."""
    q = questions.withColumn("f_blocks", T.pipe_blocks(F.col("question_text")))
    return q.withColumns({
        "f_loose": T.undelimited_latex(F.col("question_text")),
        "f_control": T.control_characters(F.col("question_text")),
        "f_options": T.looks_like_multiple_choice(F.col("question_text")),
        "f_malformed": T.malformed_tables(F.col("f_blocks")),
        "f_ragged": T.ragged_tables(F.col("f_blocks")),
        "f_table": T.looks_like_a_table(F.col("f_blocks")),
        "f_repeated": T.repeated_sentences(F.col("question_text")),
        "f_broken": T.broken_powers(F.col("question_text")),
        "f_picture": F.coalesce(F.exists("table_regions", T.is_usable_region), F.lit(False)),
    })


def question_rules(questions: DataFrame) -> DataFrame:
    """Rules local to a question. questions: doc, page_count, position and the question's fields."""
    q = with_text_facts(questions)
    qid, text = F.col("source_question_id"), F.col("question_text")
    nth = F.row_number().over(Window.partitionBy("doc", "source_question_id").orderBy("position"))
    q = q.withColumn("nth", nth)
    blank_id = N.stripped(qid) == ""
    start, end, pages = F.col("page_start"), F.col("page_end"), F.col("page_count")
    bad_page, bad_range = (start <= 0) | (end <= 0), end < start
    table_severity = F.when(F.col("f_picture"), "low").otherwise("medium")
    fallback = F.when(F.col("f_picture"), " A picture of the table was captured.").otherwise("")
    choice = F.col("question_type") == "multiple_choice"
    counted = F.transform(F.array_sort(F.array_distinct("f_control")), lambda c: F.concat(F.lpad(F.hex(F.ascii(c)), 2, "0"), F.lit("x"), F.size(F.filter("f_control", lambda d: d == c)).cast("string")))
    issues = [
        issue("MISSING_QUESTION_ID", "high", blank_id, F.lit("A question has no source_question_id."), 1),
        issue("DUPLICATE_QUESTION_ID", "medium", ~blank_id & (F.col("nth") > 1), say("Duplicate question id: %s", qid), 2),
        issue("EMPTY_QUESTION_TEXT", "critical", N.stripped(text) == "", say("Question %s has empty text.", qid), 3),
        issue("PAGE_NUMBER_INVALID", "high", bad_page, say("Question %s has invalid page number.", qid), 4),
        issue("PAGE_RANGE_INVALID", "high", ~bad_page & bad_range, say("Question %s page_end is before page_start.", qid), 5),
        issue("PAGE_OUT_OF_RANGE", "high", ~bad_page & ~bad_range & (pages > 0) & (end > pages), say("Question %s claims page %d, but the document has %d page(s).", qid, end, pages), 6),
        issue("MARKS_INVALID", "medium", F.col("marks") < 0, say("Question %s has negative marks (%s).", qid, F.col("marks").cast("string")), 7),
        issue("DIAGRAM_REGION_UNUSABLE", "medium", F.col("diagram_required") & ~T.is_usable_region(F.col("diagram_region")), say("Question %s needs a diagram but gave no usable region; the whole page will be rendered instead.", qid), 8),
        issue("LATEX_NOT_DELIMITED", "medium", F.size("f_loose") > 0, say("Question %s has LaTeX outside \\( \\): %s.", qid, _listed(F.col("f_loose"), 5)), 9),
        issue("CONTROL_CHARACTER", "high", F.size("f_control") > 0, say("Question %s contains control characters (%s).", qid, F.array_join(counted, ", ")), 10),
        issue("OPTIONS_NOT_SEPARATED", "medium", ~choice & F.col("f_options"), say("Question %s prints its options inside the text but is not marked multiple_choice.", qid), 11),
        issue("OPTIONS_MISSING", "medium", choice & (F.size("options") == 0), say("Question %s is multiple choice but carries no options.", qid), 12),
        issue("MALFORMED_TABLE", table_severity, F.col("f_malformed") > 0, F.concat(say("Question %s has %d table-like block(s) with no separator row.", qid, F.col("f_malformed")), fallback), 13),
        issue("RAGGED_TABLE", table_severity, F.size("f_ragged") > 0, F.concat(say("Question %s has %d table(s) whose rows disagree on cell count (by up to %d).", qid, F.size("f_ragged"), F.array_max("f_ragged")), fallback), 14),
        issue("TABLE_NOT_CAPTURED", "low", F.col("f_table") & (F.size("table_regions") == 0), say("Question %s transcribes a table but gave no table_regions.", qid), 15),
        issue("REPEATED_TEXT_IN_QUESTION", "medium", F.size("f_repeated") > 0, say("Question %s repeats text verbatim: %s", qid, F.substring(F.get(F.col("f_repeated"), F.lit(0)), 1, 60)), 16),
        issue("POSSIBLE_BROKEN_POWER", "medium", F.size("f_broken") > 0, say("Question %s may have broken power notation: %s", qid, _listed(F.col("f_broken"), 1 << 20)), 17),
    ]
    return exploded(q, issues, qid)


def document_rules(documents: DataFrame) -> DataFrame:
    """Rules over a document's own fields: page count, emptiness, form, module, marking scheme."""
    name_level, paper_level = N.parse_level(F.col("file_name")), N.parse_level(F.col("level_text"))
    name_module, paper_module = N.parse_module(F.col("file_name")), N.parse_module(F.col("module_text"))
    n = F.col("n_questions")
    optional = ("level_source", "module", "module_source")  # of older archives
    documents = documents.withColumns({c: F.lit(None).cast("string") for c in optional if c not in documents.columns})
    issues = [
        issue("PAGE_COUNT_INVALID", "high", F.col("page_count") <= 0, F.lit("Document page_count is invalid."), 0),
        issue("NO_QUESTIONS_FOUND", "critical", n == 0, F.lit("No questions were extracted."), 1),
        issue("LEVEL_MISSING", "low", F.col("level").isNull(), F.lit("Neither the file name nor the paper names a recognised form."), 2),
        issue("LEVEL_MISMATCH", "medium", F.col("level").isNotNull() & (name_level != paper_level), say("File name says %s but the paper prints '%s' (%s); using %s from the %s. Rename the file if the paper is right.", name_level, F.col("level_text"), paper_level, F.col("level"), F.coalesce("level_source", F.lit("filename"))), 3),
        issue("MODULE_MISMATCH", "medium", name_module != paper_module, say("The file name says %s but the paper prints '%s' (%s); using %s from the %s. Rename the file if the paper is right.", name_module, F.col("module_text"), paper_module, F.coalesce("module", name_module), F.coalesce("module_source", F.lit("filename"))), 4),
        issue("SUSPICIOUSLY_FEW_QUESTIONS", "medium", (n > 0) & (F.col("page_count") >= X.LEAST_PAGES_FOR_DENSITY) & (n < F.col("page_count") * X.LEAST_PER_PAGE), say("Only %d question(s) found in %d pages.", n, F.col("page_count")), 5),
    ]
    own = exploded(documents, issues)
    scheme = documents.where(F.col("marking_scheme").isNotNull())

    def each(column: str, code: str, text: str, named: bool, ordinal: int) -> DataFrame:
        x = scheme.select("doc", F.explode(F.col("marking_scheme")[column]).alias("id"))
        return x.select("doc", F.lit(code).alias("issue_code"), F.lit("low").alias("severity"), say(text, F.col("id")).alias("message"), (F.col("id") if named else F.lit(None).cast("string")).alias("source_question_id"), F.lit(ordinal).alias("ordinal"))

    unused = exploded(scheme, [issue("MARKING_SCHEME_UNUSED", "medium", F.size(F.col("marking_scheme")["matched"]) == 0, F.lit("Nothing in the marking scheme matched a question number in this paper."), 8)])
    parts = [own, each("unmatched_scheme_ids", "MARKING_SCHEME_UNMATCHED", "The marking scheme has an entry for %s, which is not a question in this paper.", False, 6), each("questions_without_answer", "ANSWER_NOT_IN_MARKING_SCHEME", "Question %s has no answer even after attaching its marking scheme.", True, 7), unused]
    return reduce(DataFrame.unionByName, parts)


def dependency_rules(questions: DataFrame) -> DataFrame:
    """depends_on entries that name the question itself or nothing in the paper, and unrecorded ones."""
    known = questions.select("doc", F.explode(F.array_compact(F.array("source_question_id", N.parent_of(F.col("source_question_id"))))).alias("target")).distinct()
    asked = questions.select("doc", "position", "source_question_id", F.explode("depends_on").alias("target"))
    own = asked.where("target = source_question_id")
    lost = asked.where("target <> source_question_id").join(known, ["doc", "target"], "left_anti")
    silent = questions.where((F.size("depends_on") == 0) & ((F.size(T.referenced_parts(F.col("question_text"), F.col("source_question_id"))) > 0) | T.says_hence(F.col("question_text"))))

    def rows(df: DataFrame, code: str, severity: str, message: Column, ordinal: int) -> DataFrame:
        return df.select("doc", F.lit(code).alias("issue_code"), F.lit(severity).alias("severity"), message.alias("message"), "source_question_id", F.lit(ordinal).alias("ordinal"))

    qid = F.col("source_question_id")
    return (
        rows(own, "DEPENDENCY_SELF", "medium", say("Question %s lists itself in depends_on.", qid), 1)
        .unionByName(rows(lost, "DEPENDENCY_UNKNOWN", "medium", say("Question %s depends on %s, which is not in this paper.", qid, F.col("target")), 2))
        .unionByName(rows(silent, "DEPENDENCY_UNMARKED", "low", say("Question %s refers to an earlier part in its text but depends_on is empty.", qid), 3))
    )


def marks_missing(questions: DataFrame) -> DataFrame:
    """Unmarked questions of documents that mark some."""
    marked = F.col("marks").isNotNull() | F.col("group_marks").isNotNull()
    per = questions.groupBy("doc").agg(F.count_if(marked).alias("n_marked"), F.count(F.lit(1)).alias("n_all")).where("n_marked > 0")
    found = questions.where(~marked).join(per, "doc")
    return found.select("doc", F.lit("MARKS_MISSING").alias("issue_code"), F.lit("low").alias("severity"), say("Question %s has no marks, but %d of %d questions do.", F.col("source_question_id"), F.col("n_marked"), F.col("n_all")).alias("message"), "source_question_id", F.lit(1).alias("ordinal"))


def dash_totals(questions: DataFrame, doc: str = "doc", text: str = "question_text") -> DataFrame:
    """doc, hyphen, en_dash, minus: uses in the prose of each document, and kinds used often enough."""
    each = questions.select(F.col(doc), T.dash_counts(F.col(text)).alias("d"))
    kinds = ("hyphen", "en_dash", "minus")
    sums = each.groupBy(doc).agg(*(F.sum(F.col("d")[k]).cast("long").alias(k) for k in kinds))
    return sums.withColumn("kinds", reduce(lambda a, b: a + b, [(F.col(k) >= X.LEAST_DASHES).cast("int") for k in kinds]))


def minus_rule(questions: DataFrame) -> DataFrame:
    mixed = dash_totals(questions).where("kinds > 1")
    kinds = zip(("hyphen", "en_dash", "minus"), X.DASHES.values(), strict=True)
    named = F.array_join(F.array_compact(F.array(*(F.when(F.col(k) >= X.LEAST_DASHES, F.format_string(f"{name} x%d", F.col(k))) for k, name in kinds))), ", ")
    return mixed.select("doc", F.lit("INCONSISTENT_MINUS_SIGN").alias("issue_code"), F.lit("low").alias("severity"), say("This paper came back with %d different dash characters (%s). The page prints one; matching text later needs one.", F.col("kinds"), named).alias("message"), F.lit(None).cast("string").alias("source_question_id"), F.lit(1).alias("ordinal"))


def validate_extraction(documents: DataFrame) -> DataFrame:
    """All issues of documents with nested questions (column ``questions``), severest first per document.

    documents: doc, file_name, page_count, level, level_text, module_text, marking_scheme, questions. They are
    stored first, since every rule reads them: what they are made of runs once.
    """
    from tallyquill.operators.repairs import stem_contamination

    docs = stored(documents, "validated").withColumn("n_questions", F.size("questions"))
    questions = docs.select("doc", "page_count", F.posexplode("questions").alias("position", "q")).select("doc", "page_count", "position", "q.*")
    stems = stem_contamination(questions)
    stems = stems.select("doc", F.explode("question_ids").alias("source_question_id"), "parent", "removed", "owner")
    stems = stems.select("doc", F.lit("STEM_CONTAMINATION").alias("issue_code"), F.lit("high").alias("severity"), say("The stem shared by question %s ends with %s, which is %s's own question.", F.col("parent"), F.col("removed"), F.col("owner")).alias("message"), "source_question_id", F.lit(1).alias("ordinal"))
    producers = [document_rules(docs), dependency_rules(questions), question_rules(questions), stems, marks_missing(questions), minus_rule(questions)]
    return reduce(DataFrame.unionByName, producers)


def severity_rank(severity: Column) -> Column:
    order = F.create_map(*(F.lit(x) for k, s in enumerate(X.SEVERITIES) for x in (s, k)))
    return F.coalesce(F.try_element_at(order, severity), F.lit(9))


def blocking(issues: DataFrame) -> DataFrame:
    """Documents with a critical issue: their file goes to the failed folder."""
    return issues.groupBy("doc").agg(F.coalesce(F.bool_or(F.col("severity") == "critical"), F.lit(False)).alias("blocking"))
