"""Deterministic rewrites of question texts, and the rows that say what was rewritten.

``questions`` holds doc, position and a question's fields. Each repair is a DataFrame transform and
adds a note to extraction_notes; apply them in the order of ``repaired``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyquill.functions import fixed as X
from tallyquill.functions import names as N
from tallyquill.functions import texts as T


def sibling_groups(questions: DataFrame) -> DataFrame:
    """doc, parent and the parts (position, id, text) in printed order, for parents of two or more."""
    parts = questions.withColumn("parent", N.parent_of(F.col("source_question_id"))).where("parent is not null")
    groups = parts.groupBy("doc", "parent").agg(F.array_sort(F.collect_list(F.struct("position", "source_question_id", "question_text"))).alias("parts"))
    return groups.where(F.size("parts") >= 2)


def common_prefix(texts: Column) -> Column:
    """Longest start that all texts share, by the shared length of neighbours in sorted order."""
    least, most = F.array_min(texts), F.array_max(texts)
    places = F.sequence(F.lit(0), F.length(least))
    differs = F.filter(places, lambda i: (i >= F.length(least)) | (F.substring(least, i + 1, F.lit(1)) != F.substring(most, i + 1, F.lit(1))))
    return F.substring(least, F.lit(1), differs[0])


def up_to_sentence_end(text: Column) -> Column:
    return F.regexp_extract(text, f"(?s)^(.*[{X.SENTENCE_ENDS}])", 1)


def _plain(text: Column) -> Column:
    return N.stripped(F.regexp_replace(N.collapsed(text), f"[{X.SENTENCE_ENDS}]+$", ""))


def stem_contamination(questions: DataFrame) -> DataFrame:
    """doc, parent, removed, owner, question_ids, stem, keep: groups whose shared stem ends with one
    part's whole own question; owner is the first such part."""
    g = sibling_groups(questions).withColumn("stem", up_to_sentence_end(common_prefix(F.transform("parts", lambda p: p["question_text"]))))
    g = g.withColumn("sentences", F.filter(F.split("stem", f"[{X.SENTENCE_ENDS}\n]+"), lambda s: N.stripped(s) != "")).where((F.col("stem") != "") & (F.size("sentences") >= 2))
    g = g.withColumn("removed", _plain(F.element_at("sentences", -1))).where(F.length("removed") >= X.LEAST_SENTENCE)
    owns = F.filter("parts", lambda p: _plain(F.substring(p["question_text"], F.length("stem") + 1, F.length(p["question_text"]))) == F.col("removed"))
    g = g.withColumn("owner", F.get(owns, F.lit(0))["source_question_id"]).where("owner is not null")
    keep = up_to_sentence_end(F.substring("stem", F.lit(1), F.length("stem") - F.instr(F.reverse("stem"), F.reverse("removed")) - F.length("removed") + 1))
    return g.select("doc", "parent", "removed", "owner", F.transform("parts", lambda p: p["source_question_id"]).alias("question_ids"), "stem", keep.alias("keep"))


def _noted(condition: Column, note: Column) -> Column:
    return F.when(condition, F.concat("extraction_notes", F.array(note))).otherwise(F.col("extraction_notes"))


def repair_stems(questions: DataFrame) -> DataFrame:
    """The stray question taken out of the stem of every part of a contaminated group."""
    faults = stem_contamination(questions).select(F.col("doc").alias("d"), F.col("parent").alias("p"), "removed", "owner", "stem", "keep")
    q = questions.join(faults, (F.col("doc") == F.col("d")) & (N.parent_of(F.col("source_question_id")) == F.col("p")), "left")
    text = N.stripped(F.concat("keep", F.substring("question_text", F.length("stem") + 1, F.length("question_text"))))
    hit = F.col("removed").isNotNull()
    note = F.format_string("Repaired: removed '%s' from the stem shared by question %s; it is %s's own question.", "removed", "p", "owner")
    return q.withColumns({"question_text": F.when(hit, text).otherwise(F.col("question_text")), "extraction_notes": _noted(hit, note)}).select(*questions.columns)


def repair_control_characters(questions: DataFrame) -> DataFrame:
    """Backslashes that a JSON escape had eaten put back."""
    q = questions.withColumn("__r", T.restore_backslashes(F.col("question_text")))
    notes = F.array_compact(F.array(*(F.when(F.col("__r")[c] > 0, F.format_string(f"Repaired: restored %d unescaped backslash(es) before '{c}'.", F.col("__r")[c])) for c in sorted(X.EATEN.values()))))
    return q.withColumns({"question_text": F.col("__r")["text"], "extraction_notes": F.concat("extraction_notes", notes)}).drop("__r")


def repair_bare_formulas(questions: DataFrame) -> DataFrame:
    q = questions.withColumn("__r", T.wrap_bare_formulas(F.col("question_text")))
    n = F.size(F.col("__r")["wrapped"])
    return q.withColumns({"question_text": F.col("__r")["text"], "extraction_notes": _noted(n > 0, F.format_string("Repaired: wrapped %d displayed formula(s) in \\( \\).", n))}).drop("__r")


def with_previous_part(parts: DataFrame, group: list[str], order: str, value: str, name: str = "previous") -> DataFrame:
    """The value of the part printed just before under the same parent, null for the first."""
    return parts.withColumn(name, F.lag(value).over(Window.partitionBy(*group).orderBy(order)))


def repair_dependencies(questions: DataFrame) -> DataFrame:
    """Empty depends_on lists filled: with parts the text names that exist, else with the part before where
    the text says hence."""
    q = questions.withColumn("__parent", N.parent_of(F.col("source_question_id")))
    q = with_previous_part(q, ["doc", "__parent"], "position", "source_question_id", "__before")
    ids = questions.groupBy("doc").agg(F.collect_set("source_question_id").alias("__ids"))
    q = q.join(ids, "doc").withColumn("__named", F.filter(T.referenced_parts(F.col("question_text"), F.col("source_question_id")), lambda t: F.array_contains("__ids", t)))
    before = F.when(F.col("__parent").isNotNull() & T.says_hence(F.col("question_text")), F.col("__before"))
    filled = F.when(F.size("depends_on") > 0, F.lit(None)).when(F.size("__named") > 0, F.col("__named")).when(before.isNotNull(), F.array(before))
    reason = F.when(F.size("__named") > 0, "named in the text").otherwise("'Hence' / '由此' refers to the part before")
    q = q.withColumn("__filled", filled)
    note = F.format_string("depends_on filled from the text (%s): %s", reason, F.array_join("__filled", ", "))
    return q.withColumns({"depends_on": F.coalesce("__filled", "depends_on"), "extraction_notes": _noted(F.col("__filled").isNotNull(), note)}).select(*questions.columns)


def repaired(questions: DataFrame) -> DataFrame:
    """All repairs, in their order: stems, control characters, formulas, dependencies."""
    return questions.transform(repair_stems).transform(repair_control_characters).transform(repair_bare_formulas).transform(repair_dependencies)
