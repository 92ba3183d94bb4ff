"""Queries over whole papers: a conversation stands for a paper, its turns for the questions, faults planted by
expressions over both ids. The SQL finds the faults again from texts and fields, rule by rule."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyquill.functions import fixed as X
from tallyquill.functions import names as N
from tallyquill.operators import ingest, repairs, rules
from tallyquill.plans.registry import query, read
from tallyquill.sources.archive import ARCHIVE, QUESTION, REGION

KIND_SQL = "(conv_id * 7 + turn * 5) % 26"
LINE = "chr(10)"
#: Fields of a question, in SQL that both engines read.
FIELDS = {
    "source_question_id": f"CASE WHEN conv_id % 9 = 4 THEN '3(' || chr(CAST(97 + turn AS INT)) || ')' WHEN {KIND_SQL} = 0 THEN ' ' WHEN {KIND_SQL} = 1 THEN '1' ELSE CAST(turn + 1 AS STRING) END",
    "page_start": f"CAST(CASE {KIND_SQL} WHEN 12 THEN 0 WHEN 13 THEN 3 ELSE turn % 3 + 1 END AS INT)",
    "page_end": f"CAST(CASE {KIND_SQL} WHEN 13 THEN 2 WHEN 14 THEN 50 ELSE turn % 3 + 1 END AS INT)",
    "question_text": f"""CASE WHEN conv_id % 9 = 4 THEN 'Read it all。 What is said in turn 0 of it？What is said in turn ' || turn || ' of it？' || CASE turn WHEN 2 THEN 'It follows by part (b)。' WHEN 3 THEN 'Hence say more。' ELSE '' END WHEN {KIND_SQL} = 2 THEN ' ' ELSE text || CASE {KIND_SQL}
 WHEN 3 THEN ' ' || chr(92) || 'alpha x_{{10}} ' || chr(92) || '(' || chr(92) || 'beta' || chr(92) || ')' WHEN 4 THEN chr(12) || 'rac' || chr(8) || 'eta' || chr(12)
 WHEN 5 THEN {LINE} || 'A. x' || {LINE} || 'B. y' || {LINE} || 'C. z' WHEN 6 THEN {LINE} || '| a | b |' || {LINE} || '| c | d |' WHEN 7 THEN {LINE} || '| a | b |' || {LINE} || '| --- | --- |' || {LINE} || '| c | d | e |'
 WHEN 8 THEN {LINE} || 'It is said again。It is said again。' WHEN 9 THEN ' with x2 and y3 of Q1' WHEN 10 THEN ' Hence find it' WHEN 11 THEN ' using part (b) - - - – – –' WHEN 24 THEN ' − − −' WHEN 25 THEN {LINE} || '  ' || chr(92) || 'frac{{1}}{{2}}' || {LINE} || '= y' ELSE '' END END""",
    "question_type": f"CASE WHEN {KIND_SQL} IN (19, 20) THEN 'multiple_choice' ELSE 'short_answer' END",
    "marks": f"CAST(CASE WHEN conv_id % 4 = 0 OR {KIND_SQL} IN (16, 17) THEN NULL WHEN {KIND_SQL} = 15 THEN -1 ELSE 2 END AS DOUBLE)",
    "group_marks": f"CAST(CASE WHEN {KIND_SQL} = 17 THEN 3 END AS DOUBLE)",
    "diagram_required": f"{KIND_SQL} IN (17, 18)",
}
HAS_PICTURE = f"{KIND_SQL} IN (6, 18) AND conv_id % 2 = 0"  # one usable region, of a diagram or a table
DEPENDS = {21: "own", 22: "99", 23: "1"}  # kind -> what its depends_on names
DOC_SQL = {
    "page_count": "CAST(CASE conv_id % 6 WHEN 0 THEN 0 WHEN 1 THEN 30 ELSE 4 END AS INT)",
    "file_name": "CASE conv_id % 5 WHEN 0 THEN 'F4 paper.pdf' WHEN 1 THEN 'S5 Module 1.pdf' WHEN 2 THEN 'Form 6.pdf' ELSE 'paper.pdf' END",
    "level_text": "CASE conv_id % 3 WHEN 0 THEN 'Form 5' WHEN 2 THEN 'Secondary 4' END",
    "module_text": "CASE conv_id % 7 WHEN 0 THEN 'Module 2' WHEN 1 THEN 'Module 1' END",
}
LOST_QUESTIONS = "conv_id % 11 = 0"  # papers of which no question was read


def papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Papers with nested questions, as validate_extraction takes them."""
    kind = F.expr(KIND_SQL)
    region = F.struct(*(F.lit(v).alias(s) for s, v in (("page", 1), ("y_min", 10), ("x_min", 10), ("y_max", 500), ("x_max", 500))))
    own = {n: F.expr(s.replace("chr(92)", "'\\\\'")) for n, s in FIELDS.items()}
    depends = F.when(kind == 21, F.array(own["source_question_id"])).when(kind == 22, F.array(F.lit("99"))).when(kind == 23, F.array(F.lit("1"))).otherwise(F.expr("cast(array() as array<string>)"))
    given = own | {
        "options": F.when(kind == 20, F.array(F.lit("A. x"), F.lit("B. y"))).otherwise(F.expr("cast(array() as array<string>)")),
        "depends_on": depends,
        "diagram_region": F.when(F.expr(HAS_PICTURE), region),
        "table_regions": F.when(F.expr(HAS_PICTURE), F.array(region)).otherwise(F.expr(f"cast(array() as array<{REGION}>)")),
    }
    fields = [given.get(n, F.lit(None)).alias(n) for n in StructType.fromDDL(QUESTION).names]
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", F.struct(*fields).cast(QUESTION).alias("q"))
    lost = F.expr(LOST_QUESTIONS)
    nested = turns.groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(F.when(~lost, F.struct("turn", "q")))), lambda x: x["q"]).alias("questions"))
    none = F.expr("cast(array() as array<string>)")

    def scheme(matched, unmatched, silent):
        return F.struct(matched.alias("matched"), unmatched.alias("unmatched_scheme_ids"), silent.alias("questions_without_answer"))

    one = F.array(F.lit("1"))
    nested = nested.withColumns({n: F.expr(s) for n, s in DOC_SQL.items()})
    level, module = N.resolve_level(F.col("file_name"), F.col("level_text")), N.resolve_module(F.col("file_name"), F.col("module_text"), F.lit(None).cast("string"))
    k = F.col("conv_id") % 8
    return nested.select(
        F.col("conv_id").cast("string").alias("doc"), *DOC_SQL, level["level"].alias("level"), level["source"].alias("level_source"), module["module"].alias("module"), module["source"].alias("module_source"),
        F.when(k == 0, scheme(none, F.array(F.lit("Z9")), one)).when(k == 1, scheme(one, none, none)).alias("marking_scheme"), "questions",
    )


def _rule(code: str, severity: str, when: str, message: str) -> str:
    """One rule over the questions q, as rows of issues."""
    return f"SELECT doc, '{code}' AS issue_code, {severity} AS severity, {message} AS message, source_question_id FROM q WHERE {when}"


OUTSIDE_SQL = r"regexp_replace(question_text, '(?s)\\\(.*?\\\)|\$\$.*?\$\$|\$[^$\n]+\$', ' ', 'g')"
REFERENCE_SQL = X.REFERENCE.replace("(?U)", "")
BAD_PAGE = "(page_start <= 0 OR page_end <= 0)"
FALLBACK = "CASE WHEN picture THEN ' A picture of the table was captured.' ELSE '' END"
TABLE_SEVERITY = "CASE WHEN picture THEN 'low' ELSE 'medium' END"
SILENT = rf"len(depends_on) = 0 AND (regexp_matches(question_text, '{REFERENCE_SQL}') OR regexp_matches(question_text, '(^|[^A-Za-z])Hence([^A-Za-z]|$)|由此'))"
UNUSED = "Rename the file if the paper is right."
RULE_SQL = "\nUNION ALL ".join([
    _rule("MISSING_QUESTION_ID", "'high'", "trim(source_question_id) = ''", "'A question has no source_question_id.'"),
    _rule("DUPLICATE_QUESTION_ID", "'medium'", "trim(source_question_id) <> '' AND nth > 1", "'Duplicate question id: ' || source_question_id"),
    _rule("EMPTY_QUESTION_TEXT", "'critical'", "trim(question_text) = ''", "'Question ' || source_question_id || ' has empty text.'"),
    _rule("PAGE_NUMBER_INVALID", "'high'", BAD_PAGE, "'Question ' || source_question_id || ' has invalid page number.'"),
    _rule("PAGE_RANGE_INVALID", "'high'", f"NOT {BAD_PAGE} AND page_end < page_start", "'Question ' || source_question_id || ' page_end is before page_start.'"),
    _rule("PAGE_OUT_OF_RANGE", "'high'", f"NOT {BAD_PAGE} AND page_end >= page_start AND page_count > 0 AND page_end > page_count", "'Question ' || source_question_id || ' claims page ' || page_end || ', but the document has ' || page_count || ' page(s).'"),
    _rule("MARKS_INVALID", "'medium'", "marks < 0", "'Question ' || source_question_id || ' has negative marks (' || marks || ').'"),
    _rule("DIAGRAM_REGION_UNUSABLE", "'medium'", "diagram_required AND NOT picture", "'Question ' || source_question_id || ' needs a diagram but gave no usable region; the whole page will be rendered instead.'"),
    _rule("LATEX_NOT_DELIMITED", "'medium'", "len(loose) > 0", r"'Question ' || source_question_id || ' has LaTeX outside \( \): ' || array_to_string(list_sort(list_distinct(loose))[1:5], ', ') || '.'"),
    _rule("CONTROL_CHARACTER", "'high'", "len(control) > 0", "'Question ' || source_question_id || ' contains control characters (' || array_to_string(list_transform(list_sort(list_distinct(control)), lambda c: hex(c) || 'x' || len(list_filter(control, lambda d: d = c))), ', ') || ').'"),
    _rule("OPTIONS_NOT_SEPARATED", "'medium'", "question_type <> 'multiple_choice' AND lettered >= 3", "'Question ' || source_question_id || ' prints its options inside the text but is not marked multiple_choice.'"),
    _rule("OPTIONS_MISSING", "'medium'", "question_type = 'multiple_choice' AND n_options = 0", "'Question ' || source_question_id || ' is multiple choice but carries no options.'"),
    _rule("MALFORMED_TABLE", TABLE_SEVERITY, "malformed > 0", f"'Question ' || source_question_id || ' has ' || malformed || ' table-like block(s) with no separator row.' || {FALLBACK}"),
    _rule("RAGGED_TABLE", TABLE_SEVERITY, "ragged > 0", f"'Question ' || source_question_id || ' has ' || ragged || ' table(s) whose rows disagree on cell count (by up to ' || spread || ').' || {FALLBACK}"),
    _rule("TABLE_NOT_CAPTURED", "'low'", "tables > 0 AND NOT picture", "'Question ' || source_question_id || ' transcribes a table but gave no table_regions.'"),
    _rule("REPEATED_TEXT_IN_QUESTION", "'medium'", "repeated IS NOT NULL", "'Question ' || source_question_id || ' repeats text verbatim: ' || substr(repeated, 1, 60)"),
    _rule("POSSIBLE_BROKEN_POWER", "'medium'", "len(broken) > 0", "'Question ' || source_question_id || ' may have broken power notation: ' || array_to_string(list_sort(list_distinct(broken)), ', ')"),
    _rule("DEPENDENCY_UNMARKED", "'low'", SILENT, "'Question ' || source_question_id || ' refers to an earlier part in its text but depends_on is empty.'"),
    _rule("MARKS_MISSING", "'low'", "NOT marked AND n_marked > 0", "'Question ' || source_question_id || ' has no marks, but ' || n_marked || ' of ' || n_all || ' questions do.'"),
    # rules over targets of dependencies, over groups of parts and over papers
    """SELECT doc, 'DEPENDENCY_SELF', 'medium', 'Question ' || source_question_id || ' lists itself in depends_on.', source_question_id FROM asked WHERE target = source_question_id""",
    """SELECT doc, 'DEPENDENCY_UNKNOWN', 'medium', 'Question ' || source_question_id || ' depends on ' || target || ', which is not in this paper.', source_question_id FROM asked
  WHERE target <> source_question_id AND NOT EXISTS (SELECT 1 FROM q WHERE q.doc = asked.doc AND target IN (q.source_question_id, q.parent))""",
    """SELECT doc, 'STEM_CONTAMINATION', 'high', 'The stem shared by question 3 ends with What is said in turn 0 of it, which is 3(a)''s own question.', unnest(ids) FROM
  (SELECT doc, list(source_question_id) AS ids FROM q WHERE parent = '3' AND starts_with(question_text, 'Read it all。 What is said in turn 0 of it？') GROUP BY doc HAVING count(*) >= 2 AND bool_or(source_question_id = '3(a)'))""",
    """SELECT doc, 'INCONSISTENT_MINUS_SIGN', 'low', 'This paper came back with ' || len(kinds) || ' different dash characters (' || array_to_string(kinds, ', ') || '). The page prints one; matching text later needs one.', NULL FROM
  (SELECT doc, list_filter([CASE WHEN h >= 3 THEN 'U+002D hyphen x' || h END, CASE WHEN e >= 3 THEN 'U+2013 en dash x' || e END, CASE WHEN m >= 3 THEN 'U+2212 minus x' || m END], lambda x: x IS NOT NULL) AS kinds FROM
    (SELECT doc, CAST(sum(length(o) - length(replace(o, '-', ''))) AS BIGINT) AS h, CAST(sum(length(o) - length(replace(o, '–', ''))) AS BIGINT) AS e, CAST(sum(length(o) - length(replace(o, '−', ''))) AS BIGINT) AS m FROM (SELECT doc, outside AS o FROM q) GROUP BY doc)) WHERE len(kinds) > 1""",
    "SELECT doc, 'PAGE_COUNT_INVALID', 'high', 'Document page_count is invalid.', NULL FROM d WHERE page_count <= 0",
    "SELECT doc, 'NO_QUESTIONS_FOUND', 'critical', 'No questions were extracted.', NULL FROM d WHERE n = 0",
    "SELECT doc, 'LEVEL_MISSING', 'low', 'Neither the file name nor the paper names a recognised form.', NULL FROM d WHERE name_level IS NULL AND paper_level IS NULL",
    f"SELECT doc, 'LEVEL_MISMATCH', 'medium', 'File name says ' || name_level || ' but the paper prints ''' || level_text || ''' (' || paper_level || '); using ' || name_level || ' from the filename. {UNUSED}', NULL FROM d WHERE name_level <> paper_level",
    f"SELECT doc, 'MODULE_MISMATCH', 'medium', 'The file name says ' || name_module || ' but the paper prints ''' || module_text || ''' (' || paper_module || '); using ' || name_module || ' from the filename. {UNUSED}', NULL FROM d WHERE name_module <> paper_module",
    "SELECT doc, 'SUSPICIOUSLY_FEW_QUESTIONS', 'medium', 'Only ' || n || ' question(s) found in ' || page_count || ' pages.', NULL FROM d WHERE n > 0 AND page_count >= 5 AND n < page_count * 0.5",
    "SELECT doc, 'MARKING_SCHEME_UNMATCHED', 'low', 'The marking scheme has an entry for Z9, which is not a question in this paper.', NULL FROM d WHERE conv_id % 8 = 0",
    "SELECT doc, 'ANSWER_NOT_IN_MARKING_SCHEME', 'low', 'Question 1 has no answer even after attaching its marking scheme.', '1' FROM d WHERE conv_id % 8 = 0",
    "SELECT doc, 'MARKING_SCHEME_UNUSED', 'medium', 'Nothing in the marking scheme matched a question number in this paper.', NULL FROM d WHERE conv_id % 8 = 0",
])
RAW_SQL = rf"""WITH raw AS (SELECT conv_id, turn, CAST(conv_id AS VARCHAR) AS doc, {DOC_SQL['page_count']} AS page_count, {', '.join(f'{s} AS {n}' for n, s in FIELDS.items())},
  CASE {KIND_SQL} {' '.join(f"WHEN {k} THEN [{FIELDS['source_question_id'] if t == 'own' else repr(t)}]" for k, t in DEPENDS.items())} ELSE [] END AS depends_on, {HAS_PICTURE} AS picture, CASE {KIND_SQL} WHEN 20 THEN 2 ELSE 0 END AS n_options
  FROM conversations WHERE NOT ({LOST_QUESTIONS}))"""
BARE = r"""regexp_matches(x, '\S') AND NOT regexp_matches(x, '[\x{3000}-\x{9fff}\x{ff00}-\x{ffef}]|\\\(|\\\)|\$') AND regexp_matches(x, '\\[a-zA-Z]{2,}|[\^_]\{[^}\n]{1,30}\}')"""
REPAIRED_SQL = RAW_SQL + rf""",
stray AS (SELECT doc FROM raw WHERE starts_with(question_text, 'Read it all。 What is said in turn 0 of it？') GROUP BY doc HAVING count(*) >= 2 AND bool_or(turn = 0)),
one AS (SELECT *, doc IN (FROM stray) AS was_stray, CASE WHEN doc IN (FROM stray) THEN replace(question_text, ' What is said in turn 0 of it？What', 'What') ELSE question_text END AS t1 FROM raw),
two AS (SELECT *, string_split(replace(replace(t1, chr(8), chr(92) || 'b'), chr(12), chr(92) || 'f'), chr(10)) AS l2 FROM one),
three AS (SELECT *, array_to_string(list_transform(l2, lambda x: CASE WHEN {BARE} THEN regexp_extract(x, '^(\s*)', 1) || '\( ' || regexp_replace(x, '^\s+|\s+$', '', 'g') || ' \)' ELSE x END), chr(10)) AS t3, len(list_filter(l2, lambda x: {BARE})) AS wrapped,
  nullif(regexp_extract(source_question_id, '^(.+?)\s*\([^()]*\)\s*$', 1), '') AS parent, list(source_question_id) OVER (PARTITION BY doc) AS ids FROM two),
four AS (SELECT *, list_filter(list_transform(regexp_extract_all(t3, '{REFERENCE_SQL}', 1), lambda x: split_part(source_question_id, '(', 1) || '(' || x || ')'), lambda x: x <> source_question_id AND list_contains(ids, x)) AS named,
  CASE WHEN parent IS NOT NULL AND regexp_matches(t3, '(^|[^A-Za-z])Hence([^A-Za-z]|$)|由此') THEN lag(source_question_id) OVER (PARTITION BY doc, parent ORDER BY turn) END AS earlier FROM three),
five AS (SELECT *, CASE WHEN len(depends_on) > 0 THEN NULL WHEN len(named) > 0 THEN named WHEN earlier IS NOT NULL THEN [earlier] END AS filled FROM four),
fixed AS (SELECT * EXCLUDE (question_text, depends_on, parent), t3 AS question_text, coalesce(filled, depends_on) AS depends_on, list_filter([
  CASE WHEN was_stray THEN 'Repaired: removed ''What is said in turn 0 of it'' from the stem shared by question 3; it is 3(a)''s own question.' END,
  CASE WHEN contains(t1, chr(8)) THEN 'Repaired: restored ' || (length(t1) - length(replace(t1, chr(8), ''))) || ' unescaped backslash(es) before ''b''.' END,
  CASE WHEN contains(t1, chr(12)) THEN 'Repaired: restored ' || (length(t1) - length(replace(t1, chr(12), ''))) || ' unescaped backslash(es) before ''f''.' END,
  CASE WHEN wrapped > 0 THEN 'Repaired: wrapped ' || wrapped || ' displayed formula(s) in \( \).' END,
  CASE WHEN filled IS NOT NULL THEN 'depends_on filled from the text (' || CASE WHEN len(named) > 0 THEN 'named in the text' ELSE '''Hence'' / ''由此'' refers to the part before' END || '): ' || array_to_string(filled, ', ') END], lambda x: x IS NOT NULL) AS notes FROM five)"""
FOUND_SQL = rf"""
lines AS (SELECT doc, turn, unnest(string_split(question_text, chr(10))) AS line, generate_subscripts(string_split(question_text, chr(10)), 1) AS i FROM c),
piped AS (SELECT *, i - row_number() OVER (PARTITION BY doc, turn ORDER BY i) AS g, length(line) - length(replace(line, '|', '')) AS pipes FROM lines WHERE contains(line, '|')),
blocks AS (SELECT doc, turn, g, count(DISTINCT pipes) = 1 AS steady, bool_or(regexp_matches(line, '^\|( *-+ *\|)+$')) AS sep, max(pipes) - min(pipes) AS uneven FROM piped GROUP BY ALL HAVING count(*) >= 2),
t AS (SELECT doc, turn, count(*) FILTER (WHERE steady AND NOT sep) AS malformed, count(*) FILTER (WHERE sep AND uneven > 0) AS ragged, max(uneven) FILTER (WHERE sep) AS spread, count(*) FILTER (WHERE steady OR sep) AS tables FROM blocks GROUP BY ALL),
s AS (SELECT doc, turn, trim(regexp_replace(unnest(string_split_regex(question_text, '[。？！\n]+')), '\s+', ' ', 'g')) AS s FROM c),
r AS (SELECT doc, turn, min(s) AS repeated FROM (SELECT doc, turn, s FROM s WHERE length(s) >= 8 AND NOT contains(s, '|') GROUP BY ALL HAVING count(*) > 1) GROUP BY ALL),
o AS (SELECT *, {OUTSIDE_SQL} AS outside, marks IS NOT NULL OR group_marks IS NOT NULL AS marked FROM c),
q AS (SELECT o.*, t.* EXCLUDE (doc, turn), repeated, row_number() OVER (PARTITION BY o.doc, source_question_id ORDER BY o.turn) AS nth, nullif(regexp_extract(source_question_id, '^(.+?)\s*\([^()]*\)\s*$', 1), '') AS parent,
  list_concat(regexp_extract_all(outside, '\\[a-zA-Z]{{2,}}'), regexp_extract_all(outside, '[\^_]\{{[^}}\n]{{1,30}}\}}')) AS loose, regexp_extract_all(question_text, '[\x00-\x09\x0b-\x1f]') AS control,
  len(list_distinct(regexp_extract_all(question_text, '(?m)^\s*\(?([A-D])[.)、．]\s', 1))) AS lettered, regexp_extract_all(regexp_replace(regexp_replace(question_text, '\b\d[xX]\d\b', '#', 'g'), '\b[A-Z]\d+\b', '#', 'g'), '[a-zA-Z]\d+') AS broken,
  count(*) FILTER (WHERE marked) OVER (PARTITION BY o.doc) AS n_marked, count(*) OVER (PARTITION BY o.doc) AS n_all
  FROM o LEFT JOIN t ON t.doc = o.doc AND t.turn = o.turn LEFT JOIN r ON r.doc = o.doc AND r.turn = o.turn),
asked AS (SELECT doc, source_question_id, unnest(depends_on) AS target FROM q),
d AS (SELECT conv_id, CAST(conv_id AS VARCHAR) AS doc, count(*) FILTER (WHERE NOT ({LOST_QUESTIONS})) AS n, {', '.join(f'{s} AS {n}' for n, s in DOC_SQL.items())}, CASE conv_id % 5 WHEN 0 THEN 'F4' WHEN 1 THEN 'F5' WHEN 2 THEN 'F6' END AS name_level,
  CASE conv_id % 3 WHEN 0 THEN 'F5' WHEN 2 THEN 'F4' END AS paper_level, CASE WHEN conv_id % 5 = 1 THEN 'M1' END AS name_module, CASE conv_id % 7 WHEN 0 THEN 'M2' WHEN 1 THEN 'M1' END AS paper_module FROM conversations GROUP BY conv_id),
issues AS ({RULE_SQL})"""
ISSUES_SQL = RAW_SQL + ", c AS (FROM raw)," + FOUND_SQL
INGESTED_SQL = REPAIRED_SQL + ", c AS (SELECT conv_id, turn, doc, page_count, " + ", ".join(FIELDS) + ", depends_on, picture, n_options FROM fixed)," + FOUND_SQL


@query(ISSUES_SQL + " SELECT * FROM issues")
def validated_papers(spark, sf_dir):
    """The whole rule catalogue over all papers."""
    return rules.validate_extraction(papers(spark, sf_dir)).drop("ordinal")


@query(ISSUES_SQL + " SELECT doc, bool_or(severity = 'critical') AS blocking FROM issues GROUP BY doc")
def blocked_papers(spark, sf_dir):
    """Papers with issues, and whether one of them blocks."""
    return rules.blocking(rules.validate_extraction(papers(spark, sf_dir)))


@query(REPAIRED_SQL + " SELECT doc, CAST(row_number() OVER (PARTITION BY doc ORDER BY turn) - 1 AS INT) AS position, source_question_id, question_text, array_to_string(depends_on, ',') AS depends_on, array_to_string(notes, ' | ') AS notes FROM fixed")
def repaired_papers(spark, sf_dir):
    """All repairs over all papers: texts, dependencies and the notes of what was changed."""
    q = papers(spark, sf_dir).select("doc", F.posexplode("questions").alias("position", "q")).select("doc", "position", "q.*")
    done = repairs.repaired(q.withColumn("extraction_notes", F.expr("cast(array() as array<string>)")))
    return done.select("doc", "position", "source_question_id", "question_text", F.array_join("depends_on", ",").alias("depends_on"), F.array_join("extraction_notes", " | ").alias("notes"))


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Papers as the results of an extraction, before the chain."""
    kinds = StructType.fromDDL(ARCHIVE)
    p, none = papers(spark, sf_dir), F.expr("cast(array() as array<string>)")
    noted = F.transform("questions", lambda q: q.withField("extraction_notes", none))
    source = {"file_name": F.col("file_name"), "sha256": F.sha2("doc", 256), "page_count": F.col("page_count")}
    scheme = {n: F.col("marking_scheme")[n] for n in ("matched", "unmatched_scheme_ids", "questions_without_answer")}

    def struct(fields: dict, kind: StructType):
        return F.struct(*(fields.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in kind))

    document = {n: F.col(n) for n in p.columns if n not in ("doc", "marking_scheme")} | {"questions": noted}
    document["marking_scheme"] = F.when(F.col("marking_scheme").isNotNull(), struct(scheme, kinds["document"].dataType["marking_scheme"].dataType))
    made = {"source": struct(source, kinds["source"].dataType), "document": struct(document, kinds["document"].dataType), "run": F.lit(None).cast(kinds["run"].dataType)}
    return p.select(*(made.get(f.name, F.expr(f"cast(array() as {f.dataType.simpleString()})")).alias(f.name) for f in kinds))


@query(INGESTED_SQL + " SELECT substr(sha256(doc), 1, 12) AS paper, issue_code, severity, message, source_question_id FROM issues")
def ingested_papers(spark, sf_dir):
    """What is left to report after the chain has repaired all papers."""
    done = ingest.ingested(results(spark, sf_dir))
    return done.select(N.paper_key(F.col("source.sha256")).alias("paper"), F.explode("issues").alias("i")).select("paper", "i.*")


@query(INGESTED_SQL + """, n AS (SELECT doc, count(*) AS issues, bool_or(severity = 'critical') AS blocking FROM issues GROUP BY doc)
SELECT CASE WHEN blocking THEN 'failed' ELSE 'ok' END AS status, count(*) AS papers, CAST(sum(d.n) AS BIGINT) AS questions, CAST(sum(coalesce(issues, 0)) AS BIGINT) AS issues FROM d LEFT JOIN n USING (doc) GROUP BY ALL""")
def ingest_outcomes(spark, sf_dir):
    """Papers, questions and issues of the chain by status."""
    done = ingest.outcomes(ingest.ingested(results(spark, sf_dir)))
    return done.groupBy("status").agg(F.count(F.lit(1)).alias("papers"), F.sum("questions").alias("questions"), F.sum("issues").alias("issues"))
