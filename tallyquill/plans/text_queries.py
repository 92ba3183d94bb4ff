"""Queries over texts, names and answers. ``documents`` stands for questions (paper: source, id: doc_id),
``pages`` and ``orders`` for files, ``conversations`` for parts printed under one parent."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyquill.functions import fixed as X
from tallyquill.functions import names as N
from tallyquill.functions import texts as T
from tallyquill.operators import repairs, rules, stats
from tallyquill.plans.registry import query, read

ENDS = ".!?"  # sentence ends of the driver's prose


def plain(sql_expr: str) -> str:
    """SQL for a text collapsed to single blanks."""
    return rf"regexp_replace(regexp_replace({sql_expr}, '\s+', ' ', 'g'), '^ | $', '', 'g')"


REPEATED_SQL = f"""
SELECT doc_id, list_sort(list(s)) AS repeated FROM (
  SELECT doc_id, s FROM (SELECT doc_id, unnest(list_transform(string_split_regex(text, '[.!?\n]+'), lambda x: {plain('x')})) AS s FROM documents)
  WHERE length(s) >= 8 AND NOT contains(s, '|') GROUP BY doc_id, s HAVING count(*) > 1) GROUP BY doc_id"""
MASKED_SQL = r"regexp_replace(regexp_replace(text, '\b\d[xX]\d\b', '#', 'g'), '\b[A-Z]\d+\b', '#', 'g')"


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with features and whether one of three text rules fires."""
    text = F.col("text")
    features = F.array_compact(F.array(
        F.when(text.contains("|"), "piped"), F.when(text.contains("\n"), "several lines"), F.when(F.col("n_chars") > 2000, "long"),
        F.when(text.rlike("[0-9]"), "numbers"), F.concat(F.lit("lang "), F.col("lang")), F.when(~text.contains("|") & ~text.rlike("[0-9]"), "prose only"),
    ))
    flagged = (F.size(T.repeated_sentences(text, ENDS)) > 0) | (F.size(T.broken_powers(text)) > 0) | (T.dash_counts(text)["hyphen"] > 0)
    return read(spark, sf_dir, "documents").select("doc_id", "source", features.alias("features"), flagged.alias("flagged"))


LABELLED_SQL = rf"""
WITH r AS ({REPEATED_SQL}), d AS (
  SELECT d.doc_id, source, (r.doc_id IS NOT NULL OR len(regexp_extract_all({MASKED_SQL}, '[a-zA-Z]\d+')) > 0
      OR contains(regexp_replace(text, '(?s)\\\(.*?\\\)|\$\$.*?\$\$|\$[^$\n]+\$', ' ', 'g'), '-')) AS flagged,
    list_filter([CASE WHEN contains(text, '|') THEN 'piped' END, CASE WHEN contains(text, chr(10)) THEN 'several lines' END, CASE WHEN n_chars > 2000 THEN 'long' END,
      CASE WHEN regexp_matches(text, '[0-9]') THEN 'numbers' END, 'lang ' || lang,
      CASE WHEN NOT contains(text, '|') AND NOT regexp_matches(text, '[0-9]') THEN 'prose only' END], lambda x: x IS NOT NULL) AS features
  FROM documents d LEFT JOIN r USING (doc_id))"""


@query(LABELLED_SQL + """, e AS (SELECT unnest(features) AS feature, flagged FROM d)
SELECT feature, count(*) AS questions, CAST(sum(CAST(flagged AS INT)) AS BIGINT) AS flagged, sum(CAST(flagged AS INT)) / count(*) AS issue_rate FROM e GROUP BY feature""")
def feature_issue_rate(spark, sf_dir):
    return stats.feature_rates(labelled(spark, sf_dir))


@query("SELECT doc_id, substr(sha256(text), 1, 12) AS paper, substr(sha256(text), 1, 12) || ':' || doc_id AS question_key FROM documents")
def document_sha_key(spark, sf_dir):
    sha = F.sha2("text", 256)
    return read(spark, sf_dir, "documents").select("doc_id", N.paper_key(sha).alias("paper"), N.question_key(sha, F.col("doc_id").cast("string")).alias("question_key"))


@query("SELECT doc_id, CASE WHEN row_number() OVER (PARTITION BY sha256(text) ORDER BY doc_id) = 1 THEN 'done' ELSE 'duplicate' END AS status FROM documents")
def duplicate_content(spark, sf_dir):
    d = read(spark, sf_dir, "documents").select("doc_id", F.unhex(F.sha2("text", 256)).alias("sha"))
    return stats.content_status(d, "sha", "doc_id").select("doc_id", "status")


@query("""SELECT doc_id, CASE WHEN doc_id % 3 <> 0 THEN substr(k, 1, 12) END AS paper, CASE WHEN doc_id % 3 <> 0 THEN substr(k, 14) END AS question
FROM (SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'short:' || doc_id ELSE substr(sha256(text), 1, 12) || ':' || doc_id || ':a' END AS k FROM documents)""")
def question_key_build_split(spark, sf_dir):
    key = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("short:"), F.col("doc_id"))).otherwise(N.question_key(F.sha2("text", 256), F.concat(F.col("doc_id"), F.lit(":a"))))
    parts = N.split_key(key)
    return read(spark, sf_dir, "documents").select("doc_id", parts["paper"].alias("paper"), parts["question"].alias("question"))


NAME_SQL = """CASE doc_id % 8 WHEN 0 THEN 'S' || (1 + doc_id % 6) || 'MATH1-' || source WHEN 1 THEN 'form ' || (1 + doc_id % 6) || ' paper' WHEN 2 THEN '中四 mock'
 WHEN 3 THEN 'maths4' WHEN 4 THEN 'Grade ' || (7 + doc_id % 6) WHEN 5 THEN 'F.' || (1 + doc_id % 6) || ' Module ' || (1 + doc_id % 2) WHEN 6 THEN 'S1 and S2, algebra and calculus' ELSE 'year 2045' END"""


@query(rf"""SELECT doc_id, CASE WHEN len(l) = 1 THEN l[1] END AS level FROM (SELECT doc_id, list_distinct(list_concat(list_concat(
  list_transform(regexp_extract_all(name, '(?i)(?:^|[^A-Za-z0-9])(?:form|secondary|sec|[SF])\.?\s?([1-6])', 1), lambda x: 'F' || x),
  list_transform(regexp_extract_all(name, '中([四])', 1), lambda x: 'F4')),
  list_transform(regexp_extract_all(name, '(?i)(?:^|[^A-Za-z0-9])grade\s?(7|8|9|1[0-2])', 1), lambda x: 'F' || (CAST(x AS INT) - 6)))) AS l FROM (SELECT doc_id, {NAME_SQL} AS name FROM documents))""")
def level_from_name(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", N.parse_level(F.expr(NAME_SQL)).alias("level"))


@query(rf"""SELECT doc_id, coalesce(m, 'compulsory') AS module, CASE WHEN m IS NULL THEN 'default' ELSE 'filename' END AS source FROM (
  SELECT doc_id, CASE WHEN regexp_matches(name, '(?i)module 1') THEN 'M1' WHEN regexp_matches(name, '(?i)module 2|algebra and calculus') THEN 'M2' END AS m FROM (SELECT doc_id, {NAME_SQL} AS name FROM documents))""")
def module_from_name(spark, sf_dir):
    m = N.resolve_module(F.expr(NAME_SQL), F.lit(None).cast("string"), F.lit(None).cast("string"))
    return read(spark, sf_dir, "documents").select("doc_id", m["module"].alias("module"), m["source"].alias("source"))


@query("""WITH f AS (SELECT o_orderkey, 2010 + o_orderkey % 40 AS y, o_orderkey % 4 AS k FROM orders)
SELECT o_orderkey, CASE k WHEN 0 THEN y || '-' || lpad(CAST((y + 1) % 100 AS VARCHAR), 2, '0') WHEN 1 THEN CAST(y AS VARCHAR) WHEN 2 THEN '2025-26' END AS year,
  CASE k WHEN 1 THEN '1st' WHEN 2 THEN 'final' END AS term, CASE k WHEN 0 THEN 'quiz' WHEN 2 THEN 'mock' WHEN 3 THEN 'test' END AS exam_type,
  CAST(CASE k WHEN 1 THEN 2 WHEN 2 THEN 3 END AS INT) AS paper_number FROM f""")
def year_term_rules(spark, sf_dir):
    y, k = 2010 + F.col("o_orderkey") % 40, F.col("o_orderkey") % 4
    name = F.when(k == 0, F.concat(y, F.lit("-"), F.lpad(((y + 1) % 100).cast("string"), 2, "0"), F.lit("_quiz"))).when(k == 1, F.concat(y, F.lit("_1st_S4MATH2"))).when(k == 2, "2526_final-mock_paper-3").otherwise("x-uniform test")
    m = N.meta_of_name(F.concat(name, F.lit(".pdf")))
    return read(spark, sf_dir, "orders").select("o_orderkey", *(m[c].alias(c) for c in ("year", "term", "exam_type", "paper_number")))


@query(r"""SELECT page_id, CASE WHEN s = '' THEN 'document' ELSE s END AS stem FROM (SELECT page_id,
  regexp_replace(substr(regexp_replace(regexp_replace(regexp_replace(regexp_replace(last, '\s+', '-', 'g'), '[\\/:*?"<>|()\[\]{}#%&^$!`''~;,+=@\x00-\x1f]', '', 'g'), '-{2,}', '-', 'g'), '^[-. ]+|[-. ]+$', '', 'g'), 1, 80), '^[-. ]+|[-. ]+$', '', 'g') AS s
  FROM (SELECT page_id, regexp_replace(list_last(string_split(regexp_replace(url, '/+$', ''), '/')), '(.)\.[^.]+$', '\1') AS last FROM pages))""")
def safe_stem_of_url(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", N.safe_stem(F.col("url")).alias("stem"))


PART_SQL = "CAST(conv_id AS VARCHAR(20)) || '(' || chr(CAST(97 + turn % 20 AS INT)) || ')' || CASE WHEN turn % 3 = 2 THEN ' (ii)' ELSE '' END"


@query(rf"SELECT conv_id, turn, nullif(regexp_extract({PART_SQL}, '^(.+?)\s*\([^()]*\)\s*$', 1), '') AS parent, trim(split_part({PART_SQL}, '(', 1)) AS root FROM conversations")
def parent_id_of_part(spark, sf_dir):
    part = F.expr(PART_SQL)
    return read(spark, sf_dir, "conversations").select("conv_id", "turn", N.parent_of(part).alias("parent"), N.root_of(part).alias("root"))


@query(rf"SELECT doc_id, len(t) AS n, array_to_string(list_sort(list_distinct(t)), ', ') AS tokens FROM (SELECT doc_id, regexp_extract_all({MASKED_SQL}, '[a-zA-Z]\d+') AS t FROM documents) WHERE len(t) > 0")
def broken_power_tokens(spark, sf_dir):
    t = F.col("t")
    return read(spark, sf_dir, "documents").select("doc_id", T.broken_powers(F.col("text")).alias("t")).where(F.size(t) > 0).select("doc_id", F.size(t).cast("long").alias("n"), F.array_join(F.array_sort(F.array_distinct(t)), ", ").alias("tokens"))


@query(r"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents),
p AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id ORDER BY i) AS g, length(line) - length(replace(line, '|', '')) AS pipes FROM l WHERE contains(line, '|')),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, g ORDER BY i) AS n FROM p),
b AS (SELECT doc_id, g, count(DISTINCT pipes) = 1 AS steady, bool_or(n <= 2 AND regexp_matches(line, '^\s*\|?(\s*:?-{2,}:?\s*\|)+\s*:?-{2,}:?\s*\|?\s*$|^\s*\|(\s*:?-{2,}:?\s*\|)+\s*$')) AS sep FROM r GROUP BY doc_id, g HAVING count(*) >= 2)
SELECT doc_id, count(*) AS blocks, count(*) FILTER (WHERE (steady OR sep) AND NOT sep) AS malformed, bool_or(steady OR sep) AS looks_like_a_table FROM b GROUP BY doc_id""")
def pipe_table_blocks(spark, sf_dir):
    b = F.col("b")
    d = read(spark, sf_dir, "documents").select("doc_id", T.pipe_blocks(F.col("text")).alias("b")).where(F.size(b) > 0)
    return d.select("doc_id", F.size(b).cast("long").alias("blocks"), T.malformed_tables(b).cast("long").alias("malformed"), T.looks_like_a_table(b).alias("looks_like_a_table"))


TABLE_SQL = "'| a | b |' || chr(10) || '| --- | --- |' || chr(10) || '| ' || doc_id || ' |' || CASE WHEN doc_id % 3 = 0 THEN '' WHEN doc_id % 3 = 1 THEN ' x |' ELSE ' x | y | z |' END"


@query(f"SELECT doc_id, CAST(CASE doc_id % 3 WHEN 0 THEN 1 ELSE 2 END AS INT) AS spread FROM (SELECT doc_id, {TABLE_SQL} AS t FROM documents) WHERE doc_id % 3 <> 1")
def ragged_tables(spark, sf_dir):
    table = F.expr(TABLE_SQL.replace("chr(10)", "'\\n'"))
    d = read(spark, sf_dir, "documents").select("doc_id", T.ragged_tables(T.pipe_blocks(table)).alias("r")).where(F.size("r") > 0)
    return d.select("doc_id", F.array_max("r").alias("spread"))


LATEX_SQL = r"text || CASE doc_id % 4 WHEN 0 THEN ' \(\frac{1}{2}\) and \alpha' WHEN 1 THEN ' $x^{2}$ x_{10}' WHEN 2 THEN ' $$\beta$$' ELSE '' END"


@query(rf"""SELECT doc_id, array_to_string(loose, ' ') AS loose FROM (SELECT doc_id, list_concat(regexp_extract_all(t, '\\[a-zA-Z]{{2,}}'), regexp_extract_all(t, '[\^_]\{{[^}}\n]{{1,30}}\}}')) AS loose
FROM (SELECT doc_id, regexp_replace({LATEX_SQL}, '(?s)\\\(.*?\\\)|\$\$.*?\$\$|\$[^$\n]+\$', ' ', 'g') AS t FROM documents)) WHERE len(loose) > 0""")
def undelimited_latex(spark, sf_dir):
    k = F.col("doc_id") % 4
    text = F.concat("text", F.when(k == 0, F.lit(r" \(\frac{1}{2}\) and \alpha")).when(k == 1, F.lit(" $x^{2}$ x_{10}")).when(k == 2, F.lit(r" $$\beta$$")).otherwise(""))
    d = read(spark, sf_dir, "documents").select("doc_id", T.undelimited_latex(text).alias("l")).where(F.size("l") > 0)
    return d.select("doc_id", F.array_join("l", " ").alias("loose"))


@query(r"""WITH p AS (SELECT source, regexp_replace(text || CASE WHEN doc_id % 5 = 0 THEN ' – –' ELSE '' END, '(?s)\\\(.*?\\\)|\$\$.*?\$\$|\$[^$\n]+\$', ' ', 'g') AS t FROM documents),
s AS (SELECT source, CAST(sum(length(t) - length(replace(t, '-', ''))) AS BIGINT) AS hyphen, CAST(sum(length(t) - length(replace(t, '–', ''))) AS BIGINT) AS en_dash, CAST(sum(length(t) - length(replace(t, '−', ''))) AS BIGINT) AS minus FROM p GROUP BY source)
SELECT *, CAST(hyphen >= 3 AS INT) + CAST(en_dash >= 3 AS INT) + CAST(minus >= 3 AS INT) AS kinds FROM s""")
def dash_totals_per_source(spark, sf_dir):
    text = F.concat("text", F.when(F.col("doc_id") % 5 == 0, " – –").otherwise(""))
    return rules.dash_totals(read(spark, sf_dir, "documents").withColumn("t", text), "source", "t")


@query(f"SELECT doc_id, len(repeated) AS n, repeated[1] AS first FROM ({REPEATED_SQL})")
def repeated_sentences(spark, sf_dir):
    d = read(spark, sf_dir, "documents").select("doc_id", T.repeated_sentences(F.col("text"), ENDS).alias("r")).where(F.size("r") > 0)
    return d.select("doc_id", F.size("r").cast("long").alias("n"), F.get("r", F.lit(0)).alias("first"))


@query("""SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN 2 WHEN doc_id % 7 = 1 THEN 1 ELSE 0 END AS n, sha256(replace(replace(t, chr(12), '\\f'), chr(8), '\\b')) AS restored
FROM (SELECT doc_id, text || CASE doc_id % 7 WHEN 0 THEN ' ' || chr(12) || 'rac' || chr(8) || 'eta' WHEN 1 THEN chr(8) || 'ar' ELSE '' END AS t FROM documents)""".replace("\\\\", "\\"))
def control_chars(spark, sf_dir):
    k = F.col("doc_id") % 7
    text = F.concat("text", F.when(k == 0, F.concat(F.lit(" \x0crac\x08eta"))).when(k == 1, F.lit("\x08ar")).otherwise(""))
    return read(spark, sf_dir, "documents").select("doc_id", F.size(T.control_characters(text)).alias("n"), F.sha2(T.restore_backslashes(text)["text"], 256).alias("restored"))


OPTIONS_SQL = "text || CASE doc_id % 3 WHEN 0 THEN chr(10) || 'A. x' || chr(10) || '(B) y' || chr(10) || ' C、 z' WHEN 1 THEN chr(10) || 'A. x' || chr(10) || 'A. y' || chr(10) || 'B. z' ELSE '' END"


@query(rf"SELECT doc_id, len(list_distinct(regexp_extract_all({OPTIONS_SQL}, '(?m)^\s*\(?([A-D])[.)、．]\s', 1))) >= 3 AS multiple_choice FROM documents")
def multiple_choice_shape(spark, sf_dir):
    text = F.expr(OPTIONS_SQL.replace("chr(10)", "'\\n'"))
    return read(spark, sf_dir, "documents").select("doc_id", T.looks_like_multiple_choice(text).alias("multiple_choice"))


CUE_SQL = "text || CASE doc_id % 5 WHEN 0 THEN ' Hence use the sine rule.' WHEN 1 THEN ' 利用配方法,由此' WHEN 2 THEN ' by  Elimination' ELSE '' END"


@query(rf"SELECT doc_id, len(regexp_extract_all({CUE_SQL}, '(?i){'|'.join(f'(?:{p})' for p in X.METHOD_CUES)}', 0)) AS cues FROM documents")
def method_cue_hits(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", F.size(T.method_cues(F.expr(CUE_SQL))).cast("long").alias("cues"))


def text_issues(spark, sf_dir) -> DataFrame:
    """Three row-local rules in one projection."""
    text = F.col("text")
    d = read(spark, sf_dir, "documents").withColumns({"r": T.repeated_sentences(text, ENDS), "b": T.broken_powers(text), "h": T.dash_counts(text)["hyphen"]})
    found = [
        rules.issue("REPEATED_TEXT_IN_QUESTION", "medium", F.size("r") > 0, F.lit("repeats text"), 1),
        rules.issue("POSSIBLE_BROKEN_POWER", "medium", F.size("b") > 0, F.lit("broken power"), 2),
        rules.issue("HYPHEN_IN_PROSE", "low", F.col("h") > 0, F.lit("hyphen"), 3),
    ]
    return rules.exploded(d, found, F.col("doc_id").cast("string"), "source")


ISSUES_SQL = rf"""
WITH r AS ({REPEATED_SQL}), i AS (
  SELECT source AS doc, 'REPEATED_TEXT_IN_QUESTION' AS issue_code, 'medium' AS severity, CAST(doc_id AS VARCHAR) AS source_question_id FROM documents JOIN r USING (doc_id)
  UNION ALL SELECT source, 'POSSIBLE_BROKEN_POWER', 'medium', CAST(doc_id AS VARCHAR) FROM documents WHERE len(regexp_extract_all({MASKED_SQL}, '[a-zA-Z]\d+')) > 0
  UNION ALL SELECT source, 'HYPHEN_IN_PROSE', 'low', CAST(doc_id AS VARCHAR) FROM documents WHERE contains(regexp_replace(text, '(?s)\\\(.*?\\\)|\$\$.*?\$\$|\$[^$\n]+\$', ' ', 'g'), '-'))"""


@query(ISSUES_SQL + " SELECT * FROM i")
def issues_union_long(spark, sf_dir):
    return text_issues(spark, sf_dir).select("doc", "issue_code", "severity", "source_question_id")


@query(ISSUES_SQL + " SELECT severity, count(*) AS n FROM i GROUP BY severity")
def severity_histogram(spark, sf_dir):
    return stats.severity_histogram(text_issues(spark, sf_dir))


@query(ISSUES_SQL + " SELECT doc, source_question_id, count(*) AS n FROM i GROUP BY doc, source_question_id ORDER BY n DESC, CAST(source_question_id AS BIGINT) LIMIT 15")
def worst_questions_topk(spark, sf_dir):
    counts = text_issues(spark, sf_dir).groupBy("doc", "source_question_id").agg(F.count(F.lit(1)).alias("n")).withColumn("position", F.col("source_question_id").cast("long"))
    return stats.top_k(counts, "n", ["position"], 15).drop("position")


@query("SELECT conv_id, turn, lag(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS previous FROM conversations")
def previous_part_lag(spark, sf_dir):
    return repairs.with_previous_part(read(spark, sf_dir, "conversations").select("conv_id", "turn"), ["conv_id"], "turn", "turn")


@query("SELECT CAST(conv_id AS VARCHAR) AS parent, count(*) AS parts, arg_min(role, turn) AS first_role FROM conversations GROUP BY conv_id HAVING count(*) >= 2")
def sibling_groups_having(spark, sf_dir):
    c = read(spark, sf_dir, "conversations").select(F.lit("d").alias("doc"), F.concat("conv_id", F.lit("("), "turn", F.lit(")")).alias("source_question_id"), F.col("turn").alias("position"), F.col("role").alias("question_text"))
    g = repairs.sibling_groups(c)
    return g.select("parent", F.size("parts").cast("long").alias("parts"), F.col("parts")[0]["question_text"].alias("first_role"))


@query("""SELECT 'd' AS doc, CAST(conv_id AS VARCHAR) AS parent, 'What is said in turn 0 of it' AS removed, conv_id || '(0)' AS owner, 'Read the talk。' AS keep, string_agg(conv_id || '(' || turn || ')', ',' ORDER BY turn) AS question_ids
FROM conversations GROUP BY conv_id HAVING count(*) >= 2 AND min(turn) = 0""")
def stem_contamination(spark, sf_dir):
    """Turns of a conversation as parts that all start with a stem ending in the first turn's own question."""
    c = read(spark, sf_dir, "conversations")
    own = F.concat(F.lit("What is said in turn "), "turn", F.lit(" of it？"))
    q = c.select(F.lit("d").alias("doc"), F.concat("conv_id", F.lit("("), "turn", F.lit(")")).alias("source_question_id"), F.col("turn").alias("position"), F.concat(F.lit("Read the talk。 What is said in turn 0 of it？"), own).alias("question_text"))
    return repairs.stem_contamination(q).select("doc", "parent", "removed", "owner", "keep", F.array_join("question_ids", ",").alias("question_ids"))


ANSWER_SQL = r"""CASE l_orderkey % 5 WHEN 0 THEN '\(\frac{' || q || '}{' || l_linenumber || '}\)' WHEN 1 THEN 'x = ' || q || ' cm' WHEN 2 THEN '(' || chr(CAST(65 + q % 4 AS INT)) || ') ' || q WHEN 3 THEN ' ' WHEN 4 THEN '$' || q || '.50$。' END"""


@query(rf"""SELECT l_orderkey, l_linenumber, CASE l_orderkey % 5 WHEN 0 THEN printf('%.6g', CAST(q AS DOUBLE) / l_linenumber) WHEN 1 THEN printf('%.6g', CAST(q AS DOUBLE)) WHEN 2 THEN chr(CAST(65 + q % 4 AS INT)) WHEN 4 THEN printf('%.6g', q + 0.5) END AS answer
FROM (SELECT *, CAST(l_quantity AS INT) AS q FROM lineitem)""")
def normalise_answer_cases(spark, sf_dir):
    q, k, n = F.col("l_quantity").cast("int"), F.col("l_orderkey") % 5, F.col("l_linenumber")
    text = F.when(k == 0, F.concat(F.lit(r"\(\frac{"), q, F.lit("}{"), n, F.lit(r"}\)"))).when(k == 1, F.concat(F.lit("x = "), q, F.lit(" cm"))).when(k == 2, F.concat(F.lit("("), F.chr(65 + q % 4), F.lit(") "), q)).when(k == 3, F.lit(" ")).otherwise(F.concat(F.lit("$"), q, F.lit(".50$。")))
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", T.normalise_answer(text).alias("answer"))


@query("""SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 7 = 0 THEN NULL WHEN q = r THEN TRUE WHEN (length(CAST(q AS VARCHAR)) = 1) <> (length(CAST(r AS VARCHAR)) = 1) THEN NULL ELSE FALSE END AS verdict
FROM (SELECT *, CAST(l_quantity AS INT) AS q, CAST(l_quantity AS INT) % 13 + 1 AS r FROM lineitem)""")
def answers_match_three_valued(spark, sf_dir):
    q = F.col("l_quantity").cast("int")
    given = F.when(F.col("l_orderkey") % 7 == 0, "").otherwise(q.cast("string"))
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", T.answers_match(given, (q % 13 + 1).cast("string")).alias("verdict"))


@query("""SELECT l_orderkey, array_to_string(list_sort(list(DISTINCT printf('%.6g', CAST(l_quantity AS DOUBLE)))), ',') AS answers FROM lineitem GROUP BY l_orderkey HAVING count(DISTINCT l_quantity) > 1""")
def strategies_disagree(spark, sf_dir):
    answers = read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_set(T.normalise_answer(F.col("l_quantity").cast("string")))).alias("a"))
    return answers.where(F.size("a") > 1).select("l_orderkey", F.array_join("a", ",").alias("answers"))
