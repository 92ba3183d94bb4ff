"""Queries over vocabularies and hierarchies. ``part`` types stand for skills, regions, nations and
suppliers for prerequisites."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyquill.operators import cycles, taxonomy
from tallyquill.plans.registry import query, read

#: Error patterns of the fixture: id and entries.
ERRORS = (("err.any.round", ["*"]), ("err.promo.sign", ["promo.*"]), ("err.one.slip", ["promo.brand-1.s1", "small.brand-2.s0", "economy.brand-3.s2"]), ("err.none.at", ["absent.unit.slug", "standard.*"]))
ERRORS_SQL = "(VALUES " + ", ".join(f"('{e}', [{', '.join(repr(s) for s in skills)}])" for e, skills in ERRORS) + ") e(error_id, skills)"
SKILL_SQL = "(SELECT DISTINCT lower(p_type) || '.' || lower(replace(p_brand, '#', '-')) || '.s' || (p_size % 3) AS skill_id FROM part)"


def error_patterns(spark):
    return spark.createDataFrame([(e, s) for e, s in ERRORS], "error_id string, skills array<string>")


def skill_ids(spark, sf_dir):
    return read(spark, sf_dir, "part").select(F.concat_ws(".", F.lower("p_type"), F.lower(F.translate("p_brand", "#", "-")), F.concat(F.lit("s"), F.col("p_size") % 3)).alias("skill_id")).distinct()


@query(f"""SELECT DISTINCT s.skill_id, x.error_id, x.general FROM {SKILL_SQL} s, (SELECT error_id, unnest(skills) AS entry, len(list_filter(skills, lambda z: regexp_matches(z, '^(\\*|(na|ms|dh|fl|m1|m2)\\.\\*)$'))) > 0 AS general FROM {ERRORS_SQL}) x
WHERE x.entry = '*' OR x.entry = s.skill_id OR (x.entry LIKE '%.*' AND starts_with(s.skill_id, left(x.entry, length(x.entry) - 1)))""")
def wildcard_scope_join(spark, sf_dir):
    return taxonomy.errors_of_skills(skill_ids(spark, sf_dir), error_patterns(spark))


EDGES_SQL = """e AS (SELECT 's' || s_suppkey AS node, 'n' || s_nationkey AS next FROM supplier UNION SELECT 'n' || n_nationkey, 'r' || n_regionkey FROM nation UNION SELECT 'r' || r_regionkey, 'r' || (r_regionkey + 1) % 3 FROM region WHERE r_regionkey < 3)"""


def edges(spark, sf_dir):
    s = read(spark, sf_dir, "supplier").select(F.concat(F.lit("s"), "s_suppkey").alias("node"), F.concat(F.lit("n"), "s_nationkey").alias("next"))
    n = read(spark, sf_dir, "nation").select(F.concat(F.lit("n"), "n_nationkey").alias("node"), F.concat(F.lit("r"), "n_regionkey").alias("next"))
    r = read(spark, sf_dir, "region").where("r_regionkey < 3").select(F.concat(F.lit("r"), "r_regionkey").alias("node"), F.concat(F.lit("r"), (F.col("r_regionkey") + 1) % 3).alias("next"))
    return s.unionByName(n).unionByName(r)


CLOSURE_SQL = f"""WITH RECURSIVE {EDGES_SQL}, c AS (SELECT node AS start, next AS reached, 1 AS depth, [next] AS path FROM e UNION ALL
SELECT c.start, e.next, depth + 1, list_append(path, e.next) FROM c JOIN e ON c.reached = e.node WHERE NOT list_contains(path, e.next))"""


@query(CLOSURE_SQL + " SELECT start, reached, CAST(min(depth) AS INT) AS depth FROM c GROUP BY start, reached")
def closure_region_hierarchy(spark, sf_dir):
    return taxonomy.closure(edges(spark, sf_dir))


@query(CLOSURE_SQL + " SELECT start AS node, CAST(min(depth) AS INT) AS length FROM c WHERE start = reached GROUP BY start")
def prerequisite_cycles(spark, sf_dir):
    return taxonomy.cycles(edges(spark, sf_dir))


#: Suppliers as skills that rest on one or two others, with cycles of several lengths.
RESTS_SQL = """e AS (SELECT s_suppkey AS node, (s_suppkey * 3 + s_nationkey) % (SELECT count(*) FROM supplier) AS next FROM supplier UNION SELECT s_suppkey, s_suppkey // 2 FROM supplier WHERE s_suppkey % 4 = 0),
reach AS (SELECT node AS a, next AS b FROM e UNION SELECT a, next FROM reach JOIN e ON b = node),
comp AS (SELECT x.a AS node, min(y.a) AS component FROM reach x JOIN reach y ON x.b = y.a AND y.b = x.a AND x.a = y.b WHERE EXISTS (SELECT 1 FROM reach z WHERE z.a = x.a AND z.b = x.a) GROUP BY x.a)"""


def rests(spark, sf_dir):
    s = read(spark, sf_dir, "supplier")
    n, k = s.count(), F.col("s_suppkey")
    one = s.select(k.alias("node"), ((k * 3 + F.col("s_nationkey")) % n).alias("next"))
    return one.unionByName(s.where(k % 4 == 0).select(k.alias("node"), F.floor(k / 2).alias("next")))


@query(f"""WITH RECURSIVE {RESTS_SQL}, i AS (SELECT e.node, e.next, a.component FROM e JOIN comp a ON a.node = e.node JOIN comp b ON b.node = e.next AND a.component = b.component),
d AS (SELECT DISTINCT component, component AS node, 0 AS depth FROM comp UNION SELECT d.component, i.node, depth + 1 FROM d JOIN i ON i.component = d.component AND i.next = d.node WHERE depth < 60),
m AS (SELECT component, node, min(depth) AS dist FROM d GROUP BY ALL), l AS (SELECT component, min(dist) + 1 AS length FROM m JOIN i USING (component) WHERE i.node = component AND i.next = m.node GROUP BY component),
p AS (SELECT component, component AS here, length AS togo, CAST(component AS VARCHAR) AS path, length FROM l
  UNION ALL SELECT component, here, togo - 1, path || ' -> ' || here, length FROM (SELECT p.component, p.togo, p.path, p.length, min(i.next) AS here FROM p JOIN i ON i.component = p.component AND i.node = p.here JOIN m ON m.component = p.component AND m.node = i.next AND m.dist = p.togo - 1 WHERE togo > 0 GROUP BY ALL))
SELECT component, CAST(length AS INT) AS length, path FROM p WHERE togo = 0""")
def cycle_paths(spark, sf_dir):
    """One shortest cycle of each strongly connected component."""
    return cycles.cycle_paths(rests(spark, sf_dir))


@query(f"WITH RECURSIVE {RESTS_SQL} SELECT node, component FROM comp")
def cycle_components(spark, sf_dir):
    return cycles.components_on_cycles(rests(spark, sf_dir))


@query("SELECT c_custkey AS ref FROM customer WHERE c_nationkey % 5 <> 0 AND c_custkey NOT IN (SELECT user_id FROM events)")
def uncovered_antijoin(spark, sf_dir):
    """Customers as objectives, users of events as what skills refer to."""
    objectives = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("ref"), F.when(F.col("c_nationkey") % 5 == 0, "enrichment").otherwise("foundation").alias("status"))
    skills = read(spark, sf_dir, "events").select(F.array("user_id").alias("guide_ref"))
    return taxonomy.uncovered_objectives(objectives, skills).select("ref")


#: Ids of which some tails (unit and slug) belong to one skill and some to several.
TAILED_SQL = "(SELECT DISTINCT lower(p_type) || '.' || lower(replace(p_brand, '#', '-')) || '.s' || (p_partkey % 499) AS skill_id FROM part)"


@query(f"""WITH k AS {TAILED_SQL}, w AS (SELECT DISTINCT 'zz' || substr(skill_id, instr(skill_id, '.')) AS wrong FROM k)
SELECT wrong, min(skill_id) AS skill_id FROM w JOIN k ON substr(wrong, instr(wrong, '.')) = substr(skill_id, instr(skill_id, '.')) WHERE len(string_split(wrong, '.')) = 3 GROUP BY wrong HAVING count(*) = 1""")
def unique_suffix_match(spark, sf_dir):
    part = read(spark, sf_dir, "part")
    known = part.select(F.concat_ws(".", F.lower("p_type"), F.lower(F.translate("p_brand", "#", "-")), F.concat(F.lit("s"), F.col("p_partkey") % 499)).alias("skill_id")).distinct()
    wrong = known.select(F.concat(F.lit("zz."), F.expr("substring_index(skill_id, '.', -2)")).alias("wrong"))
    return taxonomy.unique_suffix(wrong, known)


@query(f"""WITH k AS {TAILED_SQL}, t AS (SELECT substr(skill_id, instr(skill_id, '.')) AS tail, count(*) AS n FROM k GROUP BY 1),
p AS (SELECT p_partkey, lower(p_type) || '.' || lower(replace(p_brand, '#', '-')) || '.s' || (p_partkey % 499) AS skill_id FROM part)
SELECT p_partkey, CASE WHEN n = 1 THEN skill_id ELSE skill_id || ',zz' || tail END AS skills FROM p JOIN t ON tail = substr(skill_id, instr(skill_id, '.'))""")
def repaired_part_ids(spark, sf_dir):
    """Each part's skill, listed twice and once under a wrong strand, which is mended where unit and slug are one skill's."""
    skill = F.concat_ws(".", F.lower("p_type"), F.lower(F.translate("p_brand", "#", "-")), F.concat(F.lit("s"), F.col("p_partkey") % 499))
    rows = read(spark, sf_dir, "part").select("p_partkey", skill.alias("skill_id"))
    wrong = F.concat(F.lit("zz."), F.expr("substring_index(skill_id, '.', -2)"))
    listed = rows.select("p_partkey", F.array("skill_id", wrong, "skill_id").alias("atomic_skills"))
    return taxonomy.repair_skill_ids(listed, rows.select("skill_id").distinct()).select("p_partkey", F.array_join("atomic_skills", ",").alias("skills"))
