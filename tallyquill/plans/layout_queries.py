"""Stitching of rows: the sentences of each document, set as a printed table of three columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyquill.operators import layout
from tallyquill.plans.registry import query, read

SENTENCES_SQL = """s AS (SELECT doc_id AS part, generate_subscripts(l, 1) - 1 AS k, coalesce(nullif(trim(regexp_replace(unnest(l), '[^A-Za-z]+', ' ', 'g')), ''), 'none') AS t FROM (SELECT doc_id, string_split(text, '.') AS l FROM documents))"""


def pieces(spark, sf_dir):
    """Forty sentences a page from the top down; every third starts an objective, every sixth stands beside a unit."""
    s = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("part"), F.posexplode(F.split("text", r"\.")).alias("k", "t")).withColumn("t", F.coalesce(F.nullif(F.trim(F.regexp_replace("t", "[^A-Za-z]+", " ")), F.lit("")), F.lit("none")))
    k = F.col("k")
    at = [
        (F.lit(True), 120.0, F.col("t")), (k % 3 == 0, 100.0, F.concat(F.floor(k / 6), F.lit("."), k)), (k % 6 == 0, 10.0, F.concat(F.floor(k / 6), F.lit(". Unit"))),
        (k % 3 == 1, 300.0, F.concat(k, F.lit(" hours"))), (k % 4 == 1, 400.0, F.concat(F.lit("see "), k)), (k == 0, 300.0, F.lit("Time")), (k == 0, 400.0, F.lit("Remarks")),
    ]
    each = F.explode(F.array_compact(F.array(*(F.when(on, F.struct(F.lit(x).alias("x"), text.alias("text"))) for on, x, text in at))))
    # the marks of the columns stand above the first row
    return s.select("part", "k", each.alias("p")).select("part", F.floor(k / 40).cast("int").alias("page"), "p.x", (700.0 - F.when(F.col("p.text").isin("Time", "Remarks"), -10).otherwise(k % 40 * 12)).alias("y"), "p.text")


@query(f"""WITH {SENTENCES_SQL} SELECT part, (k // 3 // 2) || '.' || (k // 3 * 3) AS obj, CAST(k // 3 // 2 AS VARCHAR) AS unit_no, string_agg(t, ' ' ORDER BY k) AS text,
min(CASE WHEN k % 3 = 1 THEN k || ' hours' END) AS time, coalesce(string_agg(CASE WHEN k % 4 = 1 THEN 'see ' || k END, ' ' ORDER BY k), '') AS remarks, CAST(arg_min(k, k) // 40 AS INT) AS page FROM s GROUP BY part, k // 3""")
def stitched_objectives(spark, sf_dir):
    return layout.objectives(pieces(spark, sf_dir))
