"""Checks of hand-made ratings against the vocabularies."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyquill.functions import fixed as X


def validate_gold(gold: DataFrame, skills: DataFrame, errors: DataFrame) -> DataFrame:
    """(problem) of ratings (question_key, R..E, skills, errors, status): repeated keys, levels out of range,
    unknown skills and errors, unknown states, ratings without skills; each once, sorted."""
    key = F.col("question_key")

    def told(rows: DataFrame, text: str, *args: Column) -> DataFrame:
        return rows.select(F.format_string(text, *args).alias("problem"))

    levels = gold.select(key, F.explode(F.array(*(F.struct(F.lit(d).alias("d"), F.col(d).alias("level")) for d in X.DIMENSIONS))).alias("x")).select(key, "x.*")

    def unknown(column: str, vocabulary: DataFrame, id_col: str) -> DataFrame:
        named = gold.select(key, F.explode(column).alias("id"))
        return named.join(vocabulary.select(F.col(id_col).alias("id")).distinct(), "id", "left_anti")

    found = [
        told(gold.groupBy(key).count().where("count > 1"), "%s is rated more than once", key),
        told(levels.where(~F.col("level").between(0, X.MOST_LEVEL)), f"%s: %s = %d, not 0-{X.MOST_LEVEL}", key, F.col("d"), F.col("level")),
        told(unknown("skills", skills, "skill_id"), "%s: skill %s does not exist", key, F.col("id")),
        told(unknown("errors", errors, "error_id"), "%s: error %s does not exist", key, F.col("id")),
        told(gold.where(~F.col("status").isin("draft", "confirmed")), "%s: status '%s' is not draft or confirmed", key, F.col("status")),
        told(gold.where(F.size("skills") == 0), "%s: no skills", key),
    ]
    return reduce(DataFrame.unionByName, found).distinct().orderBy("problem")


def scorecard_means(each: DataFrame) -> DataFrame:
    """compared, mean_skill_overlap, mean_error_overlap of the overlaps per question; 0 of none."""
    return each.agg(F.count(F.lit(1)).alias("compared"), *(F.coalesce(F.avg(c), F.lit(0.0)).alias(f"mean_{c}") for c in ("skill_overlap", "error_overlap")))
