"""Tables on printed pages, stitched from pieces of text with positions.

pieces: part, page, x, y, text; y grows upwards. Columns are found by where their marks stand most often, rows by
rounded height, and what belongs to an objective by carrying its number forward from row to row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLACK = 2.0  # how far left of its column a piece may stand
OBJECTIVE, UNIT = r"^(\d+\.\d+)\s+(.*)$", r"^(\d+)\s*\.\s*(\S.*)$"


def column_places(pieces: DataFrame) -> DataFrame:
    """(part, xo, xt, xr): the commonest x of objective numbers, of Time and of Remarks; of several the leftmost."""
    kind = F.when(F.col("text").rlike(r"^\d+\.\d+$"), "xo").when(F.col("text") == "Time", "xt").when(F.col("text") == "Remarks", "xr")
    counts = pieces.select("part", "x", kind.alias("kind")).where("kind is not null").groupBy("part", "kind", "x").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("part", "kind").agg(F.min_by("x", F.struct(-F.col("n"), F.col("x"))).alias("x"))
    return best.groupBy("part").agg(*(F.max(F.when(F.col("kind") == k, F.col("x"))).alias(k) for k in ("xo", "xt", "xr")))


def page_rows(pieces: DataFrame) -> DataFrame:
    """(part, page, line, unit, objective, time, remarks): the pieces of a row, joined by band from left to right."""
    x = F.col("x")
    band = F.when(x >= F.col("xr") - SLACK, "remarks").when(x >= F.col("xt") - SLACK, "time").when(x >= F.col("xo") - SLACK, "objective").otherwise("unit")
    placed = pieces.join(column_places(pieces), "part").withColumns({"band": band, "line": F.bround("y").cast("long")})

    def joined(name: str) -> Column:
        own = F.array_sort(F.collect_list(F.when(F.col("band") == name, F.struct("x", "text"))))
        return F.trim(F.regexp_replace(F.array_join(F.transform(own, lambda p: p["text"]), " "), r"\s+", " ")).alias(name)

    return placed.groupBy("part", "page", "line").agg(*map(joined, ("unit", "objective", "time", "remarks")))


def objectives(pieces: DataFrame) -> DataFrame:
    """part, obj, unit_no, text, time, remarks, page of every numbered objective: rows below it up to the next one
    continue its text and remarks, the first time given is its own, and the unit's name is carried down to it.
    A part is read in one order, so its rows meet in one task: parts are documents."""
    rows = page_rows(pieces).where(~F.col("unit").startswith("Learning Unit") & ~F.col("objective").startswith("Learning Objective"))
    down = Window.partitionBy("part").orderBy("page", F.desc("line"))
    starts = F.regexp_extract("objective", OBJECTIVE, 1)
    rows = rows.withColumns({"own": F.when(starts != "", starts), "nth": F.row_number().over(down), "heading": F.when(F.col("unit").rlike(UNIT), F.regexp_extract("unit", UNIT, 1))})
    rows = rows.withColumns({"start": F.last(F.when(F.col("own").isNotNull(), F.col("nth")), ignorenulls=True).over(down), "unit_no": F.last("heading", ignorenulls=True).over(down)})
    rows = rows.where("start is not null").withColumn("said", F.when(F.col("own").isNotNull(), F.regexp_extract("objective", OBJECTIVE, 2)).otherwise(F.col("objective")))

    def below(c: str) -> Column:
        lines = F.array_sort(F.collect_list(F.when(F.col(c) != "", F.struct("nth", F.col(c).alias("t")))))
        return F.array_join(F.transform(lines, lambda p: p["t"]), " ")

    first = F.min_by("time", F.when(F.col("time") != "", F.col("nth")))
    own = F.col("nth") == F.col("start")
    return rows.groupBy("part", "start").agg(F.max("own").alias("obj"), F.max(F.when(own, F.col("unit_no"))).alias("unit_no"), below("said").alias("text"), first.alias("time"), below("remarks").alias("remarks"), F.max(F.when(own, F.col("page"))).alias("page")).drop("start")
