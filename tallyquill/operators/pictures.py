"""Which pictures a document's questions need, as rows; drawing them needs a PDF rasteriser."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyquill.functions import names as N
from tallyquill.functions import texts as T


def asset_name(qid: Column, kind: Column, index: Column) -> Column:
    """'17-a.png' of a diagram, '17-a-table-1.png' of a question's first table."""
    stem = N.safe_asset_name(qid)
    return F.when(kind == "diagram", F.concat(stem, F.lit(".png"))).otherwise(F.format_string("%s-table-%d.png", stem, index + 1))


def planned_images(questions: DataFrame) -> DataFrame:
    """questions (doc, position, source_question_id, diagram_required, diagram_region, table_regions) -> a row
    for each picture: kind, index, region, file; the diagram first, then the tables in order."""
    keys = ["doc", "position", "source_question_id"]
    region = "struct<page:int,y_min:int,x_min:int,y_max:int,x_max:int>"
    diagrams = questions.where("diagram_required").select(*keys, F.lit("diagram").alias("kind"), F.lit(0).alias("index"), F.col("diagram_region").cast(region).alias("region"))
    tables = questions.select(*keys, F.posexplode("table_regions").alias("index", "region")).select(*keys, F.lit("table").alias("kind"), "index", F.col("region").cast(region).alias("region"))
    return diagrams.unionByName(tables).withColumn("file", asset_name(F.col("source_question_id"), F.col("kind"), F.col("index")))


def crop_plan(planned: DataFrame, pages: DataFrame) -> DataFrame:
    """planned with the page to draw and the pixels to cut: the padded box of a usable region, else the whole
    page. pages: doc, page, width, height in pixels; page_start is drawn where a region names no page."""
    usable = T.is_usable_region(F.col("region"))
    p = planned.withColumn("cropped", usable).withColumn("page", F.coalesce(F.col("region")["page"], F.lit(1)))
    j = p.join(pages, ["doc", "page"])
    whole = F.struct(F.lit(0).alias("left"), F.lit(0).alias("top"), F.col("width").cast("int").alias("right"), F.col("height").cast("int").alias("bottom"))
    return j.withColumn("box", F.when(F.col("cropped"), T.crop_box(F.col("region"), F.col("width"), F.col("height"))).otherwise(whole))


def with_images(questions: DataFrame, images: DataFrame) -> DataFrame:
    """questions with the diagram and the tables (in order) that were drawn for each, null and empty where none."""
    own = images.groupBy("doc", "source_question_id").agg(
        F.max(F.when(F.col("kind") == "diagram", F.col("image_path"))).alias("diagram"),
        F.transform(F.array_sort(F.collect_list(F.when(F.col("kind") == "table", F.struct("index", "image_path")))), lambda x: x["image_path"]).alias("tables"),
    )
    j = questions.join(own, ["doc", "source_question_id"], "left")
    return j.withColumn("tables", F.coalesce("tables", F.expr("cast(array() as array<string>)")))


def images_by_question(images: DataFrame, doc: str = "doc") -> DataFrame:
    """(doc, id, images): a question's pictures in one array, by kind and index."""
    return images.groupBy(doc, "source_question_id").agg(F.array_sort(F.collect_list(F.struct("kind", "index"))).alias("images"))
