"""What the operators share: written intermediate tables and text clean-up."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyquill.sources.shared import shared_dir

HOT_KEYS = 1000  # a key is hot if it holds more than this part of all rows, so there are fewer hot keys
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries made and run within remove their shuffle files when they end. Otherwise these stay until the driver
    happens to collect garbage, beside those of the steps that follow."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def written(df: DataFrame, name: str, path_too: bool = False) -> DataFrame | tuple[DataFrame, str]:
    """Write df as Parquet in the shared folder and read it back: lineage ends there, and a lost
    executor costs no more than its own tasks. Nothing reads the write's shuffles again, so they go when it ends.
    The folder carries the application's id; ``remove_written`` removes it when the job's results are stored,
    ``removed`` a single table before that."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    with shuffles_removed(spark):
        df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    return (back, path) if path_too else back


def join_hot(rows: DataFrame, small: DataFrame, hot: DataFrame, keys: list[str], spread: str) -> DataFrame:
    """rows joined with the one row that ``small`` has for each of their keys, which are not null.

    ``hot`` holds those rows of small whose keys hold more than 1 in HOT_KEYS of all rows: fewer than
    HOT_KEYS, so they are broadcast. Rows with such keys are dealt by the column ``spread`` in the join with
    the rest, where they find nothing; no task gets all rows of a key that grows with the input.
    """
    new = [c for c in small.columns if c not in keys]
    known = hot.select(*keys, F.struct(*new).alias("__hot"))
    j = rows.join(F.broadcast(known), keys, "left").withColumn("__salt", F.when(F.col("__hot").isNotNull(), F.xxhash64(spread)))
    rest = small.select(*keys, F.struct(*new).alias("__rest"), F.lit(0).cast("long").alias("__of"))
    on = [F.col(f"l.{k}") == F.col(f"r.{k}") for k in keys]
    j = j.alias("l").join(rest.alias("r"), [*on, F.coalesce("l.__salt", F.lit(0)) == F.col("r.__of")], "left")
    found = F.coalesce("l.__hot", "r.__rest")
    return j.where(found.isNotNull()).select(*(F.col(f"l.{c}") for c in rows.columns), *(found[c].alias(c) for c in new))


def removed(spark: SparkSession, path: str) -> None:
    """Remove a written table that nothing reads any more."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def remove_written(spark: SparkSession) -> None:
    """Remove the tables that this application has written: after its results are stored, not before."""
    removed(spark, f"{shared_dir(spark)}/{spark.sparkContext.applicationId}")


def unused(name: str, taken: list[str]) -> str:
    """A column name that is not taken, in any case of letters."""
    while name.lower() in {t.lower() for t in taken}:
        name += "_"
    return name


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
