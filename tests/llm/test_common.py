import time

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallyquill.llm import ngram_join
from tallyquill.llm.common import CLEANUP, written


def shuffle_files(spark):
    """Names of the shuffle files on this machine."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (files.apply(i).getName() for i in range(files.size()))
    return {n for n in names if n.startswith("shuffle_") and n.endswith(".data")}


def left_after(spark, before):
    """Shuffle files that are new and still there some seconds later (Spark removes them in the background)."""
    for _ in range(50):
        if not (new := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    return new


def test_a_written_table_leaves_no_shuffle_files(spark):
    before, was = shuffle_files(spark), spark.conf.get(CLEANUP, None)
    rows = spark.range(10_000).withColumn("k", F.col("id") % 7)
    sums = rows.groupBy("k").agg(F.sum("id").alias("s"))
    table = written(rows.join(sums.hint("merge"), "k"), "sums")
    assert left_after(spark, before) == set()
    assert table.count() == 10_000 and spark.conf.get(CLEANUP, None) == was


@pytest.mark.parametrize("value", ["true", "false"])
def test_the_session_keeps_its_own_setting(spark, value):
    try:
        spark.conf.set(CLEANUP, value)
        written(spark.range(3), "three")
        assert spark.conf.get(CLEANUP) == value
        with pytest.raises(PySparkException):
            written(spark.range(3).select(F.raise_error(F.lit("no")).cast("long").alias("x")), "none")
        assert spark.conf.get(CLEANUP) == value
    finally:
        spark.conf.unset(CLEANUP)


def test_steps_of_the_join_do_not_keep_the_files_of_those_before(spark, sf, monkeypatch):
    """When the common shingles are told, or a step of the n-gram join is written, none of its shuffle files stay
    beside the next one's."""
    kept = {}

    def watched(name):
        step = getattr(ngram_join, name)

        def run(df, *args):
            before = shuffle_files(spark)
            out = step(df, *args)
            kept[args[0] if name == "written" else name] = left_after(spark, before)
            return out

        monkeypatch.setattr(ngram_join, name, run)

    watched("written")
    watched("common_shingles")
    ngram_join.near_duplicates(spark.read.parquet(f"{sf}/documents.parquet"))
    assert {"common_shingles", "hot", "members", "groups", "texts"} <= set(kept) and not any(kept.values())
