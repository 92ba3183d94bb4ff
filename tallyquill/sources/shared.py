"""The folder that all executors share."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir. Where it is unset, as in tests, a folder of this machine if the whole session is
    on it, else an error: on a cluster each machine would hold another part of the rows."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir is not set: intermediate tables need a folder that all executors share")
    return os.path.join(tempfile.gettempdir(), "tallyquill")


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A folder below the shared one that nothing else uses."""
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """df checkpointed to the session's folder."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()


def stored(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder, for steps that read it more than once: columns are pruned, and a lost
    executor costs only its own tasks."""
    path = fresh_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
