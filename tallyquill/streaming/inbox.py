"""The inbox as an incremental file source: each trigger takes what is new, then stops.

What was taken is remembered by the stream itself: the source's log knows files, the state store, keyed by content
hash, knows contents. The table is only appended to and never read, so a trigger costs what arrives, however much
is stored. Source log, state and the sink's log are one checkpoint: a run that dies starts again where its
last completed batch ended, and a batch written twice is in the table once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",  # a trigger writes what it adds
}


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Streams started within keep their state in RocksDB: keys are not held on the heap."""
    before = {k: spark.conf.get(k, None) for k in STATE}
    for k, v in STATE.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def arrivals(spark: SparkSession, inbox: str, schema: str, format: str = "json", files_per_batch: int | None = None) -> DataFrame:
    """Rows of the inbox's files, of all folders in it, as they come."""
    stream = spark.readStream.schema(schema).format(format).option("recursiveFileLookup", True)
    if files_per_batch:
        stream = stream.option("maxFilesPerTrigger", files_per_batch)
    return stream.load(inbox)


def ingest(spark: SparkSession, inbox: str, table: str, checkpoint: str, schema: str, key: str, prepare: Callable[[DataFrame], DataFrame] = lambda df: df, format: str = "json", files_per_batch: int | None = None) -> StreamingQuery:
    """Everything in the inbox not seen before goes through ``prepare`` and is appended to the table, the first of
    each key. Returns the ended query when all is done."""
    rows = prepare(arrivals(spark, inbox, schema, format, files_per_batch)).dropDuplicates([key])
    with state_on_disk(spark):
        q = rows.writeStream.format("parquet").option("path", table).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
        q.awaitTermination()
    return q


def keyed(batch: DataFrame, column: str, key: str) -> DataFrame:
    """batch with the SHA-256 of a column as key."""
    return batch.withColumn(key, F.sha2(F.col(column).cast("string"), 256))
