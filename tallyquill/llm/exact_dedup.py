"""Exact dedup by skew-safe combining.

Three combines, each of which groups by digest *and* whole text, so that equal digests never stand in
for equal texts: within each map task (Spark's partial aggregate: "local"), within salted digest groups,
and over the winners of the salts. A group of copies of any size thus reaches a reducer as at most one
row per map task and salt, and the last combine as at most ``salts`` rows.

The rows are numbered once, in a written table of small columns, and learn their group by a join on the
SHA-256 alone: groups that hold more than a thousandth of all rows, of which there are fewer than a thousand,
are broadcast, and their rows dealt by number, so that no task gets all rows of a large group, repeated or null
ids among them. Which row of an id stays is a maximum over numbers, combined where the rows are. Should two texts ever share a digest the query stops with an error rather than joining them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyquill.llm.common import HOT_KEYS, join_hot, text_or_empty, written

SALTS = 16


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Null texts equal empty ones. The largest id of a group stays; null ids lose to any id, and a group
    of null ids alone keeps one of them under keep_id null. Rows repeated with the same id and text all
    count in group_size and one of them is kept. Columns of the input other than these two are ignored.
    An empty table gives an empty result.
    """
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_or_empty(text_col).alias("t"))
    rows = rows.withColumn("digest", F.unhex(F.sha2("t", 256)))
    ids = written(rows.select("doc_id", "digest", F.monotonically_increasing_id().alias("row")), "ids")
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(salts))
    salted = rows.groupBy("digest", "t", salt.alias("salt")).agg(F.max("doc_id").alias("keep"), F.count(F.lit(1)).alias("n"))
    classes = salted.groupBy("digest", "t").agg(F.max("keep").alias("keep"), F.sum("n").alias("n"))
    groups = classes.groupBy("digest").agg(F.max("keep").alias("keep_id"), F.sum("n").alias("group_size"), F.count(F.lit(1)).alias("texts"))
    groups = groups.select("digest", "keep_id", F.when(F.col("texts") == 1, F.col("group_size")).otherwise(F.raise_error(F.lit("two texts share a SHA-256"))).cast("long").alias("group_size"))
    stays = ids.groupBy("digest").agg(F.max(F.struct("doc_id", "row"))["row"].alias("keep_row"))
    groups = written(groups.join(stays, "digest"), "groups")
    hot = groups.where(F.col("group_size") * HOT_KEYS > ids.count())
    return join_hot(ids, groups, hot, ["digest"], "row").select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("row") == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
