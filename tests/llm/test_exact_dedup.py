from collections import defaultdict
from hashlib import sha256

from pyspark.sql import functions as F

from tallyquill.llm.exact_dedup import exact_dedup
from tallyquill.llm.queries import op9_exact_dedup


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    out = []
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        first = True
        for i in ids:
            out.append((i, keep, len(ids), i == keep and first, sha256(t.encode()).hexdigest()))
            first = first and i != keep
    return sorted(out, key=repr)


def test_documents(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, op9_exact_dedup(spark, sf).collect()), key=repr) == brute(rows)


def test_awkward(spark, awkward):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    assert sorted(map(tuple, exact_dedup(awkward).collect()), key=repr) == brute(rows)


def test_hot_group_and_empty_table(spark, awkward):
    many = spark.range(3000).selectExpr("id as doc_id", "if(id % 3 = 0, cast(id as string), 'same') as text")
    got = exact_dedup(many).where("text_sha256 = sha2('same', 256)").select("keep_id", "group_size").distinct().collect()
    assert [tuple(r) for r in got] == [(2999, 2000)]
    assert exact_dedup(awkward.limit(0)).count() == 0


def test_groups_above_and_below_the_hot_share(spark):
    """A third of all rows in one group (broadcast), groups of four (joined), and texts by themselves."""
    df = spark.range(9_000).selectExpr("id AS doc_id", "CASE id % 3 WHEN 0 THEN 'same' WHEN 1 THEN concat('four ', id DIV 12) ELSE concat('own ', id) END AS text")
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_dedup(df).collect()}
    groups = defaultdict(list)
    for i in range(9_000):
        groups["same" if i % 3 == 0 else ("four", i // 12) if i % 3 == 1 else i].append(i)
    assert got == {i: (max(g), len(g), i == max(g)) for g in groups.values() for i in g}


def largest_share(spark, df):
    """Share of the rows that the fullest task gives out, without adaptive splitting."""
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    return max(sizes) / sum(sizes)


def test_null_and_repeated_ids_of_one_text_are_dealt(spark):
    """A third of all rows with null ids, a third with one id, all of one text."""
    df = spark.range(9_000).selectExpr("CASE id % 3 WHEN 0 THEN NULL WHEN 1 THEN 7 ELSE id + 10000 END AS doc_id", "if(id % 3 = 2, concat('own ', id), 'same') AS text")
    got = exact_dedup(df)
    assert largest_share(spark, got) < 0.5
    same = got.where("text_sha256 = sha2('same', 256)")
    assert [tuple(r) for r in same.groupBy("doc_id", "keep_id", "group_size").agg(F.count_if("kept")).orderBy("doc_id").collect()] == [(None, 7, 6000, 0), (7, 7, 6000, 1)]
    assert got.where("doc_id >= 10000").agg(F.count_if("kept")).first()[0] == 3000
    nulls = exact_dedup(spark.range(50).selectExpr("cast(null as bigint) AS doc_id", "'x' AS text"))
    assert [tuple(r) for r in nulls.groupBy("keep_id", "group_size").agg(F.count_if("kept")).collect()] == [(None, 50, 1)]
