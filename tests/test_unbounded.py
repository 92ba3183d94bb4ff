"""What once stopped at a fixed depth or number of rows."""

import time

import pytest
from pyspark.sql import functions as F

from tallyquill.functions import names as N
from tallyquill.functions import texts as T
from tallyquill.operators import reports, taxonomy
from tallyquill.operators.contains import contained_items
from tallyquill.sources import archive


def test_fractions_of_any_depth(spark):
    tex = "x"
    for _ in range(9):
        tex = f"\\frac{{{tex}}}{{2}}"
    got = spark.createDataFrame([(tex,), ("7",), (None,)], "s string").select(T.strip_latex(F.col("s"))).collect()
    assert "frac" not in got[0][0] and got[0][0].count("/") == 9 and got[1][0] == "7" and got[2][0] is None


def test_a_batch_report_has_a_line_for_each_file(spark):
    df = spark.range(1_500).selectExpr("1 AS batch", "concat('f', id) AS file", "'ok' AS status", "id AS questions")
    assert reports.batch_reports(df).first().report.count("| f") == 1_500


def test_closure_goes_to_the_end_of_a_chain(spark):
    edges = spark.range(66).selectExpr("id AS node", "id + 1 AS next")
    assert taxonomy.closure(edges).where("start = 0").agg(F.max("reached")).first()[0] == 66


def test_long_texts_take_time_in_proportion(spark):
    """A text of a megabyte: sentences, tables and sidecar lines in seconds."""
    sentences = " ".join(f"This is sentence number {i % 9_000} of a long text." for i in range(25_000))
    table = "\n".join(f"| {i} | x |" for i in range(50_000)) + "\nplain\n| a |\n| b |"
    sidecar = "\n".join(f"year: {i}\nschool: s{i}" for i in range(20_000))
    df = spark.createDataFrame([(sentences, table, sidecar)], "s string, t string, m string")
    began = time.time()
    r = df.select(F.size(T.repeated_sentences(F.col("s"), ".")).alias("n"), F.transform(T.pipe_blocks(F.col("t")), F.size).alias("b"), N.parse_sidecar(F.col("m")).alias("m")).first()
    assert r.n == 9_000 and r.b == [50_000, 2] and r.m == {"year": "19999", "school": "s19999"}
    assert time.time() - began < 20


def test_short_items_are_found(spark):
    docs = spark.createDataFrame([(1, "abc def"), (2, "xabcx"), (3, "b"), (4, None), (5, "")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "abc"), (2, "b"), (3, "bc d"), (4, "zz"), (5, ""), (6, "ab")], "item_id long, item string")
    got = sorted(tuple(r) for r in contained_items(docs, items, "doc_id", "item_id").collect())
    texts = {1: "abc def", 2: "xabcx", 3: "b", 5: ""}
    assert got == sorted((i, d) for i, x in ((1, "abc"), (2, "b"), (3, "bc d"), (4, "zz"), (5, ""), (6, "ab")) for d, t in texts.items() if x in t)


def test_header_rows_of_vocabularies(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.csv").write_text("  # note\nid,name\n1,one\nid,name\n\n2,\n")
    assert sorted(tuple(r) for r in archive.read_rows(spark, str(tmp_path / "a")).collect()) == [("1", "one"), ("2", ""), ("id", "name")]
    (tmp_path / "a" / "y.csv").write_text("id,other\n3,x\n")
    with pytest.raises(ValueError):
        archive.read_rows(spark, str(tmp_path / "a"))
