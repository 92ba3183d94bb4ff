"""Rows of a printed table, from pieces with positions."""

from tallyquill.operators.layout import objectives

P = [
    (120.0, 700.2, "Learning Objective"), (300.0, 700.0, "Time"), (400.0, 700.0, "Remarks"), (10.0, 690.0, "3 . Shapes"), (100.0, 690.3, "3.1"), (120.0, 689.8, "know"), (150.0, 690.0, "lines"), (300.0, 690.0, "4"),
    (120.0, 680.0, "and angles"), (401.0, 680.0, "see 2"), (99.0, 670.0, "3.2"), (120.0, 670.0, "draw"), (400.0, 660.0, "late"), (100.0, 650.0, "4.1"), (120.0, 650.0, "x"), (10.0, 650.0, "4. Sets"), (300.0, 640.0, "7"), (300.0, 630.0, "8"), (100.0, 620.0, "4.2"), (120.0, 620.0, "y"),
]


def test_stitched_rows(spark):
    df = spark.createDataFrame([("p", 1, *p) for p in P] + [("q", 1, *P[1]), ("q", 1, *P[2])], "part string, page int, x double, y double, text string")
    got = sorted((r.part, r.obj, r.unit_no, r.text, r.time, r.remarks, r.page) for r in objectives(df).fillna("").collect())
    assert got == [("p", "3.1", "3", "know lines and angles", "4", "see 2", 1), ("p", "3.2", "3", "draw", "", "late", 1), ("p", "4.1", "4", "x", "7", "", 1), ("p", "4.2", "4", "y", "", "", 1)]
    assert objectives(df.limit(0)).collect() == []
