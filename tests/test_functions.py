"""Literal cases of the scalar functions."""

import pytest
from pyspark.sql import functions as F

from tallyquill.functions import names as N
from tallyquill.functions import texts as T


def values(spark, rows, f, kind="string"):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, x {kind}")
    return [r[0] for r in df.select("i", f(F.col("x")).alias("y")).orderBy("i").select("y").collect()]


def test_levels(spark):
    cases = {"F4-2024-mock.pdf": "F4", "2526_1st_S4MATH1.pdf": "F4", "Form 4": "F4", "Secondary 4": "F4", "Sec. 4": "F4", "S.4": "F4", "s4-x": "F4", "中四": "F4", "中四級": "F4", "Grade 10": "F4", "grade 7": "F1", "maths4": None, "S45": None, "其中一個": None, "中一至中三": None, "2045": None, "S4 and F.4": "F4", "": None}
    assert values(spark, list(cases), N.parse_level) == list(cases.values())
    assert values(spark, ["S3, 中一 and Form 2, S3"], N.find_levels)[0] == ["F3", "F1", "F2"]


def test_modules(spark):
    cases = {"M1": "M1", "m2 paper": "M2", "MATHM1": "M1", "S6M2": "M2", "S4MATH1": None, "2526M2": None, "Module 2 (Algebra and Calculus)": "M2", "單元一": "M1", "微積分與統計": "M1", "M1 and M2": None, "M12": None}
    assert values(spark, list(cases), N.parse_module) == list(cases.values())
    assert values(spark, ["extended part", "延伸部分", "x", None], N.mentions_extended_part) == [True, True, False, False]


def test_paper_meta(spark):
    got = values(spark, ["2526_1st_S4MATH1.pdf", "F6-2025-26-dse-mock-paper2.pdf", "2024-uniform test.pdf", "final_2030.pdf", "2025-27 quiz.pdf", "上學期測驗 9900.pdf"], N.meta_of_name)
    assert [tuple(r) for r in got] == [("2025-26", "1st", None, 1), ("2025-26", None, "mock", 2), ("2024", None, "test", None), ("2030", "final", None, None), ("2025", None, "quiz", None), (None, "1st", "test", None)]


def test_names(spark):
    assert values(spark, ["19(a)", "18(a)(ii)", "7", " 3 (b) ", "(a)"], N.parent_of) == ["19", "18(a)", None, "3", None]
    assert values(spark, ["a/b c (1).pdf", "--x--.pdf", "?.pdf", "試卷 一.pdf", "x" * 90 + ".pdf"], N.safe_stem) == ["b-c-1", "x", "document", "試卷-一", "x" * 80]
    assert values(spark, ["S4-2024-mock-ms.pdf", "a_Marking Scheme.pdf", "problems.pdf", "x answers.PDF"], N.scheme_stem) == ["S4-2024-mock", "a", None, "x"]
    assert values(spark, ["17(a)(i)", "()"], N.safe_asset_name) == ["17-a-i", "question"]
    keys = values(spark, ["b584940bfebb:17(a)", "short:1", "b584940bfebb:", "b584940bfebb:a:b"], N.split_key)
    assert [k and tuple(k) for k in keys] == [("b584940bfebb", "17(a)"), None, None, ("b584940bfebb", "a:b")]


def test_strategy_ids_ignore_spelling_and_order(spark):
    df = spark.createDataFrame([("Factor & solve", ["b", "a"]), ("factor   solve!", ["a", "b", "a"]), ("factor solve", ["a"])], "n string, s array<string>")
    ids = [r[0] for r in df.select(N.strategy_id(F.col("n"), F.col("s"))).collect()]
    assert ids[0] == ids[1] != ids[2] and all(len(i) == 12 for i in ids)


def test_sidecars(spark):
    text = "form: S4\nSchool: A School  # ours\npaper: Paper 2\npaper-number: none\ntopics: a, b；\nTopic: x、y\nunknown: z\nno colon\nexam:\n"
    got = spark.createDataFrame([(text,)], "t string").select(N.parse_sidecar(F.col("t")).alias("m")).select("m", N.topics_of(F.col("m"))).first()
    assert got[0] == {"level": "S4", "school": "A School", "paper_number": "2", "topics": "x、y"} and got[1] == ["x", "y"]


ANSWERS = {r"\frac{1}{2}": "0.5", "x = 5": "5", "(B) 1024": "B", "b": "B", "5 cm²": "5", "−3": "-3", " $12.50$ 。": "12.5", "(5)": "5", r"\dfrac{\sqrt{3}}{2}": "(sqrt3)/2", "1000000": "1e+06", "0.00001": "1e-05", "999999.9": "1e+06", "7/3": "2.33333", "7/0": "7/0", "Hello World": "helloworld", " ": None, "100000": "100000", r"\text{No}": "no", "0": "0", r"\frac{\frac{1}{2}}{3}": "(1/2)/3"}


def test_answers(spark):
    assert values(spark, list(ANSWERS), T.normalise_answer) == list(ANSWERS.values())


@pytest.mark.parametrize("given,reference,want", [("B", "b", True), ("5", "10", None), ("12", "13", False), ("", "1", None), ("B (1024)", "1024", True), ("0.50", r"\frac{1}{2}", True), ("cat", "dog", False), ("A", "C", False)])
def test_answers_match(spark, given, reference, want):
    df = spark.createDataFrame([(given, reference)], "a string, b string")
    assert df.select(T.answers_match(F.col("a"), F.col("b"))).first()[0] is want


def test_text_faults(spark):
    assert values(spark, ["225x2 and Q1 in a 2x2 grid, y3"], T.broken_powers)[0] == ["x2", "y3"]
    good, bare, ragged = "| a | b |\n| --- | --- |\n| 1 | 2 |", "| a | b |\n| 1 | 2 |", "| a | b |\n|---|---|\n| 1 |"
    blocks = [T.pipe_blocks(F.lit(t)) for t in (good, bare, ragged, "a | b\nplain", "x | y\nz | w | v")]
    row = spark.range(1).select(*[T.malformed_tables(b) for b in blocks], *[F.size(T.ragged_tables(b)) for b in blocks]).first()
    assert list(row) == [0, 1, 0, 0, 0, 0, 0, 1, 0, 0]
    assert values(spark, [r"so \alpha and \(\beta\) and x^{2}"], T.undelimited_latex)[0] == [r"\alpha", "^{2}"]
    assert values(spark, ["一二三四五六七八。一二三四五六七八。短。短。"], T.repeated_sentences)[0] == ["一二三四五六七八"]
    assert values(spark, ["A. x\n(B) y\nC、 z", "A. x\nA. y\nB. z"], T.looks_like_multiple_choice) == [True, False]
    assert values(spark, [r"\alpha = 1" + "\n  x^{2}\n甲 \\beta\n\\(x\\)"], T.wrap_bare_formulas)[0]["text"] == "\\( \\alpha = 1 \\)\n  \\( x^{2} \\)\n甲 \\beta\n\\(x\\)"
    assert tuple(values(spark, ["\x0crac\x08eta\x0c"], T.restore_backslashes)[0]) == ("\\frac\\beta\\f", 2, 1)
    assert values(spark, ["Hence use the sine rule, 由此"], T.method_cues)[0] == ["Hence", "use the sine rule", "由此"]


def test_references(spark):
    df = spark.createDataFrame([("利用 (a) 的結果 and from part (b)", "17(b)"), ("using (i), (ii)", "18(a)(ii)"), ("in part (a)", "3(a)"), ("by (c) and by (c)", "5(d)")], "t string, q string")
    assert [r[0] for r in df.select(T.referenced_parts(F.col("t"), F.col("q"))).collect()] == [["17(a)"], ["18(a)(i)"], [], ["5(c)"]]


def test_boxes(spark):
    df = spark.createDataFrame([(1, 0, 0, 500, 500), (1, 0, 0, 10, 500), (1, 990, 990, 1001, 1000)], "page int, y_min int, x_min int, y_max int, x_max int").select(F.struct("*").alias("r"))
    got = df.select(T.is_usable_region(F.col("r")), T.crop_box(F.col("r"), F.lit(1000), F.lit(2000))).collect()
    assert [r[0] for r in got] == [True, False, False] and tuple(got[0][1]) == (0, 0, 520, 1040)
