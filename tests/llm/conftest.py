import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def awkward(spark):
    """Null and empty texts, ties, repeated rows, a very long text, and an extra column with a clashing name."""
    long = "The quick brown fox and 12 dogs. " * 4000
    rows = [
        (1, "a b c d e f g", "x"), (2, "a b c d e f g", None), (2, "a b c d e f g", None), (3, None, "y"), (4, "", "y"), (None, "a b c d e f g", "z"),
        (5, long, "x"), (6, " \t\n", "x"), (7, "İstanbul ΣΑΣ ſtraße 漢字かな <|endoftext|> 👩‍👩‍👧 it's we'll x", "x"), (8, "…\u0000́é \r\n\x0b\x1c\x85 end", None),
        (9, "tail\n\n\n   spaces   ", None), (10, "!!!! ???? ....  12345678901234567890", None),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, n string").withColumn("t", F.lit("clash"))
