import math
import re
import time
from hashlib import sha256

from pyspark.sql import functions as F

from tallyquill.llm.queries import op7_secret_scan
from tallyquill.llm.secret_scan import ALPHABET, KINDS, THRESHOLDS, WINDOW, hot_range, joined, redacted, scan_secrets

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base(text):
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(out)


def windows(s, threshold):
    hot = []
    for i in range(len(s) - WINDOW + 1):
        w = s[i : i + WINDOW]
        bits = -sum(w.count(c) / WINDOW * math.log2(w.count(c) / WINDOW) for c in set(w))
        if bits >= threshold - 1e-9:
            hot.append(i)
    return (hot[0], hot[-1] + WINDOW) if hot else (0, 0)


def test_documents(spark, sf):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in op7_secret_scan(spark, sf).collect():
        want = base(texts[r.doc_id])
        said = ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in want)
        assert r.base_sha256 == sha256(said.encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == x for _, k, _ in want) for x in range(3))
        assert set(filter(None, said.split(","))) <= set(r.spans.split(","))


TEXTS = [
    'x password = "hunter2hunter2" y', "token=secret : abcdefghijklmnop", "API_KEY:'abc'", "😀 é apikey=ABCDEFGHIJKL.", "AKIAABCDEFGHIJKLMN AKIAX", "deadbeefdeadbeef00 cafe",
    "PASSWD=aaaaaaaaaaaa token=bbbbbbbbbbbbb", "Password==========1", "", None, "id 550e8400-e29b-41d4-a716-446655440000", "k9Xw2LqPz7RtYb4NcVm8 tail", "plain words only here", "seſret=abcdefghijklmnop Key",
]


def test_base_places_and_nulls(spark):
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(TEXTS)], "doc_id long, text string, base_spans string")
    for r in scan_secrets(df).collect():
        assert [tuple(s) for s in r.base_spans] == base(TEXTS[r.doc_id] or "")
        assert all(s in r.all_spans for s in r.base_spans)


def test_entropy_spans(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    got = {r.doc_id: [s for s in r.all_spans if s.kind == 3] for r in scan_secrets(df).collect()}
    assert [(s.start, s.end) for s in got[11]] == [(0, 20)]
    assert not got[10] and not got[12]  # allow-listed, no digits


def test_incremental_counts_agree_with_counting(spark):
    import random

    rnd = random.Random(5)
    strings = ["".join(rnd.choice(ALPHABET[: rnd.choice([4, 16, 66])]) for _ in range(rnd.randint(1, 70))) for _ in range(60)]
    df = spark.createDataFrame([(s,) for s in strings], "s string")
    for r in df.select("s", *(hot_range(F.col("s"), F.lit(x)).alias(k) for k, x in THRESHOLDS.items())).collect():
        for k, x in THRESHOLDS.items():
            assert (r[k].first, r[k].last) == windows(r.s, x)


def test_redaction_and_empty(spark):
    df = spark.createDataFrame([(1, "a token=abcdefghijkl b"), (2, None)], "doc_id long, text string")
    got = scan_secrets(df).select("doc_id", redacted(F.coalesce("text", F.lit("")), F.col("all_spans")).alias("t"), joined(F.col("base_spans")).alias("j"))
    assert [tuple(r) for r in got.orderBy("doc_id").collect()] == [(1, "a [SECRET] b", "assign:2:20"), (2, "", "")]
    assert scan_secrets(df.limit(0)).count() == 0


def timed(df):
    began = time.time()
    rows = df.collect()
    return rows, time.time() - began


def test_long_candidates_slugs_and_many_spans(spark):
    """Texts that one long string or very many findings fill: right, and in time that grows with their length."""
    import random

    rnd = random.Random(3)
    blob = "".join(rnd.choice(ALPHABET) for _ in range(100_000))
    flat = "a1" * 50_000
    texts = {
        1: "x " + blob + " y", 2: "ab-" * 33_000 + "1x", 3: "ab-" * 33_000 + "17", 4: flat, 5: " ".join(f"token=abcdefghij{i:06d}" for i in range(10_000)),
        6: "é " + " ".join("".join(rnd.choice(ALPHABET[10:62]) for _ in range(24)) + str(i) for i in range(10_000)), 7: "= " * 20_000 + "-/" * 20_000,
    }
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows, seconds = timed(scan_secrets(df).withColumn("hidden", redacted(F.col("text"), F.col("all_spans"))))
    got = {r.doc_id: r for r in rows}
    for i, t in texts.items():
        assert [tuple(s) for s in got[i].base_spans] == base(t)
    hot = {i: [(s.start, s.end) for s in r.all_spans if s.kind == 3] for i, r in got.items()}
    assert hot[1] == [tuple(2 + p for p in windows(blob, THRESHOLDS["base64"]))]
    assert not any(hot[i] for i in (2, 3, 4, 5, 7))
    assert len(got[5].base_spans) == 10_000 and got[5].hidden == " ".join(["[SECRET]"] * 10_000)
    assert len(hot[6]) > 9_000
    want, at = [], 0
    for a, b in hot[6]:
        want += [texts[6][at:a], "[SECRET]"]
        at = b
    assert got[6].hidden == "".join(want) + texts[6][at:]
    assert seconds < 60


def test_counts_do_not_drift(spark):
    import random

    rnd = random.Random(8)
    s = "".join(rnd.choice(ALPHABET[: rnd.choice([3, 8, 20])]) for _ in range(5_000))
    for x in (2.0, 2.6, 3.0, 3.3, 3.7):
        r = spark.createDataFrame([(s,)], "s string").select(hot_range(F.col("s"), F.lit(x)).alias("r")).first().r
        assert (r.first, r.last) == windows(s, x)
