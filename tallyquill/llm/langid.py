"""Language of web pages by Bayesian fusion of four kinds of evidence.

Text: hashed byte trigrams of the page's blocks (those that are mostly links left out) under one
smoothed multinomial per language; the mean log-likelihood counts as CREDIT trigrams at most, since a
text's trigrams are far from independent. Markup and address: how often pages of a language declare a
language code, and how often their address ends in a suffix or starts its path with a code. Host: how
the languages are spread over the other pages of the host, smoothed towards its domain, that towards its
suffix, and that towards all pages.

Shares and priors come from grouped sums of the pages' text posteriors. A page's own posterior is taken
out of every sum it is judged by, so that its text does not count twice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyquill.llm.common import HOT_KEYS, join_hot, text_or_empty, written
from tallyquill.llm.html_leaves import leaves
from tallyquill.llm.shingles import mix

SAMPLE = 4_000  # documents the text model is fitted on, about
BUCKETS = 1 << 15
CREDIT = 20.0
SMOOTH = 0.5  # of declared codes and suffixes
HOST, DOMAIN, SUFFIX = 8.0, 20.0, 50.0  # weight of the wider level, in pages


def trigrams(text: str) -> np.ndarray:
    """Bucket of each byte trigram of the lower-cased text, blanks at both ends."""
    b = np.frombuffer(f" {' '.join(text.lower().split())} ".encode(), np.uint8).astype(np.uint64)
    if len(b) < 3:
        return np.zeros(0, np.int64)
    return (mix(b[:-2] << np.uint64(16) | b[1:-1] << np.uint64(8) | b[2:]) % np.uint64(BUCKETS)).astype(np.int64)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sums: dict[str, np.ndarray] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            sums[lang] = sums.get(lang, 0) + np.bincount(trigrams(text.as_py()), minlength=BUCKETS)
        for lang, n in sums.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(n[at].astype(np.int64))], names=["lang", "bucket", "n"])


def fit_text(docs: DataFrame, sample: int = SAMPLE) -> tuple[list[str], np.ndarray]:
    """(languages, log-probability of each bucket under each) from about ``sample`` documents, drawn by a hash
    of their ids: every language that they hold. Counts alone come to the driver."""
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    share = min(1.0, sample / max(1, docs.count()))
    rows = known.where(F.pmod(F.xxhash64("doc_id", F.lit("lang")), F.lit(1_000_000)) < share * 1_000_000).select("lang", "text")
    got = rows.mapInArrow(_counted, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).collect()
    langs = sorted({r.lang for r in got}) or ["und"]
    place = {x: i for i, x in enumerate(langs)}
    counts = np.full((BUCKETS, len(langs)), 0.0)
    for r in got:
        counts[r.bucket, place[r.lang]] = r.n
    counts += 2e4 * (counts.sum(1, keepdims=True) + 0.5) / (counts.sum() + 0.5 * BUCKETS) / 10  # towards all languages
    return langs, np.log(counts / counts.sum(0)).astype(np.float32)


def _evidence(table: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                out = []
                for page in part.column(2):
                    text = " ".join(b.text for b in leaves(page.as_py()) if 2 * b.link <= len(b.text))
                    at = trigrams(text)
                    ll = table[at].mean(0, dtype=np.float64) * min(len(at), CREDIT) if len(at) else np.zeros(table.shape[1])
                    out.append((ll - ll.max()).tolist())
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(out, pa.list_(pa.float64()))], names=["page_id", "url", "html", "ll"]).select(["page_id", "url", "ll"])

    return run


def address(url: Column) -> dict[str, Column]:
    """host, domain (its last two labels), suffix and the code its path starts with, '' where absent."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return {
        "host": host,
        "domain": F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1),
        "suffix": F.regexp_extract(host, r"\.([^.]+)$", 1),
        "code": F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([A-Za-z]{2})(?:[/?#-]|$)", 1)),
    }


def declared(page: Column) -> Column:
    """Two-letter code of the html tag's lang attribute, '' where absent."""
    return F.lower(F.regexp_extract(page, r"""(?is)<html\b[^>]*?\slang\s*=\s*["']?([A-Za-z]{2})\b""", 1))


def fuse(pages: DataFrame, langs: list[str]) -> DataFrame:
    """Of (page_id, url, decl, host, domain, suffix, code, ll): page_id, url, host, declared, text_lang,
    lang, probability. Own posteriors are left out of the sums; equal scores go to the first language."""
    k = len(langs)
    e = F.transform("ll", lambda x: F.exp(x))
    rows = pages.withColumn("e", e).withColumn("q", F.transform("e", lambda x: x / F.aggregate("e", F.lit(0.0), lambda a, b: a + b))).drop("e")
    seen, rows = rows, rows.withColumn("row", F.monotonically_increasing_id())

    def with_sums(df: DataFrame, key: str, n: int) -> DataFrame:
        """df with the sums over the pages of its key; a host or code of a large share of the pages meets in no task."""
        s = seen.groupBy(key).agg(F.array(*(F.sum(F.col("q")[i]) for i in range(k))).alias(f"s_{key}"), F.count(F.lit(1)).alias("n"))
        return join_hot(df, s.drop("n"), s.where(F.col("n") * HOT_KEYS > n).drop("n"), [key], "row")

    total = rows.agg(F.count(F.lit(1)).alias("n"), F.array(*(F.coalesce(F.sum(F.col("q")[i]), F.lit(0.0)) for i in range(k))).alias("s"), F.countDistinct("decl").alias("d"), F.countDistinct("suffix").alias("x"), F.countDistinct("code").alias("c")).first()
    all_pages = F.array(*(F.lit(float(x)) for x in total.s))
    for key in ("decl", "code", "suffix", "domain", "host"):
        rows = with_sums(rows, key, total.n)

    def rest(column: str | Column) -> Column:
        """A sum without the page's own posterior."""
        return F.zip_with(column, "q", lambda s, q: F.greatest(s - q, F.lit(0.0)))

    def level(column: str, wider: Column, weight: float) -> Column:
        mine = rest(column)
        n = F.aggregate(mine, F.lit(0.0), lambda a, b: a + b)
        return F.zip_with(mine, wider, lambda s, w: (s + weight * w) / (n + weight))

    n_all = F.aggregate(rest(all_pages), F.lit(0.0), lambda a, b: a + b)
    base = F.transform(rest(all_pages), lambda s: (s + 1.0) / (n_all + k))
    rows = rows.withColumn("p0", base)
    rows = rows.withColumn("p1", level("s_suffix", F.col("p0"), SUFFIX)).withColumn("p2", level("s_domain", F.col("p1"), DOMAIN)).withColumn("p3", level("s_host", F.col("p2"), HOST))

    def given(column: str, kinds: int) -> Column:
        """log P(value | language), of the page's own value."""
        return F.transform(F.arrays_zip(rest(column).alias("s"), rest(all_pages).alias("t")), lambda x: F.log((x["s"] + SMOOTH) / (x["t"] + SMOOTH * max(1, kinds))))

    logs = F.arrays_zip(F.col("ll").alias("a"), given("s_decl", total.d).alias("b"), given("s_code", total.c).alias("c"), F.col("p3").alias("d"))
    rows = rows.withColumn("score", F.transform(logs, lambda x: x["a"] + x["b"] + x["c"] + F.log(x["d"])))
    top = F.array_max("score")
    names = F.array(*map(F.lit, langs))
    return rows.select(
        "page_id",
        "url",
        "host",
        F.col("decl").alias("declared"),
        F.element_at(names, F.array_position("ll", F.array_max("ll")).cast("int")).alias("text_lang"),
        F.element_at(names, F.array_position("score", top).cast("int")).alias("lang"),
        F.round(1 / F.aggregate("score", F.lit(0.0), lambda a, x: a + F.exp(x - top)), 6).alias("probability"),
    )


def identify_languages(pages: DataFrame, docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """A row for each page: page_id, url, host, declared, text_lang, lang, probability.

    A null or textless page is judged by its markup, address and host alone; a null url has no host, and
    such pages share one nameless host. Repeated rows stay repeated, each judged by the others; other
    columns are ignored. An empty table gives an empty result.
    """
    langs, table = fit_text(docs, sample)
    rows = pages.select("page_id", text_or_empty("url").alias("url"), text_or_empty("html").alias("html"))
    kind = dict(pages.dtypes)["page_id"]
    marked = rows.select("page_id", "url", F.col("html"), declared(F.col("html")).alias("decl"))
    # the declared code rides along in the address column, so that pages go through Python once
    packed = marked.select("page_id", F.concat_ws("\u0000", "decl", "url").alias("url"), "html")
    seen = packed.mapInArrow(_evidence(table), f"page_id {kind}, url string, ll array<double>")
    parts = F.split("url", "\u0000", 2)
    seen = seen.select("page_id", parts[0].alias("decl"), parts[1].alias("url"), "ll")
    seen = written(seen.select("*", *(c.alias(n) for n, c in address(F.col("url")).items())), "evidence")
    return fuse(seen, langs)
