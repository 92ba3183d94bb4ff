from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from tallyquill.llm.langid import DOMAIN, HOST, SMOOTH, SUFFIX, address, declared, fit_text, fuse, identify_languages, trigrams
from tallyquill.llm.queries import op1_language_id


def test_pages(spark):
    sf = "/root/testdata/sf0.01"
    rows = op1_language_id(spark, sf).withColumn("code", address(F.col("url"))["code"]).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/pages.parquet").count()
    assert np.mean([r.lang == r.code for r in rows]) >= 0.99


def brute(rows, langs):
    k = len(langs)
    q = np.array([np.exp(r["ll"]) / np.exp(r["ll"]).sum() for r in rows])
    total = q.sum(0)
    by = {c: defaultdict(lambda: np.zeros(k)) for c in ("decl", "code", "suffix", "domain", "host")}
    for r, x in zip(rows, q, strict=True):
        for c in by:
            by[c][r[c]] += x
    out = {}
    for r, x in zip(rows, q, strict=True):
        rest = {c: np.maximum(by[c][r[c]] - x, 0) for c in by}
        t = total - x
        p = (t + 1) / (t.sum() + k)
        for c, w in (("suffix", SUFFIX), ("domain", DOMAIN), ("host", HOST)):
            p = (rest[c] + w * p) / (rest[c].sum() + w)
        s = np.array(r["ll"]) + np.log(p)
        for c in ("decl", "code"):
            s = s + np.log((rest[c] + SMOOTH) / (t + SMOOTH * len(by[c])))
        out[r["page_id"]] = (langs[int(s.argmax())], round(float(1 / np.exp(s - s.max()).sum()), 5))
    return out


def test_fusion_against_brute_force(spark):
    rng, langs = np.random.default_rng(8), ["de", "en", "fr"]
    rows = []
    for i in range(120):
        host = f"h{rng.integers(0, 9)}.d{rng.integers(0, 4)}.{rng.choice(['com', 'fr'])}"
        rows.append({"page_id": i, "url": f"http://{host}/", "decl": str(rng.choice(["", "en", "fr"])), "code": str(rng.choice(["", "de"])), "host": host, "domain": host.split(".", 1)[1], "suffix": host.rsplit(".", 1)[1], "ll": (-4 * rng.random(3)).tolist()})
    df = spark.createDataFrame(rows, "page_id long, url string, decl string, code string, host string, domain string, suffix string, ll array<double>")
    got = {r.page_id: (r.lang, round(r.probability, 5)) for r in fuse(df, langs).collect()}
    want = brute(rows, langs)
    assert all(got[i][0] == want[i][0] and abs(got[i][1] - want[i][1]) < 2e-5 for i in want)


def test_host_and_markup_decide_where_text_is_silent(spark):
    docs = spark.createDataFrame([(i, " ".join(["the and of with"] * 9) if i % 2 else " ".join(["der und die mit"] * 9), "en" if i % 2 else "de") for i in range(40)], "doc_id long, text string, lang string")
    page = '<html lang="{}"><body><p>{}</p></body></html>'
    rows = [(i, f"http://a.example.com/{i}", page.format("de-AT", "der und die mit der und die")) for i in range(30)]
    rows += [(100 + i, f"http://b.example.org/{i}", page.format("en", "the and of with the and of")) for i in range(30)]
    rows += [(200, "http://a.example.com/x", None), (201, "http://b.example.org/y", "<p></p>"), (202, None, page.format("de", "")), (203, "not an address", ""), (203, "not an address", "")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, host string")
    got = {r.page_id: r for r in identify_languages(df, docs).collect()}
    assert got[200].lang == "de" and got[201].lang == "en" and got[202].lang == "de" and got[202].host == "" and len(got) == 64
    assert identify_languages(df, docs).count() == len(rows)
    assert identify_languages(df.limit(0), docs).count() == 0
    assert identify_languages(df, docs.limit(0)).where("lang = 'und'").count() == len(rows)


def test_addresses(spark):
    urls = ["https://user@www.A.co.uk:80/en/x", "http://a/de", "ftp://x.y.fr", "no", "http://h.com/fra/x", "http://h.com/es?x"]
    df = spark.createDataFrame([(u,) for u in urls], "u string").select(*(c.alias(n) for n, c in address(F.col("u")).items()))
    assert [tuple(r) for r in df.collect()] == [("www.a.co.uk", "co.uk", "uk", "en"), ("a", "", "", "de"), ("x.y.fr", "y.fr", "fr", ""), ("", "", "", ""), ("h.com", "h.com", "com", ""), ("h.com", "h.com", "com", "es")]
    pages = ["<html lang=en-GB>", "<HTML class='x' LANG='Fr'>", "<html><body lang=de>", "", '<html xml:lang="es">']
    assert [r[0] for r in spark.createDataFrame([(p,) for p in pages], "p string").select(declared(F.col("p"))).collect()] == ["en", "fr", "", "", ""]


def test_more_languages_than_a_few_dozen(spark):
    names = [f"{a}{b}" for a in "abcdefgvz" for b in "abcdefghi"]
    texts = [f"{x}{x}um {x}o{x} qu{x}l {x}is{x}" * 3 for x in names]
    langs, table = fit_text(spark.createDataFrame([(i, t, x) for i, (t, x) in enumerate(zip(texts, names, strict=True))], "doc_id long, text string, lang string"))
    assert langs == names and [langs[table[trigrams(t)].mean(0).argmax()] for t in texts] == names


def test_pages_without_address_are_dealt(spark):
    """A third of all pages have no url and so one nameless host: no task joins all of them with its sums."""
    from tests.llm.test_exact_dedup import largest_share

    rows = spark.range(6_000, numPartitions=4).selectExpr("id AS page_id", "if(id % 3 = 0, '', concat('http://h', id, '.example/x')) AS url", "'' AS decl", "array(-1.0 - id % 2, -2.0D) AS ll")
    rows = rows.selectExpr("page_id", "url", "decl", "cast(ll AS array<double>) AS ll").select("*", *(c.alias(n) for n, c in address(F.col("url")).items()))
    got = fuse(rows, ["a", "b"])
    assert got.count() == 6_000 and largest_share(spark, got) < 0.5
