import html as H
import re
import time
from random import Random

import numpy as np
from pyspark.sql import functions as F

from tallyquill.llm.html_blocks import Labeller, extract_main_text, made_page, main_texts, padded, trained, vectors
from tallyquill.llm.html_leaves import leaves
from tallyquill.llm.queries import op5_html_blocks


def article(page):
    """The article of these pages, cut out by its tags."""
    a = page[page.find("<article>") : page.find("</article>")]
    return "\n".join(filter(None, (" ".join(H.unescape(re.sub(r"<[^>]+>", "", x)).split()) for x in re.split(r"</?(?:p|h1|br|article)>", a))))


def test_pages(spark, sf):
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    rows = op5_html_blocks(spark, sf).collect()
    assert len(rows) == len(pages) and all(r.url == pages[r.page_id].url and r.n_chars == len(r.text) for r in rows)
    assert [r.page_id for r in rows if r.text != article(pages[r.page_id].html)] == []


def test_unseen_made_pages():
    rnd, hit, found, want = Random(12345), 0, 0, 0
    for _ in range(120):
        page, labels = made_page(rnd)
        got = trained().label([leaves(page)])[0]
        hit, found, want = hit + (got & labels).sum(), found + got.sum(), want + sum(labels)
    assert hit / found > 0.95 and hit / want > 0.93


def test_semantic_page_with_every_kind_of_clutter():
    page = """<html><body><header class=site-header><a href=/>Home</a></header><nav><a href=/a>News</a> <a href=/b>Blog</a></nav>
    <div class="cookie-notice"><p>We use cookies on this site.</p><button>Accept</button></div>
    <article><h1>A &lt;title&gt; &amp; more</h1><p>First   paragraph
    of the story, long enough to be one.</p><div class="ad">Buy now, click here</div><p>Second one<b> with bold</b> text.</article>
    <aside class="sidebar"><h3>Related</h3><ul><li><a href=/x>Another story</a></li></ul></aside>
    <section class="comments"><h3>Comments</h3><div class=comment><p>nobody says:</p><p>I do not agree with this at all.</p></div></section>
    <form class=newsletter><label>Email</label><input></form><footer>Copyright</footer><script>var x = "<p>no</p>";</script></body></html>"""
    assert main_texts([page], trained()) == ["A <title> & more\nFirst paragraph of the story, long enough to be one.\nSecond one with bold text."]


def test_leaves():
    def texts(page):
        return [b.text for b in leaves(page)]

    assert texts("") == texts("<p>") == texts("<script>x") == texts("<!-- never closed <p>a") == []
    assert texts("a<p>b<p>c<br>d &amp;amp; &#x41;&nbsp;e</p><li>f<li>g") == ["a", "b", "c", "d &amp; A e", "f", "g"]
    assert texts('<p title="a>b">x < y</p>') == ["x < y"]
    assert texts("<div>a<p>b</div>c") == ["a", "b", "c"]
    assert leaves("<div class='Main x2'><p>t<a href=#>link</a>")[0].path == ("div", "c:main", "c:x", "c:2", "p")
    assert leaves("<p>t<a href=#>link</a>")[0].link == 4
    assert len(leaves("<div>" * 3000 + "deep")) == 1 and len(leaves('<a b="' * 2000)) <= 1


def test_comments_and_nested_elements_end_where_html_says():
    def texts(page):
        return [b.text for b in leaves(page)]

    assert texts("<p>a<!-- note --!>b</p><p>c") == ["ab", "c"]
    assert texts("<p>a<!-->b</p>") == texts("<p>a<!--->b</p>") == texts("<p>a<!-- x -- ! > -->b</p>") == ["ab"]
    for tag in ("template", "svg", "object", "noscript", "canvas"):
        assert texts(f"<p>a<{tag}>1<{tag}>2</{tag}>3</{tag}>b") == ["ab"]
        assert texts(f"<p>a<{tag}>1<{tag}>2</{tag}>b<p>c") == ["ab", "c"]  # the outer one is never closed
        assert texts(f"<p>a</{tag}>b<{tag}>1</{tag}>c") == ["abc"]
    assert texts("<svg><svg/></svg>a") == ["a"]
    assert texts("<p>a<script><!--<script>x</script>--></script>b") == ["ab"]
    assert texts("<p>a<script><!-- x</script>b") == texts("<p>a<script><!--<script>--></script>b") == texts("<p>a<script><!--><script></script>b") == ["ab"]
    assert texts("<p>a<plaintext><b>&amp;</p>") == ["a", "<b>&amp;</p>"]


def test_many_comments_and_elements_take_linear_time():
    n = 60_000
    for page in ("<!-- x --!>" * n + "-->", "<svg>" * n, "<svg>" * n + "</svg>" * n, "<svg></svg>" * n, "<template>" * n + "</template>", "<script><!--<script></script>--></script>" * n):
        began = time.time()
        leaves(page)
        assert time.time() - began < 5


def test_gradients_against_differences():
    net, rnd, rng = Labeller(), Random(1), np.random.default_rng(1)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    rows = []
    while len(rows) < 3:
        page, labels = made_page(rnd)
        if 4 < len(labels) < 20:
            rows.append((vectors(leaves(page)), labels))
    x, mask, y = padded(rows)
    x, mask = x.astype(np.float64), mask.astype(np.float64)

    def loss():
        logit, _ = net.forward(x, mask)
        return float((np.logaddexp(0, logit) - y * logit)[mask[:, :, 0] > 0].sum() / mask.sum())

    got = net.gradients(x, mask, y)
    used = np.flatnonzero(x.sum((0, 1)))
    for k, p in net.p.items():
        for i in rng.choice(p.size, min(p.size, 10), replace=False):
            i = int(rng.choice(used)) * p.shape[1] + i % p.shape[1] if k == "in" else i
            old, eps = p.flat[i], 1e-4
            p.flat[i] = old + eps
            up = loss()
            p.flat[i] = old - eps
            down = loss()
            p.flat[i] = old
            assert abs((up - down) / (2 * eps) - got[k].flat[i]) < 2e-4, k


def test_nulls_repeats_and_empty(spark):
    page = "<html><body><nav><a href=#>x</a></nav><article><p>The whole story is here, told in one sentence.</p></article></body></html>"
    df = spark.createDataFrame([(1, None, None), (2, "u", ""), (3, "v", page), (3, "v", page), (None, "w", page * 400)], "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    rows = extract_main_text(df).collect()
    assert [(r.page_id, r.url, len(r.text) > 0) for r in sorted(rows, key=lambda r: (r.page_id is None, r.page_id or 0))] == [(1, None, False), (2, "u", False), (3, "v", True), (3, "v", True), (None, "w", True)]
    assert extract_main_text(df.limit(0)).count() == 0


def test_all_words_of_a_block_and_of_a_class_count():
    def hashed(page):
        return vectors(leaves(page))[0]

    early = " ".join(f"w{i}" for i in range(400))
    a, b = (hashed(f"<p>{early} {late}</p>") for late in ("reply comment posted", "story article chapter"))
    assert (a[:-8] != b[:-8]).any()
    a, b = (hashed("<p>" + "w" * 20_000 + f" {late}</p>") for late in ("reply", "story"))
    assert (a[:-8] != b[:-8]).any()
    utilities = " ".join(f"mt-{i} px-{i}" for i in range(9))
    assert "c:comment" in leaves(f"<div class='{utilities} comment'>x</div>")[0].path
    deep = "<div class='a'>" * 120
    assert (hashed(deep + "<main><section><p>x")[:512] != hashed(deep + "<section><main><p>x")[:512]).any()


def test_a_long_block_is_labelled_as_a_short_one():
    for n in (30, 400, 2_500, 40_000):
        story = " ".join(f"word{i * i % 9973} and{i}" + "." * (i % 9 == 0) for i in range(n))
        menu = " ".join(f"<a href=/{i}>link{i}</a>" for i in range(n))
        page = f"<html><body><nav>{menu}</nav><article><h1>A title</h1><p>{story}</p><p>The end of it.</p></article><footer>Copyright</footer></body></html>"
        assert main_texts([page], trained()) == [f"A title\n{story}\nThe end of it."]


def test_faulty_and_unusual_markup():
    def texts(page):
        return [b.text for b in leaves(page)]

    assert texts('<p title="x>Hello') == ["Hello"]
    assert texts("<p>a <a href=foo'>b</a> c</p>") == ["a b c"]
    assert texts('<p>one</p><svg width="1"/><p>two</p>') == ["one", "two"]
    assert texts("<p>icon <svg><title>no</title><path d='M1'/></svg> inside</p>") == ["icon inside"]
    assert texts("<p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn></math> be</p>") == ["Let x=2 be"]
    assert texts("<p>a <img src=x> b<script>c</script> d <!-- e --> f</p>") == ["a b d f"]
    assert texts("<p>a</p><svg><p>b</p>") == ["a", "b"]  # never closed
    assert texts("<script src=x/><p>a</p>") == [] and texts("<script src='x' /><p>a</p>") == ["a"]
    assert texts("a < b <1 </ > </p x='>'> c <!doctype x> <?php y ?> d") == ["a < b <1", "c d"]
    assert texts("<P CLASS=a class=b =x / y = 'z'>t</P\n>u") == ["t", "u"]
    assert leaves("<P CLASS=a class=b =x / y = 'z'>t")[0].path == ("p", "c:a")
    assert texts("x <a href='y") == ["x"] and texts("<!-->a") == ["a"] and texts("<p>&am<b>p;</b>") == ["&amp;"]
    assert texts("<ul><li>a<ul><li>b<li>c</ul>d<li>e</ul>") == ["a", "b", "c", "d", "e"]


def test_large_broken_pages_take_time_in_proportion():
    began = time.time()
    n = 250_000
    assert leaves("<a " * n) == [] and len(leaves("<p>x</p>" + "<a <b> " * n)) == 1
    deep = leaves("<div class=c>" * 100_000 + "deep" + "</span>" * 100_000 + "<h1>t" * 1_000)
    assert deep[0].text == "deep" and len(deep) == 1_001
    assert len(leaves("<p><section>" + "<foo>" * 100_000 + "<h2>x</h3>" * 10_000)) == 10_000
    for piece in ("<", "<!--", "</", "<svg>", "<a b=\"", "&", "<p x='", "</p", "<script ", "<svg/><title/>", "<a = / ="):
        leaves(piece * n)
    assert time.time() - began < 30


def test_a_page_of_very_many_blocks():
    story = "".join(f"<p>Sentence number {i} of the story, told at length.</p>" for i in range(20_000))
    text = main_texts([f"<html><body><nav><a href=#>x</a></nav><article>{story}</article></body></html>"], trained())[0]
    assert text.count("\n") > 19_000


def test_columns_of_any_name_pass(spark):
    df = spark.createDataFrame([(1, "<article><p>A story that is told here.</p></article>")], "page long, html string").withColumn("PAGE_", F.lit("x")).withColumn("__page", F.lit(2))
    r = extract_main_text(df).first()
    assert (r.page, r["PAGE_"], r["__page"]) == (1, "x", 2)
