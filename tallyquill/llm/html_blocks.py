"""Main text of web pages by a recurrent labeller of leaf blocks.

A page is read as the sequence of its leaf blocks. A block's vector holds its hashed tag path (each tag
and each class or id word above it, and neighbouring pairs of them), its hashed words, and its shape
(length, share of link text, digits, full stops, place in the page). A bidirectional LSTM in numpy reads
the whole sequence, so that each block is judged by what surrounds it on the page, and labels it main
text or not.

The tables hold no labelled pages, so the network is trained here on pages that it makes up: articles
of invented words amid menus, headers, footers, sidebars, notices, adverts, forms and comments, in
semantic tags as well as in plain divs with the class words usual on the web, with unclosed tags and
other faults. Which block is main text is then known. The seed is fixed, so the network is always the same.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import cache
from random import Random

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyquill.llm.common import unused
from tallyquill.llm.html_leaves import PATH, Leaf, leaves

WORD, SHAPE = 256, 8
PROJECTED, HIDDEN = 24, 24
PAGES, EPOCHS, BATCH, RATE = 900, 5, 24, 6e-3


def _bucket(s: str, n: int) -> int:
    return zlib.crc32(s.encode()) % n


def vectors(blocks: list[Leaf], first: int = 0, total: int | None = None) -> np.ndarray:
    """A row for each block; the blocks are those from place ``first`` of a page of ``total``."""
    total = len(blocks) if total is None else total
    x = np.zeros((len(blocks), PATH + WORD + SHAPE), np.float32)
    for i, b in enumerate(blocks):
        x[i, :PATH] = np.unpackbits(np.frombuffer(b.places.to_bytes(PATH // 8, "little"), np.uint8), bitorder="little")
        for w in dict.fromkeys(b.text.lower().split()):
            x[i, PATH + _bucket(w, WORD)] += 1
        n, at = len(b.text), (first + i) / total
        x[i, PATH : PATH + WORD] /= max(1.0, np.linalg.norm(x[i, PATH : PATH + WORD]))  # of one length, however many words
        stops = sum(b.text.count(c) for c in ".!?;")
        x[i, -SHAPE:] = (min(1.5, np.log1p(n) / 6), b.link / n, min(1.0, stops / 4), min(1.0, n / 400), at, 1 - at, b.text[-1] in ".!?:;\"'”»", 1)
    return x


class Labeller:
    """Sequences of block vectors -> probability of main text for each block."""

    def __init__(self, seed: int = 9):
        rng = np.random.default_rng(seed)

        def normal(*shape):
            return (rng.normal(size=shape) * shape[0] ** -0.5).astype(np.float32)

        self.p = {"in": normal(PATH + WORD + SHAPE, PROJECTED) * 2, "in_b": np.zeros(PROJECTED, np.float32), "out": normal(2 * HIDDEN + PROJECTED, 1)[:, 0], "out_b": np.zeros(1, np.float32)}
        for d in "fb":
            self.p |= {f"w{d}": normal(PROJECTED + HIDDEN, 4 * HIDDEN), f"b{d}": np.concatenate((np.ones(HIDDEN), np.zeros(3 * HIDDEN))).astype(np.float32)}

    def _run(self, v: np.ndarray, mask: np.ndarray, d: str, back: bool = True):
        """v: (time, batch, PROJECTED), mask: (time, batch, 1). Hidden states and, if wanted, what the way back needs."""
        t, n, _ = v.shape
        h, c, w, b = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32), self.p["w" + d], self.p["b" + d]
        out, kept = np.zeros((t, n, HIDDEN), np.float32), []
        for i in range(t) if d == "f" else range(t - 1, -1, -1):
            z = np.concatenate((v[i], h), 1)
            a = z @ w + b
            gates = 1 / (1 + np.exp(-a[:, : 3 * HIDDEN]))
            f, g_in, g_out, new = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :], np.tanh(a[:, 3 * HIDDEN :])
            c2 = f * c + g_in * new
            tc = np.tanh(c2)
            if back:
                kept.append((i, z, f, g_in, g_out, new, c, tc))
            h, c = mask[i] * (g_out * tc) + (1 - mask[i]) * h, mask[i] * c2 + (1 - mask[i]) * c
            out[i] = h
        return out, kept

    def _back(self, dout: np.ndarray, mask: np.ndarray, kept: list, d: str, g: dict) -> np.ndarray:
        w, dv = self.p["w" + d], np.zeros((*dout.shape[:2], PROJECTED), np.float32)
        g["w" + d], g["b" + d] = np.zeros_like(w), np.zeros(4 * HIDDEN, np.float32)
        dh, dc = np.zeros(dout.shape[1:], np.float32), np.zeros(dout.shape[1:], np.float32)
        for i, z, f, g_in, g_out, new, c, tc in reversed(kept):
            dh = dh + dout[i]
            m = mask[i]
            da_h, dc_all = dh * m, dc * m
            d2 = dc_all + da_h * g_out * (1 - tc**2)
            da = np.concatenate((d2 * c * f * (1 - f), d2 * new * g_in * (1 - g_in), da_h * tc * g_out * (1 - g_out), d2 * g_in * (1 - new**2)), 1)
            g["w" + d] += z.T @ da
            g["b" + d] += da.sum(0)
            dz = da @ w.T
            dv[i] = dz[:, :PROJECTED]
            dh, dc = dz[:, PROJECTED:] + dh * (1 - m), d2 * f + dc * (1 - m)
        return dv

    def project(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(x @ self.p["in"] + self.p["in_b"])

    def embed(self, blocks: list[Leaf]) -> np.ndarray:
        """Projected vectors of a page's blocks, some thousands at a time: the wide ones never stand together."""
        return np.concatenate([self.project(vectors(blocks[i : i + 2048], i, len(blocks))) for i in range(0, len(blocks), 2048)])

    def forward(self, x: np.ndarray, mask: np.ndarray):
        return self.read(self.project(x), mask)

    def read(self, v: np.ndarray, mask: np.ndarray, back: bool = True):
        hf, kf = self._run(v, mask, "f", back)
        hb, kb = self._run(v, mask, "b", back)
        last = np.concatenate((hf, hb, v), 2)
        return last @ self.p["out"] + self.p["out_b"][0], (v, last, kf, kb)

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        logit, (v, last, kf, kb) = self.forward(x, mask)
        d = ((1 / (1 + np.exp(-logit)) - y) * mask[:, :, 0] / mask.sum()).astype(np.float32)
        g = {"out": np.einsum("tn,tnk->k", d, last), "out_b": d.sum(keepdims=True).reshape(1)}
        dl = d[:, :, None] * self.p["out"]
        dv = dl[:, :, 2 * HIDDEN :] + self._back(dl[:, :, :HIDDEN], mask, kf, "f", g) + self._back(dl[:, :, HIDDEN : 2 * HIDDEN], mask, kb, "b", g)
        da = dv * (1 - v**2)
        g["in"] = np.einsum("tnk,tnp->kp", x, da, optimize=True)
        g["in_b"] = da.sum((0, 1))
        return g

    def label(self, pages: list[list[Leaf]]) -> list[np.ndarray]:
        """Whether each block of each page is main text; pages of like length go together."""
        out = [np.zeros(0, bool)] * len(pages)
        order = sorted((i for i, p in enumerate(pages) if p), key=lambda i: len(pages[i]))
        at = 0
        while at < len(order):
            take = max(1, min(64, 6_000 // len(pages[order[min(at + 63, len(order) - 1)]])))
            some = order[at : at + take]
            at += take
            v, mask, _ = padded([(self.embed(pages[i]), None) for i in some])
            logit, _ = self.read(v, mask, back=False)
            for k, i in enumerate(some):
                out[i] = logit[: len(pages[i]), k] > 0
        return out


def padded(rows: list):
    t = max(len(x) for x, _ in rows)
    x = np.zeros((t, len(rows), rows[0][0].shape[1]), np.float32)
    mask, y = np.zeros((t, len(rows), 1), np.float32), np.zeros((t, len(rows)), np.float32)
    for k, (v, labels) in enumerate(rows):
        x[: len(v), k], mask[: len(v), k] = v, 1
        if labels is not None:
            y[: len(v), k] = labels
    return x, mask, y


# ---- pages made up for training -------------------------------------------------------------------

#: Class words usual for each region on the web (fixed values).
CLASSES = {
    "main": ["content", "main", "post", "entry", "article-body", "story", "post-content", "entry-content", "article", "text", "body-copy", "page-content", "maincontent"],
    "nav": ["nav", "menu", "navbar", "navigation", "breadcrumb", "breadcrumbs", "topnav", "main-menu", "pagination", "toc", "links"],
    "header": ["header", "masthead", "site-header", "branding", "topbar", "logo", "page-header", "banner"],
    "footer": ["footer", "site-footer", "copyright", "legal", "bottom", "foot", "credits"],
    "aside": ["sidebar", "widget", "related", "recommended", "side", "rail", "popular", "trending", "more-stories", "tags", "share", "social", "author-box"],
    "ad": ["ad", "ads", "advert", "advertisement", "sponsored", "promo", "ad-slot", "banner-ad", "commercial"],
    "notice": ["notice", "cookie", "cookie-banner", "consent", "alert", "gdpr", "popup", "modal", "newsletter", "paywall", "subscribe", "message"],
    "form": ["form", "search", "login", "signup", "search-form", "contact-form", "subscribe-form"],
    "comments": ["comments", "comment", "comment-list", "discussion", "responses", "replies", "disqus", "reader-comments"],
}
TAGS = {"main": ["article", "main", "div", "section"], "nav": ["nav", "div", "ul"], "header": ["header", "div"], "footer": ["footer", "div"], "aside": ["aside", "div", "section"], "ad": ["div", "aside", "ins-box"], "notice": ["div", "section", "aside"], "form": ["form", "div"], "comments": ["section", "div", "ol"]}
#: Words usual in each region.
SAYS = {
    "nav": "Home About Contact News Blog Products Services Login Help Sitemap Next Previous",
    "header": "Welcome Home Menu Search Skip to content",
    "footer": "Copyright © All rights reserved · Terms Privacy Policy Imprint Contact",
    "aside": "Related Popular Recommended Read more Share Follow us Tags Latest Archives",
    "ad": "Advertisement Sponsored Buy now Shop Offer Sale Free Click here",
    "notice": "We use cookies Accept Decline This site Subscribe to our newsletter Agree",
    "form": "Name Email Search Submit Send Password Sign in Register Your message",
    "comments": "says: Reply Comments Posted on likes Leave a comment Report",
}


def made_page(rnd: Random) -> tuple[str, list[bool]]:
    """A page and, for each of its leaves, whether it is main text. Main text carries a mark (a private
    character) while the page is made, which is taken out again once the leaves are known."""
    letters = rnd.choice(["etaoinshrdlu", "enisratdhulcgmobß", "eaosrnidlctumpbgvyqé", "abcdefghijklmnoprstuvwxyz"])
    lexicon = ["".join(rnd.choices(letters, k=rnd.randint(1, 9))) for _ in range(rnd.randint(60, 400))]

    def words(lo: int, hi: int, usual: str = "") -> str:
        own = usual.split()
        out = [rnd.choice(own) if own and rnd.random() < 0.5 else rnd.choice(lexicon) for _ in range(rnd.randint(lo, hi))]
        return " ".join(out)

    def sentence(lo: int = 3, hi: int = 22) -> str:
        return words(lo, hi).capitalize() + rnd.choice(".....!?,:;") * (rnd.random() < 0.9)

    def open_tag(kind: str) -> tuple[str, str]:
        tag = rnd.choice(TAGS[kind])
        plain = rnd.random() < (0.5 if tag not in ("div", "section", "ul", "ol") else 0.04)
        names = "" if plain else f' {rnd.choice(["class", "class", "id"])}="{rnd.choice(CLASSES[kind])}{rnd.choice(["", "", " x" + rnd.choice(lexicon)])}"'
        tag = "div" if tag == "ins-box" else tag
        return f"<{tag}{names}>", f"</{tag}>"

    def region(kind: str) -> str:
        a, b = open_tag(kind)
        usual = SAYS[kind] if rnd.random() < 0.5 else ""
        shape = rnd.random()
        if kind == "nav" or kind in ("aside", "footer", "header") and shape < 0.45:
            items = [f'<li><a href="/{i}">{words(1, 5, usual)}</a></li>' for i in range(rnd.randint(2, 9))]
            body = "".join(items) if a.startswith("<ul") else "<ul>" + "".join(items) + "</ul>" if rnd.random() < 0.8 else " ".join(f'<a href="#">{words(1, 3, usual)}</a>' for _ in items)
            if kind == "aside" and rnd.random() < 0.6:
                body = f"<h3>{words(1, 3, usual)}</h3>" + body
        elif kind == "form":
            body = "".join(f"<p><label>{words(1, 3, usual)}</label><input name=x></p>" for _ in range(rnd.randint(1, 4))) + f"<button>{words(1, 2, usual)}</button>"
            if rnd.random() < 0.5:
                body = f"<p>{sentence()}</p>" + body
        elif kind == "comments":
            inner = rnd.choice([("<div class=comment>", "</div>"), ("<li class=comment>", "</li>"), ('<article class="comment">', "</article>")])
            body = f"<h3>{words(1, 3, usual)}</h3>" + "".join(f"{inner[0]}<p>{words(1, 4, usual)}</p><p>{' '.join(sentence() for _ in range(rnd.randint(1, 5)))}</p>{inner[1]}" for _ in range(rnd.randint(1, 6)))
        else:
            texts = [" ".join([words(2, 6, usual), *(sentence() for _ in range(rnd.randint(0, 3)))]) for _ in range(rnd.randint(1, 3))]
            body = texts[0] if len(texts) == 1 and rnd.random() < 0.7 else "".join(f"<p>{x}</p>" for x in texts)
        return a + body + b

    mark = "\ue000"
    blocks = []
    for k in range(rnd.choice([1, 1, 2, 3, 5, 8, 13, 24])):
        text = " ".join(sentence() for _ in range(rnd.choice([1, 1, 2, 4, 8])))
        if rnd.random() < 0.2:
            text = words(1, 3) + "."
        elif rnd.random() < 0.1:  # bad text is main text all the same
            text = " ".join(rnd.choice(lexicon).capitalize() + " " + " ".join([rnd.choice(lexicon)] * rnd.randint(3, 60)) for _ in range(rnd.randint(1, 3)))
        elif rnd.random() < 0.1:
            text = " ".join(w + rnd.choice(["***", "!!", "%%%", " |", "###"]) for w in text.upper().split())
        shape = rnd.random()
        if shape < 0.1:
            blocks.append(f"<h{rnd.randint(2, 4)}>{mark}{words(1, 7)}</h2>")
        elif shape < 0.16:
            blocks.append("<ul>" + "".join(f"<li>{mark}{sentence()}</li>" for _ in range(rnd.randint(2, 6))) + "</ul>")
        elif shape < 0.2:
            blocks.append(f"<blockquote>{mark}{text}</blockquote>")
        elif shape < 0.23:
            blocks.append(f"<table><tr><td>{mark}{words(1, 4)}</td><td>{mark}{words(1, 4)}</td></tr></table>")
        elif shape < 0.4:
            blocks.append(f"<p><b>{mark}{text}<br>")
        elif shape < 0.5:
            blocks.append(f'<p>{mark}{text} <a href="/x">{words(1, 3)}</a> {words(1, 5)}</p>')
        else:
            blocks.append(f"<p>{mark}{text}</p>" if rnd.random() < 0.9 else f"<p>{mark}{text}")
        if rnd.random() < 0.06:
            blocks.append(region(rnd.choice(["ad", "aside", "notice", "form"])))
    title = words(2, 10)
    heading = f"<h1>{mark}{title}</h1>" if rnd.random() < 0.8 else ""
    if heading and rnd.random() < 0.2:
        heading = f"<header>{heading}</header>"
    a, b = open_tag("main")
    if rnd.random() < 0.25:
        a, b = f'<div class="{rnd.choice(["wrapper", "container", "row", "page", "layout"])}">' + a, b + "</div>"
    before = [region(k) for k in ("header", "nav", "notice", "ad", "aside", "form") if rnd.random() < (0.75 if k == "nav" else 0.35)]
    after = [region(k) for k in ("aside", "comments", "form", "ad", "nav", "notice") if rnd.random() < 0.3]
    rnd.shuffle(after)
    if rnd.random() < 0.8:
        after.append(region("footer"))
    head = f'<!DOCTYPE html><html><head><meta charset="utf-8"><title>{title}</title><style>p{{margin:0}}</style><script>var t="</p>";</script></head><body>'
    page = head + "".join(before) + a + heading + "".join(blocks) + b + "".join(after) + "</body></html>" * (rnd.random() < 0.7)
    labels = [x.text.startswith(mark) for x in leaves(page)]
    return page.replace(mark, ""), labels


@cache
def trained(pages: int = PAGES, epochs: int = EPOCHS, seed: int = 17) -> Labeller:
    """The network, made once in a process."""
    rnd, rng, net = Random(seed), np.random.default_rng(seed), Labeller()
    rows = []
    for _ in range(pages):
        page, labels = made_page(rnd)
        found = leaves(page)
        if len(found) == len(labels):
            rows.append((vectors(found), labels))
    first, second, t = {}, {}, 0
    steps = epochs * -(-len(rows) // BATCH)
    for _ in range(epochs):
        # batches of like length, in random order
        order = np.argsort([len(x) + rng.random() * 8 for x, _ in rows], kind="stable")
        starts = rng.permutation(np.arange(0, len(rows), BATCH))
        for lo in starts:
            t += 1
            rate = RATE * (1 - 0.9 * t / steps)
            for k, g in net.gradients(*padded([rows[i] for i in order[lo : lo + BATCH]])).items():
                g = np.clip(g, -1, 1)
                first[k] = 0.9 * first.get(k, 0) + 0.1 * g
                second[k] = 0.999 * second.get(k, 0) + 0.001 * g * g
                net.p[k] -= (rate * first[k] / (1 - 0.9**t) / (np.sqrt(second[k] / (1 - 0.999**t)) + 1e-7)).astype(np.float32)
    return net


def main_texts(pages: list[str], net: Labeller) -> list[str]:
    found = [leaves(p) for p in pages]
    return ["\n".join(b.text for b, good in zip(f, y, strict=True) if good) for f, y in zip(found, net.label(found), strict=True)]


def extract_main_text(pages: DataFrame, html_col: str = "html", out_col: str = "text") -> DataFrame:
    """pages with the main text in out_col, replacing a column of that name; null and empty pages have
    none ("" ). Whole pages are read, every block labelled main text is given whole. Repeated rows stay."""
    net = trained()
    others = [c for c in pages.columns if c not in (html_col, out_col)]
    rows = pages.select(*(F.col(f"`{c}`") for c in others), F.coalesce(F.col(f"`{html_col}`").cast("string"), F.lit("")).alias(unused("page", others)))
    schema = rows.select(*(F.col(f"`{c}`") for c in others), F.lit("").alias(out_col)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                texts = main_texts(part.column(len(others)).to_pylist(), net)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(texts, pa.string())], names=[*others, out_col])

    return rows.mapInArrow(run, schema)
