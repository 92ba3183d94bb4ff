import re
from collections import Counter, defaultdict

import duckdb
import pytest

from tallyquill.llm import divergence
from tallyquill.llm.divergence import divergence_sql, pieces, source_divergence


def by_hand(rows, least, top):
    n, docs = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        w = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        n[lang or "", source or ""].update(w)
        docs[lang or ""].update(set(w))
    out = []
    for lang, source in n:
        kept = [t for t, k in docs[lang].items() if k >= least]
        all_of = sum((n[g] for g in n if g[0] == lang), Counter())

        def p(c, kept=kept):
            total = sum(c[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (c[t] + 5) // (total + 5 * len(kept)) for t in kept}

        mine, q = p(n[lang, source]), p(all_of)
        pairs = [(sum(abs(mine[t] - o[t]) for t in kept), s) for s in sorted(g[1] for g in n if g[0] == lang and g[1] != source) for o in [p(n[lang, s])]]
        terms = [(mine[t] - q[t], t) for t in kept if n[lang, source][t] and mine[t] > q[t]]
        for part, found, most in (("pair", pairs, None), ("term", terms, top)):
            found.sort(key=lambda x: (-x[0], x[1].encode()))
            out += [(lang, source, part, item, v, i + 1) for i, (v, item) in enumerate(found[:most])]
    return sorted(out)


ROWS = [("en", f"s{i % 5}", f"the Fox{i % 3} word{i % 7} é{'x' * (i % 2)} {'hot ' * (i % 11)}\n1{i}") for i in range(60)]
ROWS += [("de", None, "ein Wort"), ("de", "", "ein ein"), ("de", "b", None), (None, "b", "solo"), ("fr", "a", "rare"), ("fr", "b", ""), ("en", "s0", ROWS[0][2]), ("en", "s0", ROWS[0][2]), ("en", "bare", "123 ...")]
SCHEMA = "lang string, source string, text string, term string, shard int, n long"


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame([(*r, "t", 1, 2) for r in ROWS], SCHEMA).repartition(5)  # columns named like the operator's own


@pytest.mark.parametrize("least, top", [(2, 50), (1, 3), (30, 50), (999, 5)])
def test_by_hand(rows, least, top):
    got = sorted(map(tuple, source_divergence(rows, least, top).collect()))
    assert got == by_hand(ROWS, least, top)


def test_small_parts_give_the_same(rows, monkeypatch):
    want = sorted(map(tuple, source_divergence(rows, 2).collect()))
    monkeypatch.setattr(divergence, "HELD", 1)
    assert list(divergence._counts(iter([]))) == []
    assert sorted(map(tuple, source_divergence(rows, 2, shards=37).collect())) == want


def test_sql_says_the_same(rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (lang VARCHAR, source VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", ROWS)
    assert sorted(con.execute(divergence_sql(2, 3)).fetchall()) == sorted(map(tuple, source_divergence(rows, 2, 3).collect()))


def test_long_texts_are_cut_between_terms():
    text = (b"ab " * 200_000) + b"x" * 600_000 + b" " + b"y" * 10
    cut = list(pieces(text))
    assert b"".join(cut) == text and len(cut) > 2
    assert sum((Counter(re.findall(rb"[a-z]+", c)) for c in cut), Counter()) == Counter(re.findall(rb"[a-z]+", text))


def test_empty_table(rows):
    assert source_divergence(rows.limit(0)).collect() == []
