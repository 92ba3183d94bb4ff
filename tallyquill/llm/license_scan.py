"""License scan by diagonal voting, in DataFrame functions alone.

1. Every text's words are read; of all its rolling word k-grams those whose hash is a template's are joined,
   hash and words alike, with the templates' positions. The set of template hashes is fixed and small, so
   grams of no template end where they arise and only hits become rows.
2. A hit at word p of a text and word t of a template votes for the diagonal p - t: the place where the
   template would begin. Hits are counted by text, template and diagonal.
3. Diagonals of a template no further apart than its ``gap`` are merged, since a word more or less moves
   what follows to the next diagonal.
4. A merged span is verified by the share of the template's grams found in it (coverage) and the share of the
   span's grams that are the template's (density).

Base phrases are templates whose gap is 0 and whose coverage must be whole, so a verified span of one is a place
where its words stand one after the other. Texts never move: one shuffle takes a short row for each text and each hit.
"""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyquill.llm.common import text_or_empty
from tallyquill.llm.secret_scan import let

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # of text whose A-Z are lower-cased
NOTICE_GRAM, PHRASE_GRAM = 5, 2
MOST_GAP = 8
LEAST_COVERAGE, LEAST_DENSITY = 0.6, 0.5

#: The base phrases and their labels.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

#: Notices as their licenses ask for them, and the label that each gives.
NOTICES = (
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at"),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software"),
    ("cc-by", "This work is licensed under the Creative Commons Attribution 4.0 International License."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
)


class Template(NamedTuple):
    name: str
    label: str
    words: list[str]
    width: int  # words of a gram
    gap: int  # most that neighbouring diagonals of one span differ by
    base: bool
    coverage: float  # least share of the grams that a span must show


def words_of(text: str) -> list[str]:
    return re.findall(WORD, text.translate(str.maketrans(UPPER, LOWER)))


def templates(phrases=PHRASES, notices=NOTICES) -> list[Template]:
    out = [Template(f"phrase{i}", label, words_of(p), PHRASE_GRAM, 0, True, 1.0) for i, (p, label) in enumerate(phrases)]
    for i, (label, text) in enumerate(notices):
        words = words_of(text)
        out.append(Template(f"notice{i}", label, words, NOTICE_GRAM, min(MOST_GAP, len(words) // 3), False, LEAST_COVERAGE))
    return out


def positions(spark: SparkSession, known: list[Template]) -> DataFrame:
    """(gram, template, label, base, gap, least, n_grams, t): every gram of every template at its place."""
    rows = ", ".join(f"(array({', '.join(repr(w) for w in t.words[i : i + t.width])}), '{t.name}', '{t.label}', {t.base}, {t.gap}, double({t.coverage}), {len(t.words) - t.width + 1}, {i})" for t in known for i in range(len(t.words) - t.width + 1))
    return spark.sql(f"SELECT *, xxhash64(gram) AS h FROM VALUES {rows} AS g(gram, template, label, base, gap, least, n_grams, t)")


FINDING = "struct<start:int,end:int,template:string,label:string,base:boolean,coverage:double,verified:boolean>"


def scan_licenses(docs: DataFrame, known: list[Template] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_words, findings (sorted by start): the spans of templates, with start and
    end in words, the share of the template they cover and whether they are verified.

    A null text is empty and has neither words nor findings. Repeated rows and null ids each give their own
    row. An empty table gives an empty result; other columns are ignored.
    """
    grams = positions(docs.sparkSession, known or templates())
    of_width: dict[int, list[int]] = {}
    for r in grams.select(F.size("gram").alias("k"), "h").distinct().collect():  # of the templates, which are fixed
        of_width.setdefault(r.k, []).append(r.h)

    def hits(w: Column) -> Column:
        """(p, gram) of the text's grams whose hash is some template's."""

        def of(k: int) -> Column:
            return F.array_compact(F.transform(w, lambda _, i: F.when(F.xxhash64(*(F.get(w, i + j) for j in range(k))).isin(of_width[k]), F.struct(i.alias("p"), F.slice(w, i + 1, F.lit(k)).alias("gram")))))

        return F.struct(F.size(w).alias("n"), F.concat(*map(of, sorted(of_width))).alias("hits"))

    words = F.regexp_extract_all(F.translate(text_or_empty(text_col), UPPER, LOWER), F.lit(WORD), F.lit(0))
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), let(words, hits).alias("s"), F.monotonically_increasing_id().alias("row"))
    each = rows.select("row", "doc_id", F.col("s.n").alias("n"), F.explode_outer("s.hits").alias("hit")).select("row", "doc_id", "n", "hit.p", "hit.gram").withColumn("h", F.xxhash64("gram"))
    # a row for each hit and each text without any; the templates are broadcast, they are fixed
    placed = each.join(F.broadcast(grams), ["h", "gram"], "left").drop("h", "gram").withColumn("diagonal", F.col("p") - F.col("t")).repartition("row")
    of_template = ["row", "doc_id", "n", "template", "label", "base", "gap", "least", "n_grams"]
    votes = placed.groupBy(*of_template, "diagonal").agg(F.collect_set("t").alias("seen"), F.count("p").alias("votes"), F.min("p").alias("lo"), F.max("p").alias("hi"))
    along = Window.partitionBy("row", "template").orderBy("diagonal")
    far = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(along) > F.col("gap"), F.lit(True))
    spans = votes.withColumn("far", far.cast("int")).withColumn("span", F.sum("far").over(along))
    spans = spans.groupBy(*of_template, "span").agg(F.size(F.array_distinct(F.flatten(F.collect_list("seen")))).alias("seen"), F.sum("votes").alias("votes"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    coverage, density = F.col("seen") / F.col("n_grams"), F.col("votes") / (F.col("hi") - F.col("lo") + 1)
    width = F.when(F.col("base"), PHRASE_GRAM).otherwise(NOTICE_GRAM)
    verified = (coverage >= F.col("least")) & (density >= LEAST_DENSITY)
    finding = F.when(F.col("template").isNotNull(), F.struct(F.col("lo").alias("start"), (F.col("hi") + width).alias("end"), "template", "label", "base", coverage.alias("coverage"), verified.alias("verified")).cast(FINDING))
    return spans.groupBy("row", "doc_id", "n").agg(F.array_sort(F.collect_list(finding)).alias("findings")).select("doc_id", F.col("n").cast("long").alias("n_words"), "findings")


def license_rows(docs: DataFrame, known: list[Template] | None = None) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of every row of docs.

    score is the largest share of a template that a verified span covers, 0 without any.
    """
    good = F.filter("findings", lambda f: f["verified"])
    base = F.filter("findings", lambda f: f["verified"] & f["base"])

    def labels(found: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(found, lambda f: f["label"]))), ",")

    starts = F.transform(base, lambda f: f["start"])
    return scan_licenses(docs, known).select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"), F.array_max(starts).cast("long").alias("last_word"),
        labels(base).alias("base_labels"), labels(good).alias("labels"),
        F.coalesce(F.array_max(F.transform(good, lambda f: f["coverage"])), F.lit(0.0)).alias("score"),
    )


def _list(words: list[str]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def license_sql(known: list[Template] | None = None) -> str:
    """The same in DuckDB, grams joined by their words."""
    rows = ", ".join(f"('{t.name}', '{t.label}', {t.base}, {t.width}, {t.gap}, {t.coverage}, {_list(t.words)})" for t in known or templates())
    return f"""WITH t(template, label, base, k, gap, least, words) AS (VALUES {rows}),
g AS (SELECT * EXCLUDE (words), words[pos + 1:pos + k] AS gram FROM (SELECT *, len(words) - k + 1 AS n_grams, unnest(range(0, len(words) - k + 1)) AS pos FROM t)),
d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w FROM documents),
e AS (SELECT r, i, w[i + 1:i + {PHRASE_GRAM}] AS gram FROM (SELECT r, w, unnest(range(0, len(w) - {PHRASE_GRAM} + 1)) AS i FROM d) UNION ALL SELECT r, i, w[i + 1:i + {NOTICE_GRAM}] FROM (SELECT r, w, unnest(range(0, len(w) - {NOTICE_GRAM} + 1)) AS i FROM d)),
v AS (SELECT r, template, label, base, k, gap, least, n_grams, i - pos AS diagonal, count(*) AS votes, list(pos) AS seen, min(i) AS lo, max(i) AS hi FROM e JOIN g USING (gram) GROUP BY ALL),
f AS (SELECT *, sum(far) OVER (PARTITION BY r, template ORDER BY diagonal) AS span FROM (SELECT *, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY r, template ORDER BY diagonal) <= gap THEN 0 ELSE 1 END AS far FROM v)),
s AS (SELECT r, label, base, min(lo) AS lo, len(list_distinct(flatten(list(seen)))) / n_grams AS coverage, sum(votes) / (max(hi) - min(lo) + 1) AS density, least FROM f GROUP BY r, template, label, base, least, n_grams, span),
x AS (SELECT r, count(*) FILTER (WHERE base) AS n_base, min(lo) FILTER (WHERE base) AS first_word, max(lo) FILTER (WHERE base) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base) AS base_labels,
  string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(coverage) AS score FROM s WHERE coverage >= least AND density >= {LEAST_DENSITY} GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, CAST(coalesce(score, 0) AS DOUBLE) AS score FROM d LEFT JOIN x USING (r)"""
