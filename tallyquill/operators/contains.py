"""Containment of one text in another without comparing every pair."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyquill.functions.texts import let

ANCHOR = 4  # whole words that both sides must share


def _runs(parts: Column, n: int, f) -> Column:
    """f of every run of n parts (fewer at the end), each once."""
    return let(parts, lambda p: F.array_distinct(F.transform(p, lambda _, i: f(F.slice(p, i + 1, F.lit(n))))))


def contained_items(docs: DataFrame, items: DataFrame, doc_id: str, item_id: str) -> DataFrame:
    """(item_id, doc_id) of every item whose text stands literally in a document's.

    Items of enough words are looked up by an anchor: their second to fifth word, which are whole words of
    any document that contains them, joined on a hash with the documents' runs of as many words; the
    literal test follows. Shorter items are looked up by their first three characters, or all of fewer, among
    the distinct runs of as many characters of each document. docs: doc_id, text; items: item_id, item.
    """
    words = F.split("item", r"\s+", -1)
    anchored = items.where(F.size(words) >= ANCHOR + 2).select(item_id, "item", F.xxhash64(F.array_join(F.slice(words, 2, ANCHOR), " ")).alias("anchor"))
    runs = docs.select(doc_id, F.explode(_runs(F.split("text", r"\s+", -1), ANCHOR, lambda x: F.xxhash64(F.array_join(x, " ")))).alias("anchor"))
    near = runs.join(anchored, "anchor").select(item_id, "item", doc_id).distinct()
    short = items.where(F.size(words) < ANCHOR + 2)
    for n in () if short.isEmpty() else (1, 2, 3):
        heads = short.where(F.least(F.length("item"), F.lit(3)) == n).select(item_id, "item", F.substring("item", 1, n).alias("anchor"))
        runs = docs.select(doc_id, F.explode(_runs(F.split("text", ""), n, lambda x: F.array_join(x, ""))).alias("anchor"))
        near = near.unionByName(runs.join(heads, "anchor").select(item_id, "item", doc_id).distinct())
    empty = short.where("item = ''").select(item_id, F.explode(F.sequence(F.lit(0), F.lit(31))).alias("k"))  # stands in every text
    every = docs.where("text is not null").select(doc_id, F.pmod(F.hash(doc_id), F.lit(32)).alias("k")).join(empty, "k").select(item_id, doc_id)
    return near.join(docs, doc_id).where(F.contains("text", "item")).select(item_id, doc_id).unionByName(every)
