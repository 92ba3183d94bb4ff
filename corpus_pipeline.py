"""The corpus pipeline: five stages, each an operator applied to all that the stage before it kept.

Documents that score as toxic go; of equal texts the row with the largest doc_id stays; of each component
of near duplicates (5-word shingles, Jaccard 0.8) the row with the smallest doc_id stays; secrets are
replaced by a mark; what is left is packed into sequences of 4096 tokens. Each stage's result is
written as Parquet and read again by the next. All but the last return the columns of documents.

Null texts count as empty and pass as such. Rows repeated with one id and text lose their copies in exact
dedup; rows with a null doc_id can be no near duplicates and stay. An empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyquill.llm import toxicity
from tallyquill.llm.common import read, text_or_empty, unused, written
from tallyquill.llm.exact_dedup import exact_dedup
from tallyquill.llm.ngram_join import near_duplicates
from tallyquill.llm.packing import pack_documents
from tallyquill.llm.queries import WORD_BPE
from tallyquill.llm.secret_scan import redacted, scan_secrets

#: Least toxicity score at which a document is rejected.
TOXIC_FROM = toxicity.THRESHOLD


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text does not score as toxic under a model fitted on the labels that are not held out."""
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"))
    score = unused("score", docs.columns)
    return toxicity.with_scores(docs, model, score).where(F.col(score) < TOXIC_FROM).drop(score)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts. Rows repeated with the id that stays count as one: they meet in
    the semi join's own partitioning, so the texts move once here."""
    null, key, sha, nth = (unused(n, docs.columns) for n in ("null", "key", "sha", "nth"))

    def keys(text_sha: Column) -> dict:
        """Columns that tell a row's id, null ids included, and text."""
        return {null: F.col("doc_id").isNull(), key: F.coalesce(F.col("doc_id"), F.lit(0)), sha: text_sha}

    kept = exact_dedup(docs).where("kept").select(*(c.alias(n) for n, c in keys(F.col("text_sha256")).items()))
    keyed = docs.withColumns(keys(F.sha2(text_or_empty("text"), 256)))
    names = [null, key, sha]
    place = F.row_number().over(Window.partitionBy(*names).orderBy(F.lit(0)))
    return keyed.join(kept, names, "left_semi").withColumn(nth, place).where(F.col(nth) == 1).select(*(F.col(f"`{c}`") for c in docs.columns))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one of smallest id, of each component of near duplicates."""
    key = unused("key", docs.columns)
    gone = near_duplicates(docs).where("doc_id <> component_id").select(F.col("doc_id").alias(key)).distinct()
    return docs.join(gone, docs["doc_id"] == F.col(key), "left_anti")


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with each found secret replaced by a mark; n_chars follows where a text changed."""
    base, spans, text = (unused(n, docs.columns) for n in ("base", "spans", "hidden"))
    found = scan_secrets(docs, base_col=base, all_col=spans)
    found = found.withColumn(text, redacted(text_or_empty("text"), F.col(spans)))
    changed = F.size(spans) > 0
    new = {"text": F.when(changed, F.col(text)).otherwise(F.col("text")), "n_chars": F.when(changed, F.length(text).cast("long")).otherwise(F.col("n_chars"))}
    return found.select(*(new.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in sequences."""
    return pack_documents(docs, WORD_BPE)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_exact_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("secret scans", mask_secrets),
    ("best-fit packing", pack),
]

#: Toxicity and packing cannot be said in SQL; tests compare the pipeline with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"pipeline-{k}")
    return docs
