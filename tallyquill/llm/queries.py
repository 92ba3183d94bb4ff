"""One query per operator, with production parameters, and the SQL of those that SQL can express."""

from __future__ import annotations

from public_tokenizers import path
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyquill.llm.ann_graph import nearest
from tallyquill.llm.ball_kmeans import cluster_rows, cluster_sql
from tallyquill.llm.bpe_chunks import code_documents
from tallyquill.llm.common import read
from tallyquill.llm.divergence import divergence_sql, source_divergence
from tallyquill.llm.exact_dedup import exact_dedup
from tallyquill.llm.html_blocks import extract_main_text
from tallyquill.llm.langid import identify_languages
from tallyquill.llm.license_scan import license_rows, license_sql
from tallyquill.llm.ngram_join import near_duplicates
from tallyquill.llm.packing import pack_documents
from tallyquill.llm.quality_cnn import quality_rows
from tallyquill.llm.secret_scan import joined, scan_secrets
from tallyquill.llm.toxicity import toxic_rows

#: Files of the public tokenizers; a parameter of the operators that read them.
BYTE_BPE, WORD_BPE = path("byte_bpe_50k.json"), path("word_bpe_49k.json")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every page, from its text, its markup, its address and its host."""
    return identify_languages(read(spark, sf_dir, "pages"), read(spark, sf_dir, "documents"))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of 4-word shingles reach Jaccard 0.85."""
    return near_duplicates(read(spark, sf_dir, "documents"), 4, 85)


def op3_ann_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest vectors of every row whose vec_id is divisible by 50, among all rows."""
    vectors = read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nearest(vectors, vectors.where(F.col("vec_id") % 50 == 0), 5)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, by a model of the labels that are not held out."""
    return toxic_rows(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op5_html_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract_main_text(read(spark, sf_dir, "pages").select("page_id", "url", "html")).withColumn("n_chars", F.length("text").cast("long"))


def op6_quality_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, by a network fitted on the labels that are not held out."""
    return quality_rows(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and entropy findings of every document, as places."""
    found = scan_secrets(read(spark, sf_dir, "documents").select("doc_id", "text"))

    def count(kind: int):
        return F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(joined(F.col("base_spans")), 256).alias("base_sha256"),
        joined(F.col("all_spans")).alias("spans"),
    )


def op8_bpe_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document and their decoded text, as digests."""
    return code_documents(read(spark, sf_dir, "documents"), BYTE_BPE)


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group of equal texts of every document, and which row of it stays."""
    return exact_dedup(read(spark, sf_dir, "documents"))


OP9_SQL = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""


def op10_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces, packed into sequences of 4096 tokens."""
    return pack_documents(read(spark, sf_dir, "documents"), WORD_BPE)


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of license phrases and notices in every document."""
    return license_rows(read(spark, sf_dir, "documents").select("doc_id", "text"))


def op12_ball_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster of every vector after ten exact rounds with eight centroids."""
    return cluster_rows(read(spark, sf_dir, "embeddings"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the sources of each language lie from each other, and each source's terms."""
    return source_divergence(read(spark, sf_dir, "documents").select("lang", "source", "text"))


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_ngram_join": op2_ngram_join,
    "op3_ann_graph": op3_ann_graph,
    "op4_toxicity": op4_toxicity,
    "op5_html_blocks": op5_html_blocks,
    "op6_quality_cnn": op6_quality_cnn,
    "op7_secret_scan": op7_secret_scan,
    "op8_bpe_chunks": op8_bpe_chunks,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_best_fit": op10_best_fit,
    "op11_license_scan": op11_license_scan,
    "op12_ball_kmeans": op12_ball_kmeans,
    "op13_source_divergence": op13_source_divergence,
}
ORACLE = {"op9_exact_dedup": OP9_SQL, "op11_license_scan": license_sql(), "op12_ball_kmeans": cluster_sql(), "op13_source_divergence": divergence_sql()}
