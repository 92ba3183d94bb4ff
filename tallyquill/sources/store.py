"""Sinks: archives as JSON, results in a snapshot store, and routing. Versions beyond that are in ``versions``."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyquill.functions import names as N
from tallyquill.sources.rows import PAPER_COLUMNS, document_rows, question_rows, run_rows
from tallyquill.sources.snapshots import Layout, Snapshot, Store, joined


def archive_rows(results: DataFrame) -> DataFrame:
    """Results as archived: question keys added; the latest file's name and the history file's name."""
    sha = F.col("source.sha256")
    keyed = F.transform("document.questions", lambda q: q.withField("question_key", N.question_key(sha, q["source_question_id"])))
    stem = N.safe_stem(F.col("source.file_name"))
    return results.withColumn("document", F.col("document").withField("questions", keyed)).withColumns({"paper": N.paper_key(sha), "latest": F.concat_ws("-", stem, N.paper_key(sha)), "history": F.concat_ws("/", stem, F.col("run.run_id"))})


BUCKETS = 64  # folders of an archive, whatever the number of its papers or students


def in_buckets(rows: DataFrame, key: str) -> DataFrame:
    """rows with the bucket of their key, a task for each bucket, so that a write makes at most a file in each."""
    return rows.withColumn("bucket", F.pmod(F.hash(key), F.lit(BUCKETS)).cast("int")).repartition("bucket")


def replace_latest(rows: DataFrame, key: str, path: str) -> None:
    """Put each key's new row in place of its old one: buckets of other keys are left as they lie."""
    spark, new = rows.sparkSession, in_buckets(rows, key)
    touched = [r[0] for r in new.select("bucket").distinct().collect()]
    try:
        old = spark.read.schema(new.schema).json(path).where(F.col("bucket").isin(touched)).join(rows.select(key), key, "left_anti")
        new = new.unionByName(old).repartition("bucket")
    except AnalysisException as e:  # the first write: there is nothing yet
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
    new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").json(path)


def write_archive(results: DataFrame, base: str) -> None:
    """As JSON lines: base/latest, a row a paper, replaced by newer runs of it, and base/history, appended."""
    rows = archive_rows(results)
    in_buckets(rows, "paper").write.mode("append").partitionBy("bucket").json(f"{base}/history")
    replace_latest(rows, "paper", f"{base}/latest")


def without_run(tables: dict[str, DataFrame], run_id: str) -> dict[str, DataFrame]:
    """Tables without the rows of a run."""
    return {name: df.where(F.col("run_id") != run_id) for name, df in tables.items()}


def route(documents: DataFrame, blocking: Column) -> DataFrame:
    """Where each input file goes: failed or processed, below its own folder; a name already taken at its
    destination gets -2, -3, ... in order of path."""
    to = documents.withColumn("folder", F.when(blocking, "failed").otherwise("processed"))
    nth = F.row_number().over(Window.partitionBy("folder", "name").orderBy("path"))
    suffix = F.when(nth > 1, F.concat(F.lit("-"), nth.cast("string"))).otherwise("")
    return to.withColumn("destination", F.concat(F.col("folder"), F.lit("/"), F.regexp_replace("name", r"\.[^.]*$", ""), suffix, F.regexp_extract("name", r"(\.[^.]*)$", 1)))


def upsert_vocabulary(stored: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """New rows win by key; rows no longer listed stay."""
    return new.unionByName(stored.join(new.select(key), key, "left_anti"))


# ---- runs, analyses and attempts

def results_store(spark: SparkSession, base: str, **sizes: int) -> Store:
    run, asked = Layout("run_id", ("run_id",)), Layout("extraction_run_id", ("extraction_run_id",))
    return Store(spark, base, {"documents": run, "questions": asked, "runs": run}, **sizes)


def save_results(store: Store, results: DataFrame) -> Snapshot:
    """Documents, questions and runs of results in one commit, once for each run: readers see all three or none."""
    documents = document_rows(results).join(results.select(F.col("source.sha256").alias("sha256"), F.col("run.run_id").alias("run_id"), F.col("run.extracted_at").alias("extracted_at")), "sha256")

    def merge(old: dict, batch: dict) -> dict:
        def fresh(name: str) -> DataFrame:
            run = store.tables[name].deal
            known = old["runs"].select(F.col("run_id").alias(run)) if "runs" in old else None
            return batch[name] if known is None else batch[name].join(known, run, "left_anti")

        if fresh("runs").isEmpty():
            return {}
        return {name: joined(old.get(name), fresh(name)) for name in batch}

    return store.commit({"documents": documents, "questions": question_rows(results), "runs": run_rows(results)}, merge)


def stored_documents(documents: DataFrame) -> DataFrame:
    """Each document as its runs leave it: level and module as last known, the paper's columns as last read
    from a paper, the rest as last written."""
    order = F.struct("extracted_at", "run_id")
    paper = F.struct(*PAPER_COLUMNS)
    any_paper = F.coalesce(*(F.col(c).cast("string") for c in PAPER_COLUMNS)).isNotNull()
    last = [F.max_by(c, order).alias(c) for c in ("file_name", "page_count", "byte_size")]
    known = [F.max_by(c, F.when(F.col(c).isNotNull(), order)).alias(c) for c in ("level", "module")]
    return documents.groupBy("sha256").agg(*last, F.max_by(paper, F.when(any_paper, order)).alias("paper"), *known).select("sha256", "file_name", "page_count", "byte_size", "paper.*", "level", "module")


def current_questions(runs: DataFrame, questions: DataFrame) -> DataFrame:
    """Questions of each document's last run that does not block."""
    good = runs.where("not blocking").groupBy("sha256").agg(F.max_by("run_id", F.struct("extracted_at", "run_id")).alias("extraction_run_id"))
    return questions.join(good.select("extraction_run_id"), "extraction_run_id", "left_semi")


def push_analyses(rows: DataFrame, path: str, push: int) -> None:
    """Append the rows of one push, numbered in order; readers see current_analyses of them."""
    rows.withColumn("push", F.lit(push).cast("long")).write.mode("append").parquet(path)


def current_analyses(stored: DataFrame) -> DataFrame:
    """Of each run the rows of its last push, with is_current for the last one pushed under a question key."""
    run, key = Window.partitionBy("analysis_run_id"), Window.partitionBy("question_key")
    last = stored.withColumn("of_run", F.max("push").over(run)).where("push = of_run").drop("of_run")
    return last.withColumn("is_current", F.col("push") == F.max("push").over(key))


def export_analyses(results: DataFrame, base: str) -> None:
    """As write_archive: the latest analysis of each paper, and all of them by run."""
    rows = results.withColumns({"paper": N.paper_key(F.col("sha256")), "history": F.concat_ws("/", N.safe_stem(F.col("file_name")), F.col("run.run_id"))})
    in_buckets(rows, "paper").write.mode("append").partitionBy("bucket").json(f"{base}/history")
    replace_latest(rows, "paper", f"{base}/latest")


def export_attempts(attempts: DataFrame, base: str) -> None:
    in_buckets(attempts, "student_id").write.mode("append").partitionBy("bucket").json(base)


def output_names(results: DataFrame) -> DataFrame:
    """Names of a result's files: its JSON, its report beside it, its history entry and its pictures' folder."""
    stem = F.concat_ws("-", N.safe_stem(F.col("source.file_name")), N.paper_key(F.col("source.sha256")))
    return results.select(F.concat(stem, F.lit(".json")).alias("json"), F.concat(stem, F.lit(".md")).alias("report"), F.concat(F.lit("history/"), stem, F.lit("/"), F.col("run.run_id"), F.lit(".json")).alias("history"), stem.alias("pictures"))


# ---- schemas

def aligned(rows: DataFrame, schema: StructType) -> DataFrame:
    """rows of an older schema under the present one: missing columns null, types cast, others left out."""
    have = {c.lower() for c in rows.columns}
    return rows.select(*((F.col(f.name) if f.name.lower() in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema))


def schema_problems(rows: DataFrame, schema: StructType, name: str) -> list[str]:
    """What a stored table lacks of the registered schema."""
    have = {f.name: f.dataType for f in rows.schema}
    lost = [f"{name}: column {f.name} is missing" for f in schema if f.name not in have]
    return lost + [f"{name}: column {f.name} is {have[f.name].simpleString()}, not {f.dataType.simpleString()}" for f in schema if f.name in have and have[f.name] != f.dataType]
