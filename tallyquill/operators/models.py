"""The boundary to a model: a client that answers prompts, replayed offline from recorded answers."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyquill.sources.shared import stored

RETRYABLE = frozenset({408, 429, 500, 502, 503, 504})
ATTEMPTS, LEAST_WAIT, MOST_WAIT = 4, 2.0, 30.0


class ModelError(Exception):
    def __init__(self, message: str, status: int | None = None):
        super().__init__(message)
        self.status = status


class ModelClient(Protocol):
    def generate(self, prompt: str) -> str: ...


class RecordedClient:
    """Answers by the prompt's SHA-256, as recorded; what was not recorded is an error of that row."""

    def __init__(self, answers: dict[str, str]):
        self.answers = answers

    def generate(self, prompt: str) -> str:
        import hashlib

        key = hashlib.sha256(prompt.encode()).hexdigest()
        if key not in self.answers:
            raise ModelError("no recorded answer")
        return self.answers[key]


def with_retry(call: Callable[[], str], sleep: Callable[[float], None] = time.sleep) -> str:
    """The call's answer; four attempts with doubling waits on errors worth retrying. Empty answers are errors."""
    for attempt in range(ATTEMPTS):
        try:
            answer = call()
            if not answer or not answer.strip():
                raise ModelError("empty response")
            return answer
        except ModelError as e:
            if e.status not in RETRYABLE or attempt == ATTEMPTS - 1:
                raise
            sleep(min(MOST_WAIT, LEAST_WAIT * 2**attempt))
    raise AssertionError


def call_model(prompts: DataFrame, make_client: Callable[[], ModelClient], at_once: int = 1) -> DataFrame:
    """prompts (id, prompt) -> id, answer, error; each task has at most ``at_once`` calls open. A failed call is a
    row with its error, not a failed task: write the result before using it, so that a retried task does not pay
    for its calls again, or use ``call_once``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = make_client()

        def ask(prompt: str) -> tuple[str | None, str | None]:
            try:
                return with_retry(lambda: client.generate(prompt)), None
            except ModelError as e:
                return None, str(e)

        with ThreadPoolExecutor(at_once) as pool:
            for rows in batches:
                told = list(pool.map(ask, rows["prompt"]))
                yield pd.DataFrame({"id": rows["id"], "answer": pd.Series([a for a, _ in told], dtype=object), "error": pd.Series([e for _, e in told], dtype=object)})

    return prompts.select("id", "prompt").mapInPandas(run, f"id {dict(prompts.dtypes)['id']}, answer string, error string")


LEDGER = "k string, answer string, error string"


def ledger_rows(spark: SparkSession, ledger: str) -> DataFrame:
    """(k, answer, error) of a ledger: a row for each call that was recorded, k the prompt's SHA-256."""
    return spark.read.schema(LEDGER).parquet(ledger)


def call_once(prompts: DataFrame, ledger: str, make_client: Callable[[], ModelClient], batches: int = 8, at_once: int = 4) -> DataFrame:
    """As call_model, through a ledger in the folder ``ledger``: prompts that have an answer there are not called,
    equal prompts are called once. The rest goes in batches by the prompt's hash, each recorded before the next
    begins, so that a run that broke off and starts again pays only for the batch it was in. Failed calls are
    recorded too and called again by the next run. One run at a time may use a ledger."""
    spark = prompts.sparkSession
    spark.createDataFrame([], LEDGER).write.mode("append").parquet(ledger)
    wanted = stored(prompts.select(F.sha2("prompt", 256).alias("id"), "prompt").dropDuplicates(["id"]), "prompts")
    for batch in range(batches):
        answered = ledger_rows(spark, ledger).where("answer is not null").select(F.col("k").alias("id"))
        still = wanted.where(F.pmod(F.xxhash64("id"), F.lit(batches)) == batch).join(answered, "id", "left_anti")
        call_model(still, make_client, at_once).select(F.col("id").alias("k"), "answer", "error").write.mode("append").parquet(ledger)
    known = ledger_rows(spark, ledger).groupBy("k").agg(F.max("answer").alias("answer"), F.max("error").alias("error"))
    told = prompts.select("id", F.sha2("prompt", 256).alias("k")).join(known, "k", "left")
    return told.select("id", "answer", F.when(F.col("answer").isNull(), F.col("error")).alias("error"))


def replayed(prompts: DataFrame, recordings: DataFrame) -> DataFrame:
    """As call_model with a RecordedClient, from a table of recordings (k, a) of any size: k is a prompt's
    SHA-256, a its answer. A join, so that nothing is collected; of several answers of a prompt the greatest counts."""
    known = recordings.groupBy("k").agg(F.max("a").alias("a"), F.lit(True).alias("hit"))
    j = prompts.select("id", F.sha2("prompt", 256).alias("k")).join(known, "k", "left")
    error = F.when(F.col("hit").isNull(), "no recorded answer").when(~F.coalesce(F.col("a").rlike(r"\S"), F.lit(False)), "empty response")
    return j.select("id", F.when(error.isNull(), F.col("a")).alias("answer"), error.alias("error"))


def parsed(answers: DataFrame, schema: str) -> DataFrame:
    """answers plus payload, read by the schema; an answer cut short or not JSON has none and says so."""
    payload = F.from_json("answer", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    bad = F.col("answer").isNotNull() & F.try_parse_json("answer").isNull()
    return answers.withColumn("payload", F.when(~bad, payload)).withColumn("error", F.coalesce("error", F.when(bad, "response is not JSON")))


def prompt(head: str, title: str, rows: Column) -> Column:
    """A prompt's head, a block title and rows as JSON."""
    return F.concat(F.lit(head + "\n\n" + title + "\n"), F.to_json(rows))


TRUNCATED, BLOCKED = ("MAX_TOKENS",), ("SAFETY", "RECITATION", "BLOCKLIST", "PROHIBITED_CONTENT", "SPII")


def checked_responses(responses: DataFrame, schema: str) -> DataFrame:
    """Raw responses (id, finish_reason, text, input_tokens, output_tokens) -> id, payload, error and the counts.

    A response cut off at the token limit, blocked, empty or not JSON has no payload and says why; the reason
    may carry its enumeration's name before a point.
    """
    reason = F.upper(F.element_at(F.split(F.col("finish_reason"), r"\."), -1))
    blank = ~F.coalesce(F.col("text").rlike(r"\S"), F.lit(False))
    error = (
        F.when(reason.isin(*TRUNCATED), "truncated: the output token limit was hit, so the JSON is incomplete")
        .when(reason.isin(*BLOCKED), F.concat(F.lit("blocked: finish_reason="), reason))
        .when(blank, F.concat(F.lit("empty: no JSON, finish_reason="), F.coalesce(reason, F.lit("unknown"))))
    )
    rows = responses.select("id", F.when(error.isNull(), F.col("text")).alias("answer"), error.alias("error"), "input_tokens", "output_tokens")
    return parsed(rows, schema).drop("answer")


def read_prompts(spark: SparkSession, path: str) -> DataFrame:
    """path, text and hash of every prompt file below a folder."""
    texts = spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.txt")
    return texts.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"), prompt_hash(F.col("value")).alias("hash"))


def prompt_hash(text: Column) -> Column:
    """Twelve hex digits that tell a prompt's text."""
    return F.substring(F.sha2(text, 256), 1, 12)


def filled(template: Column, values: dict[str, Column]) -> Column:
    """A template with {NAME} replaced by each value."""
    for name, value in values.items():
        template = F.replace(template, F.lit("{" + name + "}"), value)
    return template


def block(title: str, rows: Column) -> Column:
    """A title and a line for each row."""
    return F.concat_ws("\n", F.lit(title), F.array_join(rows, "\n"))


def questions_block(questions: DataFrame) -> DataFrame:
    """(doc, block): a paper's questions as JSON, in order, for a model."""
    fields = [c for c in ("source_question_id", "question_text", "question_type", "options", "marks", "answer") if c in questions.columns]
    each = questions.select("doc", "position", F.to_json(F.struct(*fields)).alias("j"))
    return each.groupBy("doc").agg(F.concat(F.lit("QUESTIONS\n"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("position", "j"))), lambda x: x["j"]), "\n")).alias("block"))


def vocabulary_block(title: str, rows: DataFrame, id_col: str) -> DataFrame:
    """(block): 'id | name' of each row, by id. One row; vocabularies are small beside questions."""
    line = F.concat_ws(" | ", id_col, "name_en").alias("line")
    return rows.select(id_col, line).agg(F.concat(F.lit(f"{title}\n"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(id_col, "line"))), lambda x: x["line"]), "\n")).alias("block"))


def find_question(questions: DataFrame, doc: str, qid: str) -> DataFrame:
    """The question, or an error where the paper has none of that id."""
    found = questions.where((F.col("doc") == doc) & (F.col("source_question_id") == qid)).limit(1)
    if found.isEmpty():
        raise KeyError(f"question {qid!r} is not in {doc}")
    return found
