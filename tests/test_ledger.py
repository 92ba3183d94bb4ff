"""Model calls through a ledger."""

import hashlib
import os

import pytest
from pyspark.sql import functions as F

from tallyquill.operators import models


class Counting:
    """Notes each call in a file of its prompt; breaks the task at one prompt while a marker is there."""

    def __init__(self, folder):
        self.folder = folder

    def generate(self, prompt):
        with open(f"{self.folder}/{hashlib.sha256(prompt.encode()).hexdigest()}", "a") as f:
            f.write(".")
        if prompt == "p13" and os.path.exists(f"{self.folder}/broken"):
            raise RuntimeError("the task is lost")
        if prompt == "p5":
            raise models.ModelError("refused", 400)
        return f"[{prompt}]"


def test_a_broken_run_pays_only_for_its_batch(spark, tmp_path):
    folder, ledger = tmp_path / "calls", str(tmp_path / "ledger")
    folder.mkdir()
    (folder / "broken").touch()
    prompts = spark.range(40).select("id", F.concat(F.lit("p"), F.col("id") % 20).alias("prompt"))
    client = lambda: Counting(str(folder))
    with pytest.raises(Exception, match="the task is lost"):
        models.call_once(prompts, ledger, client, batches=4)
    recorded = {r.k for r in models.ledger_rows(spark, ledger).where("answer is not null").collect()}
    (folder / "broken").unlink()
    got = {r.id: (r.answer, r.error) for r in models.call_once(prompts, ledger, client, batches=4).collect()}
    assert got == {i: (None, "refused") if i % 20 == 5 else (f"[p{i % 20}]", None) for i in range(40)}
    calls = {k: len((folder / k).read_text()) for k in os.listdir(folder)}
    assert len(calls) == 20 and all(calls[k] == 1 for k in recorded)
    before = sum(calls.values())
    assert models.call_once(prompts, ledger, client, batches=4).count() == 40
    assert sum(len((folder / k).read_text()) for k in os.listdir(folder)) == before + 1  # the refused one


def test_no_prompts(spark, tmp_path):
    assert models.call_once(spark.createDataFrame([], "id long, prompt string"), str(tmp_path / "l"), lambda: Counting("")).count() == 0
