"""Bounded samples of labelled documents to fit classifiers on."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyquill.llm.common import text_or_empty, written


def held_out(doc_id: Column, mod: int, rest: int) -> Column:
    """Whether crc32 of the id as text leaves this rest; a null id is held out."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(mod)) == rest, F.lit(True))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, mod: int, rest: int, most: int) -> DataFrame:
    """(doc_id, text, label 0/1, fold 0-9) of at most ``most`` labelled documents that are not held out.

    Labels are sampled by a hash of the id, so that every size of table gives about ``most`` of them and
    every run the same, and are then few enough to go to every task: the documents do not move. The
    sample is written once; what reads it does not scan the documents again.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    known = known.where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("doc_id"), mod, rest))
    known = known.groupBy("doc_id").agg(F.max("label").alias("label"))
    share = min(1.0, 0.97 * most / max(1, known.count()))
    place = F.xxhash64("doc_id", F.lit(label))
    picked = known.where(F.pmod(place, F.lit(1_000_000)) < share * 1_000_000).orderBy(place, "doc_id").limit(most)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty("text").alias("text"))
    out = texts.join(F.broadcast(picked), "doc_id")
    return written(out.withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(10)).cast("int")), f"{label}-sample")


class Logistic:
    """Logistic regression on standardised columns, fitted by Newton steps with a ridge."""

    def __init__(self, x: np.ndarray, y: np.ndarray, ridge: float = 1.0):
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-9
        z = np.column_stack(((x - self.mean) / self.scale, np.ones(len(x))))
        w = np.zeros(z.shape[1])
        penalty = np.append(np.full(x.shape[1], ridge), 1e-3)
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty), z.T @ (y - p) - penalty * w)
            w += np.clip(step, -4, 4)
            if np.abs(step).max() < 1e-7:
                break
        self.w = w

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.mean) / self.scale @ self.w[:-1] + self.w[-1]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def auc(y: np.ndarray, score: np.ndarray) -> float:
    """Area under the ROC curve, ties counted half."""
    order = np.argsort(score, kind="stable")
    _, first, counts = np.unique(score[order], return_index=True, return_counts=True)
    rank = np.empty(len(score))
    rank[order] = np.repeat(first + (counts + 1) / 2, counts)
    n1 = int(y.sum())
    return float((rank[y == 1].sum() - n1 * (n1 + 1) / 2) / max(1, n1 * (len(y) - n1)))
