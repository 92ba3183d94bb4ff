"""Quality by a byte-level convolutional network in numpy.

A text's bytes are cut into overlapping chunks that cover it wholly. Each byte has a learned vector;
learned filters over windows of WIDTH bytes are max-pooled over the chunk, and a small hidden layer
turns the pooled values into the chunk's logit. The mean, least and greatest logit of all chunks are
combined into one probability by a logistic curve.

The network is fitted with Adam on all chunks of a bounded sample of labelled documents, those of a long
one counting less; the curve
on the whole texts of a part of the sample that the network has not seen. The gradient of a pooled
filter reaches only the window it was largest at, which makes a step cheap.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyquill.llm.common import text_or_empty
from tallyquill.llm.labelled import Logistic, held_out, labelled_sample
from tallyquill.llm.shingles import slices

SAMPLE = 6_000  # labelled documents at most
CHUNKS = 100_000  # chunks of them that the network is fitted on at most: whole documents in order of a hash
CHUNK, STEP = 512, 448
WIDTH, STRIDE, DIMS, FILTERS, HIDDEN = 8, 2, 4, 32, 16
WEIGHT, EPOCHS, BATCH, RATE, CUT = 4, 10, 64, 4e-3, 0.25  # training: weight of a text in chunks at most, rounds, chunks a step, step size, share shortened
PAD = 256
MOD, REST, THRESHOLD = 3, 1, 0.5


def chunks(data: bytes) -> np.ndarray:
    """All chunks of data, a row each, padded with PAD; an empty text is one chunk of padding."""
    n = 1 + max(0, -(-(len(data) - CHUNK) // STEP))
    out = np.full(CHUNK + STEP * (n - 1), PAD, np.int16)
    out[: len(data)] = np.frombuffer(data, np.uint8)
    return np.lib.stride_tricks.sliding_window_view(out, CHUNK)[::STEP]


class Network:
    """Chunk rows -> logits."""

    def __init__(self, seed: int = 3):
        rng = np.random.default_rng(seed)

        def normal(*shape, scale):
            return (rng.normal(size=shape) * scale).astype(np.float32)

        self.p = {
            "bytes": normal(PAD + 1, DIMS, scale=0.5),
            "filters": normal(WIDTH * DIMS, FILTERS, scale=(WIDTH * DIMS) ** -0.5),
            "bias": np.zeros(FILTERS, np.float32),
            "hidden": normal(FILTERS + 1, HIDDEN, scale=FILTERS**-0.5),
            "hidden_bias": np.zeros(HIDDEN, np.float32),
            "out": normal(HIDDEN, scale=HIDDEN**-0.5),
            "out_bias": np.zeros(1, np.float32),
        }
        self.p["bytes"][PAD] = 0

    def _windows(self, rows: np.ndarray) -> np.ndarray:
        v = self.p["bytes"][rows].reshape(len(rows), CHUNK * DIMS)
        return np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(v, WIDTH * DIMS, axis=1)[:, :: STRIDE * DIMS])

    def forward(self, rows: np.ndarray):
        windows = self._windows(rows)
        values = windows @ self.p["filters"]
        at = values.argmax(1)
        pooled = np.tanh(np.take_along_axis(values, at[:, None], 1)[:, 0] + self.p["bias"])
        filled = np.log2(1 + (rows != PAD).sum(1, keepdims=True)).astype(np.float32) / 9  # short chunks meet fewer filters
        pooled = np.concatenate((pooled, filled), 1)
        hidden = np.tanh(pooled @ self.p["hidden"] + self.p["hidden_bias"])
        return hidden @ self.p["out"] + self.p["out_bias"][0], (windows, at, pooled, hidden)

    def logits(self, rows: np.ndarray) -> np.ndarray:
        return np.concatenate([self.forward(rows[i : i + 128])[0] for i in range(0, len(rows), 128)]) if len(rows) else np.zeros(0, np.float32)

    def gradients(self, rows: np.ndarray, y: np.ndarray, weight: np.ndarray | float = 1.0) -> dict[str, np.ndarray]:
        """Of the mean weighted cross-entropy against labels y."""
        logit, (windows, at, pooled, hidden) = self.forward(rows)
        d = (weight * (1 / (1 + np.exp(-logit)) - y) / len(y)).astype(np.float32)
        g = {"out": hidden.T @ d, "out_bias": d.sum(keepdims=True)}
        dh = d[:, None] * self.p["out"] * (1 - hidden**2)
        g |= {"hidden": pooled.T @ dh, "hidden_bias": dh.sum(0)}
        dv = (dh @ self.p["hidden"].T * (1 - pooled**2))[:, :FILTERS]
        g["bias"] = dv.sum(0)
        best = windows[np.arange(len(rows))[:, None], at]  # (rows, filters, window)
        g["filters"] = np.einsum("bfw,bf->wf", best, dv)
        dw = (dv[:, :, None] * self.p["filters"].T).reshape(-1, DIMS)
        places = at[:, :, None] * STRIDE + np.arange(WIDTH)
        seen = rows[np.arange(len(rows))[:, None, None], places].ravel()
        g["bytes"] = np.stack([np.bincount(seen, dw[:, k], PAD + 1) for k in range(DIMS)], 1).astype(np.float32)
        g["bytes"][PAD] = 0
        return g

    def train(self, rows: np.ndarray, y: np.ndarray, weight: np.ndarray, seed: int = 5) -> None:
        rng, first, second, t = np.random.default_rng(seed), {}, {}, 0
        steps = EPOCHS * -(-len(rows) // BATCH)
        for _ in range(EPOCHS):
            order = rng.permutation(len(rows))
            for lo in range(0, len(rows), BATCH):
                pick = order[lo : lo + BATCH]
                t += 1
                rate = RATE * (1 - 0.9 * t / steps)
                shown = rows[pick].copy()
                cut = rng.random(len(pick)) < CUT  # the starts of some chunks stand in for short texts
                for i in np.flatnonzero(cut):
                    shown[i, int(2 ** rng.uniform(2, 8)) :] = PAD
                for k, g in self.gradients(shown, y[pick], weight[pick]).items():
                    first[k] = 0.9 * first.get(k, 0) + 0.1 * g
                    second[k] = 0.999 * second.get(k, 0) + 0.001 * g * g
                    self.p[k] -= (rate * first[k] / (1 - 0.9**t) / (np.sqrt(second[k] / (1 - 0.999**t)) + 1e-7)).astype(np.float32)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All chunks of each text, with its label and what each chunk weighs."""
    for batch in batches:
        out, labels, weights = [], [], []
        for text, label in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
            data = text.as_py().encode()
            n = 1 + max(0, -(-(len(data) - CHUNK) // STEP))
            out += [data[k * STEP : k * STEP + CHUNK] for k in range(n)]
            labels += [label] * n
            weights += [min(1.0, WEIGHT / n)] * n
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary()), pa.array(labels, pa.int32()), pa.array(weights, pa.float64())], names=["chunk", "label", "weight"])


def _affordable(rows: DataFrame, most: int) -> DataFrame:
    """Rows in order of a hash while their chunks are at most ``most`` together: whole texts, or none of one.
    Texts of more than a twentieth of that are left out of the sum, so at least twenty texts remain, if there are."""
    n = F.greatest(F.ceil((F.octet_length("text") - CHUNK) / STEP), F.lit(0)) + 1
    place = Window.orderBy(F.xxhash64("doc_id", F.lit("fit")), "doc_id")  # over a bounded sample's ids and sizes
    sizes = rows.groupBy("doc_id").agg(F.sum(n).alias("n")).where(F.col("n") <= max(1, most // 20)).withColumn("upto", F.sum("n").over(place))
    return rows.join(F.broadcast(sizes.where(F.col("upto") <= most).select("doc_id")), "doc_id")


def _scored(network: Network, curve: Logistic | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices([len(t.as_py()) for t in batch.column(1)], 1 << 19):
                part = batch.slice(lo, hi - lo)
                rows = [chunks(t.as_py().encode()) for t in part.column(1)]
                logit = network.logits(np.concatenate(rows))
                first = np.cumsum([0, *(len(r) for r in rows)])[:-1]
                count = np.array([len(r) for r in rows])
                f = np.column_stack((np.add.reduceat(logit, first) / count, np.minimum.reduceat(logit, first), np.maximum.reduceat(logit, first))).astype(float)
                score = curve(f) if curve else np.full(len(f), 0.5)
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(f[:, k]) for k in range(3)), pa.array(score)], names=["doc_id", "mean", "least", "greatest", "score"])

    return run


SCORED = "doc_id long, mean double, least double, greatest double, score double"


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[Network, Logistic | None]:
    """Network and curve from a bounded sample of the labelled rows that are not held out. Without
    labels of both kinds there is no curve and every text scores 0.5."""
    rows = labelled_sample(docs, labels, "quality", MOD, REST, sample)
    drawn = _affordable(rows.where("fold < 7"), CHUNKS).select("text", "label").mapInArrow(_cut, "chunk binary, label int, weight double").collect()
    network = Network()
    drawn.sort(key=lambda r: (zlib.crc32(r.chunk), bytes(r.chunk), r.label))  # the same steps whatever order rows came in
    if drawn:
        x = np.stack([_row(bytes(r.chunk)) for r in drawn])
        network.train(x, np.array([r.label for r in drawn], np.float32), np.array([r.weight for r in drawn], np.float32))
    rest = rows.where("fold >= 7")
    known = F.broadcast(rest.select("doc_id", "label").distinct())
    got = rest.select("doc_id", "text").mapInArrow(_scored(network, None), SCORED).join(known, "doc_id").select("mean", "least", "greatest", "label").collect()
    f = np.array([tuple(r) for r in got], float).reshape(-1, 4)
    both = len(f) and 0 < f[:, 3].sum() < len(f)
    return network, Logistic(f[:, :3], f[:, 3]) if both else None


def _row(data: bytes) -> np.ndarray:
    out = np.full(CHUNK, PAD, np.int16)
    out[: len(data)] = np.frombuffer(data, np.uint8)
    return out


def score_quality(docs: DataFrame, model: tuple[Network, Logistic | None], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score of every row; whole texts, null ones as empty. Repeated rows stay repeated; other
    columns are ignored."""
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return rows.mapInArrow(_scored(*model), SCORED).select("doc_id", "score")


def quality_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document under a model fitted on labels."""
    out = score_quality(docs, fit(docs, labels))
    return out.select("doc_id", held_out(F.col("doc_id"), MOD, REST).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
