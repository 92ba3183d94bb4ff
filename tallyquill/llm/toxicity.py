"""Toxicity by maximum-scoring segments of token log-odds.

Tokens are runs of letters and digits, lower-cased. Each has a chain of nodes: its prefixes of 4 to 8
bytes and itself. For every node the labelled sample gives the toxic and the clean documents that hold
it; its toxic share is estimated under a Dirichlet prior centred on its parent's share, the root's being
the overall one. Its score is its log-odds against the root less their standard error, and nothing above
0 where they are not well clear of it. A token scores as its deepest node
known to the model, less a small drift, so that plain text runs downhill.

One linear scan (Ruzzo and Tompa's) finds all maximal-scoring segments of a text. A segment of score S
in a text of n tokens is as surprising as an extreme value of clean text: its E-value is K n exp(-lambda
S), where lambda and K come from the best segments of clean labelled documents that gave no counts.
Segments of E-value under ``SIGNIFICANT`` are the toxic passages; the strongest one's log E-value, the
sum over all of them and their number go to a logistic curve, fitted on that same part of the sample.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyquill.llm.common import text_or_empty
from tallyquill.llm.held import let_go
from tallyquill.llm.labelled import Logistic, held_out, labelled_sample
from tallyquill.llm.shingles import _BASE, _BYTE, _INVERSE, _power, mix, slices

SAMPLE = 16_000  # labelled documents the model is fitted on at most
PREFIXES = (4, 5, 6, 7, 8)
LEAST_TOXIC = 4  # toxic documents a node needs
PRIOR = 6.0  # weight, in documents, of the parent's share
SURE, CAUTION = 2.5, 1.0  # standard errors a score must reach, and is lessened by
DRIFT = 0.1
SIGNIFICANT = 0.05
MOD, REST, THRESHOLD = 4, 2, 0.3
SLICE = 1 << 18  # characters looked at together, whole texts; what bounds a worker's memory

_plain = np.array([chr(c).isalnum() or c >= 128 for c in range(256)])


def token_nodes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(starts, nodes): nodes[starts[i]:starts[i+1]] holds a row for each token of text i, from the
    shortest prefix to the token itself; 0 where the token is no longer than the prefix."""
    data = [t.lower().encode() for t in texts]
    ends = np.cumsum([len(d) + 1 for d in data])
    b = np.frombuffer(b"\n".join([*data, b""]), np.uint8)
    edge = np.flatnonzero(np.diff(np.concatenate(([False], _plain[b], [False])).astype(np.int8)))
    first, after = edge[0::2], edge[1::2]
    starts = np.searchsorted(first, np.concatenate(([0], ends)))
    if not len(first):
        return starts, np.zeros((0, len(PREFIXES) + 1), np.uint64)
    run = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[b] * _power(_BASE, len(b)), dtype=np.uint64)))
    back, size = _power(_INVERSE, len(b))[first], after - first
    nodes = np.zeros((len(first), len(PREFIXES) + 1), np.uint64)
    for k, n in enumerate(PREFIXES):
        some = size > n
        nodes[some, k] = mix((run[first[some] + n] - run[first[some]]) * back[some] + np.uint64(1000 + n))
    nodes[:, -1] = mix((run[after] - run[first]) * back + size.astype(np.uint64) + np.uint64(10_000))
    return starts, nodes


@dataclass
class Model:
    keys: np.ndarray  # nodes, ascending
    scores: np.ndarray
    scale: float = 1.0  # lambda
    log_k: float = 0.0
    curve: Logistic | None = None

    def token_scores(self, nodes: np.ndarray) -> np.ndarray:
        out = np.zeros(len(nodes))
        if len(self.keys):
            for k in range(nodes.shape[1]):  # deeper nodes overwrite
                at = np.searchsorted(self.keys, nodes[:, k])
                at[at == len(self.keys)] = 0
                hit = self.keys[at] == nodes[:, k]
                out[hit] = self.scores[at[hit]]
        return out - DRIFT

    def features(self, scores: np.ndarray) -> tuple[float, float, float]:
        """Of a text's token scores: the best segment's -ln E, the sum over significant ones, their number."""
        found = self.passages(scores)
        good = [-e for _, _, e in found if e < math.log(SIGNIFICANT)]
        best = -min((e for _, _, e in found), default=self.log_k + math.log(max(1, len(scores))))
        return max(-12.0, min(60.0, best)), math.log1p(sum(good)), math.log1p(len(good))

    def passages(self, scores: np.ndarray) -> list[tuple[int, int, float]]:
        """(first token, end, ln E-value) of every maximal segment."""
        log_kn = self.log_k + math.log(max(1, len(scores)))
        return [(a, b, log_kn - self.scale * s) for a, b, s in maximal_segments(scores)]


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """(start, end, sum) of all maximal-scoring segments, disjoint and in order, in linear time."""
    sums = np.concatenate(([0.0], np.cumsum(scores)))
    kept: list[list] = []  # start, end, sum before, sum after, place of the last kept one with a lower sum before
    for i in np.flatnonzero(scores > 0).tolist():
        start, low, high = i, sums[i], sums[i + 1]
        j = len(kept) - 1
        while True:
            while j >= 0 and kept[j][2] >= low:
                j = kept[j][4]
            if j < 0 or kept[j][3] >= high:
                kept.append([start, i + 1, low, high, j])
                break
            start, low = kept[j][0], kept[j][2]
            del kept[j:]
            j = len(kept) - 1
    return [(a, b, high - low) for a, b, low, high, _ in kept]


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Toxic and clean documents of each node of (text, label) rows, summed over a slice of texts."""
    let_go()
    for batch in batches:
        for lo, hi in slices([len(t.as_py()) for t in batch.column(0)], SLICE):
            part = batch.slice(lo, hi - lo)
            starts, nodes = token_nodes(part.column(0).to_pylist())
            nodes_of, up_of, labels = [], [], []
            for i, label in enumerate(part.column(1).to_pylist()):
                mine = nodes[starts[i] : starts[i + 1]]
                up = np.zeros_like(mine)
                for k in range(1, mine.shape[1]):  # parent: the longest shorter prefix that the token has
                    up[:, k] = np.where(mine[:, k - 1] != 0, mine[:, k - 1], up[:, k - 1])
                flat, first = np.unique(mine.ravel(), return_index=True)
                first, flat = first[flat != 0], flat[flat != 0]
                nodes_of.append(flat)
                up_of.append(up.ravel()[first])
                labels.append(np.full(len(flat), label))
            node, first, inverse = np.unique(np.concatenate(nodes_of), return_index=True, return_inverse=True)
            toxic = np.bincount(inverse, np.concatenate(labels), len(node)).astype(np.int64)
            total = np.bincount(inverse, minlength=len(node)).astype(np.int64)
            columns = [node.view(np.int64), np.concatenate(up_of)[first].view(np.int64), toxic, total - toxic]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["node", "up", "toxic", "clean"])


def _log_odds(rows: np.ndarray, share: float) -> tuple[np.ndarray, np.ndarray]:
    """Keys and scores from (node, up, toxic, clean) rows, parents before children."""
    root = math.log(share / (1 - share))
    found: dict[int, float] = {}
    by_support = rows[np.argsort(-(rows[:, 2] + rows[:, 3]), kind="stable")]
    pending = {int(r[0]): (int(r[1]), int(r[2]), int(r[3])) for r in by_support}

    def share_of(node: int) -> float:
        chain = []
        while node not in found and node in pending:
            chain.append(node)
            node = pending[node][0]
        q = found.get(node, share)
        for n in reversed(chain):
            _, toxic, clean = pending[n]
            q = found[n] = (toxic + PRIOR * q) / (toxic + clean + PRIOR)
        return q

    keys, scores = [], []
    for n, (_, toxic, clean) in pending.items():
        q = share_of(n)
        odds = math.log(q / (1 - q)) - root
        doubt = math.sqrt(1 / (toxic + 1) + 1 / (clean + 1))
        keys.append(n)
        scores.append(odds - CAUTION * doubt if odds > SURE * doubt else min(odds, 0.0))
    keys = np.array(keys, np.int64).view(np.uint64)
    order = np.argsort(keys)
    # a node known to be ordinary matters: it stops its token from scoring as its prefix does
    return keys[order], np.round(np.maximum(np.array(scores)[order], -0.5), 4)


def _scored(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            for lo, hi in slices([len(t.as_py()) for t in batch.column(1)], SLICE):
                part = batch.slice(lo, hi - lo)
                starts, nodes = token_nodes(part.column(1).to_pylist())
                scores = model.token_scores(nodes)
                f = np.array([model.features(scores[a:b]) for a, b in zip(starts[:-1], starts[1:], strict=True)]).reshape(-1, 3)
                p = model.curve(f) if model.curve else np.zeros(len(f))
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(f[:, k]) for k in range(3)), pa.array(p)], names=["doc_id", "best", "total", "passages", "score"])

    return run


FEATURES = "doc_id long, best double, total double, passages double, score double"


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from a bounded sample of the labelled rows that are not held out: token counts from seven
    tenths of it, extreme values and the logistic curve from the rest. Without labels it knows nothing
    and scores every text alike."""
    rows = labelled_sample(docs, labels, "toxic", MOD, REST, sample)
    counting = rows.where("fold < 7")
    sums = counting.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()
    n = {r.label: r.n for r in sums}
    share = (n.get(1, 0) + 0.5) / (sum(n.values()) + 1)
    nodes = counting.select("text", "label").mapInArrow(_counts, "node long, up long, toxic long, clean long")
    nodes = nodes.groupBy("node").agg(F.min("up").alias("up"), F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).where(F.col("toxic") >= LEAST_TOXIC)
    # ordinary nodes keep their place only where their parent stands out; most do not
    kept = nodes.collect()
    table = np.array([tuple(r) for r in kept], np.int64).reshape(-1, 4)
    keys, scores = _log_odds(table, share)
    loud = set(keys[np.abs(scores) >= 0.3].view(np.int64).tolist())
    keep = np.isin(keys, np.array([r[0] for r in table.tolist() if r[0] in loud or r[1] in loud], np.int64).view(np.uint64))
    model = Model(keys[keep], scores[keep])

    rest = rows.where("fold >= 7")
    _extreme_values(model, rest)
    got = rest.select("doc_id", "text").mapInArrow(_scored(model), FEATURES).join(F.broadcast(rest.select("doc_id", "label").distinct()), "doc_id").select("best", "total", "passages", "label").collect()
    x = np.array([tuple(r) for r in got], float).reshape(-1, 4)
    if len(x) and 0 < x[:, 3].sum() < len(x):
        model.curve = Logistic(x[:, :3], x[:, 3])
    return model


def _extreme_values(model: Model, rest: DataFrame) -> None:
    """Gumbel's lambda and K from the best segments of the clean documents, by moments."""

    def best(batches):
        let_go()
        for batch in batches:
            for lo, hi in slices([len(t.as_py()) for t in batch.column(0)], SLICE):
                starts, nodes = token_nodes(batch.column(0).slice(lo, hi - lo).to_pylist())
                s = model.token_scores(nodes)
                top = [max((x for _, _, x in maximal_segments(s[a:b])), default=0.0) for a, b in zip(starts[:-1], starts[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(np.diff(starts).astype(np.int64)), pa.array(np.array(top, float))], names=["n", "top"])

    x = np.array([tuple(r) for r in rest.where("label = 0").select("text").mapInArrow(best, "n long, top double").collect()], float).reshape(-1, 2)
    x = x[x[:, 0] > 0]
    if len(x) < 20:
        return
    log_n, top = np.log(x[:, 0]), x[:, 1]
    trimmed = top <= np.quantile(top, 0.98)  # labels err: a few of these texts are toxic
    log_n, top = log_n[trimmed], top[trimmed]
    scale = 1.0
    for _ in range(30):  # spread of top - ln n / lambda is pi / (lambda sqrt 6)
        scale = float(np.clip(math.pi / math.sqrt(6) / max(1e-6, np.std(top - log_n / scale)), 0.2, 5.0))
    model.scale, model.log_k = scale, float(np.mean(scale * top - log_n) - 0.5772156649)


def score_toxicity(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score, passages (significant ones), best (the strongest one's -ln E-value) of every row.

    The whole text is scanned. Null and empty texts have no passages and score as such. Repeated rows stay
    repeated; other columns are ignored.
    """
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    out = rows.mapInArrow(_scored(model), FEATURES)
    return out.select("doc_id", "score", F.round(F.expm1("passages")).cast("long").alias("passages"), "best")


def with_scores(docs: DataFrame, model: Model, score_col: str, text_col: str = "text") -> DataFrame:
    """docs with every row's score in a new column; the rows themselves pass through the scan."""
    schema = docs.withColumn(score_col, F.lit(0.0)).schema
    schema[score_col].nullable = True
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            texts = [t.as_py() or "" for t in batch.column(place)]
            for lo, hi in slices([len(t) for t in texts], SLICE):
                starts, nodes = token_nodes(texts[lo:hi])
                scores = model.token_scores(nodes)
                f = np.array([model.features(scores[a:b]) for a, b in zip(starts[:-1], starts[1:], strict=True)]).reshape(-1, 3)
                p = model.curve(f) if model.curve else np.zeros(len(f))
                yield pa.RecordBatch.from_arrays([*batch.slice(lo, hi - lo).columns, pa.array(p)], names=[*batch.schema.names, score_col])

    return docs.mapInArrow(run, schema)


def toxic_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, passages of every document under a model fitted on labels."""
    out = score_toxicity(docs, fit(docs, labels))
    return out.select("doc_id", held_out(F.col("doc_id"), MOD, REST).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "passages")
