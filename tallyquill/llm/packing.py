"""Best-fit packing of tokenized documents into sequences of at most ``capacity`` tokens.

Documents are tokenized where they are read; only (id, piece, length, checksum) rows move. They are
dealt by hash into groups of about ``per_group`` documents; each group is packed by best-fit decreasing.
Beside the optimum this costs at most a partly filled sequence per group, one in tens of thousands.

Within a group a segment tree stands over the remaining capacities 0..capacity: a leaf counts the open
bins with just that much room, an inner node the bins below it. The tightest bin for a piece is the first
non-empty leaf at or right of its length, found in one climb and one descent.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyquill.llm.common import text_or_empty

CAPACITY = 4096
PER_GROUP = 65_536
SEPARATOR_ID = 1
SLICE = 512  # rows held as Python objects at a time


class RoomTree:
    """Open bins by remaining capacity."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]

    def add(self, room: int, bin_id: int) -> None:
        self.bins[room].append(bin_id)
        node, count = room + self.leaves, self.count
        while node:
            count[node] += 1
            node >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """(bin, room) of the bin with the least room >= need, removed; None if there is none."""
        node, count = need + self.leaves, self.count
        if not count[node]:
            # climb to the first right neighbour with a bin in it, then descend to its leftmost one
            while node > 1 and (node & 1 or not count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node *= 2
                if not count[node]:
                    node += 1
        room = node - self.leaves
        while node:
            count[node] -= 1
            node >>= 1
        return self.bins[room].pop(), room


def best_fit_decreasing(lengths: list[int], capacity: int = CAPACITY) -> tuple[list[int], list[int]]:
    """Bin and offset of each piece; lengths in any order, each 1..capacity. Ties go in input order."""
    tree, bins, offsets, opened = RoomTree(capacity), [0] * len(lengths), [0] * len(lengths), 0
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        n = lengths[i]
        found = tree.take(n)
        if found is None:
            found, opened = (opened, capacity), opened + 1
        bins[i], offsets[i] = found[0], capacity - found[1]
        if found[1] > n:
            tree.add(found[1] - n, found[0])
    return bins, offsets


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _pieces(path: str, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tallyquill.llm.word_bpe import word_bpe

        encode, end = word_bpe(path).encode, SEPARATOR_ID.to_bytes(4, "little")
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                rows: list[tuple] = []
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1), strict=True):
                    ids = encode(text.as_py()) + end
                    for k, start in enumerate(range(0, len(ids), 4 * capacity)):
                        piece = ids[start : start + 4 * capacity]
                        rows.append((doc_id, k, start // 4, len(piece) // 4, zlib.crc32(piece)))
                if rows:
                    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return run


def _pack(capacity: int):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc_id", "piece", "start", "ids_crc32"], kind="stable", ignore_index=True)
        bins, offsets = best_fit_decreasing(rows["length"].tolist(), capacity)
        return rows.assign(sequence_id=pd.Series(bins, dtype="int64") + (int(key[0]) << 40), offset=pd.Series(offsets, dtype="int64")).drop(columns="grp")

    return run


def pack_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, per_group: int = PER_GROUP) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A null or empty text is its separator id alone. Repeated rows are packed each for itself; a null id
    stays null. An empty table packs into nothing. Other columns are ignored.
    """
    groups = max(1, -(-docs.count() // per_group))
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    pieces = texts.mapInArrow(_pieces(tokenizer, capacity), PIECES)
    dealt = pieces.withColumn("grp", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(groups)).cast("int"))
    return dealt.groupBy("grp").applyInPandas(_pack(capacity), PIECES + ", sequence_id long, offset long")
