"""BPE encoding and decoding with reuse of content-defined chunks.

A rolling hash over the bytes of a text (each byte's random weight, halved in influence at every step,
so the last 32 bytes count) cuts it where the hash's low bits are zero: equal passages are cut alike
wherever they stand. A worker encodes each distinct chunk once and keeps the ids with their decimal and
decoded forms in a store of bounded size, so shared passages and copies cost a look-up.

Joins are repaired. A chunk is encoded only from its first to its last blank edge, a place where white
space follows something else: the split pattern never puts such a place inside a piece, so ids of that
inner part hold in any surroundings. What lies between two inner parts, over the cut, is encoded anew
with a whole piece of both neighbours around it; if the ids of these pieces agree with what the chunks
say, the repair stands, else the window grows over both inner parts, which are encoded as one.

Ids come from a byte-pair encoder over the same ranks as the tokenizer file (built from the file), which
gives the library's ids several times faster; the library encodes texts with special tokens' strings.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyquill.llm.common import text_or_empty
from tallyquill.llm.held import held
from tallyquill.llm.word_bpe import _byte_of

MEAN_CHUNK = 1024  # bytes between cuts
LEAST_CHUNK = 64
STORE_MB = 48
SLICE = 256
#: The split pattern of byte-level BPE vocabularies of this family.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_weights = np.random.default_rng(20240501).integers(0, 2**32, 256, dtype=np.uint32)


def cuts(data: bytes, mean: int = MEAN_CHUNK, least: int = LEAST_CHUNK) -> list[int]:
    """Ends of the chunks of data, at UTF-8 character starts; the last is len(data)."""
    b = np.frombuffer(data, np.uint8)
    if len(b) <= least:
        return [len(b)]
    h = _weights[b]
    step = 1
    while step < 32:  # after k rounds each place holds the weighted sum of the last 2**k bytes
        h[step:] += h[:-step] << np.uint32(step)
        step *= 2
    places = np.flatnonzero((h >> np.uint32(8)) % np.uint32(mean) == 0) + 1
    out, last = [], 0
    for p in places.tolist():
        while p < len(data) and data[p] & 0xC0 == 0x80:
            p += 1
        if p - last >= least and p < len(data):
            out.append(p)
            last = p
    return [*out, len(data)]


class ChunkBpe:
    """Encoder of whole texts that keeps what it knows of chunks."""

    def __init__(self, path: str, store_bytes: int = STORE_MB << 20):
        import tiktoken
        from tokenizers import Tokenizer

        spec = json.load(open(path, encoding="utf-8"))
        byte_of = _byte_of()
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(byte_of[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in self.specials}
        self.encoder = tiktoken.Encoding("chunks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        size = max([*ranks.values(), *self.specials.values()]) + 1
        self.bytes_of = [b""] * size
        for b, i in [*ranks.items(), *((s.encode(), i) for s, i in self.specials.items())]:
            self.bytes_of[i] = b
        self.digits = [str(i) for i in range(size)]
        self.store: dict[bytes, tuple] = {}
        self.held, self.most = 0, store_bytes
        self.reused = self.encoded = 0

    def _forms(self, ids: list[int]) -> tuple[int, str, bytes]:
        return len(ids), ",".join(map(self.digits.__getitem__, ids)), b"".join(map(self.bytes_of.__getitem__, ids))

    def _chunk(self, data: bytes) -> tuple:
        """(head, inner forms or None, tail, first piece, last piece): head and tail are bytes outside the
        blank edges; the pieces are the inner part's first and last stretch with their ids."""
        key = hashlib.blake2b(data, digest_size=16).digest()
        known = self.store.get(key)
        if known is not None:
            self.reused += 1
            return known
        self.encoded += 1
        edges = blank_edges(data)
        if len(edges) < 3:
            known = (data, None, b"", b"", "", b"", "")
        else:
            first, last = edges[0], edges[-1]
            head_stretch, tail_stretch = data[first : edges[1]], data[edges[-2] : last]
            ids = self.encoder.encode_ordinary(data[first:last].decode())
            known = (data[:first], self._forms(ids), data[last:], head_stretch, self._csv(head_stretch), tail_stretch, self._csv(tail_stretch))
        cost = 3 * len(data) + 500
        if self.held + cost > self.most:
            self.store.clear()
            self.held = 0
        self.store[key] = known
        self.held += cost
        return known

    def _csv(self, data: bytes) -> str:
        return ",".join(map(self.digits.__getitem__, self.encoder.encode_ordinary(data.decode())))

    def encode(self, text: str) -> tuple[int, str, bytes]:
        """(number of ids, ids as decimals joined by commas, decoded bytes)."""
        if any(s in text for s in self.specials):
            return self._forms(self.library.encode(text, add_special_tokens=False).ids)
        data = text.encode()
        at, pending, before = 0, b"", (b"", "")
        parts: list[tuple[int, str, bytes]] = []  # gaps and inner parts in turn, an inner part last
        for end in cuts(data):
            head, inner, tail, first, first_csv, last, last_csv = self._chunk(data[at:end])
            at = end
            pending += head
            if inner is None:
                continue
            repaired = self._repair(pending, before, (first, first_csv))
            if repaired is None:
                inner = self._joined(parts, pending, inner[2])
            else:
                parts.append(repaired)
            parts.append(inner)
            pending, before = tail, (last, last_csv)
        repaired = self._repair(pending, before, (b"", ""))
        parts.append(self._joined(parts, pending, b"") if repaired is None else repaired)
        return sum(k for k, _, _ in parts), ",".join(c for _, c, _ in parts if c), b"".join(b for _, _, b in parts)

    def _joined(self, parts: list[tuple[int, str, bytes]], gap: bytes, after: bytes) -> tuple[int, str, bytes]:
        """Forms of the last inner part, which is taken from the parts, the gap and what follows, as one."""
        before = parts.pop()[2] if parts else b""
        return self._forms(self.encoder.encode_ordinary((before + gap + after).decode()))

    def _repair(self, gap: bytes, before: tuple[bytes, str], after: tuple[bytes, str]) -> tuple[int, str, bytes] | None:
        """Forms of the gap between two inner parts, or None if its surroundings do not agree."""
        if not gap:
            return 0, "", b""
        ids = self.encoder.encode_ordinary((before[0] + gap + after[0]).decode())
        left, right = before[1].count(",") + 1 if before[1] else 0, after[1].count(",") + 1 if after[1] else 0
        said = self.digits.__getitem__
        if ",".join(map(said, ids[:left])) != before[1] or ",".join(map(said, ids[len(ids) - right :])) != after[1] or left + right > len(ids):
            return None
        found = self._forms(ids[left : len(ids) - right])
        return found if found[2] == gap else None


def blank_edges(data: bytes) -> list[int]:
    """The first two and the last two places where an ASCII blank follows another ASCII character that is none."""
    found: list[int] = []
    at = 1
    while len(found) < 2:
        p = _next(data, at)
        if p < 0:
            return found
        found.append(p)
        at = p + 1
    back: list[int] = []
    at = len(data)
    while len(back) < 2:
        p = _previous(data, at)
        if p <= found[-1]:
            break
        back.append(p)
        at = p
    return found + back[::-1]


def _edge(data: bytes, p: int) -> bool:
    return p > 0 and 0x21 <= data[p - 1] < 0x7F and data[p] in b" \n"


def _next(data: bytes, at: int) -> int:
    while True:
        a, b = data.find(b" ", at), data.find(b"\n", at)
        p = min(x for x in (a, b) if x >= 0) if a >= 0 or b >= 0 else -1
        if p < 0 or _edge(data, p):
            return p
        at = p + 1


def _previous(data: bytes, at: int) -> int:
    while True:
        p = max(data.rfind(b" ", 0, at), data.rfind(b"\n", 0, at))
        if p < 0 or _edge(data, p):
            return p
        at = p


def chunk_bpe(path: str) -> ChunkBpe:
    return held(ChunkBpe, path)


CODED = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def code_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256.

    Whole texts are encoded, their ids decoded again. Null and empty texts have no tokens; repeated rows
    stay repeated; other columns are ignored. No shuffle: chunks are shared within a worker, whose store
    is bounded, and not through an exchange, which would move every text twice.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = chunk_bpe(tokenizer).encode
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                n, ids, decoded = [], [], []
                for text in part.column(1):
                    k, csv, out = encode(text.as_py())
                    n.append(k)
                    ids.append(hashlib.sha256(csv.encode()).hexdigest())
                    decoded.append(hashlib.sha256(out.decode("utf-8", "replace").encode()).hexdigest())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_or_empty(text_col).alias("text")).mapInArrow(run, CODED)
