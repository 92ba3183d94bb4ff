import random
import zlib
from collections import defaultdict
from struct import pack

from tokenizers import Tokenizer

from tallyquill.llm.packing import CAPACITY, best_fit_decreasing, pack_documents
from tallyquill.llm.queries import WORD_BPE, op10_best_fit
from tallyquill.llm.word_bpe import word_bpe


def check(rows, texts):
    """texts: (id, text) of every row."""
    library = Tokenizer.from_file(WORD_BPE)
    want = []
    for i, t in texts:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 1]
        for k in range(0, len(ids), CAPACITY):
            p = ids[k : k + CAPACITY]
            want.append((i, k // CAPACITY, k, len(p), zlib.crc32(pack(f"<{len(p)}I", *p))))
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=repr) == sorted(want, key=repr)
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for placed in bins.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= CAPACITY
    return len(bins)


def test_documents(spark, sf):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    rows = op10_best_fit(spark, sf).collect()
    assert check(rows, texts) <= -(-sum(r.length for r in rows) // CAPACITY) + 2


def test_awkward_and_empty(spark, awkward):
    texts = [(r.doc_id, r.text) for r in awkward.collect()]
    check(pack_documents(awkward, WORD_BPE).collect(), texts)
    assert pack_documents(awkward.limit(0), WORD_BPE).count() == 0


def test_ids_of_every_code_point():
    library, ours = Tokenizer.from_file(WORD_BPE), word_bpe(WORD_BPE)
    texts = [f"a{chr(c)}b" for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(texts), 50_000):
        part = texts[at : at + 50_000]
        want = [pack(f"<{len(e.ids)}I", *e.ids) for e in library.encode_batch(part, add_special_tokens=False)]
        assert [t for t, w in zip(part, want, strict=True) if ours.encode(t) != w] == []


def test_tightest_bin_against_a_scan():
    rnd = random.Random(3)
    for _ in range(30):
        capacity = rnd.choice([7, 8, 50, 4096])
        lengths = [rnd.randint(1, capacity) for _ in range(200)]
        bins, _ = best_fit_decreasing(lengths, capacity)
        room: list[int] = []
        for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
            fits = [r for r in room if r >= lengths[i]]
            if fits:
                room[room.index(min(fits))] -= lengths[i]
            else:
                room.append(capacity - lengths[i])
        used = defaultdict(int)
        for b, n in zip(bins, lengths, strict=True):
            used[b] += n
        assert sorted(capacity - u for u in used.values()) == sorted(room)
