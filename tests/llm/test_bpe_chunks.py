import random
from hashlib import sha256

from tokenizers import Tokenizer

from tallyquill.llm.bpe_chunks import ChunkBpe, code_documents, cuts
from tallyquill.llm.queries import BYTE_BPE, op8_bpe_chunks


def want(library, i, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return i, len(ids), sha256(",".join(map(str, ids)).encode()).hexdigest(), sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_documents(spark, sf):
    library = Tokenizer.from_file(BYTE_BPE)
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert sorted(map(tuple, op8_bpe_chunks(spark, sf).collect())) == sorted(want(library, i, t) for i, t in texts)


def test_awkward_and_empty(spark, awkward):
    library = Tokenizer.from_file(BYTE_BPE)
    texts = [(r.doc_id, r.text) for r in awkward.collect()]
    assert sorted(map(tuple, code_documents(awkward, BYTE_BPE).collect()), key=repr) == sorted((want(library, i, t) for i, t in texts), key=repr)
    assert code_documents(awkward.limit(0), BYTE_BPE).count() == 0


def test_random_texts_and_small_chunks(monkeypatch):
    import tallyquill.llm.bpe_chunks as m

    monkeypatch.setattr(m.cuts, "__defaults__", (24, 6))
    library, mine, rnd = Tokenizer.from_file(BYTE_BPE), ChunkBpe(BYTE_BPE, 40_000), random.Random(11)
    parts = ["the", " ", "  ", "\n", "'s", "'", "12", "é", "漢", " ", " ", "!!", "word", ",", "\t", "👩", "I'll", "\r\n", "ß", "x y z ", "<|", "a.b"]
    for _ in range(400):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 120)))
        n, csv, out = mine.encode(text)
        ids = library.encode(text, add_special_tokens=False).ids
        assert (csv, n, out.decode()) == (",".join(map(str, ids)), len(ids), text)


def test_shared_passages_are_cut_alike_and_reused():
    rnd = random.Random(2)
    words = ["".join(rnd.choices("abcdefgh", k=rnd.randint(2, 9))) for _ in range(3000)]
    passage = " ".join(words).encode()
    a, b = b"Some other start, " + passage, b"x" * 37 + b" " + passage
    ends_a = {e - len(a) for e in cuts(a)}
    ends_b = {e - len(b) for e in cuts(b)}
    assert len(ends_a & ends_b) > 0.8 * len(ends_a)
    mine = ChunkBpe(BYTE_BPE)
    mine.encode(a.decode())
    before = mine.encoded
    mine.encode(b.decode())
    assert mine.encoded - before <= 3 and mine.reused > 5


def test_a_repair_that_fails_grows_its_window():
    """Whatever agreement is refused, the ids are the library's."""
    import random

    from tallyquill.llm.bpe_chunks import ChunkBpe
    from tallyquill.llm.queries import BYTE_BPE

    coder, rnd = ChunkBpe(BYTE_BPE), random.Random(2)
    text = " ".join("".join(rnd.choice("abcdeé漢 \n.,1'") for _ in range(rnd.randint(1, 9))) for _ in range(4_000))
    want = coder.library.encode(text, add_special_tokens=False).ids
    repair = coder._repair
    for share in (0.0, 0.3, 1.0):
        coder._repair = lambda *a, s=share: None if rnd.random() < s else repair(*a)
        n, csv, out = coder.encode(text)
        assert n == len(want) and csv == ",".join(map(str, want)) and out == text.encode()
