"""Text alignment against the standard library's."""

import difflib
import random
import time

import pytest

from tallyquill.functions.alignment import blocks, changes, shown


def wanted(a, b):
    return [(i, j, n) for i, j, n in difflib.SequenceMatcher(None, a, b, autojunk=False).get_matching_blocks() if n]


def opcodes(a, b):
    return [tuple(o[1:]) for o in difflib.SequenceMatcher(None, a, b, autojunk=False).get_opcodes() if o[0] != "equal"]


@pytest.mark.parametrize("a, b", [("", ""), ("", "x"), ("x", ""), ("abc", "abc"), ("abcd", "bcde"), ("aaaa", "aa"), ("ab" * 40, "ba" * 40), ("漢字😀x", "字😀漢x"), ("a\ud800b", "b\ud800")])
def test_small_texts(a, b):
    assert blocks(a, b) == wanted(a, b) and changes(a, b) == opcodes(a, b)


def test_random_texts():
    rnd = random.Random(8)
    for letters, size in (("ab", 120), ("abcd", 300), ("abcdefgh ", 700)):
        for _ in range(15):
            a = "".join(rnd.choice(letters) for _ in range(rnd.randrange(size)))
            b = list(a)
            for _ in range(rnd.randrange(12)):
                at = rnd.randrange(len(b) + 1)
                b[at : at + rnd.randrange(9)] = [rnd.choice(letters) for _ in range(rnd.randrange(9))]
            b = "".join(b)
            assert changes(a, b) == opcodes(a, b)
            c = "".join(rnd.choice(letters) for _ in range(rnd.randrange(size)))
            assert blocks(a, c) == wanted(a, c)


def test_a_hundred_thousand_characters_in_seconds():
    rnd = random.Random(2)
    words = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 9))) for _ in range(4000)]
    text = [rnd.choice(words) for _ in range(16_000)]
    edited = [w if rnd.random() > 0.01 else rnd.choice(words) for w in text if rnd.random() > 0.005]
    a, b = " ".join(text), " ".join(edited)
    began = time.time()
    got = changes(a, b)
    assert len(a) > 90_000 and time.time() - began < 30
    i = j = 0
    for x, y, u, v in got:  # what is between the changes stays
        assert a[i:x] == b[j:u]
        i, j = y, v
    assert a[i:] == b[j:] and len(got) > 100
    began = time.time()
    assert changes("x" * 100_000, "x" * 99_000) == [(99_000, 100_000, 99_000, 99_000)] and time.time() - began < 10


def test_context_and_marks():
    assert shown("one two three four", "one 2 three four", 4) == "one [-two-]{+2+} thr…"
    assert shown("abcdefghijklmnop", "abcdefghijklmnopX", 3) == "…nop{+X+}"
    assert shown("same", "same", 3) == ""
