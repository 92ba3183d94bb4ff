"""Ids of the lower-casing BPE with word ends, a stretch between blanks at a time.

No token of this vocabulary crosses white space, so a text's ids are those of its blank-separated
stretches in order. Each distinct stretch is encoded once per worker and kept, as the little-endian
bytes of its ids, while the store has room; a text is then one join of byte strings.

Encoding proper: the tokenizer file's normalizer (NFC, lower case) and split pattern, then byte-pair
merging in rank order. A word's last byte carries the word end, which is put as a byte that UTF-8 never
uses: (byte, end) pairs have the lowest ranks, so they merge before all others. Texts that hold a special
token's string go to the tokenizers library itself, and so do stretches with a letter or number of a
Unicode newer than the library's: the pattern would take it for a part of a word.
"""

from __future__ import annotations

import json
import struct
import unicodedata

from tallyquill.llm.held import held

END = b"\xff"
ROOM = 500_000  # stretches kept per worker, about 100 MB


def _byte_of() -> dict[str, int]:
    """The printable stand-in of each byte: itself where printable, else the next code point from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def newer() -> frozenset[str]:
    """Letters and numbers to the split pattern's engine that Unicode 15 does not assign."""
    import regex

    unassigned = "".join(c for c in map(chr, range(128, 0x110000)) if unicodedata.category(c) == "Cn")
    return frozenset(regex.findall(r"[\p{L}\p{N}]", unassigned))


class WordBpe(dict):
    """Stretch -> bytes of its ids as unsigned 32-bit little-endian."""

    def __init__(self, path: str, room: int = ROOM):
        import regex
        import tiktoken
        from tokenizers import Tokenizer

        super().__init__()
        self.room = room
        spec = json.load(open(path, encoding="utf-8"))
        byte_of = _byte_of()
        self.specials = [t["content"] for t in spec["added_tokens"]]
        ranks = {}
        for token, i in spec["model"]["vocab"].items():
            if token in self.specials:
                continue
            ended = token.endswith("</w>")
            ranks[bytes(byte_of[c] for c in (token[:-4] if ended else token)) + END * ended] = i
        self.merge = tiktoken.Encoding("words", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece
        self.words = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]).findall
        self.newer = newer()
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()

    def __missing__(self, stretch: str) -> bytes:
        if stretch.isascii() and stretch.isalpha():
            ids = self.merge(stretch.lower().encode() + END)
        elif not self.newer.isdisjoint(stretch):
            ids = self.library.encode(stretch, add_special_tokens=False).ids
        else:
            ids = []
            for w in self.words(lowered(unicodedata.normalize("NFC", stretch))):
                ids += self.merge(w.encode() + END)
        out = struct.pack(f"<{len(ids)}I", *ids)
        if len(self) < self.room and len(stretch) < 64:
            self[stretch] = out
        return out

    def encode(self, text: str) -> bytes:
        if any(s in text for s in self.specials):
            ids = self.library.encode(text, add_special_tokens=False).ids
            return struct.pack(f"<{len(ids)}I", *ids)
        return b"".join(map(self.__getitem__, text.replace("\n", " ").replace("\t", " ").split(" ")))


def lowered(s: str) -> str:
    """Lower case a character at a time: the library knows no final sigma."""
    return s.lower() if s.isascii() or "Σ" not in s else "".join(c.lower() for c in s)


def word_bpe(path: str) -> WordBpe:
    """This worker's encoder for the file, made once."""
    return held(WordBpe, path)
