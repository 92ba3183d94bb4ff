"""Leaf blocks of a page: runs of text between block-level tags, with the path of tags above them.

The page is read once from left to right, as HTML says: a quote opens a value only after '=', a comment,
a script or a tag that never ends runs to the end of the page. A quote that is never closed does not: its
tag ends at the next '>'. Work is linear in the page, however deep its tags are nested: a block refers to
the node it stands under, and nodes share what is above them.
"""

from __future__ import annotations

import html
import re
import zlib
from bisect import bisect_left
from functools import lru_cache

#: Tags that stay inside a block; all others end one. Fixed by HTML and MathML.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
MATHS = frozenset("math menclose merror mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover semantics".split())
#: Empty elements, and those of them that do not end a block.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset("area base embed img input link meta param source track".split())
#: Elements whose content is no text of the page; of the first no other element can be in it.
RAW = frozenset("script style textarea title iframe xmp noembed noframes".split())
SKIPPED = frozenset("noscript template object svg canvas annotation annotation-xml".split())
#: An opening tag of the key closes an open tag of its values, up to a tag that holds such things.
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
HOLDS = frozenset("ul ol dl table body article section div main nav aside footer header form select blockquote".split())
ENDS_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol pre section table ul".split())

NAME = re.compile(r"[a-zA-Z][^\s/>]*+")
ATTRIBUTE = re.compile(r"[\s/]*+([^\s/>=][^\s/>=]*+)(\s*+=\s*+)?")
BLANK = re.compile(r"[\s/]*+")
END = re.compile(r"[\s/]*+>")
PLAIN = re.compile(r"[^\s>]*+")
WORDS = re.compile(r"[a-z]+|[0-9]+")
SCRIPT = re.compile(r"<!---?>|<!--|-->|</script(?=[\s/>])[^>]*+>|<script(?=[\s/>])", re.I)
KEPT = {"class": "c", "id": "i", "role": "r", "itemprop": "i"}
PATH = 512  # places of a hashed path


@lru_cache(1 << 16)
def bit(name: str) -> int:
    return 1 << zlib.crc32(name.encode()) % PATH


class Node:
    """An open tag: its names (the tag and its class, id, role and itemprop words) and the places, as bits,
    of all names and neighbouring pairs of names from the root to it."""

    __slots__ = ("above", "names", "places")

    def __init__(self, above: Node | None, names: list[str]):
        self.above, self.names = above, names
        places = above.places if above else 0
        last = above.names[-1] if above else None
        for n in names:
            places |= bit(n) if last is None else bit(n) | bit(f"{last}>{n}")
            last = n
        self.places = places


class Leaf:
    __slots__ = ("node", "text", "link")

    def __init__(self, node: Node | None, text: str, link: int):
        self.node, self.text, self.link = node, text, link

    @property
    def places(self) -> int:
        return self.node.places if self.node else 1

    @property
    def path(self) -> tuple[str, ...]:
        nodes, node = [], self.node
        while node:
            nodes.append(node)
            node = node.above
        return tuple(x for n in reversed(nodes) for x in n.names)


class _Page:
    """A page and how far it is read."""

    def __init__(self, text: str):
        self.text, self.at = text, 0
        self.gone: set[str] = set()  # what was looked for and does not stand in the rest
        self.found: dict[str, int] = {}  # where it was found last
        self.pairs: dict[str, tuple[dict[int, int], list[int]]] = {}

    def find(self, s: str, at: int) -> int:
        if s in self.gone:
            return -1
        p = self.found.get(s, -1)
        if p < at:
            p = self.found[s] = self.text.find(s, at)
        if p < 0:
            self.gone.add(s)
        return p

    def skip_to(self, s: str, at: int) -> None:
        p = self.find(s, at)
        self.at = p + len(s) if p >= 0 else len(self.text)

    def skip_comment(self, at: int) -> None:
        """Over the comment whose text starts here: it ends at --> or --!>."""
        ends = [(p, len(s)) for s in ("-->", "--!>") for p in [self.find(s, at)] if p >= 0]
        self.at = sum(min(ends)) if ends else len(self.text)

    def script_end(self) -> int:
        """Where the script's end tag ends, -1 if there is none. Within <!-- a script in the script has its own end tag."""
        state = "data"
        for m in SCRIPT.finditer(self.text, self.at):
            what = m[0].lower()
            if what.startswith("<!--"):
                state = "escaped" if what == "<!--" and state == "data" else state
            elif what == "-->":
                state = "data"
            elif what.startswith("</"):
                if state != "double":
                    return m.end()
                state = "escaped"
            elif state == "escaped":
                state = "double"
        return -1

    def matching_end(self, tag: str, start: int) -> int:
        """Where the end tag ends that belongs to the element opened at start, elements of its kind within it
        having their own; of one that is never closed the next end tag; -1 without any."""
        if tag not in self.pairs:
            ends, closes, open_at = {}, [], []
            for m in re.finditer(rf"<(/?){re.escape(tag)}(?=[\s/>])[^>]*+>", self.text, re.I):
                if m[1]:
                    closes.append(m.end())
                    if open_at:
                        ends[open_at.pop()] = m.end()
                elif not m[0].endswith("/>"):
                    open_at.append(m.start())
            self.pairs[tag] = ends, closes
        ends, closes = self.pairs[tag]
        k = bisect_left(closes, self.at)
        return ends.get(start, closes[k] if k < len(closes) else -1)

    def end_tag(self, tag: str) -> int:
        """Where the element's end tag ends, -1 if there is none."""
        if tag in self.gone:
            return -1
        m = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*+>", re.I).search(self.text, self.at)
        if m is None:
            self.gone.add(tag)
        return m.end() if m else -1

    def tag_rest(self) -> tuple[dict[str, str], bool] | None:
        """Attributes that count and whether the tag closes itself; None where the page ends before."""
        kept: dict[str, str] = {}
        while True:
            m = END.match(self.text, self.at)
            if m:
                self.at = m.end()
                return kept, m[0][-2:-1] == "/"
            m = ATTRIBUTE.match(self.text, self.at)
            if m is None:
                self.at = BLANK.match(self.text, self.at).end() + 1  # over a stray '='
                if self.at > len(self.text):
                    return None
                continue
            self.at, value = m.end(), ""
            if m[2]:
                quote = self.text[self.at : self.at + 1]
                if quote in ('"', "'") and quote:
                    end = self.find(quote, self.at + 1)
                    if end < 0:  # never closed
                        self.skip_to(">", self.at)
                        return kept, False
                    value, self.at = self.text[self.at + 1 : end], end + 1
                else:
                    v = PLAIN.match(self.text, self.at)
                    value, self.at = v[0], v.end()
            key = m[1].lower()
            if key in KEPT and key not in kept:
                kept[key] = value


def leaves(page: str) -> list[Leaf]:
    """All non-empty blocks in page order. Character references are decoded once, white space inside a
    block is one space; script, style and the like have no text and end no block, no more than pictures
    do; formulas are text. An unclosed comment, script or tag runs to the end of the page. A break ends a block."""
    out: list[Leaf] = []
    stack: list[tuple[str, Node, int]] = []  # tag, node, place of the nearest tag at or below that holds others
    opened: dict[str, list[int]] = {}  # places in the stack by tag
    parts: list[str] = []
    node: Node | None = None
    link, in_link = 0, False
    src = _Page(page)

    def flush() -> None:
        nonlocal link
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                out.append(Leaf(node, text, min(link, len(text))))
            parts.clear()
        link = 0

    def said(text: str) -> None:
        nonlocal link
        text = html.unescape(text)
        parts.append(text)
        if in_link:
            link += len(text.strip())

    def pop_to(place: int) -> None:
        while len(stack) > place:
            opened[stack.pop()[0]].pop()

    def last(tag: str) -> int:
        return opened[tag][-1] if opened.get(tag) else -1

    n = len(page)
    while src.at < n:
        start = src.find("<", src.at)
        if start < 0:
            said(page[src.at :])
            break
        if start > src.at:
            said(page[src.at : start])
        closing = page[start + 1 : start + 2] == "/"
        m = NAME.match(page, start + 1 + closing)
        if m is None:
            if page.startswith("<!--", start):
                src.skip_comment(start + 2 if page.startswith(("<!-->", "<!--->"), start) else start + 4)
            elif page[start + 1 : start + 2] in ("!", "?", "/") and start + 1 < n:
                src.skip_to(">", start + 1)
            else:
                said("<")
                src.at = start + 1
            continue
        tag = m[0].lower()
        src.at = m.end()
        rest = src.tag_rest()
        if rest is None:
            break
        kept, itself = rest
        if tag in INLINE or tag in MATHS:
            if tag == "a":
                in_link = not closing
            continue
        if not closing and (tag in RAW or tag in SKIPPED):
            if itself and tag in SKIPPED:
                continue
            end = src.script_end() if tag == "script" else src.matching_end(tag, start) if tag in SKIPPED else src.end_tag(tag)
            if end >= 0:
                src.at = end
            elif tag in RAW and not itself:
                src.at = n
            continue
        if tag in RAW or tag in SKIPPED or tag in UNSEEN:
            continue
        flush()
        if tag == "plaintext" and not closing:  # no tag ends it
            parts.append(page[src.at :])
            break
        if closing:
            place = last(tag)
            if place >= 0:
                pop_to(place)
                in_link = False
                node = stack[-1][1] if stack else None
            continue
        if tag in VOID or itself and tag not in HOLDS and tag != "p":
            continue
        closes = CLOSES.get(tag, ()) or (("p",) if tag in ENDS_P else ())
        place = max((last(t) for t in closes), default=-1)
        if place >= 0 and place > (stack[-1][2] if stack else -1):
            pop_to(place)
            node = stack[-1][1] if stack else None
        names = [tag]
        for key, value in kept.items():
            names += [f"{KEPT[key]}:{w}" for w in WORDS.findall(value.lower())]
        node = Node(node, names)
        opened.setdefault(tag, []).append(len(stack))
        stack.append((tag, node, len(stack) if tag in HOLDS else stack[-1][2] if stack else -1))
    flush()
    return out
