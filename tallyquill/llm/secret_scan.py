"""Secret scan in DataFrame functions alone.

Base findings are three patterns. To them come high-entropy spans: over each candidate string a window
of ``WINDOW`` characters slides, the count of each character is kept by adding the entering and
subtracting the leaving one, and the sum of c*log2(c) follows from the two counts that change; a window
whose Shannon entropy reaches the threshold of the string's character class is hot. Strings matching an
allow-list pattern are left out, as are candidates inside a base finding. Texts and candidates may be of any
length: the work is close to linear in both.

Matches are found as text: ``regexp_extract_all`` gives the matches, ``split`` what stands between them,
and the running sum of both lengths gives the places, in code points.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyquill.llm.common import text_or_empty

#: Patterns of the base kinds, in their listed order.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
#: Cheap tests that every text with a valid finding passes.
ASSIGN_HINT = r"""[:=]\x20*["']?[A-Za-z0-9+/_.=-]{12}"""
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 12, 18, 16
HEX_RUN = r"[0-9a-f]{16,}"  # runs are maximal, so this finds what HEX finds and its length test keeps

WINDOW = 20
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*[0-9])(?=[0-9+/_=-]*[A-Za-z])[A-Za-z0-9+/_=-]{20,}"
ALPHABET = "0123456789abcdefABCDEFghijklmnopqrstuvwxyzGHIJKLMNOPQRSTUVWXYZ+/_=-"
PER_WORD = 12  # counts of five bits in a long
BLOCK = 256  # elements by which arrays grow
CUT = 4096  # characters of the pieces that a text is redacted in
#: Bits a window must reach, by character class.
THRESHOLDS = {"hex": 3.0, "alnum": 3.7, "base64": 3.9}
#: Strings that look random and are no secrets: UUIDs, dates and times, documented sample keys, slugs of plain words, one long number.
ALLOW_LIST = (
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    r"^\d{4}-\d{2}-\d{2}[T_]",
    r"(?i)EXAMPLE(KEY)?$",
    r"^(?:[A-Za-z]++[/_=-]++)++[0-9]++$",
)


def let(value: Column, f) -> Column:
    """f(value) with the value computed once."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def running(items: Column, start: Column, step, of: str) -> Column:
    """Array of what ``step(state, item)`` gives beside the next state, for each item in order. ``of`` is the
    type of its elements. Arrays grow by blocks, and blocks by an array of blocks, since appending copies
    an array: the work is close to linear in the items."""

    def one(acc: Column, x: Column) -> Column:
        state, out = step(acc["s"], x)
        return F.struct(state.alias("s"), F.concat(acc["out"], F.array(out)).alias("out"))

    def over(acc: Column, block: Column) -> Column:
        done = F.aggregate(block, F.struct(acc["s"].alias("s"), F.expr(f"cast(array() as array<{of}>)").alias("out")), one)
        return let(done, lambda d: F.struct(d["s"].alias("s"), F.concat(acc["out"], F.array(d["out"])).alias("out")))

    def all_of(xs: Column) -> Column:
        last = F.greatest(F.ceil(F.size(xs) / BLOCK).cast("int") - 1, F.lit(0))
        blocks = F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(xs, k * BLOCK + 1, F.lit(BLOCK)))
        return F.aggregate(blocks, F.struct(start.alias("s"), F.expr(f"cast(array() as array<array<{of}>>)").alias("out")), over, lambda acc: F.flatten(acc["out"]))

    return let(items, all_of)


SPAN = "struct<start:int,kind:int,end:int>"
FOUND = "struct<start:int,kind:int,end:int,m:string>"


def _found(text: Column, pattern: str, hint: Column, kind: int, keep) -> Column:
    """Array of (start, kind, end, m) of the leftmost non-overlapping matches m for which keep(m, group 2) holds."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    second = F.regexp_extract_all(text, F.lit(pattern), F.lit(2)) if pattern == ASSIGN else found
    zipped = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), found.alias("m"), second.alias("g"))

    def step(at: Column, x: Column) -> tuple[Column, Column]:
        start = at + F.length(x["gap"])
        end = start + F.coalesce(F.length(x["m"]), F.lit(0))
        return end, F.when(keep(x["m"], x["g"]), F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), x["m"].alias("m")))

    none = F.expr(f"cast(array() as array<{FOUND}>)")
    return F.when(hint, F.array_compact(running(zipped, F.lit(0), step, FOUND))).otherwise(none)


def _spans(found: Column) -> Column:
    return F.transform(found, lambda x: F.struct(x["start"], x["kind"], x["end"]))


def hot_range(s: Column, threshold: Column, window: int = WINDOW) -> Column:
    """(first, last): from the start of the first hot window to the end of the last one, 0-based and
    end-exclusive; last 0 where no window is hot.

    The counts of all characters stand in a few longs, five bits each, and move by one character at each
    step: the entering one's place goes up, the leaving one's down. The sum of c*log2(c) is kept as an
    integer of 2**-40 bits, so that it does not drift. Linear in the string.
    """
    assert window < 32  # a count has five bits
    unit, words = 1 << 40, -(-len(ALPHABET) // PER_WORD)
    terms = [round(n * math.log2(n) * unit) if n else 0 for n in range(window + 2)]
    # what a count's term rises by when n becomes n + 1
    rise = F.array(*(F.lit(b - a).cast("long") for a, b in zip(terms, terms[1:])))
    most = F.floor((F.lit(math.log2(window)) - threshold) * window * unit + 1000).cast("long")

    def place(c: Column) -> Column:
        return F.struct(F.floor((c - 1) / PER_WORD).cast("int").alias("w"), ((c - 1) % PER_WORD * 5).cast("int").alias("b"))

    def steps(at: Column) -> Column:
        return F.transform(at, lambda c, i: F.struct(place(c).alias("e"), F.when(i >= window, place(F.get(at, i - window))).alias("l"), i.alias("i"), (c == F.get(at, i - window)).alias("same")))

    def word(acc: Column, w: Column) -> Column:
        out = acc["w0"]
        for k in range(1, words):
            out = F.when(w == k, acc[f"w{k}"]).otherwise(out)
        return out

    def count(acc: Column, p: Column) -> Column:
        return F.call_function("shiftright", word(acc, p["w"]), p["b"]).bitwiseAND(F.lit(31).cast("long")).cast("int")

    def one(p: Column, k: int) -> Column:
        return F.when(p["w"] == k, F.call_function("shiftleft", F.lit(1).cast("long"), p["b"])).otherwise(F.lit(0).cast("long"))

    def move(acc: Column, x: Column) -> Column:
        e, l = x["e"], x["l"]
        added = acc["sum"] + F.get(rise, count(acc, e))
        # the entering character is counted before the leaving one goes
        total = F.when(l.isNull(), added).otherwise(added - F.get(rise, count(acc, l) + F.when(x["same"], 0).otherwise(-1)))

        def told(t: Column) -> Column:
            hot = (x["i"] >= window - 1) & (t <= acc["most"])
            kept = [(acc[f"w{k}"] + one(e, k) - F.when(l.isNull(), F.lit(0).cast("long")).otherwise(one(l, k))).alias(f"w{k}") for k in range(words)]
            first = F.when(hot & (acc["last"] == 0), x["i"] - (window - 1)).otherwise(acc["first"])
            return F.struct(*kept, t.alias("sum"), acc["most"].alias("most"), first.alias("first"), F.when(hot, x["i"] + 1).otherwise(acc["last"]).alias("last"))

        return let(total, told)

    def over(at: Column) -> Column:
        nothing = F.lit(0).cast("long")
        start = F.struct(*(nothing.alias(f"w{k}") for k in range(words)), nothing.alias("sum"), most.alias("most"), F.lit(0).alias("first"), F.lit(0).alias("last"))
        return F.aggregate(steps(at), start, move, lambda acc: F.struct(acc["first"].alias("first"), acc["last"].alias("last")))

    characters = F.filter(F.split(s, ""), lambda c: c != "")
    return let(F.transform(characters, lambda c: F.instr(F.lit(ALPHABET), c)), over)


def _outside(base: Column, candidates: Column) -> Column:
    """Candidates that lie in no base finding: in order of start, no earlier finding ends at or after theirs."""
    wide = F.transform(base, lambda b: F.struct(b["start"], b["kind"], b["end"], F.lit("").alias("m")))

    def step(reach: Column, x: Column) -> tuple[Column, Column]:
        own = x["kind"] == 3
        return F.when(own, reach).otherwise(F.greatest(reach, x["end"])), F.when(own & (x["end"] > reach), x)

    return F.when(F.size(candidates) > 0, F.array_compact(running(F.array_sort(F.concat(wide, candidates)), F.lit(0), step, FOUND))).otherwise(candidates)


def _entropy_spans(text: Column, base: Column, allow_list, thresholds) -> Column:
    hint = text.rlike("[0-9]") & text.rlike(CANDIDATE)
    candidates = _found(text, CANDIDATE, hint, 3, lambda m, g: m.isNotNull() & ~reduce(lambda a, b: a | b, [m.rlike(p) for p in allow_list], F.lit(False)))

    def narrowed(c: Column) -> Column:
        s = c["m"]
        threshold = F.when(s.rlike("^[0-9a-fA-F]+$"), thresholds["hex"]).when(s.rlike("^[0-9A-Za-z]+$"), thresholds["alnum"]).otherwise(thresholds["base64"])
        return let(hot_range(s, threshold), lambda r: F.struct((c["start"] + r["first"]).alias("start"), F.lit(3).alias("kind"), F.when(r["last"] > 0, c["start"] + r["last"]).otherwise(F.lit(-1)).alias("end")))

    return let(candidates, lambda cs: F.filter(F.transform(_outside(base, cs), narrowed), lambda c: c["end"] > 0))


KINDS = ("assign", "access", "hex", "entropy")


def scan_secrets(docs: DataFrame, text_col: str = "text", allow_list=ALLOW_LIST, thresholds=THRESHOLDS, base_col: str = "base_spans", all_col: str = "all_spans") -> DataFrame:
    """docs plus two arrays of (start, kind, end), sorted by start and then kind: the base findings and
    all findings. kind indexes KINDS; places are code points, end exclusive. A null text counts as empty
    and has no findings; existing columns named like the two are replaced.
    """
    text = text_or_empty(text_col)
    assign = _found(text, ASSIGN, text.rlike(ASSIGN_HINT), 0, lambda m, g: F.length(g) >= ASSIGN_LEAST)
    access = _found(text, ACCESS, text.contains("AKIA"), 1, lambda m, g: F.length(m) >= ACCESS_LEAST)
    hexes = _found(text, HEX_RUN, text.rlike(HEX_RUN), 2, lambda m, g: m.isNotNull())
    out = docs.withColumn(base_col, F.array_sort(F.concat(*map(_spans, (assign, access, hexes)))))
    return out.withColumn(all_col, F.array_sort(F.concat(F.col(base_col), _entropy_spans(text, F.col(base_col), allow_list, thresholds))))


def joined(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """text with each span replaced by the mark; overlapping spans share one. The text is cut into pieces
    once, so that what stands between two spans is taken from the pieces it lies in."""

    def between(pieces: Column, a: Column, b: Column) -> Column:
        i = F.floor(a / CUT).cast("int")
        j = F.greatest(i, F.floor((b - 1) / CUT).cast("int"))
        return F.substring(F.array_join(F.slice(pieces, i + 1, j - i + 1), ""), a - i * CUT + 1, b - a)

    def step(at: Column, s: Column) -> tuple[Column, Column]:
        return F.greatest(at, s["end"]), F.when(s["start"] >= at, F.struct(at.alias("a"), s["start"].alias("b")))

    def put(pieces: Column) -> Column:
        kept = F.array_compact(running(spans, F.lit(0), step, "struct<a:int,b:int>"))
        last = between(pieces, F.array_max(F.transform(spans, lambda s: s["end"])), F.length(text))
        return F.concat(F.array_join(F.transform(kept, lambda g: F.concat(between(pieces, g["a"], g["b"]), F.lit(mark))), ""), last)

    return F.when(F.size(spans) == 0, text).otherwise(let(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CUT}}}+"), F.lit(0)), put))
