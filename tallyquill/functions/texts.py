"""Faults and cues in question texts, each as an expression over the text alone."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyquill.functions import fixed as X
from tallyquill.functions.names import collapsed, parent_of, root_of, stripped


def let(value: Column, f) -> Column:
    """f(value) with the value computed once: f gets a name for it, however often it uses it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def found_all(c: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(c, F.lit(pattern), F.lit(group))


def occurrences(c: Column, s: str) -> Column:
    return ((F.length(c) - F.length(F.replace(c, F.lit(s), F.lit("")))) / len(s)).cast("int")


def broken_powers(text: Column) -> Column:
    """Letter-digit runs that look like a flattened power, '2x2' grids and 'Q1' labels aside."""
    return found_all(F.regexp_replace(F.regexp_replace(text, X.DIMENSION_TOKEN, "#"), X.LABEL_TOKEN, "#"), X.BROKEN_POWER)


def pipe_blocks(text: Column) -> Column:
    """Runs of two or more consecutive lines with a pipe."""
    # lines hold no line end, so that "\r" can stand between the lines of a block and "\n" for what parts blocks
    marked = F.array_join(F.transform(F.split(text, X.LINE_ENDS), lambda line: F.when(line.contains("|"), line).otherwise("\n")), "\r")
    blocks = F.filter(F.split(marked, "[\r\n]*\n[\r\n]*"), lambda b: b.contains("\r"))
    return F.when(text.contains("|"), F.transform(blocks, lambda b: F.split(b, "\r"))).otherwise(F.expr("cast(array() as array<array<string>>)"))


def has_separator(block: Column) -> Column:
    return F.exists(F.slice(block, 1, 2), lambda line: line.rlike(X.TABLE_SEPARATOR))


def is_table_like(block: Column) -> Column:
    return has_separator(block) | (F.size(F.array_distinct(F.transform(block, lambda line: occurrences(line, "|")))) == 1)


def cell_count(line: Column) -> Column:
    """Cells of a table row, outer pipes aside."""
    parts = F.split(line, r"\|", -1)
    n = F.size(parts)
    first = F.when(stripped(parts[0]) == "", 1).otherwise(0)
    last = F.when((n > first) & (stripped(F.element_at(parts, -1)) == ""), 1).otherwise(0)
    return n - first - last


def malformed_tables(blocks: Column) -> Column:
    """How many table-like blocks lack the separator row."""
    return F.size(F.filter(blocks, lambda b: is_table_like(b) & ~has_separator(b)))


def ragged_tables(blocks: Column) -> Column:
    """For each table whose rows disagree on their number of cells, by how many."""

    def spread(b: Column) -> Column:
        counts = F.transform(b, cell_count)
        return F.array_max(counts) - F.array_min(counts)

    return F.filter(F.transform(F.filter(blocks, has_separator), spread), lambda n: n > 0)


def looks_like_a_table(blocks: Column) -> Column:
    return F.exists(blocks, is_table_like)


def repeated_sentences(text: Column, ends: str = X.SENTENCE_ENDS) -> Column:
    """Sentences of at least 8 characters that stand more than once in one text, sorted."""
    parts = F.transform(F.split(text, f"[{ends}\n]+"), collapsed)
    parts = F.array_sort(F.filter(parts, lambda s: (F.length(s) >= X.LEAST_SENTENCE) & ~s.contains("|")))
    return let(parts, lambda p: F.array_distinct(F.filter(p, lambda s, i: s == F.get(p, i + 1))))


def looks_like_multiple_choice(text: Column) -> Column:
    return F.size(F.array_distinct(found_all(text, X.OPTION_LINE, 1))) >= X.LEAST_OPTIONS


def outside_maths(text: Column) -> Column:
    return F.regexp_replace(text, X.MATH_SPAN, " ")


def undelimited_latex(text: Column) -> Column:
    """LaTeX commands and braced scripts outside delimited maths."""
    out = outside_maths(text)
    return F.concat(found_all(out, X.LOOSE_COMMAND), found_all(out, X.LOOSE_SCRIPT))


def dash_counts(text: Column) -> Column:
    """Uses of each dash character in the prose, as a struct of one count each."""
    prose = outside_maths(text)
    return F.struct(*(occurrences(prose, d).alias(n) for d, n in zip(X.DASHES, ("hyphen", "en_dash", "minus"), strict=True)))


def control_characters(text: Column) -> Column:
    """Control characters other than line feeds, in order of appearance."""
    return found_all(text, r"[\x00-\x09\x0b-\x1f]")


def method_cues(text: Column) -> Column:
    """Phrases that state the method, as printed."""
    return found_all(F.coalesce(text, F.lit("")), "(?iuU)" + "|".join(f"(?:{p})" for p in X.METHOD_CUES))


def says_hence(text: Column) -> Column:
    return text.rlike(X.HENCE)


def referenced_parts(text: Column, qid: Column) -> Column:
    """Ids of the parts that a text names with a cue word, in order, each once, itself left out."""
    parent = parent_of(qid)
    nested = F.coalesce(parent.contains("("), F.lit(False))

    def target(token: Column) -> Column:
        base = F.when(token.rlike("^[ivx]{1,4}$") & nested, parent).otherwise(root_of(qid))
        return F.concat(base, F.lit("("), token, F.lit(")"))

    return F.array_distinct(F.filter(F.transform(found_all(text, X.REFERENCE, 1), target), lambda t: t != qid))


def restore_backslashes(text: Column) -> Column:
    """(text, f, b): form feeds and backspaces back to the \\f and \\b they came from, and how many."""
    fixed = reduce(lambda c, pair: F.replace(c, F.lit(pair[0]), F.lit("\\" + pair[1])), X.EATEN.items(), text)
    return F.struct(fixed.alias("text"), *(occurrences(text, c).alias(letter) for c, letter in X.EATEN.items()))


def is_bare_formula(line: Column) -> Column:
    s = stripped(line)
    delimited = s.contains("\\(") | s.contains("\\)") | s.contains("$")
    return (s != "") & ~s.rlike(X.CJK) & ~delimited & (s.rlike(X.LOOSE_COMMAND) | s.rlike(X.LOOSE_SCRIPT))


def wrap_bare_formulas(text: Column) -> Column:
    """(text, wrapped): lines that are a formula and nothing else put in \\( \\), and those lines."""
    lines = F.split(text, "\n", -1)

    def wrapped(line: Column) -> Column:
        return F.when(is_bare_formula(line), F.concat(F.regexp_extract(line, r"(?U)^(\s*)", 1), F.lit("\\( "), stripped(line), F.lit(" \\)"))).otherwise(line)

    return F.struct(F.array_join(F.transform(lines, wrapped), "\n").alias("text"), F.transform(F.filter(lines, is_bare_formula), stripped).alias("wrapped"))


# ---- answers

def strip_latex(s: Column) -> Column:
    """Plain text of an answer: \\frac{a}{b} -> (a)/(b), innermost first, however deep."""
    s = F.regexp_replace(s, r"\\[\(\)\[\]]", "")
    s = F.regexp_replace(s, r"\\(left|right|,|;|!|quad|displaystyle)", "")
    s = F.regexp_replace(s, r"(?U)\\sqrt\s*\{([^{}]*)\}", "sqrt($1)")
    s = F.regexp_replace(F.regexp_replace(s, r"\^\{([^{}]*)\}", "^$1"), r"_\{([^{}]*)\}", "_$1")
    passes = F.sequence(F.lit(1), F.regexp_count(s, F.lit("frac")))  # a pass unwraps one at least, if any is left
    s = F.aggregate(passes, s, lambda t, _: F.regexp_replace(t, r"(?U)\\(?:d|t)?frac\s*\{([^{}]*)\}\s*\{([^{}]*)\}", "($1)/($2)"))
    s = F.regexp_replace(s, r"(?U)\((\w+)\)", "$1")
    for a, b in (("\\pm", "±"), ("\\times", "*"), ("\\cdot", "*"), ("\\pi", "π")):
        s = F.replace(s, F.lit(a), F.lit(b))
    s = F.regexp_replace(s, r"(?U)\\(?:text|mathrm|mbox)\s*\{([^{}]*)\}", "$1")
    return F.translate(F.regexp_replace(s, r"\\[a-zA-Z]+", ""), "{}", "")


def six_digits(x: Column) -> Column:
    """A number to six significant digits, trailing zeros off, exponent form below 1e-4 and from 1e6."""
    return let(F.struct(x.alias("x"), F.format_string("%.5e", x).alias("s")), lambda v: _six_digits(v["x"], v["s"]))


def _six_digits(x: Column, science: Column) -> Column:
    exponent = F.regexp_extract(science, r"e([-+]\d+)$", 1)
    e = F.when(exponent != "", exponent).cast("int")

    def trimmed(c: Column) -> Column:
        return F.regexp_replace(F.regexp_replace(c, r"(\.\d*?)0+$", "$1"), r"\.$", "")

    out = F.concat(trimmed(F.regexp_extract(science, r"^(.*)e", 1)), F.lit("e"), exponent)
    for k in range(-4, 6):
        out = F.when(e == k, trimmed(F.format_string(f"%.{5 - k}f", x))).otherwise(out)
    return F.when(x == 0, F.lit("0")).otherwise(out)


def normalise_answer(text: Column) -> Column:
    """One form to compare: an option letter, a number, or lower-cased text; null for a blank answer."""
    return let(stripped(text), _normalised)


def _normalised(s: Column) -> Column:
    letter = F.when(s.rlike(X.MC_LETTER), F.upper(F.regexp_extract(s, X.MC_LETTER, 1)))
    t = F.when(s.rlike(r"[\\{}(]"), stripped(strip_latex(s))).otherwise(s)  # nothing to strip elsewhere
    t = F.regexp_replace(t, X.LEADING_VARIABLE, "")
    t = F.regexp_replace(F.translate(t, "−×，", "-*,"), r"[.。 ]+$", "")
    t = F.replace(F.lower(F.regexp_replace(t, r"(?U)\s+", "")), F.lit("$"), F.lit(""))
    t = F.regexp_replace(F.regexp_replace(t, X.UNITS, ""), r"[.。]+$", "")
    t = F.regexp_replace(t, r"^\((-?\d+(?:\.\d+)?)\)$", "$1")
    short = s.rlike("^(?:0|-?[1-9][0-9]{0,5})$")  # a whole number that is its own form
    return F.when(short, s).when(s != "", F.coalesce(letter, let(t, _number_or_text)))


def _number_or_text(t: Column) -> Column:
    fraction = t.rlike(X.FRACTION)
    under = F.when(fraction, F.regexp_extract(t, X.FRACTION, 2)).cast("double")
    over = F.when(fraction, F.regexp_extract(t, X.FRACTION, 1)).cast("double")
    value = F.when(under > 0, over / under).when(t.rlike(X.NUMBER), F.when(t.rlike(X.NUMBER), t).cast("double"))
    return let(value, lambda v: F.when(v.isNotNull(), six_digits(v)).otherwise(t))


def answers_match(given: Column, reference: Column) -> Column:
    """True, false, or null where there is nothing to compare: a blank side, or one single character
    against several, unless a bracketed value settles that."""
    both = F.concat(F.coalesce(given, F.lit("None")), F.coalesce(reference, F.lit("None")))
    sides = F.struct(normalise_answer(given).alias("a"), normalise_answer(reference).alias("b"), both.alias("both"))

    def verdict(v: Column) -> Column:
        a, b = v["a"], v["b"]
        lopsided = (F.length(a) == 1) != (F.length(b) == 1)
        inner = normalise_answer(F.regexp_extract(v["both"], r"\(([^()]+)\)", 1))
        inside = F.coalesce(inner == F.when(F.length(a) == 1, b).otherwise(a), F.lit(False))
        return F.when(a.isNull() | b.isNull(), F.lit(None)).when(a == b, True).when(lopsided, F.when(v["both"].rlike(r"\(([^()]+)\)"), inside)).otherwise(False)

    return let(sides, verdict)


# ---- pictures

def is_usable_region(r: Column) -> Column:
    """A box inside the page with both sides long enough."""
    sides = [r[n] for n in ("y_min", "x_min", "y_max", "x_max")]
    inside = reduce(lambda p, q: p & q, [(s >= 0) & (s <= X.REGION_SCALE) for s in sides])
    least = X.LEAST_REGION * X.REGION_SCALE
    return F.coalesce(inside & (r["x_max"] - r["x_min"] >= least) & (r["y_max"] - r["y_min"] >= least), F.lit(False))


def crop_box(r: Column, width: Column, height: Column, padding: float = X.PADDING) -> Column:
    """Pixels (left, top, right, bottom) of a padded box, clamped, never empty; halves round to even."""

    def at(v: Column, size: Column, sign: int) -> Column:
        return F.bround(v / X.REGION_SCALE * size + sign * padding * size).cast("int")

    left, top = (F.greatest(F.lit(0), at(r[n], s, -1)) for n, s in (("x_min", width), ("y_min", height)))
    right, bottom = (F.least(s.cast("int"), at(r[n], s, 1)) for n, s in (("x_max", width), ("y_max", height)))
    return F.struct(left.alias("left"), top.alias("top"), F.greatest(right, left + 1).alias("right"), F.greatest(bottom, top + 1).alias("bottom"))
