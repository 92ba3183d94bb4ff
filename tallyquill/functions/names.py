"""What names and cover lines say: keys, parts, forms, modules, years, terms, safe stems."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyquill.functions import fixed as X


def stripped(c: Column) -> Column:
    """Without white space of any script at both ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def collapsed(c: Column) -> Column:
    """Stripped, inner white space as one blank."""
    return stripped(F.regexp_replace(c, r"(?U)\s+", " "))


def said(c: Column) -> Column:
    """True where the text is there and not empty; null and '' both count as missing."""
    return F.coalesce(c, F.lit("")) != ""


def matched(c: Column, pattern: str, group: int = 1) -> Column:
    """The group of the first match, null where there is none."""
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, group))


def first_of(c: Column, rules) -> Column:
    """Value of the first rule whose pattern is found."""
    out = F.lit(None).cast("string")
    for pattern, value in reversed(rules):
        out = F.when(c.rlike(pattern), F.lit(value)).otherwise(out)
    return out


# ---- identity

def paper_key(sha256: Column) -> Column:
    """First 12 hex digits; an error where there are fewer."""
    return F.when(F.length(sha256) >= X.KEY_LENGTH, F.lower(F.substring(sha256, 1, X.KEY_LENGTH))).otherwise(F.raise_error(F.lit("sha256 too short for a paper key")))


def question_key(sha256: Column, qid: Column) -> Column:
    """<paper>:<id>, null where the id is blank."""
    return F.when(said(stripped(qid)), F.concat_ws(":", paper_key(sha256), stripped(qid)))


def split_key(key: Column) -> Column:
    """(paper, question) of a key, null where it is none."""
    at = F.instr(key, ":")
    good = (at == X.KEY_LENGTH + 1) & (F.length(key) > X.KEY_LENGTH + 1)
    return F.when(good, F.struct(F.substring(key, 1, X.KEY_LENGTH).alias("paper"), F.substring(key, F.lit(X.KEY_LENGTH + 2), F.length(key)).alias("question")))


def parent_of(qid: Column) -> Column:
    """The question a part belongs to: '18(a)(ii)' -> '18(a)' -> '18' -> null."""
    return F.when(stripped(qid).rlike(X.PART_OF), stripped(F.regexp_extract(stripped(qid), X.PART_OF, 1)))


def root_of(qid: Column) -> Column:
    return stripped(F.substring_index(qid, "(", 1))


def strategy_id(name: Column, skills: Column) -> Column:
    """Hash of the method's words and its set of skills: stable under spelling, spacing and order."""
    words = collapsed(F.regexp_replace(F.lower(name), X.STRATEGY_NAME_DROPS, " "))
    return F.substring(F.sha2(F.concat(words, F.lit("|"), F.array_join(F.array_sort(F.array_distinct(skills)), ";")), 256), 1, X.KEY_LENGTH)


# ---- forms and modules

def find_levels(text: Column) -> Column:
    """Every form named, in printed order, each once; grades 7 to 12 are forms 1 to 6."""
    digits = F.create_map(*(F.lit(x) for pair in X.CHINESE_DIGITS.items() for x in pair))

    def code(m: Column) -> Column:
        number = F.regexp_extract(m, r"([0-9]+)$", 1)
        chinese = digits[F.regexp_extract(m, "([一二三四五六])", 1)]
        n = F.when(number == "", chinese).otherwise(F.when(F.lower(m).startswith("grade"), F.try_to_number(number, F.lit("99")) - 6).otherwise(F.try_to_number(number, F.lit("99"))).cast("int"))
        return F.concat(F.lit("F"), n.cast("string"))

    return F.array_distinct(F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(X.LEVEL_MENTION), F.lit(0)), code))


def _only(found: Column) -> Column:
    return F.when(F.size(found) == 1, found[0])


def parse_level(text: Column) -> Column:
    """The form a text names, null if it names none or several."""
    return _only(find_levels(text))


def resolve_level(file_name: Column, level_text: Column) -> Column:
    """(level, source): the file name's, else the paper's."""
    name, paper = parse_level(file_name), parse_level(level_text)
    return F.struct(F.coalesce(name, paper).alias("level"), F.when(name.isNotNull(), "filename").when(paper.isNotNull(), "paper").alias("source"))


def find_modules(text: Column) -> Column:
    """Every module named, in printed order, each once."""

    def code(m: Column) -> Column:
        named = F.when(F.lower(m).rlike("^calculus|^微積分"), "M1").when(F.lower(m).rlike("^algebra|^代數"), "M2")
        digit = F.regexp_extract(m, "([一二12])$", 1)
        return F.coalesce(named, F.concat(F.lit("M"), F.translate(digit, "一二", "12")))

    return F.array_distinct(F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(X.MODULE_MENTION), F.lit(0)), code))


def parse_module(text: Column) -> Column:
    return _only(find_modules(text))


def mentions_extended_part(text: Column) -> Column:
    return F.coalesce(text, F.lit("")).rlike(X.EXTENDED_PART)


def resolve_module(file_name: Column, module_text: Column, stated: Column) -> Column:
    """(module, source): stated in the sidecar, else the file name's, else the paper's, else compulsory."""
    name, paper = parse_module(file_name), parse_module(module_text)
    value = F.when(said(stated), stated).otherwise(F.coalesce(name, paper, F.lit("compulsory")))
    source = F.when(said(stated), "sidecar").when(name.isNotNull(), "filename").when(paper.isNotNull(), "paper").otherwise("default")
    return F.struct(value.alias("module"), source.alias("source"))


# ---- papers

def stem(name: Column) -> Column:
    """The last path part without its last suffix; a leading dot starts no suffix."""
    last = F.element_at(F.split(F.regexp_replace(name, "/+$", ""), "/"), -1)
    return F.regexp_replace(last, r"(?<=.)\.[^.]+$", "")


def year_of(text: Column) -> Column:
    """'2025', '2025-26' where the second part is the next year, or a compact '2526' as '2025-26'."""
    start, end = matched(text, X.YEAR_FULL, 1), F.regexp_extract(text, X.YEAR_FULL, 2)
    follows = (end != "") & (F.try_to_number(end, F.lit("99")) == (F.try_to_number(start, F.lit("9999")) + 1) % 100)
    full = F.when(follows, F.concat_ws("-", start, end)).otherwise(start)
    a, b = (F.try_to_number(matched(text, X.YEAR_COMPACT, g), F.lit("99")) for g in (1, 2))
    compact = F.when((a >= 15) & (a <= 60) & (b == a + 1), F.concat(F.lit("20"), matched(text, X.YEAR_COMPACT, 1), F.lit("-"), matched(text, X.YEAR_COMPACT, 2)))
    return F.coalesce(full, compact)


def meta_of_name(file_name: Column) -> Column:
    """(year, term, exam_type, paper_number) that a file's name encodes."""
    s = stem(file_name)
    return F.struct(year_of(s).alias("year"), first_of(s, X.TERMS).alias("term"), first_of(s, X.EXAM_TYPES).alias("exam_type"), matched(s, X.PAPER_NUMBER).cast("int").alias("paper_number"))


def scheme_stem(file_name: Column) -> Column:
    """Stem of the paper that a marking scheme's file name names, null for other files."""
    return matched(stem(file_name), X.SCHEME_NAME, 1)


def safe_stem(name: Column) -> Column:
    """A stem fit for a folder name and a Markdown link; letters of any script stay."""

    def trimmed(c: Column) -> Column:
        return F.regexp_replace(c, r"^[-. ]+|[-. ]+$", "")

    s = F.regexp_replace(stem(name), r"(?U)\s+", "-")
    s = trimmed(F.regexp_replace(F.regexp_replace(s, X.UNSAFE_IN_NAME, ""), "-{2,}", "-"))
    s = trimmed(F.substring(s, 1, X.MOST_STEM))
    return F.when(s == "", "document").otherwise(s)


def safe_asset_name(qid: Column) -> Column:
    s = F.regexp_replace(F.regexp_replace(qid, "[^0-9A-Za-z]+", "-"), "^-+|-+$", "")
    return F.when(s == "", "question").otherwise(s)


def normal_id(qid: Column) -> Column:
    """How schemes and papers agree on a question id: no white space, lower case."""
    return F.lower(F.regexp_replace(qid, r"(?U)\s+", ""))


# ---- sidecars

def parse_sidecar(text: Column) -> Column:
    """Map of the 'key: value' lines: comments off, aliases resolved, unknown keys out, the last line of a
    key wins. A paper number is its first digits; a number without digits leaves an earlier one standing."""
    aliases = F.create_map(*(F.lit(x) for pair in X.SIDECAR_ALIASES.items() for x in pair))
    fields = F.array(*map(F.lit, X.SIDECAR_FIELDS))

    def last(pairs: Column) -> Column:
        """The last pair of each field that has one."""
        return F.array_compact(F.transform(fields, lambda f: F.try_element_at(F.filter(pairs, lambda p: p["key"] == f), F.lit(-1))))

    def pair(line: Column) -> Column:
        line = stripped(F.substring_index(line, "#", 1))
        at = F.instr(line, ":")
        key = F.translate(F.lower(stripped(F.substring(line, F.lit(1), at - 1))), "- ", "__")
        value = stripped(F.substring(line, at + 1, F.length(line)))
        key = F.coalesce(F.try_element_at(aliases, key), key)
        value = F.when(key == "paper_number", F.regexp_extract(value, r"(\d+)", 1)).otherwise(value)
        return F.when((at > 0) & F.array_contains(fields, key) & (value != ""), F.struct(key.alias("key"), value.alias("value")))

    pairs = F.filter(F.transform(F.split(text, X.LINE_ENDS), pair), lambda p: p.isNotNull())
    return F.map_from_entries(F.get(F.transform(F.array(pairs), last), F.lit(0)))


def sidecar_module(sidecar: Column) -> Column:
    """The module a sidecar states: a named one, or the word compulsory."""
    said_so = F.try_element_at(sidecar, F.lit("module"))
    return F.coalesce(parse_module(said_so), F.when(F.lower(said_so) == "compulsory", said_so))


def resolve_meta(file_name: Column, sidecar: Column) -> Column:
    """A paper's meta: what the sidecar states, the rest from the file name; source says which was first."""
    meta = meta_of_name(file_name)

    def stated(field: str) -> Column:
        return F.try_element_at(sidecar, F.lit(field))

    there = F.coalesce(F.size(sidecar) > 0, F.lit(False))
    return F.struct(
        *(F.coalesce(stated(c), meta[c]).alias(c) for c in ("year", "term", "exam_type")),
        F.coalesce(stated("paper_number").cast("int"), meta["paper_number"]).alias("paper_number"),
        stated("school").alias("school"),
        topics_of(sidecar).alias("topics"),
        F.when(there, "sidecar").otherwise("filename").alias("source"),
    )


# ---- labels

def marks_label(marks: Column) -> Column:
    """'1 mark', '2 marks', '2.5 marks'."""
    number = F.when(marks == F.floor(marks), marks.cast("long").cast("string")).otherwise(marks.cast("string"))
    return F.concat(number, F.when(marks == 1, " mark").otherwise(" marks"))


def pages_label(start: Column, end: Column) -> Column:
    return F.when(start == end, F.format_string("page %d", start)).otherwise(F.format_string("pages %d–%d", start, end))


def paper_label(paper: Column) -> Column:
    """'2025-26, 1st term, exam, paper 1, School · topics (from source)', 'unknown' where nothing is known."""
    bits = F.filter(F.array(paper["year"], F.concat(paper["term"], F.lit(" term")), paper["exam_type"], F.format_string("paper %d", paper["paper_number"]), paper["school"]), lambda b: F.coalesce(b, F.lit("")) != "")
    bits = F.filter(bits, lambda b: b != "paper null")
    topics = F.when(F.size(paper["topics"]) > 0, F.concat(F.lit(" · "), F.array_join(paper["topics"], ", "))).otherwise("")
    origin = F.when(said(paper["source"]) & (F.size(bits) > 0), F.concat(F.lit(" (from "), paper["source"], F.lit(")"))).otherwise("")
    return F.when(paper.isNull(), "unknown").otherwise(F.concat(F.when(F.size(bits) > 0, F.array_join(bits, ", ")).otherwise("unknown"), topics, origin))


def module_label(module: Column) -> Column:
    return F.when(module == "M1", "Extended Part Module 1 (Calculus and Statistics)").when(module == "M2", "Extended Part Module 2 (Algebra and Calculus)").otherwise("Compulsory Part")


def topics_of(sidecar: Column) -> Column:
    parts = F.transform(F.split(F.coalesce(F.try_element_at(sidecar, F.lit("topics")), F.lit("")), "[,;、，]"), stripped)
    return F.filter(parts, lambda t: t != "")
