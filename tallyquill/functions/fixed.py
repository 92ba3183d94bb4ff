"""Values that results depend on: patterns, word lists, tables and limits of the question-bank domain.

Fixed values, in natural order. Patterns are Java's (``(?U)`` for Unicode classes, ``(?iu)`` for
case-insensitive matching of any script).
"""

# ---- identity
KEY_LENGTH = 12
PART_OF = r"(?Us)^(.+?)\s*\([^()]*\)\s*$"
STRATEGY_NAME_DROPS = r"[^a-z0-9\u4e00-\u9fff ]+"

# ---- form, module, year, term, kind and number of a paper
LEVEL_MENTION = (
    r"(?iU)(?<![A-Za-z0-9])(?:form|secondary|sec)\.?\s?[1-6](?![0-9])"
    r"|(?<![A-Za-z0-9])[SF]\.?\s?[1-6](?![0-9])"
    r"|(?<![其當集])中[一二三四五六](?:年級|級)?"
    r"|(?<![A-Za-z0-9])grade\s?(?:7|8|9|1[0-2])(?![0-9])"
)
CHINESE_DIGITS = {"一": 1, "二": 2, "三": 3, "四": 4, "五": 5, "六": 6}
MODULE_MENTION = (
    r"(?iU)MATHS?[-_\s]?M[.\s]?[12](?![0-9])"
    r"|(?<![A-Za-z0-9])[SF][1-6][-_\s]?M[.\s]?[12](?![0-9])"
    r"|(?<![A-Za-z0-9])M[.\s]?[12](?![0-9])"
    r"|(?<![A-Za-z])module[-_\s]?[12](?![0-9])"
    r"|單元\s?[一二12]"
    r"|calculus\s+and\s+statistics|微積分\s*(?:與|及|和)\s*統計"
    r"|algebra\s+and\s+calculus|代數\s*(?:與|及|和)\s*微積分"
)
EXTENDED_PART = r"(?iU)extended\s+part|延伸部分"
YEAR_FULL = r"(?<!\d)(20\d\d)(?:[-_/](\d\d))?(?!\d)"
YEAR_COMPACT = r"(?<!\d)(\d\d)(\d\d)(?!\d)"
TERMS = (
    (r"(?i)(?<![a-z])(1st|first)(?![a-z])", "1st"),
    (r"(?i)(?<![a-z])(2nd|second)(?![a-z])", "2nd"),
    (r"(?i)(?<![a-z])mid(?:[-_ ]?term|[-_ ]?year)?(?![a-z])", "mid"),
    (r"(?i)(?<![a-z])final(?![a-z])", "final"),
    (r"上學期|上期", "1st"),
    (r"下學期|下期", "2nd"),
)
EXAM_TYPES = (
    (r"(?i)(?<![a-z])mock(?![a-z])|模擬", "mock"),
    (r"(?i)(?<![a-z])dse(?![a-z])", "dse"),
    (r"(?i)(?<![a-z])(exam|examination)(?![a-z])|考試", "exam"),
    (r"(?i)(?<![a-z])(test|ut|uniform)(?![a-z])|測驗|統測", "test"),
    (r"(?i)(?<![a-z])quiz(?![a-z])|小測", "quiz"),
    (r"(?i)(?<![a-z])(hw|homework|assignment|worksheet)(?![a-z])|功課|工作紙", "homework"),
)
PAPER_NUMBER = r"(?i)(?<![a-z])(?:paper|maths?)[-_ ]?([1-4])(?![0-9])"
SCHEME_NAME = r"(?i)^(.+?)[-_ ](?:ms|marking[-_ ]?scheme|marking|answers?|ans|solutions?|sol|key|answer[-_ ]?key)$"
SIDECAR_FIELDS = ("year", "term", "exam_type", "paper_number", "school", "topics", "level", "module")
SIDECAR_ALIASES = {"exam": "exam_type", "type": "exam_type", "paper": "paper_number", "form": "level", "subject": "topics", "topic": "topics", "part": "module", "extended": "module"}
UNSAFE_IN_NAME = r"[\\/:*?\"<>|()\[\]{}#%&^$!`'~;,+=@\x00-\x1f]"
MOST_STEM = 80

# ---- text faults
DIMENSION_TOKEN = r"(?U)\b\d[xX]\d\b"
LABEL_TOKEN = r"(?U)\b[A-Z]\d+\b"
BROKEN_POWER = r"[a-zA-Z]\d+"
TABLE_SEPARATOR = r"^\s*\|?(\s*:?-{2,}:?\s*\|)+\s*:?-{2,}:?\s*\|?\s*$|^\s*\|(\s*:?-{2,}:?\s*\|)+\s*$"
LINE_ENDS = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"
SENTENCE_ENDS = "。？！"
OPTION_LINE = r"(?mU)^\s*\(?([A-D])[.)、．]\s"
LEAST_OPTIONS = 3
MATH_SPAN = r"(?s)\\\(.*?\\\)|\$\$.*?\$\$|\$[^$\n]+\$"
LOOSE_COMMAND = r"\\[a-zA-Z]{2,}"
LOOSE_SCRIPT = r"[\^_]\{[^}\n]{1,30}\}"
CJK = r"[\u3000-\u9fff\uff00-\uffef]"
DASHES = {"-": "U+002D hyphen", "\u2013": "U+2013 en dash", "\u2212": "U+2212 minus"}
LEAST_DASHES = 3
LEAST_SENTENCE = 8
LEAST_PAGES_FOR_DENSITY, LEAST_PER_PAGE = 5, 0.5
EATEN = {"\x0c": "f", "\x08": "b"}
REFERENCE = (
    r"(?U)(?:利用|根據|使用|承|參考|按|由|[Uu]sing|[Ff]rom|[Bb]y|[Ii]n|results?\s+of|[Pp]arts?)"
    r"\s*(?:the\s+)?(?:results?\s+(?:of|in)\s+)?(?:parts?\s+)?\(([a-z]{1,2}|[ivx]{1,4})\)"
)
HENCE = r"(?<![A-Za-z])Hence(?![A-Za-z])|由此"
METHOD_CUES = (
    r"利用[^，。]{0,12}(公式|定理|配方法|因式分解|代入|圖像|對數)",
    r"用[^，。]{0,6}(配方法|二次公式|因式分解法|圖解法)",
    r"以[^，。]{0,6}(配方法|二次公式|因式分解法|圖解法)",
    r"\b(use|using|by|apply|applying)\s+(the\s+)?(quadratic formula|completing the square|"
    r"factori[sz]ation|factor theorem|remainder theorem|sine rule|cosine rule|"
    r"difference of two squares|a graphical method|substitution|elimination)",
    r"\bhence\b",
    r"由此",
    r"利用\s*\([a-z]+\)",
)

# ---- answers
MC_LETTER = r"(?U)^\(?([A-Da-d])\)?(?:[\s.:)]|$)"
LEADING_VARIABLE = r"(?U)^[a-zA-Z]\s*=\s*"
NUMBER = r"^[-+]?\d+(?:\.\d+)?$"
FRACTION = r"(?U)^\(?([-+]?\d+)\)?\s*/\s*\(?(\d+)\)?$"
UNITS = r"(平方單位|立方單位|單位|分|cm[²³23]?|m[²³23]?|km|度|°)+$"

# ---- analyses
DIMENSIONS = ("R", "P", "D", "I", "C", "E")
MOST_LEVEL, DRIVER_FROM, MOST_D_WITH_CUE = 3, 2, 1
STRATEGY_SOURCES = ("analyzer", "student", "teacher")
STRATEGY_STATUSES = ("proposed", "confirmed", "rejected", "unverified")
CRITIC_CODES = (
    "STRATEGY_DOES_NOT_SOLVE", "STRATEGY_STEPS_WRONG", "STRATEGY_MISSING", "PRIMARY_NOT_TYPICAL", "LEVEL_OVERRATED", "LEVEL_UNDERRATED",
    "EVIDENCE_NOT_IN_QUESTION", "SKILL_MISSING", "SKILL_IRRELEVANT", "ERROR_NOT_TRIGGERED", "ERROR_MISSING", "ANSWER_MISMATCH",
)
SEVERITIES = ("critical", "high", "medium", "low")
CRITIC_SEVERITIES = ("low", "medium", "high")
SOLVER_BATCH, CRITIC_BATCH = 8, 10
LOW_CONFIDENCE = 0.6

# ---- vocabularies
STRANDS = {"na": "Number and Algebra", "ms": "Measures, Shape and Space", "dh": "Data Handling", "fl": "Further Learning Unit", "m1": "Module 1 (Calculus and Statistics)", "m2": "Module 2 (Algebra and Calculus)"}
COMPULSORY_STRANDS = ("na", "ms", "dh", "fl")
MODULE_STRANDS = {"m1": "M1", "m2": "M2"}
FORMS = ("F1", "F2", "F3", "F4", "F5", "F6")
FLAGS = {"F": "foundation", "N": "non-foundation", "E": "enrichment"}
GUIDE_REF = r"^(KS3|CP|M1|M2)-\d+(\.\d+)?$"
SKILL_ID = r"^(na|ms|dh|fl|m1|m2)\.[a-z0-9-]+\.[a-z0-9-]+$"
ERROR_ID = r"^err\.[a-z0-9-]+\.[a-z0-9-]+$"
WILDCARD = r"^(\*|(na|ms|dh|fl|m1|m2)\.\*)$"

# ---- pictures
REGION_SCALE, LEAST_REGION, PADDING, DPI = 1000, 0.02, 0.02, 200

# ---- comparing runs
COMPARED_FIELDS = ("question_text", "marks", "group_marks", "group_marks_scope", "page_start", "page_end", "answer", "worked_solution", "diagram_required")
CONTEXT_CHARS = 10
