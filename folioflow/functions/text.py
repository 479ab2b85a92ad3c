"""Column functions on the text of blocks and questions.

Patterns are written so that they mean the same to java.util.regex and to RE2:
no look-around, and consuming groups instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What labels, markers and cue words look like.
ROMAN = "i{1,3}|iv|v|vi{1,3}|ix|x"
ENUMERATORS = (
    ("roman", rf"(?i)^\s*\(?\s*({ROMAN})\s*\)", 2),
    ("example", r"(?i)^\s*Example\s+(\d{1,3}(?:\.\d{1,3})?)", 0),
    ("numbered", r"^\s*(\d{1,3}\.\d{1,3})[\s.):]", 0),
    ("numbered", r"^\s*(\d{1,3})\.\s", 0),
    ("upper", r"^\s*\(\s*([A-Z])\s*\)", 1),
    ("num", r"^\s*\(\s*(\d+)\s*\)", 1),
    ("lower", r"(?i)^\s*\(\s*([a-hj-z])\s*\)", 2),
)
ENUMERATOR_START = rf"(?i)^\s*(?:(?:Example|Illustration|Activity|Exercise)\s+\d+|Q\s*\.?\s*\d+|\d{{1,3}}\.\d{{1,3}}[\s.):]|\d{{1,3}}\s*[.)]\s|\(\s*[A-Za-z]\s*\)|\(\s*(?:{ROMAN})\s*\))"
ANSWER_START = r"(?i)^\s*(?:Ans(?:wer)?\s*\.?|Sol(?:ution)?\s*\.?|Explanation\s*:?|Hint\s*:?)"
ANSWER_WORD = "(?:Ans(?:wer)?s?|Sol(?:ution)?s?|Explanation|Working|Hint)"
ANSWER_HEADING = rf"(?i)^\s*{ANSWER_WORD}\b\s*[:.]?\s*$"
ANSWER_OPENER = rf"(?i)^\s*{ANSWER_WORD}\b\s*[:.]?\s+\S"
ANSWER_RESET = r"(?i)^\s*(?:Example|Exercise|Question|Q\s*\.?\s*\d|Summary|Points? to ponder|(?:FIG(?:URE)?|TABLE|PLATE)\s*\.?\s*\d|\d{1,3}(?:\.\d{1,3})?\s+[A-Z])"
ANSWER_BOUNDARY = rf"(?im)^[ \t]*(?:{ANSWER_WORD}[ \t]*[:.]|{ANSWER_WORD}[ \t]*$|Sol(?:ution)?s?[ \t]+\S)"
INLINE_MARKER = r"(?i)(Ans\.|Answer\s*:|Solution\s*:|Explanation\s*:)"
SENTENCE_END = r"[.?!…]['\")\]”]?\s*$"
STATEMENT_END = r"[.?!:;]['\")\]]?\s*$"
DANGLING_END = r"(?i)(?:[,;:–—-]|\b(?:and|or|of|the|a|an|to|in|for|with|that|which|is|are|be)\b)\s*$"
CONNECTIVE_START = r"(?i)^\s*(?:and|or|but|so|then|which|that|because|where|when|while|hence|therefore|thus)\b"
QUESTION_SECTION = r"(?i)\b(exercise|question|problem|assessment|practice|activit|worksheet|quiz|test|revision|competency|case[\s-]based|assignment)"
PROSE_SECTION = r"(?i)\b(summary|points? to ponder|key ?(terms|words|points)|glossary|recap|conclusion|introduction|did you know|reference|bibliograph|learning objective|index|content)"
ASKING = r"(?i)\?|^\s*(?:\(?[a-z0-9]{1,4}[.)]\s*)?(what|why|how|when|where|which|who|whose|is|are|do|does|did|can|could|will|would|should|state|define|explain|describe|calculate|find|determine|derive|show|prove|compute|estimate|evaluate|list|name|identify|compare|distinguish|differentiate|discuss|obtain|draw|sketch|verify|justify|suggest|choose|select|fill|match|write)\b"
QUESTION_NUMBER = r"(?i)^\s*(?:Q\s*\.?\s*)?\(?\d{1,3}(?:\.\d{1,3})?\)?[.)]?\s+"
BARE_NUMBER = r"^\s*(?:Q\s*\.?\s*)?(?:\d{1,3}(?:\.\d{1,3})?|[A-Z])\s*[.):]?\s*$"
BLOOM = r"(?i)\((Remember|Understand|Apply|Analyse|Analyze|Evaluate|Create)\)"
MARKS_AFTER_BLOOM = r"(?i)\((?:Remember|Understand|Apply|Analyse|Analyze|Evaluate|Create)\)\s*(\d+)"
MARKS_BANNER = r"(?i)\[\s*(\d+)\s*marks?\s*\]"
TOPIC_HEADING = r"(?i)^\s*topic\s+\d+"
SELF_ASSESSMENT = r"(?i)self[\s-]*assessment"
BANNER_MARKS = (
    (r"(?i)very short answer|\bvsa\b", 1), (r"(?i)short answer.*(ii|2)|\bsa[\s-]*ii\b", 3), (r"(?i)short answer.*(i|1)|\bsa[\s-]*i\b", 2),
    (r"(?i)long answer|\bla\b", 5), (r"(?i)multiple choice", 1), (r"(?i)assertion", 1),
)
REFERENCE_LABEL = r"(?i)\b(\d+\.\d+)\b|\(\s*([a-zA-Z0-9]{1,3})\s*\)|\bno\.?\s*(\d+)"
DIRECTIONS = ("above", "below", "following", "previous", "next")
HINTS = (("fig", "figure"), ("diagram", "diagram"), ("table", "table"), ("graph", "graph"), ("equation", "equation"), ("formula", "equation"), ("image", "image"))
STOP_WORDS = ("the", "a", "an", "of", "to", "in", "is", "and", "or", "for", "on", "at", "by", "it", "as", "be", "are", "this", "that", "with", "which", "from")
SOURCE_TAG = r"^\s*[\[(][^\[\]()]{0,60}[\])]\s*$"
TYPE_CUES = {
    "assertion": r"(?i)assertion\s*\(?\s*a", "reason": r"(?i)reason\s*\(?\s*r", "blank": r"(?i)…{2,}|\.{4,}|_{3,}|\bfill in the blank",
    "true_false": r"(?i)true or false|state whether.*(true|false)", "matching": r"(?i)match the following|column\s*(i|a|1)\b",
    "distinguish": r"(?i)distinguish between|differentiate between|difference between|\bcompare\b",
    "ordering": r"(?i)\barrange\b|ascending order|descending order|increasing order|decreasing order|in order of",
    "numeric": r"(?i)\bcalculate\b|\bcompute\b|\bfind the\b|\bdetermine the\b|how (far|long|much|many)",
    "unit": r"(?i)\d+(\.\d+)?\s*(hz|khz|m/s|ms\W|metres?|meters?|\bm\b|\bs\b|cm|km|kg|db|°?c)",
    "descriptive": r"(?i)\bdefine\b|\bexplain\b|\bwhy\b|what is|what are|\bhow\b|\bdescribe\b|give reasons?|\bstate\b|\blist\b|\bwrite\b",
    "activity": r"(?i)^\s*activity\b|\btake\b .*\band\b .*\bobserve\b", "case": r"(?i)case[\s-]*based|read the (given )?extract|passage",
}
ASSET_TYPES = ("figure", "image", "diagram", "table", "equation")
HEADING_TYPES = ("chapter", "topic", "section", "subsection", "heading")
GENERIC_TYPES = ("paragraph", "list", "list_item", "other")
ANSWER_TYPES = ("answer", "solution", "explanation", "table", "equation")


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text_of(c: Column | str) -> Column:
    """The text, '' for null."""
    return F.coalesce(_c(c), F.lit(""))


def enumerator(c: Column | str) -> Column:
    """Struct(style, label, level) of the label that a text starts with; null fields without one."""
    t = text_of(c)
    style = label = level = None
    for name, pattern, lvl in reversed(ENUMERATORS):
        hit = t.rlike(pattern)
        found = F.regexp_extract(t, pattern, 1)
        found = F.lower(found) if name == "roman" else found
        style = F.when(hit, name) if style is None else F.when(hit, name).otherwise(style)
        label = F.when(hit, found) if label is None else F.when(hit, found).otherwise(label)
        level = F.when(hit, lvl) if level is None else F.when(hit, lvl).otherwise(level)
    return F.struct(style.alias("style"), label.alias("label"), level.cast("int").alias("level"))


def is_or_marker(c: Column | str) -> Column:
    """Whether a text is only the mark between alternatives."""
    return F.upper(F.trim(text_of(c))) == "OR"


def section_kind(c: Column | str) -> Column:
    """'question', 'prose' or 'unknown' from a heading; prose wins."""
    t = F.trim(text_of(c))
    return F.when(t == "", "unknown").when(t.rlike(PROSE_SECTION), "prose").when(t.rlike(QUESTION_SECTION), "question").otherwise("unknown")


def asks(c: Column | str) -> Column:
    """Whether a text asks or instructs, judged without its leading number."""
    t = F.regexp_replace(F.trim(text_of(c)), QUESTION_NUMBER, "")
    return (F.trim(text_of(c)) != "") & t.rlike(ASKING)


def tokens(c: Column | str) -> Column:
    """Lower-case alphanumeric tokens without stop words and single characters."""
    return F.filter(F.regexp_extract_all(F.lower(text_of(c)), F.lit("([a-z0-9]+)")), lambda x: (F.length(x) > 1) & ~x.isin(*STOP_WORDS))


def all_tokens(c: Column | str) -> Column:
    """Lower-case alphanumeric tokens."""
    return F.regexp_extract_all(F.lower(text_of(c)), F.lit("([a-z0-9]+)"))


def looks_mcq(c: Column | str) -> Column:
    """Whether a text has an option grid."""
    t = text_of(c)
    letters = F.regexp_count(t, F.lit(r"\(\s*[a-d]\s*\)"))
    romans = F.regexp_count(t, F.lit(rf"(?i)\(\s*(?:{ROMAN})\s*\)"))
    return (letters >= 3) | (romans >= 3) | (F.lower(t).contains("options:") & (letters >= 2))


def question_type(c: Column | str, has_subparts: Column, is_case: Column, has_equation: Column, marks: Column, is_activity: Column) -> Column:
    """Struct(kind, confidence): the first rule that holds decides."""
    t = text_of(c)
    cue = lambda name: t.rlike(TYPE_CUES[name])
    numeric = has_equation | cue("numeric") | (cue("unit") & t.contains("?"))
    rules = [
        (is_case | (has_subparts & cue("case")), "case_study", 0.9), (cue("assertion") & cue("reason"), "assertion_reason", 0.95), (looks_mcq(t), "mcq", 0.9),
        (cue("blank"), "fill_blank", 0.9), (cue("true_false"), "true_false", 0.9), (cue("matching"), "matching", 0.9), (cue("distinguish"), "distinguish", 0.9),
        (cue("ordering"), "ordering", 0.85), (numeric, "numerical", 0.85), (is_activity | cue("activity"), "activity", 0.8),
        (cue("descriptive") & F.coalesce(marks >= 3, F.lit(False)), "long_answer", 0.7), (cue("descriptive") & F.coalesce(marks <= 2, F.lit(False)), "short_answer", 0.7),
        (cue("descriptive"), "conceptual", 0.6), (t.contains("?"), "conceptual", 0.4),
    ]
    out = F.struct(F.lit("unknown").alias("kind"), F.lit(0.0).alias("confidence"))
    for rule, kind, confidence in reversed(rules):
        out = F.when(F.coalesce(rule, F.lit(False)), F.struct(F.lit(kind).alias("kind"), F.lit(confidence).alias("confidence"))).otherwise(out)
    return out


def answer_boundary(c: Column | str) -> Column:
    """0-based offset where the answer begins, -1 without one."""
    t = text_of(c)
    head = F.split_part(F.regexp_replace(F.translate(t, "\x01", ""), ANSWER_BOUNDARY, "\x01$0"), F.lit("\x01"), F.lit(1))
    return F.when(t.rlike(ANSWER_BOUNDARY), F.length(head)).otherwise(F.lit(-1)).cast("int")


def marker_segments(c: Column | str, pattern: str) -> Column:
    """Array of struct(start, end, text): the text cut before every match of a pattern.

    The first segment starts at 0 and may be empty.
    """
    pieces = F.split(F.regexp_replace(F.translate(text_of(c), "\x01", ""), pattern, "\x01$0"), "\x01")
    step = lambda acc, x: F.struct(
        (acc["at"] + F.length(x)).alias("at"),
        F.concat(acc["out"], F.array(F.struct(acc["at"].alias("start"), (acc["at"] + F.length(x)).alias("end"), x.alias("text")))).alias("out"),
    )
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,text:string>>").alias("out"))
    return F.aggregate(pieces, zero, step, lambda acc: acc["out"])


def reference_parts(c: Column | str) -> Column:
    """Struct(direction, hint, label) of a phrase that refers to a figure, table or equation."""
    low = F.lower(text_of(c))
    direction = F.lit(None).cast("string")
    for word in reversed(DIRECTIONS):
        direction = F.when(low.contains(word), word).otherwise(direction)
    hint = F.lit(None).cast("string")
    for word, kind in reversed(HINTS):
        hint = F.when(low.contains(word), kind).otherwise(hint)
    label = F.coalesce(*(F.nullif(F.lower(F.regexp_extract(text_of(c), REFERENCE_LABEL, i)), F.lit("")) for i in (1, 2, 3)))
    return F.struct(direction.alias("direction"), hint.alias("hint"), label.alias("label"))


def script_marks(c: Column | str) -> Column:
    """Text with runs of superscript and subscript digits marked."""
    t = F.regexp_replace(text_of(c), "([⁰¹²³⁴⁵⁶⁷⁸⁹⁺⁻]+)", "<super>$1</super>")
    t = F.regexp_replace(t, "([₀₁₂₃₄₅₆₇₈₉₊₋]+)", "<sub>$1</sub>")
    return F.translate(t, "⁰¹²³⁴⁵⁶⁷⁸⁹⁺⁻₀₁₂₃₄₅₆₇₈₉₊₋", "0123456789+-0123456789+-")


def escaped(c: Column | str) -> Column:
    """Text safe inside markup."""
    return F.replace(F.replace(F.replace(text_of(c), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def short_hash(c: Column | str) -> Column:
    """First 24 hex digits of the SHA-256 of a text."""
    return F.substring(F.sha2(text_of(c), 256), 1, 24)
