"""Pieces of SQL that several twins of queries share."""

from __future__ import annotations

from folioflow.functions import text as T


def lit(s: str) -> str:
    """A string as an SQL literal."""
    return "'" + s.replace("'", "''") + "'"


def corner(i: int) -> str:
    f, a, b = ("least", i + 1, i + 3) if i < 2 else ("greatest", i - 1, i + 1)
    return f"CASE WHEN len(bbox) = 4 AND len(list_filter(bbox, lambda x: x IS NOT NULL)) = 4 THEN {f}(bbox[{a}], bbox[{b}]) END"


BLOCKS = f"""b AS (
  SELECT document_id, block_id, coalesce(lower(block_type), 'other') AS block_type, text, latex, caption, heading_level, page_index, col_ix, reading_order,
    nullif(section_id, '') AS section_id, nullif(part_of_id, '') AS part_of_id, nullif(continuation_of, '') AS continuation_of, nullif(continues_to, '') AS continues_to,
    group_role, enumerator, or_group_id, inline_answer, tags, extraction_confidence, {corner(0)} AS x0, {corner(1)} AS y0, {corner(2)} AS x1, {corner(3)} AS y1
  FROM (SELECT *, row_number() OVER (PARTITION BY document_id, block_id ORDER BY ingested_at DESC NULLS LAST, deleted_at IS NOT NULL DESC) AS rn
        FROM blocks WHERE document_id IS NOT NULL AND block_id <> '')
  WHERE rn = 1 AND deleted_at IS NULL
)"""

QUESTIONS = """q AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY document_id, question_id) AS rn FROM questions WHERE document_id IS NOT NULL AND question_id IS NOT NULL) WHERE rn = 1
)"""

ROMAN_RANK = "list_position(['i','ii','iii','iv','v','vi','vii','viii','ix','x'], {0})"


def in_list(values) -> str:
    return "(" + ", ".join(lit(v) for v in values) + ")"


def rlike(c: str, pattern: str) -> str:
    """Whether a pattern is found in a column."""
    return f"regexp_matches({c}, {lit(pattern)})"


def trim(c: str) -> str:
    return f"trim({c}, ' ')"


def enumerator(c: str) -> tuple[str, str, str]:
    """Style, label and level of the label that a text starts with."""
    style = "CASE " + " ".join(f"WHEN {rlike(c, p)} THEN {lit(n)}" for n, p, _ in T.ENUMERATORS) + " END"
    label = "CASE " + " ".join(f"WHEN {rlike(c, p)} THEN " + (f"lower(regexp_extract({c}, {lit(p)}, 1))" if n == "roman" else f"regexp_extract({c}, {lit(p)}, 1)") for n, p, _ in T.ENUMERATORS) + " END"
    level = "CASE " + " ".join(f"WHEN {rlike(c, p)} THEN {v}" for _, p, v in T.ENUMERATORS) + " END"
    return style, label, level


ASSETS, HEADINGS, GENERIC, ANSWERS = (in_list(x) for x in (T.ASSET_TYPES, T.HEADING_TYPES, T.GENERIC_TYPES, T.ANSWER_TYPES))
LEVEL = f"""CASE WHEN upper({trim("coalesce(text, '')")}) IN ('OR', 'OR:') THEN NULL
  WHEN block_type IN {HEADINGS} OR heading_level IS NOT NULL THEN coalesce(CASE block_type WHEN 'chapter' THEN 0 WHEN 'topic' THEN 1 WHEN 'section' THEN 2 WHEN 'subsection' THEN 3 END, heading_level, CASE WHEN block_type = 'heading' THEN 2 END) END"""
