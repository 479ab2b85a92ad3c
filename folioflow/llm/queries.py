"""Queries of the operators for training text, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from folioflow.llm import components, leakage, packing, scan_repair, stuffing
from folioflow.session import table


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    """Every damage of scanned text and formulas, with its repair."""
    return scan_repair.damages(*(table(spark, sf, t) for t in ("raw_blocks", "blocks", "pages")))


def p2_clean_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Scanned blocks as continuous paragraphs and formulas."""
    return scan_repair.clean_texts(*(table(spark, sf, t) for t in ("raw_blocks", "blocks", "pages")))


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    """One group id for all fragments that are linked directly or indirectly."""
    return components.block_groups(table(spark, sf, "blocks"))


def p6_packed(spark: SparkSession, sf: str) -> DataFrame:
    """Every text in a container of each budget; texts above the capacity in pieces."""
    return packing.packed(table(spark, sf, "documents"), table(spark, sf, "pack_budgets"))


def p6_unused_room(spark: SparkSession, sf: str) -> DataFrame:
    """Containers and unused share of the packing, per budget."""
    return packing.fill_report(p6_packed(spark, sf), table(spark, sf, "pack_budgets"))


def p6_vector_packed(spark: SparkSession, sf: str) -> DataFrame:
    """The packing with capacities for documents and attention that bind."""
    return packing.packed(table(spark, sf, "documents"), table(spark, sf, "pack_budgets"), max_docs=24, attention_share=0.5)


def p6_validity(spark: SparkSession, sf: str) -> DataFrame:
    """What is wrong with the packing, per budget: nothing, for all texts."""
    return packing.validity(p6_packed(spark, sf), table(spark, sf, "pack_budgets"))


def p6_vector_validity(spark: SparkSession, sf: str) -> DataFrame:
    """What is wrong with the packing under three capacities, per budget: nothing, for all texts."""
    return packing.validity(p6_vector_packed(spark, sf), table(spark, sf, "pack_budgets"), max_docs=24, attention_share=0.5)


def p7_found(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with the evaluation items that they leak."""
    return leakage.leaks(table(spark, sf, "documents"), table(spark, sf, "eval_items"))


def p8_found(spark: SparkSession, sf: str) -> DataFrame:
    """Documents that are mostly repeated keywords, links or product tags."""
    return stuffing.stuffed_pages(table(spark, sf, "documents"))


QUERIES = {f.__name__: f for f in (p2_found, p2_clean_texts, p3_found, p6_packed, p6_unused_room, p6_validity, p6_vector_packed, p6_vector_validity, p7_found, p8_found)}

_P3_FOUND = """
WITH RECURSIVE rows AS (
  SELECT DISTINCT document_id, block_id, continuation_of, continues_to, logical_item_id FROM blocks WHERE document_id IS NOT NULL AND block_id <> ''
), ids AS (SELECT DISTINCT document_id, block_id FROM rows
), shared AS (
  SELECT document_id, block_id, min(block_id) OVER (PARTITION BY document_id, logical_item_id) AS other
  FROM rows WHERE logical_item_id NOT IN ('', 'none', 'item_00000000')
), named AS (
  SELECT document_id, block_id, continuation_of AS other FROM rows
  UNION SELECT document_id, block_id, continues_to FROM rows
  UNION SELECT document_id, block_id, other FROM shared
), links AS (
  SELECT n.document_id, n.block_id AS a, n.other AS b FROM named n JOIN ids i ON i.document_id = n.document_id AND i.block_id = n.other WHERE n.block_id <> n.other
), both_ways AS (
  SELECT document_id, a, b FROM links UNION SELECT document_id, b, a FROM links
), reach AS (
  SELECT DISTINCT document_id, a AS block_id, a AS seen FROM both_ways
  UNION
  SELECT r.document_id, r.block_id, l.b FROM reach r JOIN both_ways l ON l.document_id = r.document_id AND l.a = r.seen
)
SELECT document_id, block_id, min(seen) AS group_id FROM reach GROUP BY ALL
"""

_P6_VALID = """
SELECT b.budget_id, (SELECT count(DISTINCT doc_id) FROM documents WHERE text IS NOT NULL) AS n_texts, 0 AS n_twice, 0 AS n_badly_cut, 0 AS n_over_tokens, 0 AS n_over_docs, 0 AS n_over_attention
FROM (SELECT DISTINCT budget_id FROM pack_budgets WHERE budget_id IS NOT NULL AND capacity_tokens > 0) b
"""

ORACLE = {"p6_validity": _P6_VALID, "p6_vector_validity": _P6_VALID, "p3_found": _P3_FOUND}
