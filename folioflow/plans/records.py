"""Queries of the operators on records: hierarchies, orphan references, nested records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from folioflow.operators import hierarchy, nested, references
from folioflow.session import table


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    """Path, depth, root and state of every block and node that is linked."""
    return hierarchy.hierarchies(table(spark, sf, "blocks"), table(spark, sf, "hierarchy"))


def _with_paths(spark: SparkSession, sf: str) -> DataFrame:
    return hierarchy.hierarchies(table(spark, sf, "blocks"), table(spark, sf, "hierarchy"), keep_path=True)


def p1_small_fragments(spark: SparkSession, sf: str) -> DataFrame:
    """The rows of p1_found with every quotient solved over the cluster, however small it is."""
    return hierarchy.hierarchies(table(spark, sf, "blocks"), table(spark, sf, "hierarchy"), one_fragment_rows=0)


def p1_descendants(spark: SparkSession, sf: str) -> DataFrame:
    """All descendants of each block or node, with their distance."""
    return hierarchy.descendants(_with_paths(spark, sf))


def p1_descendant_counts(spark: SparkSession, sf: str) -> DataFrame:
    """How many descendants each block or node has, and how far down they go."""
    return hierarchy.descendant_counts(_with_paths(spark, sf))


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    """Every reference whose target is missing, deleted or late."""
    return references.orphan_references(*(table(spark, sf, t) for t in ("blocks", "hierarchy", "questions", "edges", "pages", "raw_blocks")))


def p4_orphan_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Orphan references per table, field, reason and month."""
    return references.orphan_counts(p4_found(spark, sf))


def p4_orphan_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Keys with orphan references, from a stored state and the changes of the last month."""
    return references.orphan_keys_from_changes(*(table(spark, sf, t) for t in ("blocks", "hierarchy", "questions", "edges", "pages", "raw_blocks")))


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    """Keys of the flat question and escalation tables."""
    return nested.links(nested.written(table(spark, sf, "canonical_documents")))


def p5_questions(spark: SparkSession, sf: str) -> DataFrame:
    """The flat question table with its payload columns."""
    return nested.flat_table(nested.written(table(spark, sf, "canonical_documents")), "question")


def p5_escalations(spark: SparkSession, sf: str) -> DataFrame:
    """The flat escalation table with its payload columns."""
    return nested.flat_table(nested.written(table(spark, sf, "canonical_documents")), "escalation")


QUERIES = {f.__name__: f for f in (p1_found, p1_small_fragments, p1_descendants, p1_descendant_counts, p4_found, p4_orphan_counts, p4_orphan_keys, p5_found, p5_questions, p5_escalations)}

_P1_FOUND = """
WITH RECURSIVE links AS (
  SELECT 'part_of' AS tree, document_id, block_id AS node, min(nullif(part_of_id, '')) AS named
  FROM blocks WHERE document_id IS NOT NULL AND block_id <> '' GROUP BY ALL
  UNION ALL
  SELECT 'hierarchy', h.document_id, h.node_id, min(c.node_id)
  FROM (SELECT DISTINCT document_id, node_id FROM hierarchy WHERE document_id IS NOT NULL AND node_id <> '') h
  LEFT JOIN (SELECT document_id, node_id, unnest(children) AS child FROM hierarchy WHERE node_id <> '') c
    ON c.document_id = h.document_id AND c.child = h.node_id GROUP BY ALL
), nodes AS (
  SELECT l.*, p.node AS parent FROM links l LEFT JOIN links p ON p.tree = l.tree AND p.document_id = l.document_id AND p.node = l.named
), listed AS (
  SELECT * FROM nodes n WHERE n.named IS NOT NULL OR (n.tree, n.document_id, n.node) IN (SELECT (tree, document_id, parent) FROM nodes WHERE parent IS NOT NULL)
), up AS (
  SELECT tree, document_id, node, node AS cur, parent, [node] AS ids, false AS looped, false AS home FROM listed
  UNION ALL
  SELECT u.tree, u.document_id, u.node, n.node, n.parent, list_prepend(n.node, u.ids), list_contains(u.ids, n.node), n.node = u.node
  FROM up u JOIN nodes n ON n.tree = u.tree AND n.document_id = u.document_id AND n.node = u.parent WHERE NOT u.looped
), ends AS (
  SELECT * FROM up WHERE parent IS NULL OR looped
)
SELECT tree, document_id, node AS node_id,
  CASE WHEN NOT looped THEN 'tree' WHEN home THEN 'cycle' ELSE 'below_cycle' END AS tree_state,
  CASE WHEN looped THEN '' ELSE cur END AS root_id,
  CAST(CASE WHEN looped THEN -1 ELSE len(ids) - 1 END AS INTEGER) AS depth,
  CASE WHEN looped THEN '' ELSE array_to_string(ids, '/') END AS id_path
FROM ends
"""

_P1_COUNTS = f"""
WITH f AS ({_P1_FOUND}), e AS (
  SELECT tree, document_id, depth, string_split(id_path, '/') AS ids, unnest(range(depth)) AS pos FROM f WHERE tree_state = 'tree' AND depth > 0
)
SELECT tree, document_id, ids[pos + 1] AS node_id, count(*) AS n_descendants, CAST(max(depth - pos) AS INTEGER) AS height FROM e GROUP BY ALL
"""

# written apart from the operator's pattern, from the wording of the tables: kind in any of its spellings, blanks or brackets, number
_NAMED = r"(fig(?:ure)?|tab(?:le)?|eq(?:n|uation)?)s?[ \t\n]*\.?[ \t\n]*[(\[]?[ \t\n]*[0-9]+[ \t\n]*\.[ \t\n]*[0-9]+"


def _label_sql(c: str) -> str:
    """The key of a text that is such a label and nothing else."""
    numbers = f"regexp_extract_all({c}, '[0-9]+')"
    return f"CASE left({c}, 1) WHEN 'f' THEN 'fig ' WHEN 't' THEN 'table ' WHEN 'e' THEN 'eq ' END || CAST({numbers}[1] AS HUGEINT) || '.' || CAST({numbers}[2] AS HUGEINT)"


def _id_sql(c: str) -> str:
    return rf"nullif(lower(regexp_replace({c}, '^\s+|\s+$', '', 'g')), '')"


_P4_TABLES = f"""WITH refs AS (
  SELECT 'edges' AS ref_table, 'src' AS ref_field, document_id, CAST(edge_id AS VARCHAR) AS ref_key, {_id_sql('src')} AS target_key, created_at AS ref_at FROM edges
  UNION ALL SELECT 'edges', 'dst', document_id, CAST(edge_id AS VARCHAR), {_id_sql('dst')}, created_at FROM edges
  UNION ALL SELECT 'questions', 'answer_block_ids', document_id, question_id, {_id_sql('x')}, associated_at FROM (SELECT *, unnest(answer_association.answer_block_ids) AS x FROM questions)
  UNION ALL SELECT 'raw_blocks', 'refs', document_id, CAST(raw_id AS VARCHAR), {_label_sql('x')}, extracted_at
    FROM (SELECT *, ltrim(unnest(regexp_extract_all(lower(r), '(?:^|[^a-z0-9_])' || '{_NAMED}')), ' ([,;:-/.' || chr(9) || chr(10)) AS x FROM (SELECT *, unnest(refs) AS r FROM raw_blocks))
), rows AS (
  SELECT document_id, {_id_sql('block_id')} AS target_key, ingested_at AS first_at, ingested_at, deleted_at IS NOT NULL AS deleted FROM blocks
  UNION ALL SELECT document_id, {_label_sql('x')}, NULL, ingested_at, deleted_at IS NOT NULL
    FROM (SELECT *, regexp_extract(ltrim(lower(caption), ' ([' || chr(9) || chr(10)), '^' || '{_NAMED}') AS x FROM blocks WHERE caption IS NOT NULL) WHERE x <> ''
  UNION ALL SELECT document_id, {_id_sql('node_id')}, NULL, NULL, false FROM hierarchy
  UNION ALL SELECT document_id, {_id_sql('question_id')}, NULL, NULL, false FROM questions
  UNION ALL SELECT document_id, 'page_' || page_index, NULL, NULL, false FROM pages
), known AS (
  SELECT document_id, target_key, min(first_at) AS first_at, arg_max(deleted, (coalesce(ingested_at, TIMESTAMPTZ '0001-01-01'), deleted)) AS deleted
  FROM rows WHERE target_key IS NOT NULL GROUP BY ALL
)"""

_P4_FOUND = f"""{_P4_TABLES}
SELECT DISTINCT ref_table, ref_field, r.document_id, ref_key, r.target_key,
  CASE WHEN k.target_key IS NULL THEN 'missing' WHEN k.deleted THEN 'deleted' ELSE 'late' END AS reason,
  coalesce(strftime(ref_at AT TIME ZONE 'UTC', '%Y-%m'), '') AS ref_month
FROM refs r LEFT JOIN known k ON k.document_id = r.document_id AND k.target_key = r.target_key
WHERE r.target_key IS NOT NULL AND r.document_id IS NOT NULL AND ref_key IS NOT NULL
  AND (k.target_key IS NULL OR k.deleted OR k.first_at > r.ref_at)
"""

_P4_COUNTS = f"""
WITH f AS ({_P4_FOUND})
SELECT ref_table, ref_field, reason, ref_month, count(*) AS n_references, count(DISTINCT (document_id, target_key)) AS n_targets FROM f GROUP BY ALL
"""

_P4_KEYS = f"""{_P4_TABLES}, named AS (
  SELECT document_id, target_key, count(*) AS n_references, min(ref_at) AS first_ref FROM refs WHERE target_key IS NOT NULL AND document_id IS NOT NULL AND ref_key IS NOT NULL GROUP BY ALL
)
SELECT document_id, target_key, n_references, CASE WHEN deleted IS NULL THEN 'missing' WHEN deleted THEN 'deleted' ELSE 'late' END AS reason
FROM named LEFT JOIN known USING (document_id, target_key) WHERE coalesce(deleted, true) OR first_at > first_ref
"""

_P1_DESCENDANTS = f"""
WITH f AS ({_P1_FOUND}), e AS (
  SELECT tree, document_id, node_id, depth, string_split(id_path, '/') AS ids, unnest(range(depth)) AS pos FROM f WHERE tree_state = 'tree' AND depth > 0
)
SELECT tree, document_id, ids[pos + 1] AS ancestor_id, node_id AS descendant_id, CAST(depth - pos AS INTEGER) AS distance FROM e
"""

ORACLE = {"p1_found": _P1_FOUND, "p1_small_fragments": _P1_FOUND, "p1_descendants": _P1_DESCENDANTS, "p1_descendant_counts": _P1_COUNTS, "p4_found": _P4_FOUND, "p4_orphan_counts": _P4_COUNTS, "p4_orphan_keys": _P4_KEYS}
