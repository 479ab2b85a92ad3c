"""Queries of the operators on documents: statistics, order, structure, text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.functions import arithmetic
from folioflow.functions import text as T
from folioflow.operators import corpus, evaluate, hierarchy, reconstruct, structure
from folioflow.plans import sqltext as S
from folioflow.session import table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query, with the SQL that gives the same rows."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = sql
        return f

    return add


def live(spark: SparkSession, sf: str) -> DataFrame:
    return corpus.live_blocks(table(spark, sf, "blocks"))


# ---------------------------------------------------------------- statistics


@query(f"WITH {S.BLOCKS} SELECT block_type, count(*) AS n_blocks FROM b GROUP BY ALL")
def q_type_counts(spark, sf):
    """AGG-1: blocks per type."""
    return corpus.type_counts(live(spark, sf))


@query(f"""WITH {S.BLOCKS} SELECT document_id, count(*) AS n_blocks, count(DISTINCT page_index) AS n_pages,
  100.0::DOUBLE * count(*) FILTER (trim(coalesce(text, ''), ' ') <> '') / count(*) AS pct_text, 100.0::DOUBLE * count(x0) / count(*) AS pct_box,
  100.0::DOUBLE * count(*) FILTER (block_type IN {S.ASSETS}) / count(*) AS pct_assets, count(*) FILTER (block_type IN {S.ASSETS} AND caption IS NOT NULL) AS n_captioned FROM b GROUP BY ALL""")
def q_coverage(spark, sf):
    """AGG-2, AGG-5: shares with text, box and asset per document."""
    return corpus.coverage(live(spark, sf))


@query(f"""WITH {S.BLOCKS} SELECT document_id, count(*) FILTER (page_index IS NOT NULL AND reading_order IS NOT NULL AND x0 IS NOT NULL AND extraction_confidence IS NOT NULL) AS n_complete,
  bool_and(page_index IS NOT NULL AND reading_order IS NOT NULL AND x0 IS NOT NULL AND extraction_confidence IS NOT NULL) AS all_complete FROM b GROUP BY ALL""")
def q_provenance(spark, sf):
    """AGG-3, PRJ-2: completeness of provenance per document."""
    return corpus.provenance(live(spark, sf))


@query(f"""WITH {S.BLOCKS} SELECT document_id, avg(extraction_confidence) AS mean_confidence, min(extraction_confidence) AS min_confidence,
  100.0::DOUBLE * count(*) FILTER (extraction_confidence < 0.6) / count(extraction_confidence) AS pct_below FROM b GROUP BY ALL""")
def q_confidence(spark, sf):
    """AGG-4: extraction confidence per document."""
    return corpus.confidence(live(spark, sf))


@query(f"WITH {S.BLOCKS} SELECT document_id, block_id, extraction_confidence FROM b WHERE extraction_confidence IS NOT NULL ORDER BY extraction_confidence, document_id, block_id LIMIT 50")
def q_lowest_confidence(spark, sf):
    """AGG-4: the fifty blocks read with the least confidence."""
    return corpus.lowest_confidence(live(spark, sf))


@query(f"""WITH {S.BLOCKS} SELECT document_id, count(*) AS n_blocks, count(*) - count(DISTINCT reading_order) AS n_repeats, max(reading_order) - min(reading_order) + 1 - count(DISTINCT reading_order) AS n_gaps,
  max(reading_order) - min(reading_order) + 1 = count(*) AND count(DISTINCT reading_order) = count(*) AS contiguous FROM b GROUP BY ALL""")
def q_order_integrity(spark, sf):
    """AGG-6: gaps and repeats of the reading order."""
    return corpus.order_integrity(live(spark, sf))


_PAGE = "p AS (SELECT document_id, page_index, max(width) AS width, max(height) AS height FROM pages WHERE document_id IS NOT NULL AND page_index IS NOT NULL GROUP BY ALL)"


@query(f"""WITH {S.BLOCKS}, {_PAGE}, f AS (
  SELECT b.document_id, b.page_index, (x1 - x0) * (y1 - y0) / (p.width * p.height) AS share, block_type, text FROM b LEFT JOIN p USING (document_id, page_index)
), n AS (
  SELECT document_id, page_index, count(*) AS n, count(*) FILTER (share < 2e-4) AS tiny, count(*) FILTER (share > 0.95 AND block_type NOT IN {S.ASSETS}) AS full_page,
    count(*) FILTER (block_type IN ('paragraph', 'question', 'answer', 'solution', 'explanation', 'list_item') AND trim(coalesce(text, ''), ' ') = '') AS blank FROM f GROUP BY ALL
), a AS (
  SELECT k.document_id, coalesce(n, 0) AS n, coalesce(tiny, 0) AS tiny, coalesce(full_page, 0) AS full_page, coalesce(blank, 0) AS blank
  FROM (SELECT document_id, page_index FROM p UNION SELECT document_id, page_index FROM n) k LEFT JOIN n USING (document_id, page_index)
)
SELECT document_id, list_sort(list(n))[count(*) // 2 + 1] AS median_blocks, count(*) FILTER (n = 0) AS empty_pages, CAST(sum(tiny) AS BIGINT) AS n_tiny, CAST(sum(full_page) AS BIGINT) AS n_full_page, CAST(sum(blank) AS BIGINT) AS n_textless FROM a GROUP BY ALL""")
def q_integrity(spark, sf):
    """AGG-8: upper median of blocks a page, empty pages, tiny and full-page boxes, prose without text."""
    return corpus.integrity(live(spark, sf), table(spark, sf, "pages"))


@query(f"""WITH {S.BLOCKS}, {_PAGE}, n AS (SELECT p.document_id, p.page_index, count(b.block_id) AS n_blocks FROM p LEFT JOIN b USING (document_id, page_index) GROUP BY ALL),
  m AS (SELECT document_id, median(n_blocks) AS median_blocks FROM n GROUP BY ALL)
SELECT document_id, page_index, n_blocks, median_blocks FROM n JOIN m USING (document_id) WHERE n_blocks < greatest(2.0, 0.25 * median_blocks)""")
def q_low_yield_pages(spark, sf):
    """AGG-9, AGG-10: pages with far fewer blocks than usual."""
    return corpus.low_yield_pages(live(spark, sf), table(spark, sf, "pages"))


def _duplicates(tbl: str, column: str, whole: bool = False) -> str:
    key = f"regexp_replace(lower(trim(coalesce({column}, ''), ' ')), '\\s+', ' ', 'g')"
    key = f"trim({key}, ' ')" if whole else f"substr({key}, 1, 200)"
    return f"SELECT sha256(k) AS text_key, count(*) - 1 AS surplus FROM (SELECT {key} AS k FROM {tbl}) WHERE k <> '' GROUP BY k HAVING count(*) > 1"


@query(_duplicates("questions", "question_text"))
def q_duplicate_questions(spark, sf):
    """AGG-13: question texts that come more than once."""
    return corpus.duplicate_texts(table(spark, sf, "questions"), "question_text")


@query(_duplicates("documents", "text", whole=True))
def q_duplicate_documents(spark, sf):
    """AGG-13: whole documents that come more than once."""
    return corpus.duplicate_texts(table(spark, sf, "documents"), "text", length=None)


@query(f"""WITH {S.BLOCKS}, h AS (
  SELECT document_id, reading_order // 4096 AS part, sha256(string_agg(block_id || '|' || coalesce(text, ''), chr(10) ORDER BY reading_order, block_id)) AS h FROM b GROUP BY ALL
) SELECT document_id, sha256(string_agg(h, '' ORDER BY part)) AS content_sha256 FROM h GROUP BY ALL""")
def q_content_hash(spark, sf):
    """AGG-23: hash of each document's content in reading order."""
    return corpus.content_hash(live(spark, sf))


@query(f"""WITH {S.BLOCKS}, l AS (SELECT *, lag(block_id) OVER w AS prev_id, lead(block_id) OVER w AS next_id FROM b WINDOW w AS (PARTITION BY document_id ORDER BY reading_order))
SELECT document_id, 'ev_' || block_id AS unit_id, block_id, CASE WHEN block_type IN ('figure', 'image', 'diagram') THEN 'visual' WHEN block_type IN ('table', 'equation') THEN block_type ELSE 'text' END AS kind,
  coalesce(text, caption, '') AS unit_text, concat_ws(',', prev_id, next_id) AS neighbours FROM l""")
def q_evidence_units(spark, sf):
    """PRJ-5, PER-4: one retrieval unit per block."""
    return corpus.evidence_units(structure.linked(live(spark, sf)))


@query("""SELECT document_id, question_id, question_type, source_type, coalesce(answer_association.status, 'none') AS status, coalesce(answer_association.final_confidence, answer_association.llm_confidence) AS confidence,
  substr(question_text, 1, 110) AS preview FROM questions WHERE question_type IN ('mcq', 'numerical', 'case_study') AND source_type IN ('activity', 'in_text', 'worked_example') AND contains(lower(coalesce(question_text, '')), 'pressure')""")
def q_filter_questions(spark, sf):
    """PRJ-6, PRJ-7, PRJ-8: filtered question list."""
    return corpus.question_rows(corpus.filtered(table(spark, sf, "questions"), ["mcq", "numerical", "case_study"], ["activity", "in_text", "worked_example"], "Pressure"))


# ---------------------------------------------------------------- order and structure


@query(f"WITH {S.BLOCKS} SELECT document_id, block_id, lag(block_id) OVER w AS prev_id, lead(block_id) OVER w AS next_id FROM b WINDOW w AS (PARTITION BY document_id ORDER BY reading_order)")
def q_prev_next(spark, sf):
    """WIN-1, SRT-1: neighbours in reading order."""
    return structure.linked(live(spark, sf)).select("document_id", "block_id", "prev_id", "next_id")


_BEFORE = "OVER (PARTITION BY document_id ORDER BY reading_order ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
_LEVELS = ", ".join(f"max(CASE WHEN level = {k} THEN reading_order END) {_BEFORE} AS m{k}" for k in range(1, structure.MAX_LEVEL + 1))
_PARENT = " ".join(f"WHEN level = {k} THEN " + ("NULL" if k == 1 else f"greatest({', '.join(f'm{i}' for i in range(1, k))})") for k in range(1, structure.MAX_LEVEL + 1))


@query(f"""WITH {S.BLOCKS}, l AS (SELECT document_id, block_id, reading_order, CAST({S.LEVEL} AS INTEGER) AS level FROM b),
m AS (SELECT *, {_LEVELS}, max(CASE WHEN level > 0 THEN reading_order END) OVER (PARTITION BY document_id ORDER BY reading_order) AS sec FROM l),
r AS (SELECT *, CASE WHEN level > 0 THEN CASE {_PARENT} END ELSE sec END AS par FROM m)
SELECT r.document_id, r.block_id, r.level, coalesce(r.level > 0, false) AS opens, s.block_id AS section_block, p.block_id AS parent_block
FROM r LEFT JOIN l s ON s.document_id = r.document_id AND s.reading_order = r.sec LEFT JOIN l p ON p.document_id = r.document_id AND p.reading_order = r.par""")
def q_sections(spark, sf):
    """WIN-2, JON-5: section of each block and parent of each heading."""
    return structure.sections(live(spark, sf))


@query("""WITH RECURSIVE n AS (SELECT DISTINCT document_id, node_id FROM hierarchy WHERE document_id IS NOT NULL AND node_id <> ''),
e AS (SELECT h.document_id, h.node_id AS parent, h.child AS node FROM (SELECT document_id, node_id, unnest(children) AS child FROM hierarchy WHERE node_id <> '') h JOIN n ON n.document_id = h.document_id AND n.node_id = h.child),
p AS (SELECT document_id, node, min(parent) AS parent FROM e GROUP BY ALL),
up AS (SELECT document_id, node, parent, [node] AS seen, parent = node AS looped FROM p
  UNION ALL SELECT u.document_id, u.node, p.parent, list_append(u.seen, p.node), list_contains(u.seen, p.node) OR coalesce(p.parent = p.node, false) FROM up u JOIN p ON p.document_id = u.document_id AND p.node = u.parent WHERE NOT u.looped),
f AS (SELECT document_id, node, max(len(seen)) AS depth, bool_or(looped) AS looped FROM up GROUP BY ALL)
SELECT n.document_id, count(*) AS n_nodes, count(f.node) AS n_linked, CAST(coalesce(max(CASE WHEN NOT f.looped THEN f.depth END), 0) AS INTEGER) AS max_depth, count(*) FILTER (f.looped) AS n_lost
FROM n LEFT JOIN f ON f.document_id = n.document_id AND f.node = n.node_id GROUP BY ALL""")
def q_hierarchy_metrics(spark, sf):
    """AGG-7: nodes, linked nodes, depth, and nodes on or under a cycle per document."""
    h = table(spark, sf, "hierarchy")
    links = hierarchy.child_list_links(h)
    solved = hierarchy.resolve(hierarchy.node_table(links))
    n = links.groupBy("document_id").agg(F.count(F.lit(1)).alias("n_nodes"))
    s = solved.groupBy("document_id").agg(F.count_if(F.col("depth") != 0).alias("n_linked"), F.coalesce(F.max(F.when(F.col("depth") > 0, F.col("depth"))), F.lit(0)).alias("max_depth"), F.count_if(F.col("tree_state") != "tree").alias("n_lost"))
    return n.join(s, "document_id", "left").select("document_id", "n_nodes", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("n_linked", "max_depth", "n_lost")))


@query(f"""WITH {S.BLOCKS}, k AS (SELECT document_id, block_id, reading_order, block_type, trim(coalesce(text, ''), ' ') AS t, block_type IN {S.HEADINGS} OR heading_level IS NOT NULL AS heading FROM b),
e AS (SELECT *, CASE WHEN heading AND {S.rlike('t', T.ANSWER_HEADING)} THEN 'opens' WHEN heading THEN 'closes' WHEN block_type IN {S.GENERIC} AND {S.rlike('t', T.ANSWER_OPENER)} THEN 'opener' WHEN {S.rlike('t', T.ANSWER_RESET)} THEN 'closes' END AS event,
  block_type IN {S.GENERIC} AND t <> '' AND NOT heading AS generic FROM k),
i AS (SELECT *, count(event) OVER (PARTITION BY document_id ORDER BY reading_order) AS isl FROM e),
r AS (SELECT *, first_value(event) OVER w AS head, count(*) FILTER (generic AND event IS NULL) OVER w AS k FROM i WINDOW w AS (PARTITION BY document_id, isl ORDER BY reading_order))
SELECT document_id, block_id, CASE WHEN event = 'opener' THEN 'answer_opener' ELSE 'answer_heading_run' END AS source FROM r
WHERE event = 'opener' OR (event IS NULL AND generic AND head IN ('opens', 'opener') AND k <= 8)""")
def q_answer_runs(spark, sf):
    """WIN-3: generic blocks that become answers."""
    return structure.answer_runs(live(spark, sf))


_BANNERS = " ".join(f"WHEN {S.rlike('t', p)} THEN {v}" for p, v in T.BANNER_MARKS)


@query(f"""WITH {S.BLOCKS}, m AS (SELECT document_id, block_id, reading_order, coalesce(text, '') AS t, block_type IN ('banner', 'heading') AS banner FROM b),
v AS (SELECT *, coalesce(CAST(nullif(regexp_extract(t, {S.lit(T.MARKS_BANNER)}, 1), '') AS INTEGER), CASE WHEN banner THEN CASE {_BANNERS} END END) AS mk, banner AND {S.rlike('t', T.SELF_ASSESSMENT)} AS sa FROM m)
SELECT document_id, block_id, CASE WHEN bool_or(sa) OVER w THEN 'self_assessment' ELSE 'body' END AS region, last_value(mk IGNORE NULLS) OVER w AS banner_marks FROM v WINDOW w AS (PARTITION BY document_id ORDER BY reading_order)""")
def q_regions(spark, sf):
    """WIN-10: region and banner marks in force."""
    return structure.regions(live(spark, sf))


_LINES = """l AS (SELECT document_id, row_id, position, block_type, text FROM (
  SELECT doc_id AS document_id, doc_id || ':' || (ix - 1) AS row_id, ix - 1 AS position, CASE WHEN line LIKE 'Ans%' OR line LIKE 'Solution%' THEN 'answer' ELSE 'paragraph' END AS block_type, line AS text
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS ix FROM documents)))"""


def lines(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of the documents as rows in order (SRC-7)."""
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("document_id"), F.posexplode(F.split("text", "\n")).alias("position", "text"))
    kind = F.when(F.col("text").startswith("Ans") | F.col("text").startswith("Solution"), "answer").otherwise("paragraph")
    return docs.select("document_id", F.concat_ws(":", "document_id", "position").alias("row_id"), F.col("position").cast("bigint").alias("position"), kind.alias("block_type"), "text")


_ST, _LB, _LV = S.enumerator("text")


@query(f"WITH {_LINES} SELECT document_id, row_id, {_ST} AS style, {_LB} AS label, CAST({_LV} AS INTEGER) AS level FROM l WHERE ({_ST}) IS NOT NULL")
def q_enumerators(spark, sf):
    """STR-1, STR-4: labels that lines start with."""
    e = lines(spark, sf).select("document_id", "row_id", T.enumerator("text").alias("e")).select("document_id", "row_id", "e.*")
    return e.filter("style is not null")


_PST, _PLB, _PLV = S.enumerator("pt")
_SUBS = "('upper', 'num', 'lower', 'roman')"
_GROUP_SQL = f"""WITH {_LINES}, a AS (SELECT *, upper(trim(coalesce(text, ''), ' ')) = 'OR' AS is_or, coalesce(text, '') AS pt FROM l),
e AS (SELECT *, {_PST} AS style, {_PLB} AS label, {_PLV} AS level FROM a),
c AS (SELECT *, NOT is_or AND coalesce(block_type = 'worked_example' OR style IN ('example', 'numbered'), false) AS is_cont FROM e),
d AS (SELECT *, max(CASE WHEN is_cont THEN position END) OVER (PARTITION BY document_id ORDER BY position) AS cont FROM c),
s AS (SELECT *, NOT is_or AND NOT is_cont AND coalesce(style IN {_SUBS}, false) AND cont IS NOT NULL AS is_sub FROM d),
u AS (SELECT *, max(CASE WHEN is_sub AND level = 1 THEN position END) OVER (PARTITION BY document_id ORDER BY position ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS up FROM s),
p AS (SELECT *, CASE WHEN is_sub THEN CASE WHEN level = 2 AND up > cont THEN up ELSE cont END END AS par, NOT is_or AND NOT is_cont AND NOT is_sub AND block_type IN ('answer', 'solution', 'explanation') AND cont IS NOT NULL AS is_content FROM u),
v AS (SELECT *, last_value(CASE WHEN is_or THEN 'or' WHEN is_cont OR is_sub OR is_content THEN 'other' END IGNORE NULLS) OVER w AS ev, max(CASE WHEN is_sub THEN position END) OVER w AS prev_sub FROM p WINDOW w AS (PARTITION BY document_id ORDER BY position ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
k AS (SELECT v.*, coalesce(v.is_sub AND v.ev = 'or' AND v.prev_sub > v.cont AND o.par = v.par, false) AS link FROM v LEFT JOIN v o ON o.document_id = v.document_id AND o.position = v.prev_sub),
g AS (SELECT *, lead(link) OVER w AS next_link, last_value(CASE WHEN NOT link THEN row_id END IGNORE NULLS) OVER w AS first_id FROM k WHERE is_sub WINDOW w AS (PARTITION BY document_id ORDER BY position))
SELECT k.document_id, k.row_id, CASE WHEN k.is_or THEN 'or_separator' WHEN k.is_cont THEN 'container' WHEN g.link OR g.next_link THEN 'or_alternative' WHEN k.is_sub THEN 'subpart' ELSE 'content' END AS group_role,
  CASE WHEN k.is_cont OR k.is_sub THEN k.label END AS enumerator, CASE WHEN k.is_cont THEN coalesce(k.style, 'example') WHEN k.is_sub THEN k.style END AS style, CASE WHEN k.is_sub THEN CAST(k.level AS INTEGER) END AS depth,
  k.document_id || ':' || CASE WHEN k.is_content THEN k.cont ELSE k.par END AS parent_row, CASE WHEN g.link OR g.next_link THEN 'or_' || g.first_id END AS or_group
FROM k LEFT JOIN g ON g.row_id = k.row_id AND g.document_id = k.document_id WHERE k.is_or OR k.is_cont OR k.is_sub OR k.is_content"""


@query(_GROUP_SQL)
def q_group_structure(spark, sf):
    """WIN-7, STR-2, STR-3: containers, parts and alternatives among the lines of the documents."""
    return structure.enumeration(lines(spark, sf), ["document_id"])


@query(f"""WITH {S.BLOCKS}, {_PAGE}, w AS (SELECT b.document_id, b.page_index, block_id, reading_order, y0, col_ix, x1 - x0 > 0.62 * p.width AND x0 < 0.28 * p.width AS full_w, (x0 + x1) / 2 < p.width / 2.0 AS is_left
  FROM b JOIN p USING (document_id, page_index) WHERE x0 IS NOT NULL),
c AS (SELECT *, count(*) FILTER (NOT full_w AND is_left) OVER g >= 2 AND count(*) FILTER (NOT full_w AND NOT is_left) OVER g >= 2 AS two, CASE WHEN full_w THEN -1 WHEN is_left THEN 0 ELSE 1 END AS side FROM w WINDOW g AS (PARTITION BY document_id, page_index)),
d AS (SELECT c.*, (SELECT count(*) FROM w f WHERE f.document_id = c.document_id AND f.page_index = c.page_index AND f.full_w AND f.y0 < c.y0) AS band FROM c),
r AS (SELECT *, row_number() OVER (PARTITION BY document_id, page_index ORDER BY band, side, y0, reading_order, block_id) AS geo, row_number() OVER (PARTITION BY document_id, page_index ORDER BY reading_order, block_id) AS model,
  CASE WHEN side = -1 THEN -1 WHEN NOT two THEN 0 ELSE side END AS label FROM d),
x AS (SELECT a.document_id, a.page_index, count(*) AS n_crossed FROM r a JOIN r z ON a.document_id = z.document_id AND a.page_index = z.page_index AND a.model < z.model AND a.geo > z.geo GROUP BY ALL)
SELECT r.document_id, r.page_index, count(*) AS n_blocks, CAST(CASE WHEN bool_or(two) THEN 2 ELSE 1 END AS INTEGER) AS n_columns, count(*) FILTER (full_w) AS n_full_width, count(*) FILTER (full_w) + 1 AS n_bands,
  count(*) FILTER (label IS DISTINCT FROM col_ix) AS n_corrected, coalesce(any_value(n_crossed), 0) AS n_crossed,
  CASE WHEN count(*) > 1 THEN 1 - coalesce(any_value(n_crossed), 0) / (count(*) * (count(*) - 1) / 2.0::DOUBLE) ELSE 1.0::DOUBLE END AS agreement
FROM r LEFT JOIN x USING (document_id, page_index) GROUP BY r.document_id, r.page_index""")
def q_columns(spark, sf):
    """WIN-4, WIN-5, WIN-6, NUM-11: columns, bands and agreement of orders per page."""
    return structure.columns(live(spark, sf), table(spark, sf, "pages"))


_BARS = "CASE WHEN coalesce({0}, '') <> '' THEN length(split_part({0}, chr(10), 1)) - length(replace(split_part({0}, chr(10), 1), '|', '')) END"
_ROWNO = "list_transform(regexp_extract_all(coalesce({0}, ''), '\\(\\s*(\\d{{1,9}})\\s*\\)', 1), lambda x: CAST(x AS INTEGER))"


@query(f"""WITH {S.BLOCKS}, {_PAGE}, h AS (SELECT b.*, coalesce(p.height, 1) AS height FROM b LEFT JOIN p USING (document_id, page_index) WHERE x0 IS NOT NULL AND block_type <> 'noise'),
n AS (SELECT *, lead(block_id) OVER w AS n_id, lead(block_type) OVER w AS n_type, lead(text) OVER w AS n_text, lead(page_index) OVER w AS n_page, lead(col_ix) OVER w AS n_col, lead(y0) OVER w AS n_y0, lead(height) OVER w AS n_height FROM h WINDOW w AS (PARTITION BY document_id ORDER BY reading_order)),
k AS (SELECT *, coalesce(block_type = n_type AND block_type IN ('paragraph', 'table', 'list') AND y1 > 0.80 * height AND n_y0 < 0.25 * n_height AND (page_index IS DISTINCT FROM n_page OR col_ix IS DISTINCT FROM n_col)
  AND CASE WHEN block_type = 'table' THEN coalesce(list_max({_ROWNO.format('text')}) + 1 = list_min({_ROWNO.format('n_text')}), false) OR coalesce({_BARS.format('text')} = {_BARS.format('n_text')} AND {_BARS.format('text')} >= 1, false)
      ELSE coalesce(text, '') <> '' AND NOT {S.rlike("trim(text, ' ')", T.STATEMENT_END)} END, false) AS link FROM n),
j AS (SELECT *, coalesce(lag(link) OVER (PARTITION BY document_id ORDER BY reading_order), false) AS linked FROM k),
i AS (SELECT *, last_value(CASE WHEN NOT linked THEN block_id END IGNORE NULLS) OVER (PARTITION BY document_id ORDER BY reading_order) AS head FROM j)
SELECT document_id, block_id, n_id AS continues_to, 'item_' || head AS logical_item FROM i WHERE link""")
def q_continuations(spark, sf):
    """WIN-8, JON-7, STR-33: fragments that go on over a column or page."""
    return structure.continuations(live(spark, sf), table(spark, sf, "pages"))


def _parts(phrase: str) -> str:
    low = f"lower(coalesce({phrase}, ''))"
    d = " ".join(f"WHEN contains({low}, '{w}') THEN '{w}'" for w in T.DIRECTIONS)
    h = " ".join(f"WHEN contains({low}, '{w}') THEN '{k}'" for w, k in T.HINTS)
    label = ", ".join(f"nullif(lower(regexp_extract({phrase}, {S.lit(T.REFERENCE_LABEL)}, {i})), '')" for i in (1, 2, 3))
    return f"CASE {d} END AS direction, CASE {h} END AS hint, coalesce({label}) AS label"


@query(f"""SELECT document_id, raw_id, CAST(ix - 1 AS INTEGER) AS ref_ix, phrase, {_parts('phrase')} FROM (SELECT document_id, raw_id, unnest(refs) AS phrase, generate_subscripts(refs, 1) AS ix FROM raw_blocks WHERE document_id IS NOT NULL) WHERE phrase IS NOT NULL""")
def q_reference_phrases(spark, sf):
    """PRS-13, STR-34: parsed references."""
    return structure.references(table(spark, sf, "raw_blocks")).drop("page_index", "reading_order")


_REF_LABEL = "coalesce(" + ", ".join(f"nullif(lower(regexp_extract(lt, {S.lit(T.REFERENCE_LABEL)}, {i})), '')" for i in (1, 2, 3)) + ")"
_REF_FITS = " OR ".join(f"(hint = '{h}' AND asset_type IN {S.in_list(kinds)})" for h, kinds in structure.FITS)
_REF_RIGHT = f"CASE WHEN direction IN {S.in_list(structure.BEFORE)} THEN spot < ro WHEN direction IN {S.in_list(structure.AFTER)} THEN spot > ro END"


@query(f"""WITH {S.BLOCKS}, ph AS (SELECT DISTINCT document_id, raw_id, page_index, reading_order AS ro, ix, phrase FROM (SELECT document_id, raw_id, page_index, reading_order, unnest(refs) AS phrase, generate_subscripts(refs, 1) - 1 AS ix FROM raw_blocks WHERE document_id IS NOT NULL) WHERE phrase IS NOT NULL),
r AS (SELECT document_id, raw_id || ':' || ix AS ref_id, page_index, ro, {_parts('phrase')} FROM ph),
a AS (SELECT *, {_REF_LABEL} AS a_label FROM (SELECT document_id, block_id AS asset_id, block_type AS asset_type, page_index AS a_page, reading_order AS spot, concat_ws(' ', caption, text) AS lt FROM b WHERE block_type IN {S.ASSETS})),
c AS (SELECT r.*, asset_id, a_page, spot, a_label, coalesce(a_page = page_index, false) AS near FROM r JOIN a USING (document_id) WHERE hint IS NULL OR {_REF_FITS}),
lb AS (SELECT document_id, ref_id, count(*) AS n_labelled, min(asset_id) AS labelled FROM c WHERE label = a_label GROUP BY ALL),
p1 AS (SELECT * FROM (SELECT *, bool_or(near) OVER w AS any_near FROM c WINDOW w AS (PARTITION BY document_id, ref_id)) WHERE near OR NOT any_near),
p2 AS (SELECT * FROM (SELECT *, coalesce({_REF_RIGHT}, direction IS NULL) AS ok, bool_or(coalesce({_REF_RIGHT}, false)) OVER w AS any_ok FROM p1 WINDOW w AS (PARTITION BY document_id, ref_id)) WHERE ok OR NOT any_ok),
p3 AS (SELECT *, abs(spot - ro) AS away, min(abs(spot - ro)) OVER w AS least_away FROM p2 WINDOW w AS (PARTITION BY document_id, ref_id)),
n AS (SELECT document_id, ref_id, count(*) AS ties, min(asset_id) AS nearest, bool_or(near) AS same_page FROM p3 WHERE away = least_away AND (near OR away <= 8) GROUP BY ALL),
s AS (SELECT r.*, n_labelled, labelled, nearest, ties, same_page, CASE WHEN n_labelled = 1 THEN 'resolved' WHEN n_labelled > 1 THEN 'ambiguous' WHEN ties IS NULL THEN 'no_candidate' WHEN ties > 1 THEN 'ambiguous' ELSE 'resolved' END AS status,
  CASE WHEN n_labelled >= 1 THEN 'label' WHEN ties IS NOT NULL THEN CASE WHEN direction IS NOT NULL AND ties = 1 THEN 'direction' ELSE 'proximity' END END AS method FROM r LEFT JOIN lb USING (document_id, ref_id) LEFT JOIN n USING (document_id, ref_id))
SELECT document_id, ref_id, status, CASE WHEN status = 'resolved' THEN CASE WHEN method = 'label' THEN labelled ELSE nearest END END AS target_id, method,
  (CASE WHEN status <> 'resolved' THEN 0 WHEN method = 'label' THEN 0.9 WHEN method = 'direction' THEN 0.75 WHEN same_page THEN 0.7 ELSE 0.55 END)::DOUBLE AS confidence FROM s""")
def q_resolved_references(spark, sf):
    """JON-4: references with their target by label, direction or nearness."""
    refs = structure.references(table(spark, sf, "raw_blocks")).dropDuplicates(["document_id", "raw_id", "ref_ix"]).withColumn("ref_id", F.concat_ws(":", "raw_id", "ref_ix"))
    assets = live(spark, sf).filter(F.col("block_type").isin(*T.ASSET_TYPES)).select("document_id", F.col("block_id").alias("asset_id"), F.col("block_type").alias("asset_type"), "page_index", "reading_order", F.concat_ws(" ", "caption", "text").alias("label_text"))
    return structure.resolve_references(refs, assets)


@query("""WITH r AS (SELECT DISTINCT ON (document_id, raw_id) document_id, raw_id, page_index, coalesce(reading_order, 0) AS ro, coalesce(block_ix, 0) AS ix FROM raw_blocks WHERE document_id IS NOT NULL AND page_index IS NOT NULL AND raw_id IS NOT NULL)
SELECT document_id, raw_id, 'blk_' || printf('%06d', row_number() OVER w - 1) AS canonical_id, row_number() OVER w - 1 AS new_order FROM r WINDOW w AS (PARTITION BY document_id ORDER BY page_index, ro, ix, raw_id)""")
def q_canonical_ids(spark, sf):
    """PRS-10: ids and order of parsed blocks."""
    return structure.canonical_ids(table(spark, sf, "raw_blocks"))


@query("""WITH n AS (SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS series, l_linenumber AS n FROM lineitem), d AS (SELECT series, n, lead(n) OVER (PARTITION BY series ORDER BY n) AS after, count(*) OVER (PARTITION BY series) AS c FROM n)
SELECT series, n + 1 AS first_missing, after - 1 AS last_missing FROM d WHERE c >= 3 AND after > n + 1""")
def q_numbering_gaps(spark, sf):
    """WIN-12: gaps of the line numbers of orders."""
    rows = table(spark, sf, "lineitem").select(F.col("l_orderkey").cast("string").alias("series"), F.col("l_linenumber").alias("n"))
    return structure.numbering_gaps(rows)


@query(f"""WITH {_LINES}, n AS (SELECT DISTINCT CAST(document_id AS VARCHAR) || ':N' AS series, CAST(regexp_extract(text, '^\\s*(\\d{{1,3}})[.)]\\s', 1) AS INTEGER) AS n FROM l WHERE regexp_matches(text, '^\\s*(\\d{{1,3}})[.)]\\s')),
d AS (SELECT series, n, lead(n) OVER (PARTITION BY series ORDER BY n) AS after, count(*) OVER (PARTITION BY series) AS c FROM n) SELECT series, n + 1 AS first_missing, after - 1 AS last_missing FROM d WHERE c >= 3 AND after > n + 1""")
def q_exercise_gaps(spark, sf):
    """WIN-12, STR-32: gaps in the numbers that lines begin with."""
    rows = lines(spark, sf).select(F.concat(F.col("document_id").cast("string"), F.lit(":N")).alias("series"), F.nullif(F.regexp_extract("text", r"^\s*(\d{1,3})[.)]\s", 1), F.lit("")).cast("int").alias("n"))
    return structure.numbering_gaps(rows)


@query(f"""WITH {S.BLOCKS}, v AS (SELECT document_id, page_index, block_id, x0, y0, x1, y1, (x1 - x0) * (y1 - y0) AS ar FROM b WHERE x0 IS NOT NULL),
o AS (SELECT a.document_id, a.page_index, a.block_id AS a_block_id, z.block_id AS b_block_id, (least(a.x1, z.x1) - greatest(a.x0, z.x0)) * (least(a.y1, z.y1) - greatest(a.y0, z.y0)) AS common, a.ar AS aa, z.ar AS za
  FROM v a JOIN v z ON a.document_id = z.document_id AND a.page_index = z.page_index AND a.block_id < z.block_id AND a.x0 < z.x1 AND z.x0 < a.x1 AND a.y0 < z.y1 AND z.y0 < a.y1)
SELECT document_id, page_index, a_block_id, b_block_id, common / (aa + za - common) AS iou FROM o WHERE common / (aa + za - common) >= 0.5""")
def q_overlapping_boxes(spark, sf):
    """PRJ-4, NUM-12: boxes of a page that overlap."""
    return structure.boxes_that_overlap(live(spark, sf))


@query(f"""WITH {S.BLOCKS}, p AS (SELECT document_id, page_index, max(width) AS width, max(height) AS height FROM pages WHERE document_id IS NOT NULL AND page_index IS NOT NULL AND width > 0 AND height > 0 GROUP BY ALL),
g AS (SELECT document_id, page_index, x.i, y.j FROM p, unnest(range(CAST(ceil(width / 100.0) AS BIGINT))) x(i), unnest(range(CAST(ceil(height / 100.0) AS BIGINT))) y(j)),
c AS (SELECT g.document_id, g.page_index, g.i, g.j, bool_or(coalesce((g.i + 0.5) * 100 BETWEEN x0 AND x1 AND (g.j + 0.5) * 100 BETWEEN y0 AND y1, false)) AS hit FROM g LEFT JOIN b ON b.document_id = g.document_id AND b.page_index = g.page_index GROUP BY ALL)
SELECT document_id, page_index, count(*) FILTER (hit) AS n_covered, count(*) AS n_points, CAST(count(*) FILTER (hit) AS DOUBLE) / count(*) AS coverage FROM c GROUP BY ALL""")
def q_box_coverage(spark, sf):
    """JON-24, IMG-3: share of a page's grid points under boxes."""
    return structure.box_coverage(live(spark, sf), table(spark, sf, "pages"))


@query(f"""WITH {S.BLOCKS}, {_PAGE} SELECT b.document_id, b.block_id, greatest(0.0, least(x0, p.width)) AS px0, greatest(0.0, least(y0, p.height)) AS py0, greatest(0.0, least(x1, p.width)) AS px1, greatest(0.0, least(y1, p.height)) AS py1,
  CAST(x0 AS DOUBLE) / p.width AS nx0, CAST(y1 AS DOUBLE) / p.height AS ny1 FROM b JOIN p USING (document_id, page_index) WHERE x0 IS NOT NULL""")
def q_normalised_boxes(spark, sf):
    """PRS-6, PRS-12, PRJ-3: boxes clamped to the page and as shares of it."""
    from folioflow.functions import geometry

    page = table(spark, sf, "pages").filter("document_id is not null and page_index is not null").groupBy("document_id", "page_index").agg(F.max("width").alias("width"), F.max("height").alias("height"))
    b = live(spark, sf).filter("x0 is not null").join(page, ["document_id", "page_index"])
    inside = geometry.clamped(F.col("width"), F.col("height"))
    return b.select("document_id", "block_id", *(c.alias(f"p{n}") for n, c in inside.items()), (F.col("x0") / F.col("width")).alias("nx0"), (F.col("y1") / F.col("height")).alias("ny1"))


# ---------------------------------------------------------------- reconstruction


def scored(spark: SparkSession, sf: str, blocks: DataFrame | None = None) -> DataFrame:
    """Pair scores of the blocks without page furniture; blocks are the live ones, where they are at hand."""
    page = table(spark, sf, "pages").filter("document_id is not null and page_index is not null").groupBy("document_id", "page_index").agg(F.max("height").alias("height"))
    b = (live(spark, sf) if blocks is None else blocks).filter("block_type <> 'noise'").join(page, ["document_id", "page_index"], "left").withColumn("height", F.coalesce("height", F.lit(1)).cast("double"))
    return reconstruct.pair_scores(b.withColumnsRenamed({"block_id": "row_id", "reading_order": "position"}), ["document_id"])


_CONTINUABLE = S.in_list(reconstruct.CONTINUABLE)
_SCORE = f"""{S.BLOCKS}, {_PAGE}, h AS (SELECT b.*, CAST(coalesce(p.height, 1) AS DOUBLE) AS height FROM b LEFT JOIN p USING (document_id, page_index) WHERE block_type <> 'noise'),
g AS (SELECT *, lag(block_id) OVER w AS p_id, lag(text) OVER w AS p_text, lag(section_id) OVER w AS p_sec, lag(part_of_id) OVER w AS p_par, lag(page_index) OVER w AS p_page, lag(col_ix) OVER w AS p_col, lag(y1) OVER w AS p_y1 FROM h WINDOW w AS (PARTITION BY document_id ORDER BY reading_order)),
t AS (SELECT *, rtrim(coalesce(p_text, ''), ' ') AS lt, regexp_replace(coalesce(text, ''), '^\\s+', '') AS rt, coalesce(text, '') AS ct, p_page IS NOT DISTINCT FROM page_index AND p_col IS NOT DISTINCT FROM col_ix AS same, y0 - p_y1 AS gap FROM g),
s AS (SELECT *, p_id IS NULL OR block_type NOT IN {_CONTINUABLE} OR {S.rlike('ct', T.ANSWER_START)} OR upper(trim(ct, ' ')) = 'OR' OR {S.rlike('ct', T.ENUMERATOR_START)} AS hard_stop,
  (CASE WHEN p_sec IS NOT DISTINCT FROM section_id THEN 0.15 ELSE -0.25 END)::DOUBLE + (CASE WHEN p_par = part_of_id THEN 0.15 ELSE 0 END)::DOUBLE + (CASE WHEN same THEN 0.15 ELSE 0.05 END)::DOUBLE
  + (CASE WHEN same AND gap >= 0 AND gap < 0.04 * height THEN 0.15 ELSE 0 END)::DOUBLE + (CASE WHEN same AND gap > 0.12 * height THEN -0.15 ELSE 0 END)::DOUBLE
  + (CASE WHEN lt <> '' AND NOT {S.rlike('lt', T.SENTENCE_END)} THEN 0.35 ELSE 0 END)::DOUBLE + (CASE WHEN lt <> '' AND {S.rlike('lt', T.DANGLING_END)} THEN 0.15 ELSE 0 END)::DOUBLE
  + (CASE WHEN regexp_matches(rt, '^\\p{{Ll}}') THEN 0.25 ELSE 0 END)::DOUBLE + (CASE WHEN {S.rlike('rt', T.CONNECTIVE_START)} THEN 0.10 ELSE 0 END)::DOUBLE
  + (CASE WHEN lt <> '' AND {S.rlike('lt', T.SENTENCE_END)} AND regexp_matches(rt, '^\\p{{Lu}}') THEN -0.20 ELSE 0 END)::DOUBLE + (CASE WHEN block_type IN ('equation', 'table') THEN 0.10 ELSE 0 END)::DOUBLE AS raw FROM t),
z AS (SELECT document_id, block_id, reading_order, block_type, p_id, hard_stop, CASE WHEN hard_stop THEN 0.0::DOUBLE ELSE round(greatest(0.0::DOUBLE, least(1.0::DOUBLE, raw)), 6) END AS score FROM s)"""


@query(f"WITH {_SCORE} SELECT document_id, block_id AS row_id, p_id AS previous_id, hard_stop, score FROM z")
def q_join_scores(spark, sf):
    """STR-5, STR-6, STR-7: does a block go on with what the one before it began?"""
    return scored(spark, sf).select("document_id", "row_id", "previous_id", "hard_stop", "score")


@query(f"""WITH {_SCORE}, k AS (SELECT *, block_type IN ('question', 'worked_example') AS anchor, block_type IN ('question', 'worked_example') OR hard_stop OR score < 0.55 AS brk FROM z),
i AS (SELECT *, count(*) FILTER (brk) OVER (PARTITION BY document_id ORDER BY reading_order) AS isl FROM k),
r AS (SELECT *, row_number() OVER w - 1 AS seg, first_value(block_id) OVER w AS head, first_value(anchor AND brk) OVER w AS ok FROM i WINDOW w AS (PARTITION BY document_id, isl ORDER BY reading_order))
SELECT document_id, head AS anchor_id, CAST(seg AS INTEGER) AS segment, block_id AS row_id, CASE WHEN seg = 0 THEN 'stem' ELSE 'continuation' END AS role FROM r WHERE ok AND seg < 12""")
def q_spans(spark, sf):
    """WIN-9, JON-8, REC-1: blocks of each question."""
    return reconstruct.spans(scored(spark, sf), ["document_id"], F.col("block_type").isin("question", "worked_example"))


@query(f"WITH {_SCORE} SELECT document_id, count(*) AS n_ambiguous FROM z WHERE NOT hard_stop AND score BETWEEN 0.4 AND 0.7 GROUP BY ALL")
def q_ambiguous_pairs(spark, sf):
    """REC-2: pairs that rules alone don't settle."""
    return reconstruct.ambiguous_pairs(scored(spark, sf), ["document_id"])


def texts(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").filter("text is not null").select("doc_id", "text")


@query()
def q_subparts(spark, sf):
    """STR-10..STR-13: runs of parts inside one text."""
    parts = reconstruct.subparts(texts(spark, sf), "doc_id", "text")
    return parts.select("doc_id", F.posexplode("marks").alias("ix", "m")).select("doc_id", "ix", "m.start", "m.label")


@query()
def q_split_inward(spark, sf):
    """STR-15, STR-16, DIS-4, DIS-5: texts cut into stem, parts and answer."""
    return reconstruct.split_inward(texts(spark, sf), "doc_id", "text")


def _segments(c: str, pattern: str) -> str:
    """The text cut before every match of a pattern with one group."""
    return f"string_split(regexp_replace(translate(coalesce({c}, ''), chr(1), ''), {S.lit(pattern)}, chr(1) || '\\1', 'g'), chr(1))"


def _option_list(pattern: str) -> str:
    head = S.lit("^" + pattern)
    own = rf"regexp_replace(regexp_replace(x, {head}, ''), '^[ .:\n\t]+|[ .:\n\t]+$', '', 'g')"
    own = f"trim(regexp_replace({own}, '(?i)\\s*\\((Remember|Understand|Apply|Analyse|Analyze|Evaluate|Create)\\)\\s*\\d*\\s*$', ''), ' ')"
    return f"list_transform(list_filter({_segments('item', pattern)}, lambda x: regexp_matches(x, {head})), lambda x: {{'k': lower(regexp_extract(x, '^\\(\\s*([a-zA-Z]+)\\s*\\)', 1)), 't': substr({own}, 1, 200)}})"


_LETTERS, _ROMANS = r"(\(\s*[a-d]\s*\))", rf"(\(\s*(?i:{T.ROMAN})\s*\))"
_FITS = "len({0}) >= 2 AND list_sum(list_transform({0}, lambda x: length(x.t))) / len({0}) < 160"


@query(f"""WITH sg AS (SELECT doc_id, {_segments('text', chr(40) + chr(10) + chr(92) + 'd{1,3}' + chr(92) + '. )')} AS l FROM documents WHERE text IS NOT NULL),
it AS (SELECT doc_id || ':' || (i - 1) AS item_id, l[i] AS item FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM sg)),
op AS (SELECT item_id, {_option_list(_LETTERS)} AS a, {_option_list(_ROMANS)} AS b FROM it),
ch AS (SELECT item_id, CASE WHEN {_FITS.format('a')} THEN a WHEN {_FITS.format('b')} THEN b END AS o FROM op)
SELECT item_id, CAST(i AS INTEGER) AS ix, o[i + 1].k AS opt_key, o[i + 1].t AS opt_text FROM (SELECT item_id, o, unnest(range(len(o))) AS i FROM ch WHERE o IS NOT NULL)""")
def q_options(spark, sf):
    """STR-14, STR-20, STR-21: options of the numbered items."""
    items = texts(spark, sf).select("doc_id", F.posexplode(T.marker_segments("text", r"(\n\d{1,3}\. )")).alias("ix", "s")).select(F.concat_ws(":", "doc_id", "ix").alias("item_id"), F.col("s.text").alias("item"))
    return reconstruct.options(items, "item_id", "item")


@query(f"""WITH s AS (SELECT doc_id, {_segments('text', T.INLINE_MARKER)} AS l FROM documents WHERE text IS NOT NULL), m AS (SELECT doc_id, CASE WHEN l[1] = '' AND len(l) > 1 THEN l[2:] ELSE l END AS l FROM s),
p AS (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM m WHERE len(l) > 1), o AS (SELECT *, coalesce(list_sum(list_transform(l[1:i - 1], lambda x: length(x))), 0) AS a, lower(l[i]) AS low FROM p)
SELECT doc_id, CAST(i - 1 AS INTEGER) AS segment, CASE WHEN i = 1 THEN 'question' WHEN starts_with(low, 'expl') THEN 'explanation' WHEN starts_with(low, 'sol') THEN 'solution' ELSE 'answer' END AS role, CAST(a AS INTEGER) AS start, CAST(a + length(l[i]) AS INTEGER) AS "end" FROM o""")
def q_inline_segments(spark, sf):
    """STR-17: questions and answers inside one text."""
    return reconstruct.inline_segments(texts(spark, sf), "doc_id", "text")


@query(f"SELECT doc_id, CAST(length(split_part(regexp_replace(text, {S.lit(T.ANSWER_BOUNDARY)}, chr(1) || '\\0'), chr(1), 1)) AS INTEGER) AS boundary FROM documents WHERE {S.rlike('text', T.ANSWER_BOUNDARY)}")
def q_answer_boundary(spark, sf):
    """STR-8: where the answer begins."""
    return texts(spark, sf).select("doc_id", T.answer_boundary("text").alias("boundary")).filter("boundary >= 0")


def _cue(n: str) -> str:
    return S.rlike("t", T.TYPE_CUES[n])


_MCQ = f"(len(regexp_extract_all(t, '\\(\\s*[a-d]\\s*\\)')) >= 3 OR len(regexp_extract_all(t, {S.lit('(?i)' + chr(92) + '(' + chr(92) + 's*(?:' + T.ROMAN + ')' + chr(92) + 's*' + chr(92) + ')')})) >= 3 OR (contains(lower(t), 'options:') AND len(regexp_extract_all(t, '\\(\\s*[a-d]\\s*\\)')) >= 2))"
_RULES = [
    (f"{_cue('assertion')} AND {_cue('reason')}", "assertion_reason", 0.95), (_MCQ, "mcq", 0.9), (_cue("blank"), "fill_blank", 0.9), (_cue("true_false"), "true_false", 0.9), (_cue("matching"), "matching", 0.9),
    (_cue("distinguish"), "distinguish", 0.9), (_cue("ordering"), "ordering", 0.85), (f"({_cue('numeric')} OR ({_cue('unit')} AND contains(t, '?')))", "numerical", 0.85), (f"(source_type = 'activity' OR {_cue('activity')})", "activity", 0.8),
    (f"{_cue('descriptive')} AND marks >= 3", "long_answer", 0.7), (f"{_cue('descriptive')} AND marks <= 2", "short_answer", 0.7), (_cue("descriptive"), "conceptual", 0.6), ("contains(t, '?')", "conceptual", 0.4),
]


@query(f"""SELECT document_id, question_id, question_text, CASE {' '.join(f"WHEN {r} THEN '{k}'" for r, k, _ in _RULES)} ELSE 'unknown' END AS kind, CASE {' '.join(f"WHEN {r} THEN {c}::DOUBLE" for r, _, c in _RULES)} ELSE 0.0::DOUBLE END AS confidence
FROM (SELECT *, coalesce(question_text, '') AS t FROM questions)""")
def q_question_types(spark, sf):
    """STR-22: type of each question by its text."""
    q = table(spark, sf, "questions")
    no = F.lit(False)
    kind = T.question_type("question_text", no, no, no, F.col("marks"), F.coalesce(F.col("source_type") == "activity", no))
    return q.select("document_id", "question_id", "question_text", kind.alias("k")).select("document_id", "question_id", "question_text", "k.kind", "k.confidence")


@query(f"SELECT document_id, node_id, title, CASE WHEN trim(coalesce(title, ''), ' ') = '' THEN 'unknown' WHEN {S.rlike('title', T.PROSE_SECTION)} THEN 'prose' WHEN {S.rlike('title', T.QUESTION_SECTION)} THEN 'question' ELSE 'unknown' END AS section_kind FROM hierarchy")
def q_section_kinds(spark, sf):
    """STR-18: what a section holds, by its heading."""
    return table(spark, sf, "hierarchy").select("document_id", "node_id", "title", T.section_kind("title").alias("section_kind"))


@query(f"WITH {S.BLOCKS} SELECT document_id, block_id, trim(coalesce(text, ''), ' ') <> '' AND regexp_matches(regexp_replace(trim(coalesce(text, ''), ' '), {S.lit(T.QUESTION_NUMBER)}, ''), {S.lit(T.ASKING)}) AS asks FROM b")
def q_asking_blocks(spark, sf):
    """STR-19: blocks that ask or instruct."""
    return live(spark, sf).select("document_id", "block_id", T.asks("text").alias("asks"))


_TAG = "nullif(trim(tags['{0}'], ' '), '')"
_SAID = "nullif(regexp_extract(coalesce(text, ''), {0}, 1), '')"


@query(f"""WITH {S.BLOCKS}, t AS (SELECT document_id, block_id, coalesce({_TAG.format('marks')}, {_SAID.format(S.lit(T.MARKS_AFTER_BLOOM))}, {_SAID.format(S.lit(T.MARKS_BANNER))}) AS marks,
  coalesce({_TAG.format('bloom')}, lower({_SAID.format(S.lit(T.BLOOM))})) AS bloom, {_TAG.format('source')} AS source, CASE WHEN {S.rlike("coalesce(text, '')", T.TOPIC_HEADING)} THEN 1 END AS level_hint FROM b)
SELECT * FROM t WHERE coalesce(marks, bloom, source, CAST(level_hint AS VARCHAR)) IS NOT NULL""")
def q_block_tags(spark, sf):
    """PRS-11, PRS-14, PRS-15, MAP-1: tags of blocks, the parser's before the text's own."""
    return corpus.block_tags(live(spark, sf))


@query("""WITH v(t) AS (VALUES ('Why? (Apply) 3'), ('[board] (understand)'), ('[ 5 marks ] (Create)'), ('plain'), ('[portal] [board 2] [ 2 mark ]'))
SELECT t, nullif(regexp_extract(t, '(?i)\\((Remember|Understand|Apply|Analyse|Analyze|Evaluate|Create)\\)', 1), '') AS bloom,
  coalesce(nullif(regexp_extract(t, '(?i)\\((?:Remember|Understand|Apply|Analyse|Analyze|Evaluate|Create)\\)\\s*(\\d+)', 1), ''), nullif(regexp_extract(t, '(?i)\\[\\s*(\\d+)\\s*marks?\\s*\\]', 1), '')) AS marks FROM v""")
def q_tags(spark, sf):
    """PRS-14: tags that a text states (on a few made-up lines: the tables have none)."""
    rows = spark.createDataFrame([(t,) for t in ("Why? (Apply) 3", "[board] (understand)", "[ 5 marks ] (Create)", "plain", "[portal] [board 2] [ 2 mark ]")], "t string")
    marks = F.coalesce(F.nullif(F.regexp_extract("t", T.MARKS_AFTER_BLOOM, 1), F.lit("")), F.nullif(F.regexp_extract("t", T.MARKS_BANNER, 1), F.lit("")))
    return rows.select("t", F.nullif(F.regexp_extract("t", T.BLOOM, 1), F.lit("")).alias("bloom"), marks.alias("marks"))


@query("""WITH l AS (SELECT l_orderkey, l_linenumber, CAST(l_quantity AS BIGINT) AS a, l_linenumber AS m, CAST(l_quantity AS BIGINT) * l_linenumber + CASE WHEN l_orderkey % 7 = 0 THEN 50 ELSE 0 END AS c FROM lineitem)
SELECT l_orderkey, l_linenumber, CAST(a * m AS DOUBLE) AS "left", CAST(c AS DOUBLE) AS "right", abs(a * m - c) <= greatest(0.06, 0.02 * a * m) AS ok FROM l""")
def q_numeric_chain(spark, sf):
    """NUM-1, NUM-2, NUM-3: printed products against what they compute to."""
    rows = table(spark, sf, "lineitem").withColumns({"a": F.col("l_quantity").cast("bigint"), "c": F.col("l_quantity").cast("bigint") * F.col("l_linenumber") + F.when(F.col("l_orderkey") % 7 == 0, 50).otherwise(0)})
    text = F.concat(F.col("a").cast("string"), F.lit(" \\times "), F.col("l_linenumber").cast("string"), F.lit(" kg = "), F.col("c").cast("string"), F.lit(" kg"))
    return arithmetic.numeric_checks(rows, ["l_orderkey", "l_linenumber"], text).select("l_orderkey", "l_linenumber", "left", "right", "ok")


@query()
def q_formula_checks(spark, sf):
    """NUM-3: chains of equalities in the formulas and answers of the blocks."""
    b = live(spark, sf).filter("block_type in ('equation', 'solution', 'answer', 'explanation')")
    return arithmetic.numeric_checks(b, ["document_id", "block_id"], F.concat_ws(" ", "latex", "text")).select("document_id", "block_id", "step", "expr", "ok")


_TOK = "regexp_extract_all(lower(coalesce({0}, '')), '[a-z0-9]+')"


@query(f"""WITH {S.BLOCKS}, {S.QUESTIONS}, f AS (SELECT document_id, question_id, question_text, lower(trim(list_filter(source_blocks, lambda x: trim(x, ' ') <> '')[1], ' ')) AS block_id FROM q),
p AS (SELECT f.document_id, f.question_id, b.block_id, question_text AS g, b.text AS t FROM f JOIN b ON b.document_id = f.document_id AND b.block_id = f.block_id),
g AS (SELECT document_id, question_id, tok, count(*) AS n FROM (SELECT document_id, question_id, unnest({_TOK.format('g')}) AS tok FROM p) GROUP BY ALL),
h AS (SELECT document_id, question_id, tok, count(*) AS n FROM (SELECT document_id, question_id, unnest({_TOK.format('t')}) AS tok FROM p) GROUP BY ALL),
c AS (SELECT g.document_id, g.question_id, sum(g.n) AS total, sum(least(g.n, coalesce(h.n, 0))) AS found FROM g LEFT JOIN h ON h.document_id = g.document_id AND h.question_id = g.question_id AND h.tok = g.tok GROUP BY ALL)
SELECT p.document_id, p.question_id, p.block_id, coalesce(CAST(found AS DOUBLE) / total, 1.0::DOUBLE) AS coverage FROM p LEFT JOIN c USING (document_id, question_id)""")
def q_token_coverage(spark, sf):
    """AGG-24, STR-30: how much of a question its source block holds."""
    return evaluate.source_coverage(table(spark, sf, "questions"), live(spark, sf))


@query()
def q_box_matches(spark, sf):
    """JON-22, JON-23, AGG-20: boxes of text blocks matched with boxes of assets of the page, one to one."""
    b = live(spark, sf).filter("x0 is not null").select("document_id", "page_index", F.col("block_id").alias("box_id"), F.col("block_type").alias("kind"), "x0", "y0", "x1", "y1")
    return evaluate.box_matches(b.filter(F.col("kind").isin(*T.ASSET_TYPES)), b.filter(~F.col("kind").isin(*T.ASSET_TYPES)), 0.3)
