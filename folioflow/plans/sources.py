"""Queries of parsers, caches, sinks and events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.functions import geometry
from folioflow.plans import sqltext as S
from folioflow.plans.answers import _TREE, tree_of
from folioflow.plans.documents import live
from folioflow.session import table
from folioflow.sources import cache, parsers, sinks
from folioflow.streaming import jobs

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


@query("""WITH p AS (SELECT doc_id, unnest(string_split(text, chr(10) || chr(10))) AS t, generate_subscripts(string_split(text, chr(10) || chr(10)), 1) AS ix FROM documents), b AS (SELECT doc_id, CAST(ix - 1 AS INTEGER) AS ix, trim(t, ' ') AS t FROM p WHERE trim(t, ' ') <> '')
SELECT doc_id, ix, CASE WHEN starts_with(t, '#') THEN 'heading' WHEN starts_with(t, '|') THEN 'table' WHEN regexp_matches(t, '^[-*] ') THEN 'list' WHEN starts_with(t, '$$') OR starts_with(t, '\\[') THEN 'equation' ELSE 'paragraph' END AS block_type, trim(regexp_replace(t, '^#+', ''), ' ') AS text FROM b""")
def q_markdown_blocks(spark, sf):
    """PRS-8: coarse blocks of the documents."""
    return parsers.markdown_blocks(table(spark, sf, "documents").filter("text is not null"), "doc_id", "text")


@query()
def q_html_blocks(spark, sf):
    """PRS-3, PRS-4, PRS-5: elements of the documents that hold markup."""
    return parsers.html_blocks(table(spark, sf, "documents").filter("text like '%<%'"), "doc_id", "text")


@query(f"""WITH {S.BLOCKS}, r AS (SELECT document_id, block_id, unnest(string_split(text, chr(10))) AS r, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM b WHERE block_type = 'table' AND contains(text, '|')),
c AS (SELECT document_id, block_id, CAST(i - 1 AS INTEGER) AS row_ix, unnest(string_split(r, '|')) AS c, generate_subscripts(string_split(r, '|'), 1) AS j FROM r WHERE contains(r, '|')) SELECT document_id, block_id, row_ix, CAST(j - 1 AS INTEGER) AS cell_ix, trim(c, ' ') AS cell FROM c""")
def q_table_cells(spark, sf):
    """PRS-7: cells of the tables."""
    return parsers.table_cells(live(spark, sf).filter("block_type = 'table'"), ["document_id", "block_id"], "text")


def _raw(spark: SparkSession, sf: str) -> DataFrame:
    return geometry.with_corners(table(spark, sf, "raw_blocks").filter("document_id is not null and page_index is not null"))


_ROUTES = f"""r AS (SELECT document_id, page_index, text, {S.corner(0)} AS x0, {S.corner(1)} AS y0, {S.corner(2)} AS x1, {S.corner(3)} AS y1 FROM raw_blocks WHERE document_id IS NOT NULL AND page_index IS NOT NULL),
s AS (SELECT document_id, page_index, CAST(sum(length(trim(coalesce(text, ''), ' '))) AS BIGINT) AS n_chars, coalesce(sum((x1 - x0) * (y1 - y0)) FILTER (x0 IS NOT NULL AND trim(coalesce(text, ''), ' ') <> ''), 0) AS area FROM r GROUP BY ALL),
p AS (SELECT document_id, page_index, max(width) AS width, max(height) AS height FROM pages WHERE document_id IS NOT NULL AND page_index IS NOT NULL GROUP BY ALL),
rt AS (SELECT p.document_id, p.page_index, coalesce(n_chars, 0) AS n_chars, CASE WHEN coalesce(n_chars, 0) >= 100 AND coalesce(area, 0) / (width * height) >= 0.02 THEN 'text_layer' ELSE 'ocr' END AS route FROM p LEFT JOIN s USING (document_id, page_index))"""


@query(f"WITH {_ROUTES} SELECT * FROM rt")
def q_route_pages(spark, sf):
    """SRC-12, SRC-13: route of each page."""
    return parsers.route_pages(_raw(spark, sf), table(spark, sf, "pages"))


@query(f"""WITH {_ROUTES} SELECT document_id, count(*) AS n_pages, count(*) FILTER (route = 'text_layer') AS n_text_layer, bool_and(route = 'text_layer') AS born_digital, bool_or(route = 'text_layer') AND NOT bool_and(route = 'text_layer') AS mixed,
  CASE WHEN bool_and(route = 'text_layer') THEN 'layout' ELSE 'vision' END AS parser FROM rt GROUP BY ALL""")
def q_routing_summary(spark, sf):
    """SRC-14, SRC-15: documents by route and the parser that fits."""
    return parsers.routing_summary(parsers.route_pages(_raw(spark, sf), table(spark, sf, "pages")))


@query()
def q_payload_status(spark, sf):
    """PRS-16, PRS-17, PRS-18, JSN-1: what the delivered payloads are worth."""
    return table(spark, sf, "canonical_documents").select(parsers.payload_status("payload").alias("status")).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def _extractions(spark: SparkSession, sf: str) -> DataFrame:
    """One extraction per page and parser of the raw blocks: failed where a block was hardly read, cut off where a text ends in a hyphen."""
    text = F.trim(F.coalesce("text", F.lit("")))
    per = _raw(spark, sf).groupBy("document_id", "page_index", F.col("parser").alias("model")).agg(F.count_if(text != "").alias("n_blocks"), F.min("extraction_confidence").alias("least"), F.max(text.endswith("-")).alias("truncated"))
    sha = F.sha2(F.concat_ws(":", "document_id", "page_index"), 256)
    failed = F.coalesce(F.col("least") < 0.55, F.lit(False))
    return per.select(sha.alias("page_sha"), "model", F.lit("v1").alias("prompt_version"), F.when(failed, "failed").otherwise("ok").alias("status"), "truncated", F.when(failed, "unreadable").alias("failure_reason"), "n_blocks")


_EXTRACT = """x AS (SELECT sha256(document_id || ':' || page_index) AS page_sha, parser AS model, CASE WHEN coalesce(min(extraction_confidence) < 0.55, false) THEN 'failed' ELSE 'ok' END AS status, bool_or(ends_with(trim(coalesce(text, ''), ' '), '-')) AS truncated,
  CASE WHEN coalesce(min(extraction_confidence) < 0.55, false) THEN 'unreadable' END AS failure_reason, count(*) FILTER (trim(coalesce(text, ''), ' ') <> '') AS n_blocks FROM raw_blocks WHERE document_id IS NOT NULL AND page_index IS NOT NULL GROUP BY document_id, page_index, parser)"""


@query(f"WITH {_EXTRACT} SELECT page_sha, model, CASE WHEN status = 'ok' AND NOT truncated AND n_blocks > 0 THEN 'valid' WHEN status <> 'ok' THEN failure_reason WHEN truncated THEN 'truncated' ELSE 'empty' END AS outcome FROM x")
def q_cache_split(spark, sf):
    """CCH-1, CCH-3: results to keep, and failures with their reason."""
    good, bad = cache.split(_extractions(spark, sf))
    return good.select("page_sha", "model", F.lit("valid").alias("outcome")).unionByName(bad.select("page_sha", "model", F.col("failure_reason").alias("outcome")))


@query(f"WITH {_EXTRACT}, w AS (SELECT DISTINCT sha256(document_id || ':' || page_index) AS page_sha, 'vlm' AS model FROM pages WHERE document_id IS NOT NULL AND page_index IS NOT NULL) SELECT w.page_sha, x.n_blocks, x.page_sha IS NOT NULL AS from_cache FROM w LEFT JOIN x ON x.page_sha = w.page_sha AND x.model = w.model AND x.status = 'ok' AND NOT x.truncated AND x.n_blocks > 0")
def q_cache_lookup(spark, sf):
    """CCH-2, JON-27: pages with what is stored for them."""
    wanted = table(spark, sf, "pages").filter("document_id is not null and page_index is not null").select(F.sha2(F.concat_ws(":", "document_id", "page_index"), 256).alias("page_sha"), F.lit("vlm").alias("model"), F.lit("v1").alias("prompt_version")).distinct()
    return cache.lookup(wanted, _extractions(spark, sf)).select("page_sha", "n_blocks", "from_cache")


@query(f"""WITH RECURSIVE {_TREE}, r AS (SELECT q.*, len(u.path) - 1 AS depth, array_to_string(u.path, '/') AS id_path FROM q JOIN u USING (document_id, question_id)),
l AS (SELECT document_id, id_path, list_concat(list_concat([repeat('  ', depth) || coalesce(question_number, question_id) || '. ' || replace(replace(replace(coalesce(question_text, ''), '&', '&amp;'), '<', '&lt;'), '>', '&gt;'),
  repeat('  ', depth) || concat_ws(' · ', question_type, source_type) || CASE WHEN marks IS NULL THEN '' ELSE ' · ' || CASE WHEN marks = floor(marks) THEN CAST(CAST(marks AS BIGINT) AS VARCHAR) ELSE CAST(marks AS VARCHAR) END || CASE WHEN marks = 1 THEN ' mark' ELSE ' marks' END END],
  list_transform(list_filter(coalesce(options, []), lambda o: NOT contains(coalesce(question_text, ''), coalesce(o.opt_text, ''))), lambda o: repeat('  ', depth) || '(' || coalesce(o.opt_key, '?') || ') ' || replace(replace(replace(coalesce(o.opt_text, ''), '&', '&amp;'), '<', '&lt;'), '>', '&gt;'))),
  CASE WHEN answer_association.status IS NULL THEN [] ELSE [repeat('  ', depth) || CASE answer_association.status WHEN 'matched' THEN 'Answer' WHEN 'partial' THEN 'Answer (partial)' WHEN 'ambiguous' THEN 'Answer (ambiguous - needs review)' WHEN 'not_in_document' THEN 'NOT IN DOCUMENT' ELSE answer_association.status END] END) AS ls FROM r)
SELECT document_id, id_path, CAST(n - 1 AS INTEGER) AS line_no, line FROM (SELECT document_id, id_path, unnest(ls) AS line, generate_subscripts(ls, 1) AS n FROM l) WHERE line IS NOT NULL""")
def q_render_lines(spark, sf):
    """PER-5, PER-7, PER-8, STR-38: question sheets as lines."""
    return sinks.render_lines(tree_of(spark, sf), table(spark, sf, "questions"))


@query(f"""WITH RECURSIVE {_TREE} SELECT q.document_id, count(*) FILTER (len(u.path) = 1) AS n_top, count(*) AS n_all, count(*) FILTER (answer_association.status IN ('matched', 'partial')) AS n_answered, count(*) FILTER (answer_association.status = 'not_in_document') AS n_absent
FROM q JOIN u USING (document_id, question_id) GROUP BY ALL""")
def q_export_summary(spark, sf):
    """PER-6: what a sheet of questions holds."""
    return sinks.export_summary(tree_of(spark, sf), table(spark, sf, "questions"))


@query("SELECT event_type, count(*) AS n_events, sum(value) AS total FROM events GROUP BY ALL")
def q_counters(spark, sf):
    """AGG-21: run counters."""
    return jobs.counters(table(spark, sf, "events"), "event_type")


@query("SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start, event_type, count(*) AS n_events, sum(value) AS total FROM events WHERE ts IS NOT NULL GROUP BY ALL")
def q_events_tumbling(spark, sf):
    """Streaming form over the whole table: events per hour and type."""
    return jobs.counts_by_time(table(spark, sf, "events"), "ts", "event_type")


@query("""WITH e AS (SELECT user_id, ts, CASE WHEN ts < lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL '30 minutes' THEN 0 ELSE 1 END AS first_ FROM events WHERE ts IS NOT NULL), s AS (SELECT *, sum(first_) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS n FROM e)
SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL '30 minutes' AS session_end, count(*) AS n_events FROM s GROUP BY user_id, n""")
def q_events_session(spark, sf):
    """Streaming form over the whole table: sessions of users."""
    return jobs.sessions(table(spark, sf, "events"), "ts", "user_id")
