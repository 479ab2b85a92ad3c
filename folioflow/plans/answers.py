"""Queries of retrieval, answers, the graph and question trees."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.functions import text as T
from folioflow.operators import answers, discover, evaluate, graph, hierarchy, retrieval, structure
from folioflow.plans import sqltext as S
from folioflow.plans.documents import _MCQ, _SCORE, live
from folioflow.session import stage, table

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


_STOP = S.in_list(T.STOP_WORDS)
_TOKENS = "list_filter(regexp_extract_all(lower(coalesce({0}, '')), '[a-z0-9]+'), lambda x: length(x) > 1 AND x NOT IN " + _STOP + ")"


# ---------------------------------------------------------------- retrieval


@query(f"SELECT token, count(*) AS df FROM (SELECT doc_id, unnest(list_distinct({_TOKENS.format('text')})) AS token FROM documents) GROUP BY ALL")
def q_term_statistics(spark, sf):
    """AGG-22, STR-29: document frequencies of the corpus."""
    return retrieval.term_statistics(table(spark, sf, "documents"), "doc_id", "text")


@query(f"SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_tokens, avg(n) AS avg_length FROM (SELECT coalesce(len({_TOKENS.format('text')}), 0) AS n FROM documents)")
def q_corpus_size(spark, sf):
    """AGG-22: size of the corpus in documents and tokens."""
    return retrieval.corpus_size(table(spark, sf, "documents"), "doc_id", "text")


_BM25 = f"""qt AS (SELECT item_id, token, count(*) AS times FROM (SELECT item_id, unnest({_TOKENS.format('text')}) AS token FROM eval_items) GROUP BY ALL),
dt AS (SELECT doc_id, {_TOKENS.format('text')} AS t FROM documents),
sz AS (SELECT count(*) AS n, avg(len(t)) AS av FROM dt),
tf AS (SELECT doc_id, dl, token, count(*) AS tf FROM (SELECT doc_id, len(t) AS dl, unnest(t) AS token FROM dt) WHERE token IN (SELECT token FROM qt) GROUP BY ALL),
df AS (SELECT token, count(*) AS df FROM tf GROUP BY ALL),
sc AS (SELECT item_id, doc_id, sum(times * ln(1 + (n - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE)) * 2.5::DOUBLE * tf / (tf + 1.5::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * dl / av))) AS score FROM qt JOIN df USING (token) JOIN tf USING (token), sz GROUP BY ALL),
rk AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY round(score, 9) DESC, doc_id) AS rank FROM sc)"""


@query(f"WITH {_BM25} SELECT item_id, doc_id, score, score / max(score) OVER (PARTITION BY item_id) AS share, CAST(rank AS INTEGER) AS rank FROM rk WHERE rank <= 8")
def q_bm25_topk(spark, sf):
    """NUM-4, SRT-2, RET-2: the eight best documents of each evaluation item."""
    return retrieval.bm25_topk(table(spark, sf, "eval_items"), "item_id", "text", table(spark, sf, "documents"), "doc_id", "text")


_COSINE = """SELECT query_id, vec_id, similarity, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(similarity, 9) DESC, vec_id) AS rank FROM (
    SELECT a.vec_id AS query_id, z.vec_id, list_cosine_similarity(a.embedding::DOUBLE[], z.embedding::DOUBLE[]) AS similarity FROM embeddings a JOIN embeddings z ON a.vec_id <> z.vec_id WHERE a.vec_id % 20 = 0)) WHERE rank <= 8"""


@query(_COSINE)
def q_cosine_topk(spark, sf):
    """NUM-5, SRT-3, RET-3: the eight nearest vectors of every twentieth one."""
    vectors = table(spark, sf, "embeddings")
    return retrieval.cosine_topk(vectors.filter("vec_id % 20 = 0"), vectors)


_LEAF = f"""{S.QUESTIONS}, leaf AS (SELECT document_id, question_id, question_number, question_text, lower(trim(list_filter(source_blocks, lambda x: trim(x, ' ') <> '')[1], ' ')) AS block_id
  FROM q WHERE (document_id, question_id) NOT IN (SELECT (document_id, parent_id) FROM q WHERE parent_id IS NOT NULL))"""


@query(f"WITH {_LEAF} SELECT document_id, question_id, question_number, question_text, block_id FROM leaf")
def q_leaf_questions(spark, sf):
    """PRJ-11, DIS-2: questions that are asked by themselves."""
    return retrieval.leaf_questions(table(spark, sf, "questions"))


def evidence_of(spark: SparkSession, sf: str, best: int | None = answers.TOP) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Leaves, blocks and structural candidates, at least the best of each question."""
    blocks = stage(live(spark, sf), "live")
    leaves = retrieval.leaf_questions(table(spark, sf, "questions"))
    found = stage(retrieval.structural_candidates(leaves, blocks, table(spark, sf, "edges"), best), "found")
    return leaves, blocks, found


_RUN_WHAT = f"""CASE WHEN hd AND {S.rlike('t', '(?i)^' + T.ANSWER_WORD + chr(92) + 'b' + chr(92) + 's*[:.]?$')} THEN 'skip' WHEN block_type IN ('question', 'worked_example') OR coalesce(group_role, '') = 'container' OR hd THEN 'stop'
  WHEN block_type IN {S.ANSWERS} THEN 'take' WHEN block_type IN ('figure', 'image', 'diagram', 'caption', 'noise', 'banner') THEN 'skip' WHEN {S.rlike('t', T.SOURCE_TAG)} THEN 'tag' ELSE 'stop' END"""


def _run_sql(name: str, starts: str, limit: int) -> str:
    """The scan as a recursion over positions."""
    return f"""{name} AS (
  SELECT s.document_id, s.start_id, s.n, 0 AS step, 0 AS taken, 0 AS tags, false AS stopped, CAST(NULL AS VARCHAR) AS block_id FROM {starts} s
  UNION ALL
  SELECT r.document_id, r.start_id, p.n, r.step + 1, r.taken + CASE WHEN p.what = 'take' THEN 1 ELSE 0 END, r.tags + CASE WHEN p.what = 'tag' THEN 1 ELSE 0 END,
    p.what = 'stop' OR (p.what = 'tag' AND (r.taken > 0 OR r.tags > 0)), CASE WHEN p.what = 'take' THEN p.block_id END
  FROM {name} r JOIN pl p ON p.document_id = r.document_id AND p.n = r.n + 1 WHERE NOT r.stopped AND r.step < 14 AND r.taken < {limit}
)"""


_MATCH = "coalesce(lower(el.enumerator) = lower(question_number) OR starts_with(lower(trim(coalesce(el.text, ''), ' ')), '(' || lower(question_number) || ')') OR starts_with(lower(trim(coalesce(el.text, ''), ' ')), 'ans. (' || lower(question_number) || ')'), false)"
_CANDIDATES = f"""{S.BLOCKS}, {_LEAF},
pl AS (SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY reading_order) AS n, trim(coalesce(text, ''), ' ') AS t, block_type IN {S.HEADINGS} OR heading_level IS NOT NULL AS hd FROM b),
pw AS (SELECT document_id, n, block_id, {_RUN_WHAT} AS what FROM pl),
el AS (SELECT document_id, block_id, part_of_id, section_id, text, enumerator, continues_to FROM b WHERE block_type IN {S.ANSWERS}),
qq AS (SELECT l.document_id, l.question_id, l.question_number, l.block_id AS q_block, p.n, p.part_of_id AS q_part, p.section_id AS q_section FROM leaf l JOIN pl p ON p.document_id = l.document_id AND p.block_id = l.block_id),
s1 AS (SELECT DISTINCT document_id, q_block AS start_id, n FROM qq),
s2 AS (SELECT document_id, part_of_id AS start_id, max(n) AS n FROM pl WHERE part_of_id IS NOT NULL GROUP BY ALL),
{_run_sql('r1', 's1', 5).replace('JOIN pl p', 'JOIN pw p')},
{_run_sql('r2', "(SELECT * FROM s2 WHERE (document_id, start_id) IN (SELECT (document_id, q_part) FROM qq WHERE q_part IS NOT NULL))", 8).replace('JOIN pl p', 'JOIN pw p')},
c1 AS (
  SELECT qq.document_id, question_id, el.block_id, CASE WHEN coalesce(k.block_type = 'worked_example', false) THEN 'same_worked_example' WHEN {_MATCH} THEN 'same_container_enum' ELSE 'same_container' END AS relationship, CASE WHEN {_MATCH} THEN 0.95 ELSE 0.85 END::DOUBLE AS strength, 1 AS source
  FROM qq JOIN el ON el.document_id = qq.document_id AND el.part_of_id = qq.q_part LEFT JOIN b k ON k.document_id = qq.document_id AND k.block_id = qq.q_part WHERE el.block_id <> qq.q_block
  UNION ALL SELECT qq.document_id, question_id, el.block_id, CASE WHEN {_MATCH} THEN 'container_solution_enum' ELSE 'container_solution_run' END, CASE WHEN {_MATCH} THEN 0.92 ELSE 0.7 END, 2
  FROM qq JOIN r2 ON r2.document_id = qq.document_id AND r2.start_id = qq.q_part AND r2.block_id IS NOT NULL JOIN el ON el.document_id = r2.document_id AND el.block_id = r2.block_id
  UNION ALL SELECT qq.document_id, question_id, r1.block_id, 'adjacent_solution', 0.9, 3 FROM qq JOIN r1 ON r1.document_id = qq.document_id AND r1.start_id = qq.q_block AND r1.block_id IS NOT NULL
  UNION ALL SELECT qq.document_id, question_id, a.block_id, 'refers_to', 0.75, 4 FROM qq JOIN edges e ON e.document_id = qq.document_id AND e.edge_type = 'refers_to' AND lower(trim(e.src, ' ')) = qq.q_block
    JOIN b a ON a.document_id = qq.document_id AND a.block_id = lower(trim(e.dst, ' ')) AND a.block_type IN ('table', 'equation')
  UNION ALL SELECT qq.document_id, question_id, el.block_id, 'same_section', 0.6, 5 FROM qq JOIN el ON el.document_id = qq.document_id AND el.section_id = qq.q_section WHERE el.block_id <> qq.q_block
), d1 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY document_id, question_id, block_id ORDER BY strength DESC, source) AS rn FROM c1) WHERE rn = 1),
c2 AS (SELECT document_id, question_id, block_id, relationship, strength, source FROM d1
  UNION ALL SELECT d.document_id, d.question_id, t.block_id, 'continuation', greatest(0.8::DOUBLE, d.strength - 0.05::DOUBLE), 6 FROM d1 d JOIN el o ON o.document_id = d.document_id AND o.block_id = d.block_id JOIN el t ON t.document_id = d.document_id AND t.block_id = o.continues_to),
cand AS (SELECT document_id, question_id, block_id, relationship, strength FROM (SELECT *, row_number() OVER (PARTITION BY document_id, question_id, block_id ORDER BY strength DESC, source) AS rn FROM c2) WHERE rn = 1),
ev AS (SELECT * FROM (SELECT c.*, b.reading_order, b.block_type, row_number() OVER (PARTITION BY c.document_id, question_id ORDER BY strength DESC, b.reading_order, c.block_id) AS rank FROM cand c JOIN b USING (document_id, block_id)) WHERE rank <= 6)"""


@query(f"WITH RECURSIVE {_CANDIDATES} SELECT document_id, question_id, block_id, relationship, strength FROM cand")
def q_structural_candidates(spark, sf):
    """RET-1, JON-9..JON-15: answer blocks that a question's place points to."""
    return evidence_of(spark, sf, None)[2]


@query(f"WITH RECURSIVE {_CANDIDATES} SELECT document_id, question_id, block_id, relationship, strength, CAST(rank AS INTEGER) AS rank FROM ev")
def q_ranked_evidence(spark, sf):
    """WIN-13, RET-6: the six strongest candidates of each question."""
    _, blocks, found = evidence_of(spark, sf)
    return answers.ranked(found, blocks).select("document_id", "question_id", "block_id", "relationship", "strength", "rank")


_DOMINANT = "dm AS (SELECT e.document_id, e.question_id, min(e.block_id) AS block_id, min(e.relationship) AS relationship, max(m.best) AS strength FROM ev e JOIN (SELECT document_id, question_id, max(strength) AS best FROM ev GROUP BY ALL) m USING (document_id, question_id) WHERE e.strength >= m.best - 1e-6 GROUP BY e.document_id, e.question_id HAVING count(*) = 1 AND max(m.best) >= 0.9)"


@query(f"WITH RECURSIVE {_CANDIDATES}, {_DOMINANT} SELECT * FROM dm")
def q_dominant(spark, sf):
    """WIN-14: questions with one candidate clearly ahead."""
    _, blocks, found = evidence_of(spark, sf)
    return answers.dominant(answers.ranked(found, blocks))


_ASSOC = f"""{_DOMINANT}, st AS (SELECT document_id, question_id, max(strength) AS best, count(*) AS n_candidates FROM ev GROUP BY ALL),
asc_ AS (SELECT l.document_id, l.question_id, l.block_id AS source_block, i.block_id AS inline_block, st.best, coalesce(st.n_candidates, 0) AS n_candidates, d.block_id AS sure_block, d.relationship AS rel, k.block_type AS kind, substr(coalesce(i.text, i.caption, ''), 1, 400) AS i_view, substr(coalesce(k.text, k.caption, ''), 1, 400) AS k_view FROM leaf l
  LEFT JOIN b i ON i.document_id = l.document_id AND i.block_id = l.block_id AND i.inline_answer LEFT JOIN st ON st.document_id = l.document_id AND st.question_id = l.question_id
  LEFT JOIN dm d ON d.document_id = l.document_id AND d.question_id = l.question_id LEFT JOIN b k ON k.document_id = d.document_id AND k.block_id = d.block_id),
assoc AS (SELECT document_id, question_id, source_block, CASE WHEN inline_block IS NOT NULL THEN 'matched' WHEN best IS NULL THEN 'not_in_document' WHEN sure_block IS NOT NULL THEN 'matched' ELSE 'ambiguous' END AS status,
  CASE WHEN inline_block IS NOT NULL THEN 'inline' WHEN best IS NULL THEN 'no_candidate' ELSE 'structural' END AS method, coalesce(inline_block, sure_block) AS answer_block, CASE WHEN inline_block IS NOT NULL THEN 'inline' ELSE rel END AS relationship,
  CASE WHEN inline_block IS NOT NULL THEN 'inline' WHEN sure_block IS NOT NULL THEN CASE kind WHEN 'table' THEN 'table' WHEN 'equation' THEN 'equation' ELSE 'text' END END AS answer_kind,
  (CASE WHEN inline_block IS NOT NULL THEN 0.95::DOUBLE WHEN best IS NULL THEN 0.9::DOUBLE WHEN sure_block IS NOT NULL THEN best ELSE round(best * 0.6::DOUBLE, 3) END)::DOUBLE AS final_confidence, n_candidates,
    CASE WHEN inline_block IS NOT NULL THEN i_view WHEN best IS NOT NULL AND sure_block IS NOT NULL THEN k_view END AS answer_preview FROM asc_)"""


def associations_of(spark: SparkSession, sf: str) -> DataFrame:
    leaves, blocks, found = evidence_of(spark, sf)
    return answers.associate(leaves, blocks, stage(answers.ranked(found, blocks), "evidence"))


@query(f"WITH RECURSIVE {_CANDIDATES}, {_ASSOC} SELECT * FROM assoc")
def q_associations(spark, sf):
    """ASC-1, ASC-4, STR-36: one decision per question."""
    return associations_of(spark, sf)


@query(f"WITH RECURSIVE {_CANDIDATES}, {_ASSOC} SELECT dimension, value, count(*) AS n FROM (SELECT 'status' AS dimension, status AS value FROM assoc UNION ALL SELECT 'method', method FROM assoc UNION ALL SELECT 'answer_kind', coalesce(answer_kind, 'none') FROM assoc) GROUP BY ALL")
def q_association_counts(spark, sf):
    """AGG-14, AGG-17: associations by status, method and kind."""
    return answers.association_counts(associations_of(spark, sf))


@query(f"WITH RECURSIVE {_CANDIDATES}, {_ASSOC} SELECT DISTINCT document_id, source_block AS src, answer_block AS dst, question_id, relationship, final_confidence FROM assoc WHERE status = 'matched' AND answer_block IS NOT NULL AND source_block IS NOT NULL AND answer_block <> source_block")
def q_answered_by(spark, sf):
    """ASC-5, VAL-7: edges from questions to answers."""
    return answers.answered_by(associations_of(spark, sf))


@query(f"""WITH {_BM25}, le AS (SELECT item_id AS query_id, doc_id AS block_id, score / max(score) OVER (PARTITION BY item_id) AS score FROM rk WHERE rank <= 8),
se AS (SELECT query_id + 7001 AS query_id, vec_id AS block_id, greatest(0.0::DOUBLE, similarity) AS score FROM ({_COSINE})),
st AS (SELECT i.item_id AS query_id, d.block_id, 0.6::DOUBLE AS strength FROM eval_items i JOIN (SELECT subject, min(doc_id) AS block_id FROM documents GROUP BY ALL) d ON d.subject = i.subject),
a AS (SELECT query_id, block_id, strength AS st, NULL::DOUBLE AS le, NULL::DOUBLE AS se FROM st UNION ALL SELECT query_id, block_id, NULL, score, NULL FROM le UNION ALL SELECT query_id, block_id, NULL, NULL, score FROM se),
o AS (SELECT query_id, block_id, coalesce(max(st), 0) AS strength, coalesce(max(le), 0) AS lexical, coalesce(max(se), 0) AS semantic, concat_ws(',', CASE WHEN count(le) > 0 THEN 'lexical' END, CASE WHEN count(se) > 0 THEN 'semantic' END, CASE WHEN count(st) > 0 THEN 'structural' END) AS channels FROM a GROUP BY ALL),
r AS (SELECT *, CASE WHEN strength > 0 THEN strength ELSE round((0.5::DOUBLE * semantic + 0.3::DOUBLE * lexical) * 0.7::DOUBLE, 4) END AS rerank FROM o)
SELECT query_id, block_id, strength, lexical, semantic, rerank, channels, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY rerank DESC, block_id) AS rank FROM r) WHERE rank <= 6""")
def q_fused_channels(spark, sf):
    """NUM-6, SET-1, SET-2: the fusion of three channels on ids of any kind: lexical and vector hits, and for evaluation items the first document of their subject, fused."""
    items, docs = table(spark, sf, "eval_items"), table(spark, sf, "documents")
    lexical = retrieval.bm25_topk(items, "item_id", "text", docs, "doc_id", "text").select(F.col("item_id").alias("query_id"), F.col("doc_id").alias("block_id"), F.col("share").alias("score"))
    vectors = table(spark, sf, "embeddings")
    semantic = retrieval.cosine_topk(vectors.filter("vec_id % 20 = 0"), vectors).select((F.col("query_id") + 7001).alias("query_id"), F.col("vec_id").alias("block_id"), F.greatest(F.lit(0.0), F.col("similarity")).alias("score"))
    first = docs.filter("subject is not null").groupBy("subject").agg(F.min("doc_id").alias("block_id"))
    same = items.join(first, "subject").select(F.col("item_id").alias("query_id"), "block_id", F.lit(0.6).alias("strength"))
    return retrieval.fuse(same, lexical, semantic)


_OWN_TEXT = _TOKENS.format("concat_ws(' ', text, caption)")
_LEXICAL = f"""po AS (SELECT document_id, block_id, {_OWN_TEXT} AS t FROM b WHERE block_type IN {S.ANSWERS} AND coalesce(text, caption) IS NOT NULL),
ms AS (SELECT document_id, count(*) AS n, avg(len(t)) AS mean FROM po GROUP BY ALL),
ps AS (SELECT document_id, block_id, dl, token, count(*) AS tf FROM (SELECT document_id, block_id, len(t) AS dl, unnest(t) AS token FROM po) GROUP BY ALL),
pd AS (SELECT document_id, token, count(*) AS df FROM ps GROUP BY ALL),
lt AS (SELECT document_id, question_id, token, count(*) AS times FROM (SELECT document_id, question_id, unnest({_TOKENS.format('question_text')}) AS token FROM leaf) GROUP BY ALL),
ls AS (SELECT document_id, question_id, block_id, sum(times * ln(1 + (n - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE)) * 2.5::DOUBLE * tf / (tf + 1.5::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * dl / mean))) AS score
  FROM lt JOIN pd USING (document_id, token) JOIN ps USING (document_id, token) JOIN ms USING (document_id) GROUP BY ALL),
lx AS (SELECT document_id, question_id, block_id, score / max(score) OVER (PARTITION BY document_id, question_id) AS share FROM (SELECT *, row_number() OVER (PARTITION BY document_id, question_id ORDER BY round(score, 9) DESC, block_id) AS place FROM ls) WHERE place <= 8),
fa AS (SELECT document_id, question_id, block_id, coalesce(max(st), 0) AS strength, coalesce(max(le), 0) AS lexical, concat_ws(',', CASE WHEN count(le) > 0 THEN 'lexical' END, CASE WHEN count(st) > 0 THEN 'structural' END) AS channels
  FROM (SELECT document_id, question_id, block_id, strength AS st, NULL::DOUBLE AS le FROM cand UNION ALL SELECT document_id, question_id, block_id, NULL, share FROM lx) GROUP BY ALL),
fb AS (SELECT *, CASE WHEN strength > 0 THEN strength ELSE round(0.3::DOUBLE * lexical * 0.7::DOUBLE, 4) END AS rerank FROM fa),
fu AS (SELECT * FROM (SELECT fb.*, row_number() OVER (PARTITION BY fb.document_id, question_id ORDER BY rerank DESC, b.reading_order, fb.block_id) AS rank FROM fb JOIN b ON b.document_id = fb.document_id AND b.block_id = fb.block_id) WHERE rank <= 6)"""


@query(f"""WITH RECURSIVE {_CANDIDATES}, {_LEXICAL} SELECT fu.document_id, fu.question_id, fu.block_id, coalesce(cand.relationship, 'none') AS relationship,
  CASE WHEN cand.relationship IS NOT NULL OR (o.block_id IS NOT NULL AND o.section_id = b.section_id) THEN 'in_scope' ELSE 'cross_section' END AS scope, fu.strength, lexical, rerank, channels, CAST(fu.rank AS INTEGER) AS rank
FROM fu JOIN b ON b.document_id = fu.document_id AND b.block_id = fu.block_id LEFT JOIN cand ON cand.document_id = fu.document_id AND cand.question_id = fu.question_id AND cand.block_id = fu.block_id
  LEFT JOIN leaf ON leaf.document_id = fu.document_id AND leaf.question_id = fu.question_id LEFT JOIN b o ON o.document_id = leaf.document_id AND o.block_id = leaf.block_id""")
def q_fused_evidence(spark, sf):
    """JON-10, RET-2, RET-6, NUM-6: candidates of each question by place and by BM25 over its document's answer blocks, fused."""
    leaves, blocks, found = evidence_of(spark, sf)
    return retrieval.fused_evidence(leaves, blocks, found, retrieval.block_bm25(leaves, blocks))


@query(f"""WITH {S.BLOCKS}, l AS (SELECT *, lag(block_id) OVER w AS prev_id, lead(block_id) OVER w AS next_id FROM b WINDOW w AS (PARTITION BY document_id ORDER BY reading_order)), w AS (SELECT * FROM l WHERE block_type = 'question'),
h AS (SELECT document_id, block_id, prev_id AS near_id, 0.9 AS score FROM w UNION ALL SELECT document_id, block_id, next_id, 0.9 FROM w UNION ALL SELECT w.document_id, w.block_id, o.block_id, 0.7 FROM w JOIN b o ON o.document_id = w.document_id AND o.section_id = w.section_id UNION ALL SELECT document_id, block_id, part_of_id, 0.6 FROM w),
m AS (SELECT document_id, block_id, near_id, max(score)::DOUBLE AS score FROM h WHERE near_id IS NOT NULL AND near_id <> block_id GROUP BY ALL)
SELECT document_id, block_id, near_id, score, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY document_id, block_id ORDER BY score DESC, near_id) AS rank FROM m) WHERE rank <= 10""")
def q_structural_neighbours(spark, sf):
    """WIN-16, SRT-4: the ten blocks nearest to each question block."""
    b = structure.linked(live(spark, sf)).withColumn("parent_block", F.col("part_of_id"))
    return retrieval.structural_neighbours(b, b.filter("block_type = 'question'").select("document_id", "block_id"))


# ---------------------------------------------------------------- validation

_STORED = f"""st_ AS (SELECT document_id, question_id, lower(trim(list_filter(source_blocks, lambda x: trim(x, ' ') <> '')[1], ' ')) AS source_block, answer_association.status AS status, answer_association.method AS method, answer_association.answer_kind AS answer_kind,
  answer_association.llm_confidence AS llm_confidence, coalesce(list_distinct(list_filter(list_transform(answer_association.answer_block_ids, lambda x: lower(trim(x, ' '))), lambda x: x <> '')), []) AS ids FROM q WHERE answer_association IS NOT NULL),
ch AS (SELECT document_id, question_id, status, method, answer_kind, source_block, unnest(ids) AS block_id FROM st_)"""
_FINDINGS = f"""{_STORED}, rw AS (SELECT c.document_id, c.question_id, c.block_id, k.block_id IS NOT NULL AS there, k.page_index, k.block_type, coalesce(k.text, k.caption) AS body, e.strength, s.block_id IS NOT NULL AND k.section_id IS DISTINCT FROM s.section_id AND k.part_of_id IS DISTINCT FROM s.part_of_id AS apart
  FROM ch c LEFT JOIN b k ON k.document_id = c.document_id AND k.block_id = c.block_id LEFT JOIN b s ON s.document_id = c.document_id AND s.block_id = c.source_block LEFT JOIN ev e ON e.document_id = c.document_id AND e.question_id = c.question_id AND e.block_id = c.block_id
  WHERE status IN ('matched', 'partial') AND method <> 'inline'),
mine AS (SELECT document_id, question_id, coalesce(max(strength), 0) AS own, max(trim(coalesce(body, ''), ' ')) AS body FROM rw GROUP BY ALL),
riv AS (SELECT e.document_id, e.question_id, max(strength) AS rival FROM ev e WHERE NOT EXISTS (SELECT 1 FROM ch c WHERE c.document_id = e.document_id AND c.question_id = e.question_id AND c.block_id = e.block_id AND c.status IN ('matched', 'partial') AND c.method <> 'inline') GROUP BY ALL),
fi AS (SELECT document_id, question_id, 'qa_dangling_answer' AS "check", 'error' AS severity FROM rw WHERE NOT there UNION SELECT document_id, question_id, 'qa_out_of_scope', 'error' FROM rw WHERE there AND strength IS NULL
  UNION SELECT document_id, question_id, 'qa_answer_is_question', 'error' FROM rw WHERE block_type = 'question' UNION SELECT document_id, question_id, 'qa_cross_section', 'warn' FROM rw WHERE there AND apart UNION SELECT document_id, question_id, 'qa_answer_no_provenance', 'warn' FROM rw WHERE there AND page_index IS NULL
  UNION SELECT document_id, question_id, 'qa_competing_stronger', 'warn' FROM mine JOIN riv USING (document_id, question_id) WHERE rival > own + 0.05::DOUBLE
  UNION SELECT document_id, question_id, 'qa_unsupported', 'error' FROM st_ WHERE status IN ('matched', 'partial') AND method <> 'inline' AND (document_id, question_id) NOT IN (SELECT (document_id, question_id) FROM mine WHERE body <> '')
  UNION SELECT c.document_id, c.question_id, 'mm_asset_out_of_context', 'warn' FROM ch c JOIN b k ON k.document_id = c.document_id AND k.block_id = c.block_id AND k.block_type IN ('table', 'equation') LEFT JOIN b s ON s.document_id = c.document_id AND s.block_id = c.source_block
    WHERE c.answer_kind IN ('table', 'equation') AND (s.block_id IS NULL OR (k.section_id IS DISTINCT FROM s.section_id AND k.part_of_id IS DISTINCT FROM s.part_of_id))
      AND k.part_of_id IS DISTINCT FROM c.source_block AND NOT EXISTS (SELECT 1 FROM ev e WHERE e.document_id = c.document_id AND e.question_id = c.question_id AND e.block_id = c.block_id AND e.relationship = 'refers_to'))"""


def findings_of(spark: SparkSession, sf: str) -> tuple[DataFrame, ...]:
    leaves, blocks, found = evidence_of(spark, sf)
    evidence = stage(answers.ranked(found, blocks), "evidence")
    stored = stage(answers.stored_answers(table(spark, sf, "questions")), "stored")
    return leaves, blocks, evidence, stored, stage(answers.findings(stored, blocks, evidence), "findings"), fused_of(leaves, blocks, found)


@query(f"WITH RECURSIVE {_CANDIDATES}, {_FINDINGS} SELECT * FROM fi")
def q_findings(spark, sf):
    """VAL-1, VAL-2, JON-25: what is wrong with the answers that questions carry."""
    return findings_of(spark, sf)[4]


_BASE = "CASE rel2 " + " ".join(f"WHEN '{k}' THEN {v}::DOUBLE" for k, v in answers.RELIABILITY.items()) + f" ELSE {answers.UNKNOWN_RELIABILITY}::DOUBLE END"
_GATE = f"""{_FINDINGS}, {_LEXICAL}, cr AS (SELECT e.document_id, e.question_id, arg_min(e.relationship, e.rank) AS relationship FROM ev e JOIN ch c ON c.document_id = e.document_id AND c.question_id = e.question_id AND c.block_id = e.block_id GROUP BY ALL),
rv AS (SELECT e.document_id, e.question_id, max(strength) AS rival FROM ev e WHERE NOT EXISTS (SELECT 1 FROM ch c WHERE c.document_id = e.document_id AND c.question_id = e.question_id AND c.block_id = e.block_id) GROUP BY ALL),
co AS (SELECT c.document_id, c.question_id, max(CASE WHEN contains(channels, 'lexical') THEN 0.02 ELSE 0 END)::DOUBLE AS bonus FROM fu JOIN ch c ON c.document_id = fu.document_id AND c.question_id = fu.question_id AND c.block_id = fu.block_id GROUP BY ALL),
g1 AS (SELECT s.*, CASE WHEN s.method = 'inline' THEN 'inline' ELSE coalesce(cr.relationship, t1.relationship) END AS rel2, coalesce(co.bonus, 0) AS bonus, coalesce(rv.rival, 0) AS rival, EXISTS (SELECT 1 FROM fi WHERE fi.document_id = s.document_id AND fi.question_id = s.question_id AND severity = 'error') AS bad
  FROM st_ s LEFT JOIN co ON co.document_id = s.document_id AND co.question_id = s.question_id LEFT JOIN ev t1 ON t1.document_id = s.document_id AND t1.question_id = s.question_id AND t1.rank = 1 LEFT JOIN cr ON cr.document_id = s.document_id AND cr.question_id = s.question_id LEFT JOIN rv ON rv.document_id = s.document_id AND rv.question_id = s.question_id),
g2 AS (SELECT *, {_BASE} AS base FROM g1),
g3 AS (SELECT *, CASE WHEN status = 'not_in_document' THEN CASE WHEN method = 'no_candidate' THEN 0.9::DOUBLE ELSE 0.65::DOUBLE END WHEN status = 'ambiguous' OR len(ids) = 0 THEN 0.4::DOUBLE
  ELSE round(greatest(0.0::DOUBLE, least(1.0::DOUBLE, base + bonus + CASE WHEN base - rival >= 0.1::DOUBLE THEN 0::DOUBLE ELSE -1.5::DOUBLE * (0.1::DOUBLE - (base - rival)) END)), 3) END AS sysc FROM g2),
g4 AS (SELECT *, round(CASE WHEN method IN ('inline', 'structural') OR status = 'not_in_document' OR status = 'ambiguous' OR len(ids) = 0 THEN sysc ELSE 0.6::DOUBLE * sysc + 0.4::DOUBLE * coalesce(llm_confidence, sysc) END, 3) AS cal FROM g3),
g5 AS (SELECT *, CASE WHEN bad THEN 'low' WHEN status = 'not_in_document' THEN CASE WHEN cal >= 0.8::DOUBLE THEN 'high' ELSE 'medium' END WHEN cal >= 0.85::DOUBLE THEN 'high' WHEN cal >= 0.6::DOUBLE THEN 'medium' ELSE 'low' END AS tier FROM g4),
gt AS (SELECT document_id, question_id, status, sysc AS system, llm_confidence AS model, cal AS calibrated, tier, CASE WHEN bad THEN 'escalate' WHEN tier = 'high' THEN 'accept' WHEN tier = 'medium' THEN 'escalate' ELSE 'abstain' END AS action FROM g5)"""


def fused_of(leaves: DataFrame, blocks: DataFrame, found: DataFrame) -> DataFrame:
    return stage(retrieval.fused_evidence(leaves, blocks, found, retrieval.block_bm25(leaves, blocks)), "fused")


def gated_of(spark: SparkSession, sf: str) -> DataFrame:
    leaves, blocks, evidence, stored, found, fused = findings_of(spark, sf)
    return answers.calibrated(stored, evidence, found, fused)


@query(f"WITH RECURSIVE {_CANDIDATES}, {_GATE} SELECT * FROM gt")
def q_calibrated(spark, sf):
    """NUM-7, NUM-8, NUM-9, WIN-15, VAL-3: confidences and gate of the stored answers."""
    return gated_of(spark, sf)


@query(f"WITH RECURSIVE {_CANDIDATES}, {_GATE} SELECT tier, action, count(*) AS n, count(*) FILTER (calibrated >= 0.85::DOUBLE) AS n_high, count(*) FILTER (calibrated >= 0.6::DOUBLE AND calibrated < 0.85::DOUBLE) AS n_middle, count(*) FILTER (calibrated < 0.6::DOUBLE) AS n_low FROM gt GROUP BY ALL")
def q_gate_counts(spark, sf):
    """AGG-15, AGG-16: answers per tier and band."""
    return answers.gate_counts(gated_of(spark, sf))


@query(f"WITH RECURSIVE {_CANDIDATES}, {_GATE} SELECT document_id, question_id, CAST(place AS INTEGER) AS place FROM (SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY question_id) AS place FROM gt WHERE action = 'escalate') WHERE place <= 20")
def q_escalation_queue(spark, sf):
    """SRT-5, VAL-5: the first twenty questions to escalate in each document."""
    return answers.escalation_queue(gated_of(spark, sf))


@query(f"WITH RECURSIVE {_CANDIDATES}, {_GATE} SELECT count(*) AS n_answers, count(*) FILTER (action = 'accept') AS n_accepted, count(*) FILTER (action = 'escalate') AS n_escalated, count(*) FILTER (action = 'abstain' OR status = 'ambiguous') AS n_abstained, round(100.0::DOUBLE * count(*) FILTER (action = 'escalate') / greatest(count(*), 1), 1) AS retry_rate_pct FROM gt")
def q_gate_rates(spark, sf):
    """AGG-15: accepted, escalated and abstained answers and the retry rate."""
    return answers.gate_rates(gated_of(spark, sf))


@query(f"WITH RECURSIVE {_CANDIDATES}, {_GATE} SELECT document_id, question_id, 'gate_' || action AS flag, 'gate' AS severity FROM gt WHERE action <> 'accept' UNION ALL SELECT document_id, question_id, \"check\", severity FROM fi")
def q_flags(spark, sf):
    """PRJ-10: findings and gate items for a reviewer."""
    leaves, blocks, evidence, stored, found, fused = findings_of(spark, sf)
    return answers.flags(answers.calibrated(stored, evidence, found, fused), found)


@query("SELECT document_id, question_id, CASE WHEN answer_association.status IN ('matched', 'partial') THEN 'answered' ELSE 'not_found' END AS part FROM (SELECT *, row_number() OVER (PARTITION BY document_id, question_id) AS rn FROM questions WHERE document_id IS NOT NULL AND question_id IS NOT NULL) WHERE rn = 1 AND answer_association IS NOT NULL")
def q_answer_partition(spark, sf):
    """PRJ-9: questions that have an answer and those that have none."""
    s = answers.stored_answers(table(spark, sf, "questions"))
    return s.select("document_id", "question_id", F.when(F.col("status").isin("matched", "partial"), "answered").otherwise("not_found").alias("part"))


@query(f"""WITH RECURSIVE {_CANDIDATES}, {_ASSOC}, {_STORED}, vd AS (SELECT a.document_id, a.question_id, a.source_block, s.status AS said, s.llm_confidence, st.best, list_sort(list_filter(s.ids, lambda x: list_contains(sc.ids, x))) AS valid
  FROM assoc a JOIN st_ s ON s.document_id = a.document_id AND s.question_id = a.question_id JOIN st ON st.document_id = a.document_id AND st.question_id = a.question_id
  JOIN (SELECT document_id, question_id, list(block_id) AS ids FROM ev GROUP BY ALL) sc ON sc.document_id = a.document_id AND sc.question_id = a.question_id WHERE a.status = 'ambiguous' AND s.llm_confidence IS NOT NULL)
SELECT document_id, question_id, source_block, CASE WHEN said = 'matched' AND len(valid) = 0 THEN 'ambiguous' ELSE said END AS status, 'llm_adjudicated' AS method, CASE WHEN said IN ('matched', 'partial') THEN array_to_string(valid, ',') ELSE '' END AS answer_blocks,
  round(0.5::DOUBLE * CASE WHEN said IN ('matched', 'partial') AND len(valid) > 0 THEN best ELSE 0 END + 0.5::DOUBLE * llm_confidence, 3) AS final_confidence FROM vd""")
def q_adjudicated(spark, sf):
    """ASC-4, JON-28, SET-5: open questions with the verdicts that the question table carries, as far as they choose candidates."""
    leaves, blocks, found = evidence_of(spark, sf)
    evidence = stage(answers.ranked(found, blocks), "evidence")
    return answers.adjudicated(answers.associate(leaves, blocks, evidence), evidence, answers.stored_answers(table(spark, sf, "questions")))


@query(f"""WITH {S.QUESTIONS}, {_STORED} SELECT DISTINCT c.document_id, source_block AS src, c.block_id AS dst FROM ch c WHERE status IN ('matched', 'partial') AND source_block <> c.block_id
  AND NOT EXISTS (SELECT 1 FROM edges e WHERE e.edge_type = 'answered_by' AND e.document_id = c.document_id AND lower(trim(e.src, ' ')) = c.source_block AND lower(trim(e.dst, ' ')) = c.block_id)""")
def q_recovered_edges(spark, sf):
    """JON-26, VAL-7: answers that questions carry and the stored graph lacks."""
    return answers.recovered_edges(answers.stored_answers(table(spark, sf, "questions")), table(spark, sf, "edges"))


@query(f"""WITH RECURSIVE {_CANDIDATES}, {_GATE}, lq AS (SELECT g.document_id, g.question_id, '(' || lower(l.question_number) || ')' AS lab FROM gt g JOIN leaf l ON l.document_id = g.document_id AND l.question_id = g.question_id WHERE g.action = 'escalate' AND g.status = 'not_in_document' AND l.question_number IS NOT NULL)
SELECT document_id, question_id, arg_min(block_id, (rank, block_id)) AS block_id FROM (SELECT q.document_id, q.question_id, e.block_id, e.rank FROM lq q JOIN ev e ON e.document_id = q.document_id AND e.question_id = q.question_id JOIN b k ON k.document_id = e.document_id AND k.block_id = e.block_id
  WHERE contains(lower(regexp_replace(coalesce(k.text, ''), '\\(\\s*([A-Za-z0-9.]+)\\s*\\)', '(\\1)', 'g')), q.lab)) GROUP BY ALL""")
def q_recoverable(spark, sf):
    """VAL-4: answers reported absent that stand within reach."""
    leaves, blocks, evidence, stored, found, fused = findings_of(spark, sf)
    return answers.recoverable(answers.calibrated(stored, evidence, found, fused), leaves, evidence, blocks)


@query(f"WITH RECURSIVE {_CANDIDATES}, {_STORED} SELECT DISTINCT c.document_id, c.question_id, c.block_id FROM ch c WHERE status IN ('matched', 'partial') AND method <> 'inline' AND NOT EXISTS (SELECT 1 FROM ev e WHERE e.document_id = c.document_id AND e.question_id = c.question_id AND e.block_id = c.block_id)")
def q_false_associations(spark, sf):
    """JON-20, AGG-17: claimed answers without structural support."""
    _, _, evidence, stored, *_ = findings_of(spark, sf)
    return answers.false_associations(stored, evidence)


# ---------------------------------------------------------------- graph

_NODES = """nd AS (SELECT DISTINCT document_id, document_id AS node_id, 'document' AS kind, 'document' AS node_type, document_id AS label FROM (SELECT document_id FROM b UNION ALL SELECT document_id FROM hierarchy UNION ALL SELECT document_id FROM pages) WHERE document_id IS NOT NULL
  UNION ALL SELECT document_id, 'page_' || page_index, 'page', 'page', 'p.' || coalesce(max(printed_page), page_index) FROM pages WHERE document_id IS NOT NULL AND page_index IS NOT NULL GROUP BY document_id, page_index
  UNION ALL SELECT document_id, node_id, CASE WHEN min(kind) IN ('topic', 'chapter') THEN 'topic' ELSE 'section' END, coalesce(min(kind), 'section'), min(title) FROM hierarchy WHERE document_id IS NOT NULL AND node_id <> '' GROUP BY document_id, node_id
  UNION ALL SELECT document_id, block_id, 'block', block_type, substr(coalesce(text, caption, block_type), 1, 80) FROM b)"""


@query(f"WITH {S.BLOCKS}, {_NODES} SELECT * FROM nd")
def q_graph_nodes(spark, sf):
    """GRF-1: nodes of the document graph."""
    return graph.nodes(live(spark, sf), table(spark, sf, "hierarchy"), table(spark, sf, "pages"))


_EDGES = f"""lk AS (SELECT *, lead(block_id) OVER w AS next_id, lead(block_type) OVER w AS next_type FROM b WINDOW w AS (PARTITION BY document_id ORDER BY reading_order)),
tr AS (SELECT DISTINCT h.document_id, h.node_id, h.child FROM (SELECT document_id, node_id, unnest(children) AS child FROM hierarchy WHERE document_id IS NOT NULL AND node_id <> '') h JOIN hierarchy k ON k.document_id = h.document_id AND k.node_id = h.child WHERE h.child <> ''),
og AS (SELECT document_id, block_id, min(block_id) OVER (PARTITION BY document_id, or_group_id) AS first_id FROM b WHERE or_group_id IS NOT NULL),
ed AS (SELECT document_id, node_id AS src, child AS dst, 'contains' AS edge_type FROM tr UNION SELECT document_id, child, node_id, 'child_of' FROM tr UNION SELECT document_id, section_id, block_id, 'contains' FROM b WHERE section_id IS NOT NULL
  UNION SELECT document_id, block_id, section_id, 'child_of' FROM b WHERE section_id IS NOT NULL UNION SELECT document_id, block_id, 'page_' || page_index, 'located_on' FROM b WHERE page_index IS NOT NULL
  UNION SELECT document_id, block_id, 'page_' || page_index, 'derived_from' FROM b WHERE page_index IS NOT NULL AND block_type IN {S.ASSETS} UNION SELECT document_id, block_id, next_id, 'reading_next' FROM lk WHERE next_id IS NOT NULL
  UNION SELECT document_id, block_id, next_id, 'has_caption' FROM lk WHERE block_type IN {S.ASSETS} AND next_type = 'caption' UNION SELECT b.document_id, b.block_id, b.part_of_id, 'part_of' FROM b JOIN b t ON t.document_id = b.document_id AND t.block_id = b.part_of_id
  UNION SELECT b.document_id, b.block_id, b.continues_to, 'continues' FROM b JOIN b t ON t.document_id = b.document_id AND t.block_id = b.continues_to
  UNION SELECT document_id, block_id, first_id, 'or_alternative' FROM og WHERE block_id <> first_id UNION SELECT document_id, first_id, block_id, 'or_alternative' FROM og WHERE block_id <> first_id)"""


def edges_of(spark: SparkSession, sf: str) -> DataFrame:
    return graph.edges(structure.linked(live(spark, sf)), table(spark, sf, "hierarchy"))


@query(f"WITH {S.BLOCKS}, {_EDGES} SELECT * FROM ed")
def q_graph_edges(spark, sf):
    """GRF-1, GRF-2, GRF-3, JON-6, JON-16, JON-17, SET-6: edges of the document graph."""
    return edges_of(spark, sf)


@query(f"WITH {S.BLOCKS}, {_EDGES} SELECT edge_type, count(*) AS n_edges FROM ed GROUP BY ALL")
def q_edge_counts(spark, sf):
    """AGG-11, GRF-4: edges per type."""
    return graph.edge_counts(edges_of(spark, sf))


@query("SELECT edge_type, count(*) AS n_edges FROM edges GROUP BY ALL")
def q_stored_edge_counts(spark, sf):
    """GRF-4: edges per type of the stored graph."""
    return graph.edge_counts(table(spark, sf, "edges"))


@query(f"WITH {S.BLOCKS}, {_EDGES} SELECT DISTINCT document_id, src AS node_id, dst AS near_id, edge_type FROM ed WHERE edge_type = 'part_of' AND (document_id, src) IN (SELECT (document_id, block_id) FROM b WHERE block_type = 'answer')")
def q_graph_neighbours(spark, sf):
    """GRF-4: what answer blocks are part of."""
    wanted = live(spark, sf).filter("block_type = 'answer'").select("document_id", F.col("block_id").alias("node_id"))
    return graph.neighbours(edges_of(spark, sf), wanted, "part_of")


@query(f"""WITH {S.BLOCKS}, {_NODES}, k AS (SELECT DISTINCT document_id, lower(node_id) AS id FROM nd), e AS (SELECT document_id, edge_type, 'src' AS side, lower(trim(src, ' ')) AS id FROM edges UNION ALL SELECT document_id, edge_type, 'dst', lower(trim(dst, ' ')) FROM edges)
SELECT edge_type, side, count(*) AS n_dangling, count(DISTINCT (document_id, id)) AS n_targets FROM e WHERE id <> '' AND NOT EXISTS (SELECT 1 FROM k WHERE k.document_id = e.document_id AND k.id = e.id) GROUP BY ALL""")
def q_dangling_edges(spark, sf):
    """JON-18: ends of stored edges that are no node."""
    return graph.dangling(table(spark, sf, "edges"), graph.nodes(live(spark, sf), table(spark, sf, "hierarchy"), table(spark, sf, "pages")))


@query("SELECT edge_type, CAST(sum(n - 1) AS BIGINT) AS surplus FROM (SELECT edge_type, count(*) AS n FROM edges GROUP BY document_id, src, dst, edge_type HAVING count(*) > 1) GROUP BY ALL")
def q_duplicate_edges(spark, sf):
    """AGG-8: surplus copies of stored edges."""
    return graph.duplicate_edges(table(spark, sf, "edges"))


@query(f"WITH {S.BLOCKS} SELECT document_id, block_id FROM b WHERE group_role = 'container' AND NOT EXISTS (SELECT 1 FROM (SELECT document_id, lower(trim(unnest(source_blocks), ' ')) AS x FROM questions) u WHERE u.document_id = b.document_id AND u.x = b.block_id)")
def q_missed_containers(spark, sf):
    """JON-19: containers without a question."""
    return graph.missed_containers(live(spark, sf), table(spark, sf, "questions"))


# ---------------------------------------------------------------- question trees

_TREE = f"""{S.QUESTIONS}, n AS (SELECT document_id, question_id, nullif(parent_id, '') AS parent_id FROM q),
u AS (SELECT document_id, question_id, question_id AS cur, [question_id] AS path FROM n WHERE parent_id IS NULL OR (document_id, parent_id) NOT IN (SELECT (document_id, question_id) FROM n)
  UNION ALL SELECT n.document_id, n.question_id, n.question_id, list_append(u.path, n.question_id) FROM u JOIN n ON n.document_id = u.document_id AND n.parent_id = u.question_id)"""


def tree_of(spark: SparkSession, sf: str) -> DataFrame:
    q = table(spark, sf, "questions").filter("document_id is not null and question_id is not null").dropDuplicates(["document_id", "question_id"])
    links = q.select(F.lit("question").alias("tree"), "document_id", F.col("question_id").alias("node"), F.col("parent_id").alias("parent"), F.lit(True).alias("present"))
    solved = hierarchy.resolve(hierarchy.node_table(links)).filter("tree_state = 'tree'").select("document_id", F.col("node_id").alias("question_id"), "root_id", "depth", "id_path")
    alone = q.select("document_id", "question_id").join(solved, ["document_id", "question_id"], "left_anti")
    in_trees = hierarchy.node_table(links).select("document_id", F.col("node").alias("question_id"))
    alone = alone.join(in_trees, ["document_id", "question_id"], "left_anti").select("document_id", "question_id", F.col("question_id").alias("root_id"), F.lit(0).alias("depth"), F.col("question_id").alias("id_path"))
    return solved.unionByName(alone)


@query(f"WITH RECURSIVE {_TREE} SELECT document_id, question_id, path[1] AS root_id, CAST(len(path) - 1 AS INTEGER) AS depth, array_to_string(path, '/') AS id_path FROM u")
def q_question_tree(spark, sf):
    """DIS-3, PRJ-12, STR-31: questions with their path in pre-order."""
    return tree_of(spark, sf)


@query("""WITH q AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY document_id, question_id) AS rn FROM questions WHERE document_id IS NOT NULL AND question_id IS NOT NULL) WHERE rn = 1)
SELECT dimension, value, count(*) AS n FROM (SELECT 'source_type' AS dimension, coalesce(source_type, 'none') AS value FROM q UNION ALL SELECT 'question_type', coalesce(question_type, 'none') FROM q UNION ALL SELECT 'has_marks', CASE WHEN marks IS NOT NULL THEN 'yes' ELSE 'no' END FROM q
  UNION ALL SELECT 'has_options', CASE WHEN len(options) > 0 THEN 'yes' ELSE 'no' END FROM q UNION ALL SELECT 'has_answer', CASE WHEN len(answer_association.answer_block_ids) > 0 THEN 'yes' ELSE 'no' END FROM q) GROUP BY ALL""")
def q_question_counts(spark, sf):
    """AGG-12: questions by source, type, marks, options and answers."""
    return evaluate.question_counts(table(spark, sf, "questions"))


@query(f"""WITH RECURSIVE {_TREE}, {S.BLOCKS.replace('b AS', 'b AS')}, s AS (SELECT q.document_id, q.question_id, lower(trim(unnest(source_blocks), ' ')) AS block_id FROM q)
SELECT u.document_id, u.path[1] AS root_id, string_agg(DISTINCT CAST(b.page_index AS VARCHAR), ',' ORDER BY CAST(b.page_index AS VARCHAR)) AS page_list, count(DISTINCT b.page_index) AS n_pages FROM u JOIN s USING (document_id, question_id) JOIN b ON b.document_id = s.document_id AND b.block_id = s.block_id WHERE b.page_index IS NOT NULL GROUP BY ALL""")
def q_page_union(spark, sf):
    """AGG-25: pages of each question with all of its parts."""
    q = table(spark, sf, "questions").filter("document_id is not null and question_id is not null").dropDuplicates(["document_id", "question_id"])
    src = q.select("document_id", "question_id", F.explode("source_blocks").alias("x")).select("document_id", "question_id", F.lower(F.trim("x")).alias("block_id"))
    page = src.join(live(spark, sf).select("document_id", "block_id", "page_index"), ["document_id", "block_id"]).filter("page_index is not null")
    rooted = page.join(tree_of(spark, sf).select("document_id", "question_id", "root_id"), ["document_id", "question_id"])
    return rooted.groupBy("document_id", "root_id").agg(F.array_join(F.array_sort(F.collect_set(F.col("page_index").cast("string"))), ",").alias("page_list"), F.countDistinct("page_index").alias("n_pages"))


# ---------------------------------------------------------------- discovery


def _asks(c: str) -> str:
    t = f"trim(coalesce({c}, ''), ' ')"
    return f"({t} <> '' AND regexp_matches(regexp_replace({t}, {S.lit(T.QUESTION_NUMBER)}, ''), {S.lit(T.ASKING)}))"


_ROOT_STYLE, _, _ = S.enumerator("t")
_ROOT_OWN = r"regexp_replace(regexp_replace(t, '^\s*\(?\s*[A-Za-z0-9.]{1,6}\s*[).]\s*', ''), '\W', '', 'g')"


_ROOTS = f"""ti AS (SELECT document_id, node_id AS section_id, min(title) AS title FROM hierarchy WHERE document_id IS NOT NULL AND node_id <> '' GROUP BY ALL),
pa AS (SELECT DISTINCT document_id, part_of_id AS block_id FROM b WHERE part_of_id IS NOT NULL AND group_role IN ('subpart', 'or_alternative') AND {_asks('text')}),
x AS (SELECT b.document_id, b.block_id, block_type, part_of_id, coalesce(group_role, '') AS role, coalesce(text, '') AS t, pa.block_id IS NOT NULL AS part_asks,
  CASE WHEN trim(coalesce(title, ''), ' ') = '' THEN 'unknown' WHEN {S.rlike('title', T.PROSE_SECTION)} THEN 'prose' WHEN {S.rlike('title', T.QUESTION_SECTION)} THEN 'question' ELSE 'unknown' END AS kind
  FROM b LEFT JOIN ti USING (document_id, section_id) LEFT JOIN pa ON pa.document_id = b.document_id AND pa.block_id = b.block_id),
y AS (SELECT *, {_ROOT_STYLE} AS style, block_type IN {S.in_list(discover.ASKING_TYPES)} AS asking FROM x),
rt AS (SELECT document_id, block_id, CASE WHEN block_type = 'worked_example' OR style = 'example' THEN 'worked_example' WHEN style = 'numbered' THEN 'solved_question' WHEN block_type = 'activity' THEN 'activity' WHEN block_type = 'question' THEN 'in_text' ELSE 'other' END AS source_type FROM y
WHERE (asking OR coalesce(style = 'example', false) OR kind = 'question' OR (kind = 'unknown' AND ({_asks('t')} OR part_asks))) AND NOT (style IS NOT NULL AND length({_ROOT_OWN}) < 8 AND NOT asking)
  AND (role = 'container' OR (role NOT IN ('subpart', 'sub_subpart', 'or_alternative', 'content', 'or_separator') AND asking AND part_of_id IS NULL)))"""


@query(f"WITH {S.BLOCKS}, {_ROOTS} SELECT * FROM rt")
def q_question_roots(spark, sf):
    """DIS-1, DIS-2, STR-23, STR-24, STR-25: blocks that questions start from."""
    return discover.roots(live(spark, sf), table(spark, sf, "hierarchy"))


@query(f"""WITH {S.BLOCKS}, r AS (SELECT DISTINCT document_id, lower(trim(src, ' ')) AS block_id, lower(trim(dst, ' ')) AS asset_id FROM edges WHERE edge_type = 'refers_to' UNION SELECT document_id, part_of_id, block_id FROM b WHERE part_of_id IS NOT NULL)
SELECT DISTINCT r.document_id, r.block_id, r.asset_id FROM r JOIN b a ON a.document_id = r.document_id AND a.block_id = r.asset_id AND a.block_type IN {S.ASSETS}
WHERE (r.document_id, r.block_id) IN (SELECT (document_id, block_id) FROM b) OR (r.document_id, r.block_id, r.asset_id) IN (SELECT (document_id, part_of_id, block_id) FROM b WHERE part_of_id IS NOT NULL)""")
def q_related_assets(spark, sf):
    """DIS-6, SET-3, JON-13: assets that belong to blocks."""
    return discover.related_assets(live(spark, sf), table(spark, sf, "edges"))


_STEMS = S.in_list(discover.STEM_TYPES)


@query(f"""WITH {S.BLOCKS}, f AS (SELECT document_id, part_of_id AS container_id, min(reading_order) AS first_part FROM b WHERE part_of_id IS NOT NULL GROUP BY ALL),
c AS (SELECT document_id, section_id, block_id AS container_id, reading_order AS pos, lead(reading_order) OVER (PARTITION BY document_id, section_id ORDER BY reading_order) AS following FROM b WHERE group_role = 'container' AND section_id IS NOT NULL)
SELECT c.document_id, c.container_id, b.block_id FROM c LEFT JOIN f USING (document_id, container_id) JOIN b ON b.document_id = c.document_id AND b.section_id = c.section_id AND b.block_type IN {_STEMS} AND b.part_of_id IS NULL
WHERE b.reading_order > c.pos AND b.reading_order < coalesce(least(following, first_part), 9223372036854775807)""")
def q_stem_blocks(spark, sf):
    """WIN-11: blocks of a container's stem."""
    return discover.stem_blocks(live(spark, sf))


@query(f"""WITH {S.BLOCKS}, u AS (SELECT document_id, lower(trim(unnest(source_blocks), ' ')) AS block_id FROM questions), p AS (SELECT * FROM b WHERE block_type IN ('paragraph', 'callout', 'note', 'activity') AND contains(coalesce(text, ''), '?') AND length(text) BETWEEN 20 AND 600
  AND NOT EXISTS (SELECT 1 FROM u WHERE u.document_id = b.document_id AND u.block_id = b.block_id))
SELECT document_id, block_id, CAST(place AS INTEGER) AS place FROM (SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY reading_order) AS place FROM p) WHERE place <= 60""")
def q_in_text_candidates(spark, sf):
    """DIS-9, JON-21, SRT-8: prose that may hold a question."""
    return discover.in_text_candidates(live(spark, sf), table(spark, sf, "questions"))


@query(f"""WITH {S.QUESTIONS}, l AS (SELECT document_id, parent_id, question_id, ordinal, regexp_replace(lower(coalesce(question_number, '')), '[^a-z0-9]', '', 'g') AS lb FROM q WHERE parent_id IS NOT NULL),
r AS (SELECT *, CAST(CASE WHEN list_contains(['i','ii','iii','iv','v','vi','vii','viii','ix','x'], lb) THEN {S.ROMAN_RANK.format('lb')} WHEN regexp_matches(lb, '^[a-z]$') THEN ascii(lb) - 96 WHEN regexp_matches(lb, '^\\d{{1,9}}$') THEN CAST(lb AS INTEGER) ELSE 99 END AS INTEGER) AS rank FROM l)
SELECT document_id, parent_id, question_id, rank, CAST(row_number() OVER (PARTITION BY document_id, parent_id ORDER BY rank, ordinal NULLS FIRST, question_id) AS INTEGER) AS place FROM r""")
def q_label_order(spark, sf):
    """WIN-17, NUM-10: parts of a question in the order of their labels."""
    return discover.label_order(table(spark, sf, "questions"))


@query(f"""WITH {S.BLOCKS}, t AS (SELECT document_id, arg_min(trim(text, ' '), reading_order) AS chapter FROM b WHERE block_type IN ('chapter', 'topic') AND trim(coalesce(text, ''), ' ') <> '' GROUP BY ALL),
g AS (SELECT document_id, arg_min(regexp_extract(text, '\\bClass\\s+(XII|XI|IX|X|VIII|VII|VI|\\d{{1,2}})\\b', 1), reading_order) AS grade FROM b WHERE regexp_matches(text, '\\bClass\\s+(XII|XI|IX|X|VIII|VII|VI|\\d{{1,2}})\\b') GROUP BY ALL)
SELECT d.document_id, chapter, nullif(regexp_extract(chapter, '\\b(\\d{{1,2}})\\b', 1), '') AS chapter_number, grade FROM (SELECT DISTINCT document_id FROM b) d LEFT JOIN t USING (document_id) LEFT JOIN g USING (document_id)""")
def q_document_meta(spark, sf):
    """STR-35: what documents say about themselves."""
    return discover.document_meta(live(spark, sf))


_BANNER_CASE = " ".join(f"WHEN {S.rlike('t', p)} THEN {v}" for p, v in T.BANNER_MARKS)
_MARKS = f"""mm AS (SELECT document_id, block_id, reading_order, tags, coalesce(text, '') AS t, block_type IN ('banner', 'heading') AS banner FROM b),
mv AS (SELECT *, coalesce(CAST(nullif(regexp_extract(t, {S.lit(T.MARKS_BANNER)}, 1), '') AS INTEGER), CASE WHEN banner THEN CASE {_BANNER_CASE} END END) AS mk FROM mm),
mw AS (SELECT document_id, block_id, TRY_CAST(tags['marks'] AS DOUBLE) AS own, last_value(mk IGNORE NULLS) OVER (PARTITION BY document_id ORDER BY reading_order) AS banner_marks FROM mv),
mk_ AS (SELECT document_id, block_id, coalesce(own, CAST(banner_marks AS DOUBLE)) AS marks, CASE WHEN own IS NOT NULL THEN 'explicit' ELSE 'section_banner' END AS marks_source FROM mw WHERE own IS NOT NULL OR banner_marks IS NOT NULL)"""


@query(f"WITH {S.BLOCKS}, {_MARKS} SELECT * FROM mk_")
def q_marks(spark, sf):
    """STR-26: marks of blocks, their own or their banner's."""
    b = live(spark, sf)
    return discover.marks(b, structure.regions(b))


@query()
def q_adjudication_items(spark, sf):
    """ASC-2, JSN-2, STR-37: open questions with their candidates for an outside judge."""
    leaves, blocks, found = evidence_of(spark, sf)
    evidence = stage(answers.ranked(found, blocks), "evidence")
    return discover.adjudication_items(answers.associate(leaves, blocks, evidence), leaves, evidence, blocks)


# ---------------------------------------------------------------- questions from blocks


def built_of(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Live blocks and the question nodes built from them."""
    from folioflow.operators import assemble, reconstruct
    from folioflow.plans.documents import scored

    b = stage(live(spark, sf), "live")
    roots = stage(discover.roots(b, table(spark, sf, "hierarchy")), "roots")
    claimed = assemble.part_blocks(b, roots).select("document_id", F.col("block_id").alias("row_id"), F.lit(True).alias("claimed"))
    # each ordered step reads its input twice, so what it reads is written first; the spans are read twice as well
    pairs = stage(scored(spark, sf, b), "scored").join(roots.select("document_id", F.col("block_id").alias("row_id"), F.lit(True).alias("root")), ["document_id", "row_id"], "left").join(claimed, ["document_id", "row_id"], "left")
    spans = stage(reconstruct.spans(stage(pairs, "span-rows"), ["document_id"], F.coalesce("root", F.lit(False)), F.coalesce("claimed", F.lit(False))), "spans")
    return b, assemble.build(b, roots, spans, discover.marks(b, structure.regions(b)), table(spark, sf, "edges"))


_CUE = lambda n, c: S.rlike(c, T.TYPE_CUES[n])
_BUILT = f"""{_SCORE}, {_ROOTS}, {_MARKS},
qp AS (SELECT document_id, block_id, part_of_id AS parent_id FROM b WHERE part_of_id IS NOT NULL AND (block_type IN ('question', 'worked_example') OR (coalesce(group_role, '') IN ('subpart', 'or_alternative') AND block_type NOT IN {S.ANSWERS} AND block_type NOT IN {S.ASSETS}))
  AND (document_id, block_id) NOT IN (SELECT (document_id, block_id) FROM rt)),
tr_ AS (SELECT document_id, block_id, CAST(NULL AS VARCHAR) AS parent_id, block_id AS root_id, 0 AS depth FROM rt UNION ALL SELECT q.document_id, q.block_id, q.parent_id, t.root_id, t.depth + 1 FROM tr_ t JOIN qp q ON q.document_id = t.document_id AND q.parent_id = t.block_id),
sk AS (SELECT z.*, rt.block_id IS NOT NULL AS anchor, rt.block_id IS NOT NULL OR qp.block_id IS NOT NULL OR hard_stop OR score < 0.55 AS brk FROM z LEFT JOIN rt ON rt.document_id = z.document_id AND rt.block_id = z.block_id LEFT JOIN qp ON qp.document_id = z.document_id AND qp.block_id = z.block_id),
si AS (SELECT *, count(*) FILTER (brk) OVER (PARTITION BY document_id ORDER BY reading_order) AS isl FROM sk),
sr AS (SELECT *, row_number() OVER w - 1 AS seg, first_value(block_id) OVER w AS head, first_value(anchor AND brk) OVER w AS ok FROM si WINDOW w AS (PARTITION BY document_id, isl ORDER BY reading_order)),
sp AS (SELECT document_id, head AS node_id, seg AS place, block_id FROM sr WHERE ok AND seg < 12),
nc AS (SELECT t.document_id, t.block_id AS node_id, [t.block_id] AS seen, t.block_id, false AS looped FROM tr_ t WHERE (t.document_id, t.block_id) NOT IN (SELECT (document_id, node_id) FROM sp)
  UNION ALL SELECT n.document_id, n.node_id, list_append(n.seen, c.block_id), c.block_id, list_contains(n.seen, c.block_id) FROM nc n JOIN b p ON p.document_id = n.document_id AND p.block_id = n.block_id JOIN b c ON c.document_id = p.document_id AND c.block_id = p.continues_to WHERE NOT n.looped),
nx AS (SELECT document_id, node_id, len(seen) - 1 AS place, block_id FROM (SELECT *, bool_or(looped) OVER (PARTITION BY document_id, node_id) AS any_loop FROM nc) WHERE len(seen) = 1 OR NOT any_loop),
ow AS (SELECT document_id, node_id AS block_id, trim(string_agg(coalesce(text, ''), ' ' ORDER BY place, x.block_id), ' ') AS own_text FROM (SELECT * FROM sp WHERE (document_id, node_id) IN (SELECT (document_id, block_id) FROM rt) UNION ALL SELECT * FROM nx) x JOIN b USING (document_id, block_id) GROUP BY ALL),
bl AS (SELECT document_id, parent_id AS block_id, count(*) AS n_parts FROM tr_ WHERE parent_id IS NOT NULL GROUP BY ALL),
fp AS (SELECT document_id, part_of_id AS container_id, min(reading_order) AS first_part FROM b WHERE part_of_id IS NOT NULL GROUP BY ALL),
ct AS (SELECT document_id, section_id, block_id AS container_id, reading_order AS pos, lead(reading_order) OVER (PARTITION BY document_id, section_id ORDER BY reading_order) AS following FROM b WHERE group_role = 'container' AND section_id IS NOT NULL),
sb AS (SELECT c.document_id, c.container_id, b.block_id, b.text, b.reading_order FROM ct c LEFT JOIN fp USING (document_id, container_id) JOIN b ON b.document_id = c.document_id AND b.section_id = c.section_id AND b.block_type IN {_STEMS} AND b.part_of_id IS NULL
  WHERE b.reading_order > c.pos AND b.reading_order < coalesce(least(following, first_part), 9223372036854775807) AND (c.document_id, c.container_id) IN (SELECT (document_id, block_id) FROM rt) AND (c.document_id, c.container_id) IN (SELECT (document_id, block_id) FROM bl)
    AND (c.document_id, c.container_id, b.block_id) NOT IN (SELECT (document_id, node_id, block_id) FROM sp)),
sm AS (SELECT document_id, container_id AS block_id, trim(string_agg(coalesce(text, ''), ' ' ORDER BY reading_order), ' ') AS stem FROM sb GROUP BY ALL),
eq AS (SELECT DISTINCT document_id, part_of_id AS block_id FROM b WHERE block_type = 'equation' AND part_of_id IS NOT NULL),
q1 AS (SELECT t.*, rt.source_type, b.enumerator AS question_number, b.block_type, coalesce(b.group_role, '') AS role, trim(own_text || ' ' || coalesce(stem, ''), ' ') AS t, coalesce(n_parts, 0) AS n_parts, coalesce(stem <> '', false) AND coalesce(n_parts > 0, false) AS is_case, mk_.marks,
  eq.block_id IS NOT NULL OR contains(coalesce(b.text, ''), '=') OR contains(coalesce(b.text, ''), 'λ') OR contains(coalesce(b.text, ''), 'ν') AS equation
  FROM tr_ t JOIN b ON b.document_id = t.document_id AND b.block_id = t.block_id JOIN ow ON ow.document_id = t.document_id AND ow.block_id = t.block_id JOIN rt ON rt.document_id = t.document_id AND rt.block_id = t.root_id LEFT JOIN bl ON bl.document_id = t.document_id AND bl.block_id = t.block_id
    LEFT JOIN sm ON sm.document_id = t.document_id AND sm.block_id = t.block_id LEFT JOIN eq ON eq.document_id = t.document_id AND eq.block_id = t.block_id LEFT JOIN mk_ ON mk_.document_id = t.document_id AND mk_.block_id = t.block_id)"""
_BUILT_RULES = [
    (f"is_case OR (n_parts > 0 AND {_CUE('case', 't')})", "case_study"), (f"{_CUE('assertion', 't')} AND {_CUE('reason', 't')}", "assertion_reason"), (_MCQ, "mcq"), *((_CUE(n, "t"), k) for n, k in (("blank", "fill_blank"), ("true_false", "true_false"), ("matching", "matching"), ("distinguish", "distinguish"), ("ordering", "ordering"))),
    (f"equation OR {_CUE('numeric', 't')} OR ({_CUE('unit', 't')} AND contains(t, '?'))", "numerical"), (f"block_type = 'activity' OR {_CUE('activity', 't')}", "activity"), (f"{_CUE('descriptive', 't')} AND marks >= 3", "long_answer"), (f"{_CUE('descriptive', 't')} AND marks <= 2", "short_answer"),
    (f"{_CUE('descriptive', 't')} OR contains(t, '?')", "conceptual"),
]


@query(f"""WITH RECURSIVE {_BUILT} SELECT document_id, block_id AS question_id, parent_id, root_id, depth, source_type, CASE {' '.join(f"WHEN {r} THEN '{k}'" for r, k in _BUILT_RULES)} ELSE 'unknown' END AS question_type, question_number, t AS question_text, marks, is_case, n_parts,
  (CASE WHEN role = 'container' OR block_type = 'worked_example' THEN 0.95 WHEN block_type = 'question' THEN 0.85 ELSE 0.6 END)::DOUBLE AS discovery FROM q1""")
def q_built_questions(spark, sf):
    """DIS-3, DIS-7: questions built from blocks: roots with their span and stem, and the parts below them."""
    return built_of(spark, sf)[1].select("document_id", "question_id", "parent_id", "root_id", "depth", "source_type", "question_type", "question_number", "question_text", "marks", "is_case", "n_parts", "discovery")


@query()
def q_split_questions(spark, sf):
    """DIS-4, DIS-5: parts inside the text of one block, with their slice of its answer."""
    from folioflow.operators import assemble

    b, built = built_of(spark, sf)
    return assemble.split_parts(stage(built, "built"), b)


@query(f"WITH RECURSIVE {_BUILT} SELECT document_id, root_id, trim(string_agg(t, ' ' ORDER BY depth, block_id), ' ') AS full_text FROM q1 GROUP BY ALL")
def q_full_texts(spark, sf):
    """STR-31: each question's text with those of all of its parts."""
    from folioflow.operators import assemble

    return assemble.full_texts(built_of(spark, sf)[1])


# ---------------------------------------------------------------- comparison with stored questions


def gold_and_got(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """The stored top-level questions as gold, and the built ones."""
    q = table(spark, sf, "questions").filter("document_id is not null and question_id is not null").dropDuplicates(["document_id", "question_id"]).filter("parent_id is null or parent_id = ''")
    gold = q.select("document_id", F.format_string("%010d %s", F.coalesce("ordinal", F.lit(0)), F.col("question_id")).alias("gold_ix"), F.col("question_id").alias("gold_id"), F.col("question_text").alias("gold_text"), F.col("question_type").alias("gold_type"), F.col("marks").alias("gold_marks"))
    built = built_of(spark, sf)[1].filter("depth = 0")
    got = built.select("document_id", F.col("question_id").alias("got_id"), F.col("question_text").alias("got_text"), F.col("question_type").alias("got_type"), F.col("marks").alias("got_marks"))
    return stage(gold, "gold"), stage(got, "got")


def gold_pairs_of(gold: DataFrame, got: DataFrame) -> DataFrame:
    return evaluate.question_pairs(gold.select("document_id", "gold_ix", "gold_id", "gold_text"), got.select("document_id", "got_id", "got_text"))


def gold_matches_of(gold: DataFrame, got: DataFrame) -> DataFrame:
    return evaluate.question_matches(gold.select("document_id", "gold_ix", "gold_id", "gold_text"), got.select("document_id", "got_id", "got_text"))


_ALL = "regexp_extract_all(lower(coalesce({0}, '')), '[a-z0-9]+')"


@query(f"""WITH RECURSIVE {_BUILT}, gq AS (SELECT document_id, question_id AS gold_id, question_text AS g FROM (SELECT *, row_number() OVER (PARTITION BY document_id, question_id) AS rn FROM questions WHERE document_id IS NOT NULL AND question_id IS NOT NULL) WHERE rn = 1 AND coalesce(parent_id, '') = ''),
gc AS (SELECT document_id, gold_id, tok, count(*) AS n FROM (SELECT document_id, gold_id, unnest({_ALL.format('g')}) AS tok FROM gq) GROUP BY ALL),
gt_ AS (SELECT *, sum(n) OVER (PARTITION BY document_id, gold_id) AS total FROM gc),
ft AS (SELECT document_id, block_id AS got_id, tok, count(*) AS n FROM (SELECT document_id, block_id, unnest({_ALL.format('t')}) AS tok FROM q1 WHERE depth = 0) GROUP BY ALL)
SELECT document_id, gold_id, got_id, CAST(sum(least(g.n, f.n)) AS DOUBLE) / any_value(total) AS score FROM gt_ g JOIN ft f USING (document_id, tok) GROUP BY ALL HAVING CAST(sum(least(g.n, f.n)) AS DOUBLE) / any_value(total) >= 0.35""")
def q_gold_pairs(spark, sf):
    """JON-22: stored and built questions of a document whose texts agree enough."""
    return gold_pairs_of(*gold_and_got(spark, sf)).drop("gold_ix")


@query()
def q_gold_matches(spark, sf):
    """JON-22: stored questions matched with built ones, one to one, in their order."""
    return gold_matches_of(*gold_and_got(spark, sf))


@query()
def q_gold_metrics(spark, sf):
    """AGG-18, AGG-19: recall, completeness and accuracy of the built questions against the stored ones."""
    gold, got = gold_and_got(spark, sf)
    return evaluate.gold_metrics(gold_matches_of(gold, got), gold.select("document_id", "gold_id", "gold_type", "gold_marks"), got.select("document_id", "got_id", "got_type", "got_marks"))
