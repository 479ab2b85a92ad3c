"""Queries that the driver's tables leave empty, against their SQL on a chapter made for them."""

import glob
import os
from collections import Counter
from datetime import datetime

import pytest

from folioflow.plans import answers, documents

duckdb = pytest.importorskip("duckdb")
pa = pytest.importorskip("pyarrow")
pq = pytest.importorskip("pyarrow.parquet")
T0 = datetime(2024, 1, 1)
BLOCK = pa.schema([
    ("document_id", pa.string()), ("block_id", pa.string()), ("block_type", pa.string()), ("text", pa.string()), ("latex", pa.string()), ("caption", pa.string()), ("heading_level", pa.int32()), ("page_index", pa.int32()), ("bbox", pa.list_(pa.float64())),
    ("col_ix", pa.int32()), ("reading_order", pa.int64()), ("section_id", pa.string()), ("part_of_id", pa.string()), ("group_role", pa.string()), ("enumerator", pa.string()), ("depth", pa.int32()), ("or_group_id", pa.string()), ("continuation_of", pa.string()),
    ("continues_to", pa.string()), ("logical_item_id", pa.string()), ("inline_answer", pa.bool_()), ("tags", pa.map_(pa.string(), pa.string())), ("extraction_confidence", pa.float64()), ("ingested_at", pa.timestamp("us", "UTC")), ("deleted_at", pa.timestamp("us", "UTC")),
])
ANSWER = pa.struct([("status", pa.string()), ("answer_state", pa.string()), ("method", pa.string()), ("answer_block_ids", pa.list_(pa.string())), ("answer_kind", pa.string()), ("final_confidence", pa.float64()), ("llm_confidence", pa.float64())])
QUESTION = pa.schema([
    ("document_id", pa.string()), ("question_id", pa.string()), ("parent_id", pa.string()), ("ordinal", pa.int32()), ("source_type", pa.string()), ("question_type", pa.string()), ("bloom_level", pa.string()), ("question_number", pa.string()), ("question_text", pa.string()),
    ("options", pa.list_(pa.struct([("opt_key", pa.string()), ("opt_text", pa.string())]))), ("marks", pa.float64()), ("source_blocks", pa.list_(pa.string())), ("answer_association", ANSWER), ("associated_at", pa.timestamp("us", "UTC")),
])
OTHERS = {
    "hierarchy": pa.schema([("document_id", pa.string()), ("node_id", pa.string()), ("kind", pa.string()), ("title", pa.string()), ("node_level", pa.int32()), ("heading_block_id", pa.string()), ("block_ids", pa.list_(pa.string())), ("children", pa.list_(pa.string()))]),
    "edges": pa.schema([("edge_id", pa.int64()), ("document_id", pa.string()), ("src", pa.string()), ("dst", pa.string()), ("edge_type", pa.string()), ("edge_data", pa.map_(pa.string(), pa.string())), ("created_at", pa.timestamp("us", "UTC"))]),
    "pages": pa.schema([("document_id", pa.string()), ("page_index", pa.int32()), ("printed_page", pa.int32()), ("media_type", pa.string()), ("width", pa.int32()), ("height", pa.int32()), ("n_columns", pa.int32()), ("scanned", pa.bool_()), ("reading_order_confidence", pa.float64()), ("loaded_at", pa.timestamp("us", "UTC"))]),
    "documents": pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()), ("source", pa.string()), ("n_chars", pa.int64()), ("subject", pa.string()), ("grade", pa.int32()), ("crawled_at", pa.timestamp("us", "UTC"))]),
    "raw_blocks": pa.schema([("raw_id", pa.int64()), ("document_id", pa.string()), ("page_index", pa.int32()), ("reading_order", pa.int64()), ("refs", pa.list_(pa.string()))]),
}
LINES = [
    # type, text, page, bbox, and more
    ("chapter", "Sand and Wind for Class IX", 0, [0, 10, 500, 40], {}),
    ("heading", "Answers", 0, [0, 50, 500, 70], {"heading_level": 2}), ("paragraph", "The wind lifts the sand.", 0, [0, 80, 500, 100], {}), ("list_item", "It falls behind the dune.", 0, [0, 110, 500, 130], {}),
    ("section", "Exercise one [ 3 marks ]", 0, [0, 150, 500, 170], {"heading_level": 2}),
    ("question", "1. Explain how a dune moves.", 0, [0, 200, 500, 220], {"group_role": "container", "enumerator": "1", "section_id": "h_1"}),
    ("paragraph", "Think of the grains on the slope and", 0, [0, 850, 500, 900], {"section_id": "h_1"}), ("paragraph", "of those that fall behind it.", 1, [0, 10, 500, 60], {"section_id": "h_1"}),
    ("list_item", "(a) What does the wind lift?", 1, [0, 100, 500, 120], {"group_role": "subpart", "enumerator": "a", "part_of_id": "blk_00000005", "section_id": "h_1"}),
    ("equation", "v = 6 / 3", 1, [0, 130, 500, 150], {"latex": "6 / 3 = 2 = 4 - 1", "part_of_id": "blk_00000008", "section_id": "h_1"}),
    ("list_item", "(b) Where does it fall? See Fig. 2.1.", 1, [0, 160, 500, 180], {"group_role": "or_alternative", "enumerator": "b", "part_of_id": "blk_00000005", "section_id": "h_1", "tags": [("marks", "2"), ("bloom", "Apply")]}),
    ("figure", None, 1, [0, 200, 500, 400], {"caption": "Figure 2.1: a dune", "section_id": "h_1", "part_of_id": "blk_00000010"}), ("solution", "(b) It falls on the lee side.", 1, [0, 420, 500, 440], {"section_id": "h_1"}),
    ("paragraph", "Would the dune move without any wind at all?", 1, [0, 460, 500, 480], {"section_id": "h_2"}), ("note", "Why do the grains roll back? Look at the slope.", 2, [0, 10, 500, 30], {"section_id": "h_2"}),
    ("table", "|x|y|\n(1) a\n(2) b", 2, [0, 850, 500, 980], {"section_id": "h_2"}), ("table", "|x|y|\n(3) c", 3, [0, 10, 500, 100], {"section_id": "h_2"}),
    ("activity", "Activity 3.1 Take some sand and observe it.", 3, [0, 200, 500, 240], {"section_id": "h_2"}), ("worked_example", "Example 4 How far does it go? (a) In one hour it rolls. (b) In two it stops.\nSolution: 6 m", 3, [0, 300, 500, 360], {"section_id": "h_2", "inline_answer": True}),
]
NONEMPTY = ("q_answer_runs", "q_continuations", "q_exercise_gaps", "q_stem_blocks", "q_in_text_candidates", "q_recoverable", "q_built_questions", "q_question_roots", "q_marks", "q_resolved_references", "q_fused_evidence", "q_calibrated", "q_adjudicated", "q_recovered_edges", "q_findings", "q_spans", "q_associations", "q_block_tags")


def write(folder, name, schema, rows):
    pq.write_table(pa.table({f.name: pa.array([r.get(f.name) for r in rows], f.type) for f in schema}, schema=schema), f"{folder}/{name}.parquet")


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    at = str(tmp_path_factory.mktemp("mini"))
    blocks = [{"document_id": "ch", "block_id": f"blk_{i:08d}", "block_type": kind, "text": text, "page_index": page, "bbox": [float(x) for x in box], "col_ix": 0, "reading_order": i, "extraction_confidence": 0.9, "ingested_at": T0, **more} for i, (kind, text, page, box, more) in enumerate(LINES)]
    blocks.append({**blocks[2], "ingested_at": None, "text": "an earlier delivery"})
    write(at, "blocks", BLOCK, blocks)
    q = {"document_id": "ch", "ordinal": 1, "source_type": "in_text", "question_type": "conceptual"}
    write(at, "questions", QUESTION, [
        {**q, "question_id": "Q_1", "question_number": "b", "question_text": "Where does the sand fall, on the lee side?", "source_blocks": ["BLK_00000010"], "answer_association": {"status": "not_in_document", "method": "llm_adjudicated", "answer_block_ids": [], "llm_confidence": 0.4}},
        {**q, "question_id": "Q_2", "question_number": "a", "question_text": "What does the wind lift?", "source_blocks": ["blk_00000008"], "answer_association": {"status": "matched", "method": "llm_adjudicated", "answer_block_ids": ["blk_00000012", "blk_00000009", "gone"], "answer_kind": "text", "llm_confidence": 0.8}},
        {**q, "question_id": "Q_3", "question_text": None, "source_blocks": None},
        {**q, "question_id": "Q_4", "question_number": "1", "question_text": "The sand of the slope", "source_blocks": ["blk_00000013"], "answer_association": {"status": "partial", "method": "structural", "answer_block_ids": ["blk_00000015"], "answer_kind": "table", "llm_confidence": 0.5}},
    ])
    node = lambda i, title: {"document_id": "ch", "node_id": i, "kind": "section", "title": title}
    write(at, "hierarchy", OTHERS["hierarchy"], [node("h_1", "Exercise one"), node("h_2", "The slope"), {"document_id": "ch", "node_id": "h_0", "kind": "chapter", "children": ["h_1", "h_2"]}])
    edge = lambda i, a, b, kind: {"edge_id": i, "document_id": "ch", "src": a, "dst": b, "edge_type": kind, "created_at": T0}
    write(at, "edges", OTHERS["edges"], [edge(1, "blk_00000010", "blk_00000011", "refers_to"), edge(2, " BLK_00000008", "blk_00000009", "answered_by"), edge(3, "blk_00000013", "blk_00000015", "refers_to")])
    write(at, "pages", OTHERS["pages"], [{"document_id": "ch", "page_index": p, "width": 600, "height": 1000} for p in range(4)])
    write(at, "documents", OTHERS["documents"], [{"doc_id": 1, "text": "1. a\n2. b\n5. c\n9. d"}, {"doc_id": 2, "text": "1. a\n3. b"}, {"doc_id": 3, "text": None}])
    raw = lambda i, page, order, refs: {"raw_id": i, "document_id": "ch", "page_index": page, "reading_order": order, "refs": refs}
    write(at, "raw_blocks", OTHERS["raw_blocks"], [raw(1, 1, 10, ["see Fig. 2.1", "the figure above", "the table below", None]), raw(2, 0, 3, ["the figure below", "the equation"]), raw(3, 3, 18, ["the figure", "the table above"]), raw(4, 2, 400, ["the figure"]), raw(4, 2, 400, ["the figure"]), raw(5, None, None, ["the diagram"])])
    return at


@pytest.fixture(scope="module")
def con(folder):
    c = duckdb.connect()
    c.execute("SET timezone = 'UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return c


@pytest.mark.parametrize("name", NONEMPTY)
def test_like_sql_and_not_empty(spark, con, folder, name):
    queries, oracle = {**documents.QUERIES, **answers.QUERIES}, {**documents.ORACLE, **answers.ORACLE}
    value = lambda v: round(v, 6) if isinstance(v, float) else v
    df = queries[name](spark, folder)
    cols = sorted(df.columns)
    got = Counter(tuple(map(value, r)) for r in df.select(*cols).collect())
    result = con.execute(oracle[name])
    order = [[d[0] for d in result.description].index(c) for c in cols]
    assert got == Counter(tuple(value(r[i]) for i in order) for r in result.fetchall())
    assert got


def test_formula_checks(spark, folder):
    got = {(r.block_id, r.step, r.ok) for r in documents.q_formula_checks(spark, folder).collect()}
    assert ("blk_00000009", 0, True) in got and ("blk_00000009", 1, False) in got


def test_parts_inside_a_block(spark, folder):
    rows = {r.question_id: r for r in answers.q_split_questions(spark, folder).collect()}
    assert set(rows) == {"blk_00000018#a", "blk_00000018#b"}
    assert rows["blk_00000018#a"].question_text.startswith("(a) In one hour") and rows["blk_00000018#b"].discovery == 0.8


def test_gold_matches(spark, folder):
    from folioflow.operators import evaluate

    gold, got = answers.gold_and_got(spark, folder)
    scored = answers.gold_pairs_of(gold, got)
    found = evaluate.greedy_in_documents(scored, evaluate.MATCH)
    rows = {(r.gold_id, r.got_id) for r in found.collect()}
    assert rows and rows <= {(r.gold_id, r.got_id) for r in scored.collect()} and len({g for g, _ in rows}) == len(rows) == len({p for _, p in rows})
    [row] = evaluate.gold_metrics(found, gold.drop("gold_ix", "gold_text"), got.drop("got_text")).collect()
    assert row.n_gold == 4 and row.n_matched == len(rows) and row.recall == len(rows) / 4


def test_gold_files(spark, folder, tmp_path):
    import json

    from folioflow.operators import corpus, gold
    from folioflow.session import table

    lines = {
        "structure": [{"document_id": "ch", "check_id": "s1", "kind": "part_of", "needle": "explain how a dune", "expect_int": 2}, {"document_id": "ch", "check_id": "s2", "kind": "inline", "needle": "example 4", "expect_int": 0}],
        "question_counts": [{"document_id": "ch", "check_id": "c1", "source_type": "in_text", "least": 4, "most": 4}, {"document_id": "ch", "check_id": "c2", "text_contains": "no such", "least": 1}, {"document_id": "no", "check_id": "c3", "most": 0}],
        "answers": [
            {"document_id": "ch", "check_id": "a1", "text_contains": "what does the wind", "expect_status": "matched", "answer_contains": "LEE SIDE"}, {"document_id": "ch", "check_id": "a2", "question_number": "b", "expect_status": "matched"},
            {"document_id": "ch", "check_id": "a3", "text_contains": "what does the wind", "answer_contains": "nothing like it"}, {"document_id": "ch", "check_id": "a4", "text_contains": "not there"},
        ],
    }
    for name, rows in lines.items():
        (tmp_path / f"{name}.json").write_text("\n".join(map(json.dumps, rows)))
    files = gold.read_gold(spark, str(tmp_path))
    assert files["questions"].count() == 0
    blocks, questions = corpus.live_blocks(table(spark, folder, "blocks")), table(spark, folder, "questions")
    columns = spark.createDataFrame([], "document_id string, page_index int, n_columns int")
    passed = lambda df: {r.check_id for r in df.collect() if r.passed}
    assert passed(gold.structure_checks(blocks, columns, files["structure"])) == {"s1"}
    assert passed(gold.count_checks(questions, files["question_counts"])) == {"c1", "c3"}
    assert passed(gold.answer_checks(questions, blocks, files["answers"])) == {"a1"}


def test_pipeline_without_questions(spark, folder, tmp_path):
    import shutil

    from folioflow.plans import pipeline

    for name in ("blocks", "hierarchy", "edges", "pages", "raw_blocks"):
        shutil.copy(f"{folder}/{name}.parquet", tmp_path)
    built = {r.question_id: r for r in pipeline.questions_of(spark, str(tmp_path)).collect()}
    assert built["blk_00000005"].parent_id is None and built["blk_00000008"].parent_id == "blk_00000005" and "blk_00000006" in built["blk_00000005"].source_blocks
    assert pipeline.questions_of(spark, folder).count() == 4
