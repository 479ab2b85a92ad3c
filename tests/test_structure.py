from pyspark.sql import functions as F

from folioflow.functions import geometry
from folioflow.operators import answers, corpus, evaluate, graph, retrieval, structure

RAW = "document_id string, block_id string, block_type string, text string, latex string, caption string, heading_level int, page_index int, bbox array<double>, col_ix int, reading_order bigint, section_id string, part_of_id string, group_role string, enumerator string, or_group_id string, continuation_of string, continues_to string, inline_answer boolean, extraction_confidence double, ingested_at timestamp, deleted_at timestamp"
PAGES = "document_id string, page_index int, printed_page int, width int, height int"


def blocks(spark, rows, **defaults):
    names = [f.split()[0] for f in RAW.split(", ")]
    base = {"document_id": "d", "page_index": 0, "col_ix": 0, "inline_answer": False, "extraction_confidence": 0.9} | defaults
    full = [base | {"block_id": f"b{i}", "reading_order": i} | r for i, r in enumerate(rows)]
    return corpus.live_blocks(spark.createDataFrame([tuple(r.get(n) for n in names) for r in full], RAW))


def pages(spark, n=3):
    return spark.createDataFrame([("d", p, p + 1, 1000, 1400) for p in range(n)], PAGES)


def b(kind, text=None, **kw):
    return {"block_type": kind, "text": text, **kw}


def test_sections_nest_by_level(spark):
    df = blocks(spark, [b("chapter", "C"), b("paragraph", "p"), b("topic", "T1"), b("section", "S1"), b("paragraph", "q"), b("subsection", "U"), b("section", "S2"), b("heading", "OR"), b("topic", "T2"), b("heading", "H", heading_level=5)])
    got = {r.block_id: (r.section_block, r.parent_block) for r in structure.sections(df).collect()}
    assert got == {"b0": (None, None), "b1": (None, None), "b2": ("b2", None), "b3": ("b3", "b2"), "b4": ("b3", "b3"), "b5": ("b5", "b3"), "b6": ("b6", "b2"), "b7": ("b6", "b6"), "b8": ("b8", None), "b9": ("b9", "b8")}


def test_answer_runs(spark):
    df = blocks(spark, [b("heading", "Solution"), *[b("paragraph", "x")] * 9, b("paragraph", "Ans. y"), b("figure", None), b("list_item", "z"), b("paragraph", "Exercise 3"), b("paragraph", "w"), b("heading", "More"), b("paragraph", "v")])
    got = {r.block_id: r.source for r in structure.answer_runs(df).collect()}
    assert got == {**{f"b{i}": "answer_heading_run" for i in range(1, 9)}, "b10": "answer_opener", "b12": "answer_heading_run"}


def test_regions_and_marks(spark):
    df = blocks(spark, [b("paragraph", "a"), b("heading", "Long Answer"), b("paragraph", "b"), b("heading", "Self-Assessment [ 2 marks ]"), b("paragraph", "c")])
    assert [(r.region, r.banner_marks) for r in structure.regions(df).orderBy("block_id").collect()] == [("body", None), ("body", 5), ("body", 5), ("self_assessment", 2), ("self_assessment", 2)]


def test_enumeration_with_alternatives(spark):
    rows = ["Example 1. Stem", "(a) one", "OR", "(b) two", "(A) upper", "(i) deep", "Ans. x", "2. Next", "(a) lone"]
    df = spark.createDataFrame([("d", f"r{i}", i, "answer" if t.startswith("Ans") else "paragraph", t) for i, t in enumerate(rows)], "document_id string, row_id string, position bigint, block_type string, text string")
    got = {r.row_id: (r.group_role, r.parent_row, r.or_group) for r in structure.enumeration(df, ["document_id"]).collect()}
    assert got == {"r0": ("container", None, None), "r1": ("or_alternative", "r0", "or_r1"), "r2": ("or_separator", None, None), "r3": ("or_alternative", "r0", "or_r1"), "r4": ("subpart", "r0", None), "r5": ("subpart", "r4", None), "r6": ("content", "r0", None), "r7": ("container", None, None), "r8": ("subpart", "r7", None)}


def test_columns_and_agreement(spark):
    boxes = [[0, 0, 900, 50], [0, 100, 400, 200], [0, 300, 400, 400], [500, 100, 900, 200], [500, 300, 900, 400]]
    df = blocks(spark, [b("paragraph", "x", bbox=[float(v) for v in box]) for box in boxes])
    row = structure.columns(df, pages(spark)).collect()[0]
    assert (row.n_columns, row.n_full_width, row.n_bands, row.agreement) == (2, 1, 2, 1.0)
    worst = blocks(spark, [b("paragraph", "x", bbox=[0.0, 300.0 - 100 * i, 100.0, 350.0 - 100 * i]) for i in range(3)])
    assert structure.columns(worst, pages(spark)).collect()[0].agreement == 0.0


def test_continuations(spark):
    low, top = [0.0, 1200.0, 400.0, 1300.0], [0.0, 50.0, 400.0, 200.0]
    df = blocks(spark, [
        b("paragraph", "goes on", bbox=low), b("noise", "7", bbox=low), b("paragraph", "here and", bbox=[0.0, 50.0, 400.0, 1390.0], page_index=1), b("paragraph", "there.", bbox=top, page_index=2), b("table", "a | b\n(1) | x", bbox=low, page_index=2), b("table", "(2) | y", bbox=top, page_index=3), b("paragraph", "end", page_index=3),
    ])
    got = {r.block_id: (r.continues_to, r.logical_item) for r in structure.continuations(df, pages(spark, 4)).collect()}
    assert got == {"b0": ("b2", "item_b0"), "b2": ("b3", "item_b0"), "b4": ("b5", "item_b4")}


def test_references_resolve(spark):
    refs = spark.createDataFrame([("d", f"r{i}", p, 5, d, h, lab) for i, (p, d, h, lab) in enumerate([(0, None, "figure", "2.1"), (0, "below", "figure", None), (0, "above", "table", None), (0, None, "figure", None), (1, None, "table", None), (0, None, "figure", "9.9")])], "document_id string, ref_id string, page_index int, reading_order bigint, direction string, hint string, label string")
    assets = spark.createDataFrame([("d", "f1", "figure", 3, 1, "Figure 2.1"), ("d", "f2", "figure", 0, 7, ""), ("d", "f3", "diagram", 0, 4, ""), ("d", "f4", "figure", 0, 6, ""), ("d", "t1", "table", 0, 2, "")], "document_id string, asset_id string, asset_type string, page_index int, reading_order bigint, label_text string")
    got = {r.ref_id: (r.status, r.target_id, r.method) for r in structure.resolve_references(refs, assets).collect()}
    # r4's page has no table: the nearest one of another page counts, if it is within the window
    assert {r.status for r in structure.resolve_references(refs.filter("ref_id = 'r4'"), assets, window=2).collect()} == {"no_candidate"}
    assert {r.confidence for r in structure.resolve_references(refs.filter("ref_id = 'r4'"), assets).collect()} == {0.55}
    assert got == {"r0": ("resolved", "f1", "label"), "r1": ("resolved", "f4", "direction"), "r2": ("resolved", "t1", "direction"), "r3": ("ambiguous", None, "proximity"), "r4": ("resolved", "t1", "proximity"), "r5": ("ambiguous", None, "proximity")}


def test_numbering_gaps(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("a", 5), ("b", 1), ("b", 9), ("c", 3), ("c", 4), ("c", 5), (None, 1), ("a", None)], "series string, n int")
    assert [tuple(r) for r in structure.numbering_gaps(df).collect()] == [("a", 3, 4)]


def test_coverage_of_boxes(spark):
    df = blocks(spark, [b("paragraph", "x", bbox=[0.0, 0.0, 1000.0, 1400.0]), b("paragraph", "y", bbox=[0.0, 0.0, 10.0, 10.0], page_index=1), b("paragraph", "z", bbox=[1.0, 2.0], page_index=2)])
    assert {r.page_index: r.coverage for r in structure.box_coverage(df, pages(spark, 4)).collect()} == {0: 1.0, 1: 0.0, 2: 0.0, 3: 0.0}


def test_latest_delivery_counts(spark):
    from datetime import datetime

    day = lambda i: datetime(2024, 1, i)
    df = blocks(spark, [b("P", "old", block_id="a", ingested_at=day(1)), b("P", "new", block_id="a", ingested_at=day(2)), b("P", "x", block_id="b", ingested_at=day(1)), b("P", "x", block_id="b", ingested_at=day(2), deleted_at=day(3)), b(None, None, block_id="c"), b("P", "no", block_id=""), b("P", "no", document_id=None)])
    assert {(r.block_id, r.text, r.block_type) for r in df.collect()} == {("a", "new", "p"), ("c", None, "other")}


def test_answers_from_structure(spark):
    df = blocks(spark, [
        b("question", "Q1"), b("figure", None), b("answer", "Ans. one"), b("question", "Q2"), b("paragraph", "prose"), b("answer", "late"), b("worked_example", "W", block_id="w"), b("question", "(a) x", part_of_id="w"), b("question", "(b) y", part_of_id="w"), b("heading", "Solution"), b("solution", "(a) sol"), b("question", "Q3", inline_answer=True),
    ])
    q = spark.createDataFrame([("d", f"q{i}", None, n, "t", [src]) for i, (src, n) in enumerate([("b0", "1"), ("b3", "2"), ("b7", "a"), ("b8", "b"), ("b11", "3"), ("gone", "9")])], "document_id string, question_id string, parent_id string, question_number string, question_text string, source_blocks array<string>")
    leaves = retrieval.leaf_questions(q)
    edges = spark.createDataFrame([], "document_id string, src string, dst string, edge_type string")
    found = retrieval.structural_candidates(leaves, df, edges)
    assert {(r.question_id, r.block_id, r.relationship, r.strength) for r in found.collect()} == {("q0", "b2", "adjacent_solution", 0.9), ("q2", "b10", "container_solution_enum", 0.92), ("q3", "b10", "adjacent_solution", 0.9)}
    out = {r.question_id: (r.status, r.method, r.answer_block) for r in answers.associate(leaves, df, answers.ranked(found, df)).collect()}
    assert out == {"q0": ("matched", "structural", "b2"), "q1": ("not_in_document", "no_candidate", None), "q2": ("matched", "structural", "b10"), "q3": ("matched", "structural", "b10"), "q4": ("matched", "inline", "b11"), "q5": ("not_in_document", "no_candidate", None)}


def test_graph(spark):
    df = structure.linked(blocks(spark, [b("figure", None, or_group_id="g"), b("caption", "c", part_of_id="b0", or_group_id="g"), b("paragraph", "p", part_of_id="gone", section_id="h1", or_group_id="g")]))
    h = spark.createDataFrame([("d", "h1", "topic", "t", ["h2", "gone"]), ("d", "h2", "section", "u", None)], "document_id string, node_id string, kind string, title string, children array<string>")
    e = graph.edges(df, h)
    got = {(r.src, r.dst, r.edge_type) for r in e.collect()}
    assert ("b0", "b1", "has_caption") in got and ("b1", "b0", "part_of") in got and ("h1", "h2", "contains") in got and not any("gone" in x for x in got)
    assert {x[:2] for x in got if x[2] == "or_alternative"} == {("b1", "b0"), ("b0", "b1"), ("b2", "b0"), ("b0", "b2")}
    n = graph.nodes(df, h, pages(spark))
    assert graph.dangling(e, n).count() == 0 and n.count() == 1 + 3 + 2 + 3


def test_token_coverage_and_matches(spark):
    df = spark.createDataFrame([("the the sand", "sand the x"), ("", "x"), (None, None), ("a b c d", "d c")], "g string, t string")
    assert [round(r[0], 3) for r in df.select(evaluate.token_coverage(F.col("g"), F.col("t"))).collect()] == [0.667, 1.0, 1.0, 0.5]
    pairs = spark.createDataFrame([("p", "1", "g1", "x", 0.9), ("p", "1", "g1", "y", 0.8), ("p", "2", "g2", "x", 0.95), ("p", "2", "g2", "y", 0.4), ("p", "3", "g3", "y", 0.3)], "page string, gold_ix string, gold_id string, got_id string, score double")
    assert {tuple(r) for r in evaluate.greedy_matches(pairs, ["page"], 0.35).collect()} == {("g1", "x", 0.9), ("g2", "y", 0.4)}
    rates = evaluate.rates(evaluate.greedy_matches(pairs, ["page"], 0.35), 3, 2)
    assert rates["recall"] == 2 / 3 and rates["precision"] == 1.0


def test_registry_goes_on_after_a_failure(spark):
    reg = evaluate.Registry({"bad": lambda t: t["none"], "good": lambda t: t["x"]})
    reg.register("more", lambda t: t["x"].limit(0))
    out = reg.run({"x": spark.range(2)})
    assert "KeyError" in out["bad"] and out["good"].count() == 2 and out["more"].count() == 0


def test_boxes(spark):
    df = geometry.with_corners(spark.createDataFrame([([3.0, 4.0, 1.0, 2.0],), ([1.0, None, 2.0, 3.0],), (None,), ([1.0],)], "bbox array<double>"))
    assert [(r.x0, r.y0, r.x1, r.y1) for r in df.collect()] == [(1.0, 2.0, 3.0, 4.0)] + [(None,) * 4] * 3


def test_duplicate_documents_are_compared_whole(spark, tmp_path):
    from folioflow.plans import documents as P

    opening = "The sand of the beach. " * 20
    texts = [opening + "One end.", opening + "Another end.", opening.upper() + " One\n\nend.\n", "short", "Short ", None, " \n", "\n", ""]
    spark.createDataFrame([(t,) for t in texts], "text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(t,) for t in texts[:2]], "question_text string").write.parquet(f"{tmp_path}/questions.parquet")
    assert [r.surplus for r in P.q_duplicate_documents(spark, str(tmp_path)).collect()] == [1, 1]
    assert [r.surplus for r in P.q_duplicate_questions(spark, str(tmp_path)).collect()] == [1]
