from folioflow.functions import registry
from folioflow.operators import discover as D
from folioflow.operators import gold, structure
from tests.test_structure import b, blocks, pages


def hierarchy(spark, rows):
    return spark.createDataFrame(rows, "document_id string, node_id string, title string")


def test_roots(spark):
    df = blocks(spark, [
        b("paragraph", "1. The rule of the lever tells us that arms balance.", group_role="container", section_id="s1"), b("paragraph", "2. A beam of ten metres rests on two posts.", group_role="container", section_id="s2"), b("question", "Why?"), b("paragraph", "3. What is it?", group_role="container"),
        b("paragraph", "4. Answer the following", group_role="container", block_id="c"), b("paragraph", "(a) Why is it so?", group_role="subpart", part_of_id="c"), b("paragraph", "5.", group_role="container"), b("worked_example", "Example 3. Sand"),
    ])
    h = hierarchy(spark, [("d", "s1", "Summary"), ("d", "s2", "Exercises")])
    assert {(r.block_id, r.source_type) for r in D.roots(df, h).collect()} == {("b1", "solved_question"), ("b2", "in_text"), ("b3", "solved_question"), ("c", "solved_question"), ("b7", "worked_example")}


def test_meta_labels_and_candidates(spark):
    df = blocks(spark, [b("paragraph", "For Class VIII and Class X"), b("topic", " 12 Sand "), b("paragraph", "Is the sand on this beach hot?"), b("paragraph", "Used? It is, all of it.")])
    assert [tuple(r) for r in D.document_meta(df).collect()] == [("d", "12 Sand", "12", "VIII")]
    q = spark.createDataFrame([("d", "q1", ["B3 "])], "document_id string, question_id string, source_blocks array<string>")
    assert [r.block_id for r in D.in_text_candidates(df, q).collect()] == ["b2"]
    labels = spark.createDataFrame([("d", f"q{i}", "p", n, i) for i, n in enumerate(["(iii)", "(i)", "b", "2", None])], "document_id string, question_id string, parent_id string, question_number string, ordinal int")
    assert [(r.question_id, r.place) for r in D.label_order(labels).orderBy("place").collect()] == [("q1", 1), ("q2", 2), ("q3", 3), ("q0", 4), ("q4", 5)]


def test_stems_assets_and_vectors(spark):
    df = blocks(spark, [b("worked_example", "Example 1", group_role="container", section_id="s"), b("paragraph", "passage", section_id="s"), b("figure", None, section_id="s", part_of_id="b0"), b("paragraph", "later", section_id="s"), b("worked_example", "Example 2", group_role="container", section_id="s")])
    assert {(r.container_id, r.block_id) for r in D.stem_blocks(df).collect()} == {("b0", "b1")}
    edges = spark.createDataFrame([("d", "b1", " B2", "refers_to"), ("d", "gone", "b2", "refers_to"), ("d", "b1", "b3", "refers_to")], "document_id string, src string, dst string, edge_type string")
    assert {(r.block_id, r.asset_id) for r in D.related_assets(df, edges).collect()} == {("b0", "b2"), ("b1", "b2")}
    texts = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, None)], "text_id int, text string")
    known = D.missing_vectors(texts.filter("text = 'b'"), texts.limit(0).selectExpr("text as text_key"))
    assert [r.text for r in D.missing_vectors(texts, known).collect()] == ["a"]


def test_gold(spark):
    df = blocks(spark, [b("question", "What is sand", inline_answer=True, continues_to="b2"), b("answer", "Dust"), b("question", "more", page_index=1, part_of_id="b0")])
    schema = "document_id string, check_id string, kind string, needle string, expect_int int, expect_text string, page_from int, page_to int"
    rows = [("d", "o", "ordering", "SAND", None, "answer", 0, None), ("d", "o2", "ordering", "dust", None, "question", 0, None), ("d", "p", "part_of", "sand", 1, None, None, None), ("d", "p2", "part_of", "sand", 2, None, None, None), ("d", "c", "continuation", None, None, "question", 0, 1), ("d", "i", "inline", "sand", 1, None, None, None), ("d", "i2", "inline", "dust", 1, None, None, None), ("d", "l", "layout", None, 1, None, 0, None), ("e", "x", "inline", "sand", 1, None, None, None)]
    columns = spark.createDataFrame([("d", 0, 1)], "document_id string, page_index int, n_columns int")
    checks = gold.structure_checks(df, columns, spark.createDataFrame(rows, schema))
    assert {r.check_id: r.passed for r in checks.collect()} == {"o": True, "o2": False, "p": True, "p2": False, "c": True, "i": True, "i2": False, "l": True, "x": False}
    assert gold.pass_rate(checks).collect()[0].n_passed == 5
    assert structure.columns(df, pages(spark)).count() == 0
    q = spark.createDataFrame([("d", "q1", None, "1", "What is sand", "in_text", "mcq", 2.0, ("matched",), 0), ("d", "q2", "q1", "a", "Why", None, None, None, None, 1)], "document_id string, question_id string, parent_id string, question_number string, question_text string, source_type string, question_type string, marks double, answer_association struct<status string>, ordinal int")
    want = "document_id string, check_id string, text_contains string, question_number string, source_type string, expect_type string, expect_marks double, expect_status string, min_parts int"
    g = spark.createDataFrame([("d", "a", "SAND", None, None, "mcq", 2.0, "matched", 1), ("d", "b", None, "a", None, None, 1.0, None, None), ("d", "c", "none", None, None, None, None, None, None)], want)
    assert {r.check_id: r.passed for r in gold.question_checks(q, g).collect()} == {"a": True, "b": False, "c": False}


def test_sql_functions(spark):
    assert "ff_iou" in registry.register(spark)
    row = spark.sql("select ff_iou(0, 0, 2, 2, 1, 1, 3, 3) a, ff_tokens('A b-2') t, ff_text_key('  A   b ') k, ff_evaluate('2 * 3') e, ff_readable('{\"questions\": []}') r").collect()[0]
    assert (round(row.a, 4), row.t, row.k, row.e, row.r) == (round(1 / 7, 4), ["a", "b", "2"], "a b", 6.0, True)
