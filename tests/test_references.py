from datetime import datetime

from folioflow.operators import references as R

T0, T1, T2 = datetime(2024, 1, 1), datetime(2024, 2, 1), datetime(2024, 3, 31, 23, 30)
BLOCKS = "document_id string, block_id string, caption string, ingested_at timestamp, deleted_at timestamp, src string"
EDGES = "edge_id bigint, document_id string, src string, dst string, created_at timestamp"
QUESTIONS = "document_id string, question_id string, associated_at timestamp, answer_association struct<answer_block_ids array<string>>"
RAW = "raw_id bigint, document_id string, refs array<string>, extracted_at timestamp"


def tables(spark, blocks=(), nodes=(), questions=(), edges=(), pages=(), raw=()):
    return (
        spark.createDataFrame(list(blocks), BLOCKS), spark.createDataFrame(list(nodes), "document_id string, node_id string"), spark.createDataFrame(list(questions), QUESTIONS),
        spark.createDataFrame(list(edges), EDGES), spark.createDataFrame(list(pages), "document_id string, page_index int"), spark.createDataFrame(list(raw), RAW),
    )


def report(spark, **kw):
    return sorted(tuple(r) for r in R.orphan_references(*tables(spark, **kw)).collect())


def test_reasons_spellings_and_odd_rows(spark):
    blocks = [("d", "blk_1", "Fig. 2.3: x", T0, None, "x"), ("d", "blk_2", None, T0, T1, "x"), ("d", "blk_3", "Table 1.1", T2, None, "x"), ("d", "blk_4", None, T0, T1, "x"), ("d", "blk_4", None, T1, None, "x"), (None, "blk_9", None, T0, None, "x")]
    edges = [
        (1, "d", " BLK_1", "blk_2", T1), (2, "d", "blk_3", "page_7", T1), (3, "d", "h_1", "Q_9", T1), (3, "d", "h_1", "Q_9", T1), (4, "d", None, " ", T1), (5, "d", "blk_4", "blk_9", None), (6, None, "blk_8", "blk_8", T1), (7, "d", "page_8", "nonsense", T2),
    ]
    questions = [("d", "Q_9", T1, (["Blk_1", None, "", "blk_7"],)), ("d", "Q_8", T1, None)]
    raw = [(1, "d", ["(Figure 2.3)", "TAB. 1.1", "eqn. (4.05)", "as shown earlier", None, "fig 02.3"], T1)]
    got = report(spark, blocks=blocks, nodes=[("d", "h_1")], questions=questions, edges=edges, pages=[("d", 8)], raw=raw)
    assert got == sorted([
        ("edges", "dst", "d", "1", "blk_2", "deleted", "2024-02"), ("edges", "src", "d", "2", "blk_3", "late", "2024-02"), ("edges", "dst", "d", "2", "page_7", "missing", "2024-02"),
        ("edges", "dst", "d", "5", "blk_9", "missing", ""), ("edges", "dst", "d", "7", "nonsense", "missing", "2024-03"), ("questions", "answer_block_ids", "d", "Q_9", "blk_7", "missing", "2024-02"),
        ("raw_blocks", "refs", "d", "1", "eq 4.5", "missing", "2024-02"),
    ])


def test_refs_with_a_lead_in(spark):
    blocks = [("d", "blk_1", "Fig. 2.3: x", T0, None, "x"), ("d", "blk_2", "As in Fig. 2.4", T0, None, "x")]
    raw = [(1, "d", ["see Fig. 2.3", "see Fig. 2.4", "cf. table 1.1 and (eqs. (4.05))", "config 7.7", "see the figure"], T1), (2, "d", None, T1), (3, "d", [], T1)]
    got = report(spark, blocks=blocks, raw=raw)
    assert got == [("raw_blocks", "refs", "d", "1", key, "missing", "2024-02") for key in ("eq 4.5", "fig 2.4", "table 1.1")]


def test_states_merge_like_one_pass(spark):
    blocks, nodes, questions, edges, pages, raw = tables(spark, blocks=[("d", "a", None, T0, None, "x"), ("d", "b", None, T1, T2, "x")], edges=[(1, "d", "a", "b", T1), (2, "d", "c", "a", T0)])
    refs = R.reference_deltas(R.references(edges, questions, raw))
    rows = R.existence_deltas(R.records(blocks, nodes, questions, pages))
    once = {tuple(r) for r in R.orphan_keys(R.merge(refs, rows)).collect()}
    assert {tuple(r) for r in R.orphan_keys(R.merge(R.merge(refs), R.merge(rows))).collect()} == once
    # a record that is withdrawn makes its references orphans, one that comes makes them whole
    gone = R.existence_deltas(R.records(blocks.filter("block_id = 'a'"), nodes, questions, pages), -1)
    assert ("a", "missing") in {(r.target_key, r.state) for r in R.orphan_keys(R.merge(R.merge(refs, rows), gone)).collect()}
    came = R.existence_deltas(R.records(spark.createDataFrame([("d", "c", None, T0, None, "x")], BLOCKS), nodes, questions, pages))
    assert "c" not in {r.target_key for r in R.orphan_keys(R.merge(R.merge(refs, rows), came)).collect()}


def test_changes_with_withdrawals_equal_a_rebuild(spark):
    blocks, nodes, questions, edges, pages, raw = tables(
        spark, blocks=[("d", "a", None, T0, None, "x"), ("d", "a", None, T2, None, "x"), ("d", "b", None, T1, T2, "x"), ("d", "c", None, T2, None, "x")],
        edges=[(1, "d", "a", "b", T1), (2, "d", "c", "a", T0), (3, "d", "c", "e", T2), (4, "d", "b", "c", T2)],
    )
    refs, rows = R.references(edges, questions, raw), R.records(blocks, nodes, questions, pages)
    whole = lambda f, r: {tuple(x) for x in R.orphan_keys(R.merge(R.reference_deltas(f), R.existence_deltas(r))).collect()}
    state = R.merge(R.reference_deltas(refs), R.existence_deltas(rows))
    # edge 2 is the only reference before c came, and the first delivery of a the only one in time: both go
    gone_refs, left_refs = refs.filter("ref_key = '2'"), refs.filter("ref_key <> '2'")
    first = "target_key = 'a' and month(ingested_at) = 1"
    gone_rows, left_rows = rows.filter(first), rows.filter(f"not ({first})")
    after = R.apply_changes(state, refs.limit(0), rows.limit(0), gone_refs, gone_rows, left_refs, left_rows)
    got = {tuple(x) for x in R.orphan_keys(after).collect()}
    assert got == whole(left_refs, left_rows)
    assert {r[1] for r in got} == {"a", "b", "e"}
    none = tables(spark)
    assert R.orphan_keys_from_changes(*none).collect() == []
    both = R.orphan_keys_from_changes(blocks, nodes, questions, edges, pages, raw)
    assert {(r.target_key, r.reason) for r in both.collect()} == {(k, s or "late") for _, k, _, s, _ in whole(refs, rows)}


def test_hot_key_and_counts(spark):
    edges = [(i, "d", "gone", "gone", T1) for i in range(500)]
    counts = [tuple(r) for r in R.orphan_counts(R.orphan_references(*tables(spark, edges=edges))).collect()]
    assert sorted(counts) == [("edges", "dst", "missing", "2024-02", 500, 1), ("edges", "src", "missing", "2024-02", 500, 1)]


def test_empty(spark):
    assert report(spark) == []


def test_month_is_utc_in_any_session(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    df = tables(spark, edges=[(1, "d", "x", "x", T2)])
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        months = {r.ref_month for r in R.orphan_references(*df).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert months == {"2024-03"}
