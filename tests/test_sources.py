import io
import struct
import zipfile
import zlib

import pytest

from folioflow.sources import cache, files, parsers, sinks


def png(w, h):
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 0, 0, 0, 0))


def archive(members):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, data in members:
            z.writestr(name, data)
    return out.getvalue()


def test_folder_precedence_and_provenance(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    for name, data in (("b.png", png(3, 4)), ("sub/a.png", png(5, 6)), ("c.txt", b"text"), ("d.pdf", b"%PDF"), ("e.docx", b"x")):
        (tmp_path / name).write_bytes(data)
    plan = files.plan_inputs(files.read_files(spark, str(tmp_path)))
    got = {r.path.rsplit("/", 1)[1]: (r.page_index, r.ignored) for r in plan.collect()}
    assert got == {"b.png": (0, None), "a.png": (1, None), "c.txt": (None, "image pages take precedence"), "d.pdf": (None, "image pages take precedence"), "e.docx": (None, "unsupported file type")}
    assert [(r.n_files, r.n_taken, r.n_ignored, r.supported) for r in files.ingest_report(plan).collect()] == [(5, 2, 3, True)]
    prov = files.page_provenance(plan).orderBy("page_index").collect()
    assert [(r.width, r.height, r.n_bytes, len(r.sha256)) for r in prov] == [(3, 4, len(png(3, 4)), 64), (5, 6, len(png(5, 6)), 64)]


@pytest.mark.parametrize(("members", "want"), [
    ([("a.txt", b"x"), ("run.sh", b"x"), ("deep/b.txt", b"y")], {("a.txt", None), ("run.sh", "executable content"), ("deep/b.txt", None)}),
    ([("../a.txt", b"x")], {("../a.txt", "unsafe path")}), ([("/a.txt", b"x")], {("/a.txt", "unsafe path")}), ([("C:/a.txt", b"x")], {("C:/a.txt", "unsafe path")}), ([], {("", "empty archive")}),
])
def test_archives(spark, members, want):
    df = spark.createDataFrame([("in.zip", bytearray(archive(members))), ("x.txt", bytearray(b"t"))], "path string, content binary")
    rows = files.expand_archives(df).collect()
    assert {(r.path.partition("!")[2], r.reason) for r in rows if r.path.startswith("in.zip")} == want
    assert [r.path for r in rows if r.path == "x.txt"] == ["x.txt"]


def test_bad_archives(spark):
    big = io.BytesIO()
    with zipfile.ZipFile(big, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("a.txt", b"0" * 5_000_000)
    df = spark.createDataFrame([("a.zip", bytearray(b"not a zip")), ("b.zip", bytearray(big.getvalue()))], "path string, content binary")
    assert {r.reason for r in files.expand_archives(df).collect()} == {"malformed archive", "suspicious compression"}


def test_image_sizes():
    jpeg = b"\xff\xd8" + b"\xff\xe0" + struct.pack(">H", 4) + b"xx" + b"\xff\xc0" + struct.pack(">HBHH", 11, 8, 7, 9) + b"\0" * 6
    assert files.image_size(jpeg) == (9, 7) and files.image_size(b"GIF89a" + struct.pack("<HH", 2, 3)) == (2, 3) and files.image_size(b"?") is None and files.image_size(None) is None


def test_markdown_html_tables(spark):
    md = spark.createDataFrame([(1, "# Title\n\ntext\n\n| a | b |\n\n- x\n\n$$y$$\n\n  \n\n"), (2, None)], "i int, t string")
    assert [(r.block_type, r.text) for r in parsers.markdown_blocks(md, "i", "t").orderBy("ix").collect()] == [("heading", "Title"), ("paragraph", "text"), ("table", "| a | b |"), ("list", "- x"), ("equation", "$$y$$")]
    html = spark.createDataFrame([(1, "<html><title>T</title><h1>A <b>b</b></h1><p class='x'>one\n two</p><ul><li>l</li></ul><footer>f</footer><p></p></html>")], "i int, t string")
    assert [(r.block_type, r.text) for r in parsers.html_blocks(html, "i", "t").orderBy("ix").collect()] == [("chapter", "T"), ("heading", "A b"), ("paragraph", "one two"), ("list_item", "l"), ("noise", "f")]
    cells = parsers.table_cells(spark.createDataFrame([(1, "a | b\nplain\n1 | 2")], "i int, t string"), ["i"], "t").collect()
    assert {(r.row_ix, r.cell_ix, r.cell) for r in cells} == {(0, 0, "a"), (0, 1, "b"), (2, 0, "1"), (2, 1, "2")}


def test_routing(spark):
    pages = spark.createDataFrame([("d", 0, 100, 100), ("d", 1, 100, 100), ("e", 0, 100, 100)], "document_id string, page_index int, width int, height int")
    rows = [("d", 0, "x" * 120, 0.0, 0.0, 50.0, 50.0), ("d", 1, "7", 0.0, 0.0, 5.0, 5.0), ("e", 0, "x" * 200, 0.0, 0.0, 90.0, 90.0)]
    routes = parsers.route_pages(spark.createDataFrame(rows, "document_id string, page_index int, text string, x0 double, y0 double, x1 double, y1 double"), pages)
    assert {(r.document_id, r.page_index): r.route for r in routes.collect()} == {("d", 0): "text_layer", ("d", 1): "ocr", ("e", 0): "text_layer"}
    assert {(r.document_id, r.born_digital, r.mixed, r.parser) for r in parsers.routing_summary(routes).collect()} == {("d", False, True, "vision"), ("e", True, False, "layout")}


def test_parsers_keep_unreadable_pages(spark):
    out = parsers.build_parser("markdown").parse(spark.createDataFrame([("d", 0, "# A"), ("d", 1, None)], "document_id string, page_index int, content string"))
    assert {(r.page_index, r.status, r.text) for r in out.collect()} == {(0, "ok", "A"), (1, "failed", None)}
    with pytest.raises(ValueError):
        parsers.build_parser("none")
    parsers.register_parser("mine", parsers.MarkdownParser)
    assert isinstance(parsers.build_parser("mine"), parsers.MarkdownParser)


def test_cache_never_serves_failures(spark, tmp_path):
    schema = "page_sha string, model string, prompt_version string, status string, truncated boolean, failure_reason string, n_blocks int"
    rows = [("a", "m", "v", "ok", False, None, 2), ("b", "m", "v", "ok", True, None, 2), ("c", "m", "v", "ok", None, None, 0), ("d", "m", "v", "failed", None, "timeout", 0), ("e", "m", "v", None, None, None, None)]
    df = spark.createDataFrame(rows, schema)
    cache.put(df, f"file://{tmp_path}")
    assert {(r.page_sha, r.failure_reason) for r in spark.read.parquet(f"{tmp_path}/failures").collect()} == {("b", "truncated"), ("c", "empty"), ("d", "timeout"), ("e", "empty")}
    found = cache.lookup(df.select(*cache.KEY), spark.read.parquet(f"{tmp_path}/valid"))
    assert {r.page_sha for r in found.filter("from_cache").collect()} == {"a"} and cache.hit_rate(found).collect()[0].hit_rate_pct == 20.0
    keep, drop = cache.purge(df)
    assert (keep.count(), drop.count()) == (1, 4)


def test_sheets_and_graph_files(spark, tmp_path):
    tree = spark.createDataFrame([("d", "q1", 0, "q1"), ("d", "q2", 1, "q1/q2")], "document_id string, question_id string, depth int, id_path string")
    q = spark.createDataFrame([("d", "q1", "1", "A < b", "mcq", "activity", 2.0, [("a", "sand")], ("matched",)), ("d", "q2", None, "Why", None, None, None, None, None)], "document_id string, question_id string, question_number string, question_text string, question_type string, source_type string, marks double, options array<struct<opt_key string, opt_text string>>, answer_association struct<status string>")
    lines = [r.line for r in sinks.render_lines(tree, q).orderBy("id_path", "line_no").collect()]
    assert lines == ["1. A &lt; b", "mcq · activity · 2 marks", "(a) sand", "Answer", "  q2. Why", "  "]
    assert [tuple(r) for r in sinks.export_summary(tree, q).collect()] == [("d", 1, 2, 1, 0)]
    nodes = spark.createDataFrame([("d", "a"), ("d", "a")], "document_id string, node_id string")
    edges = spark.createDataFrame([("d", "a", "b", "part_of"), ("d", "b", "c", "contains")], "document_id string, src string, dst string, edge_type string")
    sinks.write_graph(nodes, edges, f"file://{tmp_path}/g")
    back = sinks.read_tables(spark, f"file://{tmp_path}/g", ["nodes", "edges", "none"])
    assert back["nodes"].count() == 1 and back["edges"].filter("edge_type = 'part_of'").count() == 1 and back["none"] is None
