"""Questions put together from blocks.

Roots, spans, parts, stems, marks, options and assets are found by their own
operators; here they become one flat table of question nodes with links to the
parent. A node's id is the id of its block; a part that was cut out of a block's
text has the block's id, '#' and its label.

Defined results: a chain of continuations that runs into a circle is not followed; a root is always at the top, also where its block is part of
another; a part belongs to the first question above it; blank texts stay blank;
blocks that a question's text takes up are listed in its source_blocks once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.functions import text as T
from folioflow.operators import discover, hierarchy, reconstruct
from folioflow.session import stage

KEY = ["document_id", "block_id"]
# How sure a question is that was found in such a place.
DISCOVERY = {"container": 0.95, "question": 0.85, "other": 0.6, "split": 0.80}
EQUATION_SIGNS = ("=", "λ", "ν")


def part_blocks(blocks: DataFrame, roots: DataFrame) -> DataFrame:
    """document_id, block_id and parent_id of the blocks that are parts of a question: by their role, or asking blocks below another block."""
    role = F.coalesce("group_role", F.lit(""))
    by_role = role.isin("subpart", "or_alternative") & ~F.col("block_type").isin(*T.ANSWER_TYPES, *T.ASSET_TYPES)
    parts = blocks.filter("part_of_id is not null").filter(F.col("block_type").isin("question", "worked_example") | by_role)
    return parts.join(roots.select(*KEY), KEY, "left_anti").select(*KEY, F.col("part_of_id").alias("parent_id"))


def question_tree(roots: DataFrame, parts: DataFrame) -> DataFrame:
    """document_id, block_id, parent_id, root_id and depth of the roots and of the parts that hang on one."""
    links = roots.select("document_id", F.col("block_id").alias("node"), F.lit(None).cast("string").alias("parent")).unionByName(parts.select("document_id", F.col("block_id").alias("node"), F.col("parent_id").alias("parent")))
    links = links.select(F.lit("built").alias("tree"), "document_id", "node", "parent", F.lit(True).alias("present"))
    solved = hierarchy.resolve(hierarchy.node_table(links)).filter("tree_state = 'tree' and depth > 0")
    below = solved.select("document_id", F.col("node_id").alias("block_id"), "root_id", "depth").join(roots.select("document_id", F.col("block_id").alias("root_id")), ["document_id", "root_id"], "left_semi").join(parts, KEY)
    top = roots.select(*KEY, F.lit(None).cast("string").alias("parent_id"), F.col("block_id").alias("root_id"), F.lit(0).alias("depth"))
    return top.unionByName(below.select(*KEY, "parent_id", "root_id", "depth"))


def _joined(rows: DataFrame, order: str) -> tuple[Column, Column]:
    """Texts of rows in order, and their block ids."""
    listed = F.array_sort(F.collect_list(F.struct(order, "block_id", T.text_of("text").alias("t"))))
    return F.array_join(F.transform(listed, lambda x: x["t"]), " "), F.transform(listed, lambda x: x["block_id"])


def node_texts(tree: DataFrame, spans: DataFrame, blocks: DataFrame) -> DataFrame:
    """document_id, block_id, own_text and own_blocks: a root's span, or a part with what continues it."""
    texts = blocks.select(*KEY, "text")
    in_span = spans.select("document_id", F.col("anchor_id").alias("node_id"), F.col("segment").alias("at"), F.col("row_id").alias("block_id"))
    span_nodes = in_span.join(tree.filter("depth = 0").select("document_id", F.col("block_id").alias("node_id")), ["document_id", "node_id"], "left_semi")
    others = tree.select("document_id", F.col("block_id").alias("node_id")).join(span_nodes.select("document_id", "node_id").distinct(), ["document_id", "node_id"], "left_anti")
    # a block hangs on the one that continues it, so its path to the root, read backwards, is its chain
    link = lambda node, parent: (F.lit("next").alias("tree"), "document_id", node.alias("node"), parent.alias("parent"), F.lit(True).alias("present"))
    onward = blocks.filter("continues_to is not null").select(*link(F.col("block_id"), F.col("continues_to")))
    reached = onward.select("document_id", F.col("parent").alias("block_id")).distinct().join(blocks.select(*KEY), KEY).select(*link(F.col("block_id"), F.lit(None).cast("string")))
    chains = hierarchy.resolve(hierarchy.node_table(onward.unionByName(reached)), keep_path=True).filter("tree_state = 'tree' and depth > 0")
    chains = chains.select("document_id", "node_id", F.posexplode(F.reverse(F.split("path", hierarchy.SEP))).alias("at", "block_id")).filter("at > 0")
    chained = chains.join(others, ["document_id", "node_id"], "left_semi").select("document_id", "node_id", "at", "block_id")
    alone = others.select("document_id", "node_id", F.lit(0).alias("at"), F.col("node_id").alias("block_id"))
    rows = span_nodes.unionByName(alone).unionByName(chained).join(texts, KEY)
    text, ids = _joined(rows, "at")
    return rows.groupBy("document_id", "node_id").agg(F.trim(text).alias("own_text"), ids.alias("own_blocks")).withColumnRenamed("node_id", "block_id")


def build(blocks: DataFrame, roots: DataFrame, spans: DataFrame, marks: DataFrame, edges: DataFrame) -> DataFrame:
    """One row per question node.

    blocks as live_blocks() gives them; roots(document_id, block_id, source_type);
    spans(document_id, anchor_id, segment, row_id); marks(document_id, block_id,
    marks, marks_source); edges as stored.
    """
    parts = part_blocks(blocks, roots)
    tree = stage(question_tree(roots, parts), "question-tree")
    own = stage(node_texts(tree, spans, blocks), "question-texts")
    below = tree.filter("parent_id is not null").groupBy("document_id", F.col("parent_id").alias("block_id")).agg(F.count(F.lit(1)).alias("n_parts"))
    # the stem of a root container: blocks before its first part that its span has not taken up
    stems = discover.stem_blocks(blocks).join(tree.filter("depth = 0").select("document_id", F.col("block_id").alias("container_id")), ["document_id", "container_id"], "left_semi")
    stems = stems.join(below.select("document_id", F.col("block_id").alias("container_id")), ["document_id", "container_id"], "left_semi")
    taken = own.select("document_id", F.col("block_id").alias("container_id"), F.explode("own_blocks").alias("block_id"))
    stems = stems.join(taken, ["document_id", "container_id", "block_id"], "left_anti").join(blocks.select(*KEY, "text", "reading_order"), KEY)
    stem_text, stem_ids = _joined(stems, "reading_order")
    stems = stems.groupBy("document_id", F.col("container_id").alias("block_id")).agg(F.trim(stem_text).alias("stem"), stem_ids.alias("stem_blocks"))
    equations = blocks.filter("block_type = 'equation' and part_of_id is not null").select("document_id", F.col("part_of_id").alias("block_id")).distinct().withColumn("has_equation", F.lit(True))
    assets = discover.related_assets(blocks, edges).groupBy(*KEY).agg(F.array_join(F.array_sort(F.collect_set("asset_id")), ",").alias("related_assets"))
    b = blocks.select(*KEY, "block_type", "group_role", F.col("enumerator").alias("question_number"), "or_group_id", "text", F.try_element_at("tags", F.lit("bloom")).alias("bloom_level"))
    d = tree.join(b, KEY).join(own, KEY).join(below, KEY, "left").join(stems, KEY, "left").join(equations, KEY, "left").join(assets, KEY, "left").join(marks, KEY, "left")
    d = d.join(roots.select("document_id", F.col("block_id").alias("root_id"), "source_type"), ["document_id", "root_id"])
    whole = F.trim(F.concat_ws(" ", "own_text", F.coalesce("stem", F.lit(""))))
    has_parts = F.col("n_parts") > 0
    case = F.coalesce(F.col("stem") != "", F.lit(False)) & F.coalesce(has_parts, F.lit(False))
    equation = F.coalesce("has_equation", F.lit(False))
    for sign in EQUATION_SIGNS:
        equation = equation | F.contains(T.text_of("text"), F.lit(sign))
    d = d.withColumns({"question_text": whole, "is_case": case}).withColumn("k", T.question_type("question_text", F.coalesce(has_parts, F.lit(False)), F.col("is_case"), equation, F.col("marks"), F.col("block_type") == "activity"))
    sure = F.when((F.coalesce("group_role", F.lit("")) == "container") | (F.col("block_type") == "worked_example"), DISCOVERY["container"]).when(F.col("block_type") == "question", DISCOVERY["question"]).otherwise(DISCOVERY["other"])
    return d.select(
        "document_id", F.col("block_id").alias("question_id"), "parent_id", "root_id", "depth", "source_type", F.col("k.kind").alias("question_type"), F.col("k.confidence").alias("type_confidence"),
        "question_number", "question_text", F.col("own_text").alias("asked_text"), "bloom_level", "marks", "marks_source", F.col("or_group_id").alias("choice_group"), "is_case", F.coalesce("n_parts", F.lit(0)).alias("n_parts"), sure.alias("discovery"),
        F.array_join(F.array_distinct(F.concat("own_blocks", F.coalesce("stem_blocks", F.array().cast("array<string>")))), ",").alias("source_blocks"), F.coalesce("related_assets", F.lit("")).alias("related_assets"),
    )


def split_parts(built: DataFrame, blocks: DataFrame) -> DataFrame:
    """Parts that stand inside the text of one root block and have no block of their own, with the slice of the answer that carries their label."""
    roots = built.filter("depth = 0").select("document_id", F.col("question_id").alias("block_id"), "source_type").join(blocks.select(*KEY, "text"), KEY)
    rows = roots.filter("text is not null").select(F.concat_ws("\x01", "document_id", "block_id").alias("row_id"), "text")
    segments = reconstruct.split_inward(rows, "row_id", "text")
    answers = segments.filter("role = 'answer'").select("row_id", F.col("start").alias("a_start"), F.col("end").alias("a_end"))
    parts = segments.filter("role = 'subpart'").join(rows, "row_id").join(answers, "row_id", "left")
    have = built.filter("parent_id is not null").select("document_id", F.col("parent_id").alias("block_id"), F.lower(F.translate(F.coalesce("question_number", F.lit("")), "() ", "")).alias("label")).distinct()
    at = F.split("row_id", "\x01")
    cut = parts.select(at[0].alias("document_id"), at[1].alias("block_id"), F.col("enumerator").alias("label"), "start", "end", F.trim(F.substring("text", F.col("start") + 1, F.col("end") - F.col("start"))).alias("question_text"), F.substring("text", F.col("a_start") + 1, F.col("a_end") - F.col("a_start")).alias("answer"))
    new = cut.join(have, ["document_id", "block_id", "label"], "left_anti").join(roots.select(*KEY, "source_type"), KEY)
    labelled = T.marker_segments("answer", reconstruct.MARKER)
    own = F.filter(labelled, lambda s: F.lower(F.regexp_extract(s["text"], r"^\(\s*([A-Za-z]+)\s*\)", 1)) == F.col("label"))
    equation = F.lit(False)
    for sign in EQUATION_SIGNS:
        equation = equation | F.contains("question_text", F.lit(sign))
    no = F.lit(False)
    kind = T.question_type("question_text", no, no, equation, F.lit(None).cast("double"), no)
    return new.select(
        "document_id", F.concat_ws("#", "block_id", "label").alias("question_id"), F.col("block_id").alias("parent_id"), "source_type", kind["kind"].alias("question_type"), F.col("label").alias("question_number"), "question_text",
        "start", "end", F.trim(F.get(own, F.lit(0))["text"]).alias("answer_inline"), F.lit(DISCOVERY["split"]).alias("discovery"),
    )


def full_texts(built: DataFrame) -> DataFrame:
    """document_id, root_id and full_text: a question's text with those of all of its parts, in the order of their ids within each depth."""
    rows = F.array_sort(F.collect_list(F.struct("depth", "question_id", F.col("question_text").alias("t"))))
    return built.groupBy("document_id", "root_id").agg(F.trim(F.array_join(F.transform(rows, lambda x: x["t"]), " ")).alias("full_text"))
