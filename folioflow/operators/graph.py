"""The typed graph of documents: nodes, edges and their integrity."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.functions import text as T


def nodes(blocks: DataFrame, hierarchy: DataFrame, pages: DataFrame) -> DataFrame:
    """document_id, node_id, kind, node_type and label of documents, pages, sections and blocks, each once."""
    cols = ("document_id", "node_id", "kind", "node_type", "label")
    docs = blocks.select("document_id").unionByName(hierarchy.select("document_id")).unionByName(pages.select("document_id")).filter("document_id is not null").distinct()
    docs = docs.select("document_id", F.col("document_id").alias("node_id"), F.lit("document").alias("kind"), F.lit("document").alias("node_type"), F.col("document_id").alias("label"))
    page = pages.filter("document_id is not null and page_index is not null").groupBy("document_id", "page_index").agg(F.max("printed_page").alias("printed"))
    page = page.select("document_id", F.concat(F.lit("page_"), F.col("page_index").cast("string")).alias("node_id"), F.lit("page").alias("kind"), F.lit("page").alias("node_type"), F.concat(F.lit("p."), F.coalesce("printed", "page_index").cast("string")).alias("label"))
    section = hierarchy.filter("document_id is not null and node_id <> ''").groupBy("document_id", "node_id").agg(F.min("kind").alias("k"), F.min("title").alias("label"))
    section = section.select("document_id", "node_id", F.when(F.col("k").isin("topic", "chapter"), "topic").otherwise("section").alias("kind"), F.coalesce("k", F.lit("section")).alias("node_type"), "label")
    block = blocks.select("document_id", F.col("block_id").alias("node_id"), F.lit("block").alias("kind"), F.col("block_type").alias("node_type"), F.substring(F.coalesce("text", "caption", "block_type"), 1, 80).alias("label"))
    return reduce(DataFrame.unionByName, [d.select(*cols) for d in (docs, page, section, block)])


def _edge(df: DataFrame, src: Column, dst: Column, kind: str) -> DataFrame:
    return df.select("document_id", src.alias("src"), dst.alias("dst"), F.lit(kind).alias("edge_type"))


def edges(blocks: DataFrame, hierarchy: DataFrame) -> DataFrame:
    """document_id, src, dst and edge_type of all relations that the tables hold; blocks has prev_id and next_id.

    Alternatives of one group are each tied to the group's first member and back,
    which gives the same neighbourhoods as all pairs without their number.
    """
    c = F.col
    page = F.concat(F.lit("page_"), c("page_index").cast("string"))
    listed = hierarchy.filter("document_id is not null and node_id <> ''").select("document_id", "node_id", F.explode("children").alias("child")).filter("child <> ''").distinct()
    known = hierarchy.filter("document_id is not null and node_id <> ''").select("document_id", c("node_id").alias("child")).distinct()
    tree = listed.join(known, ["document_id", "child"], "left_semi")
    in_section = blocks.filter("section_id is not null")
    ids = blocks.select("document_id", c("block_id").alias("to"))
    at = lambda column: blocks.filter(c(column).isNotNull()).select("document_id", "block_id", c(column).alias("to")).join(ids, ["document_id", "to"], "left_semi")
    captions = blocks.filter("block_type = 'caption'").select("document_id", c("block_id").alias("next_id"))
    assets = blocks.filter(c("block_type").isin(*T.ASSET_TYPES))
    group = blocks.filter("or_group_id is not null")
    first = group.groupBy("document_id", "or_group_id").agg(F.min("block_id").alias("first"))
    pairs = group.join(first, ["document_id", "or_group_id"]).filter("block_id <> first")
    parts = [
        _edge(tree, c("node_id"), c("child"), "contains"), _edge(tree, c("child"), c("node_id"), "child_of"),
        _edge(in_section, c("section_id"), c("block_id"), "contains"), _edge(in_section, c("block_id"), c("section_id"), "child_of"),
        _edge(blocks.filter("page_index is not null"), c("block_id"), page, "located_on"), _edge(assets.filter("page_index is not null"), c("block_id"), page, "derived_from"),
        _edge(blocks.filter("next_id is not null"), c("block_id"), c("next_id"), "reading_next"), _edge(assets.join(captions, ["document_id", "next_id"], "left_semi"), c("block_id"), c("next_id"), "has_caption"),
        _edge(at("part_of_id"), c("block_id"), c("to"), "part_of"), _edge(at("continues_to"), c("block_id"), c("to"), "continues"),
        _edge(pairs, c("block_id"), c("first"), "or_alternative"), _edge(pairs, c("first"), c("block_id"), "or_alternative"),
    ]
    return reduce(DataFrame.unionByName, parts).distinct()


def edge_counts(e: DataFrame) -> DataFrame:
    """Edges per type."""
    return e.groupBy("edge_type").agg(F.count(F.lit(1)).alias("n_edges"))


def neighbours(e: DataFrame, wanted: DataFrame, edge_type: str | None = None) -> DataFrame:
    """Nodes that the wanted(document_id, node_id) nodes lead to, of one type of edge or of any."""
    e = e.filter(F.col("edge_type") == edge_type) if edge_type else e
    return e.join(wanted.select("document_id", F.col("node_id").alias("src")), ["document_id", "src"], "left_semi").select("document_id", F.col("src").alias("node_id"), F.col("dst").alias("near_id"), "edge_type").distinct()


def dangling(e: DataFrame, n: DataFrame) -> DataFrame:
    """Edges of which an end is no node, with the end."""
    known = n.select("document_id", F.lower("node_id").alias("id")).distinct()
    ends = e.select("document_id", "src", "dst", "edge_type", F.explode(F.array(F.struct(F.lit("src").alias("side"), F.lower(F.trim("src")).alias("id")), F.struct(F.lit("dst").alias("side"), F.lower(F.trim("dst")).alias("id")))).alias("x"))
    return ends.select("document_id", "edge_type", "x.side", "x.id").filter("id <> ''").join(known, ["document_id", "id"], "left_anti").groupBy("edge_type", "side").agg(F.count(F.lit(1)).alias("n_dangling"), F.countDistinct("document_id", "id").alias("n_targets"))


def duplicate_edges(e: DataFrame) -> DataFrame:
    """Surplus copies of edges per type."""
    one = e.groupBy("document_id", "src", "dst", "edge_type").agg(F.count(F.lit(1)).alias("n"))
    return one.filter("n > 1").groupBy("edge_type").agg(F.sum(F.col("n") - 1).alias("surplus"))


def missed_containers(blocks: DataFrame, questions: DataFrame) -> DataFrame:
    """Container blocks that no question has as a source."""
    used = questions.select("document_id", F.explode("source_blocks").alias("x")).select("document_id", F.lower(F.trim("x")).alias("block_id"))
    return blocks.filter("group_role = 'container'").select("document_id", "block_id").join(used, ["document_id", "block_id"], "left_anti")
