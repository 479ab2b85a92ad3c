"""Finding questions among blocks, and what belongs to them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioflow.functions import text as T

IN_TEXT_LIMIT = 60
IN_TEXT_CHARS = (20, 600)
STEM_TYPES = ("paragraph", "list", "list_item", "table", "figure", "diagram", "image", "equation", "other", "callout", "note")
ASKING_TYPES = ("question", "worked_example", "activity")


def with_titles(blocks: DataFrame, hierarchy: DataFrame) -> DataFrame:
    """blocks with the title of their section."""
    titles = hierarchy.filter("document_id is not null and node_id <> ''").groupBy("document_id", F.col("node_id").alias("section_id")).agg(F.min("title").alias("section_title"))
    return blocks.join(titles, ["document_id", "section_id"], "left")


def roots(blocks: DataFrame, hierarchy: DataFrame) -> DataFrame:
    """document_id, block_id and source_type of the blocks that questions start from.

    A block asks by its type, by its section's heading, by its own words, or by the
    words of its parts; containers and top-level asking blocks are roots. A label
    without text of its own is none.
    """
    b = with_titles(blocks, hierarchy)
    parts = blocks.filter("part_of_id is not null and group_role in ('subpart', 'or_alternative')").filter(T.asks("text")).select("document_id", F.col("part_of_id").alias("block_id")).distinct().withColumn("part_asks", F.lit(True))
    b = b.join(parts, ["document_id", "block_id"], "left")
    e = T.enumerator("text")
    kind = T.section_kind("section_title")
    b = b.withColumns({"_style": e["style"], "_label": e["label"], "_kind": kind})
    example = F.coalesce(F.col("_style") == "example", F.lit(False))
    asking = F.col("block_type").isin(*ASKING_TYPES)
    is_candidate = asking | example | F.when(F.col("_kind") == "question", True).when(F.col("_kind") == "prose", False).otherwise(T.asks("text") | F.coalesce("part_asks", F.lit(False)))
    own = F.regexp_replace(F.regexp_replace(T.text_of("text"), r"^\s*\(?\s*[A-Za-z0-9.]{1,6}\s*[).]\s*", ""), r"\W", "")
    bare = F.col("_style").isNotNull() & (F.length(own) < 8) & ~asking
    role = F.coalesce("group_role", F.lit(""))
    top = (role == "container") | (~role.isin("subpart", "sub_subpart", "or_alternative", "content", "or_separator") & asking & F.col("part_of_id").isNull())
    source = F.when((F.col("block_type") == "worked_example") | example, "worked_example").when(F.col("_style") == "numbered", "solved_question").when(F.col("block_type") == "activity", "activity").when(F.col("block_type") == "question", "in_text").otherwise("other")
    return b.filter(is_candidate & ~bare & top).select("document_id", "block_id", source.alias("source_type"))


def marks(blocks: DataFrame, banners: DataFrame) -> DataFrame:
    """Marks of each block with their source: its own tag, else the banner in force, else none."""
    own = F.try_element_at("tags", F.lit("marks")).try_cast("double")
    b = blocks.join(banners.select("document_id", "block_id", "banner_marks"), ["document_id", "block_id"], "left")
    return b.select("document_id", "block_id", F.coalesce(own, F.col("banner_marks").cast("double")).alias("marks"), F.when(own.isNotNull(), "explicit").when(F.col("banner_marks").isNotNull(), "section_banner").alias("marks_source")).filter("marks is not null")


def related_assets(blocks: DataFrame, edges: DataFrame) -> DataFrame:
    """document_id, block_id and asset_id: what a block refers to, and the assets that are part of it."""
    assets = blocks.filter(F.col("block_type").isin(*T.ASSET_TYPES)).select("document_id", F.col("block_id").alias("asset_id"))
    refers = edges.filter("edge_type = 'refers_to'").select("document_id", F.lower(F.trim("src")).alias("block_id"), F.lower(F.trim("dst")).alias("asset_id"))
    parts = blocks.filter("part_of_id is not null").select("document_id", F.col("part_of_id").alias("block_id"), F.col("block_id").alias("asset_id"))
    return refers.join(blocks.select("document_id", "block_id"), ["document_id", "block_id"], "left_semi").unionByName(parts).join(assets, ["document_id", "asset_id"], "left_semi").select("document_id", "block_id", "asset_id").distinct()


def stem_blocks(blocks: DataFrame) -> DataFrame:
    """Blocks between a container and its first part or the section's next container that belong to its stem."""
    first = blocks.filter("part_of_id is not null").groupBy("document_id", F.col("part_of_id").alias("container_id")).agg(F.min("reading_order").alias("first_part"))
    containers = blocks.filter("group_role = 'container' and section_id is not null").select("document_id", "section_id", F.col("block_id").alias("container_id"), F.col("reading_order").alias("at"))
    following = F.lead("at").over(Window.partitionBy("document_id", "section_id").orderBy("at"))
    bounds = containers.withColumn("following", following).join(first, ["document_id", "container_id"], "left").withColumn("end", F.least("following", "first_part"))
    stems = blocks.filter(F.col("block_type").isin(*STEM_TYPES) & F.col("part_of_id").isNull()).select("document_id", "section_id", "block_id", "reading_order")
    return stems.join(bounds, ["document_id", "section_id"]).filter((F.col("reading_order") > F.col("at")) & (F.col("end").isNull() | (F.col("reading_order") < F.col("end")))).select("document_id", "container_id", "block_id")


def in_text_candidates(blocks: DataFrame, questions: DataFrame, limit: int = IN_TEXT_LIMIT) -> DataFrame:
    """Prose with a question mark that no question covers, the first of each document (the bound is the feature)."""
    used = questions.select("document_id", F.explode("source_blocks").alias("x")).select("document_id", F.lower(F.trim("x")).alias("block_id"))
    length = F.length(T.text_of("text"))
    prose = blocks.filter(F.col("block_type").isin("paragraph", "callout", "note", "activity") & F.contains(T.text_of("text"), F.lit("?")) & length.between(*IN_TEXT_CHARS))
    free = prose.join(used, ["document_id", "block_id"], "left_anti")
    place = F.row_number().over(Window.partitionBy("document_id").orderBy("reading_order"))
    return free.withColumn("place", place.cast("int")).filter(F.col("place") <= limit).select("document_id", "block_id", "place")


def label_order(questions: DataFrame) -> DataFrame:
    """place of each question among its parent's: by roman number or letter of its label, then by its ordinal."""
    one = questions.filter("document_id is not null and question_id is not null and parent_id is not null").dropDuplicates(["document_id", "question_id"])
    label = F.regexp_replace(F.lower(F.coalesce("question_number", F.lit(""))), r"[^a-z0-9]", "")
    roman = F.array_position(F.array(*map(F.lit, ("i", "ii", "iii", "iv", "v", "vi", "vii", "viii", "ix", "x"))), label)
    rank = F.when(roman > 0, roman).when(label.rlike("^[a-z]$"), F.ascii(label) - 96).when(label.rlike(r"^\d{1,9}$"), label.try_cast("int")).otherwise(99).cast("int")
    w = Window.partitionBy("document_id", "parent_id").orderBy("rank", "ordinal", "question_id")
    return one.select("document_id", "parent_id", "question_id", "ordinal", rank.alias("rank")).withColumn("place", F.row_number().over(w).cast("int")).select("document_id", "parent_id", "question_id", "rank", "place")


def document_meta(blocks: DataFrame) -> DataFrame:
    """Chapter title, its number and the grade that each document states: from its first chapter or topic, and from the first block with a grade."""
    t = T.text_of("text")
    grade = F.nullif(F.regexp_extract(t, r"\bClass\s+(XII|XI|IX|X|VIII|VII|VI|\d{1,2})\b", 1), F.lit(""))
    title = F.when(F.col("block_type").isin("chapter", "topic") & (F.trim(t) != ""), F.struct("reading_order", F.trim(t).alias("t")))
    d = blocks.groupBy("document_id").agg(F.min(title).alias("first"), F.min_by(grade, F.when(grade.isNotNull(), F.col("reading_order"))).alias("grade"))
    return d.select("document_id", F.col("first.t").alias("chapter"), F.nullif(F.regexp_extract("first.t", r"\b(\d{1,2})\b", 1), F.lit("")).alias("chapter_number"), "grade")


def adjudication_items(associations: DataFrame, leaves: DataFrame, evidence: DataFrame, blocks: DataFrame) -> DataFrame:
    """Questions that rules leave open, with their candidates as JSON for an outside judge: six at most, texts cut to what it reads."""
    keys = ["document_id", "question_id"]
    open_ = associations.filter("status = 'ambiguous'").select(*keys)
    c = evidence.join(open_, keys, "left_semi").drop("block_type", "reading_order").join(blocks.select("document_id", "block_id", "block_type", F.substring(F.coalesce("text", "caption", F.lit("")), 1, 220).alias("text")), ["document_id", "block_id"])
    listed = c.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("rank", "block_id", "block_type", "relationship", "text"))).alias("candidates"))
    q = leaves.select(*keys, F.substring(T.text_of("question_text"), 1, 400).alias("question_text"))
    return listed.join(q, keys).select(*keys, F.to_json(F.struct("question_id", "question_text", "candidates")).alias("item"))


def missing_vectors(texts: DataFrame, stored: DataFrame) -> DataFrame:
    """Texts (text_id, text) that have no vector under their hash yet: all that an embedder has to be asked for, each once."""
    keyed = texts.filter("text is not null").withColumn("text_key", T.short_hash("text"))
    return keyed.join(stored.select("text_key"), "text_key", "left_anti").dropDuplicates(["text_key"]).select("text_key", "text")
