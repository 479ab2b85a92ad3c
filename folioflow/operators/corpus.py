"""The corpus tables in the form that the other operators take, and their statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioflow.functions import geometry
from folioflow.functions import text as T

SPAN = 4096


def live_blocks(blocks: DataFrame) -> DataFrame:
    """One row per block: its latest delivery, unless that is deleted; type in lower case, '' links as null, corners of the box.

    The latest is a maximum per block, so a block delivered very often is
    pre-aggregated where it is read.
    """
    kept = [c for c in blocks.columns if c not in ("document_id", "block_id")]
    latest = blocks.filter("document_id is not null and block_id <> ''").groupBy("document_id", "block_id").agg(
        F.max_by(F.struct(*kept), F.struct(F.col("ingested_at"), F.col("deleted_at").isNotNull().alias("gone"))).alias("r"),
    )
    df = latest.filter("r.deleted_at is null").select("document_id", "block_id", "r.*")
    none = lambda c: F.nullif(F.col(c), F.lit(""))
    links = ("part_of_id", "continuation_of", "continues_to", "section_id")
    return geometry.with_corners(df.withColumns({"block_type": F.coalesce(F.lower("block_type"), F.lit("other"))} | {c: none(c) for c in links}))


def percent(part: Column, whole: Column) -> Column:
    """Share in percent, 0 of nothing."""
    return F.when(whole > 0, 100.0 * part / whole).otherwise(F.lit(0.0))


def type_counts(blocks: DataFrame) -> DataFrame:
    """Blocks per type."""
    return blocks.groupBy("block_type").agg(F.count(F.lit(1)).alias("n_blocks"))


def coverage(blocks: DataFrame) -> DataFrame:
    """Per document: blocks, pages, and the shares with text, box, link and asset type."""
    has_text = F.trim(T.text_of("text")) != ""
    n = F.count(F.lit(1))
    return blocks.groupBy("document_id").agg(
        n.alias("n_blocks"), F.countDistinct("page_index").alias("n_pages"),
        percent(F.count_if(has_text), n).alias("pct_text"), percent(F.count_if(F.col("x0").isNotNull()), n).alias("pct_box"),
        percent(F.count_if(F.col("block_type").isin(*T.ASSET_TYPES)), n).alias("pct_assets"), F.count_if(F.col("block_type").isin(*T.ASSET_TYPES) & F.col("caption").isNotNull()).alias("n_captioned"),
    )


def provenance(blocks: DataFrame) -> DataFrame:
    """Per document: blocks with all of page, position, box and confidence, and whether all are complete."""
    whole = F.col("page_index").isNotNull() & F.col("reading_order").isNotNull() & F.col("x0").isNotNull() & F.col("extraction_confidence").isNotNull()
    return blocks.groupBy("document_id").agg(F.count_if(whole).alias("n_complete"), F.bool_and(whole).alias("all_complete"))


def confidence(blocks: DataFrame, threshold: float = 0.6) -> DataFrame:
    """Per document: mean and least extraction confidence and the share below a threshold."""
    c = F.col("extraction_confidence")
    return blocks.groupBy("document_id").agg(
        F.avg(c).alias("mean_confidence"), F.min(c).alias("min_confidence"), percent(F.count_if(c < threshold), F.count(c)).alias("pct_below"),
    )


def lowest_confidence(blocks: DataFrame, k: int = 50) -> DataFrame:
    """The k blocks that were read with the least confidence (a top-k report)."""
    return blocks.filter("extraction_confidence is not null").select("document_id", "block_id", "extraction_confidence").orderBy("extraction_confidence", "document_id", "block_id").limit(k)


def order_integrity(blocks: DataFrame) -> DataFrame:
    """Per document: whether the reading order has gaps or repeats."""
    r = F.col("reading_order")
    n, d = F.count(F.lit(1)), F.countDistinct("reading_order")
    return blocks.groupBy("document_id").agg(n.alias("n_blocks"), (n - d).alias("n_repeats"), (F.max(r) - F.min(r) + 1 - d).alias("n_gaps"), ((F.max(r) - F.min(r) + 1 == n) & (d == n)).alias("contiguous"))


def integrity(blocks: DataFrame, pages: DataFrame) -> DataFrame:
    """Per document: upper median of blocks a page, pages without blocks, tiny and full-page boxes, prose without text, repeated texts."""
    page = pages.filter("document_id is not null and page_index is not null").groupBy("document_id", "page_index").agg(F.max("width").alias("width"), F.max("height").alias("height"))
    share = geometry.area() / (F.col("width") * F.col("height"))
    prose = F.col("block_type").isin("paragraph", "question", "answer", "solution", "explanation", "list_item")
    flags = blocks.join(page, ["document_id", "page_index"], "left").select(
        "document_id", "page_index", F.coalesce(share < 2e-4, F.lit(False)).alias("tiny"), F.coalesce((share > 0.95) & ~F.col("block_type").isin(*T.ASSET_TYPES), F.lit(False)).alias("full"),
        (prose & (F.trim(T.text_of("text")) == "")).alias("blank"),
    )
    per_page = flags.groupBy("document_id", "page_index").agg(F.count(F.lit(1)).alias("n"), F.count_if("tiny").alias("tiny"), F.count_if("full").alias("full"), F.count_if("blank").alias("blank"))
    all_pages = page.select("document_id", "page_index").unionByName(per_page.select("document_id", "page_index")).distinct().join(per_page, ["document_id", "page_index"], "left").fillna(0)
    # a histogram of counts, so that no document's pages are collected
    spread = all_pages.groupBy("document_id", "n").agg(F.count(F.lit(1)).alias("pages"), F.sum("tiny").alias("tiny"), F.sum("full").alias("full"), F.sum("blank").alias("blank"))
    w = Window.partitionBy("document_id")
    ranked = spread.withColumn("upto", F.sum("pages").over(w.orderBy("n"))).withColumn("all", F.sum("pages").over(w))
    return ranked.groupBy("document_id").agg(
        F.min(F.when(F.col("upto") > F.floor(F.col("all") / 2), F.col("n"))).alias("median_blocks"), F.coalesce(F.sum(F.when(F.col("n") == 0, F.col("pages"))), F.lit(0)).alias("empty_pages"),
        F.sum("tiny").alias("n_tiny"), F.sum("full").alias("n_full_page"), F.sum("blank").alias("n_textless"),
    )


def low_yield_pages(blocks: DataFrame, pages: DataFrame) -> DataFrame:
    """Pages with fewer blocks than max(2, a quarter of the document's median), with the median."""
    page = pages.filter("document_id is not null and page_index is not null").select("document_id", "page_index").distinct()
    n = blocks.groupBy("document_id", "page_index").agg(F.count(F.lit(1)).alias("n_blocks"))
    counted = page.join(n, ["document_id", "page_index"], "left").fillna(0)
    median = counted.groupBy("document_id").agg(F.median("n_blocks").alias("median_blocks"))
    return counted.join(median, "document_id").filter(F.col("n_blocks") < F.greatest(F.lit(2.0), 0.25 * F.col("median_blocks")))


def duplicate_texts(df: DataFrame, column: str, length: int | None = 200) -> DataFrame:
    """Texts that come more than once, by their first characters (None: all) in lower case and single blanks: surplus copies a key."""
    key = F.regexp_replace(F.lower(F.trim(T.text_of(column))), r"\s+", " ")
    key = F.trim(key) if length is None else F.substring(key, 1, length)
    return df.select(F.sha2(key, 256).alias("text_key"), key.alias("k")).filter("k <> ''").groupBy("text_key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("text_key", (F.col("n") - 1).alias("surplus"))


def block_tags(blocks: DataFrame) -> DataFrame:
    """Marks, Bloom level and source of the blocks that have any, and the heading level that a text hints at.

    What the parser tagged wins; what the text says itself fills the gaps.
    """
    own = lambda name: F.nullif(F.trim(F.try_element_at("tags", F.lit(name))), F.lit(""))
    said = lambda pattern: F.nullif(F.regexp_extract(T.text_of("text"), pattern, 1), F.lit(""))
    tags = blocks.select(
        "document_id", "block_id", F.coalesce(own("marks"), said(T.MARKS_AFTER_BLOOM), said(T.MARKS_BANNER)).alias("marks"), F.coalesce(own("bloom"), F.lower(said(T.BLOOM))).alias("bloom"), own("source").alias("source"),
        F.when(T.text_of("text").rlike(T.TOPIC_HEADING), 1).alias("level_hint"),
    )
    return tags.filter(F.coalesce("marks", "bloom", "source", F.col("level_hint").cast("string")).isNotNull())


def content_hash(blocks: DataFrame, span: int = SPAN) -> DataFrame:
    """SHA-256 of each document's blocks in reading order, as a hash of hashes over spans of positions."""
    line = F.concat_ws("|", "block_id", T.text_of("text"))
    part = blocks.groupBy("document_id", F.floor(F.col("reading_order") / span).alias("part")).agg(F.array_sort(F.collect_list(F.struct("reading_order", "block_id", line.alias("line")))).alias("rows"))
    hashed = part.select("document_id", "part", F.sha2(F.array_join(F.transform("rows", lambda r: r["line"]), "\n"), 256).alias("h"))
    return hashed.groupBy("document_id").agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "h"))), lambda r: r["h"]), ""), 256).alias("content_sha256"))


def evidence_units(blocks: DataFrame) -> DataFrame:
    """One retrieval unit per block: kind, text and neighbours (blocks with prev_id and next_id)."""
    kind = F.when(F.col("block_type").isin("figure", "image", "diagram"), "visual").when(F.col("block_type") == "table", "table").when(F.col("block_type") == "equation", "equation").otherwise("text")
    return blocks.select(
        "document_id", F.concat(F.lit("ev_"), "block_id").alias("unit_id"), "block_id", kind.alias("kind"), F.coalesce("text", "caption", F.lit("")).alias("unit_text"),
        F.array_join(F.array_compact(F.array("prev_id", "next_id")), ",").alias("neighbours"),
    )


def filtered(questions: DataFrame, types: list[str] | None = None, sources: list[str] | None = None, search: str | None = None) -> DataFrame:
    """Questions by type and source (any of), and by text that they contain whatever its case."""
    for column, values in (("question_type", types), ("source_type", sources)):
        if values:
            questions = questions.filter(F.col(column).isin(*values))
    if search:
        questions = questions.filter(F.lower(T.text_of("question_text")).contains(search.lower()))
    return questions


def question_rows(questions: DataFrame) -> DataFrame:
    """The columns of a question list, with the calibrated confidence or what stands for it."""
    a = F.col("answer_association")
    return questions.select(
        "document_id", "question_id", "question_type", "source_type", F.coalesce(a["status"], F.lit("none")).alias("status"),
        F.coalesce(a["final_confidence"], a["llm_confidence"]).alias("confidence"), F.substring("question_text", 1, 110).alias("preview"),
    )
