"""Parsers from pages to blocks, the choice between them, and what they returned."""

from __future__ import annotations

from abc import ABC, abstractmethod
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from folioflow.functions import text as X
from folioflow.operators.nested import read_payload

TEXT_CHARS, TEXT_AREA = 100, 0.02
# Labels of layout parsers and tags of pages as block types.
LABEL_TYPES = {
    "title": "chapter", "section_header": "heading", "text": "paragraph", "paragraph": "paragraph", "list_item": "list_item", "table": "table", "picture": "figure", "figure": "figure", "formula": "equation",
    "caption": "caption", "code": "other", "footnote": "note", "page_header": "noise", "page_footer": "noise",
}
TAG_TYPES = {"h1": "heading", "h2": "heading", "h3": "subsection", "p": "paragraph", "li": "list_item", "table": "table", "caption": "caption", "footer": "noise", "nav": "noise", "title": "chapter"}


def block_type(label: Column | str, types: dict[str, str] = LABEL_TYPES) -> Column:
    """Block type of a label, 'other' for unknown ones."""
    known = F.create_map(*(F.lit(x) for pair in types.items() for x in pair))
    return F.coalesce(F.try_element_at(known, F.lower(F.col(label) if isinstance(label, str) else label)), F.lit("other"))


def markdown_blocks(df: DataFrame, key: str, text: str) -> DataFrame:
    """Coarse blocks (key, ix, block_type, text) of markdown: cut at blank lines, typed by how they begin."""
    body = F.trim(F.col("t"))
    kind = F.when(body.startswith("#"), "heading").when(body.startswith("|"), "table").when(body.rlike(r"^[-*] "), "list").when(body.startswith("$$") | body.startswith("\\["), "equation").otherwise("paragraph")
    parts = df.select(key, F.posexplode(F.split(X.text_of(text), "\n\n")).alias("ix", "t")).filter(F.trim("t") != "")
    return parts.select(key, "ix", kind.alias("block_type"), F.trim(F.regexp_replace(body, "^#+", "")).alias("text"))


def html_blocks(df: DataFrame, key: str, html: str) -> DataFrame:
    """Blocks (key, ix, block_type, text) of the elements of a page that hold text; markup inside them is dropped."""
    tags = "|".join(TAG_TYPES)
    whole = F.regexp_extract_all(html, F.lit(rf"(?is)(<(?:{tags})\b[^>]*>.*?</(?:{tags})>)"))
    parts = df.select(key, F.posexplode(whole).alias("ix", "e"))
    text = F.trim(F.regexp_replace(F.regexp_replace("e", r"(?s)<[^>]*>", " "), r"\s+", " "))
    return parts.select(key, "ix", block_type(F.regexp_extract("e", r"(?i)^<(\w+)", 1), TAG_TYPES).alias("block_type"), text.alias("text")).filter("text <> ''")


def table_cells(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    """Cells (keys, row_ix, col_ix_, cell) of tables printed with bars."""
    rows = df.filter(F.contains(F.col(text), F.lit("|"))).select(*keys, F.posexplode(F.split(text, "\n")).alias("row_ix", "r")).filter(F.contains(F.col("r"), F.lit("|")))
    return rows.select(*keys, "row_ix", F.posexplode(F.split("r", r"\|")).alias("cell_ix", "c")).select(*keys, "row_ix", "cell_ix", F.trim("c").alias("cell"))


def route_pages(blocks: DataFrame, pages: DataFrame) -> DataFrame:
    """Route of each page: its text layer where it has enough characters on enough of its area, else reading by eye.

    blocks has document_id, page_index, text and corners.
    """
    page = pages.filter("document_id is not null and page_index is not null").groupBy("document_id", "page_index").agg(F.max("width").alias("width"), F.max("height").alias("height"))
    box = F.when(F.col("x0").isNotNull() & (F.trim(X.text_of("text")) != ""), (F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0")))
    per = blocks.groupBy("document_id", "page_index").agg(F.sum(F.length(F.trim(X.text_of("text")))).alias("n_chars"), F.coalesce(F.sum(box), F.lit(0.0)).alias("area"))
    d = page.join(per, ["document_id", "page_index"], "left").fillna({"n_chars": 0, "area": 0.0})
    enough = (F.col("n_chars") >= TEXT_CHARS) & (F.col("area") / (F.col("width") * F.col("height")) >= TEXT_AREA)
    return d.select("document_id", "page_index", "n_chars", F.when(F.coalesce(enough, F.lit(False)), "text_layer").otherwise("ocr").alias("route"))


def routing_summary(routes: DataFrame) -> DataFrame:
    """Per document: pages by route, whether it is born-digital or mixed, and the parser that fits."""
    text = F.count_if(F.col("route") == "text_layer")
    n = F.count(F.lit(1))
    s = routes.groupBy("document_id").agg(n.alias("n_pages"), text.alias("n_text_layer"))
    born = F.col("n_text_layer") == F.col("n_pages")
    return s.select("document_id", "n_pages", "n_text_layer", born.alias("born_digital"), ((F.col("n_text_layer") > 0) & ~born).alias("mixed"), F.when(born, "layout").otherwise("vision").alias("parser"))


@F.pandas_udf(StringType())
def payload_status(payloads: pd.Series) -> pd.Series:
    """'ok', 'empty' or 'failed' of what a provider returned."""

    def status(p: str | None) -> str:
        if p is None or not str(p).strip():
            return "empty"
        return "ok" if read_payload(p) is not None else "failed"

    return payloads.map(status)


class PageParser(ABC):
    """Turns pages into blocks; every page gets a row, an unreadable one with status 'failed'."""

    @abstractmethod
    def parse(self, pages: DataFrame) -> DataFrame:
        """pages(document_id, page_index, content) to (document_id, page_index, status, ix, block_type, text)."""


class MarkdownParser(PageParser):
    """Pages whose content is markdown text."""

    def parse(self, pages: DataFrame) -> DataFrame:
        keyed = pages.withColumn("page_key", F.struct("document_id", "page_index"))
        found = markdown_blocks(keyed, "page_key", "content").select("page_key.*", "ix", "block_type", "text")
        out = pages.select("document_id", "page_index").join(found, ["document_id", "page_index"], "left")
        return out.withColumn("status", F.when(F.col("ix").isNull(), "failed").otherwise("ok"))


class Provider(ABC):
    """Seam for an external model; the library itself runs offline."""

    @abstractmethod
    def extract_pages(self, pages: DataFrame) -> DataFrame:
        """Blocks of pages."""

    def embed(self, texts: DataFrame) -> DataFrame:
        """Vectors of texts; a provider without any has no semantic channel."""
        return texts.limit(0)

    def adjudicate(self, questions: DataFrame) -> DataFrame:
        """Decisions between candidates; none offline."""
        return questions.limit(0)


_PARSERS: dict[str, Callable[[], PageParser]] = {"markdown": MarkdownParser}


def register_parser(name: str, factory: Callable[[], PageParser]) -> None:
    """Make a parser known by name."""
    _PARSERS[name] = factory


def build_parser(name: str) -> PageParser:
    """A parser by name."""
    if name not in _PARSERS:
        raise ValueError(f"no parser is registered as {name!r}; there are {sorted(_PARSERS)}")
    return _PARSERS[name]()
