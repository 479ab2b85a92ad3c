"""Structure of documents: sections, answer runs, enumeration, columns, continuation, references.

Passes over a document in reading order are running sums and carried values
(see ``ordering``); each replaces an automaton that would walk the blocks.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioflow.functions import geometry
from folioflow.functions import text as T
from folioflow.operators import ordering
from folioflow.session import stage

LEVELS = {"chapter": 0, "topic": 1, "section": 2, "subsection": 3}
MAX_LEVEL = 6
MAX_RUN = 8
DOC = ["document_id"]


def linked(blocks: DataFrame) -> DataFrame:
    """blocks with prev_id and next_id."""
    return ordering.neighbours(blocks, DOC, "reading_order", {"prev_id": F.col("block_id")}, {"next_id": F.col("block_id")})


def heading_level():
    """Level of a heading, null for other blocks; a lone mark between alternatives is none."""
    level = F.lit(None).cast("int")
    for kind, value in LEVELS.items():
        level = F.when(F.col("block_type") == kind, value).otherwise(level)
    level = F.coalesce(level, F.col("heading_level"), F.when(F.col("block_type") == "heading", 2))
    choice = F.upper(F.trim(T.text_of("text"))).isin("OR", "OR:")
    return F.when(~choice, F.when(F.col("block_type").isin(*T.HEADING_TYPES) | F.col("heading_level").isNotNull(), level)).cast("int")


def sections(blocks: DataFrame) -> DataFrame:
    """document_id, block_id, level, opens (a heading above level 0), section_block and parent_block.

    A heading's parent is the last heading before it of a lower level; a block's
    section is the last heading at or before it. Null stands for the document.
    """
    rows = ordering.prepare(blocks.select("document_id", "block_id", "reading_order", heading_level().alias("level")), "reading_order")
    opens = F.col("level") > 0
    here = F.struct("reading_order", "block_id")
    before = {f"m{k}": F.when(F.col("level") == k, here) for k in range(1, MAX_LEVEL + 1)}
    rows = ordering.carry(rows, DOC, "reading_order", before, current=False)
    rows = ordering.carry(rows, DOC, "reading_order", {"sec": F.when(opens, here)})
    under = lambda k: F.greatest(F.col("m1"), F.lit(None).cast("struct<reading_order:bigint,block_id:string>"), *(F.col(f"m{i}") for i in range(2, k)))
    parent = F.lit(None).cast("struct<reading_order:bigint,block_id:string>")
    for k in range(2, MAX_LEVEL + 1):
        parent = F.when(F.col("level") == k, under(k)).otherwise(parent)
    return rows.select(
        "document_id", "block_id", "level", F.coalesce(opens, F.lit(False)).alias("opens"), F.col("sec.block_id").alias("section_block"),
        F.when(opens, parent["block_id"]).otherwise(F.col("sec.block_id")).alias("parent_block"),
    )


def answer_runs(blocks: DataFrame) -> DataFrame:
    """Generic blocks that become answers: openers, and at most MAX_RUN generic blocks after an answer heading or opener."""
    t = F.trim(T.text_of("text"))
    generic = F.col("block_type").isin(*T.GENERIC_TYPES)
    heading = F.col("block_type").isin(*T.HEADING_TYPES) | F.col("heading_level").isNotNull()
    kind = F.when(heading & t.rlike(T.ANSWER_HEADING), "opens").when(heading, "closes").when(generic & t.rlike(T.ANSWER_OPENER), "opener").when(t.rlike(T.ANSWER_RESET), "closes")
    rows = blocks.select("document_id", "block_id", "reading_order", "block_type", kind.alias("event"), (generic & (t != "") & ~heading).alias("generic"))
    rows = ordering.prepare(rows, "reading_order")
    rows = ordering.running(rows, DOC, "reading_order", {"k": (F.col("generic") & F.col("event").isNull()).cast("int")})
    # how many generic blocks there were when the run began
    rows = ordering.carry(rows, DOC, "reading_order", {"head": F.when(F.col("event").isNotNull(), F.struct("event", "k"))})
    in_run = F.col("generic") & F.col("head.event").isin("opens", "opener") & (F.col("k") - F.col("head.k") <= MAX_RUN)
    return rows.filter((F.col("event") == "opener") | (F.col("event").isNull() & in_run)).select("document_id", "block_id", F.when(F.col("event") == "opener", "answer_opener").otherwise("answer_heading_run").alias("source"))


def regions(blocks: DataFrame) -> DataFrame:
    """Region of each block ('self_assessment' from its banner on) and the marks of the last banner."""
    t = T.text_of("text")
    banner = F.col("block_type").isin("banner", "heading")
    marks = F.lit(None).cast("int")
    for pattern, value in reversed(T.BANNER_MARKS):
        marks = F.when(t.rlike(pattern), value).otherwise(marks)
    explicit = F.nullif(F.regexp_extract(t, T.MARKS_BANNER, 1), F.lit("")).cast("int")
    rows = blocks.select("document_id", "block_id", "reading_order", F.coalesce(explicit, F.when(banner, marks)).alias("m"), F.when(banner & t.rlike(T.SELF_ASSESSMENT), True).alias("s"))
    rows = ordering.carry(rows, DOC, "reading_order", {"banner_marks": F.col("m"), "self": F.col("s")})
    return rows.select("document_id", "block_id", F.when(F.col("self"), "self_assessment").otherwise("body").alias("region"), "banner_marks")


def enumeration(rows: DataFrame, keys: list[str]) -> DataFrame:
    """group_role, enumerator, style, depth, parent and or_group of rows(keys, row_id, position, block_type, text).

    Containers open at examples and numbers; labels below hang on the container
    or on the last label of a higher level in it; alternatives need an explicit
    mark between two labels with the same parent.
    """
    t = T.text_of("text")
    leads_or = t.rlike(r"(?i)^\s*OR\s*\n")
    parsed = F.when(leads_or, F.regexp_replace(t, r"(?s)^[^\n]*\n", "")).otherwise(t)
    e = T.enumerator(parsed)
    headingish = F.col("block_type").isin(*T.HEADING_TYPES, "banner")
    rows = rows.withColumn("_e", e).withColumns({"_or": T.is_or_marker("text"), "_leads": leads_or})
    container = ~F.col("_or") & ((F.col("block_type") == "worked_example") | (F.col("_e.style") == "example") | ((F.col("_e.style") == "numbered") & ~headingish))
    rows = rows.withColumn("_cont", F.coalesce(container, F.lit(False)))
    at = F.struct("position", "row_id")
    rows = ordering.carry(rows, keys, "position", {"cont": F.when(F.col("_cont"), at)})
    sub = ~F.col("_or") & ~F.col("_cont") & F.col("_e.style").isin("upper", "num", "lower", "roman") & F.col("cont").isNotNull()
    rows = rows.withColumn("_sub", F.coalesce(sub, F.lit(False)))
    rows = ordering.carry(rows, keys, "position", {"upper": F.when(F.col("_sub") & (F.col("_e.level") == 1), at)}, current=False)
    in_container = F.col("upper.position") > F.col("cont.position")
    rows = rows.withColumn("_parent", F.when(F.col("_sub"), F.when((F.col("_e.level") == 2) & in_container, F.col("upper.row_id")).otherwise(F.col("cont.row_id"))))
    # each ordered step reads its input twice; written here, the steps before it run once and not once per later branch
    rows = stage(rows.drop("text"), "enumerated")
    content = ~F.col("_or") & ~F.col("_cont") & ~F.col("_sub") & F.col("block_type").isin("answer", "solution", "explanation") & F.col("cont").isNotNull()
    event = F.when(F.col("_or"), "or").when(F.col("_cont") | F.col("_sub") | content, "other")
    rows = ordering.carry(rows, keys, "position", {"ev": event, "prev_sub": F.when(F.col("_sub"), F.struct("position", "row_id", F.col("_parent").alias("parent")))}, current=False)
    links = F.col("_sub") & ((F.col("ev") == "or") | F.col("_leads")) & (F.col("prev_sub.position") > F.col("cont.position")) & (F.col("prev_sub.parent") == F.col("_parent"))
    rows = rows.withColumn("_link", F.coalesce(links, F.lit(False)))
    # alternatives: a chain of links between consecutive labels takes its first label's id
    subs = rows.filter("_sub").select(*keys, "position", "row_id", "_link", "prev_sub")
    subs = ordering.neighbours(subs, keys, "position", following={"next_link": F.col("_link")})
    subs = ordering.carry(subs, keys, "position", {"first": F.when(~F.col("_link"), F.col("row_id"))})
    alternatives = subs.filter("_link or next_link").select(*keys, "row_id", F.concat(F.lit("or_"), "first").alias("or_group"))
    rows = rows.join(alternatives, [*keys, "row_id"], "left")
    role = F.when(F.col("_or"), "or_separator").when(F.col("_cont"), "container").when(F.col("or_group").isNotNull(), "or_alternative").when(F.col("_sub"), "subpart").when(content, "content")
    style = F.when(F.col("_cont"), F.coalesce(F.col("_e.style"), F.lit("example"))).when(F.col("_sub"), F.col("_e.style"))
    return rows.select(
        *keys, "row_id", role.alias("group_role"), F.when(F.col("_cont") | F.col("_sub"), F.col("_e.label")).alias("enumerator"), style.alias("style"),
        F.when(F.col("_sub"), F.col("_e.level")).cast("int").alias("depth"), F.when(content, F.col("cont.row_id")).otherwise(F.col("_parent")).alias("parent_row"), "or_group",
    ).filter("group_role is not null")


def columns(blocks: DataFrame, pages: DataFrame) -> DataFrame:
    """Per page: columns, full-width blocks, bands, corrected column labels and agreement of reading and geometric order.

    Agreement is one less the share of discordant pairs (pairs inside one page).
    """
    page = pages.filter("document_id is not null and page_index is not null").groupBy("document_id", "page_index").agg(F.max("width").alias("width"))
    b = blocks.filter("x0 is not null and page_index is not null").join(page, ["document_id", "page_index"])
    center = (F.col("x0") + F.col("x1")) / 2
    b = b.select(
        "document_id", "page_index", "block_id", "reading_order", "y0", "col_ix",
        ((F.col("x1") - F.col("x0") > 0.62 * F.col("width")) & (F.col("x0") < 0.28 * F.col("width"))).alias("full"), (center < F.col("width") / 2).alias("left"),
    )
    on_page = Window.partitionBy("document_id", "page_index")
    b = b.withColumns({"n_left": F.count_if(~F.col("full") & F.col("left")).over(on_page), "n_right": F.count_if(~F.col("full") & ~F.col("left")).over(on_page)})
    two = (F.col("n_left") >= 2) & (F.col("n_right") >= 2)
    side = F.when(F.col("full"), -1).when(F.col("left"), 0).otherwise(1)
    # full-width tops strictly above a block: a running count over the tops, ties not counted
    above = on_page.orderBy("y0").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    same = Window.partitionBy("document_id", "page_index", "y0")
    b = b.withColumns({"two": two, "side": side, "band": F.count_if("full").over(above) - F.count_if("full").over(same)})
    b = b.withColumn("label", F.when(F.col("side") == -1, -1).when(~F.col("two"), 0).otherwise(F.col("side")))
    b = b.withColumn("geo", F.row_number().over(on_page.orderBy("band", "side", "y0", "reading_order", "block_id"))).withColumn("model", F.row_number().over(on_page.orderBy("reading_order", "block_id")))
    pairs = b.select("document_id", "page_index", "geo", "model").alias("a").join(b.select("document_id", "page_index", "geo", "model").alias("z"), ["document_id", "page_index"])
    crossed = pairs.filter("a.model < z.model and a.geo > z.geo").groupBy("document_id", "page_index").agg(F.count(F.lit(1)).alias("n_crossed"))
    n = F.count(F.lit(1))
    report = b.groupBy("document_id", "page_index").agg(
        n.alias("n_blocks"), F.when(F.max("two"), 2).otherwise(1).cast("int").alias("n_columns"), F.count_if("full").alias("n_full_width"), (F.count_if("full") + 1).alias("n_bands"),
        F.count_if(~F.col("label").eqNullSafe(F.col("col_ix"))).alias("n_corrected"),
    ).join(crossed, ["document_id", "page_index"], "left").fillna(0, ["n_crossed"])
    possible = F.col("n_blocks") * (F.col("n_blocks") - 1) / 2
    return report.withColumn("agreement", F.when(possible > 0, 1 - F.col("n_crossed") / possible).otherwise(F.lit(1.0)))


def continuations(blocks: DataFrame, pages: DataFrame) -> DataFrame:
    """Links of a paragraph, table or list to the next block that resumes it over a column or page.

    Page furniture and blocks without a box are left out before neighbours are taken.
    """
    page = pages.filter("document_id is not null and page_index is not null").groupBy("document_id", "page_index").agg(F.max("height").alias("height"))
    b = blocks.filter("x0 is not null and block_type <> 'noise'").join(page, ["document_id", "page_index"], "left").withColumn("height", F.coalesce("height", F.lit(1)).cast("double"))
    me = F.struct("block_id", "block_type", "text", "page_index", "col_ix", "y0", "height")
    b = ordering.prepare(b, "reading_order")
    b = ordering.neighbours(b.select(ordering.BUCKET, "document_id", "reading_order", "block_id", "block_type", "text", "page_index", "col_ix", "y0", "y1", "height"), DOC, "reading_order", following={"n": me})
    first_line = lambda c: F.split_part(c, F.lit("\n"), F.lit(1))
    bars = lambda c: F.when(T.text_of(c) != "", F.regexp_count(first_line(T.text_of(c)), F.lit(r"\|")))
    numbers = lambda c: F.transform(F.regexp_extract_all(T.text_of(c), F.lit(r"\(\s*(\d{1,9})\s*\)")), lambda x: x.cast("int"))
    rows_go_on = F.coalesce(F.array_max(numbers("text")) + 1 == F.array_min(numbers("n.text")), F.lit(False))
    table = rows_go_on | F.coalesce((bars("text") == bars("n.text")) & (bars("text") >= 1), F.lit(False))
    prose = (T.text_of("text") != "") & ~F.trim(T.text_of("text")).rlike(T.STATEMENT_END)
    crosses = ~F.col("page_index").eqNullSafe(F.col("n.page_index")) | ~F.col("col_ix").eqNullSafe(F.col("n.col_ix"))
    ok = (F.col("block_type") == F.col("n.block_type")) & F.col("block_type").isin("paragraph", "table", "list")
    ok = ok & (F.col("y1") > 0.80 * F.col("height")) & (F.col("n.y0") < 0.25 * F.col("n.height")) & crosses
    ok = ok & F.when(F.col("block_type") == "table", table).otherwise(prose)
    b = b.withColumn("_link", F.coalesce(ok, F.lit(False)))
    b = ordering.neighbours(b, DOC, "reading_order", previous={"linked": F.col("_link")})
    b = ordering.carry(b, DOC, "reading_order", {"head": F.when(~F.coalesce("linked", F.lit(False)), F.col("block_id"))})
    return b.filter("_link").select("document_id", "block_id", F.col("n.block_id").alias("continues_to"), F.concat(F.lit("item_"), "head").alias("logical_item"))


def references(raw_blocks: DataFrame) -> DataFrame:
    """Phrases that refer to figures, tables and equations, parsed."""
    phrases = raw_blocks.filter("document_id is not null").select("document_id", "raw_id", "page_index", "reading_order", F.posexplode("refs").alias("ref_ix", "phrase"))
    return phrases.filter("phrase is not null").withColumn("p", T.reference_parts("phrase")).select("document_id", "raw_id", "page_index", "reading_order", "ref_ix", "phrase", "p.direction", "p.hint", "p.label")


# Types of asset that a hint fits, and how sure a resolution is.
FITS = (("figure", ("figure", "image", "diagram")), ("image", ("image", "figure")), ("diagram", ("diagram", "figure")), ("graph", ("figure", "diagram")), ("table", ("table",)), ("equation", ("equation",)))
SURE = {"label": 0.9, "direction": 0.75, "proximity": 0.7, "far": 0.55}
BEFORE, AFTER = ("above", "previous"), ("below", "following", "next")


def _fits(hint: Column, kind: Column) -> Column:
    named = reduce(lambda a, b: a | b, [(hint == h) & kind.isin(*kinds) for h, kinds in FITS])
    return F.coalesce(named, F.lit(False)) | (hint.isNull() & kind.isin(*T.ASSET_TYPES))


def _right_side(direction: Column, at: Column, here: Column) -> Column:
    return F.coalesce(F.when(direction.isin(*BEFORE), at < here).when(direction.isin(*AFTER), at > here), F.lit(True))


def resolve_references(refs: DataFrame, assets: DataFrame, window: int = 8) -> DataFrame:
    """status, target, method and confidence of each reference.

    refs(document_id, ref_id, page_index, reading_order, direction, hint, label) and
    assets(document_id, asset_id, asset_type, page_index, reading_order, label_text).
    A label that one asset of a fitting type has decides; else the nearest asset of
    the page in the direction that the phrase names, if one is nearest; and where
    the page has none that fits, the nearest of the document, if it is at most
    window positions away. A direction that no asset of the pool lies in doesn't
    count. Compared are the page's assets, and those in three stretches of window
    positions: pairs stay linear in a document.
    """
    key = ["document_id", "ref_id"]
    hint, kind = F.col("hint"), F.col("asset_type")
    label = F.coalesce(*(F.nullif(F.lower(F.regexp_extract("label_text", T.REFERENCE_LABEL, i)), F.lit("")) for i in (1, 2, 3)))
    labelled = assets.withColumn("label", label).filter("label is not null")
    by_label = refs.filter("label is not null").join(labelled.select("document_id", "label", "asset_id", "asset_type"), ["document_id", "label"]).filter(_fits(hint, kind))
    by_label = by_label.groupBy(*key).agg(F.count(F.lit(1)).alias("n_labelled"), F.min("asset_id").alias("labelled"))

    def nearest(pairs: DataFrame) -> DataFrame:
        seen = pairs.filter(_fits(hint, kind)).withColumns({"away": F.abs(F.col("at") - F.col("reading_order")), "right": _right_side(F.col("direction"), F.col("at"), F.col("reading_order"))})
        tied = seen.groupBy(*key, "away", "right").agg(F.count(F.lit(1)).alias("ties"), F.min("asset_id").alias("nearest"))
        return tied.groupBy(*key).agg(F.min_by(F.struct("ties", "nearest", "right"), F.struct(~F.col("right"), "away")).alias("b"))

    placed = assets.select("document_id", "page_index", "asset_id", "asset_type", F.col("reading_order").alias("at"))
    here = nearest(refs.join(placed, ["document_id", "page_index"]))
    # on other pages: whether any asset at all lies in the direction is told by the document's first and last of each type
    ends = placed.groupBy("document_id", "asset_type").agg(F.min("at").alias("first"), F.max("at").alias("last"))
    alone = refs.join(here.select(*key), key, "left_anti")
    toward = F.when(F.col("direction").isin(*BEFORE), F.col("first") < F.col("reading_order")).when(F.col("direction").isin(*AFTER), F.col("last") > F.col("reading_order")).otherwise(False)
    heads = alone.join(ends, "document_id").filter(_fits(hint, kind)).groupBy(*key).agg(F.max(F.coalesce(toward, F.lit(False))).alias("one_side"))
    stretch = lambda c: F.floor(F.col(c) / window)
    around = alone.join(heads, key).withColumn("s", F.explode(F.array(*(stretch("reading_order") + i for i in (-1, 0, 1)))))
    far = around.drop("page_index").join(placed.withColumn("s", stretch("at")), ["document_id", "s"]).filter(F.abs(F.col("at") - F.col("reading_order")) <= window)
    far = nearest(far.filter(~F.col("one_side") | _right_side(F.col("direction"), F.col("at"), F.col("reading_order"))).drop("s"))
    best = here.withColumn("same_page", F.lit(True)).unionByName(far.withColumn("same_page", F.lit(False)))
    out = refs.join(by_label, key, "left").join(best, key, "left")
    status = F.when(F.col("n_labelled") == 1, "resolved").when(F.col("n_labelled") > 1, "ambiguous").when(F.col("b").isNull(), "no_candidate").when(F.col("b.ties") > 1, "ambiguous").otherwise("resolved")
    method = F.when(F.col("n_labelled") >= 1, "label").when(F.col("b").isNotNull(), F.when(F.col("direction").isNotNull() & (F.col("b.ties") == 1), "direction").otherwise("proximity"))
    out = out.withColumns({"status": status, "method": method})
    target = F.when(F.col("status") == "resolved", F.when(F.col("method") == "label", F.col("labelled")).otherwise(F.col("b.nearest")))
    confidence = F.when(F.col("status") != "resolved", 0.0).when(F.col("method") == "label", SURE["label"]).when(F.col("method") == "direction", SURE["direction"]).when(F.col("same_page"), SURE["proximity"]).otherwise(SURE["far"])
    return out.select("document_id", "ref_id", "status", target.alias("target_id"), "method", confidence.alias("confidence"))


def canonical_ids(raw_blocks: DataFrame) -> DataFrame:
    """raw_id with the canonical block id and reading order: numbered by page, parser order and input order."""
    rows = raw_blocks.filter("document_id is not null and page_index is not null and raw_id is not null").select("document_id", "page_index", "raw_id", F.coalesce("reading_order", F.lit(0)).alias("ro"), F.coalesce("block_ix", F.lit(0)).alias("ix")).dropDuplicates(["document_id", "raw_id"])
    placed = ordering.positions(rows, DOC, "page_index", ["ro", "ix", "raw_id"], "new_order")
    return placed.select("document_id", "raw_id", F.format_string("blk_%06d", "new_order").alias("canonical_id"), "new_order")


def numbering_gaps(numbered: DataFrame) -> DataFrame:
    """Missing numbers of each series(series, n) of three or more distinct numbers: first and last missing of every gap."""
    distinct = numbered.filter("series is not null and n is not null").select("series", "n").distinct()
    big = distinct.groupBy("series").agg(F.count(F.lit(1)).alias("c")).filter("c >= 3").select("series")
    # numbers are windowed in stretches, so that a long series is many tasks' work
    return ordering.neighbours(distinct.join(big, "series"), ["series"], "n", following={"after": F.col("n")}).filter("after > n + 1").select("series", (F.col("n") + 1).alias("first_missing"), (F.col("after") - 1).alias("last_missing"))


def boxes_that_overlap(blocks: DataFrame, least: float = 0.5) -> DataFrame:
    """Pairs of boxes of a page with at least so much intersection over union (pairs inside one page)."""
    b = blocks.filter("x0 is not null").select("document_id", "page_index", "block_id", "x0", "y0", "x1", "y1")
    side = lambda p: b.select("document_id", "page_index", *(F.col(c).alias(f"{p}{c}") for c in ("block_id", "x0", "y0", "x1", "y1")))
    pairs = side("a_").join(side("b_"), ["document_id", "page_index"]).filter("a_block_id < b_block_id and a_x0 < b_x1 and b_x0 < a_x1 and a_y0 < b_y1 and b_y0 < a_y1")
    return pairs.withColumn("iou", geometry.iou("a_", "b_")).filter(F.col("iou") >= least).select("document_id", "page_index", "a_block_id", "b_block_id", "iou")


def box_coverage(blocks: DataFrame, pages: DataFrame, step: int = 100) -> DataFrame:
    """Share of a page's grid points that some box covers; a page without boxes has 0."""
    page = pages.filter("document_id is not null and page_index is not null and width > 0 and height > 0").groupBy("document_id", "page_index").agg(F.max("width").alias("width"), F.max("height").alias("height"))
    grid = page.withColumns({"nx": F.expr(f"cast(ceil(width / {step}) as int)"), "ny": F.expr(f"cast(ceil(height / {step}) as int)")})
    # a box covers the points (i + .5) * step from ceil(x0 / step - .5) on: points come from boxes, not from a join with all points
    b = blocks.filter("x0 is not null").select("document_id", "page_index", "x0", "y0", "x1", "y1").join(grid, ["document_id", "page_index"])
    lo = lambda c: F.greatest(F.lit(0), F.ceil(F.col(c) / step - 0.5)).cast("int")
    hi = lambda c, n: F.least(F.col(n) - 1, F.floor(F.col(c) / step - 0.5)).cast("int")
    b = b.withColumns({"i0": lo("x0"), "i1": hi("x1", "nx"), "j0": lo("y0"), "j1": hi("y1", "ny")}).filter("i0 <= i1 and j0 <= j1")
    points = b.select("document_id", "page_index", F.explode(F.sequence("i0", "i1")).alias("i"), "j0", "j1").select("document_id", "page_index", "i", F.explode(F.sequence("j0", "j1")).alias("j"))
    covered = points.groupBy("document_id", "page_index").agg(F.countDistinct("i", "j").alias("n_covered"))
    return grid.join(covered, ["document_id", "page_index"], "left").fillna(0, ["n_covered"]).select("document_id", "page_index", "n_covered", (F.col("nx") * F.col("ny")).cast("bigint").alias("n_points"), (F.col("n_covered") / (F.col("nx") * F.col("ny"))).alias("coverage"))
