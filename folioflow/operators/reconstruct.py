"""Questions that run over several blocks, and parts that share one block."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioflow.functions import text as T
from folioflow.operators import ordering

JOIN_AT = 0.55
AMBIGUOUS = (0.40, 0.70)
MAX_BLOCKS = 12
CONTINUABLE = ("paragraph", "list", "list_item", "question", "equation", "table", "other")
MARKER = rf"(\(\s*(?:[a-zA-Z]|(?i:{T.ROMAN}))\s*\)\s+)"


def pair_scores(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Each row with the score that it continues the row before it, and whether it cannot.

    rows(keys, row_id, position, block_type, text, section_id, part_of_id,
    page_index, col_ix, y0, y1, height). Signals add up and are clamped to 0..1.
    """
    before = ("text", "section_id", "part_of_id", "page_index", "col_ix", "y1", "height")
    rows = ordering.neighbours(rows, keys, "position", previous={"_p": F.struct("row_id", *before)})
    a, b = T.text_of("_p.text"), T.text_of("text")
    left, right = F.rtrim(a), F.regexp_replace(b, r"^\s+", "")
    stop = ~F.col("block_type").isin(*CONTINUABLE) | b.rlike(T.ANSWER_START) | T.is_or_marker("text") | b.rlike(T.ENUMERATOR_START)
    same_place = F.col("_p.page_index").eqNullSafe(F.col("page_index")) & F.col("_p.col_ix").eqNullSafe(F.col("col_ix"))
    gap = F.col("y0") - F.col("_p.y1")
    ended = (left != "") & left.rlike(T.SENTENCE_END)
    add = lambda condition, value, other=0.0: F.when(F.coalesce(condition, F.lit(False)), value).otherwise(other)
    score = (
        add(F.col("_p.section_id").eqNullSafe(F.col("section_id")), 0.15, -0.25) + add(F.col("_p.part_of_id") == F.col("part_of_id"), 0.15) + add(same_place, 0.15, 0.05)
        + add(same_place & (gap >= 0) & (gap < 0.04 * F.col("height")), 0.15) + add(same_place & (gap > 0.12 * F.col("height")), -0.15)
        + add((left != "") & ~left.rlike(T.SENTENCE_END), 0.35) + add((left != "") & left.rlike(T.DANGLING_END), 0.15) + add(right.rlike(r"^\p{Ll}"), 0.25)
        + add(right.rlike(T.CONNECTIVE_START), 0.10) + add(ended & right.rlike(r"^\p{Lu}"), -0.20) + add(F.col("block_type").isin("equation", "table"), 0.10)
    )
    hard = F.coalesce(stop, F.lit(False)) | F.col("_p").isNull()
    return rows.select(
        *keys, "row_id", "position", "block_type", F.col("_p.row_id").alias("previous_id"), hard.alias("hard_stop"),
        F.when(hard, 0.0).otherwise(F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), score)), 6)).alias("score"),
    )


def spans(scored: DataFrame, keys: list[str], anchor: Column, claimed: Column | None = None) -> DataFrame:
    """Rows of each anchor's span: the anchor and the unbroken run of joins behind it, MAX_BLOCKS rows at most."""
    stops = anchor if claimed is None else anchor | claimed
    broken = stops | F.col("hard_stop") | (F.col("score") < JOIN_AT)
    rows = scored.withColumns({"_anchor": F.coalesce(anchor, F.lit(False)), "_break": F.coalesce(broken, F.lit(True))})
    rows = ordering.running(ordering.prepare(rows, "position"), keys, "position", {"_n": F.lit(1)})
    rows = ordering.carry(rows, keys, "position", {"_head": F.when(F.col("_break"), F.struct("row_id", F.col("_n").alias("n"), F.col("_anchor").alias("is_anchor")))})
    at = F.col("_n") - F.col("_head.n")
    return rows.filter(F.col("_head.is_anchor") & (at < MAX_BLOCKS)).select(*keys, F.col("_head.row_id").alias("anchor_id"), at.cast("int").alias("segment"), "row_id", F.when(at == 0, "stem").otherwise("continuation").alias("role"))


def ambiguous_pairs(scored: DataFrame, keys: list[str]) -> DataFrame:
    """How many pairs score in the band that rules alone don't settle."""
    return scored.filter(~F.col("hard_stop") & F.col("score").between(*AMBIGUOUS)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_ambiguous"))


def _rank(label: Column, roman: bool) -> Column:
    if not roman:
        return F.when(F.length(label) == 1, F.ascii(label) - F.lit(96))
    values = F.array(*map(F.lit, ("i", "ii", "iii", "iv", "v", "vi", "vii", "viii", "ix", "x")))
    return F.nullif(F.array_position(values, label).cast("int"), F.lit(0))


def consecutive(labels: Column) -> Column:
    """Whether labels run without gaps, as letters or as roman numbers."""

    def run(roman: bool) -> Column:
        ranks = F.transform(labels, lambda x: _rank(x, roman))
        return F.coalesce(F.forall(F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1))), lambda i: (F.size(labels) == 1) | (F.get(ranks, i) - F.get(ranks, i - 1) == 1)) & ~F.exists(ranks, lambda r: r.isNull()), F.lit(False))

    return run(False) | run(True)


def subparts(rows: DataFrame, key: str, text: str, least: int = 2) -> DataFrame:
    """key, marks: array of struct(start, label) of the parts that a text is divided into; texts without parts are left out.

    A marker counts at the start of a line, after the number that opens the text
    or after a sentence. Markers of a kind must run without gaps; of several such
    runs the widest is the outer one, the first of equals.
    """
    segments = T.marker_segments(text, MARKER)
    found = rows.select(key, F.col(text).alias("_t"), F.posexplode(F.filter(segments, lambda s: s["text"].rlike(rf"^{MARKER}") & F.regexp_replace(s["text"], rf"^{MARKER}", "").rlike(r"(?s)^\S"))).alias("_i", "_s"))
    head = F.substring(F.col("_t"), F.lit(1), F.col("_s.start"))
    ok = head.rlike(r"(^|\n)[ \t]*$") | head.rlike(T.BARE_NUMBER) | head.rlike(r"[.?!:;]['\")\]]?\s*$")
    raw = F.trim(F.regexp_extract(F.col("_s.text"), r"^\(\s*([a-zA-Z]+)\s*\)", 1))
    low = F.lower(raw)
    kind = F.when(low.isin("ii", "iii", "iv", "vi", "vii", "viii", "ix"), "roman").when(low.isin("i", "v", "x"), "romanish").when(raw == F.upper(raw), "upper").otherwise("lower")
    marks = found.filter(ok).select(key, F.col("_s.start").alias("start"), raw.alias("raw"), low.alias("label"), kind.alias("kind"))
    whole = Window.partitionBy(key)
    has_roman = F.max(F.when(F.col("kind") == "roman", 1).otherwise(0)).over(whole)
    marks = marks.withColumn("kind", F.when(F.col("kind") == "romanish", F.when(has_roman == 1, "roman").otherwise("lower")).otherwise(F.col("kind")))
    groups = marks.groupBy(key, "kind").agg(F.array_sort(F.collect_list(F.struct("start", "label"))).alias("marks")).filter(F.size("marks") >= least)
    labels = F.transform("marks", lambda m: m["label"])
    groups = groups.filter(consecutive(labels))
    width = F.element_at("marks", -1)["start"] - F.element_at("marks", 1)["start"]
    return groups.groupBy(key).agg(F.max_by("marks", F.struct(width, -F.element_at("marks", 1)["start"])).alias("marks"))


def _bodies(marks: Column, text: Column) -> Column:
    ends = lambda i: F.coalesce(F.get(marks, i + 1)["start"], F.length(text))
    return F.transform(marks, lambda m, i: F.trim(F.substring(text, m["start"] + 1, ends(i) - m["start"])))


def is_option_list(marks: Column, text: Column) -> Column:
    """Whether parts read as options: mostly short, and all but one without an end of a sentence."""
    bodies = _bodies(marks, text)
    short = F.size(F.filter(bodies, lambda x: F.length(x) <= 60))
    bare = F.size(F.filter(bodies, lambda x: ~x.rlike(T.SENTENCE_END)))
    return (short >= F.greatest(F.lit(2), F.floor(0.75 * F.size(bodies)).cast("int"))) & (bare >= F.size(bodies) - 1)


def split_inward(rows: DataFrame, key: str, text: str) -> DataFrame:
    """Segments (key, segment, role, enumerator, start, end) of texts that hold several parts, or a question and its answer."""
    base = rows.select(key, F.col(text).alias("_t"), F.greatest(T.answer_boundary(text), F.lit(0)).alias("_b"))
    base = base.withColumn("_q", F.when(F.col("_b") > 0, F.substring(F.col("_t"), F.lit(1), F.col("_b"))).otherwise(F.col("_t")))
    parts = subparts(base, key, "_q")
    d = base.join(parts, key, "left")
    stem = F.element_at("marks", 1)["start"]
    splits = F.col("marks").isNotNull() & ~F.coalesce(is_option_list(F.col("marks"), F.col("_q")), F.lit(False))
    good_stem = (stem >= 12) | F.substring(F.col("_q"), F.lit(1), stem).rlike(T.BARE_NUMBER)
    length = F.length("_t")
    seg = lambda role, enum, start, end: F.struct(F.lit(role).alias("role"), enum.cast("string").alias("enumerator"), start.cast("int").alias("start"), end.cast("int").alias("end"))
    none = F.lit(None).cast("string")
    answer = F.when(F.col("_b") > 0, F.array(seg("answer", none, F.col("_b"), length))).otherwise(F.array().cast("array<struct<role:string,enumerator:string,start:int,end:int>>"))
    subs = F.transform("marks", lambda m, i: F.struct(F.lit("subpart").alias("role"), m["label"].alias("enumerator"), m["start"].alias("start"), F.coalesce(F.get(F.col("marks"), i + 1)["start"], F.length("_q")).alias("end")))
    divided = F.concat(F.array(seg("stem", none, F.lit(0), stem)), subs, answer)
    solved = F.concat(F.array(seg("stem", none, F.lit(0), F.col("_b"))), answer)
    out = d.select(key, F.when(splits & good_stem, divided).when(~splits & (F.col("_b") > 0) & (F.length(F.trim("_q")) >= 12), solved).alias("_segs"))
    return out.filter("_segs is not null").select(key, F.posexplode("_segs").alias("segment", "s")).select(key, "segment", "s.*")


def _options_of(text: str, pattern: str) -> Column:
    def body(s: Column) -> Column:
        own = F.regexp_replace(F.regexp_replace(s["text"], rf"^{pattern}", ""), r"^[ .:\n\t]+|[ .:\n\t]+$", "")
        own = F.trim(F.regexp_replace(own, r"(?i)\s*\((Remember|Understand|Apply|Analyse|Analyze|Evaluate|Create)\)\s*\d*\s*$", ""))
        return F.struct(F.lower(F.regexp_extract(s["text"], r"^\(\s*([a-zA-Z]+)\s*\)", 1)).alias("opt_key"), F.substring(own, 1, 200).alias("opt_text"))

    return F.transform(F.filter(T.marker_segments(text, pattern), lambda s: s["text"].rlike(rf"^{pattern}")), body)


def options(rows: DataFrame, key: str, text: str) -> DataFrame:
    """Options (key, ix, opt_key, opt_text) of texts with two or more of one kind of marker and short enough bodies; letters before roman numbers."""
    best = None
    for pattern in (r"(\(\s*[a-d]\s*\))", rf"(\(\s*(?i:{T.ROMAN})\s*\))"):
        body = _options_of(text, pattern)
        mean = F.aggregate(body, F.lit(0), lambda acc, o: acc + F.length(o["opt_text"])) / F.size(body)
        fit = F.when((F.size(body) >= 2) & (mean < 160), body)
        best = fit if best is None else F.coalesce(best, fit)
    return rows.select(key, F.posexplode(best).alias("ix", "o")).select(key, "ix", "o.opt_key", "o.opt_text")


def inline_segments(rows: DataFrame, key: str, text: str) -> DataFrame:
    """Segments (key, segment, role, start, end) of texts that hold their own answer behind a marker."""
    segs = T.marker_segments(text, T.INLINE_MARKER)
    low = lambda s: F.lower(s["text"])
    role = lambda s, i: F.when(i == 0, "question").when(low(s).startswith("expl"), "explanation").when(low(s).startswith("sol"), "solution").otherwise("answer")
    # a marker at the very start leaves an empty first segment: the text begins with an answer, which the question part then holds
    first_empty = F.get(segs, F.lit(0))["end"] == 0
    merged = F.when(first_empty & (F.size(segs) > 1), F.concat(F.array(F.struct(F.lit(0).alias("start"), F.get(segs, F.lit(1))["end"].alias("end"), F.get(segs, F.lit(1))["text"].alias("text"))), F.slice(segs, 3, F.greatest(F.size(segs) - 2, F.lit(0))))).otherwise(segs)
    out = rows.select(key, F.transform(merged, lambda s, i: F.struct(role(s, i).alias("role"), s["start"].alias("start"), s["end"].alias("end"))).alias("_s")).filter(F.size("_s") > 1)
    return out.select(key, F.posexplode("_s").alias("segment", "s")).select(key, "segment", "s.*")
