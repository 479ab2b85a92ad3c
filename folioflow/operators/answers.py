"""From candidates to answers: decision, validation, calibration and the gate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioflow.functions import text as T

# Bounds of candidates, of what counts as strong, and of the gate; corroboration by a second channel; length of a preview.
TOP = 6
PREVIEW = 400
CORROBORATION = {"semantic": 0.03, "lexical": 0.02}
HIGH, MEDIUM, ABSENT_HIGH = 0.85, 0.6, 0.8
STRONG, EPSILON = 0.9, 1e-6
MARGIN = 0.05
# How reliable a relationship is.
RELIABILITY = {
    "inline": 0.98, "same_worked_example": 0.95, "same_container_enum": 0.95, "container_solution_enum": 0.92, "adjacent_solution": 0.90, "continuation": 0.85,
    "same_container": 0.82, "refers_to": 0.80, "container_solution_run": 0.70, "same_section": 0.60,
}
UNKNOWN_RELIABILITY = 0.5


def ranked(candidates: DataFrame, blocks: DataFrame, k: int = TOP) -> DataFrame:
    """The k strongest candidates of each question, in reading order among equals."""
    placed = candidates.join(blocks.select("document_id", "block_id", "reading_order", "block_type"), ["document_id", "block_id"])
    best = Window.partitionBy("document_id", "question_id").orderBy(F.desc("strength"), "reading_order", "block_id")
    return placed.withColumn("rank", F.row_number().over(best).cast("int")).filter(F.col("rank") <= k)


def dominant(evidence: DataFrame) -> DataFrame:
    """The candidate of each question that alone has the highest strength, where that is strong."""
    top = evidence.groupBy("document_id", "question_id").agg(F.max("strength").alias("best"))
    at_top = evidence.join(top, ["document_id", "question_id"]).filter(F.col("strength") >= F.col("best") - EPSILON)
    one = at_top.groupBy("document_id", "question_id").agg(F.count(F.lit(1)).alias("c"), F.min("block_id").alias("block_id"), F.min("relationship").alias("relationship"), F.max("best").alias("strength"))
    return one.filter((F.col("c") == 1) & (F.col("strength") >= STRONG)).drop("c")


def answer_kind(types: Column) -> Column:
    """Kind of an answer from the types of its blocks (an array)."""
    return F.when(F.array_contains(types, "table"), "table").when((F.size(types) == 1) & F.array_contains(types, "equation"), "equation").when(F.size(types) > 1, "mixed").otherwise("text")


def associate(leaves: DataFrame, blocks: DataFrame, evidence: DataFrame) -> DataFrame:
    """One decision per leaf question: inline, no candidate, the dominant one, or ambiguous.

    Without an adjudicator the offline rule holds: what isn't dominant stays open.
    """
    keys = ["document_id", "question_id"]
    inline = leaves.join(blocks.filter("inline_answer").select("document_id", "block_id", preview().alias("inline_preview")), ["document_id", "block_id"]).select(*keys, F.col("block_id").alias("inline_block"), "inline_preview")
    strongest = evidence.groupBy(*keys).agg(F.max("strength").alias("best"), F.count(F.lit(1)).alias("n_candidates"))
    sure = dominant(evidence).select(*keys, F.col("block_id").alias("sure_block"), "relationship")
    sure = sure.join(blocks.select("document_id", F.col("block_id").alias("sure_block"), "block_type", preview().alias("sure_preview")), ["document_id", "sure_block"])
    d = leaves.select(*keys, "block_id").join(inline, keys, "left").join(strongest, keys, "left").join(sure, keys, "left")
    is_inline, none, is_sure = F.col("inline_block").isNotNull(), F.col("best").isNull(), F.col("sure_block").isNotNull()
    status = F.when(is_inline, "matched").when(none, "not_in_document").when(is_sure, "matched").otherwise("ambiguous")
    return d.select(
        *keys, F.col("block_id").alias("source_block"), status.alias("status"), F.when(is_inline, "inline").when(none, "no_candidate").otherwise("structural").alias("method"),
        F.when(is_inline, F.col("inline_block")).when(~none & is_sure, F.col("sure_block")).alias("answer_block"),
        F.when(is_inline, "inline").when(~none & is_sure, F.col("relationship")).alias("relationship"),
        F.when(is_inline, "inline").when(~none & is_sure, answer_kind(F.array("block_type"))).alias("answer_kind"),
        F.when(is_inline, 0.95).when(none, 0.9).when(is_sure, F.col("best")).otherwise(F.round(F.col("best") * 0.6, 3)).alias("final_confidence"),
        F.coalesce("n_candidates", F.lit(0)).alias("n_candidates"), F.when(is_inline, F.col("inline_preview")).when(~none & is_sure, F.col("sure_preview")).alias("answer_preview"),
    )


def preview() -> Column:
    """What an answer shows of a block."""
    return F.substring(F.coalesce("text", "caption", F.lit("")), 1, PREVIEW)


def adjudicated(associations: DataFrame, evidence: DataFrame, verdicts: DataFrame) -> DataFrame:
    """The open associations with an outside judge's verdict, where there is one.

    verdicts(document_id, question_id, status, ids, llm_confidence). Only chosen
    blocks that are candidates count; a match without any stays open.
    """
    keys = ["document_id", "question_id"]
    open_ = associations.filter("status = 'ambiguous'").select(*keys, "source_block")
    v = open_.join(verdicts.filter("llm_confidence is not null").select(*keys, F.col("status").alias("said"), "ids", "llm_confidence"), keys)
    scope = evidence.join(v.select(*keys), keys, "left_semi").groupBy(*keys).agg(F.max("strength").alias("best"), F.collect_set("block_id").alias("in_scope"))
    d = v.join(scope, keys).withColumn("valid", F.array_sort(F.array_intersect("ids", "in_scope")))
    taken = F.col("said").isin("matched", "partial") & (F.size("valid") > 0)
    status = F.when((F.col("said") == "matched") & (F.size("valid") == 0), "ambiguous").otherwise(F.col("said"))
    return d.select(
        *keys, "source_block", status.alias("status"), F.lit("llm_adjudicated").alias("method"), F.array_join(F.when(taken, F.col("valid")).otherwise(F.array().cast("array<string>")), ",").alias("answer_blocks"),
        F.round(0.5 * F.when(taken, F.col("best")).otherwise(0.0) + 0.5 * F.col("llm_confidence"), 3).alias("final_confidence"),
    )


def recovered_edges(stored: DataFrame, edges: DataFrame) -> DataFrame:
    """Edges from questions to the answers they carry that the stored graph lacks."""
    claimed = stored.filter("status in ('matched', 'partial') and source_block is not null").select("document_id", F.col("source_block").alias("src"), F.explode("ids").alias("dst")).filter("src <> dst").distinct()
    have = edges.filter("edge_type = 'answered_by'").select("document_id", F.lower(F.trim("src")).alias("src"), F.lower(F.trim("dst")).alias("dst"))
    return claimed.join(have, ["document_id", "src", "dst"], "left_anti")


def answered_by(associations: DataFrame) -> DataFrame:
    """Edges from questions to their answers; none from a block to itself."""
    return associations.filter("status in ('matched', 'partial') and answer_block is not null and source_block is not null and answer_block <> source_block").select("document_id", F.col("source_block").alias("src"), F.col("answer_block").alias("dst"), "question_id", "relationship", "final_confidence").distinct()


def association_counts(associations: DataFrame) -> DataFrame:
    """Associations by status, by method and by kind of answer, in one pass."""
    sets = F.explode(F.array(*(F.struct(F.lit(c).alias("dimension"), F.coalesce(F.col(c), F.lit("none")).alias("value")) for c in ("status", "method", "answer_kind")))).alias("x")
    return associations.select(sets).groupBy(F.col("x.dimension").alias("dimension"), F.col("x.value").alias("value")).agg(F.count(F.lit(1)).alias("n"))


def stored_answers(questions: DataFrame) -> DataFrame:
    """document_id, question_id, source_block and answer_block of the answers that the questions carry, each once."""
    one = questions.filter("document_id is not null and question_id is not null and answer_association is not null").dropDuplicates(["document_id", "question_id"])
    first = F.lower(F.trim(F.get(F.filter("source_blocks", lambda x: F.trim(x) != ""), F.lit(0))))
    a = F.col("answer_association")
    ids = F.array_distinct(F.filter(F.transform(a["answer_block_ids"], lambda x: F.lower(F.trim(x))), lambda x: x != ""))
    return one.select("document_id", "question_id", first.alias("source_block"), a["status"].alias("status"), a["method"].alias("method"), a["answer_kind"].alias("answer_kind"), a["llm_confidence"].alias("llm_confidence"), a["final_confidence"].alias("final_confidence"), F.coalesce(ids, F.array().cast("array<string>")).alias("ids"))


def findings(stored: DataFrame, blocks: DataFrame, evidence: DataFrame) -> DataFrame:
    """What is wrong with answers: document_id, question_id, check and severity, each once."""
    keys = ["document_id", "question_id"]
    claims = stored.filter("status in ('matched', 'partial') and method <> 'inline'")
    chosen = claims.select(*keys, "source_block", F.explode("ids").alias("block_id"))
    b = blocks.select("document_id", "block_id", "block_type", F.col("section_id").alias("sec"), F.col("part_of_id").alias("par"), "page_index", F.coalesce("text", "caption").alias("body"), F.lit(True).alias("there"))
    src = blocks.select("document_id", F.col("block_id").alias("source_block"), F.col("section_id").alias("q_sec"), F.col("part_of_id").alias("q_par"), F.lit(True).alias("q_there"))
    rows = chosen.join(b, ["document_id", "block_id"], "left").join(src, ["document_id", "source_block"], "left").join(evidence.select(*keys, "block_id", "strength"), [*keys, "block_id"], "left")
    there = F.coalesce("there", F.lit(False))
    apart = F.col("q_there") & ~F.col("sec").eqNullSafe(F.col("q_sec")) & ~F.col("par").eqNullSafe(F.col("q_par"))
    checks = [(~there, "qa_dangling_answer", "error"), (there & F.col("strength").isNull(), "qa_out_of_scope", "error"), (there & (F.col("block_type") == "question"), "qa_answer_is_question", "error"), (there & F.col("page_index").isNull(), "qa_answer_no_provenance", "warn"), (there & F.coalesce(apart, F.lit(False)), "qa_cross_section", "warn")]
    each = F.filter(F.array(*(F.when(c, F.struct(F.lit(n).alias("check"), F.lit(s).alias("severity"))) for c, n, s in checks)), lambda x: x.isNotNull())
    found = rows.select(*keys, F.explode(each).alias("f")).select(*keys, "f.*")
    mine = rows.groupBy(*keys).agg(F.coalesce(F.max("strength"), F.lit(0.0)).alias("own"), F.max(F.trim(F.coalesce("body", F.lit("")))).alias("body"))
    rivals = evidence.join(chosen.select(*keys, "block_id"), [*keys, "block_id"], "left_anti").groupBy(*keys).agg(F.max("strength").alias("rival"))
    stronger = mine.join(rivals, keys).filter(F.col("rival") > F.col("own") + MARGIN).select(*keys, F.lit("qa_competing_stronger").alias("check"), F.lit("warn").alias("severity"))
    blank = claims.select(*keys).join(mine.filter("body <> ''").select(*keys), keys, "left_anti").select(*keys, F.lit("qa_unsupported").alias("check"), F.lit("error").alias("severity"))
    assets = stored.filter("answer_kind in ('table', 'equation')").select(*keys, "source_block", F.explode("ids").alias("block_id")).join(b.filter("block_type in ('table', 'equation')"), ["document_id", "block_id"]).join(src, ["document_id", "source_block"], "left")
    outside = assets.join(evidence.filter("relationship = 'refers_to'").select(*keys, "block_id"), [*keys, "block_id"], "left_anti").filter(F.coalesce(apart, F.lit(True)) & ~F.coalesce(F.col("par") == F.col("source_block"), F.lit(False))).select(*keys, F.lit("mm_asset_out_of_context").alias("check"), F.lit("warn").alias("severity"))
    return found.unionByName(stronger).unionByName(blank).unionByName(outside).distinct()


def calibrated(stored: DataFrame, evidence: DataFrame, found: DataFrame, fused: DataFrame | None = None) -> DataFrame:
    """system, model and calibrated confidence of each answer, with tier and action of the gate.

    fused(document_id, question_id, block_id, channels) are the candidates of all
    channels: one that also points at a chosen block corroborates it.
    """
    keys = ["document_id", "question_id"]
    reliability = F.create_map(*(F.lit(x) for pair in RELIABILITY.items() for x in pair))
    claimed = stored.select(*keys, F.explode("ids").alias("block_id"))
    relation = claimed.join(evidence, [*keys, "block_id"]).groupBy(*keys).agg(F.min_by("relationship", "rank").alias("relationship"))
    top = evidence.filter("rank = 1").select(*keys, F.col("relationship").alias("top_relationship"))
    rivals = evidence.join(claimed, [*keys, "block_id"], "left_anti").groupBy(*keys).agg(F.max("strength").alias("rival"))
    errors = found.filter("severity = 'error'").select(*keys).distinct().withColumn("has_error", F.lit(True))
    d = stored.join(relation, keys, "left").join(top, keys, "left").join(rivals, keys, "left").join(errors, keys, "left")
    bonus = F.lit(0.0)
    if fused is not None:
        seen = lambda channel: F.max(F.contains("channels", F.lit(channel))).alias(f"has_{channel}")
        d = d.join(claimed.join(fused, [*keys, "block_id"]).groupBy(*keys).agg(*map(seen, CORROBORATION)), keys, "left")
        bonus = sum((F.when(F.coalesce(f"has_{c}", F.lit(False)), v).otherwise(0.0) for c, v in CORROBORATION.items()), F.lit(0.0))
    # an answer outside the candidates is as reliable as the strongest of them
    d = d.withColumn("relationship", F.when(F.col("method") == "inline", "inline").otherwise(F.coalesce("relationship", "top_relationship")))
    d = d.withColumn("base", F.coalesce(F.try_element_at(reliability, F.col("relationship")), F.lit(UNKNOWN_RELIABILITY)))
    d = d.withColumn("margin", F.col("base") - F.coalesce("rival", F.lit(0.0)))
    penalty = F.when(F.col("margin") >= 0.1, 0.0).otherwise(-1.5 * (0.1 - F.col("margin")))
    score = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("base") + bonus + penalty))
    absent, open_ = F.col("status") == "not_in_document", (F.col("status") == "ambiguous") | (F.size("ids") == 0)
    d = d.withColumn("system", F.when(absent, F.when(F.col("method") == "no_candidate", 0.9).otherwise(0.65)).when(open_, 0.4).otherwise(F.round(score, 3)))
    blended = F.when(F.col("method").isin("inline", "structural") | absent | open_, F.col("system")).otherwise(0.6 * F.col("system") + 0.4 * F.coalesce("llm_confidence", "system"))
    d = d.withColumn("calibrated", F.round(blended, 3))
    wrong = F.coalesce("has_error", F.lit(False))
    tier = F.when(wrong, "low").when(absent, F.when(F.col("calibrated") >= ABSENT_HIGH, "high").otherwise("medium")).when(F.col("calibrated") >= HIGH, "high").when(F.col("calibrated") >= MEDIUM, "medium").otherwise("low")
    d = d.withColumn("tier", tier)
    action = F.when(wrong, "escalate").when(F.col("tier") == "high", "accept").when(F.col("tier") == "medium", "escalate").otherwise("abstain")
    return d.select(*keys, "status", "system", F.col("llm_confidence").alias("model"), "calibrated", "tier", action.alias("action"))


def gate_rates(gated: DataFrame) -> DataFrame:
    """Answers in all, accepted, escalated and abstained, and the share in percent that is looked at again."""
    n, again = F.count(F.lit(1)), F.count_if(F.col("action") == "escalate")
    return gated.agg(n.alias("n_answers"), F.count_if(F.col("action") == "accept").alias("n_accepted"), again.alias("n_escalated"), F.count_if((F.col("action") == "abstain") | (F.col("status") == "ambiguous")).alias("n_abstained"), F.round(100.0 * again / F.greatest(n, F.lit(1)), 1).alias("retry_rate_pct"))


def flags(gated: DataFrame, found: DataFrame) -> DataFrame:
    """What a reviewer looks at: findings, and answers that the gate doesn't accept."""
    gate = gated.filter("action <> 'accept'").select("document_id", "question_id", F.concat(F.lit("gate_"), "action").alias("flag"), F.lit("gate").alias("severity"))
    return gate.unionByName(found.select("document_id", "question_id", F.col("check").alias("flag"), "severity"))


def gate_counts(gated: DataFrame) -> DataFrame:
    """Answers per tier and action, with those above .85, between and below .6."""
    c = F.col("calibrated")
    return gated.groupBy("tier", "action").agg(F.count(F.lit(1)).alias("n"), F.count_if(c >= 0.85).alias("n_high"), F.count_if((c >= 0.6) & (c < 0.85)).alias("n_middle"), F.count_if(c < 0.6).alias("n_low"))


def recoverable(gated: DataFrame, leaves: DataFrame, evidence: DataFrame, blocks: DataFrame) -> DataFrame:
    """Escalated questions reported absent whose own label stands in a block within reach: the first such block."""
    keys = ["document_id", "question_id"]
    q = gated.filter("action = 'escalate' and status = 'not_in_document'").join(leaves.filter("question_number is not null").select(*keys, "question_number"), keys)
    hit = q.join(evidence.select(*keys, "block_id", "rank"), keys).join(blocks.select("document_id", "block_id", "text"), ["document_id", "block_id"])
    label = F.concat(F.lit("("), F.lower("question_number"), F.lit(")"))
    hit = hit.filter(F.contains(F.lower(F.regexp_replace(T.text_of("text"), r"\(\s*([A-Za-z0-9.]+)\s*\)", "($1)")), label))
    return hit.groupBy(*keys).agg(F.min_by("block_id", F.struct("rank", "block_id")).alias("block_id"))


def escalation_queue(gated: DataFrame, limit: int = 20) -> DataFrame:
    """The first questions to escalate, at most so many a document (the bound is the feature)."""
    w = Window.partitionBy("document_id").orderBy("question_id")
    return gated.filter("action = 'escalate'").withColumn("place", F.row_number().over(w).cast("int")).filter(F.col("place") <= limit).select("document_id", "question_id", "place")


def false_associations(stored: DataFrame, evidence: DataFrame) -> DataFrame:
    """Claimed answers that nothing in the document's structure supports."""
    claimed = stored.filter("status in ('matched', 'partial') and method <> 'inline'").select("document_id", "question_id", F.explode("ids").alias("block_id"))
    return claimed.join(evidence.select("document_id", "question_id", "block_id"), ["document_id", "question_id", "block_id"], "left_anti").distinct()
