"""References to records that do not exist.

Method: references and records are turned into signed deltas per key; summing
them keeps, for each key, how many references and how many records there are.
Keys with references and no record (or with a record that was deleted or came
too late) form the current orphan report. The state of a key is a plain sum,
minimum or maximum, so new deltas are merged into an old state without reading
the old tables again, hot keys are pre-aggregated before the only shuffle, and
the report itself is a join of the references with the few orphan keys.

Defined results for odd input: null or blank ids are no references and no
records; rows with a null document_id are ignored; ids compare without outer
blanks and case; a ref in raw_blocks counts for each label that it names, also
after a lead-in ('see Fig. 2.3'), a caption only for the one that it starts
with; records delivered several times count by the delivery with
the latest ingested_at (a delivery without a time counts as the earliest; of
deliveries at the same instant a deleted one wins); a reference without a time
is never late and has an empty month; repeated rows count once in the report.
Extra columns are not looked at. Empty tables give an empty report.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.session import stage

_LABEL_ANYWHERE = r"\b(figure|fig|table|tab|equation|eqn|eq)s?\s*\.?\s*[(\[]?\s*(\d+)\s*\.\s*(\d+)"
_LABEL = r"^[\s(\[]*" + _LABEL_ANYWHERE


def clean_id(c: Column | str) -> Column:
    """The form in which ids compare; null for null and blank ones."""
    c = F.col(c) if isinstance(c, str) else c
    return F.nullif(F.lower(F.regexp_replace(c, r"^\s+|\s+$", "")), F.lit(""))


def label_key(c: Column | str) -> Column:
    """'fig N.M', 'table N.M' or 'eq N.M' of a text that starts with such a label, else null."""
    c = F.col(c) if isinstance(c, str) else c
    low = F.lower(c)
    word, major, minor = (F.regexp_extract(low, _LABEL, i) for i in (1, 2, 3))
    kind = F.when(word.startswith("fig"), "fig").when(word.startswith("tab"), "table").when(word.startswith("eq"), "eq")
    number = lambda n: F.when(F.regexp_replace(n, "^0+", "") == "", "0").otherwise(F.regexp_replace(n, "^0+", ""))
    return F.when(kind.isNotNull(), F.concat(kind, F.lit(" "), number(major), F.lit("."), number(minor)))


def label_texts(c: Column | str) -> Column:
    """The labels that a text names at any place, each from its kind to its number; null for null."""
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_extract_all(F.lower(c), F.lit(_LABEL_ANYWHERE), F.lit(0))


def references(edges: DataFrame, questions: DataFrame, raw_blocks: DataFrame) -> DataFrame:
    """ref_table, ref_field, document_id, ref_key, target_key and ref_at of every reference."""
    cols = ("ref_table", "ref_field", "document_id", "ref_key", "target_key", "ref_at")
    ends = edges.select(
        "document_id", F.col("edge_id").cast("string").alias("ref_key"), F.col("created_at").alias("ref_at"),
        F.explode(F.array(F.struct(F.lit("src").alias("f"), F.col("src").alias("id")), F.struct(F.lit("dst").alias("f"), F.col("dst").alias("id")))).alias("e"),
    ).select(F.lit("edges").alias("ref_table"), F.col("e.f").alias("ref_field"), "document_id", "ref_key", clean_id("e.id").alias("target_key"), "ref_at")
    answers = questions.select("document_id", F.col("question_id").alias("ref_key"), F.col("associated_at").alias("ref_at"), F.explode("answer_association.answer_block_ids").alias("id"))
    answers = answers.select(F.lit("questions").alias("ref_table"), F.lit("answer_block_ids").alias("ref_field"), "document_id", "ref_key", clean_id("id").alias("target_key"), "ref_at")
    labels = raw_blocks.select("document_id", F.col("raw_id").cast("string").alias("ref_key"), F.col("extracted_at").alias("ref_at"), F.explode(F.flatten(F.transform(F.array_compact("refs"), label_texts))).alias("id"))
    labels = labels.select(F.lit("raw_blocks").alias("ref_table"), F.lit("refs").alias("ref_field"), "document_id", "ref_key", label_key("id").alias("target_key"), "ref_at")
    return reduce(DataFrame.unionByName, [d.select(*cols) for d in (ends, answers, labels)]).filter("document_id is not null and target_key is not null and ref_key is not null")


def records(blocks: DataFrame, hierarchy: DataFrame, questions: DataFrame, pages: DataFrame) -> DataFrame:
    """document_id, target_key, is_block, ingested_at and deleted of every record that can be referred to."""
    never = F.lit(None).cast("timestamp").alias("ingested_at")

    def plain(df: DataFrame, key: Column) -> DataFrame:
        return df.select("document_id", key.alias("target_key"), F.lit(False).alias("is_block"), never, F.lit(False).alias("deleted"))

    gone = F.col("deleted_at").isNotNull().alias("deleted")
    by_id = blocks.select("document_id", clean_id("block_id").alias("target_key"), F.lit(True).alias("is_block"), "ingested_at", gone)
    by_label = blocks.filter("caption is not null").select("document_id", label_key("caption").alias("target_key"), F.lit(False).alias("is_block"), "ingested_at", gone)
    page_key = F.concat(F.lit("page_"), F.col("page_index").cast("string"))
    every = [by_id, by_label, plain(hierarchy, clean_id("node_id")), plain(questions, clean_id("question_id")), plain(pages, page_key)]
    return reduce(DataFrame.unionByName, every).filter("document_id is not null and target_key is not null")


def reference_deltas(refs: DataFrame, sign: int = 1) -> DataFrame:
    """Deltas of references that came (sign 1) or were withdrawn (sign -1)."""
    return refs.select(
        "document_id", "target_key", F.lit(sign).cast("bigint").alias("refs"), F.lit(0).cast("bigint").alias("rows"), F.col("ref_at").alias("first_ref"),
        F.lit(None).cast("timestamp").alias("first_row"), F.lit(None).cast("struct<at:timestamp,deleted:boolean>").alias("last_row"),
    )


def existence_deltas(rows: DataFrame, sign: int = 1) -> DataFrame:
    """Deltas of records that came (sign 1) or were withdrawn (sign -1)."""
    return rows.select(
        "document_id", "target_key", F.lit(0).cast("bigint").alias("refs"), F.lit(sign).cast("bigint").alias("rows"), F.lit(None).cast("timestamp").alias("first_ref"),
        F.when(F.col("is_block"), F.col("ingested_at")).alias("first_row"), F.struct(F.col("ingested_at").alias("at"), F.col("deleted").alias("deleted")).alias("last_row"),
    )


def merge(*deltas: DataFrame) -> DataFrame:
    """State per key of deltas and earlier states; it has the form of deltas, so states merge again.

    first_ref, first_row and last_row are extremes, which a withdrawal can't lower
    again; apply_changes() takes those of the keys that lost something from what
    is left.
    """
    return reduce(DataFrame.unionByName, deltas).groupBy("document_id", "target_key").agg(
        F.sum("refs").alias("refs"), F.sum("rows").alias("rows"), F.min("first_ref").alias("first_ref"), F.min("first_row").alias("first_row"), F.max("last_row").alias("last_row"),
    )


def apply_changes(
    state: DataFrame, came_refs: DataFrame, came_rows: DataFrame, gone_refs: DataFrame | None = None, gone_rows: DataFrame | None = None,
    refs_left: DataFrame | None = None, rows_left: DataFrame | None = None,
) -> DataFrame:
    """A stored state after references and records came or were withdrawn.

    Counts follow from the signed deltas alone. Where something was withdrawn, the
    tables as they are now (refs_left, rows_left) are read for the keys concerned
    and for no others.
    """
    came = merge(state, reference_deltas(came_refs), existence_deltas(came_rows))
    gone = [d for d in (gone_refs, gone_rows) if d is not None]
    if not gone:
        return came
    if refs_left is None or rows_left is None:
        raise ValueError("withdrawals need the references and records that are left")
    key = ["document_id", "target_key"]
    touched = stage(reduce(DataFrame.unionByName, [d.select(*key) for d in gone]).distinct(), "touched")
    again = merge(reference_deltas(refs_left.join(touched, key, "left_semi")), existence_deltas(rows_left.join(touched, key, "left_semi")))
    return came.join(touched, key, "left_anti").unionByName(again)


def changed_since(refs: DataFrame, rows: DataFrame, cut: Column) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """References and records from before a time (or without one), and those that came from it on."""
    later = lambda c: F.coalesce(F.col(c) >= cut, F.lit(False))
    return refs.filter(~later("ref_at")), rows.filter(~later("ingested_at")), refs.filter(later("ref_at")), rows.filter(later("ingested_at"))


def orphan_keys_from_changes(blocks: DataFrame, hierarchy: DataFrame, questions: DataFrame, edges: DataFrame, pages: DataFrame, raw_blocks: DataFrame) -> DataFrame:
    """The keys with orphan references: the state of all earlier months is stored, and the deltas of the last month are applied to it."""
    refs, rows = references(edges, questions, raw_blocks), records(blocks, hierarchy, questions, pages)
    last = rows.agg(F.max("ingested_at").alias("t")).unionByName(refs.agg(F.max("ref_at").alias("t"))).agg(F.date_trunc("month", F.max("t"))).first()[0]
    old_refs, old_rows, new_refs, new_rows = changed_since(refs, rows, F.lit(last).cast("timestamp"))
    stored = stage(merge(reference_deltas(old_refs), existence_deltas(old_rows)), "key-state")
    keys = orphan_keys(apply_changes(stored, new_refs, new_rows))
    return keys.select("document_id", "target_key", F.col("refs").alias("n_references"), F.coalesce("state", F.lit("late")).alias("reason"))


def orphan_keys(state: DataFrame) -> DataFrame:
    """The keys with references that have no record, a deleted one, or one that came after some reference."""
    missing = F.col("rows") <= 0
    deleted = F.coalesce(F.col("last_row.deleted"), F.lit(False))
    late = F.coalesce(F.col("first_row") > F.col("first_ref"), F.lit(False))
    keys = state.filter((F.col("refs") > 0) & (missing | deleted | late))
    return keys.select("document_id", "target_key", "refs", F.when(missing, "missing").when(deleted, "deleted").alias("state"), "first_row")


def orphans(refs: DataFrame, keys: DataFrame) -> DataFrame:
    """One row per orphan reference."""
    hit = refs.join(keys.drop("refs"), ["document_id", "target_key"]).filter("state is not null or first_row > ref_at")
    # the labels of raw_blocks never count as late: their records carry no first_row
    return hit.select(
        "ref_table", "ref_field", "document_id", "ref_key", "target_key", F.coalesce("state", F.lit("late")).alias("reason"),
        F.coalesce(F.date_format(F.to_utc_timestamp("ref_at", F.current_timezone()), "yyyy-MM"), F.lit("")).alias("ref_month"),
    ).distinct()


def orphan_references(blocks: DataFrame, hierarchy: DataFrame, questions: DataFrame, edges: DataFrame, pages: DataFrame, raw_blocks: DataFrame) -> DataFrame:
    """The orphan report of all tables, one row per reference."""
    refs = references(edges, questions, raw_blocks)
    keys = stage(orphan_keys(merge(reference_deltas(refs), existence_deltas(records(blocks, hierarchy, questions, pages)))), "orphan-keys")
    return orphans(refs, keys)


def orphan_counts(report: DataFrame) -> DataFrame:
    """Orphan references per table, field, reason and month."""
    return report.groupBy("ref_table", "ref_field", "reason", "ref_month").agg(F.count(F.lit(1)).alias("n_references"), F.countDistinct("document_id", "target_key").alias("n_targets"))
