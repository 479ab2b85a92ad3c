"""Assertions that a gold file makes about documents, found by text so that ids may change."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.functions import text as T


def _first(blocks: DataFrame, criteria: DataFrame) -> DataFrame:
    """The first block in order whose text contains each criterion's needle."""
    hits = blocks.join(criteria, "document_id").filter((F.col("needle") != "") & F.contains(F.lower(T.text_of("text")), F.lower("needle")))
    return hits.groupBy("document_id", "check_id").agg(F.min_by("block_id", "reading_order").alias("block_id"))


def structure_checks(blocks: DataFrame, columns: DataFrame, gold: DataFrame) -> DataFrame:
    """document_id, check_id, kind and passed of each assertion.

    gold(document_id, check_id, kind, needle, expect_int, expect_text, page_from,
    page_to): 'ordering' (the needle stands on page_from before a block of type
    expect_text), 'part_of' (at least expect_int children), 'continuation'
    (of type expect_text from page_from to page_to), 'inline' (expect_int 1 or 0),
    'layout' (expect_int columns on page_from). Needles are few; each is compared
    with its own document only.
    """
    keys = ["document_id", "check_id"]
    kind = lambda name: gold.filter(F.col("kind") == name)
    at = lambda name: kind(name).select("document_id", "check_id", "needle")
    done = []
    first = _first(blocks, at("ordering")).join(blocks.select("document_id", "block_id", "reading_order", "page_index"), ["document_id", "block_id"])
    typed = kind("ordering").join(blocks.select("document_id", F.col("block_type").alias("expect_text"), F.col("page_index").alias("page_from"), F.col("reading_order").alias("later")), ["document_id", "expect_text", "page_from"])
    later = typed.groupBy(*keys, "page_from").agg(F.max("later").alias("later")).join(first, keys).filter("reading_order < later and page_index = page_from").select(*keys)
    done.append(("ordering", later))
    parents = _first(blocks, at("part_of")).join(blocks.filter("part_of_id is not null").groupBy("document_id", F.col("part_of_id").alias("block_id")).agg(F.count(F.lit(1)).alias("n")), ["document_id", "block_id"])
    done.append(("part_of", parents.join(kind("part_of").select(*keys, "expect_int"), keys).filter("n >= expect_int").select(*keys)))
    to = blocks.select("document_id", F.col("block_id").alias("continues_to"), F.col("page_index").alias("page_to"))
    links = blocks.filter("continues_to is not null").select("document_id", F.col("block_type").alias("expect_text"), F.col("page_index").alias("page_from"), "continues_to").join(to, ["document_id", "continues_to"])
    done.append(("continuation", kind("continuation").join(links, ["document_id", "expect_text", "page_from", "page_to"]).select(*keys).distinct()))
    inline = _first(blocks, at("inline")).join(blocks.select("document_id", "block_id", F.coalesce("inline_answer", F.lit(False)).alias("inl")), ["document_id", "block_id"]).join(kind("inline").select(*keys, "expect_int"), keys)
    done.append(("inline", inline.filter("cast(inl as int) = expect_int").select(*keys)))
    done.append(("layout", kind("layout").join(columns.select("document_id", F.col("page_index").alias("page_from"), F.col("n_columns").alias("expect_int")), ["document_id", "page_from", "expect_int"]).select(*keys)))
    passed = reduce(DataFrame.unionByName, [d.select(*keys) for _, d in done]).distinct().withColumn("ok", F.lit(True))
    return gold.select(*keys, "kind").join(passed, keys, "left").select(*keys, "kind", F.coalesce("ok", F.lit(False)).alias("passed"))


def question_checks(questions: DataFrame, gold: DataFrame) -> DataFrame:
    """document_id, check_id and passed: the first question that fits a criterion has what is expected of it; null expectations don't count.

    gold(document_id, check_id, text_contains, question_number, source_type,
    expect_type, expect_marks, expect_status, min_parts).
    """
    keys = ["document_id", "check_id"]
    parts = questions.filter("parent_id is not null").groupBy("document_id", F.col("parent_id").alias("question_id")).agg(F.countDistinct("question_id").alias("n_parts"))
    q = questions.dropDuplicates(["document_id", "question_id"]).withColumnsRenamed({"question_number": "own_number", "source_type": "own_source"}).join(parts, ["document_id", "question_id"], "left")
    fits = lambda want, own: F.col(want).isNull() | (F.col(want) == F.col(own))
    hit = gold.join(q, "document_id").filter((F.col("text_contains").isNull() | F.contains(F.lower(T.text_of("question_text")), F.lower("text_contains"))) & fits("question_number", "own_number") & fits("source_type", "own_source"))
    ok = fits("expect_type", "question_type") & fits("expect_marks", "marks") & (F.col("expect_status").isNull() | (F.col("expect_status") == F.col("answer_association.status"))) & (F.col("min_parts").isNull() | (F.coalesce("n_parts", F.lit(0)) >= F.col("min_parts")))
    first = hit.groupBy(*keys).agg(F.min_by(F.coalesce(ok, F.lit(False)), F.struct("ordinal", "question_id")).alias("passed"))
    return gold.select(*keys).join(first, keys, "left").select(*keys, F.coalesce("passed", F.lit(False)).alias("passed"))


# Fields of the gold files, one JSON object a line.
FILES = {
    "structure": "document_id string, check_id string, kind string, needle string, expect_int int, expect_text string, page_from int, page_to int",
    "questions": "document_id string, check_id string, text_contains string, question_number string, source_type string, expect_type string, expect_marks double, expect_status string, min_parts int",
    "question_counts": "document_id string, check_id string, source_type string, question_type string, text_contains string, least int, most int",
    "answers": "document_id string, check_id string, text_contains string, question_number string, expect_status string, answer_contains string, expect_method string",
}


def read_gold(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The gold files of a folder by name, each with its schema; a file that is not there has no checks."""
    jvm = spark.sparkContext._jvm
    out = {}
    for name, schema in FILES.items():
        path = f"{folder.rstrip('/')}/{name}.json"
        at = jvm.org.apache.hadoop.fs.Path(path)
        there = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)
        out[name] = spark.read.schema(schema).json(path) if there else spark.createDataFrame([], schema)
    return out


def count_checks(questions: DataFrame, gold: DataFrame) -> DataFrame:
    """document_id, check_id and passed: as many questions fit a criterion as it allows; a null bound is none, a null criterion fits all."""
    keys = ["document_id", "check_id"]
    q = questions.filter("question_id is not null").dropDuplicates(["document_id", "question_id"]).select("document_id", F.col("source_type").alias("own_source"), F.col("question_type").alias("own_type"), F.lower(T.text_of("question_text")).alias("own_text"))
    fits = lambda want, own: F.col(want).isNull() | (F.col(want) == F.col(own))
    said = F.col("text_contains").isNull() | F.contains("own_text", F.lower("text_contains"))
    hit = gold.join(q, "document_id").filter(fits("source_type", "own_source") & fits("question_type", "own_type") & said).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    n = F.coalesce("n", F.lit(0))
    return gold.join(hit, keys, "left").select(*keys, ((n >= F.coalesce("least", F.lit(0))) & (F.col("most").isNull() | (n <= F.col("most")))).alias("passed"))


def answer_checks(questions: DataFrame, blocks: DataFrame, gold: DataFrame) -> DataFrame:
    """document_id, check_id and passed: the first question that fits has the status and method, and an answer block that contains what is expected."""
    keys = ["document_id", "check_id"]
    q = questions.filter("question_id is not null").dropDuplicates(["document_id", "question_id"]).withColumnRenamed("question_number", "own_number")
    hit = gold.join(q, "document_id").filter((F.col("text_contains").isNull() | F.contains(F.lower(T.text_of("question_text")), F.lower("text_contains"))) & (F.col("question_number").isNull() | (F.col("question_number") == F.col("own_number"))))
    a = F.col("answer_association")
    first = hit.groupBy(*keys).agg(F.min_by(F.struct(a["status"].alias("status"), a["method"].alias("method"), a["answer_block_ids"].alias("ids")), F.struct("ordinal", "question_id")).alias("q"))
    ids = first.select(*keys, F.explode("q.ids").alias("id")).select(*keys, F.lower(F.trim("id")).alias("block_id"))
    shown = ids.join(blocks.select("document_id", "block_id", F.lower(F.concat_ws(" ", "text", "caption")).alias("body")), ["document_id", "block_id"]).join(gold.select(*keys, "answer_contains"), keys)
    holds = shown.filter(F.contains("body", F.lower("answer_contains"))).select(*keys).distinct().withColumn("holds", F.lit(True))
    d = gold.join(first, keys, "left").join(holds, keys, "left")
    same = lambda want, own: F.col(want).isNull() | F.coalesce(F.col(want) == F.col(own), F.lit(False))
    ok = F.col("q").isNotNull() & same("expect_status", "q.status") & same("expect_method", "q.method") & (F.col("answer_contains").isNull() | F.coalesce("holds", F.lit(False)))
    return d.select(*keys, ok.alias("passed"))


def pass_rate(checks: DataFrame) -> DataFrame:
    """Checks, passed ones and the rate in percent."""
    n, ok = F.count(F.lit(1)), F.count_if("passed")
    return checks.agg(n.alias("n_checks"), ok.alias("n_passed"), F.when(n > 0, 100.0 * ok / n).otherwise(0.0).alias("pass_rate_pct"))
