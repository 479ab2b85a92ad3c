"""Writing results: tables, the graph, and readable question sheets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.functions import text as T

STATUS_LABELS = {"matched": "Answer", "partial": "Answer (partial)", "ambiguous": "Answer (ambiguous - needs review)", "not_in_document": "NOT IN DOCUMENT"}


def write_tables(tables: dict[str, DataFrame], folder: str, partition_by: dict[str, list[str]] | None = None) -> None:
    """Write each table to its own folder; an earlier run's is replaced."""
    for name, df in tables.items():
        writer = df.write.mode("overwrite")
        keys = (partition_by or {}).get(name)
        (writer.partitionBy(*keys) if keys else writer).parquet(f"{folder}/{name}")


def read_tables(spark: SparkSession, folder: str, names: list[str]) -> dict[str, DataFrame | None]:
    """Tables of an earlier run; a missing one is None."""
    out: dict[str, DataFrame | None] = {}
    for name in names:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
        there = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
        out[name] = spark.read.parquet(f"{folder}/{name}") if there else None
    return out


def write_graph(nodes: DataFrame, edges: DataFrame, folder: str) -> None:
    """Nodes with one row an id, and edges partitioned by type and sorted by source, which stands for indexes."""
    one = nodes.dropDuplicates(["document_id", "node_id"])
    write_tables({"nodes": one, "edges": edges.repartition("edge_type", "document_id").sortWithinPartitions("edge_type", "document_id", "src")}, folder, {"edges": ["edge_type"]})


def write_json(df: DataFrame, folder: str) -> None:
    """One JSON object a row, without null fields."""
    df.write.mode("overwrite").option("ignoreNullFields", "true").json(folder)


def marks_label(c: Column | str = "marks") -> Column:
    """' · 2 marks' of a number of marks, '' of none: absent isn't zero."""
    m = F.col(c) if isinstance(c, str) else c
    number = F.when(m == F.floor(m), F.floor(m).cast("string")).otherwise(m.cast("string"))
    return F.when(m.isNull(), "").otherwise(F.concat(F.lit(" · "), number, F.when(m == 1, " mark").otherwise(" marks")))


def render_lines(tree: DataFrame, questions: DataFrame) -> DataFrame:
    """Lines of a question sheet in depth-first order: document_id, id_path, line_no, line.

    tree(document_id, question_id, depth, id_path). Options are printed only where
    the stem doesn't show them.
    """
    q = questions.filter("document_id is not null and question_id is not null").dropDuplicates(["document_id", "question_id"]).join(tree.select("document_id", "question_id", "depth", "id_path"), ["document_id", "question_id"])
    indent = F.repeat(F.lit("  "), F.col("depth"))
    head = F.concat(indent, F.coalesce("question_number", "question_id"), F.lit(". "), T.script_marks(T.escaped("question_text")))
    meta = F.concat(indent, F.concat_ws(" · ", "question_type", "source_type"), marks_label())
    opts = F.filter(F.coalesce("options", F.array().cast("array<struct<opt_key:string,opt_text:string>>")), lambda o: ~F.contains(T.text_of("question_text"), F.coalesce(o["opt_text"], F.lit(""))))
    options = F.transform(opts, lambda o: F.concat(indent, F.lit("("), F.coalesce(o["opt_key"], F.lit("?")), F.lit(") "), T.escaped(o["opt_text"])))
    status = F.col("answer_association.status")
    labels = F.create_map(*(F.lit(x) for pair in STATUS_LABELS.items() for x in pair))
    answer = F.when(status.isNotNull(), F.array(F.concat(indent, F.coalesce(F.try_element_at(labels, status), status)))).otherwise(F.array().cast("array<string>"))
    rows = q.select("document_id", "id_path", F.posexplode(F.concat(F.array(head, meta), options, answer)).alias("line_no", "line"))
    return rows.filter("line is not null")


def export_summary(tree: DataFrame, questions: DataFrame) -> DataFrame:
    """Per document: top-level and all questions, answered ones and those without an answer."""
    one = questions.filter("document_id is not null and question_id is not null").dropDuplicates(["document_id", "question_id"]).join(tree.select("document_id", "question_id", "depth"), ["document_id", "question_id"])
    status = F.col("answer_association.status")
    return one.groupBy("document_id").agg(F.count_if(F.col("depth") == 0).alias("n_top"), F.count(F.lit(1)).alias("n_all"), F.count_if(status.isin("matched", "partial")).alias("n_answered"), F.count_if(status == "not_in_document").alias("n_absent"))
