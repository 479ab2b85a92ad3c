"""One run over a folder of tables: structure, graph, answers and reports, each written once."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.config import EngineConfig
from folioflow.operators import answers, corpus, evaluate, gold, graph, hierarchy, references, retrieval, structure
from folioflow.session import stage, table
from folioflow.sources import sinks

TABLES = ("blocks", "hierarchy", "questions", "edges", "pages", "raw_blocks")


def metrics(config: EngineConfig | None = None) -> evaluate.Registry:
    """The metrics of a run over its bundle of tables."""
    config = config or EngineConfig()
    return evaluate.Registry({
        "coverage": lambda t: corpus.coverage(t["live"]),
        "provenance": lambda t: corpus.provenance(t["live"]),
        "confidence": lambda t: corpus.confidence(t["live"], config.confidence_threshold),
        "reading_order": lambda t: corpus.order_integrity(t["live"]),
        "integrity": lambda t: corpus.integrity(t["live"], t["pages"]),
        "types": lambda t: corpus.type_counts(t["live"]),
        "edges": lambda t: graph.edge_counts(t["graph_edges"]),
        "questions": lambda t: evaluate.question_counts(t["questions"]),
        "answers": lambda t: answers.association_counts(t["associations"]),
        "gate": lambda t: answers.gate_counts(t["gated"]),
        "gate_rates": lambda t: answers.gate_rates(t["gated"]),
        "orphans": lambda t: references.orphan_counts(t["orphans"]),
    })


def gold_metrics(spark: SparkSession, folder: str) -> dict:
    """Metrics that compare a run with the gold files of a folder."""
    files = gold.read_gold(spark, folder)
    return {
        "gold_structure": lambda t: gold.pass_rate(gold.structure_checks(t["live"], structure.columns(t["live"], t["pages"]), files["structure"])),
        "gold_questions": lambda t: gold.pass_rate(gold.question_checks(t["questions"], files["questions"])),
        "gold_counts": lambda t: gold.pass_rate(gold.count_checks(t["questions"], files["question_counts"])),
        "gold_answers": lambda t: gold.pass_rate(gold.answer_checks(t["questions"], t["live"], files["answers"])),
    }


_ASSOCIATION = "struct<status:string,answer_state:string,method:string,answer_block_ids:array<string>,answer_kind:string,final_confidence:double,llm_confidence:double>"


def questions_of(spark: SparkSession, folder: str) -> DataFrame:
    """The questions table, or where there is none the questions built from the blocks."""
    try:
        return table(spark, folder, "questions")
    except AnalysisException:
        from folioflow.plans.answers import built_of

        none = F.lit(None)
        return stage(built_of(spark, folder)[1].select(
            "document_id", "question_id", "parent_id", none.cast("int").alias("ordinal"), "source_type", "question_type", "bloom_level", "question_number", "question_text", none.cast("array<struct<opt_key:string,opt_text:string>>").alias("options"),
            "marks", F.split("source_blocks", ",").alias("source_blocks"), none.cast(_ASSOCIATION).alias("answer_association"), none.cast("timestamp").alias("associated_at"),
        ), "questions")


def build(spark: SparkSession, folder: str, config: EngineConfig | None = None) -> dict[str, DataFrame]:
    """The bundle of tables of a run; lazy but for the staged inputs."""
    config = config or EngineConfig()
    t = {name: questions_of(spark, folder) if name == "questions" else table(spark, folder, name) for name in TABLES}
    t["live"] = stage(structure.linked(corpus.live_blocks(t["blocks"])), "live")
    t["sections"] = structure.sections(t["live"])
    t["forest"] = hierarchy.hierarchies(t["blocks"], t["hierarchy"])
    t["graph_nodes"] = graph.nodes(t["live"], t["hierarchy"], t["pages"])
    t["graph_edges"] = graph.edges(t["live"], t["hierarchy"])
    leaves = retrieval.leaf_questions(t["questions"])
    found = stage(retrieval.structural_candidates(leaves, t["live"], t["edges"], config.top_candidates), "found")
    t["evidence"] = stage(answers.ranked(found, t["live"], config.top_candidates), "evidence")
    t["fused"] = stage(retrieval.fused_evidence(leaves, t["live"], found, retrieval.block_bm25(leaves, t["live"], config.bm25_top), k=config.top_candidates), "fused")
    t["associations"] = stage(answers.associate(leaves, t["live"], t["evidence"]), "associations")
    stored = stage(answers.stored_answers(t["questions"]), "stored")
    t["findings"] = stage(answers.findings(stored, t["live"], t["evidence"]), "findings")
    t["gated"] = stage(answers.calibrated(stored, t["evidence"], t["findings"], t["fused"]), "gated")
    t["escalations"] = answers.escalation_queue(t["gated"], config.escalations)
    t["orphans"] = stage(references.orphan_references(*(t[n] for n in ("blocks", "hierarchy", "questions", "edges", "pages", "raw_blocks"))), "orphans")
    return t


def run(spark: SparkSession, folder: str, output: str, config: EngineConfig | None = None, gold_folder: str | None = None) -> dict[str, str]:
    """Write the tables and metrics of a run below output; returns the error of each metric that failed."""
    bundle = build(spark, folder, config)
    keep = ("sections", "forest", "evidence", "associations", "findings", "gated", "escalations", "orphans")
    sinks.write_tables({name: bundle[name] for name in keep}, output)
    sinks.write_graph(bundle["graph_nodes"], bundle["graph_edges"], f"{output}/graph")
    failed = {}
    registry = metrics(config)
    for name, metric in (gold_metrics(spark, gold_folder) if gold_folder else {}).items():
        registry.register(name, metric)
    for name, result in registry.run(bundle).items():
        if isinstance(result, str):
            failed[name] = result
        else:
            sinks.write_json(result, f"{output}/metrics/{name}")
    info = spark.createDataFrame([(k, str(v)) for k, v in (config or EngineConfig()).as_dict().items()], "name string, value string").withColumn("finished_at", F.current_timestamp())
    sinks.write_json(info, f"{output}/metrics/settings")
    return failed
