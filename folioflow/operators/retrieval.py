"""Retrieval channels: BM25, vectors, document structure, and their fusion."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioflow.functions import text as T
from folioflow.operators import ordering
from folioflow.session import stage

K1, B = 1.5, 0.75
STOP_TYPES = ("question", "worked_example")
SKIP_TYPES = ("figure", "image", "diagram", "caption", "noise", "banner")
SCAN, RUN, CONTAINER_RUN = 14, 5, 8
QUERY_BLOCK = 4096
BM25_BLOCK = 1024


def term_statistics(docs: DataFrame, key: str, text: str) -> DataFrame:
    """token and df of a corpus."""
    return docs.select(key, F.explode(F.array_distinct(T.tokens(text))).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("df"))


def corpus_size(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Number of documents, of tokens, and mean length, in one row."""
    return docs.select(F.size(T.tokens(text)).alias("n")).agg(F.count(F.lit(1)).alias("n_docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_tokens"), F.avg("n").alias("avg_length"))


def _bm25_scores(ids: list[int], vocabulary: dict[str, int], weights: np.ndarray, mean: float, key: str, k: int):
    schema = pa.schema([("query_id", pa.int64()), (key, pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, scores = [], []
            for doc, tokens in zip(batch.column(key).to_pylist(), batch.column("_t").to_pylist()):
                counts: dict[int, int] = {}
                for t in tokens or ():
                    at = vocabulary.get(t)
                    if at is not None:
                        counts[at] = counts.get(at, 0) + 1
                if counts:
                    tf = np.fromiter(counts.values(), np.float64, len(counts))
                    own.append(doc)
                    scores.append((tf / (tf + K1 * (1 - B + B * len(tokens) / mean))) @ weights[list(counts)])
            if not own:
                continue
            table, docs, out = np.array(scores), np.array(own, np.int64), []
            for q, column in zip(ids, table.T):
                near = np.flatnonzero(column > 0)
                if len(near) > k:
                    near = near[column[near] >= np.partition(column[near], -k)[-k] - 1e-9]
                out += zip([q] * len(near), docs[near].tolist(), column[near].tolist())
            for at in range(0, len(out), 50_000):
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out[at:at + 50_000]), schema)], schema=schema)

    return run


def bm25_topk(queries: DataFrame, query_key: str, query_text: str, docs: DataFrame, key: str, text: str, k: int = 8, block: int = BM25_BLOCK) -> DataFrame:
    """query_key, key, score, share of the best score, and rank of each query's k best documents; both keys are numbers.

    Frequencies of the queries' tokens are counted over all documents first. Then
    queries come in blocks of bounded size, each of which sees every document once;
    a batch of documents passes on only its own k best per query, so what is
    shuffled doesn't grow with the number of hits. A token that comes twice in a
    query counts twice.
    """
    terms = queries.filter(F.col(query_key).isNotNull()).select(F.col(query_key).cast("bigint").alias("q"), F.explode(T.tokens(query_text)).alias("token")).groupBy("q", "token").agg(F.count(F.lit(1)).alias("times"))
    rows = docs.filter(F.col(key).isNotNull()).select(F.col(key).cast("bigint").alias(key), T.tokens(text).alias("_t"))
    vocabulary = terms.select("token").distinct()
    df = rows.select(F.explode(F.array_distinct("_t")).alias("token")).join(vocabulary, "token", "left_semi").groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    size = corpus_size(docs, key, text).first()
    idf = F.log(1 + (F.lit(float(size["n_docs"])) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weighted = terms.join(df, "token").select("q", "token", (F.col("times") * idf * (K1 + 1)).alias("w"))
    n = queries.count()
    blocks, parts = max(1, -(-n // block)), []
    for b in range(blocks):
        w = weighted.filter(F.pmod(F.xxhash64("q"), F.lit(blocks)) == b).collect()
        if not w:
            continue
        ids, words = sorted({r["q"] for r in w}), {t: i for i, t in enumerate(sorted({r["token"] for r in w}))}
        at = {q: i for i, q in enumerate(ids)}
        matrix = np.zeros((len(words), len(ids)))
        for r in w:
            matrix[words[r["token"]], at[r["q"]]] = r["w"]
        parts.append(rows.mapInArrow(_bm25_scores(ids, words, matrix, float(size["avg_length"]), key, k), f"query_id bigint, {key} bigint, score double"))
    if not parts:
        return docs.limit(0).select(F.lit(0).cast("bigint").alias(query_key), F.col(key).cast("bigint").alias(key), F.lit(0.0).alias("score"), F.lit(0.0).alias("share"), F.lit(0).alias("rank"))
    scored = reduce(DataFrame.unionByName, parts)
    best = Window.partitionBy("query_id").orderBy(F.round("score", 9).desc(), key)
    top = scored.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return top.select(F.col("query_id").alias(query_key), key, "score", (F.col("score") / F.max("score").over(Window.partitionBy("query_id"))).alias("share"), F.col("rank").cast("int").alias("rank"))


def _nearest(ids: list[int], matrix: np.ndarray, k: int):
    unit = matrix / np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), 1e-12)
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("similarity", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = np.array(batch.column("vec_id").to_pylist(), np.int64)
            if not len(own):
                continue
            vectors = np.array(batch.column("embedding").to_pylist(), np.float64)
            vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
            sims = unit @ vectors.T
            out = []
            for q, row in zip(ids, sims):
                near = np.argsort(-np.round(row, 9), kind="stable")[:k + 1] if len(own) <= k + 1 else np.flatnonzero(row >= np.partition(row, -k - 1)[-k - 1] - 1e-9)
                out += [(q, int(own[j]), float(row[j])) for j in near if own[j] != q]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return run


def cosine_topk(queries: DataFrame, vectors: DataFrame, k: int = 8, block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, vec_id, similarity and rank of the k vectors nearest to each query vector (vec_id, embedding); itself left out.

    Exact. Queries come in blocks that each see all vectors once; a batch of
    vectors passes on only its own k best per query.
    """
    usable = F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & ~F.exists("embedding", lambda x: x.isNull())
    queries, vectors = queries.filter(usable), vectors.filter(usable)
    n = queries.count()
    parts = []
    for b in range(max(1, -(-n // block))):
        rows = queries.filter(F.pmod(F.xxhash64("vec_id"), F.lit(max(1, -(-n // block)))) == b).select("vec_id", "embedding").collect()
        if rows:
            parts.append(vectors.select(F.col("vec_id").cast("bigint"), "embedding").mapInArrow(_nearest([r[0] for r in rows], np.array([r[1] for r in rows], np.float64), k), "query_id bigint, vec_id bigint, similarity double"))
    if not parts:
        return vectors.limit(0).select(F.lit(0).cast("bigint").alias("query_id"), F.col("vec_id").cast("bigint"), F.lit(0.0).alias("similarity"), F.lit(0).alias("rank"))
    near = reduce(DataFrame.unionByName, parts)
    best = Window.partitionBy("query_id").orderBy(F.round("similarity", 9).desc(), "vec_id")
    return near.withColumn("rank", F.row_number().over(best).cast("int")).filter(F.col("rank") <= k)


def block_bm25(leaves: DataFrame, blocks: DataFrame, k: int = 8) -> DataFrame:
    """document_id, question_id, block_id, score and share of the k answer blocks of its own document that fit a question best.

    An inverted index: tokens of questions are joined with the postings of the
    document's answer blocks. Counts are per document.
    """
    pool = blocks.filter(F.col("block_type").isin(*T.ANSWER_TYPES) & F.coalesce("text", "caption").isNotNull()).select("document_id", "block_id", T.tokens(F.concat_ws(" ", "text", "caption")).alias("t"))
    sized = pool.select("document_id", "block_id", F.size("t").alias("dl"), "t")
    mean = sized.groupBy("document_id").agg(F.count(F.lit(1)).alias("n"), F.avg("dl").alias("mean"))
    postings = sized.select("document_id", "block_id", "dl", F.explode("t").alias("token")).groupBy("document_id", "block_id", "dl", "token").agg(F.count(F.lit(1)).alias("tf"))
    df = postings.groupBy("document_id", "token").agg(F.count(F.lit(1)).alias("df"))
    idf = df.join(mean, "document_id").select("document_id", "token", "mean", F.log(1 + (F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5)).alias("idf"))
    terms = leaves.select("document_id", "question_id", F.explode(T.tokens("question_text")).alias("token")).groupBy("document_id", "question_id", "token").agg(F.count(F.lit(1)).alias("times"))
    part = F.col("times") * F.col("idf") * (K1 + 1) * F.col("tf") / (F.col("tf") + K1 * (1 - B + B * F.col("dl") / F.col("mean")))
    scored = terms.join(idf, ["document_id", "token"]).join(postings, ["document_id", "token"]).groupBy("document_id", "question_id", "block_id").agg(F.sum(part).alias("score"))
    mine = Window.partitionBy("document_id", "question_id")
    best = scored.withColumn("place", F.row_number().over(mine.orderBy(F.round("score", 9).desc(), "block_id"))).filter(F.col("place") <= k)
    return best.select("document_id", "question_id", "block_id", "score", (F.col("score") / F.max("score").over(mine)).alias("share"))


def fused_evidence(leaves: DataFrame, blocks: DataFrame, structural: DataFrame, lexical: DataFrame, semantic: DataFrame | None = None, k: int = 6) -> DataFrame:
    """The k best candidates of each question over all channels, with relationship and scope.

    structural as structural_candidates() gives it; lexical and semantic
    (document_id, question_id, block_id, share). A block is in scope if a
    relationship or the question's own section says so.
    """
    keys = ("document_id", "question_id")
    lexical = lexical.select(*keys, "block_id", F.col("share").alias("score"))
    semantic = lexical.limit(0) if semantic is None else semantic.select(*keys, "block_id", F.col("share").alias("score"))
    sections = blocks.select("document_id", "block_id", "section_id", "reading_order")
    best = Window.partitionBy(*keys).orderBy(F.desc("rerank"), "reading_order", "block_id")
    one = channel_union(structural, lexical, semantic, keys).join(sections, ["document_id", "block_id"]).withColumn("rank", F.row_number().over(best).cast("int")).filter(F.col("rank") <= k)
    asked = leaves.join(sections.drop("reading_order"), ["document_id", "block_id"]).select(*keys, F.col("section_id").alias("q_section"), F.lit(True).alias("placed"))
    d = one.join(structural.select(*keys, "block_id", "relationship"), [*keys, "block_id"], "left").join(asked, list(keys), "left")
    in_scope = F.col("relationship").isNotNull() | (F.coalesce("placed", F.lit(False)) & (F.col("section_id") == F.col("q_section")))
    return d.select(*keys, "block_id", F.coalesce("relationship", F.lit("none")).alias("relationship"), F.when(F.coalesce(in_scope, F.lit(False)), "in_scope").otherwise("cross_section").alias("scope"), "strength", "lexical", "rerank", "channels", "rank")


def channel_union(structural: DataFrame, lexical: DataFrame, semantic: DataFrame, keys: tuple[str, ...] = ("query_id",)) -> DataFrame:
    """Union of the channels per query and block_id: structural strength decides, the others stay below it.

    structural(keys, block_id, strength), lexical and semantic(keys, block_id, score).
    """
    zero = F.lit(None).cast("double")
    every = structural.select(*keys, "block_id", F.col("strength").alias("st"), zero.alias("le"), zero.alias("se"))
    every = every.unionByName(lexical.select(*keys, "block_id", zero.alias("st"), F.col("score").alias("le"), zero.alias("se")))
    every = every.unionByName(semantic.select(*keys, "block_id", zero.alias("st"), zero.alias("le"), F.col("score").alias("se")))
    one = every.groupBy(*keys, "block_id").agg(*(F.coalesce(F.max(c), F.lit(0.0)).alias(c) for c in ("st", "le", "se")), *(F.max(F.col(c).isNotNull()).alias(f"h_{c}") for c in ("st", "le", "se")))
    rerank = F.when(F.col("st") > 0, F.col("st")).otherwise(F.round((0.5 * F.col("se") + 0.3 * F.col("le")) * 0.7, 4))
    channels = F.array_join(F.array_compact(F.array(F.when(F.col("h_le"), "lexical"), F.when(F.col("h_se"), "semantic"), F.when(F.col("h_st"), "structural"))), ",")
    return one.select(*keys, "block_id", F.col("st").alias("strength"), F.col("le").alias("lexical"), F.col("se").alias("semantic"), rerank.alias("rerank"), channels.alias("channels"))


def fuse(structural: DataFrame, lexical: DataFrame, semantic: DataFrame, k: int = 6) -> DataFrame:
    """The k best of channel_union() per query_id."""
    best = Window.partitionBy("query_id").orderBy(F.desc("rerank"), "block_id")
    return channel_union(structural, lexical, semantic).withColumn("rank", F.row_number().over(best).cast("int")).filter(F.col("rank") <= k)


def leaf_questions(questions: DataFrame) -> DataFrame:
    """Questions, each once, that no question names as its parent, with the id of their first source block."""
    one = questions.filter("document_id is not null and question_id is not null").dropDuplicates(["document_id", "question_id"])
    parents = one.filter("parent_id is not null").select("document_id", F.col("parent_id").alias("question_id")).distinct()
    first = F.lower(F.trim(F.get(F.filter("source_blocks", lambda x: F.trim(x) != ""), F.lit(0))))
    return one.join(parents, ["document_id", "question_id"], "left_anti").select("document_id", "question_id", "question_number", "question_text", first.alias("block_id"))


def _runs(starts: DataFrame, placed: DataFrame, limit: int) -> DataFrame:
    """document_id, start_id, block_id of the answer blocks behind a start(document_id, start_id, n): a scan of at most SCAN rows.

    The scanned rows come from a join on position, and only for the starts.
    """
    steps = starts.select("document_id", "start_id", F.posexplode(F.sequence(F.col("n") + 1, F.col("n") + SCAN)).alias("step", "n"))
    t = F.trim(T.text_of("text"))
    heading = F.col("block_type").isin(*T.HEADING_TYPES) | F.col("heading_level").isNotNull()
    what = (
        F.when(heading & t.rlike(rf"(?i)^{T.ANSWER_WORD}\b\s*[:.]?$"), "skip").when(F.col("block_type").isin(*STOP_TYPES) | (F.col("group_role") == "container") | heading, "stop")
        .when(F.col("block_type").isin(*T.ANSWER_TYPES), "take").when(F.col("block_type").isin(*SKIP_TYPES), "skip").when(t.rlike(T.SOURCE_TAG), "tag").otherwise("stop")
    )
    seen = steps.join(placed.select("document_id", "n", "block_id", what.alias("what")), ["document_id", "n"])
    rows = seen.groupBy("document_id", "start_id").agg(F.array_sort(F.collect_list(F.struct("step", "what", "block_id"))).alias("rows"))
    zero = F.struct(F.array().cast("array<string>").alias("out"), F.lit(0).alias("tags"), F.lit(False).alias("stopped"))

    def fold(acc, r):
        full = F.size(acc["out"]) >= limit
        tag = (r["what"] == "tag") & (F.size(acc["out"]) == 0) & (acc["tags"] < 1)
        stop = acc["stopped"] | full | (r["what"] == "stop") | ((r["what"] == "tag") & ~tag)
        return F.struct(F.when(~stop & (r["what"] == "take"), F.concat(acc["out"], F.array(r["block_id"]))).otherwise(acc["out"]).alias("out"), F.when(~stop & tag, acc["tags"] + 1).otherwise(acc["tags"]).alias("tags"), stop.alias("stopped"))

    return rows.select("document_id", "start_id", F.explode(F.aggregate("rows", zero, fold, lambda acc: acc["out"])).alias("block_id"))


def _first_of_section(eligible: DataFrame, bound: int) -> DataFrame:
    """The first answer blocks of each section in reading order, and those whose continuation is among its first ones."""
    first = F.row_number().over(Window.partitionBy("document_id", "q_section").orderBy("reading_order", "block_id"))
    targets = eligible.select("document_id", F.col("block_id").alias("continues_to"), F.col("reading_order").alias("to_order"))
    onward = F.dense_rank().over(Window.partitionBy("document_id", "q_section").orderBy("to_order", "continues_to"))
    near = eligible.filter("q_section is not null")
    cols = ("document_id", "q_section", "block_id")
    return near.withColumn("r", first).filter(F.col("r") <= bound).select(*cols).unionByName(near.join(targets, ["document_id", "continues_to"]).withColumn("r", onward).filter(F.col("r") <= bound).select(*cols)).distinct()


def structural_candidates(leaves: DataFrame, blocks: DataFrame, edges: DataFrame, best: int | None = None) -> DataFrame:
    """document_id, question_id, block_id, relationship and strength: answer blocks that a question's place in the document points to.

    Of one block's relationships the strongest counts, the first in order of
    source among equals. Blocks without a section share none.
    """
    # both are read by several branches: written once instead of being windowed and joined again in each
    placed = stage(ordering.running(blocks, ["document_id"], "reading_order", {"n": F.lit(1)}), "placed")
    eligible = blocks.filter(F.col("block_type").isin(*T.ANSWER_TYPES)).select("document_id", "block_id", "part_of_id", "section_id", "text", "enumerator", "continues_to", "reading_order")
    q = leaves.join(placed.select("document_id", "block_id", "n", F.col("part_of_id").alias("q_part"), F.col("section_id").alias("q_section")), ["document_id", "block_id"]).withColumnRenamed("block_id", "q_block")
    q = stage(q.drop("question_text"), "asked")
    example = blocks.select("document_id", F.col("block_id").alias("q_part"), (F.col("block_type") == "worked_example").alias("is_example"))
    matches = lambda: F.coalesce((F.lower("enumerator") == F.lower("question_number")) | F.lower(F.trim(T.text_of("text"))).startswith(F.concat(F.lit("("), F.lower("question_number"), F.lit(")"))) | F.lower(F.trim(T.text_of("text"))).startswith(F.concat(F.lit("ans. ("), F.lower("question_number"), F.lit(")"))), F.lit(False))
    cols = ("document_id", "question_id", "block_id", "relationship", "strength", "source")
    rel = lambda df, relationship, strength, source: df.select("document_id", "question_id", "block_id", relationship.alias("relationship"), strength.cast("double").alias("strength"), F.lit(source).alias("source"))
    inside = q.filter("q_part is not null").join(eligible.withColumnRenamed("part_of_id", "q_part"), ["document_id", "q_part"]).join(example, ["document_id", "q_part"], "left").filter("block_id <> q_block")
    one = rel(inside, F.when(F.coalesce("is_example", F.lit(False)), "same_worked_example").when(matches(), "same_container_enum").otherwise("same_container"), F.when(matches(), 0.95).otherwise(0.85), 1)
    last = placed.filter("part_of_id is not null").groupBy("document_id", "part_of_id").agg(F.max("n").alias("n")).select("document_id", F.col("part_of_id").alias("start_id"), "n")
    last = last.join(q.select("document_id", F.col("q_part").alias("start_id")).distinct(), ["document_id", "start_id"], "left_semi")
    shared = q.filter("q_part is not null").join(_runs(last, placed, CONTAINER_RUN).withColumnRenamed("start_id", "q_part"), ["document_id", "q_part"]).join(eligible.select("document_id", "block_id", "text", "enumerator"), ["document_id", "block_id"])
    two = rel(shared, F.when(matches(), "container_solution_enum").otherwise("container_solution_run"), F.when(matches(), 0.92).otherwise(0.7), 2)
    run = _runs(q.select("document_id", F.col("q_block").alias("start_id"), "n").distinct(), placed, RUN)
    three = rel(q.join(run.withColumnRenamed("start_id", "q_block"), ["document_id", "q_block"]), F.lit("adjacent_solution"), F.lit(0.9), 3)
    clean = lambda c: F.lower(F.trim(F.col(c)))
    refers = edges.filter("edge_type = 'refers_to'").select("document_id", clean("src").alias("q_block"), clean("dst").alias("block_id")).distinct()
    assets = blocks.filter(F.col("block_type").isin("table", "equation")).select("document_id", "block_id")
    four = rel(q.join(refers, ["document_id", "q_block"]).join(assets, ["document_id", "block_id"]), F.lit("refers_to"), F.lit(0.75), 4)
    around = eligible.select("document_id", "block_id", F.col("section_id").alias("q_section"), "reading_order", "continues_to")
    # of the first 2 * best + 1 at most best are stronger by another relationship, and one is the question itself
    around = around if best is None else _first_of_section(around, 2 * best + 1)
    near = q.filter("q_section is not null").join(around.select("document_id", "block_id", "q_section"), ["document_id", "q_section"]).filter("block_id <> q_block")
    five = rel(near, F.lit("same_section"), F.lit(0.6), 5)
    every = one
    for more in (two, three, four, five):
        every = every.unionByName(more.select(*cols))
    strongest = lambda df: df.groupBy("document_id", "question_id", "block_id").agg(F.max_by(F.struct("relationship", "strength", "source"), F.struct("strength", -F.col("source"))).alias("b")).select("document_id", "question_id", "block_id", "b.*")
    first = strongest(every)
    onward = first.join(eligible.filter("continues_to is not null").select("document_id", "block_id", F.col("continues_to").alias("to")), ["document_id", "block_id"]).join(eligible.select("document_id", F.col("block_id").alias("to")), ["document_id", "to"])
    six = rel(onward.drop("block_id", "relationship", "source").withColumnRenamed("to", "block_id"), F.lit("continuation"), F.greatest(F.lit(0.8), F.col("strength") - 0.05), 6)
    return strongest(first.unionByName(six)).select("document_id", "question_id", "block_id", "relationship", "strength")


def structural_neighbours(blocks: DataFrame, wanted: DataFrame, k: int = 10) -> DataFrame:
    """The k blocks nearest to each wanted(document_id, block_id) block: neighbours .9, section .7, heading .6.

    blocks has prev_id, next_id, section_id and parent_block.
    """
    w = blocks.join(wanted, ["document_id", "block_id"], "left_semi").select("document_id", "block_id", "prev_id", "next_id", "section_id", "parent_block")
    hit = lambda df, to, score: df.select("document_id", "block_id", to.alias("near_id"), F.lit(score).alias("score"))
    same = w.filter("section_id is not null").join(blocks.select("document_id", "section_id", F.col("block_id").alias("other")), ["document_id", "section_id"])
    every = hit(w, F.col("prev_id"), 0.9).unionByName(hit(w, F.col("next_id"), 0.9)).unionByName(hit(same, F.col("other"), 0.7)).unionByName(hit(w, F.col("parent_block"), 0.6))
    one = every.filter("near_id is not null and near_id <> block_id").groupBy("document_id", "block_id", "near_id").agg(F.max("score").alias("score"))
    best = Window.partitionBy("document_id", "block_id").orderBy(F.desc("score"), "near_id")
    return one.withColumn("rank", F.row_number().over(best).cast("int")).filter(F.col("rank") <= k)
