"""Comparing with gold: token coverage, greedy matches, rates and a registry of metrics."""

from __future__ import annotations

import re
from array import array
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioflow.functions import text as T

MATCH, COMPLETE, BOX_MATCH = 0.35, 0.90, 0.5


def token_coverage(gold: Column, got: Column) -> Column:
    """Share of the gold text's tokens that the other text has, as often as it has them; 1 for no tokens."""
    counts = lambda c: F.transform(F.array_distinct(T.all_tokens(c)), lambda t: F.struct(t.alias("t"), F.size(F.filter(T.all_tokens(c), lambda x: x == t)).alias("n")))
    have = F.map_from_entries(counts(got))
    found = F.aggregate(counts(gold), F.lit(0), lambda acc, g: acc + F.least(g["n"], F.coalesce(F.element_at(have, g["t"]), F.lit(0))))
    size = F.size(T.all_tokens(gold))
    return F.when(size == 0, F.lit(1.0)).otherwise(found / size)


def source_coverage(questions: DataFrame, blocks: DataFrame) -> DataFrame:
    """How much of each question's text its source block holds."""
    one = questions.filter("document_id is not null and question_id is not null").dropDuplicates(["document_id", "question_id"])
    first = F.lower(F.trim(F.get(F.filter("source_blocks", lambda x: F.trim(x) != ""), F.lit(0))))
    pairs = one.select("document_id", "question_id", "question_text", first.alias("block_id")).join(blocks.select("document_id", "block_id", "text"), ["document_id", "block_id"])
    return pairs.select("document_id", "question_id", "block_id", token_coverage(F.col("question_text"), F.col("text")).alias("coverage"))


_MATCHED = "gold_id string, got_id string, score double"
_ARROW = pa.schema([("gold_id", pa.string()), ("got_id", pa.string()), ("score", pa.float64())])


def _greedy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = sorted((r for b in batches for r in zip(b.column("gold_ix").to_pylist(), (-x for x in b.column("score").to_pylist()), b.column("got_id").to_pylist(), b.column("gold_id").to_pylist())), key=lambda r: r)
    used: set[str] = set()
    done: set[str] = set()
    out = []
    for _, score, got, gold in rows:
        if gold not in done and got not in used:
            used.add(got)
            done.add(gold)
            out.append((gold, got, -score))
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _ARROW)], schema=_ARROW)


def greedy_in_documents(pairs: DataFrame, least: float) -> DataFrame:
    """greedy_matches() inside each document, with the document."""
    named = pairs.withColumns({c: F.concat_ws("\x01", "document_id", c) for c in ("gold_id", "got_id")})
    found = greedy_matches(named, ["document_id"], least)
    part = lambda c, i: F.split(c, "\x01")[i]
    return found.select(part("gold_id", 0).alias("document_id"), part("gold_id", 1).alias("gold_id"), part("got_id", 1).alias("got_id"), "score")


def greedy_matches(pairs: DataFrame, keys: list[str], least: float) -> DataFrame:
    """One-to-one matches of pairs(keys, gold_ix, gold_id, got_id, score): golds in order take the best unclaimed one.

    Greedy choice depends on order, so it runs as a Python fold; the keys must
    bound a group (a page, a section), and only scored pairs reach it.
    """
    return pairs.filter(F.col("score") >= least).groupBy(*keys).applyInArrow(_greedy, _MATCHED)


def box_matches(gold: DataFrame, got: DataFrame, least: float = BOX_MATCH) -> DataFrame:
    """Matches of gold and found boxes of a page by intersection over union; both have document_id, page_index, box_id, kind and corners."""
    from folioflow.functions import geometry

    side = lambda df, p: df.select("document_id", "page_index", *(F.col(c).alias(f"{p}{c}") for c in ("box_id", "kind", "x0", "y0", "x1", "y1")))
    pairs = side(gold, "a_").join(side(got, "b_"), ["document_id", "page_index"]).withColumn("score", geometry.iou("a_", "b_"))
    pairs = pairs.select("document_id", "page_index", F.col("a_box_id").alias("gold_ix"), F.col("a_box_id").alias("gold_id"), F.col("b_box_id").alias("got_id"), "score")
    return greedy_matches(pairs, ["document_id", "page_index"], least)


_TOKEN = re.compile("[a-z0-9]+")


def _occurrences(body: str) -> list[tuple[str, int]]:
    """The tokens of a text, each with how often it came before."""
    seen: Counter[str] = Counter()
    out = []
    for token in _TOKEN.findall(body):
        out.append((token, seen[token]))
        seen[token] += 1
    return out


def _golds_and_gots(batches: Iterator[pa.RecordBatch]) -> tuple[list[tuple[str, list]], list[str], dict]:
    """Golds (place, id, token occurrences) in order, ids of the found ones in order, and which of these have an occurrence."""
    golds, gots = [], []
    for b in batches:
        for ix, key, body in zip(*(b.column(c).to_pylist() for c in ("ix", "id", "body"))):
            if ix is None:
                gots.append((key, body))
            else:
                golds.append((ix, key, _occurrences(body)))
    golds.sort(key=lambda g: g[:2])
    gots.sort()
    places: dict = {o: array("i") for g in golds for o in g[2]}
    for at, (_, body) in enumerate(gots):
        for o in _occurrences(body):
            if o in places:
                places[o].append(at)
    return golds, [key for key, _ in gots], {o: np.frombuffer(a, np.int32) for o, a in places.items() if a}


def _shared(own: list, places: dict, n: int) -> np.ndarray | None:
    """How many occurrences each found text has in common with a gold one: the sum of the lesser counts of its tokens."""
    hits = [places[o] for o in own if o in places]
    return np.bincount(np.concatenate(hits), minlength=n) if hits else None


def _match(least: float):
    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        golds, gots, places = _golds_and_gots(batches)
        free = np.ones(len(gots), bool)
        out = []
        for _, gold, own in golds:
            shared = _shared(own, places, len(gots))
            if shared is None:
                continue
            shared *= free
            best = int(shared.argmax())  # the first of equals, as the ids are in order
            score = int(shared[best]) / len(own)
            if score >= least:
                free[best] = False
                out.append((key[0].as_py(), gold, gots[best], score))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _MATCHES_ARROW)], schema=_MATCHES_ARROW)

    return run


_MATCHES = "document_id string, gold_id string, got_id string, score double"
_MATCHES_ARROW = pa.schema([("document_id", pa.string()), ("gold_id", pa.string()), ("got_id", pa.string()), ("score", pa.float64())])


def _gold_side(gold: DataFrame, chunk: Column) -> DataFrame:
    known = gold.filter("document_id is not null and gold_id is not null and gold_ix is not null")
    return known.select("document_id", chunk.cast("bigint").alias("chunk"), F.col("gold_ix").alias("ix"), F.col("gold_id").alias("id"), F.lower(T.text_of("gold_text")).alias("body"))


def _got_side(got: DataFrame, chunk: Column) -> DataFrame:
    known = got.filter("document_id is not null and got_id is not null")
    return known.select("document_id", chunk.cast("bigint").alias("chunk"), F.lit(None).cast("string").alias("ix"), F.col("got_id").alias("id"), F.lower(T.text_of("got_text")).alias("body"))


def question_matches(gold: DataFrame, got: DataFrame, least: float = MATCH) -> DataFrame:
    """document_id, gold_id, got_id and score: what greedy_in_documents() makes of question_pairs().

    Each gold is scored when its turn comes, so a document's questions are held and
    not their pairs, of which there are as many as their product.
    """
    one = F.lit(0)
    return _gold_side(gold, one).unionByName(_got_side(got, one)).groupBy("document_id").applyInArrow(_match(least), _MATCHES)


_PAIRS = "document_id string, gold_ix string, gold_id string, got_id string, score double"
_PAIRS_ARROW = pa.schema([(c.split()[0], pa.float64() if c.endswith("double") else pa.string()) for c in _PAIRS.split(", ")])
#: golds of a document that one group compares with all found questions; the result is given in batches of so many rows
PAIR_GOLDS, PAIR_ROWS = 500, 50_000


def _score(least: float):
    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        golds, gots, places = _golds_and_gots(batches)
        names = pa.array(gots, pa.string())
        held: list[tuple] = []
        rows = 0

        def batch() -> pa.RecordBatch:
            of = np.repeat(np.arange(len(held)), [len(h[2]) for h in held])
            told = [pa.array([h[i] for h in held], pa.string()).take(pa.array(of)) for i in (0, 1)]
            at, score = (np.concatenate([h[i] for h in held]) for i in (2, 3))
            return pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(key[0].as_py(), pa.string()), len(of)), *told, names.take(pa.array(at)), pa.array(score)], schema=_PAIRS_ARROW)

        for ix, gold, own in golds:
            shared = _shared(own, places, len(gots))
            if shared is None:
                continue
            score = shared / len(own)
            at = np.flatnonzero(score >= least)
            if len(at):
                held.append((ix, gold, at, score[at]))
                rows += len(at)
            if rows >= PAIR_ROWS:
                yield batch()
                held, rows = [], 0
        if rows:
            yield batch()

    return run


def question_pairs(gold: DataFrame, got: DataFrame, least: float = MATCH) -> DataFrame:
    """Pairs of a gold and a found question of one document whose texts agree enough, with the token coverage as score.

    gold(document_id, gold_ix, gold_id, gold_text), got(document_id, got_id,
    got_text); ids are unique in a document. The found questions of a document go
    to each group of about PAIR_GOLDS of its golds, which looks up the places of
    each token there; only pairs that agree enough become rows, and no pair of a
    token with its places does. Golds without tokens match nothing.
    """
    groups = gold.filter("document_id is not null").groupBy("document_id").agg(F.ceil(F.count(F.lit(1)) / PAIR_GOLDS).alias("groups"))
    golds = _gold_side(gold.join(groups, "document_id"), F.pmod(F.xxhash64("gold_id"), F.col("groups")))
    gots = _got_side(got.join(groups, "document_id").withColumn("group", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("groups") - 1))), F.col("group"))
    # the work is in what comes out of the groups, so they are not put together by the size of what goes in
    parts = int(gold.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return golds.unionByName(gots).repartition(parts, "document_id", "chunk").groupBy("document_id", "chunk").applyInArrow(_score(least), _PAIRS)


def gold_metrics(matches: DataFrame, gold: DataFrame, got: DataFrame) -> DataFrame:
    """Recall, completeness and accuracy of the matches in one row; rates of nothing are null, and none is averaged with another.

    gold(document_id, gold_id, gold_type, gold_marks), got(document_id, got_id, got_type, got_marks).
    """
    d = gold.join(matches, ["document_id", "gold_id"], "left").join(got, ["document_id", "got_id"], "left")
    hit = F.col("got_id").isNotNull()
    return d.agg(
        F.count(F.lit(1)).alias("n_gold"), F.count_if(hit).alias("n_matched"), F.avg(hit.cast("int")).alias("recall"), F.avg(F.when(hit, (F.col("score") >= COMPLETE).cast("int"))).alias("complete"), F.avg("score").alias("mean_completeness"),
        F.avg(F.when(hit & F.col("gold_type").isNotNull(), (F.col("gold_type") == F.col("got_type")).cast("int"))).alias("type_accuracy"), F.avg(F.when(hit & F.col("gold_marks").isNotNull(), F.coalesce(F.col("gold_marks") == F.col("got_marks"), F.lit(False)).cast("int"))).alias("marks_accuracy"),
    )


def rates(matches: DataFrame, n_gold: int, n_got: int) -> dict[str, float]:
    """Recall, precision and completeness of matches."""
    row = matches.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.avg("score"), F.lit(0.0)).alias("mean"), F.count_if(F.col("score") >= COMPLETE).alias("complete")).first()
    return {"recall": row["n"] / n_gold if n_gold else 0.0, "precision": row["n"] / n_got if n_got else 0.0, "mean_completeness": row["mean"], "complete": row["complete"] / n_gold if n_gold else 0.0}


class Registry:
    """Named metrics over a bundle of tables; one that fails is recorded and the others go on."""

    def __init__(self, metrics: dict[str, Callable[[dict[str, DataFrame]], DataFrame]] | None = None):
        self.metrics = dict(metrics or {})

    def register(self, name: str, metric: Callable[[dict[str, DataFrame]], DataFrame]) -> None:
        """Add or replace a metric."""
        self.metrics[name] = metric

    def run(self, bundle: dict[str, DataFrame]) -> dict[str, DataFrame | str]:
        """Result of each metric, or the error that kept it from one."""
        out: dict[str, DataFrame | str] = {}
        for name, metric in self.metrics.items():
            try:
                out[name] = metric(bundle)
            except Exception as error:  # a metric must not take the run with it
                out[name] = f"{type(error).__name__}: {error}"
        return out


def question_counts(questions: DataFrame) -> DataFrame:
    """Questions by source, type and whether they have marks, options and answers, in one pass."""
    one = questions.filter("document_id is not null and question_id is not null").dropDuplicates(["document_id", "question_id"])
    yes = lambda c: F.when(c, "yes").otherwise("no")
    dims = {"source_type": F.coalesce("source_type", F.lit("none")), "question_type": F.coalesce("question_type", F.lit("none")), "has_marks": yes(F.col("marks").isNotNull()), "has_options": yes(F.coalesce(F.size("options") > 0, F.lit(False))), "has_answer": yes(F.coalesce(F.size("answer_association.answer_block_ids") > 0, F.lit(False)))}
    x = F.explode(F.array(*(F.struct(F.lit(n).alias("dimension"), v.alias("value")) for n, v in dims.items()))).alias("x")
    return one.select(x).groupBy(F.col("x.dimension").alias("dimension"), F.col("x.value").alias("value")).agg(F.count(F.lit(1)).alias("n"))
