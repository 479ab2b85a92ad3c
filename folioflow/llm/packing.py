"""Filling fixed-capacity containers with items.

Method: vector best fit. A container has capacities for tokens, for documents
and for attention cost (the sum of squared lengths, as attention inside each
document costs). Items come in falling order of length; of all open containers
that still take an item under every capacity, the one whose weighted residual
vector would be shortest is chosen. Residuals are shares of their capacities;
the weight of a capacity is the number of containers that all items need at
least by it, so what is scarce counts more. The open containers are held in the
order of their token residuals, and the norms of all that have the room are
computed for each item.

Capacities for documents and attention come with the budgets (columns
``capacity_docs`` and ``capacity_attention``) or as parameters; without them
only tokens and ``TOKENS_A_DOC`` bind. An item whose cost alone is above the
attention capacity has its container to itself, as it can't be cut.

Texts are tokenised where they are read; only (doc_id, tokens) is moved. They
are dealt by hash into groups of about ``GROUP_DOCS`` documents, so no task
grows with the corpus; the unused room of a group's last containers is spread
over tens of thousands of documents. Texts above the capacity, and only these,
are cut: full pieces are containers by themselves, the remainder is packed.

Defined results for odd input: null texts and rows with a null id get no
container; blank texts are items of their own few tokens, empty ones of none;
if a doc_id comes several times, its longest text counts, once; budgets that
are null, repeated or below one token are ignored; extra columns are not
looked at; empty tables give an empty result.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.session import stage

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: how the tokenizer's vocabulary splits texts (fixed value)
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
GROUP_DOCS = 100_000
#: without a capacity for documents a container takes at most one for so many tokens of capacity
TOKENS_A_DOC = 8


def load_tokenizer(path: str):
    """The tokenizer whose ranks are in a file."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("packing", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def shipped(spark: SparkSession, path: str) -> str:
    """Send a file of the driver to all executors; its name there."""
    if os.path.exists(path):
        spark.sparkContext.addFile(path)
    return os.path.basename(path)


def _on_executor(name: str, path: str) -> str:
    """Where an executor has a shipped file; the given path where it has none."""
    try:
        there = SparkFiles.get(name)
    except Exception:  # no file was shipped to this worker
        return path
    return there if os.path.exists(there) else path


def _count(name: str, path: str):
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = load_tokenizer(_on_executor(name, path)).encode_ordinary
        for batch in batches:
            counts = [len(encode(t)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(counts, pa.int64())], schema=schema)

    return run


def token_counts(documents: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """doc_id and n_tokens of every text."""
    docs = documents.filter("doc_id is not null and text is not null").select(F.col("doc_id").cast("bigint"), "text")
    return docs.mapInArrow(_count(shipped(documents.sparkSession, tokenizer), tokenizer), "doc_id bigint, n_tokens bigint")


class Containers:
    """Open containers of one vector of capacities; weights are those of the tokens', attention's and documents' residuals."""

    def __init__(self, capacity: int, max_docs: int | None = None, max_cost: int | None = None, weights: tuple[float, float, float] = (1.0, 1.0, 1.0)):
        self.capacity = capacity
        self.max_docs = max(1, capacity // TOKENS_A_DOC) if max_docs is None else max(1, max_docs)
        self.max_cost = min(capacity * capacity if max_cost is None else max_cost, 2**62)  # as a 64-bit number
        self.weights = weights
        self.tokens: list[int] = []
        self.docs: list[int] = []
        self.cost: list[int] = []
        self.held: list[list[tuple[int, int, int]]] = []
        #: of the open containers in order of their token residuals: residuals of tokens, attention and documents, and the container
        self.open = np.zeros((4, 64), np.int64)
        self.n_open = 0

    def norm(self, tokens, cost, docs):
        """The weighted norm, squared, of a residual vector whose parts are shares of their capacities."""
        a, b, c = tokens / self.capacity, cost / max(1, self.max_cost), docs / self.max_docs
        return self.weights[0] * (a * a) + self.weights[1] * (b * b) + self.weights[2] * (c * c)

    def residual(self, bin_: int, size: int) -> float:
        """The weighted norm of what a container would have left with an item."""
        return self.norm(self.capacity - self.tokens[bin_] - size, self.max_cost - self.cost[bin_] - size * size, self.max_docs - self.docs[bin_] - 1)

    def _best(self, size: int) -> int | None:
        """Where the chosen one stands among the open containers."""
        first = int(self.open[0, : self.n_open].searchsorted(size))
        tokens, cost, docs = self.open[:3, first : self.n_open]
        if not len(tokens):
            return None
        norms = self.norm(tokens - size, cost - size * size, docs - 1)
        norms[cost < size * size] = np.inf
        at = int(norms.argmin())
        return first + at if norms[at] < np.inf else None

    def choose(self, size: int) -> int | None:
        """The container with the shortest weighted residual vector of all that take the item; of equals the one with the least token residual."""
        at = self._best(size)
        return None if at is None else int(self.open[3, at])

    def add(self, item: tuple[int, int, int]) -> None:
        """Put (doc_id, piece, tokens) into a container."""
        size = item[2]
        at = self._best(size)
        if at is None:
            bin_ = len(self.tokens)
            self.tokens.append(0)
            self.docs.append(0)
            self.cost.append(0)
            self.held.append([])
        else:
            bin_ = int(self.open[3, at])
            self.open[:, at : self.n_open - 1] = self.open[:, at + 1 : self.n_open]
            self.n_open -= 1
        self.tokens[bin_] += size
        self.docs[bin_] += 1
        self.cost[bin_] += size * size
        self.held[bin_].append(item)
        room = self.capacity - self.tokens[bin_]
        if room and self.docs[bin_] < self.max_docs and self.cost[bin_] <= self.max_cost:
            if self.n_open == self.open.shape[1]:
                self.open = np.concatenate([self.open, np.zeros_like(self.open)], axis=1)
            at = int(self.open[0, : self.n_open].searchsorted(room, "right"))
            self.open[:, at + 1 : self.n_open + 1] = self.open[:, at : self.n_open]
            self.open[:, at] = room, self.max_cost - self.cost[bin_], self.max_docs - self.docs[bin_], bin_
            self.n_open += 1


def demand(items: list[tuple[int, int, int]], capacity: int, max_docs: int, max_cost: int) -> tuple[float, float, float]:
    """Containers that the items need at least by each capacity, as shares of their sum: what is scarce weighs more."""
    need = sum(i[2] for i in items) / capacity, sum(i[2] * i[2] for i in items) / max(1, max_cost), len(items) / max_docs
    return tuple(x / (sum(need) or 1) for x in need)


def pack(items: list[tuple[int, int, int]], capacity: int, max_docs: int | None = None, max_cost: int | None = None) -> list[list[tuple[int, int, int]]]:
    """Containers of (doc_id, piece, tokens) items that are not above the capacity."""
    packed = Containers(capacity, max_docs, max_cost)
    packed.weights = demand(items, capacity, packed.max_docs, packed.max_cost)
    for item in sorted(items, key=lambda i: (-i[2], i[0], i[1])):
        packed.add(item)
    return packed.held


_PACKED = "budget_id int, doc_id bigint, piece int, container bigint, start_token bigint, n_tokens bigint"
_ARROW = pa.schema([("budget_id", pa.int32()), ("doc_id", pa.int64()), ("piece", pa.int32()), ("container", pa.int64()), ("start_token", pa.int64()), ("n_tokens", pa.int64())])


def _pack_group(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    budget, capacity, max_docs, max_cost, group, groups = (k.as_py() for k in key)
    rows: list[tuple] = []
    number = group  # container numbers of a group are group, group + groups, ...

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW)

    items: list[tuple[int, int, int]] = []
    for batch in batches:
        for doc, n in zip(batch.column("doc_id").to_pylist(), batch.column("n_tokens").to_pylist()):
            whole, left = divmod(n, capacity)
            for piece in range(whole):
                rows.append((budget, doc, piece, number, piece * capacity, capacity))
                number += groups
                if len(rows) >= 50_000:
                    yield batch_of(rows)
                    rows = []
            if left or not whole:
                items.append((doc, whole, left))
    for held in pack(items, capacity, max_docs, max_cost):
        rows += [(budget, doc, piece, number, piece * capacity, size) for doc, piece, size in held]
        number += groups
        if len(rows) >= 50_000:
            yield batch_of(rows)
            rows = []
    if rows:
        yield batch_of(rows)


def capacities(budgets: DataFrame, max_docs: int | None = None, attention_share: float | None = None) -> DataFrame:
    """budget_id and its capacities of tokens, documents and attention; null where nothing but tokens binds.

    attention_share is the share of the cost of one document of capacity_tokens.
    """
    tokens = F.max("capacity_tokens").cast("bigint")
    docs = F.max("capacity_docs") if "capacity_docs" in budgets.columns else F.lit(max_docs)
    cost = F.max("capacity_attention") if "capacity_attention" in budgets.columns else tokens * tokens * F.lit(attention_share)
    return budgets.filter("budget_id is not null and capacity_tokens > 0").groupBy(F.col("budget_id").cast("int").alias("budget_id")).agg(
        tokens.alias("capacity_tokens"), docs.cast("bigint").alias("capacity_docs"), cost.cast("bigint").alias("capacity_attention"),
    )


def packed(documents: DataFrame, budgets: DataFrame, tokenizer: str = TOKENIZER, max_docs: int | None = None, attention_share: float | None = None) -> DataFrame:
    """budget_id, doc_id, piece (from 0), container, start_token and n_tokens: every text in a container of every budget."""
    counts = stage(token_counts(documents, tokenizer).groupBy("doc_id").agg(F.max("n_tokens").alias("n_tokens")), "tokens")
    groups = max(1, -(-counts.count() // GROUP_DOCS))
    dealt = counts.withColumn("deal", F.pmod(F.xxhash64("doc_id"), F.lit(groups)).cast("bigint")).withColumn("deals", F.lit(groups).cast("bigint"))
    vector = ("capacity_tokens", "capacity_docs", "capacity_attention")
    each = [F.struct(F.lit(r.budget_id).cast("int").alias("budget_id"), *(F.lit(r[c]).cast("bigint").alias(c) for c in vector)) for r in capacities(budgets, max_docs, attention_share).orderBy("budget_id").collect()]
    if not each:
        return counts.limit(0).select(*(F.lit(None).cast(kind).alias(name) for name, kind in (f.split() for f in _PACKED.split(", "))))
    key = ("budget_id", *vector, "deal", "deals")
    return dealt.withColumn("b", F.explode(F.array(*each))).select("b.budget_id", *(f"b.{c}" for c in vector), "deal", "deals", "doc_id", "n_tokens").groupBy(*key).applyInArrow(_pack_group, _PACKED)


def containers(placed: DataFrame) -> DataFrame:
    """Tokens, documents and attention cost of each container."""
    return placed.groupBy("budget_id", "container").agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("docs"), F.sum(F.col("n_tokens") * F.col("n_tokens")).alias("attention"))


def fill_report(placed: DataFrame, budgets: DataFrame, max_docs: int | None = None, attention_share: float | None = None) -> DataFrame:
    """Per budget: containers, and the unused share of each of their capacities (null where it has none)."""
    used = containers(placed).groupBy("budget_id").agg(F.count(F.lit(1)).alias("n_containers"), F.sum("tokens").alias("n_tokens"), F.sum("docs").alias("n_pieces"), F.sum("attention").alias("attention"))
    share = lambda c, whole: 1 - F.col(c) / (F.col("n_containers") * F.col(whole))
    return used.join(capacities(budgets, max_docs, attention_share), "budget_id").select(
        "budget_id", "capacity_tokens", "n_containers", "n_pieces", "n_tokens", share("n_tokens", "capacity_tokens").alias("unused_share"),
        share("n_pieces", "capacity_docs").alias("unused_docs"), share("attention", "capacity_attention").alias("unused_attention"),
    )


def validity(placed: DataFrame, budgets: DataFrame, max_docs: int | None = None, attention_share: float | None = None) -> DataFrame:
    """Per budget: texts placed, pieces placed twice, texts cut though they fit or not cut in full pieces, containers above each capacity."""
    sizes = capacities(budgets, max_docs, attention_share)
    over = containers(placed).join(sizes, "budget_id").groupBy("budget_id").agg(
        F.count_if(F.col("tokens") > F.col("capacity_tokens")).alias("n_over_tokens"), F.count_if(F.col("docs") > F.col("capacity_docs")).alias("n_over_docs"),
        F.count_if((F.col("attention") > F.col("capacity_attention")) & (F.col("docs") > 1)).alias("n_over_attention"),
    )
    per_doc = placed.groupBy("budget_id", "doc_id").agg(F.count(F.lit(1)).alias("pieces"), F.countDistinct("piece").alias("distinct"), F.sum("n_tokens").alias("tokens"), F.max("piece").alias("last")).join(sizes, "budget_id")
    needed = F.greatest(F.lit(1), F.ceil(F.col("tokens") / F.col("capacity_tokens")))
    docs = per_doc.groupBy("budget_id").agg(F.count(F.lit(1)).alias("n_texts"), F.sum(F.col("pieces") - F.col("distinct")).alias("n_twice"), F.count_if((F.col("pieces") != needed) | (F.col("last") != needed - 1)).alias("n_badly_cut"))
    return docs.join(over, "budget_id")
