"""Results of extractions kept by content: valid ones to be used again, failures apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY = ["page_sha", "model", "prompt_version"]


def is_valid() -> Column:
    """Whether an extraction may be served: ok, not cut off, with blocks."""
    return (F.col("status") == "ok") & ~F.coalesce("truncated", F.lit(False)) & (F.coalesce("n_blocks", F.lit(0)) > 0)


def failure_reason() -> Column:
    """Why an extraction is no valid one."""
    return F.when(F.col("status") != "ok", F.coalesce("failure_reason", F.lit("failed"))).when(F.coalesce("truncated", F.lit(False)), "truncated").otherwise("empty")


def split(extractions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid extractions, and failures with their reason; a failure is never stored as a result."""
    valid = F.coalesce(is_valid(), F.lit(False))
    return extractions.filter(valid), extractions.filter(~valid).withColumn("failure_reason", failure_reason())


def put(extractions: DataFrame, folder: str) -> None:
    """Store results and failures, partitioned by model."""
    good, bad = split(extractions)
    good.write.mode("append").partitionBy("model").parquet(f"{folder}/valid")
    bad.write.mode("append").partitionBy("model").parquet(f"{folder}/failures")


def lookup(wanted: DataFrame, stored: DataFrame) -> DataFrame:
    """wanted(page_sha, model, prompt_version) with what is stored for it and from_cache; only valid results are served."""
    one = stored.filter(F.coalesce(is_valid(), F.lit(False))).dropDuplicates(KEY)
    return wanted.join(one, KEY, "left").withColumn("from_cache", F.col("status").isNotNull())


def purge(stored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What stays and what goes of a store that was filled before failures were kept apart."""
    return split(stored)


def hit_rate(looked_up: DataFrame) -> DataFrame:
    """Hits, misses and rate in percent."""
    n, hits = F.count(F.lit(1)), F.count_if("from_cache")
    return looked_up.agg(hits.alias("hits"), (n - hits).alias("misses"), F.when(n > 0, 100.0 * hits / n).otherwise(0.0).alias("hit_rate_pct"))
