"""Streaming forms: arriving pages, counters over time, bounded retries."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def arriving_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Stream of text files of a folder: path, text and hash, each content once within a day."""
    raw = spark.readStream.format("text").option("wholetext", "true").load(folder)
    rows = raw.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_modification_time").alias("at"), F.col("value").alias("text"), F.sha2("value", 256).alias("sha256"))
    return rows.withWatermark("at", "1 day").dropDuplicatesWithinWatermark(["sha256"])


def counts_by_time(events: DataFrame, time: str, kind: str, window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Events per tumbling window and kind; later ones than the watermark are left out of a stream."""
    e = events.withWatermark(time, late) if events.isStreaming else events
    counted = e.groupBy(F.window(time, window).alias("w"), kind).agg(F.count(F.lit(1)).alias("n_events"), F.sum("value").alias("total"))
    return counted.select(F.col("w.start").alias("window_start"), kind, "n_events", "total")


def sessions(events: DataFrame, time: str, key: str, gap: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    """Sessions of a key: runs of events with no gap as long as the given one."""
    e = events.withWatermark(time, late) if events.isStreaming else events
    s = e.groupBy(F.session_window(time, gap).alias("w"), key).agg(F.count(F.lit(1)).alias("n_events"))
    return s.select(key, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n_events")


def counters(events: DataFrame, kind: str) -> DataFrame:
    """Run counters per kind."""
    return events.groupBy(kind).agg(F.count(F.lit(1)).alias("n_events"), F.sum("value").alias("total"))


def bounded_retries(attempts: DataFrame, key: str, limit: int = 2) -> DataFrame:
    """Stream of attempts(key, ok) as decisions: 'retry' until one succeeds or the limit is reached, then 'recovered' or 'gave_up', once."""

    def step(keys: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        n, done = state.get if state.exists else (0, False)
        rows = []
        for frame in frames:
            for ok in frame["ok"]:
                if done:
                    continue
                n += 1
                done = bool(ok) or n >= limit
                rows.append((keys[0], n, "recovered" if ok else "gave_up" if done else "retry"))
        state.update((n, done))
        if rows:
            yield pd.DataFrame(rows, columns=[key, "attempt", "decision"])

    kind = dict(attempts.dtypes)[key]
    return attempts.groupBy(key).applyInPandasWithState(step, f"{key} {kind}, attempt int, decision string", "n int, done boolean", "append", GroupStateTimeout.NoTimeout)


def keep_counts(events: DataFrame, time: str, kind: str, folder: str, checkpoint: str):
    """Start a query that appends closed windows of counts to a table; it resumes from its checkpoint."""
    return counts_by_time(events, time, kind).writeStream.outputMode("append").format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(folder)
