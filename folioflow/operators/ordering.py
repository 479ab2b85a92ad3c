"""Ordered operators over documents of any length.

A window over a whole document puts it into one task. Here rows are first put
into buckets of ``span`` consecutive positions; windows run inside a bucket, one
summary row a bucket carries what the later buckets need, and only summaries
are windowed per document. Results equal those of a plain window.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SPAN = 4096
BUCKET = "__bucket"


def prepare(df: DataFrame, order: str, span: int = SPAN) -> DataFrame:
    """df with its buckets, so that several ordered operators in a row share one partitioning; finish() drops them."""
    return df.withColumn(BUCKET, F.floor(F.col(order) / F.lit(span)).cast("bigint"))


def finish(df: DataFrame) -> DataFrame:
    """df without buckets."""
    return df.drop(BUCKET)


def _bucketed(df: DataFrame, order: str, span: int) -> tuple[DataFrame, bool]:
    return (df, True) if BUCKET in df.columns else (prepare(df, order, span), False)


def _with_summary(df: DataFrame, keys: list[str], summary: DataFrame, kept: bool) -> DataFrame:
    joined = df.join(summary, [*keys, BUCKET], "left")
    return joined if kept else finish(joined)


def carry(df: DataFrame, keys: list[str], order: str, values: dict[str, Column], current: bool = True, span: int = SPAN) -> DataFrame:
    """Add, per name, the last non-null value at or before each row (before it, if current is false)."""
    df, kept = _bucketed(df.withColumns({f"__{n}": v for n, v in values.items()}), order, span)
    inside = Window.partitionBy(*keys, BUCKET).orderBy(order).rowsBetween(Window.unboundedPreceding, 0 if current else -1)
    local = df.withColumns({f"{n}": F.last(f"__{n}", ignorenulls=True).over(inside) for n in values})
    at = F.col(order)
    summary = df.groupBy(*keys, BUCKET).agg(*(F.max_by(f"__{n}", F.when(F.col(f"__{n}").isNotNull(), at)).alias(f"__s_{n}") for n in values))
    before = Window.partitionBy(*keys).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    summary = summary.select(*keys, BUCKET, *(F.last(f"__s_{n}", ignorenulls=True).over(before).alias(f"__c_{n}") for n in values))
    out = _with_summary(local, keys, summary, kept)
    out = out.withColumns({n: F.coalesce(n, f"__c_{n}") for n in values})
    return out.drop(*(f"__{n}" for n in values), *(f"__c_{n}" for n in values))


def running(df: DataFrame, keys: list[str], order: str, values: dict[str, Column], span: int = SPAN) -> DataFrame:
    """Add, per name, the running sum of a number up to and with each row; null counts as 0."""
    df, kept = _bucketed(df.withColumns({f"__{n}": F.coalesce(v.cast("bigint"), F.lit(0)) for n, v in values.items()}), order, span)
    inside = Window.partitionBy(*keys, BUCKET).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    local = df.withColumns({n: F.sum(f"__{n}").over(inside) for n in values})
    before = Window.partitionBy(*keys).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    sums = df.groupBy(*keys, BUCKET).agg(*(F.sum(f"__{n}").alias(f"__s_{n}") for n in values))
    sums = sums.select(*keys, BUCKET, *(F.coalesce(F.sum(f"__s_{n}").over(before), F.lit(0)).alias(f"__c_{n}") for n in values))
    out = _with_summary(local, keys, sums, kept)
    return out.withColumns({n: F.col(n) + F.col(f"__c_{n}") for n in values}).drop(*(f"__{n}" for n in values), *(f"__c_{n}" for n in values))


def neighbours(df: DataFrame, keys: list[str], order: str, previous: dict[str, Column] | None = None, following: dict[str, Column] | None = None, span: int = SPAN) -> DataFrame:
    """Add values of the previous and of the following row."""
    previous, following = previous or {}, following or {}
    df, kept = _bucketed(df.withColumns({f"__{n}": v for n, v in {**previous, **following}.items()}), order, span)
    inside = Window.partitionBy(*keys, BUCKET).orderBy(order)
    local = df.withColumns({n: F.lag(F.struct(f"__{n}")).over(inside) for n in previous} | {n: F.lead(F.struct(f"__{n}")).over(inside) for n in following})
    ends = df.groupBy(*keys, BUCKET).agg(
        *(F.max_by(F.struct(f"__{n}"), order).alias(f"__e_{n}") for n in previous), *(F.min_by(F.struct(f"__{n}"), order).alias(f"__e_{n}") for n in following),
    )
    whole = Window.partitionBy(*keys).orderBy(BUCKET)
    ends = ends.select(*keys, BUCKET, *(F.lag(f"__e_{n}").over(whole).alias(f"__c_{n}") for n in previous), *(F.lead(f"__e_{n}").over(whole).alias(f"__c_{n}") for n in following))
    out = _with_summary(local, keys, ends, kept)
    names = [*previous, *following]
    return out.withColumns({n: F.coalesce(n, f"__c_{n}")[f"__{n}"] for n in names}).drop(*(f"__{n}" for n in names), *(f"__c_{n}" for n in names))


def positions(df: DataFrame, keys: list[str], part: str, order: list[str], name: str = "position") -> DataFrame:
    """Add the 0-based rank of each row in its key, ordered by (part, *order).

    Parts are ranked inside themselves and their sizes are summed up, so only one
    row a part is windowed per key.
    """
    inside = Window.partitionBy(*keys, part).orderBy(*order)
    sizes = df.groupBy(*keys, part).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*keys).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(*keys, part, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    same = reduce(lambda a, b: a & b, [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in [*keys, part]])
    ranked = df.withColumn("__rank", F.row_number().over(inside))
    joined = ranked.alias("l").join(sizes.alias("r"), same, "left").select("l.*", "r.__before")
    return joined.withColumn(name, (F.col("__before") + F.col("__rank") - 1).cast("bigint")).drop("__before", "__rank")
