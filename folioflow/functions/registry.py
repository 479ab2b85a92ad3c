"""The functions as SQL functions of a session."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType

from folioflow.functions.arithmetic import evaluate
from folioflow.operators.nested import read_payload


@F.pandas_udf(DoubleType())
def _evaluate(texts: pd.Series) -> pd.Series:
    return texts.map(evaluate).astype("float64")


@F.pandas_udf(BooleanType())
def _readable(payloads: pd.Series) -> pd.Series:
    return payloads.map(lambda p: read_payload(p) is not None)


SQL_FUNCTIONS = {
    "ff_tokens": "(t STRING) RETURNS ARRAY<STRING> RETURN regexp_extract_all(lower(coalesce(t, '')), '([a-z0-9]+)')",
    "ff_text_key": r"(t STRING) RETURNS STRING RETURN substring(regexp_replace(lower(trim(coalesce(t, ''))), '\\s+', ' '), 1, 200)",
    "ff_short_hash": "(t STRING) RETURNS STRING RETURN substring(sha2(coalesce(t, ''), 256), 1, 24)",
    "ff_iou": "(ax0 DOUBLE, ay0 DOUBLE, ax1 DOUBLE, ay1 DOUBLE, bx0 DOUBLE, by0 DOUBLE, bx1 DOUBLE, by1 DOUBLE) RETURNS DOUBLE RETURN greatest(0D, least(ax1, bx1) - greatest(ax0, bx0)) * greatest(0D, least(ay1, by1) - greatest(ay0, by0)) / nullif((ax1 - ax0) * (ay1 - ay0) + (bx1 - bx0) * (by1 - by0) - greatest(0D, least(ax1, bx1) - greatest(ax0, bx0)) * greatest(0D, least(ay1, by1) - greatest(ay0, by0)), 0D)",
}


def register(spark: SparkSession) -> list[str]:
    """Register all functions for SQL; returns their names."""
    for name, body in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name} {body}")
    spark.udf.register("ff_evaluate", _evaluate)
    spark.udf.register("ff_readable", _readable)
    return [*SQL_FUNCTIONS, "ff_evaluate", "ff_readable"]


__all__ = ["SQL_FUNCTIONS", "register"]
