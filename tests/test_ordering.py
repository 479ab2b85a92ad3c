import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from folioflow.operators import ordering


@pytest.fixture(scope="module")
def rows(spark):
    r = random.Random(1)
    data = [(d, p, r.choice([None, None, 1, 2, 3]), r.choice([None, "a", "b"])) for d in "xyz" for p in r.sample(range(400), 90)]
    return spark.createDataFrame(data, "d string, p bigint, v int, s string").cache()


def same(a, b):
    cols = sorted(b.columns)
    assert sorted(map(str, a.select(cols).collect())) == sorted(map(str, b.select(cols).collect()))


@pytest.mark.parametrize("span", [1, 7, 10_000])
@pytest.mark.parametrize("current", [True, False])
def test_carry_like_a_window(rows, span, current):
    w = Window.partitionBy("d").orderBy("p").rowsBetween(Window.unboundedPreceding, 0 if current else -1)
    same(ordering.carry(rows, ["d"], "p", {"c": F.col("v"), "t": F.col("s")}, current, span), rows.withColumns({"c": F.last("v", True).over(w), "t": F.last("s", True).over(w)}))


@pytest.mark.parametrize("span", [1, 7, 10_000])
def test_running_like_a_window(rows, span):
    w = Window.partitionBy("d").orderBy("p")
    same(ordering.running(rows, ["d"], "p", {"c": F.col("v"), "n": F.lit(1)}, span), rows.withColumns({"c": F.sum(F.coalesce("v", F.lit(0)).cast("bigint")).over(w), "n": F.count(F.lit(1)).over(w)}))


@pytest.mark.parametrize("span", [1, 7, 10_000])
def test_neighbours_like_a_window(rows, span):
    w = Window.partitionBy("d").orderBy("p")
    same(ordering.neighbours(rows, ["d"], "p", {"b": F.col("v")}, {"a": F.col("s")}, span), rows.withColumns({"b": F.lag("v").over(w), "a": F.lead("s").over(w)}))


def test_positions_like_a_window(rows):
    df = rows.withColumn("g", (F.col("p") / 10).cast("int"))
    w = Window.partitionBy("d").orderBy("g", "p")
    same(ordering.positions(df, ["d"], "g", ["p"]), df.withColumn("position", (F.row_number().over(w) - 1).cast("bigint")))


def test_empty(rows):
    none = rows.limit(0)
    assert ordering.carry(none, ["d"], "p", {"c": F.col("v")}).count() == ordering.neighbours(none, ["d"], "p", {"b": F.col("v")}).count() == 0


@pytest.mark.parametrize("span", [1, 7, 10_000])
def test_several_in_a_row_share_buckets(rows, span):
    w = Window.partitionBy("d").orderBy("p")
    df = ordering.prepare(rows, "p", span)
    df = ordering.running(df, ["d"], "p", {"n": F.lit(1)})
    df = ordering.carry(df, ["d"], "p", {"c": F.col("v")})
    df = ordering.finish(ordering.neighbours(df, ["d"], "p", {"b": F.col("n")}))
    same(df, rows.withColumns({"n": F.count(F.lit(1)).over(w), "c": F.last("v", True).over(w)}).withColumn("b", F.lag("n").over(w)))
