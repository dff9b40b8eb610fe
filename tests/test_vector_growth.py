"""implied_growth over many rows, and over rows that its comparisons treat specially."""

import time

from pyspark.sql import functions as F

from ledgerlark.operators import metrics as D


def growth(df):
    return df.select("*", D.implied_growth(F.col("ev"), F.col("fcf"), F.col("r"), F.col("m")).alias("g"))


def test_many_rows_in_one_task_take_seconds(spark):
    """200,000 rows took some 20 seconds when each ran its hundred rounds as a lambda."""
    k = F.col("id")
    rows = spark.range(0, 200_000, 1, 1).select((k % 997 + 36).cast("double").alias("ev"), (k % 31 + 1).cast("double").alias("fcf"), F.lit(0.1).alias("r"), F.lit(15.0).alias("m"))
    growth(rows.limit(10)).collect()
    began = time.perf_counter()
    got = growth(rows).agg(F.count("g").alias("n"), F.min("g").alias("low"), F.max("g").alias("high")).first()
    assert time.perf_counter() - began < 10
    assert got.n == 200_000 and got.low >= -0.5 and got.high <= 2


def test_odd_numbers(spark):
    """Unknown and non-positive inputs give null; a root outside the interval gives its end; not-a-number is the largest number."""
    nan, inf = float("nan"), float("inf")
    cases = [(None, 1.0, None), (1.0, None, None), (0.0, 1.0, None), (1.0, -1.0, None), (1e9, 1.0, 2.0), (1e-9, 1.0, -0.5), (inf, 1.0, 2.0), (nan, 1.0, 2.0), (nan, nan, -0.5), (1.0, inf, -0.5)]
    df = spark.createDataFrame(cases, "ev double, fcf double, want double").withColumns({"r": F.lit(0.1), "m": F.lit(15.0)})
    assert [(x.g, x.want) for x in growth(df).collect() if x.g != x.want] == []
