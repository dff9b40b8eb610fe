"""Sinks: replacing and appending writes, versioned roll-ups, logs and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def replace_json(df: DataFrame, path: str) -> None:
    """K1, K2: Spark's commit protocol publishes the folder as a whole."""
    df.write.mode("overwrite").json(path)


def append_log(df: DataFrame, path: str) -> None:
    """K3: new JSON lines files beside the old ones."""
    df.write.mode("append").json(path)


def versioned(df: DataFrame, path: str, run_id: str, at: Column) -> None:
    """K4: a snapshot per run, and a history row."""
    df.write.mode("overwrite").parquet(f"{path}/snapshots/run_id={run_id}")
    row = df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(run_id).alias("run_id"), "n_rows", at.alias("written_at"))
    row.write.mode("append").parquet(f"{path}/history")


def latest_entries(spark: SparkSession, path: str, n: int, order: list[Column]) -> DataFrame:
    """K6: the last n entries of an append-only log."""
    return spark.read.parquet(path).orderBy(*order).limit(n)


def changes(old: DataFrame, new: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """(keys, field, old, new) of every value that differs."""
    a = old.select(*keys, *[F.col(f).cast("string").alias(f"a_{f}") for f in fields])
    b = new.select(*keys, *[F.col(f).cast("string").alias(f"b_{f}") for f in fields])
    each = [F.when(~F.col(f"a_{f}").eqNullSafe(F.col(f"b_{f}")), F.struct(F.lit(f).alias("field"), F.col(f"a_{f}").alias("old"), F.col(f"b_{f}").alias("new"))) for f in fields]
    return a.join(b, keys).select(*keys, F.explode(F.array_compact(F.array(*each))).alias("c")).select(*keys, "c.*")


def purge_list(files: DataFrame, keep: Column) -> DataFrame:
    """K9: what a purge would delete; nothing is deleted."""
    return files.where(~F.coalesce(keep, F.lit(False))).select("path")


def rename_list(files: DataFrame, name: str, prefix: Column) -> DataFrame:
    """(path, new name) for files that lack their prefix and whose new name is free."""
    new = F.when(F.col(name).startswith(prefix), F.col(name)).otherwise(F.concat(prefix, F.lit("_"), F.col(name)))
    marked = files.withColumn("new_name", new)
    taken = files.select(F.col("folder").alias("folder"), F.col(name).alias("new_name"))
    return marked.where(F.col("new_name") != F.col(name)).join(taken, ["folder", "new_name"], "left_anti").select("path", "new_name")


def markdown_table(df: DataFrame, order: list[str]) -> DataFrame:
    """K8: one row with a Markdown table; for reports of bounded size."""
    cols = [c for c in df.columns]
    line = F.concat(F.lit("| "), F.concat_ws(" | ", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in cols]), F.lit(" |"))
    head = "| " + " | ".join(cols) + " |\n|" + "---|" * len(cols)
    rows = F.array_sort(F.collect_list(F.struct(*order, line.alias("__line"))))
    return df.agg(F.concat(F.lit(head + "\n"), F.array_join(F.transform(rows, lambda r: r["__line"]), "\n")).alias("markdown"))
