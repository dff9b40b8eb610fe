"""The vote log as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_log(spark: SparkSession, path: str, schema, files_per_trigger: int = 4) -> DataFrame:
    """An append-only folder of Parquet files."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def first_sightings(stream: DataFrame, key: str, at: str, late: str) -> DataFrame:
    """Each key once, within the lateness allowed."""
    return stream.withWatermark(at, late).dropDuplicatesWithinWatermark([key])


def latest(stream: DataFrame, keys: list[str], value: str, order: list[str]) -> DataFrame:
    """The last value by time, then by log order; update mode."""
    return stream.groupBy(*keys).agg(F.max_by(F.struct(value, *order), F.struct(*order)).alias("l")).select(*keys, "l.*")


def totals(stream: DataFrame, keys: list[str], measures) -> DataFrame:
    """R2: the running roll-up; complete mode."""
    return stream.groupBy(*keys).agg(*measures)


def windows(stream: DataFrame, at: str, keys: list[str], length: str, slide: str | None, late: str, measures) -> DataFrame:
    """Tumbling or sliding windows with late data dropped; append mode."""
    w = F.window(at, length, slide) if slide else F.window(at, length)
    return stream.withWatermark(at, late).groupBy(w, *keys).agg(*measures)


def sessions(stream: DataFrame, at: str, keys: list[str], gap: str, late: str, measures) -> DataFrame:
    return stream.withWatermark(at, late).groupBy(F.session_window(at, gap), *keys).agg(*measures)


def run_once(stream: DataFrame, mode: str, out: str, checkpoint: str) -> DataFrame:
    """All that is there now, through foreachBatch into a Parquet folder; complete and update modes keep the last state of each batch."""
    spark = stream.sparkSession

    def write(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/epoch={epoch}")

    q = stream.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.parquet(out)
