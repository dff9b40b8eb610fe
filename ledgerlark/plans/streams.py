"""Streaming queries: the events table replayed as a log, each held against batch SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numbers import micro
from ..sources.shared import shared_folder
from ..streaming import votes as V
from .registry import query, read


def _log(spark, sf):
    """The events in four files by time, as a stream, and a folder for its output."""
    top = shared_folder(spark, "stream")
    e = read(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    e.repartitionByRange(4, "ts").write.parquet(f"{top}/log")
    return V.read_log(spark, f"{top}/log", e.schema), top


_SUM = "CAST(sum(CAST(floor(value * 1000000 + 0.5) AS BIGINT)) AS BIGINT) AS total"


def _measures():
    return [F.count(F.lit(1)).alias("n"), F.sum(micro(F.col("value"))).alias("total")]


@query("stream_votes", f"SELECT event_type, count(*) AS n, {_SUM} FROM events GROUP BY event_type")
def stream_votes(spark, sf):
    s, top = _log(spark, sf)
    out = V.run_once(V.totals(s, ["event_type"], _measures()), "complete", f"{top}/out", f"{top}/check")
    last = out.agg(F.max("epoch").alias("epoch"))
    return out.join(F.broadcast(last), "epoch").drop("epoch")


@query("stream_latest", "SELECT user_id, event_type, arg_max(value, (ts, event_id)) AS value, arg_max(event_id, (ts, event_id)) AS event_id FROM events GROUP BY ALL")
def stream_latest(spark, sf):
    s, top = _log(spark, sf)
    out = V.run_once(V.latest(s, ["user_id", "event_type"], "value", ["ts", "event_id"]), "update", f"{top}/out", f"{top}/check")
    return out.groupBy("user_id", "event_type").agg(F.max_by(F.struct("value", "event_id"), F.struct("ts", "event_id")).alias("l")).select("user_id", "event_type", "l.value", "l.event_id")


@query("stream_windows", f"SELECT CAST(CAST(date_trunc('day', ts) AS DATE) AS VARCHAR) AS day, event_type, count(*) AS n, {_SUM} FROM events WHERE date_trunc('day', ts) < (SELECT date_trunc('day', max(ts)) FROM events) GROUP BY ALL")
def stream_windows(spark, sf):
    """Windows that have closed by the end of the log: all but those of its last day."""
    s, top = _log(spark, sf)
    out = V.run_once(V.windows(s, "ts", ["event_type"], "1 day", None, "0 seconds", _measures()), "append", f"{top}/out", f"{top}/check")
    last = read(spark, sf, "events").agg(F.date_trunc("day", F.max("ts").cast("timestamp")).alias("last"))
    out = out.join(F.broadcast(last), F.col("window.start") < F.col("last"))
    return out.select(F.to_date("window.start").cast("string").alias("day"), "event_type", "n", "total")


@query("stream_distinct", "SELECT event_type, count(DISTINCT event_id) AS n FROM events GROUP BY event_type")
def stream_distinct(spark, sf):
    s, top = _log(spark, sf)
    out = V.run_once(V.first_sightings(s, "event_id", "ts", "60 days"), "append", f"{top}/out", f"{top}/check")
    return out.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
