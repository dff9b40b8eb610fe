"""Schema-explicit readers of JSON, JSONL, CSV, HTML and file listings."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CASE_STATE = (
    "version_esquema STRING, caso_id STRING, ticker STRING, bolsa STRING, fecha_caso STRING, estado_pipeline STRING, decision STRING, score STRING, confianza STRING, "
    "next_step STRING, proxima_revision STRING, pipeline MAP<STRING, STRUCT<estado: STRING, artefacto: STRING, artefacto_previo: STRING>>, "
    "sub_steps MAP<STRING, STRUCT<status: STRING, timestamp: STRING, model: STRING, model_profile: STRING, error: STRING>>"
)
VOTE_EVENT = (
    "version_esquema STRING, event_id STRING, timestamp_utc STRING, caso_id STRING, ticker STRING, fecha_caso STRING, step_name STRING, operation STRING, score_raw_0_100 STRING, "
    "vote_file STRING, rules_failed ARRAY<STRING>, config_hash STRING, model STRING, backend STRING, canonical_step_name STRING, subject_kind STRING, vote_group_id STRING"
)


def any_texts(spark: SparkSession, glob: str) -> DataFrame:
    """(file, value) of all files that a pattern names, also those that start with an underscore, which Spark's sources skip.

    The names are listed once on the driver; the files are read by the executors.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(glob)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []
    names = [(f.getPath().toUri().toString(),) for f in found if f.isFile()]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column("file").to_pylist():
                fs, at = pafs.FileSystem.from_uri(name)
                with fs.open_input_stream(at) as f:
                    yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([f.read().decode("utf-8", "replace")])], names=["file", "value"])

    return spark.createDataFrame(names, "file string").repartition(max(1, len(names) // 64)).mapInArrow(read, "file string, value string")


def json_documents(spark: SparkSession, path: str, schema: str, keep_broken: bool = False) -> DataFrame:
    """One JSON object per file; unreadable ones go, or stay as rows with status ERROR_READ."""
    parsed = any_texts(spark, path).withColumn("j", F.from_json("value", schema))
    if keep_broken:
        return parsed.select("j.*", "file", F.when(_is_object("value"), "OK").otherwise("ERROR_READ").alias("read_status"))
    return parsed.where(_is_object("value")).select("j.*", "file")


def _is_object(c: str) -> Column:
    """Whether a text is one well-formed JSON object."""
    return F.coalesce(F.get_json_object(c, "$").startswith("{"), F.lit(False))


def json_lines(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(rows with their log order `seq`, counts of lines, blank lines and parse errors)."""
    text = spark.read.text(path).withColumn("seq", F.monotonically_increasing_id())
    parsed = text.withColumn("j", F.from_json("value", schema))
    blank = F.trim("value") == ""
    bad = ~blank & ~_is_object("value")
    counts = parsed.agg(F.count(F.lit(1)).alias("n_lines"), F.count_if(blank).alias("n_blank"), F.count_if(bad).alias("n_errors"))
    return parsed.where(~blank & ~bad).select("seq", "j.*"), counts


def price_table(spark: SparkSession, path: str) -> DataFrame:
    """Daily prices from CSV; rows without a date or close go; numbers stay text until parsed."""
    df = spark.read.option("header", True).schema("Date STRING, Open STRING, High STRING, Low STRING, Close STRING, Volume STRING").csv(path)
    return df.where("Date IS NOT NULL AND Close IS NOT NULL").select(F.try_to_date("Date").alias("date"), F.col("Close").try_cast("double").alias("close"), F.col("Volume").try_cast("double").alias("volume"), F.input_file_name().alias("file"))


def files(spark: SparkSession, path: str) -> DataFrame:
    """Path, folder, name, size and time of every file under a folder; contents are not read; names that start with _ or . are skipped."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length", "modificationTime")
    return df.select("path", F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("folder"), F.substring_index("path", "/", -1).alias("name"), F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def whole_texts(spark: SparkSession, path: str) -> DataFrame:
    """One row per text file, whole."""
    return spark.read.option("wholetext", True).text(path).select(F.input_file_name().alias("file"), F.col("value").alias("text"))


def repo_state(spark: SparkSession, path: str) -> DataFrame:
    """The one-row state of the repository; an empty one of the first version where none is kept."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    schema = "version STRING, casos ARRAY<STRING>"
    if where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return spark.read.schema(schema).json(path)
    return spark.createDataFrame([("estado_repo_v1", [])], schema)


def submissions(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Parallel arrays to records; incomplete ones go."""
    z = F.explode(F.arrays_zip(*[F.col(c) for c in columns]))
    rows = df.select(key, z.alias("z")).select(key, *[F.col(f"z.{c}").alias(c) for c in columns])
    return rows.dropna(subset=columns)


def url_candidates(host: str, web: str) -> Column:
    """Candidate investor pages of a company, in order of preference, without repeats."""
    bare = F.regexp_replace(F.col(host), "^www\\.", "")
    made = [F.col(web), F.concat(F.lit("https://ir."), bare), F.concat(F.lit("https://investors."), bare), F.concat(F.lit("https://www."), bare, F.lit("/investors"))]
    return F.array_distinct(F.filter(F.array(*made), lambda u: u.isNotNull() & (u != "")))
