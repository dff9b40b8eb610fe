"""Session helpers shared by the training-data operators."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side is broadcast up to this many bytes (measured, not estimated).
BROADCAST_BYTES = 24 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir; a temporary one only where that is unset and all run in one process."""
    set_to = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not set_to:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerlark-"))
        set_to = spark.sparkContext.getCheckpointDir()
    return set_to


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/ledgerlark/{name}-{uuid.uuid4().hex}"


def write_table(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write df as Parquet into the shared folder and read it back.

    Unlike a local checkpoint the copy outlives any executor.
    """
    return write_table(df, name)[0]


class Scratch:
    """Intermediate tables of one operator, deleted as soon as nothing reads them any more.

    What is still held when the operator returns is what its result reads.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.held: list[tuple[DataFrame, str]] = []

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        self.held.append(write_table(df, name))
        return self.held[-1][0]

    def free(self, *tables: DataFrame) -> None:
        gone = [h for h in self.held if any(h[0] is t for t in tables)]
        self.held = [h for h in self.held if h not in gone]
        for _, path in gone:
            where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)

    def free_all_but(self, *tables: DataFrame) -> None:
        self.free(*[t for t, _ in self.held if not any(t is x for x in tables)])


def fold(doc_id: str | Column = "doc_id") -> Column:
    """crc32 of the id's decimal text, modulo 5; null ids fall into fold 0."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % 5, F.lit(0))


def _bytes_of(df: DataFrame) -> Column:
    """Bytes of a row, as a broadcast holds it: 16 a column, and the contents of strings and arrays."""
    total = F.lit(16 * len(df.columns)).cast("bigint")
    for f in df.schema.fields:
        kind, c = f.dataType.typeName(), F.col(f"`{f.name}`")
        if kind in ("string", "binary"):
            total = total + F.coalesce(F.octet_length(c), F.lit(0))
        elif kind == "array":
            each = F.aggregate(c, F.lit(0).cast("bigint"), lambda a, x: a + 24 + F.coalesce(F.octet_length(x.cast("string")), F.lit(0)))
            total = total + F.coalesce(each, F.lit(0))
    return total


def maybe_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast only below a measured bound of bytes; beyond it the join shuffles."""
    n = df.agg(F.sum(_bytes_of(df))).first()[0] or 0
    return F.broadcast(df) if n <= max_bytes else df
