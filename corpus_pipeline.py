"""From raw documents to token ids: five stages, each one operator of ledgerlark.llm.

A stage takes (spark, docs, sf_dir), works on every row that the stage before it has kept, and returns
a DataFrame with the columns of documents; the last returns token ids.  run() writes each stage's result
as Parquet into the shared folder and reads it again for the next; a stage's own intermediate tables and
the result of the stage before it are deleted as soon as nothing reads them.

Empty tables and null columns pass through: null texts are rejected by the quality rules, null ids stay
distinct documents by their text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.llm import bpe, decontaminate, near_duplicates, pii, quality
from ledgerlark.llm.common import Scratch, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: documents that a rule rejects go."""
    return quality.quality_filter(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: one document of each near-duplicate class stays."""
    return near_duplicates.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: documents contaminated by the benchmark go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: spans of personal data are replaced by their kind; n_chars follows the text."""
    clean = pii.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else clean


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: doc_id, n_tokens, ids (little-endian 32-bit integers), and the decoded text's SHA-256."""
    back = bpe.encode_decode(docs)
    n = (F.octet_length("ids") / 4).cast("bigint")
    return back.select("doc_id", n.alias("n_tokens"), "ids", F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [
    ("quality rules", quality_rules),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("PII", personal_data),
    ("BPE encoding and decoding", tokens),
]

#: BPE has no SQL form; tests/llm/test_queries.py holds run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        kept = scratch.keep(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        scratch.free(docs)
        docs = kept
    return STAGES[-1][1](spark, docs, sf_dir)
