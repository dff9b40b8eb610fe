"""BPE encoding and decoding run in one Python worker a task: two side by side took an executor over its memory."""

import pytest
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def texts(spark):
    rows = [(1, None), (2, ""), (3, "Plain words, twice: words 123"), (3, "Plain words, twice: words 123"), (None, "日本語 \U0001f642 naïve <|endoftext|>"), (5, "long " * 600_000), (6, "x" * 50_000)]
    return spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)


def test_one_worker_a_task(spark, texts):
    import corpus_pipeline
    from ledgerlark.llm import bpe

    for out in (corpus_pipeline.tokens(spark, texts, ""), bpe.digest(texts)):
        assert out._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1


def test_same_rows_as_one_after_the_other(spark, texts):
    from ledgerlark.llm import bpe

    def rows(df):
        return sorted(df.select(F.coalesce("doc_id", F.lit(-1)), F.sha2("ids", 256), F.sha2(F.col("text").cast("binary"), 256)).collect())

    got = rows(bpe.encode_decode(texts))
    assert len(got) == 7 and got == rows(bpe.decode(bpe.encode(texts, ids_as_list=False)))
    assert sorted(x or "" for x, in texts.select("text").collect()) == sorted(x for x, in bpe.encode_decode(texts).select("text").collect())
