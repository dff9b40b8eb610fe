import pytest

#: Texts that every operator has to bear: null, empty, blank, one word, ties, repeats, one long text, one without spaces.
HARD = [
    (1, None), (2, ""), (3, " \n\t "), (4, "word"), (5, "same text here " * 30), (6, "same text here " * 30), (6, "same text here " * 30), (None, "no id at all"),
    (7, "x" * 50_000), (8, "a b c d e f g h i j k l m n o p " * 4_000), (9, "\u00c9t\u00e9 \u65e5\u672c\u8a9e \U0001f642 na\u00efve"), (10, "@ + 1.2.3.4.5 4111 1111 1111 1111 \n\n#*$%&|<>"),
]
SCHEMA = "doc_id bigint, text string"


@pytest.fixture(scope="session")
def hard(spark):
    """The hard texts with more columns, whose names clash with those that operators add."""
    from pyspark.sql import functions as F

    extra = {c: F.lit("x") for c in ("n_words", "kept", "score", "label", "spans", "key", "h", "node", "bucket", "word", "host", "path", "lang", "source")}
    return spark.createDataFrame(HARD, SCHEMA).withColumns(extra)


@pytest.fixture(scope="session")
def empty(spark):
    from pyspark.sql import functions as F

    return spark.createDataFrame([], SCHEMA).withColumn("lang", F.lit("x"))
