"""Nulls, empty and long texts, repeats, empty tables and clashing columns, through every operator."""

import pytest
from pyspark.sql import functions as F

from ledgerlark.llm import bpe, classifier, decontaminate, language, licenses, lm, near_duplicates, pii, quality, urls


def bench(spark):
    return spark.createDataFrame([(1, "a b c d e f g h i j k l m n o p"), (2, "word"), (3, None), (None, "same text here"), (5, "")], "item_id bigint, text string")


def labels(spark):
    return spark.createDataFrame([(5, 1, 0), (8, 0, 1), (9, None, None), (None, 1, 0), (8, 0, 0)], "doc_id bigint, quality int, toxic int")


OPERATORS = {
    "quality": lambda s, d: quality.quality_verdicts(d, digest=True),
    "language": lambda s, d: language.identify_language(d, language.fit(d.where("lang IS NOT NULL"))),
    "decontaminate": lambda s, d: decontaminate.contamination(d, bench(s)),
    "bpe": lambda s, d: bpe.decode(bpe.encode(d, ids_as_list=False)),
    "licenses": lambda s, d: licenses.scan_licenses(d),
    "pii": lambda s, d: pii.find_pii(d),
    "classifier": lambda s, d: classifier.classify(d, classifier.fit(d, labels(s), "quality")),
    "lm": lambda s, d: lm.score(d, lm.fit(d)),
}


@pytest.mark.parametrize("name", list(OPERATORS))
def test_one_row_per_row(spark, hard, empty, name):
    got = OPERATORS[name](spark, hard)
    assert sorted((r.doc_id or 0) for r in got.collect()) == sorted((r.doc_id or 0) for r in hard.collect())
    assert OPERATORS[name](spark, empty).count() == 0


def test_near_duplicates(spark, hard, empty):
    got = {(r.doc_id, r.copy_key): (r.class_id, r.class_size, r.kept) for r in near_duplicates.near_duplicates(hard).collect()}
    assert len(got) == 11  # the repeated row is one document
    assert sorted(v for k, v in got.items() if k[0] in (5, 6)) == [(5, 2, False), (5, 2, True)]
    assert all(v[1:] == (1, True) for k, v in got.items() if k[0] not in (5, 6))
    assert near_duplicates.near_duplicates(empty).count() == 0


def test_urls(spark):
    rows = [(1, None), (2, ""), (3, "no scheme"), (4, "http://"), (5, "HTTP://WWW.Example.COM/en/71?x"), (6, "http://a.com/en/1"), (6, "http://a.com/en/1"), (7, "http://com/en/"), (8, "x://y://com/en/1"), (None, "http://h.org/" + "s/" * 5000)]
    got = {r.page_id: (r.host, r.path[:8], r.rule, r.verdict) for r in urls.filter_urls(spark.createDataFrame(rows, "page_id bigint, url string").withColumn("host", F.lit(1))).collect()}
    assert got[1] == got[2] == got[3] == ("", "", None, "allow")
    assert got[5] == ("www.example.com", "/en/71", "example.com/en/7", "allow")
    assert got[6] == ("a.com", "/en/1", "com/en/", "block") and got[7][2:] == ("com/en/", "block")
    assert got[8] == ("y:", "//com/en", None, "allow")
    assert urls.filter_urls(spark.createDataFrame([], "page_id bigint, url string")).count() == 0


def test_filters_keep_columns(spark, hard, empty):
    for f in (quality.quality_filter, near_duplicates.keep_one, lambda d: decontaminate.drop_contaminated(d, bench(spark)), pii.redact):
        assert f(hard).columns == hard.columns and f(empty).count() == 0
