"""Rows at which a query once did less than the whole job."""

from ledgerlark.plans.catalogue import QUERIES


def test_source_dedup_upgrade_tells_texts_with_one_opening_apart(spark, tmp_path):
    opening = "The same opening of fifty characters or so, then: "
    rows = [(1, opening + "one", "web", 53), (2, opening + "two", "web", 53), (3, opening + "one", "web", 53)]
    spark.createDataFrame(rows, "doc_id bigint, text string, source string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    assert sorted(r.seq for r in QUERIES["source_dedup_upgrade"](spark, str(tmp_path)).collect()) == [1, 2]
