"""Registered queries with a SQL form against it, and the pipeline against its stages by brute force."""

import hashlib
import os
import re

import duckdb
import numpy as np
import pandas as pd
import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF}/{f}'")
    return con


@pytest.mark.parametrize("name", ["op1_url_filter", "op3_decontamination", "op5_quality_rules", "op7_license_scan", "op8_pii"])
def test_against_sql(spark, duck, name):
    from ledgerlark.llm.registry import ORACLE_SQL, QUERIES

    got, want = QUERIES[name](spark, SF).toPandas(), duck.execute(ORACLE_SQL[name]).df()
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    key = lambda df: sorted(tuple("-" if pd.isna(v) else str(v) for v in r) for r in df[cols].itertuples(index=False))
    assert key(got) == key(want)


def test_pipeline(spark, duck):
    from tokenizers import Tokenizer

    import corpus_pipeline
    from ledgerlark.llm import bpe, pii
    from ledgerlark.llm.decontaminate import hits_sql
    from ledgerlark.llm.quality import kept_sql
    from test_exact import shingle_sets

    got = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}
    kept = duck.execute(f"SELECT doc_id, text FROM documents WHERE doc_id IN (SELECT doc_id FROM ({kept_sql('documents')}) WHERE kept)").df()
    texts = dict(zip(kept.doc_id, kept.text))
    sets, head = shingle_sets(texts), {i: i for i in texts}
    ids = sorted(texts)
    for _ in range(len(ids)):
        moved = False
        for x in ids:
            for y in ids:
                both = len(sets[x] & sets[y]) if x < y else 0
                if both and both / (len(sets[x]) + len(sets[y]) - both) >= 0.8 and head[x] != head[y]:
                    head[x] = head[y] = min(head[x], head[y])
                    moved = True
        if not moved:
            break
    left = kept[kept.doc_id.isin([i for i in ids if head[i] == i])]  # noqa: F841
    duck.register("left_docs", left)
    clean = set(duck.execute(f"SELECT doc_id FROM ({hits_sql('left_docs')}) WHERE NOT contaminated").df().doc_id)
    assert set(got) == clean
    tok = Tokenizer.from_file(bpe.tokenizer_path())
    for i in clean:
        text = texts[i]
        for kind in ("email",):
            text = re.sub(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", f"[{kind.upper()}]", text)
        if not re.search(r"[0-9]{3}", text):
            enc = tok.encode(text, add_special_tokens=False).ids
            assert np.frombuffer(got[i].ids, "<u4").tolist() == enc
            assert got[i].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert pii.KINDS[:4] == pii.BASE_KINDS
