"""Operators against brute force on small fixtures."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from ledgerlark.llm import bpe, classifier, language, licenses, lm, near_duplicates, pii, urls
from ledgerlark.llm.eliasfano import EliasFano, ef_build
from ledgerlark.llm.textbytes import NOT_ALNUM, Spans, buffers

SF = "/root/testdata/sf0.001"
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}


def test_spans():
    col = ["ab  C d", "", "e", None, "\u00e9t\u00e9 x"]
    data, offsets = buffers(pa.array(col))
    s = Spans(data, offsets, NOT_ALNUM, lower=True)
    got = [[data[a:b].tobytes().decode() for a, b in zip(s.start[i:j], s.end[i:j])] for i, j in zip(s.ptr[:-1], s.ptr[1:])]
    assert got == [["ab", "C", "d"], [], ["e"], [], ["\u00e9t\u00e9", "x"]]


@pytest.mark.parametrize("top", [10, 5_000, 2**62])
def test_elias_fano(top):
    rng = random.Random(top)
    values = np.array(sorted(rng.randrange(top) for _ in range(3000)), np.uint64)
    ef = EliasFano(ef_build(values, "v"), "v")
    assert (ef.access(np.arange(3000)) == values).all()
    asks = np.array([*rng.sample(values.tolist(), 500), *(rng.randrange(top) for _ in range(500)), 0, top], np.uint64)
    found = ef.find(asks)
    have = set(values.tolist())
    assert all((f >= 0 and values[f] == a) if int(a) in have else f < 0 for a, f in zip(asks, found))
    assert EliasFano(ef_build(np.zeros(0, np.uint64), "v"), "v").find(np.array([1], np.uint64))[0] == -1


def test_language_code_lengths(spark, docs):
    train = docs.limit(30)
    model = language.fit(train)
    rows = train.select("text", "lang").collect()
    for lang in model["langs"]:
        counts = collections.defaultdict(collections.Counter)
        for r in rows:
            if r.lang == lang:
                b = b"\0\0\0" + r.text.encode()
                for i in range(3, len(b)):
                    for k in range(4):
                        counts[b[i - k : i]][b[i]] += 1
        for text in ("", "The of and", "Éèß xyz 123"):
            b, bits = b"\0\0\0" + text.encode(), 0.0
            for i in range(3, len(b)):
                for k in (3, 2, 1, 0):
                    c = counts.get(b[i - k : i])
                    if c is None:
                        continue
                    n, d = sum(c.values()), len(c)
                    if b[i] in c:
                        bits -= math.log2(c[b[i]] / (n + d))
                        break
                    bits -= math.log2(d / (n + d))
                else:
                    bits += 8
            got = language.code_lengths(model, *buffers(pa.array([text])))[0, model["langs"].index(lang)]
            assert math.isclose(got, bits, rel_tol=1e-9, abs_tol=1e-9)


def test_language_held_out(spark):
    pred = language.op2_language_id(spark, "/root/testdata/sf0.01").where("held_out").join(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    assert len(pred) > 100 and sum(r.lang_pred == r.lang for r in pred) / len(pred) > 0.98


def test_classifier_held_out(spark):
    sf = "/root/testdata/sf0.01"
    got = classifier.op9_quality_classifier(spark, sf).where("held_out").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    assert len(got) > 40 and sum(r.predicted == r.quality for r in got) / len(got) > 0.9


def test_bpe_equals_the_library(spark, texts):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(bpe.tokenizer_path())
    odd = {-1: "don't <|endoftext|> we'll  \n\n x\t\u3000y 12\u00bd \u00b2\u00b3 e\u0301 \u65e5\u672c '' !'s<|endoftext|>", -2: None, -3: "", -4: "\r\n \xa0a\x1c\x1d b\x85"}
    rows = list(odd.items()) + list(texts.items())[:80]
    got = {r.doc_id: r for r in bpe.digest(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    for i, t in rows:
        ids = tok.encode(t or "", add_special_tokens=False).ids
        back = tok.decode(ids, skip_special_tokens=False)
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(back.encode()).hexdigest()


def shingle_sets(texts):
    out = {}
    for i, t in texts.items():
        w = WORD.findall(t.encode().lower())
        out[i] = {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else set()
    return out


def test_near_duplicate_classes(spark, docs, texts):
    rng, made = random.Random(5), dict(texts)
    base = [w for w in max(texts.values(), key=len).split()[:300]]
    for i in range(60):  # a group of near copies, some of them links only through others
        w = list(base)
        for _ in range(rng.randint(0, 9)):
            w[rng.randrange(len(w))] = f"new{rng.randrange(99)}"
        made[10_000 + i] = " ".join(w)
    got = {r.doc_id: r.class_id for r in near_duplicates.near_duplicates(spark.createDataFrame(list(made.items()), "doc_id bigint, text string")).collect()}
    sets = shingle_sets(made)
    head = {i: i for i in made}

    def find(x):
        while head[x] != x:
            x = head[x]
        return x

    ids = sorted(made)
    for x in ids:
        for y in ids:
            if x < y and sets[x] and sets[y]:
                both = len(sets[x] & sets[y])
                if both and both / (len(sets[x]) + len(sets[y]) - both) >= 0.8:
                    a, b = sorted((find(x), find(y)))
                    head[b] = a
    assert got == {i: find(i) for i in ids}


def test_signature_estimates_weighted_similarity():
    rng = random.Random(1)
    a = [f"w{rng.randrange(400)}" for _ in range(600)]
    b = a[:500] + [f"v{i}" for i in range(100)]
    data, offsets = buffers(pa.array([" ".join(a), " ".join(b)]))
    for weight in ("set", "count"):
        h, ptr, w = near_duplicates.elements(*near_duplicates.shingles(data, offsets), weight)
        x, y = (collections.Counter(dict(zip(h[i:j].tolist(), w[i:j].tolist()))) for i, j in zip(ptr[:-1], ptr[1:]))
        true = sum((x & y).values()) / sum((x | y).values())
        sig = near_duplicates.signatures(h, ptr, w, 1024)
        assert abs((sig[0] == sig[1]).mean() - true) < 0.06


def test_licenses(spark):
    rows = [(1, "x. Licensed under the Apache License, Version 2.0. y"), (2, "Licensed under the Apache Foundation"), (3, "cc by, cc-by and ALL RIGHTS reserved"), (4, "Licensed under CC BY-NC 4.0."), (5, "general public licence")]
    got = {r.doc_id: (r.n_base, r.first_word, r.last_word, r.base_labels, r.labels) for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == {1: (0, None, None, "", "apache-2.0"), 2: (0, None, None, "", ""), 3: (3, 0, 5, "cc-by,reserved", "cc-by,reserved"), 4: (1, 2, 2, "cc-by", "cc-by,cc-by-nc-4.0"), 5: (0, None, None, "", "")}


def test_pii_spans_and_redaction(spark):
    rows = [(1, "a@b.c_x@d.e"), (2, "card 4111 1111 1111 1111, not 4111 1111 1111 1112"), (3, "ip 1.2.3.4.5.6.7.8 and 256.1.1.1 and 001.2.3.255"), (4, "+1 (333) 555-8558, +12 3"), (5, "iban GB82WEST12345698765432"), (6, "GB83WEST12345698765432"), (7, "é a.b@c.de")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in pii.find_pii(df).collect()}
    assert got[1] == [("email", 0, 5), ("email", 5, 11)] and got[2] == [("card", 5, 24)]
    assert got[3] == [("ip", 3, 10), ("ip", 11, 18), ("ip", 37, 48)] and got[4] == [("phone", 0, 17)]
    assert got[5][0] == ("iban", 5, 27) and not got[6] and got[7] == [("email", 2, 10)]
    text = {r.doc_id: r.text for r in pii.redact(df).collect()}
    assert text[2] == "card [CARD], not 4111 1111 1111 1112" and text[7] == "é [EMAIL]" and text[6] == rows[5][1]


def test_language_model(spark, docs, texts):
    got = {r.doc_id: r for r in lm.op10_lm_score(spark, SF).collect()}
    tokens = {i: [*t.encode().lower().split(), None] for i, t in texts.items()}
    train = [i for i in tokens if zlib.crc32(str(i).encode()) % 5 != 1]
    one, two = collections.Counter(), collections.Counter()
    for i in train:
        one.update(tokens[i])
        two.update(zip([None, *tokens[i][:-1]], tokens[i]))
    total, v = sum(one.values()), len(one)
    mass = collections.Counter()
    for (c, _), n in two.items():
        mass[c] += (n - 0.75) / one[c]
    for i, ws in tokens.items():
        p1 = [(one[w] + 0.5) / (total + 0.5 * (v + 1)) for w in ws]
        full = [((two[c, w] - 0.75) / one[c] if two[c, w] else 0) + (1 - mass[c]) * p if one[c] else p for c, w, p in zip([None, *ws[:-1]], ws, p1)]
        assert (got[i].n_tokens, got[i].n_known, got[i].train_tokens) == (len(ws), sum(one[w] > 0 for w in ws), total)
        assert math.isclose(got[i].base_score, sum(map(math.log10, p1)), rel_tol=1e-12)
        assert abs(got[i].score - sum(map(math.log10, full))) < 0.02 * len(ws)


def test_url_templates_reject_by_purity(spark):
    rows = [(i, f"http://s.example.com/{'en' if i % 2 else 'xx'}/{i}") for i in range(60)] + [(100 + i, f"http://ok.example.org/fr/{i}") for i in range(30)]
    got = {r.page_id: (r.rule, r.verdict) for r in urls.filter_urls(spark.createDataFrame(rows, "page_id bigint, url string")).collect()}
    assert all(got[i][1] == "allow" and got[i][0] is None for i in range(100, 130))
    assert all(got[i] == ("com/en/", "block") for i in range(1, 60, 2) if not str(i).startswith("7"))


def test_url_templates_hand_their_labels_to_like_siblings(spark):
    """Rules judge /en/ alone; /de/ has the same structure and is merged with it, /shop/ has another."""
    rows = [(i, f"http://h.example.com/en/{1000 + i}.html") for i in range(80)] + [(100 + i, f"http://h.example.com/de/{2000 + i}.html") for i in range(40)]
    rows += [(200 + i, f"http://h.example.com/shop/item-{'abcdefghij'[i % 10]}/{i}") for i in range(30)] + [(300 + i, f"http://h.example.com/fr/{i}.html") for i in range(5)]
    df = spark.createDataFrame(rows, "page_id bigint, url string")
    got = {r.page_id: r for r in urls.filter_urls(df).collect()}
    assert all((got[i].rule, got[i].verdict, got[i].template) == ("com/en/", "block", "/+/*") for i in range(80))
    assert all((got[i].rule, got[i].verdict, got[i].template) == (None, "block", "/+/*") for i in range(100, 140))
    assert all(got[i].verdict == "allow" for i in [*range(200, 230), *range(300, 305)])
    assert {r.page_id: r.verdict for r in urls.filter_urls(df, with_template=False).collect()} == {i: r.verdict for i, r in got.items()}


def test_url_templates_of_deep_paths(spark):
    """Segments that vary only deep down still become wildcards there."""
    deep = "/".join(f"s{i}" for i in range(12))
    rows = [(i, f"http://d.example.org/{deep}/{i}/end") for i in range(60)]
    got = urls.filter_urls(spark.createDataFrame(rows, "page_id bigint, url string")).select("template").distinct().collect()
    assert [r.template for r in got] == [f"/{deep}/*/end"]
