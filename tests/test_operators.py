"""Edge rows of single operators: nulls, ties, orders that matter."""

import itertools
import json
import random

import pytest
from pyspark.sql import functions as F

from ledgerlark.functions import numbers as N
from ledgerlark.functions import text as T
from ledgerlark.operators import gates as G
from ledgerlark.operators import lookups as L
from ledgerlark.operators import merge as M
from ledgerlark.operators import metrics as D
from ledgerlark.operators import votes as V
from ledgerlark.sources import readers, sinks


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


def test_merge_order_examples(spark):
    rows = [("a", 1, 3, 10.0), ("a", 2, 1, 20.0), ("a", 3, 2, 30.0), ("b", 1, 1, None), ("b", 2, 4, 5.0), ("c", 1, 3, None), ("c", 2, 1, 7.0), ("d", 1, 2, 1.0), ("d", 2, 2, 2.0)]
    df = spark.createDataFrame(rows, "k string, seq int, prio int, v double")
    got = {r.k: r.v for r in M.priority_merge(df, ["k"], "seq", "prio", ["v"]).collect()}
    assert got == {"a": 30.0, "b": None, "c": 7.0, "d": 1.0}
    best = {r.k: r.v for r in M.priority_merge(df, ["k"], "seq", "prio", ["v"], mode="best_priority").collect()}
    assert best == {"a": 20.0, "b": 5.0, "c": 7.0, "d": 1.0}


def test_merge_equals_the_sequential_rule(spark):
    rng = random.Random(3)
    rows, want = [], {}
    for k in range(300):
        value = prio0 = None
        for s in range(rng.randint(1, 6)):
            p, v = rng.randint(1, 4), rng.choice([None, rng.randint(1, 9)])
            rows.append((k, s, p, v))
            if s == 0:
                value, prio0 = v, p
            elif v is not None and (p < prio0 or (value is None and p <= prio0)):
                value = v
        want[k] = value
    df = spark.createDataFrame(rows, "k int, seq int, prio int, v int")
    assert {r.k: r.v for r in M.priority_merge(df, ["k"], "seq", "prio", ["v"]).collect()} == want


def test_nearest_rank_on_small_groups(spark):
    scores = {1: [62.5], 2: [63.5, 100.4], 4: [1, 2, 3, 4], 7: [5, 5, 6, 7, 8, 9, 99]}
    df = spark.createDataFrame([(n, float(s)) for n, ss in scores.items() for s in ss], "k int, score double")
    got = {r.k: (r.p25, r.p50) for r in V.nearest_rank(df.withColumn("bin", V.score_bin(F.col("score"))), ["k"], "bin", {"p25": 0.25, "p50": 0.5}).collect()}
    assert got == {1: (62, 62), 2: (64, 64), 4: (1, 2), 7: (5, 7)}


def test_gate_edges(spark):
    d = lambda x: F.lit(x).cast("double")
    r = one(spark, G.balance_identity(d(102), d(60), d(40)).alias("a"), G.balance_identity(d(102.1), d(60), d(40)).alias("b"), G.balance_identity(d(None), d(1), d(1)).alias("c"), G.balance_identity(d(5), d(1), d(-1)).alias("d"))
    assert tuple(r) == ("PASS", "FAIL", "FAIL", "SKIP")
    c = lambda delta, other: G.cashflow_identity(d(1e7), d(0), d(0), d(delta), d(None), d(other))
    r = one(spark, c(0, None).alias("zero"), c(1.05e7, None).alias("within"), c(1.09e7, None).alias("warn"), c(1.09e7, 0.0).alias("explained"), G.ev_sanity(d(-1)).alias("ev"), G.ev_sanity(d(0)).alias("none"))
    assert tuple(r) == ("SKIP", "PASS", "WARNING", "FAIL", "WARNING", "SKIP")


def test_implied_growth_inverts_the_model(spark):
    def solve(ev, fcf, r, m, years=5):
        low, high = -0.5, 2.0
        for _ in range(100):
            g = (low + high) / 2
            v = sum(fcf * (1 + g) ** t / (1 + r) ** t for t in range(1, years + 1)) + fcf * (1 + g) ** years * m / (1 + r) ** years
            if abs(v - ev) < ev * 1e-4:
                return g
            low, high = (g, high) if v < ev else (low, g)
        return (low + high) / 2

    cases = [(1000.0, 50.0, 0.1, 15.0), (1e6, 1.0, 0.08, 10.0), (100.0, 40.0, 0.12, 25.0), (-1.0, 1.0, 0.1, 10.0), (10.0, 0.0, 0.1, 10.0)]
    df = spark.createDataFrame(cases, "ev double, fcf double, r double, m double")
    got = [x.g for x in df.select("ev", D.implied_growth(F.col("ev"), F.col("fcf"), F.col("r"), F.col("m")).alias("g")).collect()]
    for c, g in zip(cases, got):
        assert g is None if min(c) <= 0 else abs(g - solve(*c)) < 1e-4


def test_trailing_year_gaps(spark):
    rows = [("ok", "2023-03-31"), ("ok", "2023-06-30"), ("ok", "2023-09-30"), ("ok", "2023-12-31"), ("hole", "2022-12-31"), ("hole", "2023-06-30"), ("hole", "2023-09-30"), ("hole", "2023-12-31"), ("few", "2023-12-31")]
    df = spark.createDataFrame(rows, "k string, e string").withColumns({"e": F.to_date("e"), "x": F.when(F.col("e") != "2023-09-30", 1)})
    got = {r.k: (r.ttm_ok, r.ttm_x, r.ttm_y) for r in D.trailing_year(df.withColumn("y", F.lit(2)), ["k"], "e", ["x", "y"]).collect()}
    assert got == {"ok": (True, None, 8), "hole": (False, None, 8), "few": (False, None, None)}


def test_union_feeds_numbers_all_rows_in_order(spark):
    out = M.union_feeds([spark.range(1200).select(F.format_string("a%05d", "id").alias("name")), spark.createDataFrame([("z", 1)], "name string, x int")], "name").orderBy("feed", "name").collect()
    assert [r.source_id for r in out] == [f"SRC_{i:03d}" for i in range(1, 1202)] and out[-1].x == 1


def test_dedup_upgrade_rules(spark):
    rows = [("t", 1, "HTTP://A", "", 10, "p1"), ("t", 2, "http://a", "", 20, "p2"), ("t", 3, "http://a", "", 21, "p3"), ("t", 4, "", "acc", 5, "p4"), ("t", 5, "u5", "ACC", 1, "p5"), ("t", 6, "u5", "", 1, "p6"), ("t", 7, "", "", 1, "")]
    df = spark.createDataFrame(rows, "g string, seq int, url string, acc string, size long, path string")
    got = {(r.seq, r.path, r.size) for r in M.dedup_upgrade(df, "g", "seq", ("url", "acc"), "size", "path").collect()}
    assert got == {(1, "p3", 21), (4, "p4", 5), (6, "p6", 1), (7, "", 1)}


def test_ready_steps(spark):
    state = [(1, s, "DONE" if s in ("SOURCES", "TRUTH_PACK", "IMPLIED", "CATALYST") else "PENDING") for s in ("SOURCES", "TRUTH_PACK", "IMPLIED", "CATALYST", "FORENSIC", "BULL", "RED_TEAM", "ARBITRO")]
    got = L.ready_steps(spark.createDataFrame(state, "c int, step string, status string"), spark.createDataFrame(L.STEP_DEPENDENCIES, "step string, depends_on string"), "c").collect()
    assert [(r.c, r.step) for r in got] == [(1, "FORENSIC")]


def test_safe_division_never_raises(spark):
    pairs = list(itertools.product([None, -1.0, 0.0, 2.0], repeat=2))
    got = spark.createDataFrame(pairs, "n double, d double").select("n", "d", N.safe_div(F.col("n"), F.col("d")).alias("q")).collect()
    assert all(r.q == (r.n / r.d if r.n is not None and (r.d or 0) > 0 else None) for r in got)


@pytest.mark.parametrize(("text", "want"), [('{"a":1}', '{"a":1}'), ('pre {"a":1} post', '{"a":1}'), ("none", None)])
def test_json_recovery(spark, text, want):
    assert one(spark, T.json_recover(F.lit(text)).alias("x")).x == want


def test_readers_and_sinks(spark, tmp_path):
    (tmp_path / "c/T/1").mkdir(parents=True)
    (tmp_path / "c/T/2").mkdir()
    (tmp_path / "c/T/1/_estado.json").write_text(json.dumps({"ticker": "T", "pipeline": {"S": {"estado": "DONE"}}}))
    (tmp_path / "c/T/2/_estado.json").write_text("{broken")
    glob = f"{tmp_path}/c/*/*/_estado.json"
    assert readers.json_documents(spark, glob, readers.CASE_STATE).count() == 1
    assert sorted(r.read_status for r in readers.json_documents(spark, glob, readers.CASE_STATE, keep_broken=True).collect()) == ["ERROR_READ", "OK"]
    (tmp_path / "log.jsonl").write_text('{"event_id":"1","score_raw_0_100":5}\n\n{bad\n{"event_id":"2"}\n')
    rows, counts = readers.json_lines(spark, f"{tmp_path}/log.jsonl", readers.VOTE_EVENT)
    assert [r.event_id for r in rows.orderBy("seq").collect()] == ["1", "2"] and tuple(counts.first()) == (4, 1, 1)
    (tmp_path / "c/T/1/Report_v1.json").write_text("{}")
    assert [(r.name, r["size"]) for r in readers.files(spark, f"{tmp_path}/c").collect()] == [("Report_v1.json", 2)]
    out = f"{tmp_path}/out"
    sinks.versioned(spark.range(3).toDF("x"), out, "r1", F.lit("2024-01-01"))
    sinks.versioned(spark.range(4).toDF("x"), out, "r2", F.lit("2024-01-02"))
    assert [r.n_rows for r in sinks.latest_entries(spark, f"{out}/history", 1, [F.desc("written_at")]).collect()] == [4]
    a, b = (spark.createDataFrame([(1, v, "s")], "k int, v int, w string") for v in (1, 2))
    assert [tuple(r) for r in sinks.changes(a, b, ["k"], ["v", "w"]).collect()] == [(1, "v", "1", "2")]
    assert sinks.markdown_table(a, ["k"]).first().markdown.endswith("| 1 | 1 | s |")


def test_dedup_upgrade_equals_the_fold(spark):
    """Chains of shared urls and accessions, against the rule row by row."""
    rng = random.Random(11)
    rows = [(rng.choice("gh"), i, rng.choice(["", "u1", "U2", "u3", f"x{i}", f"y{i // 2}"]), rng.choice(["", "a1", "A2", f"b{i // 3}", None]), rng.randint(1, 40), rng.choice(["", "p", f"q{i}"])) for i in range(300)]
    want = []
    for g in "gh":
        seen, kept = {}, []
        for _, i, url, acc, size, path in [r for r in rows if r[0] == g]:
            marks = [x.strip().lower() for x in (url, acc or "") if x.strip()]
            own = next((seen[m] for m in marks if m in seen), None)
            if own is None:
                for m in marks:
                    seen[m] = len(kept)
                kept.append([i, size, path])
            elif path and path != kept[own][2] and size > 2 * kept[own][1]:
                kept[own][1:] = [size, path]
        want += [(g, *k) for k in kept]
    df = spark.createDataFrame(rows, "g string, seq int, url string, acc string, size long, path string")
    got = [(r.g, r.seq, r["size"], r.path) for r in M.dedup_upgrade(df, "g", "seq", ("url", "acc"), "size", "path").collect()]
    assert sorted(got) == sorted(want)
