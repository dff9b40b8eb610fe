"""Sources and sinks: tables written through the sinks into the shared folder and read back by the readers."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import numbers as N
from ..functions import text as T
from ..operators import envelopes as E
from ..operators import gates as G
from ..operators import normalise as O
from ..operators import selection as S
from ..sources import readers, sinks
from ..sources.shared import shared_folder
from .registry import query, read


def _case_files(spark, sf, what: str) -> str:
    """A folder per nation with one state file; every seventh is broken."""
    top, k = shared_folder(spark, "cases"), F.col("n_nationkey")
    good = F.concat(F.lit('{"ticker":"T'), k.cast("string"), F.lit('","estado_pipeline":"'), F.when(k % 2 == 0, "COMPLETO").otherwise("INCOMPLETO"), F.lit('","score":"'), (k * 3).cast("string"), F.lit('","pipeline":{"S1":{"estado":"DONE"}}}'))
    rows = read(spark, sf, "nation").select(F.when(k % 7 == 0, "{broken").otherwise(good).alias("value"), k.alias("caso"))
    rows.repartition("caso").write.partitionBy("caso").text(f"{top}/{what}")
    return f"{top}/{what}/*/part-*"


@query("case_states", "SELECT 'T' || n_nationkey AS ticker, CASE WHEN n_nationkey % 2 = 0 THEN 'COMPLETO' ELSE 'INCOMPLETO' END AS estado_pipeline, CAST(n_nationkey * 3 AS VARCHAR) AS score, 'DONE' AS s1 FROM nation WHERE n_nationkey % 7 <> 0")
def case_states(spark, sf):
    got = readers.json_documents(spark, _case_files(spark, sf, "states"), readers.CASE_STATE)
    return got.select("ticker", "estado_pipeline", "score", F.try_element_at("pipeline", F.lit("S1"))["estado"].alias("s1"))


@query("dashboard_scan", "SELECT CASE WHEN n_nationkey % 7 = 0 THEN 'ERROR_READ' ELSE 'OK' END AS read_status, CASE WHEN n_nationkey % 7 <> 0 THEN 'T' || n_nationkey END AS ticker FROM nation")
def dashboard_scan(spark, sf):
    return readers.json_documents(spark, _case_files(spark, sf, "dashboard"), readers.CASE_STATE, keep_broken=True).select("read_status", "ticker")


@query("vote_log_rows", "SELECT CAST(event_id AS VARCHAR) AS event_id, event_type AS step_name, CAST(value AS VARCHAR) AS score_raw_0_100, CAST(event_id % 5 AS VARCHAR) AS rule FROM events")
def vote_log_rows(spark, sf):
    path = shared_folder(spark, "log")
    e = read(spark, sf, "events").select(F.col("event_id").cast("string").alias("event_id"), F.col("event_type").alias("step_name"), F.col("value").cast("string").alias("score_raw_0_100"), F.array((F.col("event_id") % 5).cast("string")).alias("rules_failed"))
    for half in (0, 1):  # the log is appended to
        sinks.append_log(e.where(F.col("event_id").cast("bigint") % 2 == half), path)
    rows, _ = readers.json_lines(spark, path, readers.VOTE_EVENT)
    return rows.select("event_id", "step_name", "score_raw_0_100", F.get("rules_failed", F.lit(0)).alias("rule"))


@query("vote_log_counts", "SELECT count(*) AS n_lines, count(*) FILTER (event_id % 10 = 0) AS n_blank, count(*) FILTER (event_id % 10 IN (1, 2)) AS n_errors FROM events")
def vote_log_counts(spark, sf):
    path, i = shared_folder(spark, "broken-log"), F.col("event_id") % 10
    line = F.when(i == 0, "  ").when(i == 1, '{"event_id":').when(i == 2, "[1]").otherwise(F.concat(F.lit('{"event_id":"'), F.col("event_id").cast("string"), F.lit('"}')))
    read(spark, sf, "events").select(line.alias("value")).write.text(path)
    return readers.json_lines(spark, path, readers.VOTE_EVENT)[1]


@query("price_csv", "SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS date, CAST(o_orderkey AS DOUBLE) AS close, CASE WHEN o_orderkey % 4 <> 0 THEN CAST(o_custkey AS DOUBLE) END AS volume FROM orders WHERE o_orderkey % 5 <> 0")
def price_csv(spark, sf):
    path, k = shared_folder(spark, "prices"), F.col("o_orderkey")
    o = read(spark, sf, "orders").select(F.to_date("o_orderdate").cast("string").alias("Date"), F.lit("1").alias("Open"), F.lit("2").alias("High"), F.lit("0").alias("Low"), F.when(k % 5 != 0, k.cast("string")).alias("Close"), F.when(k % 4 == 0, "n/a").otherwise(F.col("o_custkey").cast("string")).alias("Volume"))
    o.write.option("header", True).csv(path)
    return readers.price_table(spark, path).select(F.col("date").cast("string").alias("date"), "close", "volume")


@query("file_listing", "SELECT n_nationkey, length(n_name) + 1 AS size FROM nation")
def file_listing(spark, sf):
    path = shared_folder(spark, "files")
    read(spark, sf, "nation").select(F.col("n_name").alias("value"), "n_nationkey").repartition("n_nationkey").write.partitionBy("n_nationkey").text(path)
    found = readers.files(spark, path).where(F.col("name").startswith("part-"))
    return found.select(F.regexp_extract("folder", "n_nationkey=([0-9]+)", 1).cast("int").alias("n_nationkey"), F.col("size").cast("bigint").alias("size"))


@query("page_files", "SELECT n_nationkey, n_name || chr(10) || n_regionkey AS text FROM nation")
def page_files(spark, sf):
    path = shared_folder(spark, "pages")
    html = F.concat(F.lit("<html><head><script>x<y</script></head><p> "), "n_name", F.lit(" </p><!-- no -->"), F.col("n_regionkey").cast("string"), F.lit("</html>"))
    read(spark, sf, "nation").select(html.alias("value"), "n_nationkey").repartition("n_nationkey").write.partitionBy("n_nationkey").text(path)
    from ..operators.pages import html_text

    got = readers.whole_texts(spark, path).withColumn("n_nationkey", F.regexp_extract("file", "n_nationkey=([0-9]+)", 1).cast("int"))
    return got.select("n_nationkey", html_text(F.col("text")).alias("text"))


@query("submissions", "SELECT o_custkey, 'F' || o_orderkey % 4 AS form, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS filed, CAST(o_orderkey AS VARCHAR) AS accession FROM orders WHERE o_orderkey % 6 <> 0")
def submissions(spark, sf):
    k = F.col("o_orderkey")
    one = F.struct(F.concat(F.lit("F"), (k % 4).cast("string")).alias("form"), F.to_date("o_orderdate").cast("string").alias("filed"), F.when(k % 6 != 0, k.cast("string")).alias("accession"))
    g = read(spark, sf, "orders").groupBy("o_custkey").agg(F.collect_list(one).alias("x")).select("o_custkey", "x.form", "x.filed", "x.accession")
    return readers.submissions(g, "o_custkey", ["form", "filed", "accession"])


@query("url_candidates", "SELECT c_custkey, array_to_string(list_filter([CASE c_custkey % 3 WHEN 0 THEN 'https://ir.h' || c_custkey || '.com' WHEN 1 THEN 'https://web' END, CASE WHEN c_custkey % 3 <> 0 THEN 'https://ir.h' || c_custkey || '.com' END, 'https://investors.h' || c_custkey || '.com', 'https://www.h' || c_custkey || '.com/investors'], lambda x: x IS NOT NULL), ' ') AS urls FROM customer")
def url_candidates(spark, sf):
    k = F.col("c_custkey")
    name = F.concat(F.lit("h"), k.cast("string"), F.lit(".com"))
    c = read(spark, sf, "customer").select("c_custkey", F.when(k % 2 == 0, F.concat(F.lit("www."), name)).otherwise(name).alias("host"), F.when(k % 3 == 0, F.concat(F.lit("https://ir."), name)).when(k % 3 == 1, "https://web").otherwise("").alias("web"))
    return c.select("c_custkey", F.array_join(readers.url_candidates("host", "web"), " ").alias("urls"))


@query("replaced_json", "SELECT s_suppkey, s_name FROM supplier WHERE s_suppkey % 2 = 0")
def replaced_json(spark, sf):
    path, s = shared_folder(spark, "replaced"), read(spark, sf, "supplier").select("s_suppkey", "s_name")
    sinks.replace_json(s, path)
    sinks.replace_json(s.where("s_suppkey % 2 = 0"), path)
    return spark.read.schema(s.schema).json(path)


@query("rollup_history", "SELECT 'r' || i AS run_id, n AS n_rows FROM (SELECT 2 AS i, count(*) FILTER (s_suppkey % 3 <> 0) AS n FROM supplier UNION ALL SELECT 3, count(*) FROM supplier)")
def rollup_history(spark, sf):
    path, s = shared_folder(spark, "rollup"), read(spark, sf, "supplier")
    for i, rows in enumerate((s.limit(0), s.where("s_suppkey % 3 <> 0"), s), 1):
        sinks.versioned(rows, path, f"r{i}", F.lit(f"2024-01-0{i}"))
    return sinks.latest_entries(spark, f"{path}/history", 2, [F.desc("written_at")]).select("run_id", "n_rows")


@query("repair_changes", "SELECT c_custkey, 'c_name' AS field, c_name AS old, c_name || '!' AS \"new\" FROM customer WHERE c_custkey % 4 = 0 UNION ALL SELECT c_custkey, 'c_mktsegment', c_mktsegment, NULL FROM customer WHERE c_custkey % 6 = 0")
def repair_changes(spark, sf):
    old, k = read(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment"), F.col("c_custkey")
    new = old.select("c_custkey", F.when(k % 4 == 0, F.concat("c_name", F.lit("!"))).otherwise(F.col("c_name")).alias("c_name"), F.when(k % 6 != 0, F.col("c_mktsegment")).alias("c_mktsegment"))
    return sinks.changes(old, new, ["c_custkey"], ["c_name", "c_mktsegment"])


@query("purge_list", "SELECT '/f' || p_partkey AS path FROM part WHERE p_size <= 25 OR p_partkey % 11 = 0")
def purge_list(spark, sf):
    files = read(spark, sf, "part").select(F.concat(F.lit("/f"), F.col("p_partkey").cast("string")).alias("path"), F.when(F.col("p_partkey") % 11 != 0, F.col("p_size")).alias("size"))
    return sinks.purge_list(files, F.col("size") > 25)


@query("rename_list", """WITH f AS (SELECT p_brand AS folder, p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'id_' ELSE '' END || 'n' || p_partkey % 50 AS name FROM part)
SELECT folder || '/' || p_partkey AS path, 'id_' || name AS new_name FROM f WHERE name NOT LIKE 'id%' AND NOT EXISTS (SELECT 1 FROM f g WHERE g.folder = f.folder AND g.name = 'id_' || f.name)""")
def rename_list(spark, sf):
    k = F.col("p_partkey")
    name = F.concat(F.when(k % 3 == 0, "id_").otherwise(""), F.lit("n"), (k % 50).cast("string"))
    files = read(spark, sf, "part").select(F.col("p_brand").alias("folder"), name.alias("name"), F.concat("p_brand", F.lit("/"), k.cast("string")).alias("path"))
    return sinks.rename_list(files, "name", F.lit("id"))


@query("markdown_report", "SELECT '| r_regionkey | r_name |' || chr(10) || '|---|---|' || chr(10) || string_agg('| ' || r_regionkey || ' | ' || r_name || ' |', chr(10) ORDER BY r_regionkey) AS markdown FROM region")
def markdown_report(spark, sf):
    return sinks.markdown_table(read(spark, sf, "region").select("r_regionkey", "r_name"), ["r_regionkey"])


@query("repo_state", "SELECT 'estado_repo_v1' AS version, 0 AS n_cases UNION ALL SELECT 'v2', count(*) FROM nation")
def repo_state(spark, sf):
    path = shared_folder(spark, "state")
    missing = readers.repo_state(spark, path)
    n = read(spark, sf, "nation").agg(F.collect_list("n_name").alias("casos"))
    sinks.replace_json(n.select(F.lit("v2").alias("version"), "casos"), path)
    return missing.union(readers.repo_state(spark, path)).select("version", F.size("casos").cast("bigint").alias("n_cases"))


# --- labels and small column functions on rows of the tables
_CAT = [("10-k|20-f|10-q", "SEC"), ("transcript|call", "TRANSCRIPT"), ("present", "PRESENTATION")]


@query("source_categories", "SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 'SEC' WHEN 1 THEN 'TRANSCRIPT' WHEN 2 THEN 'PRESENTATION' WHEN 3 THEN 'SEC' ELSE 'OTHER' END AS category FROM orders")
def source_categories(spark, sf):
    k = F.col("o_orderkey") % 5
    name = F.when(k == 0, "form 10-k").when(k == 1, "earnings call").when(k == 2, "presentation").when(k == 3, "call on 20-f").otherwise("memo")
    return read(spark, sf, "orders").select("o_orderkey", S.first_match(name, _CAT, "OTHER").alias("category"))


@query("text_labels", """SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'US' WHEN 1 THEN 'GB' WHEN 2 THEN upper(c_mktsegment) END AS country, CASE c_custkey % 3 WHEN 0 THEN 'RED_TEAM' WHEN 1 THEN 'BULL' ELSE '' END AS role, 1990 + c_custkey % 40 AS year,
 c_name AS body, CASE WHEN length(c_mktsegment) > 9 THEN c_mktsegment[1:6] || '...' ELSE c_mktsegment END AS short, CASE WHEN c_custkey % 200 < 60 THEN (c_custkey % 200) || 's' ELSE (c_custkey % 200) // 60 || 'm ' || (c_custkey % 200) % 60 || 's' END AS took FROM customer""")
def text_labels(spark, sf):
    from ..functions import periods as P

    k = F.col("c_custkey")
    country = F.when(k % 4 == 0, " usa ").when(k % 4 == 1, "United Kingdom").when(k % 4 == 2, F.lower("c_mktsegment")).otherwise(" ")
    file = F.when(k % 3 == 0, "AgentReport_Red_Team_1.json").when(k % 3 == 1, "report-bull.json").otherwise("other.json")
    return read(spark, sf, "customer").select(
        "c_custkey", T.canonical_country(country).alias("country"), T.agent_role(file).alias("role"), P.label_year(F.concat(F.lit("FY"), (1990 + k % 40).cast("string"), F.lit("-12"))).alias("year"),
        T.cut_footer(F.concat("c_name", F.lit("\n---stats\nx\n---stats")), "---stats").alias("body"), T.ellipsis(F.col("c_mktsegment"), 9).alias("short"), T.duration((k % 200).cast("double") + 0.5).alias("took"),
    )


@query("money_labels", "SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN format('{:,}.00p', o_orderkey * 100) ELSE format('{:,}.00 EUR', o_orderkey) END AS label FROM orders")
def money_labels(spark, sf):
    k = F.col("o_orderkey")
    return read(spark, sf, "orders").select("o_orderkey", N.money(k.cast("double"), F.when(k % 2 == 0, "GBP").otherwise("EUR")).alias("label"))


@query("with_data", "SELECT o_orderkey FROM orders WHERE o_orderkey % 3 = 0 OR o_orderkey % 4 = 0")
def with_data(spark, sf):
    k = F.col("o_orderkey")
    return read(spark, sf, "orders").select("o_orderkey", F.when(k % 3 == 0, k).alias("a"), F.when(k % 4 == 0, "0").alias("b"), F.lit(None).cast("double").alias("c")).where(O.has_data("a", "b", "c")).select("o_orderkey")


@query("autochecks", "SELECT o_orderkey, o_orderkey % 4 = 0 AS passed FROM orders")
def autochecks(spark, sf):
    k = F.col("o_orderkey") % 4
    doc = F.when(k == 0, '{"a":true,"b":true}').when(k == 1, '{"a":true,"b":"yes"}').when(k == 2, '{"a":true}').otherwise('{"a":true,"b":1}')
    return read(spark, sf, "orders").select("o_orderkey", E.autocheck(doc, ["a", "b"]).alias("passed"))


@query("vote_eligible", "SELECT event_id FROM events WHERE event_id % 2 = 0 AND event_id % 3 <> 0 AND (event_id % 5 <> 0 OR event_id % 7 = 0)")
def vote_eligible(spark, sf):
    i = F.col("event_id")
    return read(spark, sf, "events").where(E.vote_eligible(i % 2 == 0, F.when(i % 3 == 0, "python").otherwise("llm"), F.when(i % 5 == 0, "MONITOR").otherwise("PIPELINE"), i % 7 == 0)).select("event_id")


@query("merged_settings", "SELECT c_custkey, c_mktsegment AS a, CASE WHEN c_custkey % 2 = 0 THEN 'over' ELSE 'base' END AS b, 'new' AS c FROM customer")
def merged_settings(spark, sf):
    over = F.create_map(F.lit("b"), F.when(F.col("c_custkey") % 2 == 0, "over"), F.lit("c"), F.lit("new"))
    m = E.merge_settings(F.create_map(F.lit("a"), F.col("c_mktsegment"), F.lit("b"), F.lit("base")), over)
    return read(spark, sf, "customer").select("c_custkey", *[m[x].alias(x) for x in "abc"])


@query("sanity_warnings", "SELECT c_custkey, array_to_string(list_filter([CASE WHEN c_acctbal < 0 THEN 'negative_revenue' END, CASE WHEN 5000.0 > c_acctbal THEN 'gross_above_revenue' END], lambda x: x IS NOT NULL), ',') AS warnings FROM customer")
def sanity_warnings(spark, sf):
    return read(spark, sf, "customer").select("c_custkey", F.array_join(G.sanity_warnings(F.col("c_acctbal"), F.lit(5000.0)), ",").alias("warnings"))
