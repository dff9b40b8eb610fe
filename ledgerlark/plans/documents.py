"""Queries on documents, pages and conversations, and on fixed markup rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import numbers as N
from ..functions import text as T
from ..operators import pages as P
from .normalising import sql_values, values
from .registry import query, read

_WS = "trim(regexp_replace(text, '[ \\t\\n\\r]+', ' ', 'g'))"


@query("text_clean", f"SELECT doc_id, md5({_WS}) AS digest, length({_WS}) AS n FROM documents")
def text_clean(spark, sf):
    c = T.clean_ws(F.col("text"))
    return read(spark, sf, "documents").select("doc_id", F.md5(c.cast("binary")).alias("digest"), F.length(c).alias("n"))


@query("first_words", f"SELECT doc_id, array_to_string(string_split({_WS}, ' ')[1:25], ' ') AS head FROM documents")
def first_words(spark, sf):
    return read(spark, sf, "documents").select("doc_id", T.first_words(F.col("text")).alias("head"))


@query("theme", "SELECT doc_id, CASE WHEN regexp_matches(lower(text), 'license|licence') THEN 'legal' WHEN contains(text, '@') THEN 'contact' WHEN contains(text, '|') THEN 'table' ELSE 'prose' END AS theme FROM documents")
def theme(spark, sf):
    t = F.col("text")
    return read(spark, sf, "documents").select("doc_id", F.when(F.lower(t).rlike("license|licence"), "legal").when(t.contains("@"), "contact").when(t.contains("|"), "table").otherwise("prose").alias("theme"))


@query("url_parts", r"""SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS host, regexp_extract(regexp_replace(url, '[?#].*$', ''), '([^/]*)/?$', 1) AS base, lower(regexp_extract(regexp_extract(regexp_replace(url, '[?#].*$', ''), '([^/]*)/?$', 1), '\.([A-Za-z0-9]+)$', 1)) AS ext FROM pages""")
def url_parts(spark, sf):
    u = F.col("url")
    return read(spark, sf, "pages").select("page_id", T.url_host(u).alias("host"), T.url_basename(u).alias("base"), T.url_ext(u).alias("ext"))


_LINKS = """l AS (SELECT page_id, i - 1 AS pos, regexp_extract(a, 'href="([^"]*)"', 1) AS href, regexp_extract(a, '>([^<]*)<', 1) AS label, regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || regexp_extract(a, 'href="([^"]*)"', 1) AS url
 FROM (SELECT page_id, url, i, xs[i] AS a FROM (SELECT page_id, url, xs, unnest(range(1, len(xs) + 1)) AS i FROM (SELECT page_id, url, regexp_extract_all(html, '<a href="([^"]*)">[^<]*</a>') AS xs FROM pages))))"""


@query("html_links", f"WITH {_LINKS} SELECT page_id, pos, href, label, url FROM l")
def html_links(spark, sf):
    return P.links(read(spark, sf, "pages"), "page_id", "html", "url")


_SCORE = "contains(lower(label), 'th')::INT + contains(lower(label), 'er')::INT + contains(lower(label), 'an')::INT"


@query("html_links_scored", f"""WITH {_LINKS}, s AS (SELECT *, CASE WHEN NOT contains(lower(label), 'zz') THEN {_SCORE} END AS score FROM l), b AS (SELECT page_id, url, max(score) AS score, arg_min(pos, (-score, pos)) AS pos FROM s WHERE score > 0 GROUP BY ALL)
SELECT page_id, url, score, pos, rank FROM (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY score DESC, pos) AS rank FROM b) WHERE rank <= 6""")
def html_links_scored(spark, sf):
    l = P.links(read(spark, sf, "pages"), "page_id", "html", "url")
    s = l.withColumn("score", P.keyword_score(F.col("label"), F.col("url"), ["th", "er", "an"], ["zz"]))
    return P.best_links(s, "page_id", "url", "score", "pos", 6)


_BARE = "html"
for _tag in ("script", "style", "noscript"):
    _BARE = f"regexp_replace({_BARE}, '(?is)<{_tag}\\b.*?</{_tag}\\s*>', '', 'g')"
_BARE = f"regexp_replace(regexp_replace({_BARE}, '(?s)<!--.*?-->', '', 'g'), '(?s)<[^>]*>', chr(10), 'g')"


@query("html_text", f"SELECT page_id, array_to_string(list_filter(list_transform(string_split({_BARE}, chr(10)), lambda x: trim(x)), lambda x: x <> ''), chr(10)) AS text FROM pages")
def html_text(spark, sf):
    return read(spark, sf, "pages").select("page_id", P.html_text(F.col("html")).alias("text"))


@query("section_slice", """SELECT doc_id, CASE WHEN length(text) >= 1000 AND length(regexp_extract(text, '(?s)^(.*?) the ', 0)) > 0 THEN substr(text, greatest(1, a - 20), a - greatest(1, a - 20) + 100) END AS part FROM (SELECT doc_id, text, instr(text, ' the ') AS a FROM documents)""")
def section_slice(spark, sf):
    return read(spark, sf, "documents").select("doc_id", P.section(F.col("text"), " the ", before=20, after=100, least=1000).alias("part"))


@query("md_useful", "SELECT doc_id, doc_id % 7 >= 5 AND doc_id % 3 <> 0 AS useful FROM documents")
def md_useful(spark, sf):
    k = F.col("doc_id")
    rows = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(6)), lambda i: F.when(i < k % 7, F.lit("| a | 12 |")).otherwise(F.lit("| a | b |"))), "\n")
    md = F.concat(F.when(k % 3 == 0, "Section not found\n").otherwise("Income\n"), rows)
    return read(spark, sf, "documents").select("doc_id", P.useful_markdown(md).alias("useful"))


@query("transcript_text", "SELECT conv_id, string_agg(role || ': ' || text, chr(10) || chr(10) ORDER BY turn, role, text) AS text FROM conversations GROUP BY conv_id")
def transcript_text(spark, sf):
    return P.turns_text(read(spark, sf, "conversations"), "conv_id", "turn", "role", "text")


_JSON = [(1, '{"a":1}', '{"a":1}'), (2, 'so: ```json\n{"a":2}\n``` done', '{"a":2}'), (3, 'x {"a":{"b":3}} y', '{"a":{"b":3}}'), (4, "nothing", None), (5, None, None)]


@query("json_recover", f"SELECT i, want AS doc FROM {sql_values([(i, w) for i, _, w in _JSON], 'i, want')}")
def json_recover(spark, sf):
    return values(spark, _JSON, "i bigint, s string, want string").select("i", T.json_recover(F.col("s")).alias("doc"))


_FACTS = [("f1", 1, "us-gaap:Revenues", "c1", "1,000", "3", None), ("f1", 2, "us-gaap:Revenues", "c2", "5", "3", None), ("f1", 3, "us-gaap:Revenues", "c1", "9", "3", None), ("f1", 4, "us-gaap:NetIncomeLoss", "c1", "(7)", "6", None), ("f1", 5, "x:Other", "c1", "1", "0", None), ("f2", 6, "ifrs-full:Revenue", "c1", "—", "0", None), ("f2", 7, "ifrs-full:Revenue", "c9", "3", "0", None), ("f2", 8, "us-gaap:NetIncomeLoss", "c1", "4", "-2", "-")]
_CTX = [("f1", "c1", "2024-12-31", False), ("f1", "c2", "2024-12-31", True), ("f2", "c1", "2023-12-31", False)]
_TAGS = [("us-gaap:Revenues", "revenue"), ("ifrs-full:Revenue", "revenue"), ("us-gaap:NetIncomeLoss", "net_income")]


def facts(spark):
    f = values(spark, _FACTS, "file string, seq bigint, tag string, context string, raw string, scale string, sgn string")
    return f.withColumn("value", N.scaled_fact(N.fact_number(F.col("raw")), F.col("scale"), F.col("sgn")))


@query("xbrl_consolidated", f"""WITH f AS (SELECT *, CASE WHEN raw = '—' THEN 0.0::DOUBLE ELSE CASE WHEN starts_with(raw, '(') THEN -1 ELSE 1 END * CAST(regexp_replace(raw, '[(),]', '', 'g') AS DOUBLE) END * CASE scale WHEN '3' THEN 1000.0::DOUBLE WHEN '6' THEN 1000000.0::DOUBLE WHEN '-2' THEN 0.01::DOUBLE ELSE 1.0::DOUBLE END AS x FROM {sql_values(_FACTS, 'file, seq, tag, context, raw, scale, sgn')})
SELECT f.file, t.concept, c.e AS period_end, arg_min(CASE WHEN sgn = '-' THEN -abs(x) ELSE x END, seq) AS value, min(seq) AS seq FROM f JOIN {sql_values(_TAGS, 'tag, concept')} t ON t.tag = f.tag JOIN {sql_values([(a, b, c, int(d)) for a, b, c, d in _CTX], 'file, context, e, seg')} c ON c.file = f.file AND c.context = f.context WHERE seg = 0 GROUP BY ALL""")
def xbrl_consolidated(spark, sf):
    c = values(spark, _CTX, "file string, context string, period_end string, has_segment boolean")
    return P.consolidated_facts(facts(spark), c, values(spark, _TAGS, "tag string, concept string"))


@query("taxonomy_label", f"SELECT file, CASE WHEN count(DISTINCT string_split(tag, ':')[1]) > 1 THEN 'mixed' ELSE min(string_split(tag, ':')[1]) END AS taxonomy FROM {sql_values(_FACTS, 'file, seq, tag, context, raw, scale, sgn')} GROUP BY file")
def taxonomy_label(spark, sf):
    return P.taxonomy(facts(spark))


@query("chart_rows", "SELECT l_orderkey, l_linenumber AS t, l_extendedprice AS close, CASE WHEN l_linenumber % 2 = 0 THEN 0 ELSE CAST(l_quantity AS BIGINT) END AS volume FROM lineitem WHERE l_linenumber <> 3")
def chart_rows(spark, sf):
    l = read(spark, sf, "lineitem")
    n = F.col("l_linenumber")
    one = F.struct("l_linenumber", F.when(n != 3, F.col("l_extendedprice")).alias("c"), F.when(n % 2 == 1, F.col("l_quantity").cast("bigint")).alias("v"))
    g = l.groupBy("l_orderkey").agg(F.collect_list(one).alias("x")).select("l_orderkey", F.col("x.l_linenumber").alias("ts"), F.col("x.c").alias("cs"), F.col("x.v").alias("vs"))
    return P.chart_rows(g, "l_orderkey", "ts", "cs", "vs")


@query("table_pairs", "SELECT n_nationkey, n_name AS name, CAST(n_regionkey AS VARCHAR) AS region FROM nation")
def table_pairs(spark, sf):
    cells = F.array(F.lit("Name"), F.lit("old"), F.lit("Region"), F.col("n_regionkey").cast("string"), F.lit("Name"), F.col("n_name"), F.lit("odd"))
    return read(spark, sf, "nation").select("n_nationkey", P.table_pairs(cells).alias("m")).select("n_nationkey", F.col("m")["Name"].alias("name"), F.col("m")["Region"].alias("region"))


_VER = [("2.1.0", True), ("2.0.9", False), ("10.0", True), ("2.1", True), ("v", False)]


@query("text_helpers", f"SELECT v, want AS ok FROM {sql_values([(a, int(b)) for a, b in _VER], 'v, want')}")
def text_helpers(spark, sf):
    return values(spark, _VER, "v string, want boolean").select("v", T.version_at_least(F.col("v"), "2.1.0").cast("int").alias("ok"))


@query("case_hash", """SELECT c_custkey, sha256('{"a":' || c_custkey || ',"b":"' || c_mktsegment || '"}') AS h FROM customer""")
def case_hash(spark, sf):
    return read(spark, sf, "customer").select("c_custkey", T.canonical_hash(["b", "a"], [F.col("c_mktsegment"), F.col("c_custkey")]).alias("h"))
