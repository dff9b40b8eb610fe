"""Personal data by pattern, checksum and context (operator 8), in DataFrame functions only.

Patterns propose spans, validators confirm them (octet range, Luhn, mod-97, digit counts, mixed letters
and digits), and words near a span raise its score: those in the last REACH code points between the match
before the previous one and the span, or in the first REACH between it and the match after the next.
Base kinds stay whatever their score; added kinds need min_score, which secrets and social security
numbers only reach beside such a word.  Offsets are code points: the pieces between matches and the
matches are measured and summed in blocks, so the cost grows with a text's length, not with the square
of its number of spans.  Patterns use possessive loops and context anchors, so that their cost and stack
depth stay bounded on long texts; each finds exactly the leftmost, non-overlapping matches of the plain
pattern in its comment.

Defined results: a null text is empty and has no spans; rows are judged one by one, repeats included, in
whatever number; an empty table gives no rows; other columns may have any names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .decontaminate import ascii_lower

_LOCAL, _LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
#: kind: (cheap test that some match may stand in the text, pattern)
PATTERNS = {
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    "email": ("@", rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_LABEL}++(?:\.{_LABEL}++)++"),
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    "ip": (r"[0-9]\.[0-9]", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"),
    # [0-9]([\x20-]?[0-9])+ of 14 to 19 digits: a whole run of digits and single separators
    "card": (r"[0-9](?:[ -]?[0-9]){13}", r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){13,18}(?![ -]?[0-9])"),
    # \+[0-9][\x20().0-9-]+[0-9]
    "phone": ("+", r"\+[0-9][ ().0-9-]+[0-9]"),
    # [A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}
    "iban": (r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11}", r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}"),
    # [0-9A-Fa-f]{32,64}
    "secret": (r"[0-9A-Fa-f]{32}", r"[0-9A-Fa-f]{32,64}"),
    # AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abprs]-[A-Za-z0-9-]{10,48}
    "key": (r"AKIA|gh[pousr]_|xox[abprs]-", r"AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abprs]-[A-Za-z0-9-]{10,48}"),
    # [0-9]{3}-[0-9]{2}-[0-9]{4}
    "ssn": (r"[0-9]{3}-[0-9]{2}-[0-9]{4}", r"[0-9]{3}-[0-9]{2}-[0-9]{4}"),
}
KINDS = tuple(PATTERNS)
BASE_KINDS = ("email", "ip", "card", "phone")
#: kind: (score of a confirmed span, what a word nearby adds, those words)
SCORES = {
    "email": (0.9, 0.1, "mail|e-mail|contact"),
    "ip": (0.6, 0.1, "ip|host|server"),
    "card": (0.8, 0.1, "card|visa|credit|karte|carte|tarjeta"),
    "phone": (0.7, 0.1, "phone|tel|call|fax"),
    "iban": (0.75, 0.1, "iban|account|konto|compte|cuenta"),
    "secret": (0.5, 0.3, "token|secret|key|apikey|api|password|passwd|auth|bearer"),
    "key": (0.8, 0.1, "key|token|aws|github|slack"),
    "ssn": (0.5, 0.3, "ssn|social|security"),
}
REACH, BLOCK, CUT = 40, 64, 256


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    def step(acc, i):
        d = F.substring(digits, F.length(digits) - i + 1, F.lit(1)).cast("int")
        twice = d * 2
        return acc + F.when(i % 2 == 0, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), step) % 10 == 0


def mod97(account: Column) -> Column:
    turned = F.concat(F.substring(account, F.lit(5), F.length(account)), F.substring(account, 1, 4))

    def step(acc, i):
        c = F.ascii(F.substring(turned, i, F.lit(1)))
        return F.when(c < 58, (acc * 10 + c - 48) % 97).otherwise((acc * 100 + c - 55) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), step) == 1


def valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        octet = "0*(?:[0-9]|[1-9][0-9]|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
        return m.rlike(rf"^{octet}(?:\.{octet}){{3}}$")
    if kind == "card":
        return luhn(_digits(m))
    if kind == "phone":
        return F.length(_digits(m)).between(10, 15)
    if kind == "iban":
        return mod97(m)
    if kind == "secret":
        return m.rlike("[0-9]") & m.rlike("[A-Fa-f]")
    if kind == "ssn":
        return ~m.rlike("^(?:000|666|9)")
    return F.lit(True)


SPAN = "array<struct<start: int, end: int, rank: int, kind: string, score: double>>"


def _running(values: Column, start: Column, step) -> Column:
    """What step makes of start and all values before each value, in blocks of BLOCK and then across blocks."""
    blocks = F.sequence(F.lit(0), F.floor((F.size(values) - 1) / BLOCK).cast("int"))
    block = lambda b: F.slice(values, b * BLOCK + 1, F.lit(BLOCK))

    def along(items: Column, first: Column, of) -> Column:
        begin = F.struct(first.alias("at"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(items, begin, lambda a, x: F.struct(of(a["at"], x).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out")))["out"]

    whole = F.transform(blocks, lambda b: F.aggregate(block(b), start, step))
    heads = along(whole, start, step)
    return F.when(F.size(values) > 0, F.flatten(F.zip_with(blocks, heads, lambda b, h: along(block(b), h, step)))).otherwise(F.array().cast("array<int>"))


def _add_spans(df: DataFrame, text: str, kinds, min_score: float, out: str) -> DataFrame:
    """df with `out`: the confirmed spans of all kinds with their scores, in order of start, then of kind."""
    none = F.array().cast("array<struct<gap: int, size: int, head: string, tail: string, m: string>>")
    found = {}
    for kind in kinds:
        hint, pattern = PATTERNS[kind]
        may = F.col(text).contains(hint) if kind in ("email", "phone") else F.col(text).rlike(hint)
        piece = lambda p, m: F.struct(F.length(p).alias("gap"), F.coalesce(F.length(m), F.lit(0)).alias("size"), F.left(p, F.lit(REACH)).alias("head"), F.right(p, F.lit(REACH)).alias("tail"), m.alias("m"))
        pieces = F.zip_with(F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), piece)
        found[f"{out}_p_{kind}"] = F.when(may, pieces).otherwise(none)
    df = df.withColumns(found)
    df = df.withColumns({f"{out}_l_{k}": F.transform(f"{out}_p_{k}", lambda x: x["gap"] + x["size"]) for k in kinds})
    df = df.withColumns({f"{out}_a_{k}": _running(F.col(f"{out}_l_{k}"), F.lit(0), lambda a, x: a + x) for k in kinds})
    all_ = []
    for kind in kinds:
        pieces, base, more, words = F.col(f"{out}_p_{kind}"), *SCORES[kind]
        near = rf"(?:^|[^a-z])(?:{words})(?:[^a-z]|$)"

        def span(kind=kind, pieces=pieces, base=base, more=more, near=near):
            def made(x, i):
                start = F.get(F.col(f"{out}_a_{kind}"), i) + x["gap"]
                before = F.right(F.concat(F.coalesce(F.get(pieces, i - 1)["m"], F.lit("")), x["tail"]), F.lit(REACH))
                next_ = F.get(pieces, i + 1)
                after = F.left(F.concat(F.coalesce(next_["head"], F.lit("")), F.when(next_["gap"] < REACH, F.coalesce(next_["m"], F.lit(""))).otherwise(F.lit(""))), F.lit(REACH))
                score = F.when(ascii_lower(before).rlike(near) | ascii_lower(after).rlike(near), F.lit(base + more)).otherwise(F.lit(base))
                good = x["m"].isNotNull() & valid(kind, x["m"])
                one = F.struct(start.alias("start"), (start + x["size"]).alias("end"), F.lit(KINDS.index(kind)).alias("rank"), F.lit(kind).alias("kind"), score.alias("score"))
                return F.when(good & (F.lit(kind in BASE_KINDS) | (score >= min_score)), one)

            return made

        all_.append(F.filter(F.transform(pieces, span()), lambda s: s.isNotNull()))
    return df.withColumn(out, F.array_sort(F.concat(*all_)).cast(SPAN)).drop(*[f"{out}_{x}_{k}" for x in "pla" for k in kinds])


def find_pii(docs: DataFrame, kinds=KINDS, min_score: float = 0.7) -> DataFrame:
    """(doc_id, text, spans): every row with its spans in order of start, then of kind."""
    df = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return _add_spans(df, "text", kinds, min_score, "spans")


def redact(docs: DataFrame, kinds=KINDS, min_score: float = 0.7) -> DataFrame:
    """docs with every span's text replaced by its kind in brackets, overlapping spans as one; other columns unchanged.

    A null text stays null.  The text is cut at every CUT-th span first and each part at its own spans.
    """
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("body"))
    df = _add_spans(packed, "body", kinds, min_score, "spans")
    df = df.withColumn("ends", F.transform("spans", lambda s: s["end"]))
    df = df.withColumn("done", _running(F.col("ends"), F.lit(0), lambda a, x: F.greatest(a, x)))  # up to where the text is dealt with before each span
    gap = lambda s, d: F.struct(d.alias("from"), s["start"].alias("to"), s["kind"].alias("kind"))
    df = df.withColumn("gaps", F.filter(F.zip_with("spans", "done", gap), lambda g: g["to"] >= g["from"]))
    firsts = F.when(F.size("gaps") > 0, F.sequence(F.lit(1), F.size("gaps"), F.lit(CUT))).otherwise(F.array().cast("array<int>"))
    df = df.withColumn("parts", F.transform(firsts, lambda i: F.slice("gaps", i, F.lit(CUT))))
    with_text = lambda p: F.struct(p.alias("p"), F.get(p, F.lit(0))["from"].alias("at"), F.substring(F.col("body"), F.get(p, F.lit(0))["from"] + 1, F.get(p, F.size(p) - 1)["to"] - F.get(p, F.lit(0))["from"]).alias("t"))
    df = df.withColumn("parts", F.transform("parts", with_text))
    cut = lambda x: F.array_join(F.transform(x["p"], lambda g: F.concat(F.substring(x["t"], g["from"] - x["at"] + 1, g["to"] - g["from"]), F.lit("["), F.upper(g["kind"]), F.lit("]"))), "")
    body = F.concat(F.array_join(F.transform("parts", cut), ""), F.substring(F.col("body"), F.array_max("ends") + 1, F.length("body")))
    text = F.when(F.col("row.text").isNull() | (F.size("spans") == 0), F.col("row.text")).otherwise(body)
    return df.select(*[text.alias("text") if c == "text" else F.col(f"row.`{c}`") for c in docs.columns])


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _of_kind(kind: str) -> Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(table(spark, sf_dir, "documents"))
    counts = [_of_kind(k) for k in BASE_KINDS]
    base = F.filter("spans", lambda s: s["rank"] < len(BASE_KINDS))
    return found.select("doc_id", *counts, F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"), F.size("spans").cast("bigint").alias("n_spans"))


def spans_sql(source: str) -> str:
    plain = {
        "email": "[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+",
        "ip": "[0-9]+(\\.[0-9]+)(\\.[0-9]+)(\\.[0-9]+)",
        "card": "[0-9]([\\x20-]?[0-9])+",
        "phone": "\\+[0-9][\\x20().0-9-]+[0-9]",
        "iban": "[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}",
        "secret": "[0-9A-Fa-f]{32,64}",
        "key": "AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abprs]-[A-Za-z0-9-]{10,48}",
        "ssn": "[0-9]{3}-[0-9]{2}-[0-9]{4}",
    }
    digits = "regexp_replace(m, '[^0-9]', '', 'g')"
    luhn_sum = f"list_sum(list_transform(range(1, length({digits}) + 1), lambda i: CASE WHEN i % 2 = 0 THEN (CASE WHEN 2 * substr({digits}, length({digits}) - i + 1, 1)::INT > 9 THEN 2 * substr({digits}, length({digits}) - i + 1, 1)::INT - 9 ELSE 2 * substr({digits}, length({digits}) - i + 1, 1)::INT END) ELSE substr({digits}, length({digits}) - i + 1, 1)::INT END))"
    numeric = "list_aggregate(list_transform(range(1, length(m) + 1), lambda i: CASE WHEN ascii(substr(substr(m, 5) || substr(m, 1, 4), i, 1)) < 58 THEN substr(substr(m, 5) || substr(m, 1, 4), i, 1) ELSE (ascii(substr(substr(m, 5) || substr(m, 1, 4), i, 1)) - 55)::VARCHAR END), 'string_agg', '')"
    test = {
        "email": "true",
        "ip": "list_bool_and(list_transform(string_split(m, '.'), lambda p: length(ltrim(p, '0')) <= 3 AND coalesce(try_cast(ltrim(p, '0') AS INT), 0) <= 255))",
        "card": f"length({digits}) BETWEEN 14 AND 19 AND {luhn_sum} % 10 = 0",
        "phone": f"length({digits}) BETWEEN 10 AND 15",
        "iban": f"list_reduce(list_prepend(0::HUGEINT, list_transform(string_split({numeric}, ''), lambda c: c::HUGEINT)), lambda a, c: (a * 10 + c) % 97) = 1",
        "secret": "regexp_matches(m, '[0-9]') AND regexp_matches(m, '[A-Fa-f]')",
        "key": "true",
        "ssn": "NOT regexp_matches(m, '^(?:000|666|9)')",
    }
    low = lambda x: f"translate({x}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    parts = []
    for rank, kind in enumerate(KINDS):
        base, more, words = SCORES[kind]
        near = f"'(?:^|[^a-z])(?:{words})(?:[^a-z]|$)'"
        before = f"right(coalesce(ms[i - 1], '') || right(ps[i], {REACH}), {REACH})"
        after = f"left(left(ps[i + 1], {REACH}) || CASE WHEN length(ps[i + 1]) < {REACH} THEN coalesce(ms[i + 1], '') ELSE '' END, {REACH})"
        enough = "true" if kind in BASE_KINDS else f"CASE WHEN near THEN {base + more} ELSE {base} END >= 0.7"
        parts.append(f"""SELECT rid, '{kind}' AS kind, {rank} AS rank, s, s + length(m) AS e FROM (
  SELECT rid, ms[i] AS m, list_sum(list_transform(ps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0) AS s,
    regexp_matches({low(before)}, {near}) OR regexp_matches({low(after)}, {near}) AS near
  FROM (SELECT rid, ps, ms, unnest(range(1, len(ms) + 1)) AS i FROM (
    SELECT rid, regexp_split_to_array(text, '{plain[kind]}') AS ps, regexp_extract_all(text, '{plain[kind]}') AS ms FROM d))) WHERE {test[kind]} AND {enough}""")
    return f"""WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM {source}),
f AS ({' UNION ALL '.join(parts)}),
g AS (SELECT rid, {', '.join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in BASE_KINDS)},
  string_agg(kind || ':' || s::BIGINT || ':' || e::BIGINT, ',' ORDER BY s, rank) FILTER (rank < {len(BASE_KINDS)}) AS base,
  string_agg(kind || ':' || s::BIGINT || ':' || e::BIGINT, ',' ORDER BY s, rank) AS spans, count(*) AS n_spans FROM f GROUP BY rid)
SELECT doc_id, {', '.join(f'coalesce(n_{k}, 0) AS n_{k}' for k in BASE_KINDS)}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_spans, 0) AS n_spans
FROM d LEFT JOIN g ON g.rid = d.rid"""


OP8_SQL = spans_sql("documents")
