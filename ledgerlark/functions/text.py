"""Text and identifier column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_ws(s: Column) -> Column:
    return F.trim(F.regexp_replace(s, "[ \\t\\n\\r]+", " "))


def slug(s: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(s), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def first_words(s: Column, n: int = 25) -> Column:
    return F.array_join(F.slice(F.split(clean_ws(s), " "), 1, n), " ")


def url_host(url: Column) -> Column:
    return F.regexp_extract(url, "^[a-z]+://([^/?#]*)", 1)


def url_basename(url: Column) -> Column:
    return F.regexp_extract(F.regexp_replace(url, "[?#].*$", ""), "([^/]*)/?$", 1)


def url_ext(url: Column) -> Column:
    return F.lower(F.regexp_extract(url_basename(url), "\\.([A-Za-z0-9]+)$", 1))


def resolve_link(base: Column, href: Column) -> Column:
    """Absolute, scheme-relative, root-relative and plain relative links."""
    origin, folder = F.regexp_extract(base, "^([a-z]+://[^/?#]*)", 1), F.regexp_extract(F.regexp_replace(base, "[?#].*$", ""), "^([a-z]+://.*/)", 1)
    return (
        F.when(href.rlike("^[a-z]+://"), href).when(href.startswith("//"), F.concat(F.lit("https:"), href)).when(href.startswith("/"), F.concat(origin, href))
        .otherwise(F.concat(F.when(F.length(folder) > F.length(origin), folder).otherwise(F.concat(origin, F.lit("/"))), href))
    )


def type_token(s: Column) -> Column:
    """Upper-case filing type, blanks as OTHER."""
    return F.coalesce(F.nullif(F.upper(F.trim(s)), F.lit("")), F.lit("OTHER"))


def cut_footer(s: Column, marker: str) -> Column:
    """Everything before the first line that starts with marker."""
    return F.substring_index(s, f"\n{marker}", 1)


def ellipsis(s: Column, n: int) -> Column:
    return F.when(F.length(s) > n, F.concat(F.substring(s, 1, n - 3), F.lit("..."))).otherwise(s)


def duration(seconds: Column) -> Column:
    m = F.floor(seconds / 60)
    return F.when(seconds < 60, F.concat(F.floor(seconds).cast("string"), F.lit("s"))).otherwise(F.concat(m.cast("string"), F.lit("m "), F.floor(seconds - m * 60).cast("string"), F.lit("s")))


def version_at_least(v: Column, least: str) -> Column:
    """Numeric comparison of the first three dotted parts."""
    parts = F.transform(F.slice(F.split(F.concat(v, F.lit(".0.0")), "\\."), 1, 3), lambda p: F.coalesce(F.regexp_extract(p, "^\\d+", 0).try_cast("int"), F.lit(0)))
    want = [int(p) for p in (least + ".0.0").split(".")[:3]]
    return F.struct(*[F.get(parts, F.lit(i)) for i in range(3)]) >= F.struct(*[F.lit(w) for w in want])


def canonical_hash(keys: list[str], cols: list[Column]) -> Column:
    """SHA-256 of a JSON object with sorted keys."""
    order = sorted(range(len(keys)), key=lambda i: keys[i])
    return F.sha2(F.to_json(F.struct(*[cols[i].alias(keys[i]) for i in order])), 256)


def json_recover(s: Column) -> Column:
    """the object text itself, else that of a fenced block, else from the first { to the last }; null if none parses."""
    tries = [F.trim(s), F.regexp_replace(F.trim(s), r"\\(?![\"\\/bfnrtu])", r"\\\\"), F.regexp_extract(s, r"(?s)```(?:json)?\s*(\{.*?\})\s*```", 1), F.regexp_extract(s, r"(?s)(\{.*\})", 1)]
    return F.coalesce(*[F.when(F.get_json_object(t, "$").startswith("{"), t) for t in tries])


def canonical_country(s: Column) -> Column:
    t = F.upper(F.trim(s))
    return F.when(t.isin("US", "USA", "UNITED STATES", "UNITED STATES OF AMERICA"), "US").when(t.isin("UK", "GB", "UNITED KINGDOM", "GREAT BRITAIN"), "GB").otherwise(F.nullif(t, F.lit("")))


def agent_role(name: Column) -> Column:
    return F.upper(F.regexp_extract(F.lower(name), "(bull|red_team|arbitro|catalyst|forensic|implied)", 1))
