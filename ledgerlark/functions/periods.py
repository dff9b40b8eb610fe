"""Dates and fiscal-period labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def loose_date(s: Column) -> Column:
    """ISO, `Mon d, yyyy` or `d Mon yyyy`; null for anything else."""
    t = F.trim(s)
    return F.coalesce(*[F.try_to_timestamp(t, F.lit(f)).cast("date") for f in ("yyyy-MM-dd", "MMM d, yyyy", "d MMM yyyy")])


def period_kind(label: Column) -> Column:
    """primary, partial or rejected; labels of no known form are primary.  Order of the tests matters."""
    t = F.upper(F.trim(label))
    return (
        F.when(t.rlike(r"GUIDANCE|^\d{4}E$|^AS_OF_|^UNKNOWN$"), "rejected")
        .when(t.rlike(r"YTD|^[69]M-?\d{4}|^H[12]-?\d{4}"), "partial")
        .otherwise("primary")
    )


def canonical_period(label: Column) -> Column:
    """Q1-24, 1Q24, Q1 FY2024, FY24 ... to Qn-yyyy or FYyyyy; null if unrecognised."""
    t = F.upper(F.trim(label))
    q = F.coalesce(F.nullif(F.regexp_extract(t, r"^Q([1-4])[- ]?(?:FY)?'?\d{2,4}$", 1), F.lit("")), F.nullif(F.regexp_extract(t, r"^([1-4])Q'?\d{2,4}$", 1), F.lit("")))
    y = F.regexp_extract(t, r"(\d{2,4})$", 1)
    year = F.when(F.length(y) == 2, F.concat(F.lit("20"), y)).when(F.length(y) == 4, y)
    return F.when(q.isNotNull(), F.concat(F.lit("Q"), q, F.lit("-"), year)).when(t.rlike(r"^FY ?'?\d{2,4}$"), F.concat(F.lit("FY"), year))


def period_end(end: Column, label: Column) -> Column:
    """Chronological key: the given end, else a quarter's last day, else 31 December of a fiscal year."""
    q = F.regexp_extract(label, r"^Q([1-4])-(\d{4})$", 1).try_cast("int")
    y = F.regexp_extract(label, r"(\d{4})$", 1).try_cast("int")
    return F.coalesce(end, F.when(q.isNotNull(), F.last_day(F.make_date(y, q * 3, F.lit(1)))), F.when(label.rlike(r"^FY\d{4}$"), F.make_date(y, F.lit(12), F.lit(31))))


def period_label(kind: Column, end: Column) -> Column:
    """FYyyyy for annual (A), Qn-yyyy for quarterly rows."""
    y = F.year(end).cast("string")
    return F.when(kind == "A", F.concat(F.lit("FY"), y)).otherwise(F.concat(F.lit("Q"), F.quarter(end).cast("string"), F.lit("-"), y))


def period_rank(label: Column) -> Column:
    """(year, quarter) as one integer, fiscal years as their fourth quarter, else 0."""
    q, y = F.regexp_extract(label, r"^Q([1-4])-(\d{4})$", 1), F.regexp_extract(label, r"(\d{4})$", 1).try_cast("int")
    return F.when(q != "", y * 10 + q.try_cast("int")).when(label.rlike(r"^FY\d{4}$"), y * 10 + 4).otherwise(0)


def label_year(s: Column) -> Column:
    return F.regexp_extract(s, r"((?:19|20)\d{2})", 1).try_cast("int")
