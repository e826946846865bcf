"""Column -> Column functions with the missing-value, date, text and rounding rules of the replaced tools."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Month names of the reporting calendar (fixed values).
MONTHS_FR = ("janvier", "février", "mars", "avril", "mai", "juin", "juillet", "août", "septembre", "octobre", "novembre", "décembre")


def missing_lt(c: Column, bound) -> Column:
    """Missing sorts below every number: true when ``c`` is null or less."""
    return c.isNull() | (c < bound)


def completed_years(birth: Column, at: Column) -> Column:
    """Whole years lived; a birthday not reached takes one off (29 February is not reached on the 28th)."""
    key = lambda d: F.month(d) * 100 + F.dayofmonth(d)
    return F.year(at) - F.year(birth) - F.when(key(at) < key(birth), 1).otherwise(0)


def propcase(c: Column) -> Column:
    """Lower case, then a capital after each blank and hyphen; doubled blanks stay."""
    part = lambda x: F.concat(F.upper(F.left(x, F.lit(1))), F.substring(x, 2, 1 << 30))
    words = lambda x, sep: F.array_join(F.transform(F.split(x, sep), part), sep)
    by_blank = words(F.lower(F.trim(c)), " ")
    return F.array_join(F.transform(F.split(by_blank, "-"), part), "-")


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def safe_div(a: Column, b: Column) -> Column:
    """a / b, null where b is zero or null."""
    return a / F.nullif(b, F.lit(0).cast("double"))


def days_between(a: Column, b: Column) -> Column:
    return F.datediff(b, a).cast("bigint")


def date_id(d: Column) -> Column:
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("bigint")


def year_month(d: Column) -> Column:
    return F.date_format(d, "yyyyMM")


def iso_weekday(d: Column) -> Column:
    """1 Monday to 7 Sunday."""
    return (F.pmod(F.dayofweek(d) + 5, F.lit(7)) + 1).cast("bigint")


def month_name(d: Column) -> Column:
    return F.element_at(F.array(*[F.lit(m) for m in MONTHS_FR]), F.month(d))


def surrogate_key(*parts: Column) -> Column:
    """md5 over the parts' text joined by '|'; give timestamps an explicit format first."""
    return F.md5(F.concat_ws("|", *[p.cast("string") for p in parts]))


def decode(c: Column, default, **cases) -> Column:
    """Value by equality; the default also takes null."""
    out = None
    for k, v in cases.items():
        out = F.when(c == k, F.lit(v)) if out is None else out.when(c == k, F.lit(v))
    return out.otherwise(F.lit(default)) if out is not None else F.lit(default)


def batch_number(file_name: Column) -> Column:
    """Number in batch_NNN.csv; null for other names."""
    return F.regexp_extract(file_name, r"batch_(\d+)", 1).try_cast("int")


def tight_trim(c: Column) -> Column:
    """Trims, and makes inner blanks single."""
    return F.regexp_replace(F.trim(c), " +", " ")
