"""Dates of statements and identity papers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Local month abbreviations of two countries, January first.
MONTHS = {
    "en": ["JAN", "FEB", "MAR", "APR", "MAY", "JUN", "JUL", "AUG", "SEP", "OCT", "NOV", "DEC"],
    "km": ["JAN", "FEV", "MARS", "AVR", "MEI", "JUNE", "JULY", "AUG", "SEPT", "OCT", "NOV", "DEC"],
    "nl": ["JAN", "FEB", "MAA", "APR", "MEI", "JUN", "JUL", "AUG", "SEP", "OKT", "NOV", "DEC"],
}


def month_ends(start: Column, n: Column) -> Column:
    """ARRAY of n month ends, the first on or after the start date."""
    return F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.last_day(F.add_months(start, i)))


def same_day_last_year(d: Column) -> Column:
    return F.add_months(d, -12)


def expiry(issue: Column, years: Column) -> Column:
    return F.add_months(issue, (years * 12).cast("int"))


def month_name(d: Column, lang: str) -> Column:
    return F.element_at(F.array(*[F.lit(m) for m in MONTHS[lang]]), F.month(d))


def passport_date(d: Column) -> Column:
    """``dd MON yyyy``; spelled out from parts, so the session's locale has no say."""
    return F.concat_ws(" ", F.lpad(F.dayofmonth(d).cast("string"), 2, "0"), month_name(d, "en"), F.year(d).cast("string"))


def bilingual_date(d: Column, lang: str, mode: str) -> Column:
    """Local month after the English one (``insert``) or in its place (``replace``)."""
    day, year = F.lpad(F.dayofmonth(d).cast("string"), 2, "0"), F.year(d).cast("string")
    if mode == "insert":
        return F.concat_ws(" ", day, month_name(d, "en"), F.concat(F.lit("/"), month_name(d, lang)), year)
    return F.concat_ws(" ", day, month_name(d, lang), year)
