"""Dates and ages."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from laptrace.functions.lookups import none_if_blank
from laptrace.vocab import MONTHS

_MONTH = "(?:" + "|".join(MONTHS) + ")[a-z]*"
# A day or a range of days in running text, in the shapes ``race_date`` reads: the month first, with a
# second day or a second month and day behind a dash, or the day first.
_DASH = r"\s*[–\-]\s*"
# The first character is looked at before any word border.
TEXT_DATE = (
    rf"(?=[{''.join(sorted({m[0] for m in MONTHS}))}\d])(?:\b{_MONTH}\.?\s+\d{{1,2}}(?:{_DASH}(?:{_MONTH}\.?\s+)?\d{{1,2}})?,?\s+\d{{4}}\b"
    rf"|\b\d{{1,2}}\s+{_MONTH}\.?,?\s+\d{{4}}\b)"
)
# fixed values: accepted shapes besides ISO, each with its ISO or ``Mon d yyyy`` rewriting
_MONTH_FIRST = (r"^.*?([A-Za-z]{3})[A-Za-z]*\.?\s+(\d{1,2})(?!\d).*?(\d{4}).*$", "$1 $2 $3")
_DAY_FIRST = (r"^(\d{1,2})\s+([A-Za-z]{3})[A-Za-z]*\.?,?\s+(\d{4})$", "$2 $1 $3")
_NUMERIC = [
    (r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3"),
    (r"^(\d{4})/(\d{1,2})/(\d{1,2})$", "$1-$2-$3"),
    (r"^(1[3-9]|2\d|3[01])/(\d{1,2})/(\d{4})$", "$3-$2-$1"),
    (r"^(\d{1,2})/(\d{1,2})/(\d{4})$", "$3-$1-$2"),
]


def _rewritten(text: Column, *rules: tuple[str, str]) -> Column:
    for pattern, form in rules:
        text = F.regexp_replace(text, pattern, form)
    return text


def race_date(text: Column) -> Column:
    """First day of a date or date range; null when the text is no real calendar day.

    The common shapes are told apart by a cheap test, so that a row meets one parser
    only: month-name dates (single day or range, short or long month) as ``Mon d yyyy``,
    the rest as ISO dates.
    """
    t = F.trim(text)
    return (
        F.when(t.rlike(r"^\d{4}-\d{1,2}-\d{1,2}"), t.try_cast("date"))
        .when(t.rlike("[A-Za-z]{3}"), F.try_to_date(_rewritten(t, _DAY_FIRST, _MONTH_FIRST), "MMM d yyyy"))
        .when(t.rlike(r"\d"), _rewritten(t, *_NUMERIC).try_cast("date"))
    )


def birth_date(text: Column) -> Column:
    """``yyyy-MM-dd``, or a bare year taken as the first of January."""
    year_only = F.regexp_replace(F.trim(text), r"^(\d{4})$", "$1-01-01")
    return race_date(year_only)


def completed_years(born: Column, at: Column) -> Column:
    """Whole years lived on a day, never below zero; null when either date is unknown."""
    before_birthday = (F.month(at) * 100 + F.dayofmonth(at)) < (F.month(born) * 100 + F.dayofmonth(born))
    years = F.year(at) - F.year(born) - before_birthday.cast("int")
    # greatest() alone would turn an unknown age into zero
    return F.when(born.isNotNull() & at.isNotNull(), F.greatest(F.lit(0), years))


def first_date_text(text: Column) -> Column:
    """First month-name date or date range found in running text, as written."""
    return none_if_blank(F.regexp_extract(text, f"({TEXT_DATE})", 1))
