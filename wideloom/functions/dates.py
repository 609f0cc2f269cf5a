"""Month and date scalars (F1-F7). All are ``Column -> Column`` built-ins; no Python per row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def parse_month(c: Column | str) -> Column:
    """``YYYYMM`` -> DATE (first of month). Strict: unparseable text raises under ANSI."""
    return F.to_date(_c(c), "yyyyMM")


def try_parse_month(c: Column | str) -> Column:
    """F1, lenient: unparseable text -> null."""
    return F.try_to_date(_c(c), "yyyyMM")


def days_in_month(c: Column | str) -> Column:
    """number of days in the month of ``c``."""
    return F.day(F.last_day(as_date(c)))


def month_abbr(c: Column | str) -> Column:
    """English month abbreviation (Jan..Dec) of a date."""
    return F.date_format(as_date(c), "MMM")


def month_abbr_of_number(c: Column | str) -> Column:
    """F4 for a month number 1-12."""
    return F.date_format(F.make_date(F.lit(2000), _c(c), F.lit(1)), "MMM")


def yyyymm_to_label(c: Column | str) -> Column:
    """``YYYYMM`` -> ``YYYY-MM`` (text slicing, as the site does)."""
    c = _c(c)
    return F.concat(F.substring(c, 1, 4), F.lit("-"), F.substring(c, 5, 2))


def iso_month_label(c: Column | str) -> Column:
    """first seven characters of the text form (``YYYY-MM`` for date, timestamp or ISO text)."""
    return F.substring(_c(c).cast("string"), 1, 7)


def column_label(c: Column | str) -> Column:
    """a six-digit month name -> ``Mon YYYY``; any other name unchanged."""
    c = _c(c)
    return F.when(c.rlike(r"^\d{6}$") & F.substring(c, 5, 2).between("01", "12"),
                  F.date_format(F.to_date(c, "yyyyMM"), "MMM yyyy")).otherwise(c)


def as_date(c: Column | str) -> Column:
    """Normalise a date, timestamp or ISO text column (``month_year`` drifts between these)."""
    c = _c(c)
    return F.coalesce(F.try_to_date(c.cast("string")),
                      F.to_date(F.try_to_timestamp(c.cast("string"))))
