"""Text scalars (F8-F10, F15, F16, F18; F17 is in :mod:`wideloom.functions.urls`). ``Column -> Column`` built-ins only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return c if isinstance(c, Column) else F.col(c)


# The characters Python's ``str.title`` treats as cased (Unicode Lowercase,
# Uppercase and Titlecase properties).
CASED = r"\p{IsLowercase}\p{IsUppercase}\p{IsTitlecase}"


def title_case(c: Column | str) -> Column:
    """F8: Python ``str.title()`` semantics.

    A run of cased letters starts in title case and continues in lower case; any other character
    (space, hyphen, apostrophe, digit, uncased letter) ends the run. So ``DRUG-OFFENCES`` ->
    ``Drug-Offences``, ``WOMEN'S`` -> ``Women'S``, ``2ND class`` -> ``2Nd Class``. Spark's
    ``initcap`` only starts words after spaces, so the text is cut into cased / uncased runs and
    ``initcap`` (full Unicode title-casing: ``ß`` -> ``Ss``) is applied per run.
    """
    runs = F.regexp_extract_all(_c(c), F.lit(f"([{CASED}]+|[^{CASED}]+)"), 1)
    return F.array_join(F.transform(runs, lambda s: F.initcap(s)), "")


def contains_pattern(c: Column | str, pattern: str, *, ignore_case: bool = False) -> Column:
    """Regex *search* (not full match); null stays null."""
    return _c(c).rlike(("(?i)" if ignore_case else "") + pattern)


def ends_with_any(c: Column | str, suffixes: Sequence[str]) -> Column:
    """case-insensitive ``endswith`` over several suffixes."""
    low = F.lower(_c(c))
    out = F.lit(False)
    for s in suffixes:
        out = out | low.endswith(s.lower())
    return out


def find_all(c: Column | str, pattern: str, group: int = 0) -> Column:
    """all matches of ``pattern`` in order; ``group`` selects a capture group."""
    return F.regexp_extract_all(_c(c), F.lit(pattern), group)


def ordered_distinct(arr: Column) -> Column:
    """de-duplicate an array keeping first-seen order."""
    return F.array_distinct(arr)


def empty_if_null(c: Column | str) -> Column:
    """null -> ``""`` (the table preview's ``?? ""``)."""
    return F.coalesce(_c(c).cast("string"), F.lit(""))


def default_if_blank(c: Column | str, default: str) -> Column:
    """F20 for text: null or ``""`` -> ``default``."""
    return F.coalesce(F.nullif(_c(c).cast("string"), F.lit("")), F.lit(default))
