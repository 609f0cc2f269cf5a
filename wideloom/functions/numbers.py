"""Number scalars: humanised labels (F12-F14), defaults."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def _plain(n: Column) -> Column:
    # Whole numbers print without a fraction, as String(n) does for integers.
    return F.when(n == F.floor(n), F.floor(n).cast("bigint").cast("string")).otherwise(n.cast("string"))


def humanise(c: Column | str) -> Column:
    """>= 1e6 -> ``1.3M``; >= 1e3 -> ``411K``; else the number itself.

    Rounding is half-up on the decimal value (Java's formatter), see SURVEY F14 for where
    this differs from the site's binary rounding.
    """
    n = _c(c).cast("double")
    return (F.when(n >= 1e6, F.concat(F.format_string("%.1f", n / 1e6), F.lit("M")))
             .when(n >= 1e3, F.concat(F.format_string("%.0f", n / 1e3), F.lit("K")))
             .otherwise(_plain(n)))


def axis_label(c: Column | str) -> Column:
    """chart-axis variant with one decimal between 1e3 and 1e4 (``1.5K``)."""
    n = _c(c).cast("double")
    return (F.when(n >= 1e6, F.concat(F.format_string("%.1f", n / 1e6), F.lit("M")))
             .when(n >= 1e4, F.concat(F.format_string("%.0f", n / 1e3), F.lit("K")))
             .when(n >= 1e3, F.concat(F.format_string("%.1f", n / 1e3), F.lit("K")))
             .otherwise(_plain(n)))


def thousands_label(c: Column | str) -> Column:
    """the notebook's tick format ``{x/1e3:.0f}K`` (no M step)."""
    return F.concat(F.format_string("%.0f", _c(c).cast("double") / 1e3), F.lit("K"))


def zero_if_null(c: Column | str) -> Column:
    """F20 for numbers: ``x || 0``."""
    return F.coalesce(_c(c), F.lit(0))
