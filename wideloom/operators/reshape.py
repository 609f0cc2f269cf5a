"""Wide monthly tables: month-column discovery (N3), unpivot (R1, R2), same-schema union (R3),
per-column sums (A4) and null-skipping horizontal sums (A5).

A wide table has one row per (place, major category, minor category) and one count column per
month, named ``YYYYMM``. The set of month columns is data-dependent, so month selection happens on
the schema (driver metadata) and everything that touches rows stays a Spark expression.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import parse_month

# A month column is six digits (the site's rule); the builders accept any all-digit
# name (``str.isdigit``) when asked.
MONTH_PATTERN = r"^\d{6}$"
DIGITS_PATTERN = r"^\d+$"


def month_columns(df: DataFrame, pattern: str = MONTH_PATTERN, *, sort: bool = True,
                  start: str | None = None, end: str | None = None) -> list[str]:
    """Names of month columns, optionally restricted to ``start <= name <= end`` (text order)."""
    rx = re.compile(pattern)
    cols = [c for c in df.columns if rx.match(c)]
    if start is not None:
        cols = [c for c in cols if c >= start]
    if end is not None:
        cols = [c for c in cols if c <= end]
    return sorted(cols) if sort else cols


def last_months(df: DataFrame, k: int, pattern: str = MONTH_PATTERN) -> list[str]:
    """The last ``k`` month columns in text order (metadata only)."""
    cols = month_columns(df, pattern)
    return cols[-k:] if k else []


def _common_value_type(df: DataFrame, cols: Sequence[str]) -> T.DataType:
    types = {df.schema[c].dataType for c in cols}
    if len(types) == 1:
        return types.pop()
    if all(isinstance(t, (T.IntegerType, T.LongType, T.ShortType, T.ByteType)) for t in types):
        return T.LongType()
    if all(isinstance(t, T.NumericType) for t in types):
        return T.DoubleType()
    return T.StringType()


def melt(df: DataFrame, ids: Sequence[str], values: Sequence[str],
         variable: str = "month", value: str = "count") -> DataFrame:
    """Unpivot keeping null values; the variable column keeps the column name as text.

    Mixed value types are brought to one type first (Spark's unpivot refuses a long/string mix).
    """
    values = list(values)
    if not values:
        raise ValueError("melt needs at least one value column")
    vt = _common_value_type(df, values)
    src = df.select(*ids, *[F.col(c).cast(vt).alias(c) for c in values])
    return src.unpivot(list(ids), values, variable, value)


def melt_months(df: DataFrame, ids: Sequence[str], *, start: str | None = None,
                end: str | None = None, pattern: str = MONTH_PATTERN,
                variable: str = "month", value: str = "count") -> DataFrame:
    """R1 over the month columns only, choosing months by *name* before the unpivot.

    Catalyst cannot prune unpivot branches from a later ``month`` filter, so the range is applied
    to the schema here; the scan then reads only the chosen month columns.
    """
    months = month_columns(df, pattern, start=start, end=end)
    return melt(df, ids, months, variable, value)


def long_with_dates(df: DataFrame, ids: Sequence[str], *, start: str | None = None,
                    end: str | None = None, pattern: str = MONTH_PATTERN,
                    variable: str = "month", value: str = "count") -> DataFrame:
    """R2: wide table to (ids..., month DATE, count) with nulls kept."""
    long = melt_months(df, ids, start=start, end=end, pattern=pattern,
                       variable=variable, value=value)
    return long.withColumn(variable, parse_month(variable))


def concat_same_schema(*dfs: DataFrame) -> DataFrame:
    """Vertical concat that insists on identical schemas (``unionByName`` alone would widen)."""
    first = dfs[0]
    for other in dfs[1:]:
        if [(f.name, f.dataType) for f in other.schema] != [(f.name, f.dataType) for f in first.schema]:
            raise ValueError(f"schema mismatch: {first.schema.simpleString()} vs "
                             f"{other.schema.simpleString()}")
    return reduce(DataFrame.unionByName, dfs)


def horizontal_sum(cols: Sequence[Column | str]) -> Column:
    """A5: row-wise sum that skips nulls (all null -> 0).

    Built as a balanced addition tree so a 160-month historical file keeps a shallow expression
    (codegen method limits) instead of a 160-deep left fold.
    """
    terms = [F.coalesce(c if isinstance(c, Column) else F.col(c), F.lit(0)) for c in cols]
    if not terms:
        return F.lit(0).cast("bigint")
    while len(terms) > 1:
        nxt = [terms[i] + terms[i + 1] for i in range(0, len(terms) - 1, 2)]
        if len(terms) % 2:
            nxt.append(terms[-1])
        terms = nxt
    return terms[0]


def null_safe_sum(c: Column | str) -> Column:
    """A1 value: group sum where a group of only nulls gives 0, not null."""
    return F.coalesce(F.sum(c), F.lit(0))


def column_sums(df: DataFrame, cols: Sequence[str], *, label: str = "month",
                value: str = "total") -> DataFrame:
    """A4: one aggregate pass over all ``cols`` and a 1-row unpivot to (label, value)."""
    cols = list(cols)
    sums = df.agg(*[null_safe_sum(c).cast("bigint").alias(c) for c in cols])
    return sums.unpivot([], cols, label, value)
