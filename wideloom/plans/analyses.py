"""Grouped, ranked, seasonal and trend analyses (Q1-Q21).

Each analysis is ``DataFrame -> DataFrame`` with the column names as parameters, because the
published data drifts between snapshots. Charts in the original become two-column frames
(label, value) here; :mod:`wideloom.sources.sinks` turns them into payloads.

Deliberate differences from the original, all in the direction of determinism: ties in every
sort/limit are broken by the label; peak/lowest ties go to the earliest month; the sample-rows
report orders explicitly instead of taking file order.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import as_date, days_in_month, iso_month_label, month_abbr_of_number, \
    yyyymm_to_label
from ..functions.text import contains_pattern, title_case
from ..operators.columns import find_column
from ..operators.reshape import column_sums, concat_same_schema, horizontal_sum, last_months, \
    long_with_dates, month_columns, null_safe_sum

WIDE_IDS = ("majortext", "minortext", "boroughname")


def _desc_then_label(value: str, label: str) -> list[Column]:
    # O2: descending with nulls first (the original's order), label as the tie-break.
    return [F.desc_nulls_first(value), F.asc_nulls_first(label)]


def _filter_equal(df: DataFrame, equals: Mapping[str, object]) -> DataFrame:
    cond = reduce(lambda a, b: a & b, [F.col(k) == F.lit(v) for k, v in equals.items()], F.lit(True))
    return df.filter(cond)


# ── Wide-table builders (Q1, Q3, Q4, Q6, Q7) ──────────────────────────────────────────────────

def monthly_totals(wide: DataFrame) -> DataFrame:
    """Q1: total of every month column across all rows -> (month ``YYYY-MM``, total)."""
    months = month_columns(wide)
    if not months:
        return wide.sparkSession.createDataFrame([], "month string, total bigint")
    sums = column_sums(wide, months, label="yyyymm", value="total")
    return (sums.select(yyyymm_to_label("yyyymm").alias("month"), F.col("total"))
                .orderBy("month"))


def _row_totals(wide: DataFrame, key: str) -> DataFrame:
    months = month_columns(wide, sort=False)
    return wide.select(key, horizontal_sum(months).alias("_row_total"))


def totals_by(wide: DataFrame, key: str, *, value: str = "total") -> DataFrame:
    """Q4 core: horizontal sum per row, then summed per ``key``; descending."""
    out = (_row_totals(wide, key).groupBy(key)
           .agg(null_safe_sum("_row_total").cast("bigint").alias(value)))
    return out.orderBy(*_desc_then_label(value, key))


def top_categories(wide: DataFrame, key: str = "majortext", k: int = 10, *,
                   label: str = "category", value: str = "total") -> DataFrame:
    """Q3: top-``k`` categories by total, labels in title case."""
    top = totals_by(wide, key, value=value).limit(k)
    return top.select(title_case(key).alias(label), F.col(value)) \
              .orderBy(*_desc_then_label(value, label))


def by_borough(wide: DataFrame, key: str = "boroughname", *, value: str = "total") -> DataFrame:
    """Q4: every place by total, descending."""
    return totals_by(wide, key, value=value)


def sample_rows(wide: DataFrame, *, major_pattern: str, place_pattern: str,
                ids: Sequence[str] = WIDE_IDS, major: str = "majortext",
                place: str = "boroughname", n_months: int = 3, n: int = 8) -> DataFrame:
    """Q6: ids + the last ``n_months`` month columns for matching rows; first ``n`` in the order
    of the published file: place, then category, then the other ids."""
    recent = last_months(wide, n_months)
    return (wide.select(*ids, *recent)
                .filter(contains_pattern(major, major_pattern) & contains_pattern(place, place_pattern))
                .orderBy(*[F.asc_nulls_first(c) for c in (place, major, *(i for i in ids if i not in (place, major)))])
                .limit(n))


def meta(spark: SparkSession, counted: Mapping[str, DataFrame | int], updated: str | DataFrame) -> DataFrame:
    """Q7: ``(item, value)`` rows: the latest month label and the row count of every dataset given, as a
    number (see :func:`wideloom.sources.catalog.footer_count`) or a frame to count. ``updated`` is a month
    ``YYYYMM`` (``""`` without month columns) or a one-row frame of it. Absent datasets are simply not
    passed (skipped, not 0)."""
    latest = updated if isinstance(updated, DataFrame) else spark.range(1).select(F.lit(updated).alias("month"))
    month = F.col(latest.columns[0])
    head = latest.select(F.lit("updated").alias("item"),
                         F.when(F.coalesce(month, F.lit("")) == "", F.lit("")).otherwise(yyyymm_to_label(month)).alias("value"))
    rows = [df.agg(F.count(F.lit(1)).cast("string").alias("value")) if isinstance(df, DataFrame)
            else spark.range(1).select(F.lit(str(df)).alias("value")) for df in counted.values()]
    return reduce(DataFrame.unionByName, [r.select(F.lit(n).alias("item"), "value") for n, r in zip(counted, rows)], head)


def latest_month(wide: DataFrame) -> str:
    """The last month column of a wide table, ``""`` without one (metadata only)."""
    return (last_months(wide, 1) or [""])[0]


# ── Long-table analyses (Q8-Q11, Q19-Q21) ─────────────────────────────────────────────────────

def wide_to_long(wide: DataFrame, ids: Sequence[str] = WIDE_IDS, **kw) -> DataFrame:
    """Q8: wide -> long with the month parsed to a DATE; null cells kept."""
    return long_with_dates(wide, list(ids), **kw)


def sum_by(long: DataFrame, key: str, *, value: str = "count", out: str = "count") -> DataFrame:
    """Q9/Q10 (A1 + O2): ``sum(value)`` per ``key`` (0 for an all-null group), descending."""
    agg = long.groupBy(key).agg(null_safe_sum(value).cast("bigint").alias(out))
    return agg.orderBy(*_desc_then_label(out, key))


def pattern_by(long: DataFrame, *, text: str, pattern: str, key: str, value: str = "count",
               ignore_case: bool = True, k: int | None = None) -> DataFrame:
    """Q11: rows whose ``text`` matches ``pattern``, summed per ``key``; optional top-k."""
    out = sum_by(long.filter(contains_pattern(text, pattern, ignore_case=ignore_case)), key,
                 value=value)
    return out.limit(k) if k else out


def full_series(historical: DataFrame, current: DataFrame,
                ids: Sequence[str] = WIDE_IDS) -> DataFrame:
    """Q19 (frame): historical and current wide files, each made long, stacked, by month and ids (the
    place is not enough: a month has thousands of rows, and ties would come in any order)."""
    return concat_same_schema(wide_to_long(historical, ids), wide_to_long(current, ids)) \
        .orderBy("month", *ids)


def series_summary(full: DataFrame, month: str = "month") -> DataFrame:
    """Q19 (report): first and last month and the row count, one pass."""
    return full.agg(F.min(month).alias("first_month"), F.max(month).alias("last_month"),
                    F.count(F.lit(1)).alias("n_rows"))


def monthly_series(full: DataFrame, month: str = "month", value: str = "count") -> DataFrame:
    """Q20: total per month over the full series, ascending."""
    return (full.groupBy(month).agg(null_safe_sum(value).cast("bigint").alias(value))
                .orderBy(month))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """Q21 (A8): distinct values of one column, null included."""
    return df.select(col).distinct()


# ── Dashboard analyses (Q2, Q12-Q15) ──────────────────────────────────────────────────────────

def knife_trend(dashboard: DataFrame, *, equals: Mapping[str, object], month: str = "month_year",
                count: str = "count", k: int = 36) -> DataFrame:
    """Q2: filtered monthly totals, the last ``k`` months, ascending; labels ``YYYY-MM``."""
    monthly = (_filter_equal(dashboard, equals).groupBy(month)
               .agg(null_safe_sum(count).cast("bigint").alias("total")))
    last = monthly.orderBy(F.desc_nulls_last(month)).limit(k)
    return last.select(iso_month_label(month).alias("month"), "total").orderBy("month")


def dashboard_monthly(dashboard: DataFrame, *, equals: Mapping[str, object],
                      month: str = "month_year", count: str = "count_of_incidents",
                      out: str = "incidents") -> DataFrame:
    """Q12: filtered monthly totals, all months, ascending."""
    return (_filter_equal(dashboard, equals).groupBy(month)
            .agg(null_safe_sum(count).cast("bigint").alias(out))
            .orderBy(F.asc_nulls_first(month)))


def peak_and_lowest(monthly: DataFrame, *, month: str = "month_year",
                    value: str = "incidents") -> DataFrame:
    """Q13 (A9): the highest and the lowest month in one aggregate pass; ties -> earliest month.
    An empty series gives no rows (monthly sums are never null, so a null value means empty)."""
    day = F.unix_date(as_date(month))
    row = F.struct(F.col(month).alias("month"), F.col(value).alias("value"))
    one = monthly.agg(
        F.max_by(row, F.struct(F.col(value), -day)).alias("peak"),
        F.min_by(row, F.struct(F.col(value), day)).alias("lowest"))
    return one.select(F.inline(F.array(
        F.struct(F.lit("peak").alias("kind"), F.col("peak.month").alias(month),
                 F.col("peak.value").alias(value)),
        F.struct(F.lit("lowest").alias("kind"), F.col("lowest.month").alias(month),
                 F.col("lowest.value").alias(value))))).filter(F.col(value).isNotNull())


def seasonality(monthly: DataFrame, *, month: str = "month_year", value: str = "incidents",
                digits: int = 4) -> DataFrame:
    """Q14: mean of ``value`` per month of year (1-12) with the English abbreviation."""
    out = (monthly.groupBy(F.month(as_date(month)).alias("month_num"))
           .agg(F.round(F.avg(value), digits).alias("avg_incidents")))
    return out.select("month_num", month_abbr_of_number("month_num").alias("month_abbr"),
                      "avg_incidents").orderBy("month_num")


def daily_rate(monthly: DataFrame, *, month: str = "month_year", value: str = "incidents",
               digits: int = 4) -> DataFrame:
    """Q15: the day-adjusted rate the notebook describes: value / days in that month."""
    days = days_in_month(month)
    return monthly.select(month, value, days.alias("days_in_month"),
                          F.round(F.col(value) / days, digits).alias("daily_rate")) \
                  .orderBy(month)


# ── Record-table analyses (Q5, Q16-Q18) ───────────────────────────────────────────────────────

def count_by(records: DataFrame, col: str, *, exclude: Sequence[str] = (), k: int | None = None,
             out: str = "stops", keep_null: bool = False) -> DataFrame:
    """A2 + P7/P8 + O2/O3: rows per value of ``col`` (minus ``exclude``), descending.
    Nulls are dropped unless ``keep_null`` (then null is a group of its own, as a plain
    ``group_by`` keeps it)."""
    cond = F.lit(True) if keep_null else F.col(col).isNotNull()
    for v in exclude:
        cond = cond & ~F.col(col).eqNullSafe(F.lit(v))   # a kept null group is not excluded
    agg = records.filter(cond).groupBy(col).agg(F.count(F.lit(1)).alias(out))
    agg = agg.orderBy(*_desc_then_label(out, col))
    return agg.limit(k) if k else agg


def stops_by_ethnicity(records: DataFrame, col: str = "ethnicappearance",
                       unknown: str = "Unknown") -> DataFrame:
    """Q5: stops per officer-defined ethnicity, nulls and ``Unknown`` excluded."""
    return count_by(records, col, exclude=(unknown,))


def top_by_fuzzy_column(records: DataFrame, *needles: str, k: int = 10) -> DataFrame | None:
    """Q16/Q17: resolve the column by name fragments (N4), then the top-``k`` values.
    Returns None when no column matches, as the original skips the chart."""
    col = find_column(records, *needles)
    if col is None:
        return None
    return count_by(records, col, k=k)


def totals_by_fuzzy_columns(df: DataFrame, type_needles: Sequence[str],
                            count_needles: Sequence[str], *, out: str = "total") -> DataFrame | None:
    """Q18: resolve a type column and a count column by name fragments, total per type."""
    type_col = find_column(df, *type_needles)
    count_col = find_column(df, *count_needles)
    if type_col is None or count_col is None:
        return None
    return sum_by(df, type_col, value=count_col, out=out)
