"""The registered queries: each derives its input from the driver tables (``plans.shapes``) and
runs one analysis or operator over the whole input. ``ORACLE`` holds the independent DuckDB SQL
for the same result (column names aliased identically).

Parameters below are fixed values chosen against the driver tables' vocabulary (``p_type``,
``p_name``, ``n_name``, order status / priority, customer segment); they play the roles of the
original's ``VIOLENCE`` / borough list / ``Knife Crime`` filters.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.catalog import footer_count
from . import analyses as A
from . import shapes as S

# Filter parameters for the driver-table stand-ins.
DASHBOARD_TREND = {"area_type": "F", "measure": "BUILDING", "crime_type": "1-URGENT"}
DASHBOARD_MONTHLY = {"crime_type": "1-URGENT", "area_type": "F"}
SAMPLE_MAJOR = "PROMO"
SAMPLE_PLACES = "NATION_3|NATION_7|NATION_12|NATION_18|NATION_24"
WEAPON_PATTERN = "bolt|gear|ring"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


# ── oracle building blocks ────────────────────────────────────────────────────────────────────

_BASE_SELECT = """
  SELECT p.p_type AS majortext, p.p_name AS minortext, n.n_name AS boroughname,
         strftime(l.l_shipdate, '%Y%m') AS ym, CAST(l.l_quantity AS BIGINT) AS qty
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey"""
_BASE = "\nbase AS (" + _BASE_SELECT + ")"

# Long form of the wide table: every (key, month) cell, null where the key had no rows.
_CELLS = _BASE + """,
keys AS (SELECT DISTINCT majortext, minortext, boroughname FROM base),
months AS (SELECT DISTINCT ym FROM base),
agg AS (SELECT majortext, minortext, boroughname, ym, SUM(qty) AS s FROM base GROUP BY ALL),
cells AS (
  SELECT k.majortext, k.minortext, k.boroughname, m.ym, CAST(a.s AS BIGINT) AS cnt
  FROM keys k CROSS JOIN months m
  LEFT JOIN agg a ON a.majortext = k.majortext AND a.minortext = k.minortext
                 AND a.boroughname = k.boroughname AND a.ym = m.ym)"""

_CURRENT_CUT = "(SELECT ym FROM (SELECT DISTINCT ym FROM base) ORDER BY ym DESC LIMIT 1 OFFSET 23)"

_DASH = """
dash AS (
  SELECT o.o_orderstatus AS area_type, n.n_name AS area_name, c.c_mktsegment AS measure,
         o.o_orderpriority AS crime_type, CAST(date_trunc('month', o.o_orderdate) AS DATE) AS month_year,
         COUNT(*) AS count
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  GROUP BY ALL)"""

_RECORDS = """
rec AS (
  SELECT event_id, ts, user_id,
         CASE WHEN event_type = 'error' THEN NULL WHEN event_type = 'view' THEN 'Unknown'
              ELSE event_type END AS ethnicappearance,
         CASE WHEN event_type <> 'signup' THEN json_extract_string(props, '$.k') END AS legislation,
         strftime(ts, '%A') AS outcome
  FROM events)"""

_MONTHLY = _DASH + """,
monthly AS (
  SELECT month_year, CAST(SUM(count) AS BIGINT) AS incidents FROM dash
  WHERE crime_type = '1-URGENT' AND area_type = 'F' GROUP BY month_year)"""


# ── wide table (Q1, Q3, Q4, Q6, Q7) ───────────────────────────────────────────────────────────

@register("q01_monthly_totals", "WITH" + _BASE + """
SELECT substr(ym, 1, 4) || '-' || substr(ym, 5, 2) AS month, CAST(SUM(qty) AS BIGINT) AS total
FROM base GROUP BY ym ORDER BY month""")
def q01(spark, sf_dir):
    return A.monthly_totals(S.crime_wide(spark, sf_dir))


@register("q03_top_categories", "WITH" + _BASE + """
SELECT upper(substr(majortext, 1, 1)) || lower(substr(majortext, 2)) AS category, total FROM (
  SELECT majortext, CAST(SUM(qty) AS BIGINT) AS total FROM base GROUP BY majortext
  ORDER BY total DESC, majortext LIMIT 10)""")
def q03(spark, sf_dir):
    return A.top_categories(S.crime_wide(spark, sf_dir))


@register("q03b_top3_categories", "WITH" + _BASE + """
SELECT upper(substr(majortext, 1, 1)) || lower(substr(majortext, 2)) AS category, total FROM (
  SELECT majortext, CAST(SUM(qty) AS BIGINT) AS total FROM base GROUP BY majortext
  ORDER BY total DESC, majortext LIMIT 3)""")
def q03b(spark, sf_dir):
    """Q3 with a cut that leaves categories out."""
    return A.top_categories(S.crime_wide(spark, sf_dir), k=3)


@register("q04_by_borough", "WITH" + _BASE + """
SELECT boroughname, CAST(SUM(qty) AS BIGINT) AS total FROM base GROUP BY boroughname""")
def q04(spark, sf_dir):
    return A.by_borough(S.crime_wide(spark, sf_dir))


@register("q06_sample_rows", "WITH" + _BASE + f""",
months AS (SELECT ym, row_number() OVER (ORDER BY ym DESC) AS r FROM (SELECT DISTINCT ym FROM base)),
m AS (SELECT max(CASE WHEN r = 3 THEN ym END) AS m1, max(CASE WHEN r = 2 THEN ym END) AS m2,
             max(CASE WHEN r = 1 THEN ym END) AS m3 FROM months)
SELECT majortext, minortext, boroughname,
       m1 AS month_1, CAST(SUM(CASE WHEN ym = m1 THEN qty END) AS BIGINT) AS count_1,
       m2 AS month_2, CAST(SUM(CASE WHEN ym = m2 THEN qty END) AS BIGINT) AS count_2,
       m3 AS month_3, CAST(SUM(CASE WHEN ym = m3 THEN qty END) AS BIGINT) AS count_3
FROM base, m
WHERE regexp_matches(majortext, '{SAMPLE_MAJOR}') AND regexp_matches(boroughname, '{SAMPLE_PLACES}')
GROUP BY majortext, minortext, boroughname, m1, m2, m3
ORDER BY boroughname, majortext, minortext LIMIT 8""")
def q06(spark, sf_dir):
    rows = A.sample_rows(S.crime_wide(spark, sf_dir), major_pattern=SAMPLE_MAJOR,
                         place_pattern=SAMPLE_PLACES)
    ids, recent = rows.columns[:-3], rows.columns[-3:]
    months = [c for k, name in enumerate(recent, 1)
              for c in (F.lit(name).alias(f"month_{k}"), F.col(name).alias(f"count_{k}"))]
    return rows.select(*ids, *months)


@register("q07_meta", "WITH" + _BASE + "," + _DASH + """
SELECT 'updated' AS item, (SELECT substr(max(ym), 1, 4) || '-' || substr(max(ym), 5, 2) FROM base) AS value
UNION ALL SELECT 'stop_search', CAST(COUNT(*) AS VARCHAR) FROM events
UNION ALL SELECT 'vawg_offences', CAST(COUNT(*) AS VARCHAR) FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
UNION ALL SELECT 'dashboard', CAST(COUNT(*) AS VARCHAR) FROM dash""")
def q07(spark, sf_dir):
    counted = {"stop_search": footer_count(spark, f"{sf_dir.rstrip('/')}/events.parquet").first().rows,
               "vawg_offences": S.offence_records(spark, sf_dir),
               "dashboard": S.dashboard(spark, sf_dir)}
    return A.meta(spark, counted, S.latest_crime_month(spark, sf_dir))


# ── long table (Q8-Q11, Q19-Q21) ──────────────────────────────────────────────────────────────

@register("q08_wide_to_long", "WITH" + _CELLS + """
SELECT majortext, minortext, boroughname, CAST(strptime(ym, '%Y%m') AS DATE) AS month, cnt AS count
FROM cells""")
def q08(spark, sf_dir):
    return A.wide_to_long(S.crime_wide(spark, sf_dir))


@register("q09_by_category_long", "WITH" + _BASE + """
SELECT majortext, CAST(SUM(qty) AS BIGINT) AS count FROM base GROUP BY majortext""")
def q09(spark, sf_dir):
    return A.sum_by(A.wide_to_long(S.crime_wide(spark, sf_dir)), "majortext")


@register("q10_by_borough_long", "WITH" + _BASE + """
SELECT boroughname, CAST(SUM(qty) AS BIGINT) AS count FROM base GROUP BY boroughname""")
def q10(spark, sf_dir):
    return A.sum_by(A.wide_to_long(S.crime_wide(spark, sf_dir)), "boroughname")


@register("q11_pattern_by_borough", "WITH" + _BASE + f"""
SELECT boroughname, CAST(SUM(qty) AS BIGINT) AS count FROM base
WHERE regexp_matches(minortext, '(?i){WEAPON_PATTERN}') GROUP BY boroughname""")
def q11(spark, sf_dir):
    return A.pattern_by(A.wide_to_long(S.crime_wide(spark, sf_dir)), text="minortext",
                        pattern=WEAPON_PATTERN, key="boroughname")


@register("q11b_pattern_top10_case_sensitive", "WITH" + _BASE + f"""
SELECT boroughname, CAST(SUM(qty) AS BIGINT) AS count FROM base
WHERE regexp_matches(minortext, '{WEAPON_PATTERN}') GROUP BY boroughname
ORDER BY count DESC, boroughname LIMIT 10""")
def q11b(spark, sf_dir):
    """The README variant of Q11: case-sensitive pattern, top 10."""
    return A.pattern_by(A.wide_to_long(S.crime_wide(spark, sf_dir)), text="minortext",
                        pattern=WEAPON_PATTERN, key="boroughname", ignore_case=False, k=10)


@register("q19_full_series", "WITH" + _CELLS + """
SELECT CAST(strptime(min(ym), '%Y%m') AS DATE) AS first_month,
       CAST(strptime(max(ym), '%Y%m') AS DATE) AS last_month, COUNT(*) AS n_rows
FROM (SELECT c.* FROM cells c JOIN (SELECT DISTINCT majortext, minortext, boroughname FROM base
                                    WHERE ym < """ + _CURRENT_CUT + """) h USING (majortext, minortext, boroughname)
      WHERE c.ym < """ + _CURRENT_CUT + """
      UNION ALL
      SELECT c.* FROM cells c JOIN (SELECT DISTINCT majortext, minortext, boroughname FROM base
                                    WHERE ym >= """ + _CURRENT_CUT + """) k USING (majortext, minortext, boroughname)
      WHERE c.ym >= """ + _CURRENT_CUT + """)""")
def q19(spark, sf_dir):
    counts = S.CrimeCounts(spark, sf_dir)
    return A.series_summary(A.full_series(counts.historical(), counts.current()))


@register("q20_full_series_monthly", "WITH" + _BASE + """
SELECT CAST(strptime(ym, '%Y%m') AS DATE) AS month, CAST(SUM(qty) AS BIGINT) AS count
FROM base GROUP BY ym""")
def q20(spark, sf_dir):
    counts = S.CrimeCounts(spark, sf_dir)
    return A.monthly_series(A.full_series(counts.historical(), counts.current()))


@register("q21_distinct_crime_types", "WITH" + _DASH + """
SELECT DISTINCT crime_type FROM dash""")
def q21(spark, sf_dir):
    return A.distinct_values(S.dashboard(spark, sf_dir), "crime_type")


# ── dashboard (Q2, Q12-Q15) ───────────────────────────────────────────────────────────────────

@register("q02_knife_trend", "WITH" + _DASH + """
SELECT strftime(month_year, '%Y-%m') AS month, total FROM (
  SELECT month_year, CAST(SUM(count) AS BIGINT) AS total FROM dash
  WHERE area_type = 'F' AND measure = 'BUILDING' AND crime_type = '1-URGENT'
  GROUP BY month_year ORDER BY month_year DESC LIMIT 36)""")
def q02(spark, sf_dir):
    return A.knife_trend(S.dashboard(spark, sf_dir), equals=DASHBOARD_TREND)


@register("q12_dashboard_monthly", "WITH" + _MONTHLY + """
SELECT month_year, incidents FROM monthly""")
def q12(spark, sf_dir):
    return A.dashboard_monthly(S.dashboard(spark, sf_dir), equals=DASHBOARD_MONTHLY, count="count")


@register("q13_peak_and_lowest", "WITH" + _MONTHLY + """
SELECT * FROM (SELECT 'peak' AS kind, month_year, incidents FROM monthly
               ORDER BY incidents DESC, month_year LIMIT 1)
UNION ALL
SELECT * FROM (SELECT 'lowest' AS kind, month_year, incidents FROM monthly
               ORDER BY incidents, month_year LIMIT 1)""")
def q13(spark, sf_dir):
    monthly = A.dashboard_monthly(S.dashboard(spark, sf_dir), equals=DASHBOARD_MONTHLY, count="count")
    return A.peak_and_lowest(monthly)


@register("q14_seasonality", "WITH" + _MONTHLY + """
SELECT CAST(month(month_year) AS INTEGER) AS month_num, strftime(min(month_year), '%b') AS month_abbr,
       round(avg(incidents), 4) AS avg_incidents
FROM monthly GROUP BY month(month_year)""")
def q14(spark, sf_dir):
    monthly = A.dashboard_monthly(S.dashboard(spark, sf_dir), equals=DASHBOARD_MONTHLY, count="count")
    return A.seasonality(monthly)


@register("q15_daily_rate", "WITH" + _MONTHLY + """
SELECT month_year, incidents, CAST(day(last_day(month_year)) AS INTEGER) AS days_in_month,
       round(incidents / day(last_day(month_year)), 4) AS daily_rate
FROM monthly""")
def q15(spark, sf_dir):
    monthly = A.dashboard_monthly(S.dashboard(spark, sf_dir), equals=DASHBOARD_MONTHLY, count="count")
    return A.daily_rate(monthly)


# ── records (Q5, Q16-Q18) ─────────────────────────────────────────────────────────────────────

@register("q05_stops_by_ethnicity", "WITH" + _RECORDS + """
SELECT ethnicappearance, COUNT(*) AS stops FROM rec
WHERE ethnicappearance IS NOT NULL AND ethnicappearance <> 'Unknown' GROUP BY ethnicappearance""")
def q05(spark, sf_dir):
    return A.stops_by_ethnicity(S.stop_records(spark, sf_dir))


@register("q05b_stops_all_ethnicities", "WITH" + _RECORDS + """
SELECT ethnicappearance, COUNT(*) AS stops FROM rec GROUP BY ethnicappearance""")
def q05b(spark, sf_dir):
    """The README variant of Q5: no filter, the null group and "Unknown" kept."""
    return A.count_by(S.stop_records(spark, sf_dir), "ethnicappearance", keep_null=True)


@register("q16_top_legislation", "WITH" + _RECORDS + """
SELECT legislation, COUNT(*) AS stops FROM rec WHERE legislation IS NOT NULL
GROUP BY legislation ORDER BY stops DESC, legislation LIMIT 10""")
def q16(spark, sf_dir):
    return A.top_by_fuzzy_column(S.stop_records(spark, sf_dir), "legislat")


@register("q17_top_outcomes", "WITH" + _RECORDS + """
SELECT outcome, COUNT(*) AS stops FROM rec WHERE outcome IS NOT NULL
GROUP BY outcome ORDER BY stops DESC, outcome LIMIT 10""")
def q17(spark, sf_dir):
    return A.top_by_fuzzy_column(S.stop_records(spark, sf_dir), "outcome")


@register("q17b_top3_outcomes", "WITH" + _RECORDS + """
SELECT outcome, COUNT(*) AS stops FROM rec WHERE outcome IS NOT NULL
GROUP BY outcome ORDER BY stops DESC, outcome LIMIT 3""")
def q17b(spark, sf_dir):
    """Q17 with a cut that leaves outcomes out."""
    return A.top_by_fuzzy_column(S.stop_records(spark, sf_dir), "outcome", k=3)


@register("q18_offences_by_type", """
SELECT p.p_type, CAST(SUM(CAST(l.l_quantity AS BIGINT)) AS BIGINT) AS total
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey GROUP BY p.p_type""")
def q18(spark, sf_dir):
    return A.totals_by_fuzzy_columns(S.offence_records(spark, sf_dir),
                                     ("type", "offence", "category"),
                                     ("count", "total", "offences"))

from . import registered_ops  # noqa: E402,F401  (registers the operator-level queries)
