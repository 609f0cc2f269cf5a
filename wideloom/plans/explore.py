"""The exploration notebook's tables (Q8-Q21) from a catalog, in one session.

The borough table is read once and its long form persisted for the three analyses that use it, until
the tables are closed (``with explore(catalog) as tables: ...``);
datasets missing from the catalog are skipped (their entries are absent), and the fuzzy column
resolvers skip a chart when no column matches, as the notebook does. Every value is a lazy
DataFrame; nothing is collected here.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from ..sources.catalog import Catalog
from . import analyses as A

# The notebook's filters and column-name fragments.
WEAPON_PATTERN = "knife|blade|weapon"
KNIFE_MONTHLY = {"crime_type": "Knife Crime", "area_type": "Borough"}
LEGISLATION_NEEDLES = ("legislat",)
OUTCOME_NEEDLES = ("outcome",)
VAWG_TYPE_NEEDLES = ("type", "offence", "category")
VAWG_COUNT_NEEDLES = ("count", "total", "offences")


class Tables(dict):
    """Name -> DataFrame; ``close`` (or the end of a ``with`` block) releases what is persisted."""

    def close(self) -> None:
        if "long" in self:
            self["long"].unpersist()

    def __enter__(self) -> Tables:
        return self

    def __exit__(self, *_) -> None:
        self.close()


def explore(catalog: Catalog, *, dashboard_count: str = "count_of_incidents",
            dashboard_month: str = "month_year") -> Tables:
    """Name -> DataFrame for every table the notebook shows."""
    out = Tables()
    if catalog.exists("recorded-crime-borough"):
        long = A.wide_to_long(catalog.recorded_crime_borough()).persist(StorageLevel.MEMORY_AND_DISK)
        out["long"] = long                                                       # Q8
        out["by_category"] = A.sum_by(long, "majortext")                         # Q9
        out["by_borough"] = A.sum_by(long, "boroughname")                        # Q10
        out["knife_by_borough"] = A.pattern_by(long, text="minortext",           # Q11
                                               pattern=WEAPON_PATTERN, key="boroughname")
        if catalog.exists("recorded-crime-borough", historical=True):
            full = A.full_series(catalog.recorded_crime_borough(historical=True),
                                 catalog.recorded_crime_borough())
            out["full_series"] = A.series_summary(full)                          # Q19
            out["full_series_monthly"] = A.monthly_series(full)                  # Q20
    if catalog.exists("monthly-crime-dashboard"):
        dash = catalog.monthly_crime_dashboard()
        out["crime_types"] = A.distinct_values(dash, "crime_type")               # Q21
        monthly = A.dashboard_monthly(dash, equals=KNIFE_MONTHLY, month=dashboard_month,
                                      count=dashboard_count)                     # Q12
        out["knife_monthly"] = monthly
        out["peak_and_lowest"] = A.peak_and_lowest(monthly, month=dashboard_month)  # Q13
        out["seasonality"] = A.seasonality(monthly, month=dashboard_month)       # Q14
        out["daily_rate"] = A.daily_rate(monthly, month=dashboard_month)         # Q15
    if catalog.exists("stop-search"):
        stops = catalog.stop_search()
        if "ethnicappearance" in stops.columns:
            out["ethnicity"] = A.stops_by_ethnicity(stops)                       # Q5
        for name, needles in (("legislation", LEGISLATION_NEEDLES), ("outcomes", OUTCOME_NEEDLES)):
            top = A.top_by_fuzzy_column(stops, *needles)                         # Q16, Q17
            if top is not None:
                out[name] = top
    if catalog.exists("vawg-offences"):
        by_type = A.totals_by_fuzzy_columns(catalog.vawg_offences(), VAWG_TYPE_NEEDLES,
                                            VAWG_COUNT_NEEDLES)                  # Q18
        if by_type is not None:
            out["vawg_by_type"] = by_type
    return out
