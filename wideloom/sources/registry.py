"""The dataset registry (S9) and its page map (S10), as data.

Each entry says which published dataset to fetch (portal ``short_id``), which of its resources to
take (a case-insensitive name hint, and whether the historical file is wanted), whether several
rolling snapshots are combined (and with what stride), and the output name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

REGISTRY_SCHEMA = ("key string, name string, short_id string, resource_name_contains string, "
                   "prefer_historical boolean, combine_resources boolean, combine_stride int, "
                   "output string, shape string, description string")

# The sixteen datasets. Columns: key, name, short_id, resource name hint,
# prefer_historical, combine_resources, combine_stride, output file, table shape, description.
SOURCES: list[tuple] = [
    ("recorded-crime-borough", "MPS Recorded Crime: Borough Level", "exy3m",
     "Borough Level Crime", False, False, 1, "recorded-crime-borough.parquet", "wide",
     "Monthly counts per borough, major and minor category; latest 24 months."),
    ("recorded-crime-borough-historical", "MPS Recorded Crime: Borough Level (Historical)", "exy3m",
     "Borough Level Crime (Historical)", True, False, 1,
     "recorded-crime-borough-historical.parquet", "wide",
     "Monthly counts per borough and category, historical file."),
    ("recorded-crime-ward", "MPS Recorded Crime: Ward Level", "exy3m",
     "Ward Level Crime", False, False, 1, "recorded-crime-ward.parquet", "wide",
     "Monthly counts per ward and category."),
    ("recorded-crime-ward-historical", "MPS Recorded Crime: Ward Level (Historical)", "exy3m",
     "Ward Level Crime (Historical)", True, False, 1, "recorded-crime-ward-historical.parquet",
     "wide", "Monthly counts per ward and category, historical file."),
    ("recorded-crime-lsoa", "MPS Recorded Crime: LSOA Level", "exy3m",
     "LSOA Level Crime", False, False, 1, "recorded-crime-lsoa.parquet", "wide",
     "Monthly counts per lower super output area."),
    ("recorded-crime-lsoa-historical", "MPS Recorded Crime: LSOA Level (Historical)", "exy3m",
     "LSOA Level Crime (Historical)", True, False, 1, "recorded-crime-lsoa-historical.parquet",
     "wide", "Monthly counts per lower super output area, historical file."),
    ("stop-search", "MPS Stop and Search Dashboard", "e6yjz",
     "LDS_Extract", False, True, 1, "stop-search.parquet", "long",
     "Stop and search records combined from rolling snapshots."),
    ("monthly-crime-dashboard", "MPS Monthly Crime Dashboard", "e5n6w",
     "KnifeCrimeData", False, False, 1, "monthly-crime-dashboard.parquet", "long",
     "Monthly knife crime counts by area type and area."),
    ("custody", "MPS Custody: Arrests, Disposals, Strip Searches", "2r7po",
     "", False, False, 1, "custody.parquet", "long",
     "Custody suite records."),
    ("vawg-offences", "MPS VAWG: Offence Data", "2yod5",
     "Offence", False, False, 1, "vawg-offences.parquet", "long",
     "VAWG offence counts by type, area and month."),
    ("vawg-victims", "MPS VAWG: Victim Data", "2yod5",
     "Victim", False, False, 1, "vawg-victims.parquet", "long",
     "VAWG victim counts by offence type and area."),
    ("business-crime-offences", "MPS Business Crime: Offences", "2zpjy",
     "OffencesData", False, True, 1, "business-crime-offences.parquet", "long",
     "Business crime offence counts combined from sampled snapshots."),
    ("business-crime-outcomes", "MPS Business Crime: Outcomes", "2zpjy",
     "OutcomesData", False, True, 1, "business-crime-outcomes.parquet", "long",
     "Business crime outcome counts combined from sampled snapshots."),
    ("homicide", "MPS Homicide Dashboard", "2l1w8",
     "", False, False, 1, "homicide.parquet", "long",
     "Homicide records."),
    ("stolen-animals", "MPS Stolen Animals Dashboard", "e756x",
     "", False, False, 1, "stolen-animals.parquet", "long",
     "Stolen animal reports."),
    ("thorough-searches", "MPS More Thorough and Intimate Part Searches", "emxgp",
     "", False, True, 1, "thorough-searches.parquet", "long",
     "More thorough and intimate part search records from every snapshot."),
]

FIELDS = ("key", "name", "short_id", "resource_name_contains", "prefer_historical",
          "combine_resources", "combine_stride", "output", "shape", "description")


def source(key: str) -> dict:
    for row in SOURCES:
        if row[0] == key:
            return dict(zip(FIELDS, row))
    raise KeyError(f"unknown source {key!r}")


def registry_frame(spark: SparkSession, sources: list[tuple] | None = None) -> DataFrame:
    """The registry as a DataFrame (one row per dataset)."""
    return spark.createDataFrame(sources if sources is not None else SOURCES, REGISTRY_SCHEMA)


def dataset_pages(registry: DataFrame, base: str) -> DataFrame:
    """``key -> base + short_id`` (the portal's dataset page)."""
    return registry.select("key", F.concat(F.lit(base.rstrip("/") + "/"), "short_id").alias("page_url"))
