"""The seven summary documents (S8 over Q1-Q7) from a catalog.

Reads the wide borough table once and persists it for the five analyses that use it (the
original reads that file five times), then writes one JSON line per document.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.catalog import Catalog
from ..sources.sinks import chart_payload, table_payload, write_documents
from . import analyses as A

# The notes and filters of the published summaries.
ETHNICITY_NOTE = ("Officer-defined ethnicity. Covers records where this field is populated "
                  "(~260K of 1.35M total).")
SAMPLE_MAJOR = "VIOLENCE"
SAMPLE_PLACES = "Westminster|Southwark|Hackney|Tower Hamlets|Lambeth"
KNIFE_FILTER = {"area_type": "Borough", "measure": "Offences", "crime_type": "Knife Crime"}
META_DATASETS = (("stop_search", "stop-search"), ("vawg_offences", "vawg-offences"),
                 ("homicide", "homicide"), ("thorough_searches", "thorough-searches"))


def build_documents(spark: SparkSession, catalog: Catalog, borough: DataFrame | None = None) -> dict[str, DataFrame]:
    """The documents by name; ``borough`` is the wide borough table, if it is kept somewhere already."""
    borough = catalog.recorded_crime_borough() if borough is None else borough
    docs = {
        "monthly_totals.json": chart_payload(A.monthly_totals(borough), "month", "total",
                                             order=["month"]),
        "by_category.json": chart_payload(A.top_categories(borough), "category", "total",
                                          order=["-total", "category"]),
        "by_borough.json": chart_payload(A.by_borough(borough), "boroughname", "total",
                                         order=["-total", "boroughname"]),
    }
    if catalog.exists("monthly-crime-dashboard"):
        trend = A.knife_trend(catalog.monthly_crime_dashboard(), equals=KNIFE_FILTER)
        docs["knife_crime.json"] = chart_payload(trend, "month", "total", order=["month"])
    if catalog.exists("stop-search"):
        eth = A.stops_by_ethnicity(catalog.stop_search())
        docs["stop_search_ethnicity.json"] = chart_payload(
            eth, "ethnicappearance", "stops",
            order=["-stops", "ethnicappearance"], note=ETHNICITY_NOTE)
    sample = A.sample_rows(borough, major_pattern=SAMPLE_MAJOR, place_pattern=SAMPLE_PLACES)
    docs["sample_rows.json"] = table_payload(
        sample, order=["boroughname", "majortext", "minortext"])
    present = {name: catalog.row_count(key) for name, key in META_DATASETS if catalog.exists(key)}
    docs["meta.json"] = meta_document(A.meta(spark, present, A.latest_month(borough)))
    return docs


def meta_document(meta: DataFrame, order: tuple[str, ...] = tuple(n for n, _ in META_DATASETS)) -> DataFrame:
    """``{"updated": "...", "rows": {name: n, ...}}`` from the (item, value) rows of Q7, with the
    row counts in ``order`` (the published key order)."""
    pos = F.array_position(F.array(*[F.lit(n) for n in order]), F.col("item"))
    entries = F.array_sort(F.collect_list(F.when(
        F.col("item") != "updated", F.struct(pos.alias("p"), "item", F.col("value").cast("bigint").alias("v")))))
    rows = F.map_from_entries(F.transform(entries, lambda e: F.struct(e["item"], e["v"])))
    updated = F.max(F.when(F.col("item") == "updated", F.col("value")))
    return meta.agg(F.to_json(F.struct(updated.alias("updated"), rows.alias("rows"))).alias("json"))


def build_site(spark: SparkSession, catalog: Catalog, out_dir: str) -> dict[str, str]:
    borough = catalog.recorded_crime_borough().persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return write_documents(spark, build_documents(spark, catalog, borough), out_dir)
    finally:
        borough.unpersist()
