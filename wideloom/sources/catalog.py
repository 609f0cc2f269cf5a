"""Named datasets (S5, S6, S7): ``Catalog(spark, root).load(key)``.

``root`` is any Hadoop URI (local folder, HDFS, object store) holding one Parquet directory per
dataset, named by the registry's ``output``. Loading is lazy; only the schema is read. A missing
dataset raises ``FileNotFoundError`` with a hint instead of an empty frame.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import registry as R

HISTORICAL_KEYS = {"recorded-crime-borough", "recorded-crime-ward", "recorded-crime-lsoa"}


def footer_count(spark: SparkSession, path: str) -> DataFrame:
    """One row ``rows``, the rows of a Parquet dataset summed from its files' footers; no column is read.

    Spark reads Parquet with its first-generation source unless told otherwise, which cannot push an
    aggregate down, so the count is planned in a session of its own with the second one."""
    own = spark.newSession()
    first = own.conf.get("spark.sql.sources.useV1SourceList")
    own.conf.set("spark.sql.sources.useV1SourceList", ",".join(x for x in first.split(",") if x != "parquet"))
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return own.read.parquet(path).agg(F.count(F.lit(1)).alias("rows"))


class Catalog:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, key: str, *, historical: bool = False) -> str:
        if historical:
            if key not in HISTORICAL_KEYS:
                raise KeyError(f"{key!r} has no historical file")
            key = f"{key}-historical"
        return f"{self.root}/{R.source(key)['output']}"

    def load(self, key: str, *, historical: bool = False) -> DataFrame:
        """The dataset as a lazy DataFrame."""
        p = self.path(key, historical=historical)
        try:
            return self.spark.read.parquet(p)
        except AnalysisException as e:
            if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
                raise FileNotFoundError(
                    f"Not found: {p}\nRun the refresh for {key!r} first "
                    "(wideloom.plans.ingest.refresh) or point the catalog at another root.") from e
            raise

    def exists(self, key: str, *, historical: bool = False) -> bool:
        try:
            self.load(key, historical=historical)
            return True
        except FileNotFoundError:
            return False

    def row_count(self, key: str) -> int | None:
        """Rows of a dataset from its files' footers, None when it is missing."""
        return footer_count(self.spark, self.path(key)).first().rows if self.exists(key) else None

    def register_views(self) -> list[str]:
        """Temp views named after the keys (``-`` -> ``_``) for every dataset present."""
        names = []
        for row in R.SOURCES:
            key = row[0]
            try:
                df = self.spark.read.parquet(f"{self.root}/{row[7]}")
            except AnalysisException:
                continue
            name = key.replace("-", "_")
            df.createOrReplaceTempView(name)
            names.append(name)
        return names

    # One loader per dataset, keyword-only switches as in the original.
    def recorded_crime_borough(self, *, historical: bool = False) -> DataFrame:
        return self.load("recorded-crime-borough", historical=historical)

    def recorded_crime_ward(self, *, historical: bool = False) -> DataFrame:
        return self.load("recorded-crime-ward", historical=historical)

    def recorded_crime_lsoa(self, *, historical: bool = False) -> DataFrame:
        return self.load("recorded-crime-lsoa", historical=historical)

    def stop_search(self) -> DataFrame:
        return self.load("stop-search")

    def custody(self) -> DataFrame:
        return self.load("custody")

    def monthly_crime_dashboard(self) -> DataFrame:
        return self.load("monthly-crime-dashboard")

    def vawg_offences(self) -> DataFrame:
        return self.load("vawg-offences")

    def vawg_victims(self) -> DataFrame:
        return self.load("vawg-victims")

    def business_crime_offences(self) -> DataFrame:
        return self.load("business-crime-offences")

    def business_crime_outcomes(self) -> DataFrame:
        return self.load("business-crime-outcomes")

    def homicide(self) -> DataFrame:
        return self.load("homicide")

    def stolen_animals(self) -> DataFrame:
        return self.load("stolen-animals")

    def thorough_searches(self) -> DataFrame:
        return self.load("thorough-searches")

