"""wideloom: Spark-native ingest and analysis of irregular monthly public statistics.

    from wideloom import get_spark, Catalog, analyses
    spark = get_spark()
    borough = Catalog(spark, "hdfs:///data/crime").recorded_crime_borough()
    analyses.monthly_totals(borough).show()
"""

from .plans import analyses
from .plans.explore import explore
from .plans.ingest import refresh, summarise
from .plans.site import build_site
from .session import get_spark, scratch_dir
from .sources.catalog import Catalog
from .sources.registry import SOURCES, registry_frame

__all__ = ["Catalog", "SOURCES", "analyses", "build_site", "explore", "get_spark", "refresh",
           "registry_frame", "scratch_dir", "summarise"]
__version__ = "0.1.0"
