"""Stage driver-derived datasets as a catalog, then build the summary documents and the
notebook tables: python scripts/demo_site.py [sf_dir] [out_dir]"""

import json
import os
import sys
import uuid

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from wideloom.plans.explore import explore  # noqa: E402
from wideloom.plans.shapes import stage_catalog  # noqa: E402
from wideloom.plans.site import build_site  # noqa: E402
from wideloom.session import get_spark, scratch_dir  # noqa: E402
from wideloom.sources.catalog import Catalog  # noqa: E402


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_spark("local[8]", shuffle_partitions=8)
    out = sys.argv[2] if len(sys.argv) > 2 else f"{scratch_dir(spark)}/demo-{uuid.uuid4().hex}"
    spark.sparkContext.setLogLevel("ERROR")
    print("staged:", stage_catalog(spark, sf_dir, f"{out}/data"))
    cat = Catalog(spark, f"{out}/data")
    for name, path in build_site(spark, cat, f"{out}/site").items():
        print(name, spark.read.text(path).first().value[:160])
    with explore(cat, dashboard_count="count_of_incidents") as tables:
        for name, df in tables.items():
            if name != "long":
                print(name, [tuple(r) for r in df.limit(3).collect()])
    spark.stop()


if __name__ == "__main__":
    main()
