import json

from conftest import SF

from wideloom.plans.explore import explore
from wideloom.plans.shapes import stage_catalog
from wideloom.plans.site import build_site
from wideloom.sources.catalog import Catalog


def test_stage_site_and_notebook(spark, tmp_dir):
    staged = stage_catalog(spark, SF["0.001"], f"{tmp_dir}/data")
    assert set(staged) >= {"recorded-crime-borough", "stop-search", "thorough-searches"}
    cat = Catalog(spark, f"{tmp_dir}/data")
    docs = {n: json.loads(spark.read.text(p).first().value)
            for n, p in build_site(spark, cat, f"{tmp_dir}/site").items()}
    monthly, borough = docs["monthly_totals.json"], docs["by_borough.json"]
    assert len(monthly["labels"]) == 24 and monthly["labels"] == sorted(monthly["labels"])
    assert sum(monthly["values"]) == sum(borough["values"])          # Σ Q1 = Σ Q4
    assert borough["values"] == sorted(borough["values"], reverse=True)
    assert docs["meta.json"]["rows"] == {"stop_search": staged["stop-search"],
                                         "vawg_offences": staged["vawg-offences"],
                                         "thorough_searches": staged["thorough-searches"]}
    assert docs["meta.json"]["updated"] == monthly["labels"][-1]
    assert len(docs["sample_rows.json"]["rows"]) <= 8
    t = explore(cat, dashboard_count="count_of_incidents")
    assert {"by_category", "full_series", "seasonality", "legislation", "vawg_by_type"} <= set(t)
    full = t["full_series"].first()
    assert full.first_month < full.last_month
