import json
import os

import pytest

from wideloom.operators.manifest import MANIFEST_SCHEMA
from wideloom.plans.ingest import refresh, summarise
from wideloom.plans.site import build_site
from wideloom.sources.catalog import Catalog
from wideloom.sources.registry import SOURCES, dataset_pages, registry_frame, source


def write(path, text, enc="utf-8"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(text.encode(enc))
    return path


def test_registry(spark):
    reg = registry_frame(spark)
    assert reg.count() == 16 == len(SOURCES)
    assert source("stop-search")["combine_stride"] == 1
    pages = {r.key: r.page_url for r in dataset_pages(reg, "https://portal.example/dataset").collect()}
    assert pages["homicide"] == "https://portal.example/dataset/2l1w8"


def test_refresh_isolation_and_combine(spark, tmp_dir):
    src = os.path.join(tmp_dir, "src")
    # three rolling snapshots, newest first; the middle one is broken on purpose (no header)
    s0 = write(f"{src}/s0.csv", "Stop Date,Ethnic Appearance,Count\n01/03/2024,Black,1\n02/03/2024,Asian,2\n")
    s1 = write(f"{src}/s1.xlsx", "not a workbook")
    s2 = write(f"{src}/s2.csv", "Date,Ethnic_Appearance,Count\n2023-01-01,White,3\n02/03/2024,Asian,2\n")
    single = write(f"{src}/h.csv", "Method,Age\nknife,20\nother,x\n", enc="latin-1")
    man = spark.createDataFrame([
        ("e6yjz", 0, "LDS_Extract newest", s0, "csv"),
        ("e6yjz", 1, "LDS_Extract middle", s1, "xlsx"),
        ("e6yjz", 2, "LDS_Extract oldest", s2, "csv"),
        ("emxgp", 0, "searches newest", s0, "csv"),
        ("emxgp", 1, "searches middle", s1, "xlsx"),
        ("emxgp", 2, "searches oldest", s2, "csv"),
        ("2l1w8", 0, "Homicide", single, "csv"),
    ], MANIFEST_SCHEMA)
    out = os.path.join(tmp_dir, "out")
    sources = [source("stop-search"), source("thorough-searches"), source("homicide"),
               source("custody")]
    report = {r.key: r for r in refresh(spark, sources, man, out, parallel=2).collect()}
    # the middle snapshot of either dataset is broken and skipped; no stride leaves one out
    assert report["stop-search"].status == "ok" and report["stop-search"].used == [s0, s2]
    ts = report["thorough-searches"]
    assert ts.status == "ok" and ts.used == [s0, s2] and len(ts.skipped) == 1
    assert report["homicide"].status == "ok" and report["homicide"].rows == 2
    assert report["custody"].status == "no-match"
    cat = Catalog(spark, out)
    stops = cat.stop_search()
    assert stops.columns == ["stop_date", "ethnic_appearance", "count", "date"]
    assert stops.count() == 4
    hom = cat.homicide()
    assert hom.dtypes == [("method", "string"), ("age", "string")]   # N5 sees "20", "x": stays text
    from wideloom.plans.ingest import REPORT_SCHEMA
    s = summarise(spark.createDataFrame([tuple(r) for r in report.values()], REPORT_SCHEMA)).first()
    assert s.files == 3 and s.rows == 10 and s.failed == []


def test_catalog_missing(spark, tmp_dir):
    cat = Catalog(spark, tmp_dir)
    with pytest.raises(FileNotFoundError):
        cat.recorded_crime_borough()
    assert cat.row_count("homicide") is None
    with pytest.raises(KeyError):
        cat.path("homicide", historical=True)


def test_site_documents(spark, tmp_dir):
    root = os.path.join(tmp_dir, "data")
    wide = spark.createDataFrame(
        [("VIOLENCE AGAINST THE PERSON", "HOMICIDE", "Hackney", 1, 0, None, 2),
         ("THEFT", "BICYCLE", "Camden", 5, 4, 3, 2)],
        "majortext string, minortext string, boroughname string, `202511` bigint, `202512` bigint, "
        "`202601` bigint, `202602` bigint")
    wide.write.parquet(f"{root}/recorded-crime-borough.parquet")
    paths = build_site(spark, Catalog(spark, root), os.path.join(tmp_dir, "site"))

    def doc(name):
        return json.loads(spark.read.text(paths[name]).first().value)

    assert doc("monthly_totals.json") == {"labels": ["2025-11", "2025-12", "2026-01", "2026-02"],
                                          "values": [6, 4, 3, 4]}
    assert doc("by_borough.json") == {"labels": ["Camden", "Hackney"], "values": [14, 3]}
    assert doc("by_category.json")["labels"] == ["Theft", "Violence Against The Person"]
    assert doc("sample_rows.json") == {
        "columns": ["majortext", "minortext", "boroughname", "202512", "202601", "202602"],
        "rows": [["VIOLENCE AGAINST THE PERSON", "HOMICIDE", "Hackney", 0, None, 2]]}
    assert doc("meta.json") == {"updated": "2026-02", "rows": {}}


def test_all_snapshots_failing_is_a_skip(spark, tmp_dir):
    bad = write(os.path.join(tmp_dir, "src", "x.xlsx"), "junk")
    man = spark.createDataFrame([("emxgp", 0, "only", bad, "xlsx")], MANIFEST_SCHEMA)
    r = refresh(spark, [source("thorough-searches")], man, os.path.join(tmp_dir, "out")).first()
    assert r.status == "no-data" and r.rows == 0
    from wideloom.plans.ingest import REPORT_SCHEMA
    s = summarise(spark.createDataFrame([tuple(r)], REPORT_SCHEMA)).first()
    assert s.failed == [] and s.files == 0


def test_views_and_source_listing(spark, tmp_dir):
    from wideloom.plans.ingest import list_sources, sources_for
    from wideloom.operators.manifest import UnknownSourceError
    reg = registry_frame(spark)
    assert [r.key for r in list_sources(reg).collect()][:2] == ["business-crime-offences",
                                                                "business-crime-outcomes"]
    assert [s["key"] for s in sources_for(spark, reg, "homicide")] == ["homicide"]
    with pytest.raises(UnknownSourceError):
        sources_for(spark, reg, "nope")
    root = os.path.join(tmp_dir, "data")
    spark.createDataFrame([("a", 1), ("b", 2)], "method string, age bigint") \
        .write.parquet(f"{root}/homicide.parquet")
    assert Catalog(spark, root).register_views() == ["homicide"]
    assert spark.sql("SELECT sum(age) AS s FROM homicide").first().s == 3
    assert Catalog(spark, root).row_count("homicide") == 2


def test_explore_tables(spark, tmp_dir):
    import datetime as dt
    from wideloom.plans.explore import explore
    root = os.path.join(tmp_dir, "data")
    cols = ("majortext string, minortext string, boroughname string, `202401` bigint, "
            "`202402` bigint")
    spark.createDataFrame([("VIOLENCE", "KNIFE CRIME", "Camden", 1, 2),
                           ("THEFT", "BIKE", "Brent", 3, None)], cols) \
        .write.parquet(f"{root}/recorded-crime-borough.parquet")
    spark.createDataFrame([("VIOLENCE", "KNIFE CRIME", "Camden", 5)],
                          "majortext string, minortext string, boroughname string, `202312` bigint") \
        .write.parquet(f"{root}/recorded-crime-borough-historical.parquet")
    spark.createDataFrame([("Borough", "Knife Crime", dt.date(2024, 1, 1), 10),
                           ("Borough", "Knife Crime", dt.date(2024, 2, 1), 7),
                           ("SNT", "Knife Crime", dt.date(2024, 2, 1), 99)],
                          "area_type string, crime_type string, month_year date, "
                          "count_of_incidents bigint") \
        .write.parquet(f"{root}/monthly-crime-dashboard.parquet")
    spark.createDataFrame([("s1 PACE", "Arrest", "Black"), (None, "NFA", "Unknown")],
                          "legislation string, outcome string, ethnicappearance string") \
        .write.parquet(f"{root}/stop-search.parquet")
    t = explore(Catalog(spark, root))
    assert {r.boroughname: r["count"] for r in t["knife_by_borough"].collect()} == {"Camden": 3}
    assert {r.majortext: r["count"] for r in t["by_category"].collect()} == {"VIOLENCE": 3, "THEFT": 3}
    assert [tuple(r) for r in t["full_series"].collect()] == [(dt.date(2023, 12, 1), dt.date(2024, 2, 1), 5)]
    assert {r.kind: r.incidents for r in t["peak_and_lowest"].collect()} == {"peak": 10, "lowest": 7}
    assert [tuple(r) for r in t["legislation"].collect()] == [("s1 PACE", 1)]
    assert [tuple(r) for r in t["ethnicity"].collect()] == [("Black", 1)]
    assert "vawg_by_type" not in t and "outcomes" in t


def test_meta_document_key_order(spark):
    from wideloom.plans.site import meta_document
    m = spark.createDataFrame([("thorough_searches", "3"), ("updated", "2026-02"),
                               ("stop_search", "1"), ("homicide", "2")], "item string, value string")
    assert meta_document(m).first().json == \
        '{"updated":"2026-02","rows":{"stop_search":1,"homicide":2,"thorough_searches":3}}'


def test_partitioned_save_prunes(spark, tmp_dir):
    from wideloom.sources.sinks import save_parquet
    df = spark.createDataFrame([(2023, "a"), (2024, "b"), (2024, "c")], "year int, v string")
    res = save_parquet(df, f"{tmp_dir}/p.parquet", partition_by=["year"])
    assert res.rows == 3
    q = spark.read.parquet(f"{tmp_dir}/p.parquet").filter("year = 2024")
    assert "PartitionFilters: [isnotnull(year" in q._jdf.queryExecution().executedPlan().toString()
    assert q.count() == 2


def test_failing_write_leaves_the_old_dataset(spark, tmp_dir):
    from pyspark.sql import functions as F
    from wideloom.sources.sinks import save_parquet
    path = f"{tmp_dir}/set.parquet"
    save_parquet(spark.range(5), path)
    bad = spark.range(100).select(F.when(F.col("id") == 77, F.raise_error(F.lit("task fails"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="task fails"):
        save_parquet(bad, path)
    assert spark.read.parquet(path).count() == 5
    assert os.listdir(tmp_dir) == ["set.parquet"]                  # nothing staged is left
    own = spark.read.parquet(path)
    assert save_parquet(own.union(own), path).rows == 10           # a dataset that reads itself
    assert spark.read.parquet(path).count() == 10 and os.listdir(tmp_dir) == ["set.parquet"]


def test_failing_rename_brings_the_old_dataset_back(spark, tmp_dir, monkeypatch):
    from wideloom.sources import sinks
    path = f"{tmp_dir}/set.parquet"
    sinks.save_parquet(spark.range(5), path)
    place = sinks._Place(spark, path)
    with pytest.raises(Exception):
        place.replace(place.beside("staged"))                      # there is nothing to put in place
    assert spark.read.parquet(path).count() == 5
    os.rename(path, f"{tmp_dir}/.set.parquet.before-1")            # as a driver lost between the renames leaves it
    assert sinks.restore_dataset(spark, path) and not sinks.restore_dataset(spark, path)
    assert spark.read.parquet(path).count() == 5


def test_documents_have_an_order_and_a_bound(spark):
    from pyspark.sql import functions as F
    from wideloom.sources.sinks import chart_payload, table_payload
    df = spark.createDataFrame([("b", 2), ("a", 2), (None, 5), ("c", None)], "k string, v int")
    assert chart_payload(df, "k", "v", order=["-v", "k"]).first().json == \
        '{"labels":["c",null,"a","b"],"values":[null,5,2,2]}'
    assert table_payload(df, order=["k"]).first().json == \
        '{"columns":["k","v"],"rows":[[null,5],["a",2],["b",2],["c",null]]}'
    with pytest.raises(ValueError):
        chart_payload(df, "k", "v", order=[])
    with pytest.raises(Exception, match="more than 3 rows"):
        chart_payload(df, "k", "v", order=["k"], max_rows=3).collect()
    plan = chart_payload(df.groupBy("k").agg(F.sum("v").alias("v")), "k", "v", order=["k"])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def test_brackets_in_paths_and_backticks_in_names(spark, tmp_dir):
    src = os.path.join(tmp_dir, "src")
    a = write(f"{src}/Searches [x] (part) 50%.csv", "Kind `a`,n\nx,1\n")
    b = write(f"{src}/b.csv", "kind `A`,N\ny,z\n")
    man = spark.createDataFrame([("emxgp", 0, "one", a, "csv"), ("emxgp", 1, "two", b, "csv")], MANIFEST_SCHEMA)
    r = refresh(spark, [source("thorough-searches")], man, os.path.join(tmp_dir, "out")).first()
    assert r.status == "ok" and r.skipped == [] and r.rows == 2
    assert sorted(map(tuple, spark.read.parquet(r.path).collect())) == [("x", "1"), ("y", "z")]


def test_one_manifest_job_for_all_datasets(spark, tmp_dir, monkeypatch):
    from wideloom.plans import ingest
    calls = []
    real = ingest.plan_refresh
    monkeypatch.setattr(ingest, "plan_refresh", lambda *a: calls.append(1) or real(*a))
    man = spark.createDataFrame([], MANIFEST_SCHEMA)
    rep = refresh(spark, [source("homicide"), source("stop-search"), source("custody")], man, os.path.join(tmp_dir, "out"))
    assert len(calls) == 1 and [r.status for r in rep.collect()] == ["no-match"] * 3
