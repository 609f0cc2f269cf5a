from urllib.parse import urljoin

from pyspark.sql import functions as F

from wideloom.functions.urls import url_join
from wideloom.operators.links import extract_links, extract_urls


def test_extension_major_order_and_resolution(spark):
    html = ('<a href="/a.xlsx">x</a><a href=\'b.csv\'>y</a><a href="https://h.example/c.csv">z</a>'
            '<a href="//cdn.example/d.zip">w</a><a href="/page">no</a>')
    df = spark.createDataFrame([(1, html)], "id int, html string")
    got = [(r.pos, r.href, r.url) for r in
           extract_links(df, "html", keep=["id"], base="https://site.example").collect()]
    assert got == [(0, "b.csv", "https://site.example/b.csv"),
                   (1, "https://h.example/c.csv", "https://h.example/c.csv"),
                   (2, "/a.xlsx", "https://site.example/a.xlsx"),
                   (3, "//cdn.example/d.zip", "https://cdn.example/d.zip")]


def test_urls_in_text_dedup_first_seen(spark):
    text = '{"u": "https://a.example/x.csv", "v": ["http://b.example/y.xlsx", "https://a.example/x.csv"]}'
    df = spark.createDataFrame([(text,)], "t string")
    # extension-major; the unanchored ".xls" pattern also finds the prefix of "y.xlsx" (as the
    # original's pattern does)
    assert [r.url for r in extract_urls(df, "t").collect()] == ["https://a.example/x.csv",
                                                                "http://b.example/y.xlsx",
                                                                "http://b.example/y.xls"]


def test_url_join_against_the_standard_library(spark):
    bases = ["https://site.example", "https://site.example/", "http://h.example/a/b/c.html?q=1#top", "http://h.example/a/b/"]
    refs = ["", "x.csv", "./x.csv", "../x.csv", "../../x", "../../../../x.csv", "a/../b.csv", "a/./b/../../c", ".", "..", "./", "../",
            "a/..", "a/.", "/x", "/x/../y/./z.csv", "/..", "/a/b/..", "?x", "?x=1#y", "#a", "mailto:me@h.example", "javascript:void(0)",
            "//cdn.example/a/b.csv", "//cdn.example", "https://o.example/p?q#f", "ftp://o.example/a/../b", "x;v=1", "x/../?q", "x//y.csv",
            "..x", "x..", "...", "a b.csv", "é/ü.csv", "x#y?z", "x?y/../z"]
    pairs = [(b, r) for b in bases for r in refs]
    df = spark.createDataFrame(pairs, "b string, r string")
    got = [r.u for r in df.select(url_join(F.col("b"), F.col("r")).alias("u")).collect()]

    want = [urljoin(b, r) if r else b.split("#")[0] for b, r in pairs]
    assert list(zip(pairs, got)) == list(zip(pairs, want))


def test_url_join_white_space_and_nulls(spark):
    df = spark.createDataFrame([(" x.csv\n", "https://h.example/a/b"), (None, "https://h.example"), ("//c.example/x", None),
                                ("https://c.example/x", None)], "r string, b string")
    assert [r.u for r in df.select(url_join(F.col("b"), F.col("r")).alias("u")).collect()] == [
        "https://h.example/a/x.csv", None, "//c.example/x", "https://c.example/x"]
