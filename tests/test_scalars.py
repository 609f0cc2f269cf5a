from pyspark.sql import functions as F

from wideloom.functions.dates import column_label, days_in_month, iso_month_label, month_abbr, \
    yyyymm_to_label
from wideloom.functions.numbers import axis_label, humanise
from wideloom.functions.text import title_case
from wideloom.functions.urls import url_join


def one(spark, col, values, schema="v string"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(col).collect()]


def test_title_case(spark):
    got = one(spark, title_case("v"), ["VIOLENCE AGAINST THE PERSON", "DRUG-OFFENCES", "WOMEN'S",
                                       "2ND class", None])
    assert got == ["Violence Against The Person", "Drug-Offences", "Women'S", "2Nd Class", None]


def test_humanise(spark):
    got = one(spark, humanise("v"), [1333367, 411341, 4512, 999, 999999], "v bigint")
    assert got == ["1.3M", "411K", "5K", "999", "1000K"]


def test_axis_label(spark):
    assert one(spark, axis_label("v"), [1500, 10000], "v bigint") == ["1.5K", "10K"]


def test_month_labels(spark):
    assert one(spark, yyyymm_to_label("v"), ["202403"]) == ["2024-03"]
    assert one(spark, column_label("v"), ["202602", "majortext"]) == ["Feb 2026", "majortext"]


def test_dates(spark):
    df = spark.createDataFrame([("2024-02-10",)], "v string").select(F.to_date("v").alias("d"))
    r = df.select(days_in_month("d"), month_abbr("d"), iso_month_label("d")).first()
    assert tuple(r) == (29, "Feb", "2024-02")


def test_url_join(spark):
    got = one(spark, url_join("https://site.example", "v"),
              ["https://a.b/x.csv", "//cdn.x/y.csv", "/p/q.csv", "r.csv"])
    assert got == ["https://a.b/x.csv", "https://cdn.x/y.csv", "https://site.example/p/q.csv",
                   "https://site.example/r.csv"]


def test_thousands_label_half_up(spark):
    from wideloom.functions.numbers import thousands_label
    # Spark rounds the decimal value half-up: 2500 -> 3K (Python's format would give 2K)
    assert one(spark, thousands_label("v"), [2500, 1499, 171162], "v bigint") == ["3K", "1K", "171K"]


def test_defaults(spark):
    from wideloom.functions.numbers import zero_if_null
    from wideloom.functions.text import default_if_blank, empty_if_null
    df = spark.createDataFrame([(None, None), ("", 3), ("2026-02", None)], "u string, n bigint")
    got = [tuple(r) for r in df.select(empty_if_null("u"), default_if_blank("u", "--"),
                                       zero_if_null("n")).collect()]
    assert got == [("", "--", 0), ("", "--", 3), ("2026-02", "2026-02", 0)]


def test_drifted_dates_and_columns(spark):
    from wideloom.operators.columns import coalesce_dates, coalesce_drifted
    df = spark.createDataFrame([("05/03/2024", None, "Black", None), (None, "2023-01-02", None, "White"),
                                ("5/3/2024", None, None, None)],
                               "stopdate string, date string, ethnicappearance string, "
                               "ethnic_appearance string")
    out = coalesce_dates(df, "stop_day", {"stopdate": "dd/MM/yyyy", "date": "yyyy-MM-dd"})
    out = coalesce_drifted(out, "ethnicity", "ethnicappearance", "ethnic_appearance", "missing_col")
    got = [(str(r.stop_day) if r.stop_day else None, r.ethnicity) for r in out.collect()]
    assert got == [("2024-03-05", "Black"), ("2023-01-02", "White"), (None, None)]


def test_provenance(spark, tmp_dir):
    from wideloom.operators.columns import with_provenance
    df = spark.createDataFrame([(1,)], "a int")
    assert with_provenance(df, "_sheet", "Sheet1").first()._sheet == "Sheet1"
    p = f"{tmp_dir}/p.parquet"
    df.write.parquet(p)
    assert with_provenance(spark.read.parquet(p), "src").first().src.startswith("file:")


def test_try_parse_month(spark):
    from wideloom.functions.dates import try_parse_month
    got = one(spark, try_parse_month("v"), ["202403", "majortext"])
    assert [str(g) if g else None for g in got] == ["2024-03-01", None]


def test_as_date_accepts_date_timestamp_text(spark):
    from wideloom.functions.dates import as_date
    df = spark.createDataFrame([("2024-03-05",)], "s string").selectExpr(
        "s", "to_date(s) AS d", "to_timestamp(concat(s, ' 10:11:12')) AS t",
        "concat(s, 'T10:11:12') AS iso")
    r = df.select(*[as_date(c).alias(c) for c in df.columns], F.month(as_date("t")).alias("m")).first()
    assert {str(r.s), str(r.d), str(r.t), str(r.iso)} == {"2024-03-05"} and r.m == 3


def test_label_edges(spark):
    # a six-digit name that is not a month stays as it is; small, negative and fractional
    # numbers print as themselves, like the site's String(n)
    assert one(spark, column_label("v"), ["202413", "2024"]) == ["202413", "2024"]
    assert one(spark, humanise("v"), [-1500.0, 12.5, 0.0], "v double") == ["-1500", "12.5", "0"]
