from pyspark.sql import functions as F

from wideloom.operators.reshape import column_sums, concat_same_schema, horizontal_sum, melt_months, \
    month_columns
from wideloom.plans import analyses as A


def wide(spark):
    return spark.createDataFrame(
        [("V", "a", "P1", 1, None, None), ("V", "b", "P2", 2, 3, None), ("T", "c", "P1", None, 4, None)],
        "majortext string, minortext string, boroughname string, `202401` bigint, `202402` bigint, "
        "`202403` bigint")


def test_month_columns(spark):
    assert month_columns(wide(spark)) == ["202401", "202402", "202403"]
    assert month_columns(wide(spark), start="202402") == ["202402", "202403"]


def test_unpivot_keeps_nulls(spark):
    long = melt_months(wide(spark), ["majortext", "minortext", "boroughname"])
    assert long.count() == 9
    assert long.filter(F.col("count").isNull()).count() == 5


def test_horizontal_sum_skips_nulls(spark):
    df = wide(spark)
    got = [r.t for r in df.select(horizontal_sum(month_columns(df)).alias("t"))
           .orderBy("minortext").collect()]
    assert got == [1, 5, 4]


def test_all_null_column_sums_to_zero(spark):
    out = {r.month: r.total for r in column_sums(wide(spark), ["202401", "202403"]).collect()}
    assert out == {"202401": 3, "202403": 0}


def test_melt_sum_equals_horizontal_sum(spark):
    df = wide(spark)
    a = {r.boroughname: r["count"] for r in A.sum_by(A.wide_to_long(df), "boroughname").collect()}
    b = {r.boroughname: r.total for r in A.by_borough(df).collect()}
    assert a == b


def test_concat_requires_same_schema(spark):
    df = wide(spark)
    try:
        concat_same_schema(df, df.drop("202403"))
    except ValueError:
        pass
    else:
        raise AssertionError("schema mismatch accepted")
    assert concat_same_schema(df, df).count() == 6


def test_balanced_sum_many_columns(spark):
    cols = [f"{2010 + i // 12}{i % 12 + 1:02d}" for i in range(160)]
    df = spark.range(3).select(*[F.lit(1).cast("bigint").alias(c) for c in cols])
    assert [r.t for r in df.select(horizontal_sum(cols).alias("t")).collect()] == [160] * 3


def test_peak_lowest_ties_earliest(spark):
    m = spark.createDataFrame([("2024-01-01", 5), ("2024-02-01", 9), ("2024-03-01", 9),
                               ("2024-04-01", 5)], "month_year string, incidents bigint") \
        .select(F.to_date("month_year").alias("month_year"), "incidents")
    got = {r.kind: (str(r.month_year), r.incidents) for r in A.peak_and_lowest(m).collect()}
    assert got == {"peak": ("2024-02-01", 9), "lowest": ("2024-01-01", 5)}


def test_peak_lowest_empty(spark):
    m = spark.createDataFrame([], "month_year date, incidents bigint")
    assert A.peak_and_lowest(m).count() == 0


def test_count_by_null_group_and_exclusions(spark):
    df = spark.createDataFrame([("a",), (None,), ("Unknown",), ("a",), (None,)], "e string")
    assert {r.e: r.stops for r in A.count_by(df, "e", exclude=("Unknown",), keep_null=True).collect()} \
        == {"a": 2, None: 2}
    assert {r.e: r.stops for r in A.count_by(df, "e", exclude=("Unknown",)).collect()} == {"a": 2}


def test_melt_mixed_types_share_one_type(spark):
    from wideloom.operators.reshape import melt
    df = spark.createDataFrame([("k", 1, 2.5, "x")], "id string, a bigint, b double, c string")
    assert melt(df, ["id"], ["a", "b"]).schema["count"].dataType.simpleString() == "double"
    assert melt(df, ["id"], ["a", "c"]).schema["count"].dataType.simpleString() == "string"


def test_melt_months_prunes_columns_at_the_scan(spark, tmp_path):
    p = str(tmp_path / "wide.parquet")
    months = ["202401", "202402", "202403", "202404", "202405", "202406"]
    spark.createDataFrame([("V", "a", "P1", *range(6))],
                          "majortext string, minortext string, boroughname string, " +
                          ", ".join(f"`{m}` bigint" for m in months)).write.parquet(p)
    long = melt_months(spark.read.parquet(p), ["majortext", "minortext", "boroughname"],
                       start="202403", end="202404")
    plan = long._jdf.queryExecution().executedPlan().toString()
    schema = plan[plan.index("ReadSchema:"):].split("\n")[0]
    assert "202403" in schema and "202404" in schema
    assert "202401" not in schema and "202406" not in schema
    assert sorted(r["count"] for r in long.collect()) == [2, 3]
