from wideloom.operators.sniff import sniff


def typed(spark, values, *, csv=False, schema="v string"):
    df = spark.createDataFrame([(v,) for v in values], schema).coalesce(1)
    out, _ = sniff(df, csv=csv)
    return out.schema["v"].dataType.simpleString(), [r[0] for r in out.collect()]


def test_ints_with_blank(spark):
    assert typed(spark, ["1", "007", ""]) == ("bigint", [1, 7, None])


def test_int_float_mix(spark):
    assert typed(spark, ["1", "2.5"]) == ("double", [1.0, 2.5])


def test_all_blank_stays_text(spark):
    assert typed(spark, ["", "", None]) == ("string", ["", "", None])


def test_late_text_is_kept(spark):
    kind, vals = typed(spark, ["1"] * 100 + ["x"])
    assert kind == "string" and vals[-1] == "x"
    kind, vals = typed(spark, ["1"] * 10_050 + ["abc"], csv=True)
    assert kind == "string" and vals[-1] == "abc"


def test_spark_lenient_number_forms_rejected(spark):
    assert typed(spark, ["1d", "2"])[0] == "string"
    assert typed(spark, [" 12 ", "3"])[0] == "string"


def test_overflow_not_bigint(spark):
    assert typed(spark, ["99999999999999999999"])[0] == "string"       # a double would lose digits


def test_csv_rules(spark):
    assert typed(spark, ["1"] * 499 + ["2.5"], csv=True)[0] == "double"
    kind, vals = typed(spark, ["1"] * 10_000 + ["2.5"], csv=True)
    assert kind == "double" and vals[-1] == 2.5
    assert typed(spark, ["true", "false"], csv=True) == ("boolean", [True, False])
    assert typed(spark, ["2024-03-05"], csv=True) == ("string", ["2024-03-05"])


def test_non_text_columns_untouched(spark):
    df = spark.createDataFrame([(1, "2")], "a bigint, b string")
    out, dec = sniff(df)
    assert out.dtypes == [("a", "bigint"), ("b", "bigint")]


def test_any_column_name(spark):
    df = spark.createDataFrame([("1", "x", "2.5")], "a string, b string, c string").toDF("No. of `x`", "a", "A")
    out, dec = sniff(df)
    assert out.dtypes == [("No. of `x`", "bigint"), ("a", "string"), ("A", "double")]
    assert [d.rule for d in dec] == ["N5", "none", "N5"]


def test_text_stays_where_a_value_would_not_survive(spark):
    rows = [("1e400", "12345678901234567890", "9007199254740993", "1", "0.1"), ("2.5", "3", "1.5", "2.5", "1e-400"), ("", None, "2", "7", "3")]
    df, dec = sniff(spark.createDataFrame(rows, "a string, b string, c string, d string, e string"))
    assert [d.kind for d in dec] == ["string", "string", "string", "double", "double"]
    assert df.collect()[0].b == "12345678901234567890" and df.collect()[0].a == "1e400"
