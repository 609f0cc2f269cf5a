from pyspark.sql import functions as F
from pyspark.sql import types as T

from wideloom.operators.union import dedupe, reconcile_union


def test_missing_columns_and_order(spark):
    a = spark.createDataFrame([(1, "x")], "a bigint, b string")
    b = spark.createDataFrame([(2, 3)], "a bigint, c bigint")
    out = reconcile_union([a, b])
    assert out.dtypes == [("a", "bigint"), ("b", "string"), ("c", "bigint")]
    assert [tuple(r) for r in out.collect()] == [(1, "x", None), (2, None, 3)]


def test_type_conflict_goes_to_text(spark):
    a = spark.createDataFrame([(1,)], "a bigint")
    b = spark.createDataFrame([(1.5,)], "a double")
    out = reconcile_union([a, b])
    assert out.dtypes == [("a", "string")]
    assert sorted(r.a for r in out.collect()) == ["1", "1.5"]


def test_conflict_is_sticky(spark):
    frames = [spark.createDataFrame([(1,)], "a bigint"), spark.createDataFrame([("q",)], "a string"),
              spark.createDataFrame([(3,)], "a bigint")]
    out = reconcile_union(frames)
    assert out.dtypes == [("a", "string")] and out.count() == 3


def test_first_seen_order(spark):
    a = spark.createDataFrame([(1, 2)], "b bigint, a bigint")
    b = spark.createDataFrame([(3, 4)], "a bigint, b bigint")
    out = reconcile_union([a, b])
    assert out.columns == ["b", "a"]
    assert sorted(tuple(r) for r in out.collect()) == [(1, 2), (4, 3)]


def test_dedupe_null_equals_null(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "x")], "a bigint, b string")
    assert dedupe(df).count() == 2


def test_dedupe_idempotent_on_self_union(spark):
    df = spark.createDataFrame([(i % 7, str(i % 3)) for i in range(100)], "a bigint, b string")
    assert dedupe(reconcile_union([df, df])).count() == dedupe(df).count()


def test_numbers_as_plain_text(spark):
    import random
    from decimal import Decimal
    from wideloom.operators.union import plain_text
    rng = random.Random(1)
    values = [0.0, -0.0, 5.0, 1.2345678e7, 1e10, 1.5e-7, -2.5e-10, 123.456, 1e22, 1.7976931348623157e308, 0.1, -7.0, 0.001, 100.25,
              None] + [rng.uniform(-1, 1) * 10 ** rng.randint(-20, 25) for _ in range(200)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for r in df.select("x", F.col("x").cast("string").alias("s"), plain_text(F.col("x"), T.DoubleType()).alias("t")).collect():
        if r.x is None:
            assert r.t is None
            continue
        want = format(Decimal(r.s), "f")
        want = want.rstrip("0").rstrip(".") if "." in want else want
        assert r.t == ("0" if want == "-0" else want)
    odd = spark.createDataFrame([(float("nan"),), (float("inf"),)], "x double")
    assert [r.t for r in odd.select(plain_text(F.col("x"), T.DoubleType()).alias("t")).collect()] == ["NaN", "Infinity"]


def test_one_number_of_two_snapshots_is_one_row(spark):
    a = spark.createDataFrame([("x", 12345678), ("y", 5)], "k string, n bigint")
    b = spark.createDataFrame([("x", 1.2345678e7), ("y", 5.5)], "k string, n double")
    assert sorted(map(tuple, dedupe(reconcile_union([a, b])).collect())) == [("x", "12345678"), ("y", "5"), ("y", "5.5")]


def test_names_with_backticks_and_dots(spark):
    a = spark.createDataFrame([(1, "p")], "`a.b` int, `c``d` string")
    b = spark.createDataFrame([("q", 2.5)], "`c``d` string, `a.b` double")
    got = reconcile_union([a, b])
    assert got.columns == ["a.b", "c`d"] and sorted(map(tuple, got.collect())) == [("1", "p"), ("2.5", "q")]


def test_digest_dedupe_equals_distinct(spark):
    from wideloom.operators.union import dedupe_by_digest, row_digest
    nan = float("nan")
    rows = [("a", 1.0, None), ("a", 1.0, None), ("a", None, 1), ("b", nan, 2), ("b", nan, 2), ("c", -0.0, 3), ("c", 0.0, 3),
            (None, None, None), (None, None, None), ("d", 2.0, 4)] + [(f"k{i % 50}", float(i % 5), i % 3) for i in range(300)]
    df = spark.createDataFrame(rows, "`a.b` string, `x``y` double, z int").repartition(4)

    def have(d):
        return sorted(str(tuple(0.0 if v == 0 else v for v in r)) for r in d.collect())
    want = have(df.distinct())
    assert have(dedupe_by_digest(df)) == want and dedupe_by_digest(df).columns == df.columns
    for weak in (lambda d: [F.lit(1).cast("bigint")] * 2, lambda d: [row_digest(d)[0] % 3, F.lit(0).cast("bigint")]):
        assert have(dedupe_by_digest(df, digest=weak)) == want               # digests of different rows are equal
    assert have(dedupe_by_digest(df, max_repeated=2)) == want                # too many: whole rows
    assert dedupe_by_digest(df.limit(0)).count() == 0


def test_digest_dedupe_shuffles_no_row_that_occurs_once(spark):
    from wideloom.operators.union import dedupe_by_digest
    df = spark.range(1000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("wide"))
    p = dedupe_by_digest(df.union(df.limit(3)))._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in p and "LeftSemi" in p and "rightHint=(strategy=broadcast)" in p
