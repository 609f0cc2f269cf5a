import pytest

from wideloom.operators.columns import NameCollisionError, find_column, normalise_name, normalise_names

CASES = [
    (" Major Text ", "major_text"),
    ("Count (of) Incidents", "count_of_incidents"),
    ("Area/Borough - Name", "area_borough_name"),
    ("No.", "no"),
    ("_sheet", "sheet"),
    ("202403", "202403"),
    ("Tab\tName", "tab\tname"),
]


@pytest.mark.parametrize("raw,expected", CASES)
def test_normalise_name(raw, expected):
    assert normalise_name(raw) == expected


def test_normalise_names_frame(spark):
    df = spark.createDataFrame([(1, 2, 3)], [" Major Text ", "Count (of) Incidents", "202403"])
    assert normalise_names(df).columns == ["major_text", "count_of_incidents", "202403"]


def test_collision_and_empty(spark):
    with pytest.raises(NameCollisionError):
        normalise_names(spark.createDataFrame([(1, 2)], ["A B", "A-B"]))
    with pytest.raises(NameCollisionError):
        normalise_names(spark.createDataFrame([(1,)], ["()"]))


def test_find_column_schema_order():
    cols = ["month_year", "county", "offence_type", "count"]
    assert find_column(cols, "count", "total") == "county"   # the documented trap
    assert find_column(cols, "type", "offence") == "offence_type"
    assert find_column(cols, "legislat") is None


def test_names_of_a_table_of_headers(spark):
    from pyspark.sql import functions as F
    from wideloom.operators.columns import name_collisions, normalise_name, normalised
    names = ["A B", "A-B", "a.b", " x ", "x/y (z)", "()", "--", "__a__", "Ä ö", "tab\tkept", "50%"]
    df = spark.createDataFrame([(i % 2, n) for i, n in enumerate(names)], "file int, name string")
    assert [r.n for r in df.select(normalised(F.col("name")).alias("n")).collect()] == [normalise_name(n) for n in names]
    got = {(r.file, r.normalised): r.headers for r in name_collisions(df, ["file"], "name").collect()}
    assert got == {(0, "a_b"): ["A B", "a.b"], (1, ""): ["()"], (0, ""): ["--"]}
