import pytest

from wideloom.sources.sheets import CELL_GRID_SCHEMA, NoDataSheetsError, stack_sheets


def test_sheet_rules(spark):
    grid = spark.createDataFrame([
        ("w", 0, "S1", 0, [" A ", None]),
        ("w", 0, "S1", 1, ["1"]),
        ("w", 0, "S1", 2, [None, None]),
        ("w", 0, "S1", 3, ["2", "3", "4"]),
        ("w", 1, "HeaderOnly", 0, ["x"]),
    ], CELL_GRID_SCHEMA)
    df = stack_sheets(grid)
    assert df.columns == ["A", "col_1", "_sheet"]
    assert sorted(tuple(r) for r in df.collect()) == [("1", None, "S1"), ("2", "3", "S1")]


def test_two_sheets_union(spark):
    grid = spark.createDataFrame([
        ("w", 0, "a", 0, ["k", "v"]), ("w", 0, "a", 1, ["1", "x"]),
        ("w", 1, "b", 0, ["k", "w"]), ("w", 1, "b", 1, ["2", "y"]),
    ], CELL_GRID_SCHEMA)
    df = stack_sheets(grid)
    assert df.columns == ["k", "v", "_sheet", "w"]
    assert df.count() == 2


def test_no_sheets(spark):
    grid = spark.createDataFrame([("w", 0, "a", 0, ["k"])], CELL_GRID_SCHEMA)
    with pytest.raises(NoDataSheetsError):
        stack_sheets(grid)


def test_repeated_and_dotted_headers(spark):
    from wideloom.plans.ingest import normalise
    grid = spark.createDataFrame([("w", 0, "a", 0, ["No. of k", "k", "k"]), ("w", 0, "a", 1, ["1", "2", "x"])],
                                 CELL_GRID_SCHEMA)
    df = stack_sheets(grid)
    assert df.columns == ["No. of k", "k", "k_3", "_sheet"]
    assert normalise(df)[0].dtypes == [("no_of_k", "bigint"), ("k", "bigint"), ("k_3", "string"),
                                       ("sheet", "string")]
