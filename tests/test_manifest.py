import pytest

from wideloom.operators.manifest import UnknownSourceError, match_resources, pick_resources, \
    plan_refresh, select_sources, stride_sample

REG = "key string, short_id string, resource_name_contains string, prefer_historical boolean, " \
      "combine_resources boolean, combine_stride int"
MAN = "short_id string, pos int, name string, url string, format string"


def test_pick_newest_match(spark):
    man = spark.createDataFrame([
        ("x", 0, "MPS Borough Level Crime (Historical)", "f0.csv", "CSV"),
        ("x", 1, "MPS Borough Level Crime.pdf", "f1.pdf", "PDF"),
        ("x", 2, "MPS BOROUGH LEVEL CRIME (most recent 24 months)", "f2.csv", "CSV"),
        ("x", 3, "MPS Borough Level Crime", "f3.csv", "CSV"),
        ("x", 4, "Borough Level Crime (historical)", "noext", "csv"),
    ], MAN)
    reg = spark.createDataFrame([("k", "x", "Borough Level Crime", False, False, 1),
                                 ("h", "x", "Borough Level Crime (Historical)", True, False, 1),
                                 ("none", "y", "", False, False, 1)], REG)
    picked = {r.key: r.pos for r in pick_resources(match_resources(man, reg), reg).collect()}
    # lower-case "(historical)" is not the marker; a url without extension but format csv qualifies
    assert picked == {"k": 2, "h": 0, "none": None}


@pytest.mark.parametrize("n,s,expected", [
    (45, 22, [0, 22, 44]), (24, 4, [0, 4, 8, 12, 16, 20, 23]), (1, 4, [0]),
    (40, 1, list(range(40))), (5, 2, [0, 2, 4])])
def test_stride(spark, n, s, expected):
    man = spark.createDataFrame([("x", i, f"r{i}", f"r{i}.csv", "csv") for i in range(n)], MAN)
    reg = spark.createDataFrame([("k", "x", "", False, True, s)], REG)
    got = sorted(r.pos for r in stride_sample(match_resources(man, reg)).collect())
    assert got == expected


def test_select_and_plan(spark):
    reg = spark.createDataFrame([("k", "x", "", False, False, 1)], REG)
    with pytest.raises(UnknownSourceError):
        select_sources(reg, "nope")
    man = spark.createDataFrame([("x", i, f"r{i}", f"r{i}.csv", "csv") for i in range(3)], MAN)
    rows = plan_refresh(man, reg, "k").collect()
    assert [(r.key, r.pos) for r in rows] == [("k", 0)]
