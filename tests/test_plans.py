"""Plan-shape checks: filters and column pruning reach the scan, no cross products, no Python
workers, top-k planned as TakeOrderedAndProject. The training-data queries, some of which have no SQL
form and use Python workers, are tested in ``tests/llm``."""

import pytest

import __spark_entry__ as E
from conftest import SF
from wideloom.plans import registered


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def queries():
    return E.queries()


def test_every_query_has_oracle(queries):
    assert set(registered.QUERIES) <= set(E.oracle_sql()) <= set(queries)


@pytest.mark.parametrize("name", sorted(registered.QUERIES))
def test_no_python_or_cartesian(spark, queries, name):
    df = queries[name](spark, SF["0.001"])
    assert len(set(df.columns)) == len(df.columns), f"{name}: duplicate column names"
    p = plan(df)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
                "FlatMapGroupsInPandas", "MapInPandas"):
        assert bad not in p, f"{name}: {bad}"


def test_pushdown_and_pruning(spark):
    from wideloom.plans import shapes as S
    li = S.table(spark, SF["0.001"], "lineitem")
    df = li.filter(li.l_shipdate >= "1996-01-01").select("l_quantity")
    p = plan(df)
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual(l_shipdate" in p
    assert "ReadSchema: struct<l_quantity:double,l_shipdate:timestamp_ntz>" in p


def test_topk_is_take_ordered(spark, queries):
    assert "TakeOrderedAndProject" in plan(queries["q16_top_legislation"](spark, SF["0.001"]))


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["month", "total"] and len(rows) > 0


def _partial_before_exchange(p: str) -> bool:
    """A hash exchange with an aggregate right above it (final) and right below it (map-side)."""
    lines = [ln.strip().lstrip("+-: ").strip() for ln in p.splitlines() if ln.strip()]
    for i, ln in enumerate(lines):
        if ln.startswith("Exchange hashpartitioning") and 0 < i < len(lines) - 1:
            if lines[i - 1].startswith("HashAggregate") and lines[i + 1].startswith("HashAggregate"):
                return True
    return False


def test_hot_key_and_hot_row_aggregate_map_side(spark):
    """A key (or a duplicated row) holding a third of the rows is combined in each task before
    the shuffle, and results stay exact."""
    from pyspark.sql import functions as F
    from wideloom.operators.union import dedupe
    from wideloom.plans.analyses import sum_by
    n = 30_000
    rows = [("HOT", 1) if i % 3 == 0 else (str(i % 97), i) for i in range(n)]
    df = spark.createDataFrame(rows, "k string, count bigint").repartition(8)
    s = sum_by(df, "k")
    assert _partial_before_exchange(plan(s))
    assert {r.k: r["count"] for r in s.collect()}["HOT"] == n // 3
    d = dedupe(df)
    assert _partial_before_exchange(plan(d))
    assert d.count() == 1 + (n - n // 3)


def test_session_defaults_adaptive(spark):
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"


def test_counts_come_from_footers(spark):
    from wideloom.sources.catalog import footer_count
    df = footer_count(spark, SF["0.001"] + "/events.parquet")
    assert "PushedAggregation: [COUNT(*)]" in plan(df) and "ReadSchema: struct<>" not in plan(df)
    assert df.first().rows == spark.read.parquet(SF["0.001"] + "/events.parquet").count()


def test_wide_table_needs_one_exchange(spark):
    from wideloom.plans import shapes as S
    wide = S.crime_wide(spark, SF["0.001"])
    assert plan(wide).count("Exchange") == 1
    assert "Pivot" not in plan(wide)


def test_meta_groups_no_key_for_the_month(spark):
    from wideloom.plans import shapes as S
    p = plan(S.latest_crime_month(spark, SF["0.001"]))
    assert "p_name" not in p and "keys=[]" in p


def test_full_series_is_in_a_total_order(spark):
    from wideloom.plans import analyses as A, shapes as S
    c = S.CrimeCounts(spark, SF["0.001"])
    df = A.full_series(c.historical(), c.current())
    p = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Sort [month" in p and all(f"{i}#" in p.split("Sort [")[1].split("]")[0] for i in A.WIDE_IDS)
