"""Property checks with hypothesis; Spark work is batched per example set."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF
from wideloom.functions.text import title_case

TEXT = st.text(alphabet=st.sampled_from("abcXYZ éÉßǆﬁİ中ⓐª-' 12\t."), max_size=14)


@settings(max_examples=8, deadline=None)
@given(st.lists(TEXT, min_size=50, max_size=50))
def test_title_case_matches_python(spark, words):
    df = spark.createDataFrame([(w,) for w in words], "w string")
    got = [r.t for r in df.select(title_case("w").alias("t")).collect()]
    assert got == [w.title() for w in words]


def test_totals_agree_across_shapes(spark):
    q = E.queries()
    d = SF["0.001"]
    q1 = q["q01_monthly_totals"](spark, d).agg(F.sum("total")).first()[0]
    q4 = q["q04_by_borough"](spark, d).agg(F.sum("total")).first()[0]
    q9 = q["q09_by_category_long"](spark, d).agg(F.sum("count")).first()[0]
    q20 = q["q20_full_series_monthly"](spark, d).agg(F.sum("count")).first()[0]
    li = spark.read.parquet(f"{d}/lineitem.parquet").agg(F.sum("l_quantity")).first()[0]
    assert q1 == q4 == q9 == q20 == int(li)


def test_dedupe_of_self_union_is_idempotent(spark):
    from wideloom.operators.union import dedupe, reconcile_union
    from wideloom.plans.shapes import event_snapshots
    snaps = event_snapshots(spark, SF["0.001"])
    once = dedupe(reconcile_union(snaps))
    twice = dedupe(reconcile_union(snaps + snaps))
    assert once.count() == twice.count() and once.exceptAll(twice).count() == 0


@settings(max_examples=15, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a", "b", "c", "d", "e"]), min_size=1, max_size=4,
                         unique=True), min_size=1, max_size=4),
       st.lists(st.sampled_from(["bigint", "double", "string"]), min_size=20, max_size=20))
def test_union_schema_rule(frames, types):
    """N6 target schema: first-seen order; a name with two different types becomes string."""
    from pyspark.sql import types as T
    from wideloom.operators.union import target_schema

    class Fake:  # only .schema is read
        def __init__(self, schema):
            self.schema = schema

    names = {"bigint": T.LongType(), "double": T.DoubleType(), "string": T.StringType()}
    it = iter(types)
    fakes, seen_types = [], {}
    for cols in frames:
        fields = []
        for c in cols:
            t = next(it)
            fields.append(T.StructField(c, names[t]))
            seen_types.setdefault(c, set()).add(t)
        fakes.append(Fake(T.StructType(fields)))
    got = target_schema(fakes)
    order = list(dict.fromkeys(c for cols in frames for c in cols))
    assert [n for n, _ in got] == order
    for n, t in got:
        kinds = seen_types[n]
        assert t == (names[kinds.pop()] if len(kinds) == 1 else T.StringType())
