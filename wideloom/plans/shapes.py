"""Reference-shaped datasets derived from the driver's TPC-H-like tables.

The original works on published crime files (wide monthly counts, a long dashboard, stop-search
records, offence counts, rolling snapshots, a resource manifest). Those files are not available,
so these functions derive frames of the same *shape* from the driver tables, with Spark, so that
every registered query grows with its input:

* wide monthly table: ``lineitem ⋈ part ⋈ supplier ⋈ nation`` - place = ``n_name``,
  major category = ``p_type``, minor category = ``p_name``, one ``YYYYMM`` column per ship month
  holding ``sum(l_quantity)`` (null where a key has no rows that month);
* dashboard: ``orders ⋈ customer ⋈ nation`` counted per status, segment, priority and month;
* stop-search-like records: ``events`` with a nullable ethnicity, a legislation and an outcome;
* VAWG-like records: ``lineitem ⋈ part`` with a type column and a count column;
* rolling snapshots: overlapping ``events`` windows with drifted schemas.

Joins: ``nation`` has a fixed 25 rows and is broadcast explicitly. ``part``, ``supplier`` and
``customer`` grow with the scale factor, so no hint is given: AQE broadcasts them only when the
measured size is under ``spark.sql.autoBroadcastJoinThreshold`` and otherwise keeps a shuffle join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir

# Months kept in the "current" file (the rest are "historical").
CURRENT_MONTHS = 24


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    # 25 rows by definition of the schema: a proven bound, safe to broadcast.
    return F.broadcast(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"))


def split_months(months: list[str], current: int = CURRENT_MONTHS) -> tuple[list[str], list[str]]:
    """(historical, current): the last ``current`` months are current."""
    return months[:-current] if current else months, months[-current:] if current else []


def crime_long_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per (major, minor, place, month) quantity totals: the long form before pivoting (lazy).

    Join order is chosen for scale (Spark keeps the DataFrame order without CBO): ``supplier``
    first, which adds only an integer nation key; then ``part``, whose type and name feed the
    partial aggregation in the same stage, so the text keys never ride a fact-sized shuffle when
    either dimension is too large to broadcast; nation names are attached to aggregated rows only.
    """
    li = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_quantity", "l_shipdate")
    supp = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_name")
    joined = (li.join(supp, li.l_suppkey == supp.s_suppkey)
                .join(part, li.l_partkey == part.p_partkey))
    # Month as an integer yyyymm key: cheaper to compute and hash per row than formatted text;
    # it becomes the ``YYYYMM`` column name only on the aggregated rows.
    ym = F.year("l_shipdate") * 100 + F.month("l_shipdate")
    agg = (joined.groupBy("p_type", "p_name", "s_nationkey", ym.alias("ym"))
                 .agg(F.sum(F.col("l_quantity").cast("bigint")).alias("qty")))
    named = agg.join(_nation(spark, sf_dir), agg.s_nationkey == F.col("n_nationkey"))
    return named.select(F.col("p_type").alias("majortext"), F.col("p_name").alias("minortext"),
                        F.col("n_name").alias("boroughname"),
                        F.lpad(F.col("ym").cast("string"), 6, "0").alias("month"), "qty")


def latest_crime_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row ``month``: the last ``YYYYMM`` that a wide table over all months would have, from one
    aggregate; the dimensions are only looked up, and no key is grouped."""
    li = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_shipdate")
    supp = table(spark, sf_dir, "supplier").join(_nation(spark, sf_dir), F.col("s_nationkey") == F.col("n_nationkey"), "left_semi")
    rows = li.join(supp, li.l_suppkey == supp.s_suppkey, "left_semi") \
        .join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"), "left_semi")
    return rows.agg(F.date_format(F.max("l_shipdate"), "yyyyMM").alias("month"))


class CrimeCounts:
    """The aggregated long counts, computed once and checkpointed to the shared scratch folder.

    It has a row per key and month that occur, not per row of ``lineitem`` (how many keys there are is up
    to the part names), and it stays distributed; every wide table (current, historical, all months) and
    the month list come from it: one pass over the fact table instead of one per use.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        scratch_dir(spark)   # checkpoint() needs the shared folder registered
        # The month list is observed while the checkpoint job runs (a set bounded by the
        # calendar, merged from the tasks), so no second job reads the counts for it.
        obs = Observation("months")
        observed = crime_long_counts(spark, sf_dir).observe(
            obs, F.array_sort(F.collect_set("month")).alias("months"))
        self.counts = observed.checkpoint(eager=True)
        self.months = [m for m in obs.get["months"] if m is not None]

    def wide(self, months: list[str] | None = None) -> DataFrame:
        """Wide table over ``months`` (default all): one conditional sum per month, so one aggregation and
        one exchange; keys with no rows in these months are absent."""
        months = self.months if months is None else months
        src = self.counts.filter(F.col("month").isin(months)) if months != self.months else self.counts
        return (src.groupBy("majortext", "minortext", "boroughname")
                   .agg(*[F.sum(F.when(F.col("month") == m, F.col("qty"))).alias(m) for m in months]))

    def current(self) -> DataFrame:
        return self.wide(split_months(self.months)[1])

    def historical(self) -> DataFrame:
        return self.wide(split_months(self.months)[0])


def crime_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide monthly table over every ship month in the data."""
    return CrimeCounts(spark, sf_dir).wide()


def dashboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly-dashboard-shaped long counts: area type = order status, area = customer nation,
    measure = market segment, crime type = order priority, ``month_year`` = first of the month.
    Grouped on the integer nation key; names are attached to the aggregated rows only."""
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus", "o_orderpriority",
                                              "o_orderdate")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    agg = (o.join(c, o.o_custkey == c.c_custkey)
            .groupBy("o_orderstatus", "c_nationkey", "c_mktsegment", "o_orderpriority",
                     F.trunc(F.to_date("o_orderdate"), "month").alias("month_year"))
            .agg(F.count(F.lit(1)).alias("count")))
    named = agg.join(_nation(spark, sf_dir), agg.c_nationkey == F.col("n_nationkey"))
    return named.select(F.col("o_orderstatus").alias("area_type"), F.col("n_name").alias("area_name"),
                        F.col("c_mktsegment").alias("measure"),
                        F.col("o_orderpriority").alias("crime_type"), "month_year", "count")


def stop_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stop-search-shaped records from ``events``: ``error`` -> null ethnicity, ``view`` ->
    ``Unknown``; legislation = the ``k`` property (null for sign-ups); outcome = weekday name."""
    ev = table(spark, sf_dir, "events")
    et = F.col("event_type")
    return ev.select(
        "event_id", "ts", "user_id",
        F.when(et == "error", F.lit(None)).when(et == "view", F.lit("Unknown"))
         .otherwise(et).alias("ethnicappearance"),
        F.when(et != "signup", F.get_json_object("props", "$.k")).alias("legislation"),
        F.date_format("ts", "EEEE").alias("outcome"))


def offence_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """VAWG-shaped records: a month, a type column and a count column (found by name later)."""
    li = table(spark, sf_dir, "lineitem").select("l_partkey", "l_shipdate", "l_quantity")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    return (li.join(part, li.l_partkey == part.p_partkey)
              .select(F.trunc(F.to_date("l_shipdate"), "month").alias("month_year"),
                      "p_type", F.col("l_quantity").cast("bigint").alias("offence_count")))


# The three rolling snapshots as percent spans of the events' time range,
# overlapping on purpose; the last one has the drifted schema.
SNAPSHOT_SPANS = ((0, 60), (30, 80), (45, 100))


def snapshot_bounds(spark: SparkSession, sf_dir: str) -> list[tuple[int, int]]:
    """[start, end) of each snapshot in epoch microseconds, from the table's own min/max ``ts``
    (one aggregate row), so the snapshots always cover the whole table whatever its span."""
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    r = table(spark, sf_dir, "events").agg(F.min(us).alias("lo"), F.max(us).alias("hi")).first()
    lo, width = r.lo, r.hi - r.lo + 1
    return [(lo + width * a // 100, lo + width * b // 100) for a, b in SNAPSHOT_SPANS]


def _ntz(micros: int):
    from datetime import datetime, timedelta
    t = datetime(1970, 1, 1) + timedelta(microseconds=micros)
    return F.to_timestamp_ntz(F.lit(t.strftime("%Y-%m-%d %H:%M:%S.%f")))


def event_snapshots(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Three rolling 'snapshots' of ``events``; the newest drifted: ``event_type`` renamed to
    ``eventtype``, ``value`` published as text, and a new ``channel`` column. Bounds are
    compared with ``ts`` itself, so they reach the Parquet scan as pushed filters."""
    ev = table(spark, sf_dir, "events")
    out = []
    for i, (lo, hi) in enumerate(snapshot_bounds(spark, sf_dir)):
        w = ev.filter((F.col("ts") >= _ntz(lo)) & (F.col("ts") < _ntz(hi)))
        if i < 2:
            out.append(w.select("event_id", "ts", "user_id", "event_type", "value", "props"))
        else:
            out.append(w.select("event_id", "ts", "user_id",
                                F.col("event_type").alias("eventtype"),
                                F.col("value").cast("string").alias("value"), "props",
                                F.upper("event_type").alias("channel")))
    return out


def stage_catalog(spark: SparkSession, sf_dir: str, root: str) -> dict[str, int]:
    """Write the driver-derived datasets under ``root`` with the registry's output names, so the
    catalog, the site build and the notebook tables run end to end on them.

    Current and historical borough files come from one checkpointed aggregate; the dashboard also
    carries the notebook's ``count_of_incidents`` name; thorough searches are the reconciled and
    de-duplicated event snapshots. Returns rows written per dataset.
    """
    from ..operators.union import dedupe, reconcile_union
    from ..sources.registry import source
    from ..sources.sinks import save_parquet

    counts = CrimeCounts(spark, sf_dir)
    dash = dashboard(spark, sf_dir)
    datasets = {
        "recorded-crime-borough": counts.current(),
        "recorded-crime-borough-historical": counts.historical(),
        "monthly-crime-dashboard": dash.withColumn("count_of_incidents", F.col("count")),
        "stop-search": stop_records(spark, sf_dir),
        "vawg-offences": offence_records(spark, sf_dir),
        "thorough-searches": dedupe(reconcile_union(event_snapshots(spark, sf_dir))),
    }
    return {key: save_parquet(df, f"{root.rstrip('/')}/{source(key)['output']}").rows
            for key, df in datasets.items()}
