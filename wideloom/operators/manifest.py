"""Resource selection over a manifest (M1-M4) as relational operations.

A *manifest* lists the files a portal publishes per dataset: ``short_id``, ``pos`` (0 = newest;
order is meaningful), ``name``, ``url``, ``format``. The *registry* lists the wanted datasets
(``key``, ``short_id``, ``resource_name_contains``, ``prefer_historical``, ``combine_resources``,
``combine_stride``, ...). Matching is a join on ``short_id`` with the name/format rules as a
residual predicate; picking the newest match is a ``min_by`` per key; stride sampling is a
``row_number``/``count`` window per key.

The registry is configuration (one row per wanted dataset, a few dozen as a rule); whether it is broadcast
is left to Spark, which knows its size. The manifest side is never collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import ends_with_any

# The marker of a historical resource (case-sensitive) and the accepted file types.
HISTORICAL_MARKER = "(Historical)"
TABULAR_EXTENSIONS = (".csv", ".xlsx", ".xls")
TABULAR_FORMATS = ("csv", "xlsx", "xls")

MANIFEST_SCHEMA = "short_id string, pos int, name string, url string, format string"
REGISTRY_SCHEMA = ("key string, short_id string, resource_name_contains string, prefer_historical boolean, "
                   "combine_resources boolean, combine_stride int")


class UnknownSourceError(KeyError):
    pass


def is_tabular(url: Column, fmt: Column) -> Column:
    """URL ends in a tabular extension, or the declared format is one (both case-insensitive)."""
    return (ends_with_any(F.coalesce(url, F.lit("")), TABULAR_EXTENSIONS)
            | F.lower(F.coalesce(fmt, F.lit(""))).isin(*TABULAR_FORMATS))


def name_matches(name: Column, hint: Column, prefer_historical: Column) -> Column:
    """Hint as a case-insensitive substring (empty hint matches all); the historical marker must
    be present exactly when historical data is preferred."""
    name = F.coalesce(name, F.lit(""))
    hint = F.coalesce(hint, F.lit(""))
    hint_ok = (hint == F.lit("")) | F.lower(name).contains(F.lower(hint))
    hist = name.contains(HISTORICAL_MARKER) == F.coalesce(prefer_historical, F.lit(False))
    return hint_ok & hist


def with_defaults(registry: DataFrame) -> DataFrame:
    """Missing optional settings: hint "" , not historical, not combined, stride 1."""
    return registry.select(
        "key", "short_id",
        F.coalesce("resource_name_contains", F.lit("")).alias("resource_name_contains"),
        F.coalesce("prefer_historical", F.lit(False)).alias("prefer_historical"),
        F.coalesce("combine_resources", F.lit(False)).alias("combine_resources"),
        F.greatest(F.coalesce("combine_stride", F.lit(1)), F.lit(1)).alias("combine_stride"))


def match_resources(manifest: DataFrame, registry: DataFrame) -> DataFrame:
    """M1: every (dataset key, resource) pair that passes the rules."""
    reg = with_defaults(registry).alias("r")
    m = manifest.alias("m")
    cond = ((F.col("m.short_id") == F.col("r.short_id"))
            & is_tabular(F.col("m.url"), F.col("m.format"))
            & name_matches(F.col("m.name"), F.col("r.resource_name_contains"),
                           F.col("r.prefer_historical")))
    return m.join(reg, cond).select(
        "r.key", "r.combine_resources", "r.combine_stride", "m.short_id", "m.pos", "m.name",
        "m.url", "m.format")


def pick_resources(matches: DataFrame, registry: DataFrame | None = None) -> DataFrame:
    """M2: the first match per key in manifest order (newest). With ``registry``, keys without a
    match are kept with null resource columns, so "nothing matched" is visible."""
    res = F.struct("pos", "name", "url", "format")
    picked = (matches.groupBy("key").agg(F.min_by(res, F.col("pos")).alias("r"))
              .select("key", "r.pos", "r.name", "r.url", "r.format"))
    if registry is None:
        return picked
    return registry.select("key").join(picked, "key", "left")


RUN_ROWS = 4096            # positions that are ranked together


def stride_sample(matches: DataFrame) -> DataFrame:
    """M3: positions 0, s, 2s, ... of each key's matches, plus the last one."""
    # ranks in two levels: runs of positions first (one row each), rows inside a run second
    run = F.floor(F.col("pos") / RUN_ROWS)
    runs = matches.groupBy("key", run.alias("run")).agg(F.count(F.lit(1)).alias("rows"))
    whole = Window.partitionBy("key")
    before = whole.orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("key", "run", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("ahead"),
                       F.sum("rows").over(whole).alias("n"))
    inside = Window.partitionBy("key", "run").orderBy("pos")
    ranked = (matches.withColumn("run", run)
              .withColumn("rn", F.row_number().over(inside) - 1)
              .join(runs, ["key", "run"])
              .withColumn("rn", F.col("rn") + F.col("ahead")).select(*matches.columns, "rn", "n"))
    keep = ((F.col("rn") % F.col("combine_stride")) == 0) | (F.col("rn") == F.col("n") - 1)
    return ranked.filter(keep).drop("n")


def select_sources(registry: DataFrame, key: str | None = None) -> DataFrame:
    """M4 ``--source``: one exact key, or all. An unknown key is an error."""
    if key is None:
        return registry
    one = registry.filter(F.col("key") == key)
    if one.limit(1).count() == 0:
        raise UnknownSourceError(f"unknown source {key!r}")
    return one


def plan_refresh(manifest: DataFrame, registry: DataFrame, key: str | None = None) -> DataFrame:
    """M4 ``--dry-run``: what a refresh would read, without reading it.

    Single-file datasets get their newest match (``rn`` 0); combined datasets get their stride
    sample. Columns: key, rn, pos, name, url, format, combine_resources.
    """
    reg = select_sources(registry, key)
    matches = match_resources(manifest, reg)
    single = (pick_resources(matches.filter(~F.col("combine_resources")))
              .withColumn("rn", F.lit(0)).withColumn("combine_resources", F.lit(False)))
    combined = stride_sample(matches.filter(F.col("combine_resources")))
    cols = ["key", "rn", "pos", "name", "url", "format", "combine_resources"]
    return single.select(*cols).unionByName(combined.select(*cols))
