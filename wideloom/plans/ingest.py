"""Refresh: manifest -> selected snapshot files -> typed, reconciled, de-duplicated Parquet.

Per dataset (M5/M6):

1. select resources from the manifest (newest match, or a stride sample of rolling snapshots), for all
   datasets in one job;
2. parse each: CSV (S1 + S1b) or a workbook cell grid (S2), chosen by extension (S3);
3. normalise: column names (N1/N2), then the numeric sniff (N5);
4. combined datasets: reconciling union (N6), exact dedupe (N7); a snapshot that fails to parse
   is skipped and *reported*;
5. write zstd Parquet that takes the place of the dataset of before (S4).

The driver only loops over datasets and snapshot files (a bounded list from the manifest); every
row-level step is a Spark plan. One failing dataset does not stop the others; the report says
which failed.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.columns import normalise_names
from ..operators.manifest import REGISTRY_SCHEMA, plan_refresh, select_sources
from ..operators.sniff import TypeDecision, sniff
from ..operators.union import dedupe_by_digest, reconcile_union
from ..sources.csv import is_excel, literal_path, parse_csv
from ..sources.sheets import stack_sheets
from ..sources.sinks import save_parquet
from ..session import scratch_dir

GridReader = Callable[[SparkSession, str], DataFrame]


def normalise(df: DataFrame, *, numeric: bool = True) -> tuple[DataFrame, list[TypeDecision]]:
    """N1 + N2 names, then N5 on the columns still text. ``numeric=False`` renames only (for frames
    whose text columns were already sniffed)."""
    df = normalise_names(df)
    return sniff(df) if numeric else (df, [])


class NoGridReaderError(ValueError):
    """A workbook is to be read and no reader of cell grids was given."""


def parse_resource(spark: SparkSession, url: str, *, grid_reader: GridReader | None = None,
                   multiline: bool | None = None) -> DataFrame:
    """S3 + S1/S2 + normalise for one resource path. ``grid_reader`` gives a workbook's cells (see
    :mod:`wideloom.sources.sheets`); decoding workbook files is no work of this library."""
    if is_excel(url):
        if grid_reader is None:
            raise NoGridReaderError(f"{url}: a workbook needs a grid_reader")
        # Decode once: the sheet metadata, the rows, the typing pass and the final write all
        # read the checkpointed grid instead of re-running the workbook decoder.
        scratch_dir(spark)
        return normalise(stack_sheets(grid_reader(spark, url).checkpoint(eager=True)))[0]
    # S1b has seen every value already, so N5 has nothing to add; a resource's path is no pattern
    return normalise(parse_csv(spark, literal_path(url), multiline=multiline)[0], numeric=False)[0]


@dataclass
class RefreshReport:
    key: str
    path: str | None = None
    rows: int = 0
    status: str = "ok"           # ok | no-match | no-data | failed
    error: str | None = None
    used: list[str] = field(default_factory=list)
    skipped: list[str] = field(default_factory=list)


REPORT_SCHEMA = ("key string, path string, rows bigint, status string, error string, "
                 "used array<string>, skipped array<string>")


def registry_of(spark: SparkSession, sources: list[dict]) -> DataFrame:
    """The settings of ``sources`` that choose files, as a registry frame."""
    return spark.createDataFrame([(s["key"], s["short_id"], s.get("resource_name_contains", ""),
                                   bool(s.get("prefer_historical", False)), bool(s.get("combine_resources", False)),
                                   int(s.get("combine_stride", 1) or 1)) for s in sources], REGISTRY_SCHEMA)


def chosen_files(spark: SparkSession, sources: list[dict], manifest: DataFrame) -> dict[str, list[str]]:
    """The files of every dataset in reading order, from one job over the manifest; a dataset without a
    match has none. Only the chosen files' names reach the driver."""
    rows = plan_refresh(manifest, registry_of(spark, sources)).select("key", "rn", "url").collect()
    found: dict[str, list[str]] = {s["key"]: [] for s in sources}
    for r in sorted(rows, key=lambda r: (r.key, r.rn)):
        found[r.key].append(r.url)
    return found


def refresh_source(spark: SparkSession, source: dict, manifest: DataFrame, out_root: str, **kw) -> RefreshReport:
    """One dataset: pick (or stride-sample) its files, parse, combine, save."""
    return refresh_files(spark, source, chosen_files(spark, [source], manifest)[source["key"]], out_root, **kw)


def refresh_files(spark: SparkSession, source: dict, urls: list[str], out_root: str, *,
                  grid_reader: GridReader | None = None, multiline: bool | None = None,
                  partition_by: list[str] | None = None, snapshot_workers: int = 4) -> RefreshReport:
    """One dataset from its chosen files: parse, combine, save."""
    report = RefreshReport(source["key"])
    if not urls:
        report.status = "no-match"
        return report

    def parse(url: str):
        try:
            return url, parse_resource(spark, url, grid_reader=grid_reader, multiline=multiline), None
        except Exception as e:  # noqa: BLE001 - a bad snapshot is skipped and reported
            return url, None, e

    # Snapshots are independent: their (small, bounded) typing jobs run from a few driver
    # threads; results keep manifest order, so the union's first-seen column order is unchanged.
    if snapshot_workers > 1 and len(urls) > 1:
        from concurrent.futures import ThreadPoolExecutor
        with ThreadPoolExecutor(max_workers=min(snapshot_workers, len(urls))) as pool:
            parsed = list(pool.map(parse, urls))
    else:
        parsed = [parse(u) for u in urls]
    frames = []
    for url, df, err in parsed:
        if err is None:
            frames.append(df)
            report.used.append(url)
        elif not source.get("combine_resources"):
            raise err
        else:
            report.skipped.append(f"{url}: {type(err).__name__}: {str(err)[:200]}")
    if not frames:
        # every snapshot failed: skipped with a warning, like "no match" (not a failure)
        report.status = "no-data"
        report.error = "all resources failed"
        return report
    data = dedupe_by_digest(reconcile_union(frames)) if source.get("combine_resources") else frames[0]
    res = save_parquet(data, f"{out_root.rstrip('/')}/{source['output']}",
                       partition_by=[c for c in (partition_by or []) if c in data.columns])
    report.path, report.rows = res.path, res.rows
    return report


def refresh(spark: SparkSession, sources: list[dict], manifest: DataFrame, out_root: str, *,
            parallel: int = 1, **kw) -> DataFrame:
    """M5: refresh every source independently; the report is a DataFrame, one row per source.

    The files of all sources are chosen by one job over the manifest. Datasets share nothing after that,
    so with ``parallel > 1`` their Spark jobs are submitted from a small driver thread pool and run
    concurrently on the cluster; one failure never stops the others and leaves its own dataset as it was.
    """
    files = chosen_files(spark, sources, manifest)

    def one(s: dict) -> RefreshReport:
        try:
            return refresh_files(spark, s, files[s["key"]], out_root, **kw)
        except Exception as e:  # noqa: BLE001 - isolation: record and continue
            return RefreshReport(s["key"], status="failed",
                                 error=f"{type(e).__name__}: {str(e)[:300]}")

    if parallel > 1:
        from concurrent.futures import ThreadPoolExecutor
        with ThreadPoolExecutor(max_workers=parallel) as pool:
            reports = list(pool.map(one, sources))
    else:
        reports = [one(s) for s in sources]
    rows = [(r.key, r.path, r.rows, r.status, r.error, r.used, r.skipped) for r in reports]
    return spark.createDataFrame(rows, REPORT_SCHEMA)


def summarise(report: DataFrame) -> DataFrame:
    """A10: files written, total rows, failed keys."""
    return report.agg(
        F.count(F.when(F.col("status") == "ok", 1)).alias("files"),
        F.coalesce(F.sum(F.when(F.col("status") == "ok", F.col("rows"))), F.lit(0)).alias("rows"),
        F.collect_list(F.when(F.col("status") == "failed", F.col("key"))).alias("failed"))


def list_sources(registry: DataFrame) -> DataFrame:
    """M4 ``--list``: key and name of every configured dataset."""
    return registry.select("key", "name").orderBy("key")


def sources_for(spark: SparkSession, registry: DataFrame, key: str | None = None) -> list[dict]:
    """M4: registry rows for one key (error if unknown) or all, as plain dicts."""
    return [r.asDict() for r in select_sources(registry, key).collect()]
