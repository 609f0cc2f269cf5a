"""Sinks: zstd Parquet datasets (S4) and chart/table JSON documents.

A dataset is written beside its place and put there by renaming, so a failing job leaves the dataset of
before as it was and a reader never meets a half-written one. S8 payloads are built with ``to_json`` over
already-aggregated rows of a checked number, in an explicit order, one text line per document.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Rows of one JSON document; a longer one is an error, never cut.
MAX_DOCUMENT_ROWS = 10_000


@dataclass
class SaveResult:
    path: str
    rows: int
    columns: int


class ReplaceError(OSError):
    """A written dataset could not be put in its place; the one of before is back there."""


class _Place:
    """A folder and the hidden names beside it, on the file system that its path names."""

    def __init__(self, spark: SparkSession, path: str):
        self.path_class = spark._jvm.org.apache.hadoop.fs.Path
        self.at = self.path_class(path.rstrip("/"))
        self.fs = self.at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    def beside(self, kind: str):
        return self.path_class(self.at.getParent(), f".{self.at.getName()}.{kind}-{uuid.uuid4().hex}")

    def delete(self, path) -> None:
        if self.fs.exists(path):
            self.fs.delete(path, True)

    def restore(self) -> bool:
        """Bring back the dataset that a driver lost between the two renames had put aside."""
        parent = self.at.getParent()
        if self.fs.exists(self.at) or not self.fs.exists(parent):
            return False
        prefix = f".{self.at.getName()}.before-"
        aside = [s for s in self.fs.listStatus(parent) if s.getPath().getName().startswith(prefix)]
        if not aside:
            return False
        return self.fs.rename(max(aside, key=lambda s: s.getModificationTime()).getPath(), self.at)

    def replace(self, staged) -> None:
        before = self.beside("before")
        had = self.fs.exists(self.at)
        if had and not self.fs.rename(self.at, before):
            raise ReplaceError(f"{self.at}: cannot be put aside")
        done = False
        try:
            done = self.fs.rename(staged, self.at)
        finally:
            if not done and had:
                self.delete(self.at)
                self.fs.rename(before, self.at)
        if not done:
            raise ReplaceError(f"{self.at}: the new dataset cannot be put in place")
        self.delete(before)


def restore_dataset(spark: SparkSession, path: str) -> bool:
    """Undo a replacement that a lost driver left half done; whether there was one."""
    return _Place(spark, path).restore()


def save_parquet(df: DataFrame, path: str, *, compression: str = "zstd",
                 partition_by: list[str] | None = None) -> SaveResult:
    """Replace a Parquet dataset (a directory of part files); rows counted while writing.

    The rows go to a hidden folder beside ``path``, which then takes its place; the dataset of before is
    put aside meanwhile and comes back if that fails. ``df`` may read the dataset that it replaces.
    ``partition_by`` (e.g. a year column of a large long table) lays the files out by value so
    later filters on it prune whole directories at planning time."""
    place = _Place(df.sparkSession, path)
    place.restore()
    staged = place.beside("staged")
    obs = Observation("save")
    counted = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    writer = counted.write.option("compression", compression)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    try:
        writer.parquet(staged.toString())
        place.replace(staged)
    finally:
        place.delete(staged)
    return SaveResult(path, int(obs.get["rows"]), len(df.columns))


# ── JSON documents ────────────────────────────────────────────────────────────────────────────

Order = Sequence[str]           # column names, "-" before one that goes down


def _compare(order: Order):
    """Comparator of structs by the columns of ``order``; nulls come first either way."""
    def compare(a: Column, b: Column) -> Column:
        out = F.lit(0)
        for key in reversed(order):
            name, turn = key.lstrip("-"), -1 if key.startswith("-") else 1
            x, y = a[name], b[name]
            out = (F.when(x.isNull() & y.isNull(), out).when(x.isNull(), F.lit(-1)).when(y.isNull(), F.lit(1))
                    .when(x < y, F.lit(-turn)).when(x > y, F.lit(turn)).otherwise(out))
        return out
    return compare


def document_rows(df: DataFrame, order: Order, max_rows: int = MAX_DOCUMENT_ROWS) -> DataFrame:
    """One row ``rows``: an array of all rows of ``df`` as structs, in ``order``. More than ``max_rows``
    raise. Each task hands on at most one row more than that, and no row is numbered in one task."""
    if not order:
        raise ValueError("a document needs an order of its rows")
    few = df.limit(max_rows + 1).agg(F.collect_list(F.struct(*[F.col(c) for c in df.columns])).alias("rows"))
    checked = F.when(F.size("rows") > max_rows, F.raise_error(F.lit(f"a document of more than {max_rows} rows"))
                     .cast(few.schema["rows"].dataType)).otherwise(F.col("rows"))
    return few.select(F.array_sort(checked, _compare(order)).alias("rows"))


def chart_payload(df: DataFrame, label: str, value: str, *, order: Order, note: str | None = None,
                  max_rows: int = MAX_DOCUMENT_ROWS) -> DataFrame:
    """``{"labels":[...],"values":[...]}`` (plus ``note``) as a one-row ``json`` column, in the given
    order of rows (column names, ``-`` before one that goes down)."""
    rows = document_rows(df, order, max_rows)
    fields = [F.transform("rows", lambda r: r[label]).alias("labels"),
              F.transform("rows", lambda r: r[value]).alias("values")]
    if note is not None:
        fields.append(F.lit(note).alias("note"))
    return rows.select(F.to_json(F.struct(*fields)).alias("json"))


def _cell_json(c: Column) -> Column:
    # JSON text of one value: serialise {"v": value} and keep what follows the key; a null
    # field is omitted by to_json, so an empty match means null.
    enc = F.regexp_extract(F.to_json(F.struct(c.alias("v"))), r'^\{"v":(.*)\}$', 1)
    return F.coalesce(F.nullif(enc, F.lit("")), F.lit("null"))


def table_payload(df: DataFrame, *, order: Order, max_rows: int = MAX_DOCUMENT_ROWS) -> DataFrame:
    """S8 table: ``{"columns":[...],"rows":[[...], ...]}`` for a small, already-limited frame."""
    cells = F.transform("rows", lambda r: F.concat(
        F.lit("["), F.concat_ws(",", *[_cell_json(r[c]) for c in df.columns]), F.lit("]")))
    return document_rows(df, order, max_rows).select(F.concat(
        F.lit('{"columns":'), F.to_json(F.array(*[F.lit(c) for c in df.columns])),
        F.lit(',"rows":['), F.array_join(cells, ","), F.lit("]}")).alias("json"))


def write_documents(spark: SparkSession, docs: dict[str, DataFrame], out_dir: str) -> dict[str, str]:
    """Write each one-row ``json`` frame as a text dataset ``out_dir/<name>``; returns the paths."""
    paths = {}
    for name, df in docs.items():
        p = f"{out_dir.rstrip('/')}/{name}"
        place = _Place(spark, p)
        staged = place.beside("staged")
        try:
            df.coalesce(1).write.text(staged.toString())
            place.replace(staged)
        finally:
            place.delete(staged)
        paths[name] = p
    return paths
