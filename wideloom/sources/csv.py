"""CSV snapshots (S1, S1a, S1b) and the extension dispatch (S3).

A snapshot is read entirely as text, then typed by :mod:`wideloom.operators.sniff`, so no value
is ever silently parsed by Spark's looser inference (Spark would turn ``2024-03-05`` into a date;
the data keeps text).

* Encoding (S1a): UTF-8 unless a file holds bytes that are not valid UTF-8, then Latin-1. Decided
  per file with one aggregate over ``spark.read.text``, one row per file.
* Headers: files are grouped by their header, so files of one path may order their columns in
  different ways; the groups are united by name. Fields are read by position, so a name may hold
  any character. A blank name becomes ``_c<i>``; a repeated name gets its position as a suffix.
* Ragged rows: with an all-text schema and ``PERMISSIVE`` mode, extra fields are dropped and short
  rows padded with nulls.
* Quotes: ``escape='"'`` keeps doubled quotes. A quoted field may hold line breaks; the same pass that
  checks the encoding finds files in which a line leaves a quote open. Their lines are put together to
  records by :mod:`wideloom.sources.records`, so such a file is read by many tasks like any other; a
  quote inside an unquoted field opens nothing.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import ends_with_any
from ..operators.columns import unique_names
from ..operators.sniff import TypeDecision, sniff
from .records import leaves_open, records

# The encodings tried, in order, and the spreadsheet extensions.
UTF8 = "UTF-8"
LATIN1 = "ISO-8859-1"
EXCEL_EXTENSIONS = (".xlsx", ".xls")

# Spark reads a quoted empty field ("") as null like an absent one; the published
# files distinguish them (quoted "" is an empty string, an absent field is null). Quoted empties
# are read as this private-use marker and turned back into "" right after the read.
QUOTED_EMPTY = "\ue000\ue001"

# file -> (encoding, whether a quoted field spans a line break, digest of the header line)
Profiles = dict[str, tuple[str, bool, str]]


def literal_path(path: str) -> str:
    """A path whose characters that a reader would take for a pattern are escaped."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def file_profiles(spark: SparkSession, paths: Sequence[str] | str) -> Profiles:
    """S1a + line-break check, one parallel pass over the raw lines: per file, its encoding,
    whether a quoted field spans a line break, and a digest that files with one header share.

    If no line leaves a quote open, each line is a record and the file can be split and parsed line by
    line; the others need their lines put together. A blank first line or one that a quote leaves open
    does not show the header, so such a file stands alone. ``paths`` may be folders or patterns.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    v, f = F.col("value"), F.col("_metadata.file_path")
    lines = spark.read.text(paths).select(
        f.alias("f"), F.is_valid_utf8(v).alias("ok"), leaves_open(v).alias("open"), v,
        F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("at"))
    shown = ~F.col("open") & (F.trim(v) != "")
    lines = lines.withColumn("head", F.md5(F.when(shown, v.cast("binary")).otherwise(F.col("f").cast("binary"))))
    prof = lines.groupBy("f").agg(F.bool_and("ok").alias("ok"), F.bool_or("open").alias("open"),
                                  F.min_by("head", "at").alias("head"))
    return {literal_path(unquote(r.f)): (UTF8 if r.ok else LATIN1, r.open, r.head) for r in prof.collect()}


def file_encodings(spark: SparkSession, paths: Sequence[str] | str) -> dict[str, str]:
    """Per-file encoding choice."""
    return {f: p[0] for f, p in file_profiles(spark, paths).items()}


def _header(spark: SparkSession, path: str, encoding: str, multi: bool) -> list[str]:
    """Column names from the first record (see the module's notes on blank and repeated names).
    Spark cannot infer the width of a ``multiLine`` file whose path holds square brackets."""
    first = (spark.read.option("header", False).option("encoding", encoding)
             .option("escape", '"').option("multiLine", multi).csv(path).take(1))
    if not first:
        raise ValueError(f"{path}: empty CSV file")
    return unique_names([c if c not in (None, "") else f"_c{i}" for i, c in enumerate(first[0])])


def _read_files(spark: SparkSession, width: int, enc: str, multi: bool, files: list[str]) -> DataFrame:
    schema = T.StructType([T.StructField(f"_{i}", T.StringType()) for i in range(width)])
    if multi:
        options = {"mode": "PERMISSIVE", "escape": '"', "emptyValue": QUOTED_EMPTY}
        rows = records(spark, files, enc).select(F.from_csv("record", schema.simpleString()[7:-1].replace(":", " "), options).alias("r"))
        return rows.select("r.*")
    return (spark.read.schema(schema).option("header", True).option("encoding", enc)
            .option("mode", "PERMISSIVE").option("escape", '"').option("emptyValue", QUOTED_EMPTY)
            .option("enforceSchema", True).csv(files))


def _keys(names: list[str]) -> list[tuple[str, int]]:
    """Names without regard to case and the spaces around them, each with its turn among equal ones."""
    seen: dict[str, int] = {}
    out = []
    for n in names:
        low = n.strip().casefold()
        seen[low] = seen.get(low, -1) + 1
        out.append((low, seen[low]))
    return out


def read_csv_text(spark: SparkSession, path: str | Sequence[str], *, encoding: str | None = None,
                  multiline: bool | None = None) -> DataFrame:
    """S1 without typing: all-text columns in order of first occurrence (files in path order); a
    column that a file lacks is null there. Headers of two files that differ in case or spaces around
    them only name one column, spelled as it came first.

    ``encoding`` / ``multiline`` default to a per-file decision (:func:`file_profiles`).
    """
    groups: dict[tuple[str, bool, str], list[str]] = {}
    for f, (enc, multi, head) in sorted(file_profiles(spark, path).items()):
        key = (encoding or enc, multi if multiline is None else multiline, head)
        groups.setdefault(key, []).append(f)
    if not groups:
        raise ValueError(f"{path}: empty CSV file")
    headers = [_header(spark, files[0], enc, multi) for (enc, multi, _), files in groups.items()]
    order: dict[tuple[str, int], str] = {}
    for names in headers:
        for key, name in zip(_keys(names), names):
            order.setdefault(key, name)
    out = None
    for names, ((enc, multi, _), files) in zip(headers, groups.items()):
        raw = _read_files(spark, len(names), enc, multi, files)
        cells = {k: F.when(F.col(f"_{i}") == QUOTED_EMPTY, F.lit("")).otherwise(F.col(f"_{i}"))
                 for i, k in enumerate(_keys(names))}
        part = raw.select(*[cells.get(k, F.lit(None).cast("string")).alias(f"c{i}")
                            for i, k in enumerate(order)])
        out = part if out is None else out.union(part)
    return out.toDF(*order.values())


def parse_csv(spark: SparkSession, path: str | Sequence[str], *, encoding: str | None = None,
              multiline: bool | None = None) -> tuple[DataFrame, list[TypeDecision]]:
    """Header, encoding choice, ragged rows, then S1b typing over all rows."""
    return sniff(read_csv_text(spark, path, encoding=encoding, multiline=multiline), csv=True)


def is_excel(url: str) -> bool:
    """S3: spreadsheet by extension (case-insensitive); anything else is read as CSV."""
    return url.lower().endswith(EXCEL_EXTENSIONS)


def resource_kind(url: Column) -> Column:
    """S3 over a manifest: ``sheets`` or ``csv``, as :func:`is_excel` tells them apart; null for no URL."""
    return F.when(url.isNotNull(), F.when(ends_with_any(url, EXCEL_EXTENSIONS), F.lit("sheets")).otherwise(F.lit("csv")))
