"""Column-name operators: normalise (N1), collision check (N2), fuzzy resolve (N4),
provenance column (N10).

Names are schema metadata, so these run on the driver over ``df.columns`` and end in one
``toDF``/``select``; no rows move.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Characters that become "_" and characters that are removed in a normalised name.
UNDERSCORED = (" ", "-", "/", ".")
REMOVED = ("(", ")")


class NameCollisionError(ValueError):
    """Two source columns normalise to the same name, or a name normalises to nothing."""


def normalise_name(name: str) -> str:
    """N1 for one name: trim, lower case, separators to ``_``, drop parentheses, collapse and
    strip underscores. Tabs, ``%`` and ``&`` are kept as they are."""
    out = name.strip().lower()
    for ch in UNDERSCORED:
        out = out.replace(ch, "_")
    for ch in REMOVED:
        out = out.replace(ch, "")
    out = re.sub("_{2,}", "_", out)
    return out.strip("_")


def normalised(c: Column) -> Column:
    """N1 over a table of header names: :func:`normalise_name` as a column."""
    out = F.lower(F.regexp_replace(c, r"^\s+|\s+$", ""))
    out = F.regexp_replace(out, "[" + re.escape("".join(UNDERSCORED)) + "]", "_")
    out = F.regexp_replace(F.regexp_replace(out, "[" + re.escape("".join(REMOVED)) + "]", ""), "_{2,}", "_")
    return F.regexp_replace(out, "^_+|_+$", "")


def name_collisions(headers: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """N2 over the headers of many files at once, before any is read: for each file (``by``) the
    normalised names that are empty or that several different headers come to, with these headers."""
    return headers.groupBy(*by, normalised(F.col(name)).alias("normalised")) \
        .agg(F.array_sort(F.collect_set(name)).alias("headers")) \
        .filter((F.size("headers") > 1) | (F.col("normalised") == ""))


def unique_names(names: Sequence[str]) -> list[str]:
    """Header names with repeats (case aside) marked by their position: ``a, A`` -> ``a, A_2``."""
    taken, out = {n.casefold() for n in names}, []
    seen: set[str] = set()
    for i, name in enumerate(names, 1):
        new = name
        if name.casefold() in seen:
            new = f"{name}_{i}"
            while new.casefold() in taken:
                new += "_"
            taken.add(new.casefold())
        seen.add(new.casefold())
        out.append(new)
    return out


def normalise_names(df: DataFrame) -> DataFrame:
    """N1 + N2: rename every column; refuse collisions and empty results instead of
    silently dropping or suffixing a column."""
    new = [normalise_name(c) for c in df.columns]
    seen: dict[str, str] = {}
    for old, n in zip(df.columns, new):
        if not n:
            raise NameCollisionError(f"column {old!r} normalises to an empty name")
        if n in seen:
            raise NameCollisionError(f"columns {seen[n]!r} and {old!r} both normalise to {n!r}")
        seen[n] = old
    return df.toDF(*new)


def find_column(df: DataFrame | Sequence[str], *needles: str) -> str | None:
    """First column (schema order) whose lower-cased name contains any needle; else None."""
    cols = df.columns if isinstance(df, DataFrame) else list(df)
    low = [n.lower() for n in needles]
    for c in cols:
        lc = c.lower()
        if any(n in lc for n in low):
            return c
    return None


def with_provenance(df: DataFrame, name: str, value: str | None = None) -> DataFrame:
    """A literal provenance column (sheet name); without a value, the input file path."""
    col = F.lit(value) if value is not None else F.col("_metadata.file_path")
    return df.withColumn(name, col)


def coalesce_drifted(df: DataFrame, target: str, *candidates: str,
                     cast: T.DataType | None = None) -> DataFrame:
    """N11 (opt-in): one column from the first non-null of several drifted spellings.

    Missing candidates are ignored, so the same call works on every snapshot generation.
    """
    present = [c for c in candidates if c in df.columns]
    if not present:
        return df.withColumn(target, F.lit(None).cast(cast or T.StringType()))
    cols = [F.col(c).cast(cast) if cast else F.col(c) for c in present]
    return df.withColumn(target, F.coalesce(*cols))


def coalesce_dates(df: DataFrame, target: str, formats: dict[str, str]) -> DataFrame:
    """N11 for dates: ``{column: pattern}``; each present column parsed leniently, first wins."""
    parts = [F.try_to_date(F.col(c).cast("string"), p) for c, p in formats.items()
             if c in df.columns]
    return df.withColumn(target, F.coalesce(*parts) if parts else F.lit(None).cast("date"))
