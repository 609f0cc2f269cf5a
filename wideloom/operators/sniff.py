"""Type decisions for text columns: CSV inference (S1b) and the numeric sniff.

Both rules decide one type per column from *every* value of the column, in one aggregate pass over
the rows (one row of flags reaches the driver), and cast the column in one projection:

* S1b (CSV only): all integers -> bigint; integers and decimals -> double; all ``true``/``false``
  -> boolean; anything else -> text;
* N5 (every column still text): all integers -> bigint; all numbers -> double; else unchanged.

Nulls and ``""`` say nothing about the type; a column without any other value stays text. Since all
values are seen, a cast turns no value into null but ``""``. A column stays text if a value would not
survive: ``1e400`` is no double, a whole number beyond 64 bits (beyond 2^53 beside decimals) would lose digits.

Spark's own casts accept more than a strict number grammar (``' 12 '``, ``'1d'``, ``'inf'``), so
every decision and cast goes through the guards below. Columns are addressed by position, so names
may hold dots, backticks or differ in case only.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The number and boolean grammar accepted as "parses".
INT_RX = r"^[+-]?[0-9]+$"
FLOAT_RX = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
BOOL_RX = r"^(?i)(true|false)$"
EXACT_WHOLE = 1 << 53                      # whole numbers up to here are exact as doubles


def is_int(v: Column) -> Column:
    return v.rlike(INT_RX) & v.try_cast("bigint").isNotNull()


def is_float(v: Column) -> Column:
    """A finite number; a whole number only if a double holds all of its digits."""
    number = v.try_cast("double")
    exact = F.when(v.rlike(INT_RX), F.coalesce(F.abs(v.try_cast("bigint")) <= EXACT_WHOLE, F.lit(False))).otherwise(F.lit(True))
    return v.rlike(FLOAT_RX) & F.coalesce(F.abs(number) < float("inf"), F.lit(False)) & exact


def is_bool(v: Column) -> Column:
    return v.rlike(BOOL_RX)


def lenient_cast(v: Column, kind: str) -> Column:
    """Cast through the guard; misfits become null."""
    if kind == "bigint":
        return F.when(is_int(v), v.try_cast("bigint"))
    if kind == "double":
        return F.when(is_float(v), v.try_cast("double"))
    if kind == "boolean":
        return F.when(is_bool(v), F.lower(v) == F.lit("true"))
    return v


@dataclass
class TypeDecision:
    column: str
    kind: str          # bigint | double | boolean | string
    rule: str          # S1b | N5 | none


def decide_types(df: DataFrame, cols: Sequence[str], *, booleans: bool) -> dict[str, str]:
    """Type of each text column from all its values: one aggregate, one row of flags."""
    if not cols:
        return {}
    aggs = []
    for c in cols:
        v = F.col(c)
        for name, fits in (("int", is_int(v)), ("num", is_float(v)), ("bool", is_bool(v))):
            aggs.append(F.bool_and(F.when(v != "", fits)).alias(f"{c}_{name}"))
    flags = df.agg(*aggs).first()          # a flag is null when the column has no value
    return {c: "bigint" if flags[f"{c}_int"] else "double" if flags[f"{c}_num"]
            else "boolean" if booleans and flags[f"{c}_bool"] else "string" for c in cols}


def sniff(df: DataFrame, *, csv: bool = False) -> tuple[DataFrame, list[TypeDecision]]:
    """N5, with ``csv`` S1b before it; the typed frame and one decision per text column."""
    places = [f"_{i}" for i in range(len(df.columns))]
    rows = df.toDF(*places)
    text = {p: f.name for p, f in zip(places, df.schema.fields) if isinstance(f.dataType, T.StringType)}
    kinds = decide_types(rows, list(text), booleans=csv)
    decisions = [TypeDecision(name, kinds[p], "none" if kinds[p] == "string" else "S1b" if csv else "N5")
                 for p, name in text.items()]
    typed = [lenient_cast(F.col(p), kinds.get(p, "string")).alias(p) for p in places]
    return rows.select(*typed).toDF(*df.columns), decisions
